"""The pipeline's stages against simple versions of their decisions on a small table."""

import corpus_pipeline
from quayside.llm import common
from test_operators import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest tables have 11 toxic labels, too few to learn from
    docs = common.table(spark, sf_dir, "documents")
    ran = {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "sentencepiece":
            assert after.columns == COLUMNS
        ran[name] = (docs.toPandas(), after.toPandas())
        docs = after
    toxic = set(common.table(spark, sf_dir, "labels").where("toxic = 1").toPandas()["doc_id"])
    before, after = ran["toxicity"]
    gone = set(before["doc_id"]) - set(after["doc_id"])
    assert len(toxic & gone) >= 0.8 * len(toxic) and len(gone) < 0.3 * len(before)
    before, after = ran["ngram_join"]
    ids = before["doc_id"].tolist()
    placed = brute_components(before["text"].tolist(), 5, 80)
    groups = {}
    for at, (_, group) in placed.items():
        groups.setdefault(group, []).append(ids[at])
    assert set(after["doc_id"]) == {min(g) for g in groups.values()}
    before, after = ran["decontamination"]
    items = common.table(spark, sf_dir, "benchmark").toPandas()["text"].tolist()
    flat = lambda t: " ".join(t.split())
    held = {d for d, t in zip(before["doc_id"], before["text"]) if any(flat(i) in flat(t) for i in items)}
    gone = set(before["doc_id"]) - set(after["doc_id"])
    assert held <= gone and len(gone) <= len(held) + 5
    before, after = ran["pii"]
    assert not after["text"].str.contains(r"@mail\d").any() and len(after) == len(before)
    final = ran["sentencepiece"][1]
    assert (final["ids"].map(len) == final["n_tokens"]).all()
