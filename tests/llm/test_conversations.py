"""Conversation repair, the prefix trie and ordered digests against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quayside.llm import common, conversation_repair, ordered, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, kind string, n string, digest string, pos int"
SPACE = common.WORD_SEPARATORS


def make(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", "n", "d", 1) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    """Rows (conv, turn, role, text) of each conversation by turn (null first), role and digest."""
    out = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        out[c].append((t is not None, t or 0, role, digest, text))
    return {c: [(x[2], x[4], x[1] if x[0] else None) for x in sorted(rs)] for c, rs in out.items()}


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one conversation's (role, text, turn)."""
    faults, seen = [], set()
    for role, text, _ in rows:
        shown = text.strip(SPACE)
        faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "", [])}

    def inserted(states):
        for _ in range(2):
            more = {}
            for q, (cost, audit, said) in states.items():
                to = step[q]
                new = (cost + 2, audit + "I", [*said, "assistant:" if to == 3 else "user:"])
                if (to not in states or new[:2] < states[to][:2]) and (to not in more or new[:2] < more[to][:2]):
                    more[to] = new
            states = {**states, **more}
        return states

    for (role, text, _), fault in zip(rows, faults):
        best, moved = inserted(best), {}

        def put(q, new):
            if q not in moved or new[:2] < moved[q][:2]:
                moved[q] = new

        for q, (cost, audit, said) in best.items():
            put(q, (cost + 3, audit + "D", said))
            if fault in "bd" and fault:
                continue
            late = fault == "t"
            to = {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(role[:1])
            if to:
                put(to, (cost + late, audit + "K", [*said, f"{role}:{text}"]))
            put(step[q], (cost + 2 + late, audit + "R", [*said, ("assistant:" if step[q] == 3 else "user:") + text]))
        best = moved
    cost, audit, said = min((v for q, v in inserted(best).items() if q in (0, 3)), key=lambda v: v[:2])
    turns = [t for _, _, t in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha("\n".join(said)))


def odd_conversations(seed=3):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "What?", "", "  ", "A\nB!", "so. ", "the end", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows + rng.sample(rows, 60)


def repaired(spark, rows, ids=None):
    found = conversation_repair.repair(make(spark, rows), ids)
    return {r.conv: tuple(r)[1:] for r in conversation_repair.digests(found).collect()}


def test_repair_matches_brute_force(spark):
    rows = odd_conversations()
    ids = spark.createDataFrame([(c,) for c in [*range(62), None]], "id bigint")
    got = repaired(spark, rows, ids)
    expected = {c: brute_repair(rs) for c, rs in in_order(rows).items()}
    expected |= {c: (0, 0, 0, 0, 0, 0, "", sha("")) for c in (60, 61)}
    assert got == expected


def test_long_conversations_cross_partitions(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), f"turn {rng.randint(0, n // 2)}.")
            for c, n in ((1, 3000), (2, 2), (3, 700), (4, 1), (5, 900)) for t in range(n)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repaired(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {c: brute_repair(rs) for c, rs in in_order(rows).items()}


def test_rows_in_parts_are_worked_off_alike(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "BLOCK", 4)
    monkeypatch.setattr(conversation_repair, "ROWS_AT_ONCE", 10)
    monkeypatch.setattr(conversation_repair, "NODES_AT_ONCE", 64)
    rows = odd_conversations(7)
    expected = {c: brute_repair(rs) for c, rs in in_order(rows).items()}
    assert repaired(spark, rows) == expected


def test_a_turn_that_fills_a_conversation(spark):
    rows = [(1, 0, "user", "Hi.")] * 500 + [(1, 1, "assistant", "Hello.")] * 300 + [(1, 2, "user", "  ")] * 200
    got = repaired(spark, rows)[1]
    assert got == brute_repair(in_order(rows)[1]) and got[6] == "K" + "D" * 499 + "K" + "D" * 499


def test_repaired_turns_and_empty_tables(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", ""), (1, 3, "user", "So?")]
    found = conversation_repair.repair(make(spark, rows))
    turns = [(r.role, r.text, r.inserted) for r in found.turns.orderBy("place").collect()]
    said = ["\n".join(f"{r}:{t}" for r, t, _ in turns)]
    assert [sha(x) for x in said] == [r.repaired_sha256 for r in conversation_repair.digests(found).collect()]
    assert [r for r, _, _ in turns] == ["system", "user", "assistant", "user", "assistant"]
    none = make(spark, [])
    found = conversation_repair.repair(conversation_repair.damage(none), none.select("conv_id"))
    assert conversation_repair.digests(found).count() == 0 and found.turns.count() == 0


def test_damage(spark):
    rows = [(c, t, r, x) for c in [*range(40), None] for t, r, x in
            ((0, "user", "One. Two!"), (1, None, None), (None, "assistant", "A?"))]
    got = sorted(map(str, (tuple(r) for r in conversation_repair.damage(make(spark, rows)).collect())))
    expected = []
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        kind, role, text = crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        expected += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(map(str, expected))


def brute_trie(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (*x[:3], hashlib.sha256(
        f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()))] for c, v in own.items()}
    full = {c: (*own.get(c - c % 5, [])[:(h := crc32(str(c).encode()) % 9)], *own[c][h:]) for c in own}
    members = defaultdict(list)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = {}
    for node, cs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        out[min(cs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(cs), sum(len(m) == len(node) + 1 for m in below),
            sum(not any(len(o) == len(m) + 1 and o[:-1] == m for o in below) for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
            sha(",".join(str(c) for c in sorted(cs) if full[c] == node)))
    return out


def trie(spark, rows):
    got = prefix_trie.nodes(*prefix_trie.rebuilt(prefix_trie.turn_digests(make(spark, rows)))).collect()
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in got}
    assert len(found) == len(got)
    return found


def test_trie_matches_brute_force(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None]))
            for c in range(80) if c % 7 for t in range(rng.choice([1, 2, 3, 9, 14]))]
    rows += [(c, None, "user", "null turn") for c in range(0, 80, 9)] + [(None, 1, "user", "no id"), *rows[:20]]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 300, 5) for t in range(4)]  # a group of copies
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_a_long_conversation_and_of_none(spark):
    rows = [(5, t, "user", f"turn {t % 50}") for t in range(1500)] + [(c, t, "user", f"turn {t}") for c in (6, 7) for t in range(12)]
    got = trie(spark, rows)
    assert got == brute_trie([r for r in rows if r[0] != 5 or r[1] < 20]) | {k: v for k, v in got.items() if k[0] == 5}
    assert sum(k[0] == 5 for k in got) == 1501 and got[5, 1500][1] == 1
    assert trie(spark, []) == {} and trie(spark, [(None, 1, "user", "x")]) == {}


def test_digests_of_groups_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK", 40)
    rows = [(g, i, f"text {g} {i}") for g, n in ((1, 400), (2, 1), (None, 30), (3, 3), (4, 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int, piece string").repartition(5)
    got = {r.g: r.sha256 for r in ordered.sha256_by_group(df, "g", ["i"], "piece", "\n").collect()}
    expected = defaultdict(list)
    for g, _, piece in rows:
        expected[g].append(piece)
    assert got == {g: sha("\n".join(p)) for g, p in expected.items()}


def test_running_totals_cross_partitions(spark):
    rows = [(g, i) for g, n in ((1, 500), (2, 3), (3, 100)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int").repartition(5)
    got = ordered.running(df, "g", ["i"], {"n": F.sum("i")}, {"n": F.sum("n")}).selectExpr(
        "g", "i", "n + coalesce(_before_n, 0) AS n").collect()
    assert {(r.g, r.i): r.n for r in got} == {(g, i): i * (i + 1) // 2 for g, i in rows}


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_prefix_trie"])
def test_registered_queries_match_sql(spark, sf_dir, name):
    import duckdb

    from quayside.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    expected = con.execute(queries.ORACLE[name])
    names = [d[0] for d in expected.description]
    got = queries.QUERIES[name](spark, sf_dir).select(names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected.fetchall()))
