"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Words become template tokens: numbers, names (capitalised inside a sentence) and units (after a number) are replaced
by typed placeholders whose values are kept as slots. Windows of template tokens of documents and benchmark items are
joined by hash. For each document and item that share windows, slots must be consistent: every value of the item
corresponds to one value of the document, so a question with new numbers or names is caught, but not a text that fills the
same template at random. A document is contaminated by an item if consistent windows cover enough of the item.

Occurrences of an item are judged apart, so one that is consistent contaminates the document whatever else it holds:
windows of one text that stand equally far from their place in the item; runs of these whose distances differ by
at most ``MAX_SHIFT`` tokens, as after a word that was put in; and all windows of the key together.

Every window also has a literal hash, in which numbers, names and units stand for themselves: so windows with fewer
than ``MIN_LITERALS`` literal tokens, which placeholders alone could match, are found where they stand word for word.
Template and literal windows are counted apart, each against its own number in the item. An item is also found by
``MIN_RUN`` windows in a row, however long it is. An item without any template window of enough literals (an arithmetic
question, say) is found by the types and the order of its slots, if all its template windows of at least ``DENSE_TOKENS``
tokens and ``DENSE_LITERALS`` literals are there and consistent.

A window that m items hold weighs 1/m against the item's least shared window, so an instruction that stands before
hundreds of questions is no evidence for any of them. Windows of more than ``SHARED_BY`` items that together weigh less
than ``min_share`` of an item are left out for that item, on both sides of the share.

Documents give hashes only; slots are read where a hash belongs to the benchmark.

Defined results: null and empty texts have no windows and are clean; an item shorter than a window counts as one
window of all its tokens and is only found as a whole, in documents of any length; repeated rows get
one result each, rows that share a key are judged apart and together, and null keys are one key; ties between items go to
the smallest, and items with equal texts are one, the smallest; ids of items may have any type that can be ordered; an empty
benchmark finds nothing, an empty table gives an empty result. ``filter_clean`` keeps all columns; only key and text are read.

The benchmark's windows are broadcast if they are at most ``MAX_BROADCAST`` rows; otherwise they are shuffled with the
hashes of the documents, and the texts with hits are shuffled once more for their slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common

WINDOW = 8
#: Windows that start in a block of a text. Every hit carries the tokens of its block, so what a task holds doesn't grow
#: with the hits of a text times its length.
BLOCK = 128
#: Literal tokens that a template window needs, so that placeholders alone never match.
MIN_LITERALS = 5
#: Share of an item's windows that must be found in a document.
MIN_SHARE = 0.25
#: Windows in a row that are enough whatever their share: 25 tokens.
MIN_RUN = 18
#: Tokens by which the windows of one occurrence may be shifted against each other.
MAX_SHIFT = 8
#: Tokens and literals of a template window that counts for items without any of enough literals.
DENSE_TOKENS, DENSE_LITERALS = 6, 2
#: Items that may share a window before it can be left out as boilerplate.
SHARED_BY = 10
#: Rows, and bytes of keys, of what is broadcast.
MAX_BROADCAST, MAX_KEY_BYTES = 1_000_000, 32 << 20

#: Units that a number can be followed by.
UNITS = ("percent kg g mg km m cm mm mi mile miles ft feet inch inches l ml s sec seconds min minutes h hours hour day days "
         "week weeks month months year years eur euro euros usd dollar dollars cent cents gb mb kb").split()

#: Words that begin a question or a task, and are no names even with a capital inside a sentence.
OPENERS = ("What Which Who Whose Whom When Where Why How Is Are Was Were Do Does Did Can Could If The Find Add Solve Compute "
           "Calculate").split()

_NAME = "\u0001"
_SLOT = "\u0002"


def _marked(text: Column) -> Column:
    """The text with a mark before every name."""
    return F.regexp_replace(text, rf"([\p{{Ll}},;:] )(?=\p{{Lu}}\p{{Ll}})(?!(?:{'|'.join(OPENERS)})\b)", "$1" + _NAME)


def _tokens(marked: Column) -> Column:
    """Lower-case words without punctuation; a number and letters that follow it are words apart."""
    apart = F.when(F.rlike(marked, F.lit("[0-9]")), F.regexp_replace(marked, r"([0-9])(?=\p{L})", "$1 ")).otherwise(marked)
    return F.array_remove(F.split(F.lower(apart), rf"[^\p{{L}}\p{{M}}\p{{N}}{_NAME}]+"), "")


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, n, start, t, k, l, h): the tokens of every text, with the kind (0 literal, 1 name, 2 number, 3 unit), literal
    hash and template hash of each; ``row`` is the hash of the text and ``n`` its number of tokens. A text comes in blocks: the
    ``BLOCK`` tokens from ``start`` and those that their windows also need. Texts without number and name have only t and l.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    marked = docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("row"), _marked(body).alias("m"))
    split = marked.select("key", "row", F.rlike("m", F.lit(f"[0-9{_NAME}]")).alias("slotted"), _tokens(F.col("m")).alias("t"))
    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size("t"), F.lit(1)), F.lit(BLOCK)), lambda s: F.struct(
        s.alias("start"), F.slice(F.col("t"), s, BLOCK + WINDOW - 1).alias("t"), F.get(F.col("t"), s - 2).alias("before")))
    split = split.select("key", "row", "slotted", F.size("t").alias("n"), F.explode_outer(blocks).alias("b")).select(
        "key", "row", "slotted", "n", "b.*")
    digit = lambda w: F.coalesce(F.substring(w, 1, 1).between("0", "9"), F.lit(False))
    kind = lambda w, i: (F.when(F.substring(w, 1, 1) == _NAME, 1).when(digit(w), 2)
                         .when(w.isin(UNITS) & digit(F.when(i == 0, F.col("before")).otherwise(F.get(F.col("t"), i - 1))), 3)
                         .otherwise(0))
    bare = lambda w: F.when(F.substring(w, 1, 1) == _NAME, F.substring(w, 2, 1 << 30)).otherwise(w)
    literal = F.when(F.col("slotted"), F.transform("t", lambda w: F.xxhash64(bare(w)))).otherwise(
        F.transform("t", lambda w: F.xxhash64(w)))
    kinds = split.select("key", "row", "n", "start", "t", F.when(F.col("slotted"), F.transform("t", kind)).alias("k"), literal.alias("l"))
    return kinds.select("key", "row", "n", "start", "t", "k", "l",
                        F.zip_with("l", "k", lambda h, k: F.when(k == 0, h).otherwise(k.cast("long"))).alias("h"))


def _hashes(of: str, span: Column) -> Column:
    """The hash of every window of ``span`` tokens that starts in the block, in order, from the literal (l) or the template (h)
    hashes of the tokens."""
    starts = F.when(F.size(of) >= span, F.sequence(F.lit(1), F.least(F.size(of) - span + 1, F.lit(BLOCK)))).otherwise(
        F.array().cast("array<int>"))
    part = lambda i: F.slice(F.col(of), i, span)
    return F.transform(starts, lambda i: F.xxhash64(F.lit(1), part(i)) if of == "h" else F.xxhash64(part(i)))


def _slots() -> Column:
    """The values of a template window's slots, in order; literal windows have none."""
    values = F.filter(F.transform(F.sequence(F.col("pos"), F.col("pos") + F.col("size") - 1),
                                  lambda i: F.when(F.element_at("k", i) > 0, F.element_at("t", i))), lambda v: v.isNotNull())
    return F.when(F.col("template"), F.array_join(values, _SLOT)).otherwise("")


def item_windows(benchmark: DataFrame, item: str, text: str, min_share: float) -> DataFrame:
    """(item, item_pos, size, template, h, item_slots, kinds, weight): the windows that count for each item, and what for."""
    # items with equal texts are one; of an item that repeats, windows are not counted twice
    items = benchmark.groupBy(F.col(text).alias("text")).agg(F.min(item).alias("item"))
    hashed = _hashed(items, "item", "text").withColumn("size", F.least(F.lit(WINDOW), F.col("n"))).where("size > 0")
    made = [hashed.select("key", "start", "t", "k", "size", F.lit(of == "h").alias("template"), _hashes(of, F.col("size")).alias("w"))
            for of in "lh"]
    every = made[0].union(made[1]).select("key", "start", "t", "k", "size", "template", F.posexplode_outer("w").alias("at", "h")).where(
        "h is not null")
    every = every.withColumn("pos", F.col("at") + 1)
    literals = F.when(F.col("k").isNull(), F.col("size")).otherwise(F.size(F.filter(F.slice("k", F.col("pos"), F.col("size")), lambda k: k == 0)))
    found = every.select(F.col("key").alias("item"), (F.col("start") + F.col("at")).alias("item_pos"), "size", "template", "h", _slots().alias("item_slots"),
                         literals.alias("literals")).where("not template or literals < size").distinct()
    found = common.stored(found, "benchmark-all-windows")
    strong = F.col("literals") >= MIN_LITERALS
    bare = (F.col("literals") == F.col("size"))
    dense = (F.col("size") >= DENSE_TOKENS) & (F.col("literals") >= DENSE_LITERALS)
    templates = F.max(strong & (F.col("template") | bare)).over(Window.partitionBy("item"))
    kinds = (F.when(F.col("template") & strong, F.array(F.lit("template")))
             .when(F.col("template") & dense & ~F.col("has_template"), F.array(F.lit("dense")))
             .when(F.col("template"), F.array().cast("array<string>"))
             .when(strong & bare, F.array(F.lit("template"), F.lit("literal"))).otherwise(F.array(F.lit("literal"))))
    kept = found.withColumn("has_template", templates).withColumn("kind", F.explode(kinds))
    shared = found.groupBy("h").agg(F.count_distinct("item").alias("m"))
    of_kind = Window.partitionBy("item", "kind")
    weighed = kept.join(shared, "h").withColumn("weight", F.min("m").over(of_kind) / F.col("m"))
    lighter = F.sum("weight").over(of_kind.orderBy(F.desc("m")).rangeBetween(Window.unboundedPreceding, 0))
    weighed = weighed.withColumn("lighter", lighter).withColumn("whole", F.sum("weight").over(of_kind))
    return weighed.where((F.col("m") <= SHARED_BY) | (F.col("lighter") >= F.col("whole") * min_share)).select(
        "item", "item_pos", "size", "template", "h", "item_slots", "kind", "weight")


def found_windows(docs: DataFrame, key: str, text: str, hashes: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """(key, row, pos, h, slots): the windows of ``docs`` whose hash is one of ``hashes`` (h, size, template)."""
    of_block = F.sequence(F.lit(1), F.greatest(F.least(F.size("t"), F.lit(BLOCK)), F.lit(1)))
    part = lambda of, z: F.slice(of, F.col("pos"), F.lit(z))
    window = lambda of, z: F.when(F.size(of) >= F.col("pos") + z - 1,
                                  F.xxhash64(F.lit(1), part(of, z)) if of == "h" else F.xxhash64(part(of, z)))
    # one window at a time, in generated code: no array of a text's windows is made
    placed = _hashed(docs, key, text).select("key", "row", "start", "t", "k", "l", "h", F.explode_outer(of_block).alias("pos"))
    every = F.array(*[window(of, z) for of in "lh" for z in sizes]).cast("array<bigint>")
    hashed = placed.select("key", "row", "start", "t", "k", "pos", F.explode_outer(every).alias("h"))
    if small:
        met = hashed.join(F.broadcast(hashes), "h")
    else:
        narrow = hashed.drop("t", "k").join(hashes, "h").select(
            F.col("key").alias("of"), F.col("row").alias("of_row"), F.col("start").alias("of_start"), "h", "size", "template", "pos").distinct()
        blocks = _hashed(docs, key, text).select("key", "row", "start", "t", "k").dropDuplicates(["key", "row", "start"])
        met = narrow.join(blocks, F.col("of").eqNullSafe(F.col("key")) & (F.col("of_row") == F.col("row"))
                          & (F.col("of_start") == F.col("start")))
    return met.select("key", "row", (F.col("start") + F.col("pos") - 1).alias("pos"), "h", _slots().alias("slots"))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text", min_share: float = MIN_SHARE, min_run: int = MIN_RUN,
            max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(key, item, n_windows, n_found, consistent, exact): every document and item that share enough windows, from the
    occurrence that is consistent and has most of them."""
    items = common.stored(item_windows(benchmark, item, item_text, min_share), "benchmark-windows")
    sizes = items.groupBy(F.col("item").alias("of"), F.col("kind").alias("of_kind")).agg(
        F.count("*").alias("n_windows"), F.sum("weight").alias("whole"))
    lengths = sorted(r["size"] for r in items.select("size").distinct().collect())  # from 1 to WINDOW
    small = items.limit(max_broadcast + 1).count() <= max_broadcast
    found = found_windows(docs, key, text, items.select("h", "size", "template").distinct(), lengths, small)
    items = items.drop("size", "template")
    found = found.join(F.broadcast(items) if small else items, "h")
    # each window's slots side by side: (value in the item, value in the document)
    pairs = F.when(F.col("slots") == "", F.array().cast("array<struct<i:string,d:string>>")).otherwise(F.zip_with(
        F.split("item_slots", _SLOT), F.split("slots", _SLOT), lambda i, d: F.struct(i.alias("i"), d.alias("d"))))
    places = found.groupBy("key", "row", "item", "kind", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.sort_array(F.collect_set(F.struct("item_pos", "weight"))).alias("at"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    seen = _evidence(_occurrences(places.withColumn("in_a_row", _heaviest_run(F.col("at")))))
    judged = seen.join(F.broadcast(sizes) if small else sizes, F.col("item").eqNullSafe(F.col("of")) & (F.col("kind") == F.col("of_kind")))
    share = F.round(F.col("weight") / F.col("whole"), 9)
    enough = F.when(F.col("kind") == "dense", F.col("n_found") == F.col("n_windows")).otherwise(
        (share >= min_share) | (F.col("in_a_row") >= min_run))
    found = judged.where(enough).select("key", "item", F.struct(
        (F.col("one_each") | F.col("rest")).alias("consistent"), share, "exact", "n_found", "n_windows").alias("o"))
    return found.groupBy("key", "item").agg(F.max("o").alias("o")).select(
        F.col("key").alias(key), F.col("item").alias(item), "o.n_windows", "o.n_found", "o.consistent", "o.exact")


def _heaviest_run(at: Column) -> Column:
    """The weight of ascending windows that follow each other without a gap, at most."""
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("most"))

    def step(had, x):
        weight = F.when(x["item_pos"] == had["last"] + 1, had["weight"] + x["weight"]).otherwise(x["weight"])
        return F.struct(x["item_pos"].alias("last"), weight.alias("weight"), F.greatest(had["most"], weight).alias("most"))

    return F.round(F.aggregate(at, start, step, lambda had: had["most"]), 9)


def _occurrences(places: DataFrame) -> DataFrame:
    """(key, item, kind, occurrence, at, in_a_row, pairs): each place for each occurrence that it may belong to."""
    of_text = Window.partitionBy("key", "row", "item", "kind")
    along = of_text.orderBy("shift")
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(along) > MAX_SHIFT, F.lit(False))
    runs = places.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(along)).withColumn(
        "n_places", F.count("*").over(of_text))
    number = lambda kind, row, at: F.struct(
        F.lit(kind).alias("kind"), row.cast("long").alias("row"), at.cast("long").alias("at"))
    place, of_key = number("place", F.col("row"), F.col("shift")), number("key", F.lit(0), F.lit(0))
    # a run of one place is that place
    levels = F.when(F.col("n_places") == 1, F.array(place, of_key)).otherwise(
        F.array(place, number("run", F.col("row"), F.col("run")), of_key))
    return runs.select("key", "item", "kind", "at", "in_a_row", "pairs", F.explode(levels).alias("occurrence"))


def _evidence(occurrences: DataFrame) -> DataFrame:
    """(key, item, kind, occurrence, n_found, weight, in_a_row, one_each, exact, rest): what the places of an occurrence say
    together. Windows and slot values of the item are grouped one by one, so however many rows share a key, no more is held
    for it than the item has of them; values of documents for one value of the item are told apart by their hash.
    """
    none = F.lit(None)
    entries = F.concat(
        F.transform("at", lambda x: F.struct(x["item_pos"].alias("pos"), x["weight"].alias("weight"), none.cast("string").alias("i"),
                                             none.cast("boolean").alias("same"), none.cast("long").alias("d"))),
        F.transform("pairs", lambda p: F.struct(none.cast("int").alias("pos"), none.cast("double").alias("weight"), p["i"].alias("i"),
                                                (p["i"] == p["d"]).alias("same"), F.xxhash64(p["d"]).alias("d"))))
    every = occurrences.select("key", "item", "kind", "occurrence", "in_a_row", F.explode_outer(entries).alias("e")).select(
        "key", "item", "kind", "occurrence", "in_a_row", "e.*")
    # the original may stand beside a variant: its slots, equal in the item and the document, don't count against it
    other = F.when(~F.col("same"), F.col("d"))
    each = every.groupBy("key", "item", "kind", "occurrence", "pos", "i").agg(
        F.max("weight").alias("weight"), F.max("in_a_row").alias("in_a_row"), F.bool_and("same").alias("same"),
        (F.min("d") == F.max("d")).alias("one"), F.coalesce(F.min(other) == F.max(other), F.lit(True)).alias("one_other"))
    true = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    return each.groupBy("key", "item", "kind", "occurrence").agg(
        F.count("pos").cast("int").alias("n_found"), F.sum("weight").alias("weight"), F.max("in_a_row").alias("in_a_row"),
        true("one").alias("one_each"), true("same").alias("exact"), true("one_other").alias("rest"))


def judge(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          **options) -> DataFrame:
    """(key, item, n_found, n_windows, exact) of contaminated documents: the item of which most is found."""
    found = matches(docs, benchmark, key, text, item, **options).where("consistent")
    best = F.min_by(F.struct(item, "n_found", "n_windows", "exact"),
                    F.struct(-F.col("n_found") / F.col("n_windows"), F.col(item)))
    return found.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def filter_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item contaminates. Contaminated keys are broadcast up to a bound, so the texts stay where
    they are; beyond it both are shuffled."""
    bad = common.stored(judge(docs, benchmark, key, text).select(F.col(key).alias("_bad")), "contaminated")
    n, size = bad.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("_bad").cast("string"))), F.lit(0))).first()
    few = n <= MAX_BROADCAST and size <= MAX_KEY_BYTES
    return docs.join(F.broadcast(bad) if few else bad, docs[key].eqNullSafe(bad["_bad"]), "left_anti")
