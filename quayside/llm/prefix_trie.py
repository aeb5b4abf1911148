"""The prefix trie of conversations, by collapsing whole sequences first.

Conversations whose turns are all alike become one weighted sequence with the list of conversations that end there.
Every further step works on these sequences only, however many copies a conversation has. Sequences that are proper
prefixes of others are dropped by an anti-join, which leaves the leaves; the prefixes of the sequences, with their
weights, are then put together into nodes.

A prefix is known by its depth and the exclusive or of two 64-bit hashes of each of its turns with their places, which
can be put together from parts: a conversation of any length is spread over many tasks (see ``ordered``). That equal
fingerprints have equal turns is checked: all sequences of a node must agree in its last turn and in its parent, else the
query fails.

Sums over subtrees need no walk. A node is owned by the sequence of its smallest member; that sequence also owns what
follows below on it. So a subtree's sum is the total owned by all sequences through its top, less what the top's owner
owns above it.

Defined results: rows are ordered by turn (null first), then by role and text; a null role or text is empty; rows
without conv_id belong to no conversation and give no node; repeated rows are turns of their own; turnless conversations
are members of the root; an empty table has no members and gives no rows. Columns beside the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import common, ordered

#: The registered query takes the first turns of the conversation whose id is the next lower multiple of this.
SHARED_BY, MOST_SHARED = 5, 8

NODE = ["depth", "_x", "_y"]


def turn_digests(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """conv, pos (from 1), digest and n_bytes of every turn; texts go no further than this scan."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), role_.alias("role"), digest.alias("digest"),
        F.octet_length(text_).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("at"))
    placed = ordered.running(rows, "conv", ["turn", "role", "digest", "at"], {"pos": F.count(F.lit(1))},
                             {"pos": F.sum("pos")})
    return placed.select("conv", (F.col("pos") + F.coalesce(F.col("_before_pos"), F.lit(0))).alias("pos"),
                         "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first h turns of the one whose id is the next lower multiple of ``SHARED_BY``
    and go on with their own turns after the first h; h is the id's crc32 modulo one more than ``MOST_SHARED``. Returns
    all ids (conv), and the turns."""
    lengths = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv") - F.col("conv") % SHARED_BY
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)
    starts = lengths.select(F.col("conv").alias("_base"), F.least("n", F.lit(MOST_SHARED)).alias("_has"))
    convs = lengths.select("conv", base.alias("_base"), h.alias("_h")).join(starts, "_base", "left").select(
        "conv", "_base", "_h", F.least("_h", F.coalesce("_has", F.lit(0))).alias("_taken"))
    convs = common.stored(convs, "trie-convs")
    shared = turns.where(F.col("pos") <= MOST_SHARED).withColumnRenamed("conv", "_base").join(convs, "_base").where(
        F.col("pos") <= F.col("_h"))
    own = turns.join(convs, "conv").where(F.col("pos") > F.col("_h")).withColumn(
        "pos", F.col("pos") - F.col("_h") + F.col("_taken"))
    columns = ["conv", "pos", "digest", "n_bytes"]
    return convs.select("conv"), shared.select(columns).unionByName(own.select(columns))


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.coalesce(F.col(b), F.lit(0)))


def sequences(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv (the smallest), depth, fingerprint and weight of every distinct whole sequence, and the digest of its end
    list: the ids of all conversations with that sequence, ascending."""
    whole = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("depth"), F.bit_xor("_hx").alias("_x"),
                                      F.bit_xor("_hy").alias("_y"))
    whole = convs.join(whole, "conv", "left").select("conv", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in NODE))
    whole = common.stored(whole, "trie-whole")
    grouped = whole.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"))
    grouped = common.stored(grouped, "trie-sequences")
    key = F.concat_ws(":", *NODE)
    ends = ordered.sha256_by_group(whole.select(key.alias("_key"), "conv"), "_key", ["conv"], "conv", ",")
    return grouped.withColumn("_key", key).join(ends, "_key", "left").drop("_key").withColumnRenamed("sha256", "ends_sha256")


def nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, pos, digest, n_bytes); ``convs`` lists all conversations."""
    turns = common.stored(turns.withColumns({"_hx": F.xxhash64("pos", "digest"), "_hy": F.xxhash64("digest", "pos", F.lit(1))}),
                          "trie-turns")
    seqs = common.stored(sequences(convs, turns), "trie-weighted")
    reps = turns.join(seqs.select("conv", "weight", F.col("depth").alias("_length")), "conv")
    paths = ordered.running(reps, "conv", ["pos"], {"_x": F.bit_xor("_hx"), "_y": F.bit_xor("_hy")},
                            {"_x": F.bit_xor("_x"), "_y": F.bit_xor("_y")})
    paths = paths.withColumns({"_x": _xor("_x", "_before__x"), "_y": _xor("_y", "_before__y")})
    paths = paths.select("conv", F.col("pos").alias("depth"), "_x", "_y", "weight", "_length", "digest", "n_bytes",
                         _xor("_x", "_hx").alias("_px"), _xor("_y", "_hy").alias("_py"))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    roots = seqs.select("conv", zero.alias("depth"), zero.alias("_x"), zero.alias("_y"), "weight",
                        F.col("depth").alias("_length"), none.cast("binary").alias("digest"), zero.alias("n_bytes"),
                        none.cast("long").alias("_px"), none.cast("long").alias("_py"))
    paths = common.stored(paths.unionByName(roots), "trie-prefixes")

    proper = paths.where(F.col("depth") < F.col("_length")).select(NODE).distinct()
    leaves = seqs.join(proper, NODE, "left_anti").select("conv", F.lit(1).cast("long").alias("_leaf"))

    same = (F.min("digest").eqNullSafe(F.max("digest")) & F.min("_px").eqNullSafe(F.max("_px"))
            & F.min("_py").eqNullSafe(F.max("_py")))
    found = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.sum("weight").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.max("_px").alias("_px"), F.max("_py").alias("_py"), same.alias("_same"))
    found = found.withColumn("_value", F.when(F.col("_same"), (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(
        F.raise_error(F.lit("unlike prefixes have one fingerprint"))).cast("long")).drop("_same", "n_bytes")
    found = common.stored(found, "trie-nodes")

    owned = found.groupBy("conv").agg(F.sum("_value").alias("_owned"))
    per_sequence = seqs.select("conv").join(leaves, "conv", "left").join(owned, "conv", "left")
    sums = paths.select("conv", *NODE).join(per_sequence, "conv").groupBy(*NODE).agg(
        F.sum("_leaf").alias("n_leaves"), F.sum("_owned").alias("_through"))
    above = ordered.running(found.select("conv", *NODE, "_value"), "conv", ["depth"], {"_upto": F.sum("_value")},
                            {"_upto": F.sum("_upto")})
    above = above.select(*NODE, (F.col("_upto") + F.coalesce("_before__upto", F.lit(0)) - F.col("_value")).alias("_above"))
    parent = [(F.col("depth") - 1).alias("depth"), F.col("_px").alias("_x"), F.col("_py").alias("_y")]
    children = found.where("depth > 0").select(parent).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("_x").alias("_px"), F.col("_y").alias("_py"),
                           F.col("conv").alias("parent_conv_id"))
    joined = (found.join(sums, NODE).join(above, NODE).join(children, NODE, "left")
              .join(seqs.select(*NODE, "ends_sha256"), NODE, "left").join(parents, ["depth", "_px", "_py"], "left"))
    zero_if_null = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_children", "n_leaves")]
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", *zero_if_null,
        (F.coalesce("_through", F.lit(0)) - F.col("_above")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
