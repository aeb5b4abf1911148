"""Repair of conversations to the form (system)? (user assistant)+ by the cheapest edits, with an audit of the edits.

Every row can be kept (K), given another role (R) or deleted (D), and empty turns can be inserted (I). What has been
said decides what may follow, so an edit leads from one of four states to one other: the costs are a path through nodes
(row, state), and the letters along a path are its audit, which no other path has.

Method. Costs to the end come from a dynamic programme over the rows, last row first. Arcs on which a node's cost is
reached are its optimal arcs. Nodes are ranked by the least audits of length 1, 2, 4, ... along them: the rank of twice
the length is that of the pair (rank, rank of the node one pointer ahead), while the pointers double. The ranks choose
each node's arc (least letter, then least rank of its target), and the n-th edit of a path is found by following the
doubled pointers of the binary digits of n, for all places at once.

Conversations of any length. The rows, without texts and with equal rows counted, are dealt by ranges of (conversation,
turn), so that a conversation may lie in many partitions, and are worked off in blocks of ``BLOCK`` rows. What a block
costs from each state to each state is a 4 x 4 table, and tables are put together like products. Every partition reports
its first and last conversation, if broken, as such a table: at most two small rows of each partition are chained on the
driver, which gives every broken piece the costs behind it and the state in which it begins.

Defined results: null conversation ids are a conversation of their own; a null role or text counts as one space; rows
are taken by turn (null first), then role, then a digest of role and text, so equal rows follow each other; a conversation
without rows that ``ids`` names has no faults, no cost, an empty audit and no turns; an empty table gives an empty
result; texts of any length are digested whole. Other columns are not read, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.llm import common, ordered

#: Rows of a conversation that the dynamic programme takes at once, and nodes that a task holds in one array.
BLOCK, NODES_AT_ONCE, ROWS_AT_ONCE = 256, 1 << 18, 50_000

# Costs of the contract.
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 2, 3, 2, 1
# What stands last in what is kept: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# Arcs in the order of their letters; the end of a conversation is passed by a K that has no letter.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)
# Rows: the end of a conversation, one that must go, one that may stay, one that may stay but is truncated, padding.
END, FORCED, WHOLE, TRUNCATED, PADDING = range(5)
ROLES = ("s", "u", "a")  # others are 3

FAR = 1 << 40
_FILLED = np.array([USER, USER, ASSISTANT, USER])  # the state after an inserted or rerolled turn
_KEPT = np.full((4, 4), -1)  # state, role: the state after a kept row
_KEPT[START, 0] = SYSTEM
_KEPT[[START, SYSTEM, ASSISTANT], 1] = USER
_KEPT[USER, 2] = ASSISTANT
_ACCEPTED = np.array([True, False, False, True])
_LEGAL = np.zeros((4, 4), dtype=bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


class Repaired(NamedTuple):
    #: conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    report: DataFrame
    #: conv, place (a struct to order by), role, text, inserted
    turns: DataFrame


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by the crc32 of ``conv_id:turn``: dropped, emptied, without sentence ends,
    repeated, or given the role user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    rows = conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"))
    return rows.drop("_copy")


def _normal(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    role_, text_ = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role_.alias("role"), text_.alias("text"),
                       digest.alias("digest"))


def _diagnosed(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct rows of each conversation without their texts: n copies, the first one's kind, and one END each."""
    shown = F.btrim("text", F.lit(common.WORD_SEPARATORS))
    ended = F.substring(shown, -1, 1).isin(".", "!", "?")
    kind = F.when(shown == "", FORCED).when(ended, WHOLE).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    code = F.coalesce(*(F.when(initial == r, i) for i, r in enumerate(ROLES)), F.lit(3))
    narrow = rows.select("conv", F.lit(False).alias("end"), "turn", "role", "digest", kind.alias("kind"), code.alias("r"),
                         (shown == "").alias("blank"))
    marks = ids.unionByName(rows.select("conv")).select(
        "conv", F.lit(True).alias("end"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
        F.lit(b"").alias("digest"), F.lit(END).alias("kind"), F.lit(3).alias("r"), F.lit(False).alias("blank"))
    counted = narrow.unionByName(marks).groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("n"))
    # a row and role seen in an earlier turn: found by a join, which Spark splits where one row repeats very often
    texts = counted.where(~F.col("end")).groupBy("conv", "digest").agg(
        F.count(F.lit(1)).alias("_turns"), F.min("turn").alias("_first"), F.bool_or(F.col("turn").isNull()).alias("_null"))
    texts = texts.where("_turns > 1").select(F.col("conv").alias("_conv"), F.col("digest").alias("_digest"),
                                             F.when(~F.col("_null"), F.col("_first")).alias("_first"))
    on = counted["conv"].eqNullSafe(texts["_conv"]) & (counted["digest"] == texts["_digest"])
    joined = counted.join(texts, on, "left")
    first = F.col("_digest").isNull() | F.col("turn").eqNullSafe(F.col("_first"))
    return joined.select("conv", "end", "turn", "role", "digest", "r", "n", "blank",
                         F.when(first, F.col("kind")).otherwise(FORCED).cast("int").alias("kind"))


def _min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The table of going through ``a``, then ``b`` (a table, or the costs behind it)."""
    return np.minimum((a[:, :, None] + b[None]).min(1) if b.ndim == 2 else (a + b).min(1), FAR)


def _programme(kind: np.ndarray, role: np.ndarray, n: np.ndarray, behind: np.ndarray):
    """Costs from each node to the end of each block, and optimal arcs [row, block, state, arc], for blocks [block, row]
    with the costs ``behind`` them."""
    blocks, rows = kind.shape
    cost = np.empty((rows + 1, blocks, 4), dtype=np.int64)
    optimal = np.zeros((rows, blocks, 4, 4), dtype=bool)
    cost[rows] = behind
    arcs = np.empty((blocks, 4, 4), dtype=np.int64)
    for i in range(rows - 1, -1, -1):
        k, after = kind[:, i, None], cost[i + 1]
        late = (k == TRUNCATED) * COST_TRUNCATED
        stays = (k == WHOLE) | (k == TRUNCATED)
        kept = _KEPT.T[role[:, i]]
        arcs[:, :, DELETE] = np.where(k == END, FAR, after + np.where(k == PADDING, 0, COST_DELETE * n[:, i, None]))
        arcs[:, :, KEEP] = np.where(stays & (kept >= 0), np.take_along_axis(after, np.maximum(kept, 0), 1) + late,
                                    np.where((k == END) & _ACCEPTED, after, FAR))
        arcs[:, :, REROLE] = np.where(stays, after[:, _FILLED] + COST_REROLE + late, FAR)
        row = arcs[:, :, [DELETE, KEEP, REROLE]].min(2)
        open_ = k[:, 0] != PADDING
        best = row.copy()  # two inserted turns lead back to the state, so one or two are enough
        for state in (USER, ASSISTANT, START, SYSTEM):
            source = row if state in (USER, ASSISTANT) else best
            best[open_, state] = np.minimum(row, source[:, _FILLED] + COST_INSERT)[open_, state]
        arcs[:, :, INSERT] = np.where(open_[:, None], best[:, _FILLED] + COST_INSERT, FAR)
        cost[i] = np.minimum(best, FAR)
        optimal[i] = (arcs == best[:, :, None]) & (arcs < FAR)
    return cost, optimal


def _targets(kind: np.ndarray, role: np.ndarray) -> np.ndarray:
    """The node [row, block, state] that each arc [row, block, state, arc] leads to, as an index; the last row's are sinks."""
    blocks, rows = kind.shape
    node = np.arange((rows + 1) * blocks * 4).reshape(rows + 1, blocks, 4)
    out = np.repeat(node[:, :, :, None], 4, axis=3)
    out[:-1, :, :, DELETE] = node[1:]
    out[:-1, :, :, INSERT] = node[:-1][:, :, _FILLED]
    kept = np.where((kind.T == END)[:, :, None], np.arange(4), np.maximum(_KEPT.T[role.T], 0))
    out[:-1, :, :, KEEP] = np.take_along_axis(node[1:], kept, 2)
    out[:-1, :, :, REROLE] = node[1:][:, :, _FILLED]
    return out


class _Paths(NamedTuple):
    """Least paths of blocks: doubled pointers, the arc chosen at each node, and how many edits follow it."""

    pointers: list[np.ndarray]
    arc: np.ndarray
    edits: np.ndarray
    shape: tuple[int, int, int]

    def exits(self) -> np.ndarray:
        """The state in which each block is left, by the state in which it is entered."""
        return self.pointers[-1].reshape(self.shape)[0] % 4

    def read(self, entered: np.ndarray):
        """All nodes in which edits are made, of paths from the first row of block b in state ``entered[b]``."""
        starts = np.arange(self.shape[1]) * 4 + entered
        size = self.edits[starts]
        nodes = np.repeat(starts, size)
        place = np.arange(len(nodes)) - np.repeat(np.cumsum(size) - size, size)
        for k, pointer in enumerate(self.pointers):
            nodes = np.where(place >> k & 1, pointer[nodes], nodes)
        return nodes, size


def _ranked(kind: np.ndarray, role: np.ndarray, optimal: np.ndarray) -> _Paths:
    rows, blocks = optimal.shape[:2]
    targets = _targets(kind, role).reshape(-1, 4)
    sinks = np.zeros((1, blocks, 4, 4), dtype=bool)
    arcs = np.concatenate([optimal, sinks]).reshape(-1, 4)
    silent = np.concatenate([np.repeat(np.isin(kind.T, (END, PADDING))[:, :, None], 4, 2), np.ones((1, blocks, 4), bool)])
    silent = silent.reshape(-1)
    everyone = np.arange(len(arcs))
    least = arcs.argmax(1)  # the least letter among the optimal arcs
    moves = arcs.any(1)
    rank = np.where(moves & ~(silent & (least != INSERT)), least + 1, 0)
    pointer = np.where(moves, targets[everyone, least], everyone)
    levels = int(3 * (rows + 1)).bit_length()
    for _ in range(levels):
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    # the ranks decide: of the optimal arcs the one of the least letter, then that to the least audit
    key = np.where(arcs, np.arange(4) * (rank.max() + 1) + rank[targets], FAR)
    arc = np.where(moves, key.argmin(1), KEEP)
    pointer = np.where(moves, targets[everyone, arc], everyone)
    edits = (moves & ~(silent & (arc != INSERT))).astype(np.int64)
    pointers = [pointer]
    for _ in range(levels):
        edits = edits + edits[pointers[-1]]
        pointers.append(pointers[-1][pointers[-1]])
    return _Paths(pointers, arc, edits, (rows + 1, blocks, 4))


class _Rows:
    """Rows of broken or whole conversations that lie one behind another, cut into blocks."""

    def __init__(self, kind: np.ndarray, role: np.ndarray, n: np.ndarray, starts: np.ndarray):
        self.kind, self.role, self.n = kind, role, n
        self.starts = starts  # of the conversations
        sizes = np.diff(np.append(starts, len(kind)))
        parts = -(-sizes // BLOCK)
        self.owner = np.repeat(np.arange(len(starts)), parts)  # of the blocks
        self.first_block = np.cumsum(parts) - parts
        within = np.arange(len(self.owner)) - self.first_block[self.owner]
        self.block_start = starts[self.owner] + within * BLOCK
        self.block_size = np.minimum(BLOCK, sizes[self.owner] - within * BLOCK)

    def classes(self, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Blocks of like size, few enough for the memory."""
        width = 1 << np.ceil(np.log2(np.maximum(2, self.block_size[blocks]))).astype(int)
        for w in np.unique(width):
            some = blocks[width == w]
            step = max(1, NODES_AT_ONCE // (int(w) * 4))
            for i in range(0, len(some), step):
                yield some[i:i + step], int(w)

    def padded(self, blocks: np.ndarray, width: int):
        at = self.block_start[blocks, None] + np.arange(width)
        inside = np.arange(width) < self.block_size[blocks, None]
        at = np.where(inside, at, 0)
        return np.where(inside, self.kind[at], PADDING), np.where(inside, self.role[at], 3), np.where(inside, self.n[at], 0)

    def tables(self, blocks: np.ndarray) -> np.ndarray:
        """The 4 x 4 table of each block."""
        out = np.empty((len(self.owner), 4, 4), dtype=np.int64)
        ends = np.where(np.eye(4, dtype=bool), 0, FAR)
        for some, width in self.classes(blocks):
            kind, role, n = (np.repeat(x, 4, axis=0) for x in self.padded(some, width))
            cost, _ = _programme(kind, role, n, np.tile(ends, (len(some), 1)))
            out[some] = cost[0].reshape(len(some), 4, 4).transpose(0, 2, 1)
        return out

    def table(self) -> np.ndarray:
        """The table of all rows together, which are one conversation's."""
        tables = self.tables(np.arange(len(self.owner)))
        whole = tables[-1]
        for t in tables[-2::-1]:
            whole = _min_plus(t, whole)
        return whole

    def solved(self, behind: np.ndarray):
        """Per class of blocks: (blocks, width, costs at the first row, paths). ``behind``: costs behind each conversation."""
        costs = behind[self.owner].copy()
        counts = np.bincount(self.owner, minlength=len(self.starts))
        several = np.flatnonzero(counts > 1)
        if len(several):
            inner = np.flatnonzero(np.isin(self.owner, several))
            tables = self.tables(inner)
            for c in several:
                for b in range(self.first_block[c] + counts[c] - 1, self.first_block[c], -1):
                    costs[b - 1] = _min_plus(tables[b], costs[b])
        for some, width in self.classes(np.arange(len(self.owner))):
            kind, role, n = self.padded(some, width)
            cost, optimal = _programme(kind, role, n, costs[some])
            yield some, width, cost[0], _ranked(kind, role, optimal)

    def entered(self, exits: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """The state in which each block is entered, from the conversations' entries and the blocks' exits."""
        out = entry[self.owner]
        for b in np.flatnonzero(np.diff(self.owner, prepend=-1) == 0):
            out[b] = exits[b - 1, out[b - 1]]
        return out


def _columns(batch) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("kind", "r", "n"))


def _illegal(role: np.ndarray, n: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Illegal neighbours within each conversation of rows that stand ``n`` times (0: the end)."""
    real = n > 0
    inner = np.where(real, (n - 1) * ~_LEGAL[role, role], 0)
    left = np.r_[False, real[1:] & real[:-1] & ~_LEGAL[role[:-1], role[1:]]] if len(role) else inner.astype(bool)
    left[starts] = False
    return np.add.reduceat(inner + left, starts)


class Piece(NamedTuple):
    """What is known of a broken conversation's piece from outside."""

    entry: int
    behind: tuple[int, ...]
    before: int  # the role of the row before it, -1 if there is none


NOTHING = Piece(START, (0, 0, 0, 0), -1)
_BORDER = "part int, head boolean, ended boolean, costs array<long>, first int, last int"
_FOUND = "conv {conv}, part int, seq long, audit string, cost long, illegal long, role string, turn {turn}, digest binary, inserted boolean"


def _ends(batches) -> dict | None:
    """The first and last rows of a partition, up to an END: a dict with the number of the part and lists of arrays."""
    head, tail, ended, part = [], [], False, None
    for b in batches:
        if not b.num_rows:
            continue
        part = b.column(ordered.PART)[0].as_py()
        columns = _columns(b)
        stops = np.flatnonzero(columns[0] == END)
        if not ended:
            head.append(tuple(c[:stops[0] + 1 if len(stops) else None] for c in columns))
        if len(stops):
            tail, ended = [tuple(c[stops[-1] + 1:] for c in columns)], True
        elif ended:
            tail.append(columns)
    if part is None:
        return None
    join = lambda parts: [np.concatenate(x) for x in zip(*parts)]
    return {"part": part, "ended": ended, "head": join(head), "tail": join(tail) if tail and sum(len(t[0]) for t in tail) else None}


def _borders(batches) -> Iterator[tuple]:
    """Of each partition: the table of its first conversation, and of the last one if it goes on."""
    if (found := _ends(batches)) is None:
        return
    for head, columns in ((True, found["head"]), (False, found["tail"])):
        if columns is not None:
            kind, role, n = columns
            real = np.flatnonzero(kind != END)
            table = _Rows(kind, role, n, np.zeros(1, dtype=np.int64)).table()
            edge = (int(role[real[0]]), int(role[real[-1]])) if len(real) else (-1, -1)
            yield found["part"], head, found["ended"], table.reshape(-1).tolist(), *edge


def _chains(borders: list) -> list[list]:
    """Pieces of each broken conversation in order; ``borders`` are ordered by part, the head before the tail."""
    chains, open_ = [], None
    for b in borders:
        if b.head:
            if open_ is not None:
                open_.append(b)
                if b.ended:
                    open_ = None
            elif not b.ended:  # a partition that starts with a conversation and doesn't end it
                open_ = [b]
                chains.append(open_)
        else:
            open_ = [b]
            chains.append(open_)
    return [c for c in chains if len(c) > 1]


def _as_batches(rows, schema: StructType):
    arrow = to_arrow_schema(schema)
    if rows := list(rows):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], arrow.names)


def _broken(laid: DataFrame) -> dict[tuple[int, bool], Piece]:
    """What is known from outside of pieces of conversations that cross borders, by (part, whether it is the head).
    Two rows of each partition at most come to the driver."""
    schema = StructType.fromDDL(_BORDER)
    narrow = laid.select("kind", "r", "n", ordered.PART)
    borders = narrow.mapInArrow(lambda b: _as_batches(_borders(b), schema), schema).collect()
    chains = _chains(sorted(borders, key=lambda b: (b.part, not b.head)))
    behind: dict[tuple[int, bool], tuple] = {}
    for chain in chains:
        costs = np.zeros(4, dtype=np.int64)
        for b in reversed(chain):
            behind[b.part, b.head] = tuple(costs.tolist())
            costs = _min_plus(np.array(b.costs).reshape(4, 4), costs)
    if not chains:
        return {}
    left = StructType.fromDDL("part int, head boolean, exits array<int>")

    def leave(batches):
        if (found := _ends(batches)) is None:
            return
        rows = []
        for head, columns in ((True, found["head"]), (False, found["tail"])):
            if (key := (found["part"], head)) in behind:
                work = _Rows(*columns, np.zeros(1, dtype=np.int64))
                exits = np.empty((len(work.owner), 4), dtype=np.int64)
                for some, _, _, paths in work.solved(np.array([behind[key]])):
                    exits[some] = paths.exits()
                state = np.arange(4)
                for e in exits:
                    state = e[state]
                rows.append((*key, state.tolist()))
        yield from _as_batches(rows, left)

    exits = {(r.part, r.head): r.exits for r in narrow.mapInArrow(leave, left).collect()}
    known = {}
    for chain in chains:
        state, before = START, -1
        for b in chain:
            known[b.part, b.head] = Piece(state, behind[b.part, b.head], before)
            state, before = exits[b.part, b.head][state], b.last if b.last >= 0 else before
    return known


def _solved(batches, known: dict, schema: StructType) -> Iterator[pa.RecordBatch]:
    """Audits, costs and kept rows of the conversations of a partition, some thousand rows at a time."""
    waiting, size, first, seq = [], 0, True, 0
    for b in batches:
        if not b.num_rows:
            continue
        waiting.append(b)
        size += b.num_rows
        if size < ROWS_AT_ONCE:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        stops = np.flatnonzero(table.column("kind").to_numpy() == END)
        if not len(stops):
            continue  # one conversation goes on
        cut = int(stops[-1]) + 1
        out, seq = _edited(table.slice(0, cut), known, first, seq, schema)
        yield from out
        first, waiting = False, table.slice(cut).to_batches()
        size = sum(x.num_rows for x in waiting)
    if size:
        out, seq = _edited(pa.Table.from_batches(waiting).combine_chunks(), known, first, seq, schema)
        yield from out


def _edited(table: pa.Table, known: dict, first: bool, seq: int, schema: StructType):
    kind, role, n = _columns(table)
    part = table.column(ordered.PART)[0].as_py()
    ends = np.flatnonzero(kind == END)
    starts = np.r_[0, ends[ends < len(kind) - 1] + 1]
    pieces = [NOTHING] * len(starts)
    if first:
        pieces[0] = known.get((part, True), NOTHING)
    if kind[-1] != END and (part, False) in known:
        pieces[-1] = known[part, False]
    work = _Rows(kind, role, n, starts)
    entry = np.array([p.entry for p in pieces])
    solved = list(work.solved(np.array([p.behind for p in pieces])))
    exits, costs = np.empty((len(work.owner), 4), dtype=np.int64), np.empty((len(work.owner), 4), dtype=np.int64)
    for some, _, cost, paths in solved:
        exits[some], costs[some] = paths.exits(), cost
    entered = work.entered(exits, entry)
    last_block = np.r_[work.first_block[1:], len(work.owner)] - 1
    left = exits[last_block, entered[last_block]]
    total = costs[work.first_block, entry] - np.array([p.behind[s] for p, s in zip(pieces, left)])

    real = np.where(kind == END, 0, n)
    illegal = _illegal(role, real, starts)
    for i, p in enumerate(pieces):
        if p.before >= 0 and real[starts[i]] and not _LEGAL[p.before, role[starts[i]]]:
            illegal[i] += 1

    edits = []  # block, place in the block's path, row, arc, state after
    for some, width, _, paths in solved:
        nodes, size = paths.read(entered[some])
        state, block, row = nodes % 4, nodes // 4 % len(some), nodes // (4 * len(some))
        arc = paths.arc[nodes]
        at = work.block_start[some[block]] + row
        after = np.where(arc == KEEP, _KEPT[state, role[at]], np.where(arc == DELETE, state, _FILLED[state]))
        order = np.arange(len(nodes)) - np.repeat(np.cumsum(size) - size, size)
        edits.append(np.stack([some[block], order, at, arc, after]))
    block, order, at, arc, after = np.concatenate(edits, axis=1) if edits else np.zeros((5, 0), dtype=np.int64)
    sort = np.lexsort((order, block))
    block, at, arc, after = block[sort], at[sort], arc[sort], after[sort]
    # a deleted row that stands n times is n letters; copies behind a kept row are deleted one by one
    times = np.where(arc == DELETE, n[at], 1)
    letters = np.repeat(LETTERS[arc], times)
    owner = work.owner[block]
    bounds = np.r_[0, np.cumsum(np.bincount(owner, weights=times, minlength=len(starts)).astype(np.int64))]
    text = letters.tobytes().decode()
    conv = table.column("conv").combine_chunks()
    arrow = to_arrow_schema(schema)

    def batch(columns: dict, size: int) -> pa.RecordBatch:
        arrays = [columns.get(f.name, pa.nulls(size, f.type)) for f in arrow]
        arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
        return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow)], arrow.names)

    audits = batch({
        "conv": conv.take(pa.array(starts)), "part": pa.array([part] * len(starts), pa.int32()),
        "seq": pa.array(np.arange(seq, seq + len(starts))),
        "audit": pa.array([text[bounds[i]:bounds[i + 1]] for i in range(len(starts))]),
        "cost": pa.array(total), "illegal": pa.array(illegal)}, len(starts))
    stays = np.flatnonzero(arc != DELETE)
    rows, arc, after = pa.array(at[stays]), arc[stays], after[stays]
    given = pa.array(np.where(after == USER, "user", "assistant"))
    added = pa.array(arc == INSERT)
    own = table.column("role").combine_chunks().take(rows)
    nothing = pa.scalar(None)
    turns = batch({
        "conv": conv.take(rows), "part": pa.array([part] * len(stays), pa.int32()),
        "seq": pa.array(np.arange(seq, seq + len(stays))), "role": pc.if_else(pa.array(arc == KEEP), own, given),
        "turn": table.column("turn").combine_chunks().take(rows),
        "digest": pc.if_else(added, nothing.cast(pa.binary()), table.column("digest").combine_chunks().take(rows)),
        "inserted": added}, len(stays))
    return [audits, turns], seq + max(len(starts), len(stays))


def repair(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> Repaired:
    """The faults and the cheapest repair of every conversation of ``rows``, and of those that ``ids`` (one column) names."""
    common.bounded_batches(rows.sparkSession)
    plain = _normal(rows, conv, turn, role, text)
    ids = plain.select("conv") if ids is None else ids.select(F.col(ids.columns[0]).alias("conv"))
    diagnosed = _diagnosed(plain, ids)
    # a row that stands several times: the first may stay, the others must go
    several = F.when((F.col("kind") < WHOLE) | (F.col("n") == 1), F.array(F.struct(F.col("kind"), F.col("n")))).otherwise(
        F.array(F.struct(F.col("kind"), F.lit(1).cast("long").alias("n")),
                F.struct(F.lit(FORCED).alias("kind"), (F.col("n") - 1).alias("n"))))
    items = diagnosed.select("conv", "end", "turn", "role", "digest", "r", "blank", F.posexplode(several).alias("copy", "_s"))
    items = items.select("conv", "end", "turn", "role", "digest", "copy", "r", "blank", "_s.kind", "_s.n")
    laid = ordered.laid_out(items, ["conv", "end", "turn", "role", "digest", "copy"])

    real, blank, kind = ~F.col("end"), F.col("blank"), F.col("kind")
    faults = laid.groupBy("conv").agg(
        F.coalesce((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("long"), F.lit(0)).alias("gaps"),
        *(F.coalesce(F.sum(F.when(real & c, v)), F.lit(0)).cast("long").alias(name) for name, c, v in (
            ("blank", blank, F.col("n")), ("duplicate", ~blank & (kind == FORCED), F.col("n")),
            ("truncated", kind == TRUNCATED, F.lit(1)))))

    known = _broken(laid)
    ddl = _FOUND.format(conv=laid.schema["conv"].dataType.simpleString(), turn=laid.schema["turn"].dataType.simpleString())
    schema = StructType.fromDDL(ddl)
    found = common.stored(laid.mapInArrow(lambda b: _solved(b, known, schema), schema), "repaired")
    pieces = F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("part", "seq", "audit"))))
    audits = found.where("audit IS NOT NULL").groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"))
    audits = audits.withColumnRenamed("conv", "_conv")
    report = faults.join(audits, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")

    place = F.struct("part", "seq").alias("place")
    inserted = found.where("inserted").select("conv", place, "role", F.lit("").alias("text"), "inserted")
    kept = found.where("NOT inserted")
    # one text of each row that stays: equal rows are put together before they are sent
    texts = plain.groupBy(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("digest").alias("_digest")).agg(
        F.max("text").alias("text"))
    on = (kept["conv"].eqNullSafe(texts["_conv"]) & kept["turn"].eqNullSafe(texts["_turn"]) & (kept["digest"] == texts["_digest"]))
    kept = kept.join(texts, on).select("conv", place, "role", "text", "inserted")
    return Repaired(report, kept.unionByName(inserted))


def digests(repaired: Repaired) -> DataFrame:
    """The report with repaired_sha256: the digest of each repaired conversation's ``role:text`` lines."""
    lines = repaired.turns.select("conv", F.col("place.part").alias("part"), F.col("place.seq").alias("seq"),
                                  F.concat("role", F.lit(":"), "text").alias("line"))
    shas = ordered.sha256_by_group(lines, "conv", ["part", "seq"], "line", "\n").withColumnRenamed("conv", "_conv")
    joined = repaired.report.join(shas, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    none: Column = F.sha2(F.lit(b""), 256)
    return joined.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                         F.coalesce("sha256", none).alias("repaired_sha256"))
