"""Byte-level BPE encoding and decoding on the tokenizers library.

A file of ranks is rebuilt as a tokenizers pipeline: the splitting pattern, the mapping of bytes to characters, and
every pair of tokens that makes a third, in the order of what they make. Arrow batches of texts are encoded by chunks:
a chunk is a run of white space with the word behind it, where a match of the pattern always ends, so distinct chunks
are encoded once. Where one token occurs twice in a chunk and can be made in two ways, the library may merge the right
one first, which rank files forbid; such chunks are compared with the tiktoken library and take its ids.

Decoding reverses the byte table. A character may be split over tokens: offsets of such a token cover the whole
character, ``decode`` puts the bytes together before it reads them as UTF-8, and ``pieces`` shows a character with the
token that completes it.

Defined results: a null text is an empty text, without ids (``encode`` keeps null ids for it); names of special tokens
are ordinary text; the longest texts are encoded whole, as batches are cut at ``BATCH_CHARS`` characters; ties and
repeated rows get equal ids; an empty table gives an empty result; bytes that are no UTF-8 decode to U+FFFD. All columns
of the input pass through; a new column that clashes takes the place of the old one.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from quayside.llm import common

RANKS = "byte_bpe_multi_50k.tiktoken"
BATCH_CHARS = 1 << 20
#: Chunks, and ids of chunks, that a worker remembers; longer chunks are forgotten after their batch.
CACHE_CHUNKS, CACHED_IDS, CACHED_CHARS = 400_000, 4_000_000, 64
CHUNKS_AT_ONCE = 512

# Fixed values of Unicode: the characters with the property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
_CHUNKS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load(spark, path: str | None = None) -> bytes:
    """The rank file's bytes, from a local path on the driver or any path that Spark can read."""
    path = path or ranks_path()
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def byte_characters() -> dict[int, str]:
    """One visible character for each byte: printable Latin-1 ones stand for themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def build(ranks: dict[bytes, int], pattern: str):
    """The tokenizers pipeline of a rank table, and the tokens that can be made in more than one way."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    characters = byte_characters()
    shown = {token: token.decode("latin-1").translate(characters) for token in ranks}
    merges, several = [], set()
    for token in sorted(ranks, key=ranks.get):
        cuts = [n for n in range(1, len(token)) if token[:n] in ranks and token[n:] in ranks]
        merges += [(shown[token[:n]], shown[token[n:]]) for n in cuts]
        if len(cuts) > 1:
            several.add(token)
    tokenizer = Tokenizer(models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer, several


class Numbers(dict):
    """Numbers of chunks; a chunk that was not there gets the next one and is listed as new."""

    def __init__(self):
        self.n, self.new = 0, []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = self.n
        self.n += 1
        self.new.append(chunk)
        return number


def _gather(values: np.ndarray, lengths: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The slices of ``values`` that belong to ``rows``, one after another."""
    size = lengths[rows]
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(starts[rows] - ends + size, size)]


class Codec:
    """Encodes and decodes batches; built once in each worker from the rank file's bytes."""

    def __init__(self, data: bytes, pattern: str, threads: int = 1):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.ranks, self.pattern, self._reference = parse_ranks(data), pattern, None
        self.tokenizer, several = build(self.ranks, pattern)
        self.several = {n: frozenset(t for t in several if len(t) == n) for n in {len(t) for t in several}}
        # decoding: the byte table reversed, as one array of bytes with the place of every id in it
        byte_of = {c: b for b, c in byte_characters().items()}
        tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for shown, i in self.tokenizer.get_vocab().items():
            tokens[i] = bytes(map(byte_of.__getitem__, shown))
        self.token_lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)  # of all known chunks, by number

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """Ids of each text in order; a batch is closed when it has ``BATCH_CHARS`` characters."""
        batch: list[str | None] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield from self._encode(batch)
                batch, size = [], 0
        yield from self._encode(batch)

    def _encode(self, batch: list[str | None]) -> Iterator[np.ndarray | None]:
        if len(self.known) > CACHE_CHUNKS or len(self.ids) > CACHED_IDS:
            self._forget()
        rows = []
        for text in batch:
            chunks = _CHUNKS.findall(text or "")
            rows.append(None if text is None else np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks)))
        new, self.known.new = self.known.new, []
        self._learn(new)
        starts = np.cumsum(self.lengths) - self.lengths
        for chunks in rows:
            yield None if chunks is None else _gather(self.ids, self.lengths, starts, chunks)
        for chunk in new:
            if len(chunk) > CACHED_CHARS:
                del self.known[chunk]

    def _learn(self, new: list[str]) -> None:
        ids, lengths = [self.ids], [self.lengths]
        parts = [new[i:i + CHUNKS_AT_ONCE] for i in range(0, len(new), CHUNKS_AT_ONCE)]
        for part, e in zip(parts, self.tokenizer.encode_batch(parts, is_pretokenized=True, add_special_tokens=False)):
            found = np.array(e.ids, dtype=np.uint32)
            size = np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(part))
            if checked := [i for i, chunk in enumerate(part) if self._repeats(chunk)]:
                each = np.split(found, np.cumsum(size)[:-1])
                for i in checked:
                    each[i] = np.array(self._exact(part[i]), dtype=np.uint32)
                found, size = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
            ids.append(found)
            lengths.append(size)
        self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)

    def _repeats(self, chunk: str) -> bool:
        """Whether a token that can be made in several ways occurs twice in a chunk, so that their order counts."""
        data = chunk.encode()
        if len(data) < 4 or len({data[i:i + 3] for i in range(len(data) - 2)}) == len(data) - 2:
            return False  # such a token has three bytes at least
        for n, tokens in self.several.items():
            seen = set()
            for i in range(len(data) - n + 1):
                if (part := data[i:i + n]) in tokens:
                    if part in seen:
                        return True
                    seen.add(part)
        return False

    def _exact(self, chunk: str) -> list[int]:
        if self._reference is None:
            import tiktoken

            self._reference = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return self._reference.encode_ordinary(chunk)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return _gather(self.token_bytes, self.token_lengths, self.token_starts, ids.astype(np.int64)).tobytes()

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one after the last, that each token has a byte of; ``data`` are the tokens' bytes."""
        character = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.token_lengths[ids.astype(np.int64)])
        starts = ends - self.token_lengths[ids.astype(np.int64)]
        return character[starts], character[ends - 1] + 1

    def pieces(self, ids: np.ndarray) -> list[str]:
        """The text that each token adds: a split character comes with the token that completes it."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        last = len(ids) - 1
        return [reader.decode(self.decode_bytes(ids[i:i + 1]), i == last) for i in range(len(ids))]


@lru_cache(1)
def codec(data: bytes, pattern: str, threads: int) -> Codec:
    """The codec of a rank table, kept for the next tasks of the same worker."""
    return Codec(data, pattern, threads)


def _mapped(docs: DataFrame, ddl: str, path: str | None, threads: int, source: str, f) -> DataFrame:
    """``docs`` with new columns that ``f(codec, values of the source column)`` gives for each Arrow batch."""
    common.bounded_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    new = StructType.fromDDL(ddl)
    kinds = to_arrow_schema(new).types
    kept = [x for x in docs.schema.fields if x.name not in new.names]
    schema = StructType([*kept, *(StructField(x.name, x.dataType) for x in new.fields)])
    positions, at = [docs.columns.index(x.name) for x in kept], docs.columns.index(source)
    data, pattern = load(docs.sparkSession, path), split_pattern()

    def run(batches):
        for b in batches:
            columns = f(codec(data, pattern, threads), b.column(at))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in positions], *arrays], [x.name for x in schema.fields])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str | None = None, text: str = "text", threads: int = 1) -> DataFrame:
    """``docs`` with ids and the character offsets ``starts`` and ``ends`` of every token of every text."""

    def found(c: Codec, values):
        rows = []
        for ids in c.encode(values.to_pylist()):
            rows.append((None,) * 3 if ids is None else (ids, *c.offsets(ids, c.decode_bytes(ids))))
        return list(zip(*rows)) or [[], [], []]

    return _mapped(docs, "ids array<int>, starts array<int>, ends array<int>", ranks, threads, text, found)


def decode(encoded: DataFrame, ranks: str | None = None, ids: str = "ids") -> DataFrame:
    """``encoded`` with the decoded bytes of every list of ids, their text, and the text that each token adds."""

    def one(c: Codec, numbers) -> tuple:
        if numbers is None:
            return None, None, None
        numbers = np.array(numbers, dtype=np.uint32)
        data = c.decode_bytes(numbers)
        return data, data.decode("utf-8", "replace"), c.pieces(numbers)

    def found(c: Codec, values):
        return list(zip(*(one(c, numbers) for numbers in values.to_pylist()))) or [[], [], []]

    return _mapped(encoded, "decoded binary, decoded_text string, pieces array<string>", ranks, 1, ids, found)


def verify(docs: DataFrame, ranks: str | None = None, text: str = "text", threads: int = 1) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit numbers), decoded_sha256 (of the
    bytes that the ids decode to), n_split (tokens that begin or end inside a character) and round_trip (the decoded
    bytes are the text)."""

    def found(c: Codec, values):
        out = ([], [], [], [], [])
        texts = [t or "" for t in values.to_pylist()]
        for t, ids in zip(texts, c.encode(texts)):
            data = c.decode_bytes(ids)
            size = c.token_lengths[ids.astype(np.int64)]
            ends = np.cumsum(size)
            inside = np.append((np.frombuffer(data, dtype=np.uint8) & 0xC0) == 0x80, False)
            row = (len(ids), hashlib.sha256(ids.astype("<u4", copy=False).tobytes()).hexdigest(),
                   hashlib.sha256(data).hexdigest(), int((inside[ends] | inside[ends - size]).sum()), data == t.encode())
            for column, value in zip(out, row):
                column.append(value)
        return out

    return _mapped(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split bigint, round_trip boolean",
                   ranks, threads, text, found)
