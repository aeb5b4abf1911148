"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read here and rebuilt as a tokenizers pipeline: its normaliser, the metaspace marker, the
piece scores (unigram) or the merges that they imply (BPE), and byte fallback. Batches of texts are encoded on
several threads. ``verify`` encodes texts with both libraries and tells where ids or decoded texts differ.

Defined results: a null text has null ids, an empty text none; special pieces written in a text are ordinary text;
the longest texts are encoded whole, in batches of ``BATCH_CHARS`` characters; ties and repeated rows get equal ids; an
empty table gives an empty result. All columns of the input pass through; a new column that clashes takes the place of
the old one.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quayside.llm import common

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_CHARS = 1 << 20
SPACE = "▁"
#: Words, and ids of words, that a worker remembers; longer words are forgotten after their batch.
CACHE_WORDS, CACHED_IDS, CACHED_CHARS = 400_000, 4_000_000, 64
#: Words of a part, and parts for each thread that are encoded before their ids are kept and the rest is let go.
WORDS_AT_ONCE, PARTS_AT_ONCE = 512, 8
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

# Fixed values of the model file format: kinds of piece and of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protobuf message: varints as numbers, all else as bytes."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[i:i + size]
        i += size


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[tuple[str, float, int], ...]  # text, score, kind
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True

    @property
    def unk_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> PieceModel:
    pieces, spec = [], {}
    for number, value in _fields(data):
        if number == 1:
            f = dict(_fields(value))
            pieces.append((f[1].decode(), struct.unpack("<f", f.get(2, bytes(4)))[0], f.get(3, NORMAL)))
        elif number == 2:
            f = dict(_fields(value))
            spec |= {"model_type": f.get(3, UNIGRAM), "byte_fallback": bool(f.get(35, 0))}
        elif number == 3:
            f = dict(_fields(value))
            spec |= {"charsmap": f.get(2, b""), "dummy_prefix": bool(f.get(3, 1)), "squeeze_spaces": bool(f.get(4, 1))}
            if not f.get(5, 1):
                raise ValueError("a model that leaves white space unescaped has no metaspace marker to rebuild")
    return PieceModel(tuple(pieces), **spec)


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs in the order in which pieces are merged: by the score of what they make, then by its id."""
    usable = {p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    ranked = sorted((i for i, p in enumerate(model.pieces) if p[0] in usable), key=lambda i: (-model.pieces[i][1], i))
    out = []
    for i in ranked:
        piece = model.pieces[i][0]
        out += [(piece[:n], piece[n:]) for n in range(1, len(piece)) if piece[:n] in usable and piece[n:] in usable]
    return out


def build(model: PieceModel):
    """The tokenizers pipeline of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.model_type == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model), fuse_unk=True,
                          byte_fallback=model.byte_fallback, unk_token=model.pieces[model.unk_id][0])
    elif model.model_type == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    steps += [normalizers.Prepend(SPACE)] if model.dummy_prefix else []
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", SPACE)])
    if all(SPACE not in p.lstrip(SPACE) for p, _, _ in model.pieces):
        # no piece goes on after a word into the next space, so words can be encoded apart, and are then remembered
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


class Words(dict):
    """Numbers of words; a word that was not there gets the next one and is listed as new."""

    def __init__(self):
        self.n, self.new = 0, []

    def __missing__(self, word: str) -> int:
        number = self[word] = self.n
        self.n += 1
        self.new.append(word)
        return number


class Codec:
    """Encodes and decodes batches; built once in each worker from the model's bytes."""

    def __init__(self, data: bytes, threads: int = 1):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.data, self.model, self.threads, self._reference = data, parse_model(data), threads, None
        self.tokenizer = build(self.model)
        self.normalizer = self.tokenizer.normalizer
        # words apart: each distinct word is encoded once and remembered, which the pipeline does for few words only
        self.words = None
        if self.tokenizer.pre_tokenizer is not None:
            self.words = self.tokenizer
            self.words.normalizer = self.words.pre_tokenizer = None
        self.plain = not (self.model.charsmap or self.model.squeeze_spaces)
        self.forget()
        self.piece_bytes = [bytes([int(p[3:-1], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode()
                            for p, _, kind in self.model.pieces]
        self.bytes_from = {i for i, p in enumerate(self.model.pieces) if p[2] == BYTE}

    def forget(self) -> None:
        """Let go of the remembered words."""
        self.known = Words()
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)  # of all known words, by number

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
        if self.words is None:
            found = iter(self.tokenizer.encode_batch_fast([t for t in batch if t], add_special_tokens=False))
            for text in batch:
                yield None if text is None else np.array(next(found).ids if text else [], dtype=np.int32)
            return
        if len(self.known) > CACHE_WORDS or len(self.ids) > CACHED_IDS:
            self.forget()
        numbers = [None if t is None else self._numbers(t) for t in batch]
        new, self.known.new = self.known.new, []
        self._learn(new)
        starts = np.cumsum(self.lengths) - self.lengths
        for words in numbers:
            if words is None or not len(words):
                yield None if words is None else np.zeros(0, np.int32)
                continue
            lengths = self.lengths[words]
            ends = np.cumsum(lengths)
            yield self.ids[np.arange(ends[-1]) + np.repeat(starts[words] - ends + lengths, lengths)]
        for w in new:
            if len(w) > CACHED_CHARS:
                del self.known[w]

    def _numbers(self, text: str) -> np.ndarray:
        words = _WORDS.findall(self._normal(text)) if text else []
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _learn(self, new: list[str]) -> None:
        parts = [new[i:i + WORDS_AT_ONCE] for i in range(0, len(new), WORDS_AT_ONCE)]
        ids, lengths = [self.ids], [self.lengths]
        step = PARTS_AT_ONCE * self.threads
        for some in (parts[i:i + step] for i in range(0, len(parts), step)):
            for part, e in zip(some, self.words.encode_batch(some, is_pretokenized=True, add_special_tokens=False)):
                ids.append(np.array(e.ids, dtype=np.int32))
                lengths.append(np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(part)))
        self.ids, self.lengths = np.concatenate(ids), np.concatenate(lengths)

    def _normal(self, text: str) -> str:
        if not self.plain:
            return self.normalizer.normalize_str(text)
        return (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)

    def decode(self, ids: list[Sequence[int] | None]) -> list[str | None]:
        """The texts of lists of ids: the bytes of the pieces, which is what the pipeline's decoder gives, in less time."""
        skip = 1 if self.model.dummy_prefix else 0
        out = []
        for one in ids:
            text = None if one is None else b"".join(map(self.piece_bytes.__getitem__, one.tolist() if isinstance(one, np.ndarray) else one)).decode("utf-8", "replace")
            out.append(text[skip:] if text and text[:skip] == " " else text)
        return out

    def reference_ids(self, texts: list[str]) -> list[list[int]]:
        """What the sentencepiece library gives for the same model."""
        if self._reference is None:
            import sentencepiece

            self._reference = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        return self._reference.encode(texts, num_threads=1)


@lru_cache(1)
def codec(data: bytes, threads: int) -> Codec:
    """The codec of a model, kept for the next tasks of the same worker."""
    return Codec(data, threads)


def load(spark, path: str = MODEL_PATH) -> bytes:
    """The model file's bytes, from a local path on the driver or any path that Spark can read."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _threads(spark) -> int:
    return max(1, int(spark.conf.get("spark.task.cpus", "1")))


def _mapped(docs: DataFrame, new: list[StructField], kinds: list[pa.DataType], make) -> DataFrame:
    """``docs`` with new columns that ``make(codec, columns by name)`` gives for each Arrow batch."""
    kept = [f for f in docs.schema.fields if f.name not in {n.name for n in new}]
    schema = StructType([*kept, *new])
    positions = [docs.columns.index(f.name) for f in kept]

    @common.handing_back
    def run(batches):
        for b in batches:
            columns = make(codec(make.data, make.threads), dict(zip(b.schema.names, b.columns)))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in positions], *arrays], [f.name for f in schema.fields])
        codec(make.data, make.threads).forget()

    return docs.mapInArrow(run, schema)


class _Maker:
    def __init__(self, spark, path: str, f):
        self.data, self.threads, self.f = load(spark, path), _threads(spark), f

    def __call__(self, codec: Codec, columns: dict[str, pa.Array]):
        return self.f(codec, columns)


def encode(docs: DataFrame, model_path: str = MODEL_PATH, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every text."""
    common.bounded_batches(docs.sparkSession)
    make = _Maker(docs.sparkSession, model_path, lambda c, cols: [list(c.encode(cols[text].to_pylist()))])
    return _mapped(docs, [StructField(ids, ArrayType(IntegerType()))], [pa.list_(pa.int32())], make)


def decode(encoded: DataFrame, model_path: str = MODEL_PATH, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of every list of ids."""
    from pyspark.sql.types import StringType

    make = _Maker(encoded.sparkSession, model_path, lambda c, cols: [c.decode(cols[ids].to_pylist())])
    return _mapped(encoded, [StructField(text, StringType())], [pa.string()], make)


def verify(docs: DataFrame, model_path: str = MODEL_PATH, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_byte_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers), round_trip (the
    decoded ids are the text) and parity (the sentencepiece library gives the same ids). All are null for a null text."""
    common.bounded_batches(docs.sparkSession)

    def both(codec: Codec, columns):
        texts = columns[text].to_pylist()
        out = [[None] * len(texts) for _ in range(5)]
        start = 0
        while start < len(texts):  # slices of bounded size, so that few ids are held at once
            stop, size = start, 0
            while stop < len(texts) and (size < BATCH_CHARS or stop == start):
                size += len(texts[stop] or "")
                stop += 1
            part = texts[start:stop]
            ids = list(codec.encode(part))
            back = codec.decode(ids)
            known = [t for t in part if t is not None]
            reference = iter(codec.reference_ids(known))
            for i, (t, mine, decoded) in enumerate(zip(part, ids, back), start):
                if t is None:
                    continue
                numbers = mine.astype("<i4", copy=False)
                lowest, highest = min(codec.bytes_from, default=0), max(codec.bytes_from, default=-1)
                values = (len(mine), int(((numbers >= lowest) & (numbers <= highest)).sum()),
                          hashlib.sha256(numbers.tobytes()).hexdigest(), decoded == t, next(reference) == mine.tolist())
                for column, v in zip(out, values):
                    column[i] = v
            start = stop
        return out

    new = StructType.fromDDL("n_tokens bigint, n_byte_tokens bigint, ids_sha256 string, round_trip boolean, parity boolean")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    return _mapped(docs, list(new.fields), kinds, _Maker(docs.sparkSession, model_path, both))
