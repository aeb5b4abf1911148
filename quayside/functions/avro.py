"""Avro binary encoding (schemaless, writer schema only) as Arrow column functions.

No Avro library and no spark-avro jar are needed. Decoding is vectorised across
the records of an Arrow batch: the loop runs over the *fields* of the schema (and
over at most ten varint bytes), each step is a numpy operation over every record
still being decoded, and the result is an Arrow struct handed straight back to
Spark by an ``arrow_udf`` (no JSON detour, no per-row Python).

Error semantics follow a permissive reader:
  * an undecodable record (null/empty body, truncated data, bad union branch,
    varint over ten bytes, negative length, invalid UTF-8) becomes a null struct,
    i.e. an all-null row after ``select("decoded.*")``; nothing is dropped;
  * an ``int`` value outside 32 bits makes only that field null;
  * bytes after the record are ignored.
"""

from __future__ import annotations

import json as _json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.schemas import AvroField, avro_to_struct, parse_avro_record

ERROR_FIELD = "_decode_error"
_PAD = 16
_I32_MIN, _I32_MAX = -(2**31), 2**31 - 1
_US_PER = {"timestamp-seconds": 1_000_000, "timestamp-millis": 1_000, "timestamp-micros": 1}
_MAX_TS_US = 253402300799 * 1_000_000  # 9999-12-31T23:59:59


def _arrow_type(field: AvroField) -> pa.DataType:
    if field.logical in _US_PER and field.kind == "long":
        return pa.timestamp("us", tz="UTC")
    if field.logical == "date" and field.kind == "int":
        return pa.date32()
    return {
        "boolean": pa.bool_(),
        "int": pa.int32(),
        "long": pa.int64(),
        "float": pa.float32(),
        "double": pa.float64(),
        "string": pa.string(),
        "bytes": pa.binary(),
    }[field.kind]


def _offsets(arr: pa.Array) -> np.ndarray:
    """Value offsets of a (large) binary/string array as int64, honouring a slice offset."""
    large = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    raw = np.frombuffer(arr.buffers()[1], dtype=np.int64 if large else np.int32)
    return raw[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


# ---------------------------------------------------------------------------
# decoding
# ---------------------------------------------------------------------------
class _Cursor:
    """Read positions of every record of one Arrow batch."""

    def __init__(self, bodies: pa.Array):
        if pa.types.is_large_binary(bodies.type) or pa.types.is_large_string(bodies.type):
            bodies = bodies.cast(pa.large_binary())
        else:
            bodies = bodies.cast(pa.binary())
        self.n = len(bodies)
        offsets = _offsets(bodies)
        buf = bodies.buffers()[2]
        data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
        self.data = np.concatenate([data, np.zeros(_PAD, np.uint8)])
        self.pos = offsets[:-1].copy()
        self.end = offsets[1:].copy()
        valid = ~np.asarray(bodies.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        self.ok = valid & (self.end > self.pos)  # empty body cannot hold a record
        self.error = np.full(self.n, None, dtype=object)
        self.error[~valid] = "null body"
        self.error[valid & ~self.ok] = "empty body"

    def fail(self, rows: np.ndarray, message: str) -> None:
        rows = rows[self.ok[rows]]
        self.ok[rows] = False
        self.error[rows] = message

    def varint(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Zig-zag varints at the cursor of ``rows``; returns (values, bad)."""
        p = self.pos[rows]
        last = len(self.data) - 1
        b = self.data[np.minimum(p, last)]
        res = (b & np.uint8(0x7F)).astype(np.uint64)
        used = np.ones(len(rows), np.int64)
        more = np.nonzero(b >= 0x80)[0]  # most values are one byte: only the others go on
        for k in range(1, 10):
            if not len(more):
                break
            b = self.data[np.minimum(p[more] + k, last)]
            res[more] |= (b & np.uint8(0x7F)).astype(np.uint64) << np.uint64(7 * k)
            used[more] += 1
            more = more[b >= 0x80]
        self.pos[rows] = p + used
        value = (res >> np.uint64(1)).astype(np.int64) ^ -((res & np.uint64(1)).astype(np.int64))
        bad = np.zeros(len(rows), bool)
        bad[more] = True
        return value, bad

    def check_bounds(self, rows: np.ndarray, field: str) -> None:
        over = rows[self.pos[rows] > self.end[rows]]
        if len(over):
            self.fail(over, f"truncated record at field {field}")


def _gather_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    total = int(offsets[-1])
    if total == 0:
        return offsets, np.zeros(0, np.uint8)
    idx = np.repeat(starts - offsets[:-1], lengths) + np.arange(total, dtype=np.int64)
    return offsets, data[idx]


def _decode_field(cur: _Cursor, field: AvroField) -> tuple[np.ndarray, object]:
    """Decode one field for every live record; returns (rows with a value, values)."""
    rows = np.nonzero(cur.ok)[0]
    if len(field.branches) > 1:
        branch, bad = cur.varint(rows)
        bad |= (branch < 0) | (branch >= len(field.branches))
        if bad.any():
            cur.fail(rows[bad], f"invalid union branch for field {field.name}")
        keep = ~bad & (branch == field.value_branch)
        cur.check_bounds(rows, field.name)
        rows = rows[keep & cur.ok[rows]]
    kind = field.kind
    if kind in ("int", "long"):
        vals, bad = cur.varint(rows)
        if bad.any():
            cur.fail(rows[bad], f"varint too long in field {field.name}")
        values = vals
    elif kind in ("float", "double", "boolean"):
        width = {"float": 4, "double": 8, "boolean": 1}[kind]
        p = cur.pos[rows]
        raw = cur.data[np.minimum(p[:, None] + np.arange(width), len(cur.data) - 1)]
        cur.pos[rows] = p + width
        if kind == "boolean":
            values = raw[:, 0] != 0
        else:
            values = np.ascontiguousarray(raw).view("<f4" if width == 4 else "<f8").reshape(-1)
    else:  # string / bytes
        length, bad = cur.varint(rows)
        bad |= length < 0
        if bad.any():
            cur.fail(rows[bad], f"bad length in field {field.name}")
        length = np.where(bad, 0, length)
        starts = cur.pos[rows]
        cur.pos[rows] = starts + length
        values = (starts, length)
    cur.check_bounds(rows, field.name)
    live = cur.ok[rows]
    if isinstance(values, tuple):
        values = (values[0][live], values[1][live])
    else:
        values = values[live]
    return rows[live], values


def _build_column(cur: _Cursor, field: AvroField, rows: np.ndarray, values) -> pa.Array:
    n = cur.n
    atype = _arrow_type(field)
    if not len(rows):
        return pa.nulls(n, atype)
    valid = np.zeros(n, bool)
    valid[rows] = True
    if field.kind in ("string", "bytes"):
        starts, lengths = values
        full_len = np.zeros(n, np.int64)
        full_start = np.zeros(n, np.int64)
        full_len[rows] = lengths
        full_start[rows] = starts
        offsets, payload = _gather_bytes(cur.data, full_start, full_len)
        binary = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(payload)]
        )
        binary = pa.compute.if_else(pa.array(valid), binary, pa.nulls(n, pa.large_binary()))
        if field.kind == "bytes":
            return binary.cast(pa.binary())
        try:
            return binary.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            bad = [i for i in rows.tolist() if not _valid_utf8(binary[i].as_py())]
            cur.fail(np.asarray(bad, np.int64), f"invalid UTF-8 in field {field.name}")
            keep = valid.copy()
            keep[bad] = False
            binary = pa.compute.if_else(pa.array(keep), binary, pa.nulls(n, pa.large_binary()))
            return binary.cast(pa.large_string()).cast(pa.string())
    if field.kind == "int":
        vals = np.zeros(n, np.int64)
        vals[rows] = values
        valid &= (vals >= _I32_MIN) & (vals <= _I32_MAX)  # overflow: that field null
        if field.logical == "date":
            return pa.array(vals.astype(np.int32), pa.date32(), mask=~valid)
        return pa.array(vals.astype(np.int32), pa.int32(), mask=~valid)
    if field.kind == "long":
        vals = np.zeros(n, np.int64)
        vals[rows] = values
        if field.logical in _US_PER:
            scale = _US_PER[field.logical]
            valid &= np.abs(vals) <= _MAX_TS_US // scale
            return pa.array(np.where(valid, vals, 0) * scale, pa.timestamp("us", tz="UTC"), mask=~valid)
        return pa.array(vals, pa.int64(), mask=~valid)
    np_type = {"float": np.float32, "double": np.float64, "boolean": bool}[field.kind]
    vals = np.zeros(n, np_type)
    vals[rows] = values
    return pa.array(vals, atype, mask=~valid)


def _valid_utf8(b: bytes | None) -> bool:
    try:
        (b or b"").decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


def decode_batch(bodies: pa.Array, fields: tuple[AvroField, ...], with_error: bool = False) -> pa.StructArray:
    """Decode one Arrow batch of Avro bodies into a struct array (null where undecodable)."""
    cur = _Cursor(bodies)
    decoded = [_decode_field(cur, f) for f in fields]
    columns = [_build_column(cur, f, rows, vals) for f, (rows, vals) in zip(fields, decoded)]
    ok = cur.ok
    if not ok.all():
        kept = pa.array(ok)
        columns = [c if c.null_count == cur.n else pa.compute.if_else(kept, c, pa.nulls(cur.n, c.type)) for c in columns]
    names = [f.name for f in fields]
    if with_error:
        columns.append(pa.array(np.where(ok, None, cur.error), pa.string()))
        names.append(ERROR_FIELD)
        return pa.StructArray.from_arrays(columns, names=names)
    return pa.StructArray.from_arrays(columns, names=names, mask=pa.array(~ok))


def decoded_struct_type(avro_text: str, with_error: bool = False) -> T.StructType:
    st = avro_to_struct(avro_text)
    if with_error:
        st = T.StructType(list(st.fields) + [T.StructField(ERROR_FIELD, T.StringType(), True)])
    return st


def avro_decoder(avro_text: str, with_error: bool = False):
    """An Arrow UDF ``body -> struct`` for one writer schema (the schema text is captured once)."""
    fields = parse_avro_record(avro_text)
    out_type = decoded_struct_type(avro_text, with_error)

    @F.arrow_udf(out_type)
    def decode(bodies: pa.Array) -> pa.Array:
        return decode_batch(bodies, fields, with_error)

    return decode


def decode_avro(body: Column, avro_text: str, with_error: bool = False) -> Column:
    """Column expression: Avro body -> decoded struct."""
    return avro_decoder(avro_text, with_error)(body)


# ---------------------------------------------------------------------------
# decoding with a schema id per message (registry lookup)
# ---------------------------------------------------------------------------
_PROMOTIONS = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"),
               ("float", "double")}


def _incompatible(writer: tuple[AvroField, ...], reader: tuple[AvroField, ...]) -> str | None:
    """Why records of one schema cannot be read as the other; None if they can."""
    by_name = {f.name: f for f in writer}
    for rf in reader:
        wf = by_name.get(rf.name)
        if wf is not None and wf.kind != rf.kind and (wf.kind, rf.kind) not in _PROMOTIONS:
            return f"field {rf.name}: writer type {wf.kind} cannot be read as {rf.kind}"
    return None


def _project(struct: pa.StructArray, writer: tuple[AvroField, ...], reader: tuple[AvroField, ...]) -> list[pa.Array]:
    """Columns of the reader's record from the writer's, by field name; absent fields null, numeric promotion allowed."""
    by_name = {f.name: f for f in writer}
    return [struct.field(rf.name).cast(_arrow_type(rf)) if rf.name in by_name else pa.nulls(len(struct), _arrow_type(rf))
            for rf in reader]


def avro_decoder_by_id(writers: dict[str, str], reader_text: str, with_error: bool = False):
    """An Arrow UDF ``(schema_id, body) -> struct`` decoding each message with its own writer schema.

    ``writers`` maps schema id -> Avro text (a registry slice, bounded by the number
    of registered versions). A message with an unknown id (no auto-registration), one whose
    schema cannot be read as the reader's, or a bad body decodes to null, and the others
    go on; with ``with_error`` the record's fields are null and a field says why.
    """
    reader = parse_avro_record(reader_text)
    parsed = {sid: parse_avro_record(text) for sid, text in writers.items()}
    unreadable = {sid: why for sid, fields in parsed.items() if (why := _incompatible(fields, reader))}
    out_type = decoded_struct_type(reader_text, with_error)
    names = [f.name for f in reader]

    def one(sid, bodies: pa.Array) -> tuple[list[pa.Array], pa.Array]:
        """Columns of the messages of one schema, and why a message has none."""
        why = unreadable.get(sid) or (None if sid in parsed else "no schema id" if sid is None else f"unknown schema id {sid}")
        if why:
            return [pa.nulls(len(bodies), _arrow_type(f)) for f in reader], pa.array([why] * len(bodies), pa.string())
        decoded = decode_batch(bodies, parsed[sid], True)
        return _project(decoded, parsed[sid], reader), decoded.field(ERROR_FIELD)

    @F.arrow_udf(out_type)
    def decode(schema_ids: pa.Array, bodies: pa.Array) -> pa.Array:
        n = len(bodies)
        ids = np.asarray(schema_ids.to_numpy(zero_copy_only=False), dtype=object)
        parts, positions = [], []
        for sid in pd_unique(ids):
            rows = np.nonzero(ids == sid)[0] if sid is not None else np.nonzero([x is None for x in ids])[0]
            columns, why = one(sid, bodies.take(pa.array(rows)))
            if with_error:
                parts.append(pa.StructArray.from_arrays([*columns, why], names=[*names, ERROR_FIELD]))
            else:
                parts.append(pa.StructArray.from_arrays(columns, names=names, mask=why.is_valid()))
            positions.append(rows)
        if not parts:
            kinds = [pa.field(f.name, _arrow_type(f)) for f in reader]
            return pa.nulls(0, pa.struct([*kinds, pa.field(ERROR_FIELD, pa.string())] if with_error else kinds))
        merged = pa.concat_arrays(parts)
        order = np.empty(n, np.int64)
        order[np.concatenate(positions)] = np.arange(n)
        return merged.take(pa.array(order))

    return decode


def pd_unique(values: np.ndarray) -> list:
    seen: dict = {}
    for v in values.tolist():
        seen.setdefault(v, None)
    return list(seen)


# ---------------------------------------------------------------------------
# encoding (used to produce event messages from tables, as a Spark job)
# ---------------------------------------------------------------------------
def _zigzag_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = values.astype(np.int64)
    z = ((v << 1) ^ (v >> 63)).view(np.uint64)
    nbytes = np.ones(len(z), np.int64)
    width = max(1, -(-int(z.max(initial=0)).bit_length() // 7))  # bytes of the largest value, ten at most
    groups = np.empty((len(z), width), np.uint8)
    for k in range(width):
        rest = z >> np.uint64(7)
        more = rest != 0
        groups[:, k] = (z & np.uint64(0x7F)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        nbytes += more
        z = rest
    return groups, nbytes


def _field_parts(field: AvroField, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Byte blocks of one field for every row: list of (matrix or (offsets, data), lengths)."""
    n = len(column)
    present = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    parts = []
    if len(field.branches) > 1:
        branch = np.where(present, field.value_branch, field.null_branch)
        parts.append(_zigzag_varints(branch))
    elif not present.all():
        raise ValueError(f"null value for non-nullable field {field.name}")
    if not present.any():
        return parts
    kind = field.kind
    if kind in ("int", "long"):
        if field.logical in _US_PER:
            us = column.cast(pa.timestamp("us", tz="UTC")).cast(pa.int64()).fill_null(0)
            vals = np.floor_divide(us.to_numpy(), _US_PER[field.logical])
        elif field.logical == "date":
            vals = column.cast(pa.int32()).fill_null(0).to_numpy().astype(np.int64)
        else:
            vals = column.cast(pa.int64()).fill_null(0).to_numpy()
        mat, lens = _zigzag_varints(vals)
        parts.append((mat, np.where(present, lens, 0)))
    elif kind in ("float", "double"):
        dtype = "<f4" if kind == "float" else "<f8"
        vals = column.cast(pa.float32() if kind == "float" else pa.float64()).fill_null(0).to_numpy()
        mat = np.ascontiguousarray(vals.astype(dtype)).view(np.uint8).reshape(n, 4 if kind == "float" else 8)
        parts.append((mat, np.where(present, mat.shape[1], 0)))
    elif kind == "boolean":
        vals = column.fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)
        parts.append((vals.reshape(n, 1), present.astype(np.int64)))
    else:
        binary = column.cast(pa.large_binary()) if kind == "bytes" else column.cast(pa.large_string())
        binary = binary.fill_null(b"" if kind == "bytes" else "")
        offsets = _offsets(binary)
        buf = binary.buffers()[2]
        data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
        lengths = np.diff(offsets)
        mat, lens = _zigzag_varints(lengths)
        parts.append((mat, np.where(present, lens, 0)))
        parts.append(((offsets, data), np.where(present, lengths, 0)))
    return parts


def encode_batch(record: pa.StructArray, fields: tuple[AvroField, ...]) -> pa.BinaryArray:
    """Encode a struct array (fields by name) into Avro bodies; a null record gives a null body,
    and a nullable field that the struct lacks is written as null."""
    n = len(record)
    given = {f.name for f in record.type}
    parts = []
    for f in fields:
        parts.extend(_field_parts(f, record.field(f.name) if f.name in given else pa.nulls(n, _arrow_type(f))))
    total = np.zeros(n, np.int64)
    for _, lens in parts:
        total += lens
    record_valid = np.asarray(record.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    every = bool(record_valid.all())
    total = np.where(record_valid, total, 0)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(total, out=offsets[1:])
    out = np.zeros(int(offsets[-1]), np.uint8)
    cursor = offsets[:-1].copy()
    for block, lens in parts:
        if not every:
            lens = np.where(record_valid, lens, 0)
        if isinstance(block, tuple):  # variable payload: copy byte ranges
            src_off, src = block
            starts = src_off[:-1]
            cum = np.zeros(n + 1, np.int64)
            np.cumsum(lens, out=cum[1:])
            tot = int(cum[-1])
            if tot:
                src_idx = np.repeat(starts - cum[:-1], lens) + np.arange(tot)
                dst_idx = np.repeat(cursor - cum[:-1], lens) + np.arange(tot)
                out[dst_idx] = src[src_idx]
        else:
            width = block.shape[1]
            if n and lens.min() == width:  # as wide in every record: no mask
                for k in range(width):
                    out[cursor + k] = block[:, k]
                cursor += width
                continue
            mask = np.arange(width)[None, :] < lens[:, None]
            dst = cursor[:, None] + np.arange(width)[None, :]
            out[dst[mask]] = block[mask]
        cursor += lens
    validity = None if every else pa.array(record_valid, pa.bool_()).buffers()[1]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [validity, pa.py_buffer(offsets), pa.py_buffer(out)]
    ).cast(pa.binary())


def avro_encoder(avro_text: str):
    """An Arrow UDF ``struct -> binary`` writing schemaless Avro for one schema."""
    fields = parse_avro_record(avro_text)

    @F.arrow_udf(T.BinaryType())
    def encode(records: pa.Array) -> pa.Array:
        return encode_batch(records, fields)

    return encode


def encode_avro(record: Column, avro_text: str) -> Column:
    """Column expression: struct (fields named as in the schema, nullable ones may be left out) -> Avro body."""
    return avro_encoder(avro_text)(record)


def schema_fingerprint(avro_text: str) -> str:
    """A stable id for a schema text (canonical JSON, 64-bit hash in hex)."""
    import hashlib

    canonical = _json.dumps(_json.loads(avro_text), sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canonical.encode()).hexdigest()[:16]
