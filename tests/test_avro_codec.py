"""Avro codec on hand-written bytes and random records (no Spark needed)."""

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import avro
from quayside.functions.schemas import (
    SALES_EVENT_SCHEMA,
    avro_to_struct,
    parse_avro_record,
    sales_event_avro,
)

SALES = parse_avro_record(sales_event_avro())
SMALL = parse_avro_record(
    {
        "type": "record",
        "name": "R",
        "fields": [
            {"name": "i", "type": ["null", "int"]},
            {"name": "l", "type": "long"},
            {"name": "s", "type": ["null", "string"]},
            {"name": "d", "type": ["double", "null"]},
        ],
    }
)


def zz(v: int) -> bytes:
    """Reference zig-zag varint, written independently of the codec."""
    z = (v << 1) ^ (v >> 63)
    z &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = z & 0x7F
        z >>= 7
        if z:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def small_record(i, l, s, d) -> bytes:
    body = (zz(0) if i is None else zz(1) + zz(i)) + zz(l)
    body += zz(0) if s is None else zz(1) + zz(len(s.encode())) + s.encode()
    body += zz(1) if d is None else zz(0) + np.float64(d).astype("<f8").tobytes()
    return body


def decode(bodies, fields=SMALL, with_error=False):
    return avro.decode_batch(pa.array(bodies, pa.binary()), fields, with_error).to_pylist()


def test_schema_has_36_fields_in_order():
    st_ = avro_to_struct(sales_event_avro())
    assert len(st_.fields) == 36
    assert st_ == SALES_EVENT_SCHEMA
    kinds = [f.dataType.simpleString() for f in st_.fields]
    assert kinds[:19] == ["int"] * 19 and kinds[19:34] == ["double"] * 15
    assert kinds[34:] == ["string", "timestamp"]
    assert all(f.nullable for f in st_.fields)


def test_unsupported_types_raise():
    with pytest.raises(NotImplementedError):
        parse_avro_record({"type": "record", "name": "X", "fields": [{"name": "a", "type": ["int", "string"]}]})
    with pytest.raises(NotImplementedError):
        parse_avro_record({"type": "record", "name": "X", "fields": [{"name": "a", "type": {"type": "array",
                                                                                          "items": "int"}}]})


def test_hand_written_bytes():
    rows = decode([
        small_record(5, -1, "ab", 1.5),
        small_record(None, 2**63 - 1, "", None),
        small_record(-(2**31), -(2**63), "héllo ✓", -0.0),
    ])
    assert rows[0] == {"i": 5, "l": -1, "s": "ab", "d": 1.5}
    assert rows[1] == {"i": None, "l": 2**63 - 1, "s": "", "d": None}
    assert rows[2]["i"] == -(2**31) and rows[2]["l"] == -(2**63) and rows[2]["s"] == "héllo ✓"
    assert math.copysign(1, rows[2]["d"]) == -1


def test_bad_bodies_become_null_records_with_reason():
    good = small_record(1, 2, "x", 3.0)
    bodies = [
        None,
        b"",
        good[:-1],                        # truncated
        zz(5) + good[1:],                 # union branch out of range
        good + b"trailing bytes",         # ignored
        zz(1) + b"\xff" * 11,             # varint longer than ten bytes
        zz(1) + zz(1) + zz(1) + zz(1) + zz(-3),  # negative string length
        zz(0) + zz(1) + zz(1) + zz(2) + b"\xff\xfe" + zz(1),  # invalid UTF-8
    ]
    plain = decode(bodies)
    assert plain[4] == {"i": 1, "l": 2, "s": "x", "d": 3.0}
    assert [r is None for r in plain] == [True, True, True, True, False, True, True, True]
    errs = [r["_decode_error"] for r in decode(bodies, with_error=True)]
    assert errs[0] == "null body" and errs[1] == "empty body"
    assert errs[2].startswith("truncated record") and "union branch" in errs[3]
    assert errs[4] is None and "varint" in errs[5] and "length" in errs[6] and "UTF-8" in errs[7]


def test_int_overflow_nulls_only_that_field():
    body = zz(1) + zz(3_000_000_000) + zz(7) + zz(0) + zz(1)
    assert decode([body]) == [{"i": None, "l": 7, "s": None, "d": None}]


def test_sliced_input_and_large_binary():
    bodies = pa.array([small_record(i, i, str(i), float(i)) for i in range(10)], pa.large_binary()).slice(3, 4)
    rows = avro.decode_batch(bodies, SMALL).to_pylist()
    assert [r["i"] for r in rows] == [3, 4, 5, 6]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(
    st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)),
    st.integers(-(2**63), 2**63 - 1),
    st.one_of(st.none(), st.text(max_size=40)),
    st.one_of(st.none(), st.floats(allow_nan=False)),
), max_size=30))
def test_encode_decode_identity(records):
    arrays = [
        pa.array([r[0] for r in records], pa.int32()),
        pa.array([r[1] for r in records], pa.int64()),
        pa.array([r[2] for r in records], pa.string()),
        pa.array([r[3] for r in records], pa.float64()),
    ]
    struct = pa.StructArray.from_arrays(arrays, names=["i", "l", "s", "d"])
    encoded = avro.encode_batch(struct, SMALL)
    # the encoder agrees byte for byte with the reference writer above
    assert encoded.to_pylist() == [small_record(*r) for r in records]
    assert avro.decode_batch(encoded, SMALL).to_pylist() == [dict(zip("ilsd", r)) for r in records]


def test_sales_event_roundtrip_with_timestamps():
    ts = pa.array([dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc), None], pa.timestamp("us", tz="UTC"))
    cols = []
    for f in SALES:
        if f.name == "CreatedTime":
            cols.append(ts)
        else:
            cols.append(pa.nulls(2, avro._arrow_type(f)))
    struct = pa.StructArray.from_arrays(cols, names=[f.name for f in SALES])
    back = avro.decode_batch(avro.encode_batch(struct, SALES), SALES).to_pylist()
    assert back[0]["CreatedTime"] == dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)
    assert back[1]["CreatedTime"] is None


def test_messages_that_cannot_be_read_by_id_do_not_stop_the_others(spark):
    import json

    def schema(kind):
        return json.dumps({"type": "record", "name": "r", "fields": [{"name": "a", "type": ["null", kind]}, {"name": "b", "type": ["null", "long"]}]})

    writers = {"1": schema("int"), "2": schema("string")}
    rows = [(0, "1"), (1, "2"), (2, "gone"), (3, None), (4, "1")]
    whole = spark.createDataFrame(rows, "n INT, sid STRING").selectExpr("n", "sid", "struct(n AS a, cast(n * 10 AS BIGINT) AS b) AS i",
                                                                        "struct('x' AS a, 1L AS b) AS s")
    body = F.when(F.col("n") == 4, F.lit(b"\x07")).when(F.col("sid") == "2", avro.encode_avro(F.col("s"), writers["2"])).otherwise(
        avro.encode_avro(F.col("i"), writers["1"]))
    found = whole.select("n", "sid", body.alias("body"))
    reader = schema("long")
    got = {r.n: r.d for r in found.select("n", avro.avro_decoder_by_id(writers, reader, with_error=True)("sid", "body").alias("d")).collect()}
    assert (got[0].a, got[0].b, got[0]._decode_error) == (0, 0, None)
    assert got[1]._decode_error == "field a: writer type string cannot be read as long" and got[1].b is None
    assert got[2]._decode_error == "unknown schema id gone" and got[3]._decode_error == "no schema id"
    assert got[4]._decode_error and got[4].a is None
    plain = {r.n: r.d for r in found.select("n", avro.avro_decoder_by_id(writers, reader)("sid", "body").alias("d")).collect()}
    assert [n for n, d in plain.items() if d is not None] == [0]


def test_nullable_fields_that_a_record_lacks_are_written_as_null():
    given = {"l": pa.array([1, -(2**63)], pa.int64()), "s": pa.array(["a", None])}
    nulls = {"i": pa.nulls(2, pa.int32()), "d": pa.nulls(2, pa.float64())}
    few = pa.StructArray.from_arrays(list(given.values()), names=list(given))
    full = pa.StructArray.from_arrays([*given.values(), *nulls.values()], names=[*given, *nulls])
    want = [small_record(None, 1, "a", None), small_record(None, -(2**63), None, None)]
    assert avro.encode_batch(few, SMALL).to_pylist() == avro.encode_batch(full, SMALL).to_pylist() == want
    without = pa.StructArray.from_arrays([given["s"]], names=["s"])
    with pytest.raises(ValueError, match="non-nullable field l"):
        avro.encode_batch(without, SMALL)
