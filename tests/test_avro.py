"""Avro messages: round trips against the row-at-a-time writer, broken bytes, and the path to typed rows."""

import base64
import datetime
import json
import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwatch.sources import avro, messages

ITEM = {"type": "record", "name": "Item", "fields": [
    {"name": "x", "type": "int"}, {"name": "y", "type": ["null", "double"]}]}
RECORD = {"type": "record", "name": "Row", "fields": [
    {"name": "a", "type": "long"},
    {"name": "s", "type": ["null", "string"]},
    {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
    {"name": "m", "type": {"type": "map", "values": "string"}},
    {"name": "l", "type": {"type": "array", "items": ITEM}},
    {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}},
    {"name": "b", "type": "boolean"}, {"name": "f", "type": "double"}, {"name": "z", "type": ["null", "Item"]},
]}


def some_rows(n, seed):
    rnd = random.Random(seed)

    def item():
        return {"x": rnd.randint(-2**31, 2**31 - 1), "y": rnd.choice([None, rnd.random()])}

    return [{
        "a": rnd.choice([0, -1, 2**63 - 1, -2**63, rnd.randint(-2**40, 2**40)]),
        "s": rnd.choice([None, "", "hé" * rnd.randint(0, 40)]),
        "d": Decimal(rnd.randint(-10**10 + 1, 10**10 - 1)).scaleb(-2),
        "m": {str(i): str(rnd.random()) for i in range(rnd.randint(0, 4))},
        "l": [item() for _ in range(rnd.randint(0, 5))],
        "e": rnd.choice("AB"), "b": rnd.random() < .5, "f": rnd.random(), "z": rnd.choice([None, item()]),
    } for _ in range(n)]


def read(raw, kind, header=0):
    return avro.decode(pa.array(raw, pa.binary()), json.dumps(kind), header).to_pylist(maps_as_pydicts="strict")


def test_round_trip_and_broken_neighbours():
    rows, kind = some_rows(600, 1), avro.resolved(RECORD)
    raw = [avro.encoded(r, kind) for r in rows]
    assert read(raw, RECORD) == rows
    rnd = random.Random(2)
    for i in range(1, len(raw), 2):
        raw[i] = rnd.choice([raw[i][:rnd.randrange(len(raw[i]))], raw[i] + b"\0", None, b"\xff" * rnd.randrange(60)])
    found = read(raw, RECORD)
    assert found[::2] == rows[::2]
    assert found[1::2] == [None] * (len(raw) // 2)
    assert read([], RECORD) == []
    # A slice of a larger array keeps its own offsets.
    sliced = pa.array(raw, pa.binary())[100:110]
    assert avro.decode(sliced, json.dumps(RECORD)).to_pylist(maps_as_pydicts="strict") == found[100:110]


@pytest.mark.parametrize("kind, raw, value", [
    ("int", b"\x01", -1),
    ("int", avro.encoded(2**31, "long"), None),
    ("long", b"\xff" * 9 + b"\x01", -2**63),
    ("long", b"\xff" * 9 + b"\x02", None),
    ("string", b"\x04\xc3\x28", None),
    ("string", b"\x01", None),
    ("boolean", b"\x02", None),
    ("float", b"\x00\x00\x80\x3f", 1.0),
    ("bytes", b"\x04\x00\xff", b"\x00\xff"),
    ({"type": "fixed", "name": "F", "size": 3}, b"abc", b"abc"),
    ({"type": "fixed", "name": "F", "size": 2, "logicalType": "decimal", "precision": 4, "scale": 1}, b"\xff\xfe",
     Decimal("-0.2")),
    ({"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 2}, b"\x08\xff\xff\xff\x9c", Decimal("-1.00")),
    ({"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 2}, b"\x04\x27\x10", None),
    ({"type": "int", "logicalType": "date"}, b"\x02", datetime.date(1970, 1, 2)),
    ({"type": "enum", "name": "E", "symbols": ["A"]}, b"\x02", None),
    (["null", "long", "string"], b"\x04\x02a", {"member0": None, "member1": "a"}),
    (["null", "long", "string"], b"\x00", None),
    (["null", "long"], b"\x04", None),
    # Two blocks, the first with its size; then a count that the message cannot hold.
    ({"type": "array", "items": "long"}, b"\x03\x04\x02\x04\x02\x06\x00", [1, 2, 3]),
    ({"type": "array", "items": "long"}, b"\xfe\xff\xff\x7f\x02", None),
    ({"type": "map", "values": "long"}, b"\x04\x02k\x02\x02k\x04\x00", {"k": 2}),
])
def test_single_values(kind, raw, value):
    assert read([raw, None, raw], kind) == [value, None, value]


def test_frame_and_self_reference():
    assert read([b"\0\0\0\0\1\x02", b"\1\0\0\0\1\x02", b"\0\0", b""], "long", 5) == [1, None, None, None]
    with pytest.raises(ValueError, match="contains itself"):
        avro.compiled({"type": "record", "name": "N", "fields": [{"name": "next", "type": ["null", "N"]}]})


def test_one_message_with_a_long_list():
    kind = {"type": "array", "items": "long"}
    values = list(range(5000))
    assert read([avro.encoded(values, kind), avro.encoded([], kind)], kind) == [values, []]


def test_messages_become_typed_rows(spark):
    contract = json.dumps({"type": "record", "name": "T", "fields": [
        {"name": "transaction_id", "type": ["null", "string"]},
        {"name": "amount", "type": ["null", {
            "type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}]},
        {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "location", "type": ["null", {"type": "record", "name": "P", "fields": [
            {"name": "lat", "type": "double"}, {"name": "lon", "type": "double"}]}]},
        {"name": "metadata", "type": {"type": "map", "values": "string"}},
    ]})
    kind = avro.resolved(json.loads(contract))
    good = [{"transaction_id": "a", "amount": Decimal("0.10"), "timestamp": 1700000000123,
             "location": {"lat": 1.5, "lon": -2.5}, "metadata": {"k": "v"}},
            {"transaction_id": None, "amount": None, "timestamp": 0, "location": None, "metadata": {}}]
    raw = [b"\0\0\0\0\1" + avro.encoded(g, kind) for g in good] + [b"\0broken", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "kafka_offset long, value binary")
    rows, bad = messages.split_malformed(messages.decode_avro(df, contract))
    first, second = messages.flatten(rows).withColumn("us", F.unix_micros("timestamp")).orderBy("kafka_offset").collect()
    assert (first.transaction_id, first.amount, first.us) == ("a", Decimal("0.10"), 1700000000123000)
    assert (first.location.latitude, first.location.longitude, first.metadata) == (1.5, -2.5, {"k": "v"})
    assert (second.transaction_id, second.amount, second.us, second.location) == (None, None, 0, None)
    assert [r.raw for r in bad.orderBy("kafka_offset").collect()] == [base64.b64encode(b"\0broken").decode(), None]
