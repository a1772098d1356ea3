"""Avro binary records, decoded by column.

A schema becomes a tree of readers.  Each reader keeps one position per message of the Arrow batch and
reads its field of all messages at once: varints byte by byte over the whole batch, texts and bytes by one
gather, union branches and map or array items over the messages that have them.  So Python's work per batch
follows the number of fields (and of items in the longest list), not the number of messages.

Records, enums, fixed, arrays, maps, unions, all primitive types and the logical types ``decimal``, ``date``,
``timestamp-millis`` and ``timestamp-micros`` are read.  A union with null is its other branch, nullable; one
of several other branches is a struct ``member0``, ``member1``...  A schema that contains itself is refused.

Null messages give null.  A message that is cut short, has bytes left over, a wrong first header byte, text
that is no UTF-8, an unknown branch or symbol, or a number beyond its type gives null too; the caller can tell
these by the value, which is not null.  A list cannot declare more items than it has bytes left.
"""

import json
import struct
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

HEADER_BYTES = 5  # of a registry's framing: a zero byte and the schema's number
DAY = 86_400_000_000


class Cursor:
    """One batch of messages: all bytes, and per message its position, its end and whether it is broken."""

    def __init__(self, values, skip):
        values = values.cast(pa.binary())
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
        body = values.buffers()[2]
        size = int(offsets[-1]) if len(values) else 0
        self.data = np.zeros(size + 16, np.uint8)  # a read at the end meets zeros
        if size:
            self.data[:size] = np.frombuffer(body, np.uint8, size)
        self.pos, self.end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        self.null = ~np.asarray(values.is_valid().to_numpy(zero_copy_only=False), bool)
        self.bad = self.null | (self.end - self.pos < skip)
        if skip:
            self.bad |= self.data[self.pos] != 0
            self.pos = np.minimum(self.pos + skip, self.end)

    def fail(self, rows, where):
        self.bad[rows[where]] = True

    def longs(self, rows):
        value = np.zeros(len(rows), np.uint64)
        pos, end = self.pos[rows], self.end[rows]
        more = ~self.bad[rows]
        for shift in range(0, 70, 7):
            cut = more & (pos >= end)
            self.fail(rows, cut)
            more &= ~cut
            byte = self.data[np.minimum(pos, end)]
            part = (byte & 0x7F).astype(np.uint64)
            if shift == 63:
                self.fail(rows, more & (byte > 1))
            value |= np.where(more, part << np.uint64(shift), np.uint64(0))
            pos += more
            more &= byte > 127
            if not more.any():
                break
        self.pos[rows] = pos
        return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def take(self, rows, sizes):
        """Start and length of the next ``sizes`` bytes; nothing where they are not there."""
        wrong = (sizes < 0) | (sizes > self.end[rows] - self.pos[rows]) | self.bad[rows]
        self.fail(rows, wrong)
        sizes = np.where(wrong, 0, sizes)
        start = self.pos[rows]
        self.pos[rows] = start + sizes
        return start, sizes

    def matrix(self, rows, width):
        start, sizes = self.take(rows, np.full(len(rows), width, np.int64))
        return np.where((sizes == width)[:, None],
                        self.data[np.minimum(start[:, None] + np.arange(width), len(self.data) - 1)], np.uint8(0))

    def gather(self, start, sizes):
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        at = np.repeat(start - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.binary(), len(sizes), [
            None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data[at]))])


def _castable(cur, rows, array, kind):
    """``array`` as ``kind``; messages with a value that does not fit are broken and found by halving."""
    try:
        return array.cast(kind)
    except pa.ArrowInvalid:
        if len(array) == 1:
            cur.bad[rows] = True
            return pa.nulls(1, kind)
        half = len(array) // 2
        return pa.concat_arrays([_castable(cur, rows[:half], array[:half], kind),
                                 _castable(cur, rows[half:], array[half:], kind)])


def _number(kind):
    def read(cur, rows):
        return _castable(cur, rows, pa.array(cur.longs(rows)), kind)
    return kind, read


def _instant(factor):
    def read(cur, rows):
        value, limit = cur.longs(rows), np.iinfo(np.int64).max // factor
        far = (value > limit) | (value < -limit)
        cur.fail(rows, far)
        return pa.array(np.where(far, 0, value) * factor).cast(pa.timestamp("us", "UTC"))
    return pa.timestamp("us", "UTC"), read


def _boolean(cur, rows):
    byte = cur.matrix(rows, 1)[:, 0]
    cur.fail(rows, byte > 1)
    return pa.array(byte == 1)


def _floating(width):
    def read(cur, rows):
        return pa.array(np.ascontiguousarray(cur.matrix(rows, width)).view(f"<f{width}")[:, 0])
    return (pa.float32() if width == 4 else pa.float64()), read


def _bytes(size=None):
    def read(cur, rows):
        sizes = cur.longs(rows) if size is None else np.full(len(rows), size, np.int64)
        return cur.gather(*cur.take(rows, sizes))
    return pa.binary(), read


def _text(cur, rows):
    return _castable(cur, rows, _bytes()[1](cur, rows), pa.string())


def _decimal(size, precision, scale):
    """Two's complement, most significant byte first, of any length up to 16 significant bytes."""
    kind, width = pa.decimal128(precision, scale), np.arange(16)

    def read(cur, rows):
        sizes = cur.longs(rows) if size is None else np.full(len(rows), size, np.int64)
        start, sizes = cur.take(rows, sizes)
        cur.fail(rows, sizes > 16)
        sizes = np.minimum(sizes, 16)
        sign = np.where((sizes > 0) & (cur.data[start] > 127), 255, 0).astype(np.uint8)
        at = np.maximum(start[:, None] + sizes[:, None] - 16 + width, 0)
        big = np.where(width >= 16 - sizes[:, None], cur.data[at], sign[:, None])
        little = np.ascontiguousarray(big[:, ::-1])
        whole = pa.Array.from_buffers(pa.decimal128(38, scale), len(rows), [None, pa.py_buffer(little)])
        return _castable(cur, rows, whole, kind)
    return kind, read


def _enum(symbols):
    names = pa.array(symbols, pa.string())

    def read(cur, rows):
        at = cur.longs(rows)
        wrong = (at < 0) | (at >= len(symbols))
        cur.fail(rows, wrong)
        return names.take(pa.array(np.where(wrong, 0, at)))
    return pa.string(), read


def _record(fields):
    kind = pa.struct([pa.field(name, of) for name, (of, _) in fields])

    def read(cur, rows):
        return pa.StructArray.from_arrays([r(cur, rows) for _, (_, r) in fields], fields=list(kind))
    return kind, read


def _spread(array, has):
    """``array`` holds the values of the rows where ``has``; null elsewhere."""
    at = np.cumsum(has) - 1
    return array.take(pa.array(at, mask=~has))


def _union(branches):
    solid = [i for i, (kind, _) in enumerate(branches) if kind != pa.null()]
    kind = branches[solid[0]][0] if len(solid) == 1 else (
        pa.struct([pa.field(f"member{n}", branches[i][0]) for n, i in enumerate(solid)]) if solid else pa.null())

    def read(cur, rows):
        branch = cur.longs(rows)
        cur.fail(rows, (branch < 0) | (branch >= len(branches)))
        parts = []
        for i in solid:
            has = branch == i
            parts.append(_spread(branches[i][1](cur, rows[has]), has))
        if len(solid) == 1:
            return parts[0]
        if not solid:
            return pa.nulls(len(rows))
        return pa.StructArray.from_arrays(
            parts, fields=list(kind), mask=pa.array(~np.isin(branch, solid)))
    return kind, read


def _items(readers, build):
    """Blocks of items until an empty one; ``readers`` read the parts of one item."""
    def read(cur, rows):
        owners, parts = [], [[] for _ in readers]
        open_ = np.arange(len(rows))
        while len(open_):
            count = cur.longs(rows[open_])
            sized = open_[count < 0]
            cur.longs(rows[sized])  # the block's bytes, which only a skipping reader needs
            count = np.where(count == np.iinfo(np.int64).min, np.iinfo(np.int64).max, np.abs(count))
            cur.fail(rows[open_], count > cur.end[rows[open_]] - cur.pos[rows[open_]])
            live = (count > 0) & ~cur.bad[rows[open_]]
            open_, count = open_[live], count[live]
            done, step = open_, 0
            while len(done):
                for part, (_, reader) in zip(parts, readers):
                    part.append(reader(cur, rows[done]))
                owners.append(done)
                step += 1
                done = open_[(count > step) & ~cur.bad[rows[open_]]]
            open_ = open_[~cur.bad[rows[open_]]]
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = pa.array(np.argsort(owner, kind="stable"))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))]).astype(np.int32)
        flat = [(pa.concat_arrays(p) if p else pa.array([], r[0])).take(order) for p, r in zip(parts, readers)]
        return build(pa.array(offsets), flat)
    return read


def _last_of_each_key(array):
    """Maps as lists of entries; of a repeated key the last one counts, as in a dictionary."""
    keys = array.keys.to_pylist()
    bounds = array.offsets.to_pylist()
    if all(len(set(keys[a:b])) == b - a for a, b in zip(bounds, bounds[1:])):
        return array
    return pa.array([None if m is None else list(dict(m).items()) for m in array.to_pylist()], array.type)


def compiled(avro_schema, names=None):
    """(Arrow type, reader) of a schema, given as JSON text or as what it parses to."""
    if names is None:
        names = {}
        if isinstance(avro_schema, str) and avro_schema.lstrip()[:1] in ("{", "[", '"'):
            avro_schema = json.loads(avro_schema)
    if isinstance(avro_schema, list):
        return _union([compiled(s, names) for s in avro_schema])
    if isinstance(avro_schema, str):
        avro_schema = {"type": avro_schema}
    kind, logical = avro_schema["type"], avro_schema.get("logicalType")
    if isinstance(kind, (list, dict)):
        return compiled(kind, names)
    if logical == "decimal" and kind in ("bytes", "fixed") and avro_schema["precision"] <= 38:
        made = _decimal(avro_schema.get("size"), avro_schema["precision"], avro_schema.get("scale", 0))
    elif kind == "long" and logical in ("timestamp-millis", "timestamp-micros"):
        made = _instant(1000 if logical == "timestamp-millis" else 1)
    elif kind == "int" and logical == "date":
        made = pa.date32(), lambda cur, rows: _number(pa.int32())[1](cur, rows).cast(pa.date32())
    elif kind == "record":
        names[avro_schema["name"]] = None
        made = _record([(f["name"], compiled(f["type"], names)) for f in avro_schema["fields"]])
    elif kind == "enum":
        made = _enum(avro_schema["symbols"])
    elif kind == "fixed":
        made = _bytes(avro_schema["size"])
    elif kind == "array":
        item = compiled(avro_schema["items"], names)
        of = pa.list_(item[0])
        made = of, _items([item], lambda offsets, flat: pa.ListArray.from_arrays(offsets, flat[0], type=of))
    elif kind == "map":
        item = compiled(avro_schema["values"], names)
        made = pa.map_(pa.string(), item[0]), _items(
            [(pa.string(), _text), item], lambda offsets, flat: _last_of_each_key(
                pa.MapArray.from_arrays(offsets, *flat)))
    elif kind in names:
        if names[kind] is None:
            raise ValueError(f"the schema contains itself: {kind}")
        return names[kind]
    else:
        made = {
            "null": (pa.null(), lambda cur, rows: pa.nulls(len(rows))),
            "boolean": (pa.bool_(), _boolean), "int": _number(pa.int32()), "long": _number(pa.int64()),
            "float": _floating(4), "double": _floating(8), "bytes": _bytes(), "string": (pa.string(), _text),
        }[kind]
    if "name" in avro_schema:
        names[avro_schema["name"]] = made
    return made


def decode(values, avro_schema, header_bytes=0):
    """An Arrow array of messages as an Arrow array of their values; null where a message is broken."""
    kind, read = compiled(avro_schema)
    cur = Cursor(values, header_bytes)
    result = read(cur, np.arange(len(values)))
    broken = cur.bad | (cur.pos != cur.end)
    return result.take(pa.array(np.arange(len(values)), mask=broken)).cast(kind)


def from_avro(column, avro_schema, header_bytes=HEADER_BYTES):
    """Messages of a binary column as values of the schema's type.

    Declared as not deterministic, so that a filter on the result does not decode a second time.
    """
    kind, _ = compiled(avro_schema)
    read = F.arrow_udf(lambda values: decode(values, avro_schema, header_bytes), from_arrow_type(kind))
    return read.asNondeterministic()(column)


# ---------------------------------------------------------------- writing

def _varint(n):
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def resolved(kind, names=None):
    """The schema with each reference to a named type replaced by what it names."""
    names = {} if names is None else names
    if isinstance(kind, list):
        return [resolved(k, names) for k in kind]
    if isinstance(kind, str):
        return names.get(kind, kind)
    kind = {**kind, **{part: resolved(kind[part], names) for part in ("items", "values") if part in kind}}
    if "fields" in kind:
        kind["fields"] = [{**f, "type": resolved(f["type"], names)} for f in kind["fields"]]
    elif not isinstance(kind["type"], str):
        kind["type"] = resolved(kind["type"], names)
    if "name" in kind:
        names[kind["name"]] = kind
    return kind


def encoded(value, kind):
    """One value in Avro's binary form; of a union, the null or else the first other branch is taken."""
    if isinstance(kind, list):
        at = next(i for i, k in enumerate(kind) if (k == "null") == (value is None))
        return _varint(at) + encoded(value, kind[at])
    if isinstance(kind, str):
        kind = {"type": kind}
    name = kind["type"]
    if not isinstance(name, str):
        return encoded(value, name)
    if kind.get("logicalType") == "decimal":
        whole = int(Decimal(value).scaleb(kind.get("scale", 0)))
        raw = whole.to_bytes(kind.get("size") or (whole + (whole < 0)).bit_length() // 8 + 1, "big", signed=True)
        return raw if name == "fixed" else _varint(len(raw)) + raw
    if name == "record":
        return b"".join(encoded(value[f["name"]], f["type"]) for f in kind["fields"])
    if name == "array":
        return (_varint(len(value)) + b"".join(encoded(v, kind["items"]) for v in value) if value else b"") + b"\0"
    if name == "map":
        body = b"".join(encoded(k, "string") + encoded(v, kind["values"]) for k, v in value.items())
        return (_varint(len(value)) + body if value else b"") + b"\0"
    if name in ("string", "bytes"):
        raw = value.encode() if name == "string" else value
        return _varint(len(raw)) + raw
    return {
        "null": lambda: b"", "boolean": lambda: bytes([value]), "int": lambda: _varint(value),
        "long": lambda: _varint(value), "float": lambda: struct.pack("<f", value),
        "double": lambda: struct.pack("<d", value), "fixed": lambda: value,
        "enum": lambda: _varint(kind["symbols"].index(value)),
    }[name]()


def to_avro(column, avro_schema, schema_number=1):
    """A struct column as framed messages; times are given as the numbers that the schema stores."""
    kind = resolved(json.loads(avro_schema))
    head = b"\0" + schema_number.to_bytes(4, "big")

    def write(values):
        return pa.array([None if v is None else head + encoded(v, kind) for v in
                         values.to_pylist(maps_as_pydicts="strict")], pa.binary())

    return F.arrow_udf(write, "binary").asNondeterministic()(column)
