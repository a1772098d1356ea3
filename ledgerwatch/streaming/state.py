"""Per-customer history over a stream: features and patterns.

Window functions over rows are not available on streams, so what they would see comes from keyed
state in the RocksDB store.  A customer has

* a head: the rows that a late row may still precede with as many before them as a feature looks
  back on, the newest entries of its timeline and of its recent rows, and the days of the timeline,
* nodes of the timeline (see ``timeline``): additive measures per second of the longest window plus
  the allowed lateness, for velocities and patterns,
* blocks of recent rows, for the patterns that compare rows.

A batch writes the head, which is bounded by parameters, and the nodes and blocks its rows moved into.
The states are kept by groups of customers, whose new rows are handled in one call: with a call for each
customer, most of the time goes into handing its few rows over.
Nodes and blocks that have left every window are removed when the customer comes again.  (Timers and
times to live need the processing-time mode, in which a query of all available data never ends.)  Rows pass through Python as one text each.

A row that repeats one of the head (same time and id) is not counted again.
"""

import math
import pickle
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ledgerwatch import schema
from ledgerwatch.config import DetectorConfig, FeatureConfig, QualityConfig
from ledgerwatch.operators import detect, features
from ledgerwatch.streaming import patterns
from ledgerwatch.streaming.timeline import Recent, Timeline

# A head as one value: micros, ids, amounts, lats, lons, cut, latest, first_sec, secs, sums, days, day_sums,
# blocks, and of the recent rows micros, ids, merchants, cents, risky.
HEAD_KEY, HEAD = "customer string", "packed binary"
EMPTY = ([], [], [], [], [], False, None, None, [], [], [], [], [], [], [], [], [], [])
NODE_KEY, NODE = "customer string, level int, at bigint", "keys array<bigint>, sums array<bigint>"
BLOCK_KEY = "customer string, block bigint"
BLOCK = ("micros array<bigint>, ids array<string>, merchants array<string>, cents array<bigint>, "
         "risky array<boolean>")
GROUPS, UNKNOWN_SALTS = 4096, 256
MEASURES = 7
#: Patterns that need the history; the other two follow from a row's own features.
HISTORY_PATTERNS = [p for p in detect.PATTERNS if p not in ("velocity_attack", "impossible_travel")]
#: Bits of a row's conditions.
OK, SMALL, SMALL_DECLINED, LARGE, RISKY, TAKEOVER, ABROAD = (1 << i for i in range(7))


def output_schema(cfg, carried):
    velocities = ", ".join(f"{v} bigint" for v in features.velocity_names(cfg))
    packed = ", ".join(f"{c} string" for c in carried)
    return (f"{packed}, {velocities}, _mean double, _sd double, _prev_lat double, _prev_lon double, "
            "_prev_us bigint, velocity_complete boolean, history_complete boolean, "
            "stream_patterns array<string>")


class _Store:
    """A customer's part of a map state as ``timeline`` wants it."""

    def __init__(self, state, customer):
        self.state, self.customer = state, customer

    def get(self, key):
        key = (self.customer, *key)
        return tuple(self.state.getValue(key)) if self.state.containsKey(key) else None

    def put(self, key, value):
        self.state.updateValue((self.customer, *key), value)

    def remove(self, key):
        self.state.removeKey((self.customer, *key))


class CustomerHistory(StatefulProcessor):
    """Look-back columns and patterns of the new rows of a group's customers, from state plus the micro-batch."""

    def __init__(self, cfg, late_hours, detectors, carried):
        self.cfg, self.detectors, self.carried = cfg, detectors, carried
        self.spans = [3600 * h for h in cfg.velocity_hours]
        self.late = 3600 * late_hours
        d = detectors
        self.reach = max(*self.spans, 86400 * d.bustout_days, 60 * d.takeover_minutes,
                         60 * d.testing_minutes, 3600 * d.identity_hours) + self.late
        self.recent_reach = max(60 * d.collusion_minutes,
                                60 * d.probing_gap_minutes * (d.probing_rows - 1)) + self.late
        self.names = [*carried, *features.velocity_names(cfg), "_mean", "_sd", "_prev_lat", "_prev_lon",
                      "_prev_us", "velocity_complete", "history_complete", "stream_patterns"]

    def init(self, handle):
        self.heads = handle.getMapState("heads", HEAD_KEY, HEAD)
        self.nodes = handle.getMapState("nodes", NODE_KEY, NODE)
        self.blocks = handle.getMapState("blocks", BLOCK_KEY, BLOCK)

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)
        if key[0] < 0:
            yield self._empty(new)
            return
        columns = [new["micros"].to_numpy("int64"), new["transaction_id"].to_numpy(object),
                   *[new[c].to_numpy("float64") for c in ("amount", "lat", "lon")],
                   new["bits"].to_numpy("int64"), new["merchant_id"].to_numpy(object)]
        codes, customers = pd.factorize(new["customer"].to_numpy(object))
        order = np.argsort(codes, kind="stable")  # by customer, as they came
        ends = np.cumsum(np.bincount(codes, minlength=len(customers)))
        parts = [self._of_customer(customer, *[c[own] for c in columns])
                 for customer, own in zip(customers, np.split(order, ends[:-1]))]
        out = {c: new[c].to_numpy(object)[order] for c in self.carried}
        for i, name in enumerate(self.names[len(self.carried):-1]):
            every = [part[i] for part in parts]
            out[name] = (pd.Series(list(chain.from_iterable(every)), dtype="Int64") if name == "_prev_us"
                         else np.concatenate(every))
        out[self.names[-1]] = list(chain.from_iterable(part[-1] for part in parts))
        yield pd.DataFrame(out)

    def _of_customer(self, customer, micros, ids, amount, lat, lon, bits, merchants):
        """The new columns of a customer's new rows, in the order of ``names``."""
        h = pickle.loads(self.heads.getValue((customer,))[0]) if self.heads.containsKey((customer,)) else EMPTY
        line = Timeline(MEASURES, _Store(self.nodes, customer), *h[8:12])
        recent = Recent(_Store(self.blocks, customer), zip(*h[13:18]), h[12])
        ids, secs, merchants, new = ids.tolist(), micros // 1_000_000, merchants.tolist(), range(len(micros))

        # The old rows and the new ones that do not repeat another, by time and id.
        names = list(zip(h[0], h[1]))
        place = {n: i for i, n in enumerate(names) if n[1]}
        fresh = []
        for i, n in enumerate(zip(micros.tolist(), ids)):
            if not n[1] or n not in place:
                fresh.append(i)
                if n[1]:
                    place[n] = len(names)
                names.append(n)
        old = len(h[0])
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        own = np.empty(len(new), np.int64)  # where each new row stands
        own[fresh] = rank[old:]
        taken = set(fresh)
        for i in new:
            if i not in taken:
                own[i] = rank[place[int(micros[i]), ids[i]]]

        def lined(before, now):
            return np.concatenate([np.array(before, np.float64), now[fresh]])[order]

        every = (np.array([names[i][0] for i in order], np.int64), [names[i][1] for i in order],
                 lined(h[2], amount), lined(h[3], lat), lined(h[4], lon))
        n = self.cfg.history_rows
        mean, sd = _look_back(every[2], n)
        prev_lat, prev_lon = (np.concatenate([[np.nan], a[:-1]])[own] for a in every[3:])
        prev = [int(every[0][i - 1]) if i else None for i in own.tolist()]
        history_complete = (own >= n) | (not h[5])
        horizon = None if h[6] is None else h[6] - self.late
        velocity_complete = np.full(len(new), True) if horizon is None else secs >= horizon

        far = _distance(prev_lat, prev_lon, lat, lon, self.cfg.earth_radius_km) > self.detectors.distance_km
        ok = bits & OK > 0
        takeover = ok & (bits & TAKEOVER > 0) & ((bits & ABROAD > 0) | (far & history_complete))
        cents = np.where(np.isnan(amount), 0, np.rint(np.nan_to_num(amount) * 100)).astype(np.int64)
        counted = ok & ~np.isnan(amount)
        measures = np.stack([
            np.ones(len(new), np.int64), counted, np.where(counted, cents, 0), takeover,
            ok & (bits & SMALL > 0), ok & (bits & SMALL_DECLINED > 0), ok & (bits & LARGE > 0)],
            axis=1).astype(np.int64)
        line.add(secs[fresh], measures[fresh])
        recent.add([(int(micros[i]), ids[i], merchants[i], None if np.isnan(amount[i]) else int(cents[i]),
                     bool(bits[i] & RISKY)) for i in fresh if ok[i]])
        seen = [x for x in (h[7], int(secs[ok].min()) if ok.any() else None) if x is not None]
        first = min(seen) if seen else None

        at, back = np.unique(secs, return_inverse=True)
        velocities = [(line.trailing(at, span)[:, patterns.ALL] - 1)[back] for span in self.spans]
        found = self._patterns(line, recent, at, back, bits, ok, takeover, micros, ids, first)
        latest = max(x for x in (h[6], int(secs.max())) if x is not None)
        self._store(customer, h, every, latest, first, line, recent)
        return [*velocities, mean[own], sd[own], prev_lat, prev_lon, prev, velocity_complete, history_complete, found]

    def _patterns(self, line, recent, at, back, bits, ok, takeover, micros, ids, first):
        d, found = self.detectors, [[] for _ in bits]
        if not ok.any():
            return found
        full = patterns.additive(d, line, at, first)
        trait = {"account_takeover": takeover, "card_testing": bits & SMALL > 0,
                 "synthetic_identity": bits & LARGE > 0, "bust_out": ok}
        span = self.recent_reach - self.late
        rows = recent.between(int(at[0]) - span, int(at[-1]))
        rising = patterns.rising(d, rows)
        close = patterns.collusion(d, rows, at.tolist())
        for i in np.flatnonzero(ok).tolist():
            hits = {name for name, t in trait.items() if t[i] and full[name][back[i]]}
            if (int(micros[i]), ids[i]) in rising:
                hits.add("amount_probing")
            if bits[i] & RISKY and int(at[back[i]]) in close:
                hits.add("merchant_collusion")
            found[i] = [p for p in HISTORY_PATTERNS if p in hits]
        return found

    def _store(self, customer, h, every, latest, first, line, recent):
        line.settle(latest - self.reach)
        recent.settle(latest - self.recent_reach)
        # Everything that a row may still precede, and the look-back of the earliest such row.
        mark = (latest - self.late) * 1_000_000
        start = max(int(np.searchsorted(every[0], mark)) - self.cfg.history_rows, 0)
        rows = list(zip(*recent.rows)) or [[]] * 5
        self.heads.updateValue((customer,), (pickle.dumps((
            every[0][start:].tolist(), every[1][start:], *[_floats(a[start:]) for a in every[2:]],
            bool(h[5] or start > 0), latest, first, line.secs.tolist(), line.sums.ravel().tolist(),
            line.days.tolist(), line.day_sums.ravel().tolist(), sorted(recent.blocks),
            *[list(c) for c in rows])),))

    def _empty(self, new):
        out = new.reindex(columns=self.names[:-3]).astype({"_prev_us": "Int64"})
        out["velocity_complete"] = out["history_complete"] = True
        out["stream_patterns"] = [[] for _ in range(len(new))]
        return out


def _look_back(amounts, n):
    """Mean and sample deviation of the ``n`` values before each value; NaN where undefined."""
    padded = np.concatenate([np.full(n, np.nan), amounts])
    frames = np.lib.stride_tricks.sliding_window_view(padded, n)[: len(amounts)]
    count = (~np.isnan(frames)).sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        # whole cents add up exactly, so the mean does not depend on the order of addition
        mean = np.nansum(np.rint(frames * 100), axis=1) / 100 / count
        spread = np.nansum((frames - mean[:, None]) ** 2, axis=1)
        sd = np.where(count > 1, np.sqrt(spread / (count - 1)), np.nan)
    return mean, sd


def _distance(lat1, lon1, lat2, lon2, radius):
    """Great-circle kilometres; 0 where a coordinate is missing."""
    a, b, c, d = (np.radians(x) for x in (lat1, lon1, lat2, lon2))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return np.nan_to_num(2 * radius * np.arcsin(np.sqrt(np.minimum(1.0, h))))


def _floats(values):
    return [None if math.isnan(v) else v for v in values.tolist()]


# Between the values of a packed row; inside them both characters are written as two.
SEPARATOR, ESCAPE = "\x02", "\x01"


def _coded(text):
    """A text without separators, also for NULL."""
    plain = F.replace(F.replace(text, F.lit(ESCAPE), F.lit(f"{ESCAPE}a")), F.lit(SEPARATOR), F.lit(f"{ESCAPE}b"))
    return F.coalesce(F.concat(F.lit("v"), plain), F.lit("n"))


def _decoded(text):
    plain = F.substring(text, F.lit(2), F.length(text))
    plain = F.replace(F.replace(plain, F.lit(f"{ESCAPE}b"), F.lit(SEPARATOR)), F.lit(f"{ESCAPE}a"), F.lit(ESCAPE))
    return F.when(text.startswith("v"), plain)


def _packed(df):
    """One text that carries a row: the texts of its values, maps as the texts of their keys and values."""
    texts = []

    def walk(column, kind):
        if isinstance(kind, T.StructType):
            texts.append(F.when(column.isNotNull(), "1"))
            for f in kind.fields:
                walk(column[f.name], f.dataType)
        elif isinstance(kind, T.MapType):
            texts.append(F.array_join(F.flatten(F.transform(F.map_entries(column), lambda e: F.array(
                _coded(e["key"].cast("string")), _coded(e["value"].cast("string"))))), SEPARATOR))
        elif isinstance(kind, T.TimestampType):
            texts.append(F.unix_micros(column).cast("string"))
        elif isinstance(kind, (T.AtomicType, T.NullType)) and not isinstance(kind, T.BinaryType):
            texts.append(column.cast("string"))
        else:
            raise TypeError(f"cannot carry a column of type {kind.simpleString()}")

    for f in df.schema.fields:
        walk(df[f"`{f.name}`"], f.dataType)
    return F.concat_ws(SEPARATOR, *[_coded(t) for t in texts])


def _unpacked(row_type):
    """The columns that ``_packed`` took in, from the array ``_texts`` of the packed values."""
    at = -1

    def walk(kind):
        nonlocal at
        at += 1
        text = _decoded(F.get("_texts", F.lit(at)))
        if isinstance(kind, T.StructType):
            return F.when(text.isNotNull(), F.struct(*[walk(f.dataType).alias(f.name) for f in kind.fields]))
        if isinstance(kind, T.MapType):
            both = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, SEPARATOR))
            every = lambda part: F.transform(
                F.filter(both, lambda _, i: i % 2 == part), _decoded)
            return F.map_from_arrays(every(0), every(1)).cast(kind)
        return F.timestamp_micros(text.cast("long")) if isinstance(kind, T.TimestampType) else text.cast(kind)

    return [walk(f.dataType).alias(f.name) for f in row_type.fields]


def _bits(detectors, quality):
    """The conditions of a row that need no other row, as bits of a number."""
    amount = F.col("amount")
    traits = detect.row_traits(detectors)
    conditions = {
        OK: F.col("data_quality_score") > quality.silver_min_score,
        SMALL: traits["_small"], SMALL_DECLINED: traits["_small_declined"], LARGE: traits["_large"],
        RISKY: traits["_risky_category"],
        TAKEOVER: (amount >= detectors.takeover_amount) & ~F.col("customer_present"),
        ABROAD: F.col("is_international"),
    }
    out = F.lit(0)
    for bit, condition in conditions.items():
        out = out + F.when(condition, bit).otherwise(0)
    return out.cast("long")


def add_features_stream(df, cfg=FeatureConfig(), late_hours=2, detectors=DetectorConfig(),
                        quality=QualityConfig()):
    """The features of ``features.add_features`` on a stream, and its patterns.

    Adds ``features_complete``: false for rows too late for the stored history; the features that need
    what is gone are NULL until ``medallion.refill``.  Adds ``stream_patterns``, the names of the
    patterns that need a history; they count rows that pass the quality filter.  Rows of unknown
    customers are spread over salts and touch no state.
    """
    usable = F.col(features.CUSTOMER).isNotNull() & F.col("timestamp").isNotNull()
    customer = F.when(usable, F.col(features.CUSTOMER)).otherwise(schema.UNKNOWN_CUSTOMER)
    group = F.when(
        customer == schema.UNKNOWN_CUSTOMER,
        -1 - F.pmod(F.xxhash64("transaction_id", "timestamp", "amount"), F.lit(UNKNOWN_SALTS)),
    ).otherwise(F.pmod(F.xxhash64(customer), F.lit(GROUPS)))
    narrow = df.select(
        group.cast("int").alias("customer_group"), customer.alias("customer"),
        F.coalesce("transaction_id", F.lit("")).alias("transaction_id"),
        # never NULL: one NULL would turn the whole pandas column into floats
        F.coalesce(F.unix_micros("timestamp"), F.lit(0)).alias("micros"),
        F.col("amount").cast("double").alias("amount"),
        F.col("location.latitude").alias("lat"), F.col("location.longitude").alias("lon"),
        "merchant_id", _bits(detectors, quality).alias("bits"), _packed(df).alias("packed_row"),
    )
    names = ["packed_row"]
    looked_back = narrow.groupBy("customer_group").transformWithStateInPandas(
        CustomerHistory(cfg, late_hours, detectors, names), output_schema(cfg, names), "Append",
        "None")
    rows = looked_back.withColumn("_texts", F.split("packed_row", SEPARATOR)).select(
        *_unpacked(df.schema), *[c for c in looked_back.columns if c not in names])
    rows = features.add_row_features(
        rows.withColumn("_prev_ts", F.timestamp_micros("_prev_us")).drop("_prev_us"))
    finished = features._finish(rows, cfg)
    known = F.col("timestamp").isNotNull() & (
        F.col(features.CUSTOMER) != schema.UNKNOWN_CUSTOMER)
    by_count = {c: "velocity_complete" for c in features.velocity_names(cfg)}
    by_rows = dict.fromkeys(
        ["amount_zscore", "distance_from_last_km", "time_since_last_minutes"], "history_complete")
    return finished.withColumns({
        **{c: F.when(known & F.col(flag), F.col(c)) for c, flag in {**by_count, **by_rows}.items()},
        "features_complete": F.col("velocity_complete") & F.col("history_complete"),
    }).drop("customer_avg_amount", "customer_stddev_amount", "velocity_complete", "history_complete")
