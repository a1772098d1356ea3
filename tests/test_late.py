"""The targeted refill: which days it reads, and the same rows as a full run."""

import datetime
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwatch import schema, session
from ledgerwatch.config import FeatureConfig, PipelineConfig
from ledgerwatch.operators.features import CUSTOMER
from ledgerwatch.plans import late, medallion

DAY0 = datetime.date(2024, 1, 1)


def typed(spark, rows):
    """Transactions from short dicts; other columns are constant or null."""
    short = "transaction_id string, customer_id string, timestamp timestamp, amount decimal(10,2)"
    df = spark.createDataFrame(
        [(r["transaction_id"], r["customer_id"], r["timestamp"], Decimal(r["amount"])) for r in rows], short)
    given = {"currency": "USD", "merchant_id": "m", "merchant_name": "M", "merchant_category": "GROCERY",
             "status": "APPROVED", "channel": "POS", "card_type": "DEBIT"}
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(given.get(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.TRANSACTION.fields])


def by_rows(counts, late_days, reach):
    """(updated, context) days from the definition, row by row."""
    ranked = [day for day in sorted(counts) for _ in range(counts[day])]
    days, updated = sorted(set(counts) | set(late_days)), set()
    for day in days:
        for other in late_days:
            between = sum(other < r < day for r in ranked)
            if other <= day and (day - other <= 1 or between < reach):
                updated.add(day)
    context = {day for day in days if day not in updated and any(
        day < u and (u - day <= 1 or sum(day < r < u for r in ranked) < reach) for u in updated)}
    return updated, context


def test_affected_days(spark):
    rnd, cfg = random.Random(5), FeatureConfig(history_rows=5)
    cases = {}
    for n in range(60):
        days = rnd.sample(range(40), rnd.randint(0, 12))
        cases[f"c{n}"] = ({d: rnd.randint(1, 4) for d in days}, rnd.sample(range(40), rnd.randint(1, 2)))
    at = lambda day: DAY0 + datetime.timedelta(days=day)
    schema = f"{CUSTOMER} string, _day date"
    days = spark.createDataFrame([(c, at(d), n) for c, (k, _) in cases.items() for d, n in k.items()],
                                 f"{schema}, _rows long")
    came = spark.createDataFrame([(c, at(d)) for c, (_, k) in cases.items() for d in k], schema)
    found = {}
    for r in late.affected_days(days, came, cfg).collect():
        found.setdefault(r[CUSTOMER], {True: set(), False: set()})[r.updated].add((r._day - DAY0).days)
    for name, (counts, late_days) in cases.items():
        updated, context = by_rows(counts, late_days, 5)
        assert found[name][True] == updated, name
        # Context may hold more, never less.
        assert found[name][False] >= context, name


def test_refill_equals_a_full_run_and_leaves_others(spark):
    rnd = random.Random(6)
    start = datetime.datetime(2024, 1, 1)
    rows = [{
        "transaction_id": f"t{i}", "customer_id": rnd.choice(["a", "a", "b", "c", None]),
        "timestamp": start + datetime.timedelta(seconds=rnd.randrange(40 * 86400)),
        "amount": rnd.randint(1, 900),
    } for i in range(900)]
    # t0 was delivered twice; its first delivery comes late, under another customer.
    rows[0].update(customer_id="a", timestamp=start + datetime.timedelta(days=30))
    first = {**rows[0], "customer_id": "b", "timestamp": start + datetime.timedelta(days=3)}
    late_rows = [first, *[r for r in rows[1:] if r["customer_id"] != "c"][:4]]
    everything = typed(spark, [*rows, first])
    came_late = typed(spark, late_rows)
    written = medallion.silver(typed(spark, [r for r in rows if r not in late_rows])).withColumn(
        "features_complete", F.lit(True))
    alone = medallion.silver(typed(spark, late_rows[1:])).withColumn("features_complete", F.lit(False))
    table = written.unionByName(alone)

    cfg = PipelineConfig()
    features = ["amount_zscore", "distance_from_last_km", "time_since_last_minutes", "velocity_1h", "velocity_6h",
                "velocity_24h", "features_complete"]

    def collected(df):
        return {r["transaction_id"]: tuple(r[f] for f in features) for r in df.collect()}

    full = collected(medallion.refill(table, everything, cfg))
    some = collected(late.refill_late(table, everything, came_late, cfg))
    assert some == full and len(full) > 700  # rows without a customer do not pass the quality filter
    assert some != collected(table)
    # Without a late row of a customer nothing of it is read.
    days = late.affected_days(
        spark.createDataFrame([("c", DAY0, 3)], f"{CUSTOMER} string, _day date, _rows long"),
        spark.createDataFrame([], f"{CUSTOMER} string, _day date"))
    assert days.count() == 0


def test_no_late_rows(spark):
    rows = typed(spark, [{"transaction_id": "t1", "customer_id": "a", "amount": 5,
                           "timestamp": datetime.datetime(2024, 1, 1)}])
    table = medallion.silver(rows).withColumn("features_complete", F.lit(True))
    same = late.refill_late(table, rows, rows.limit(0))
    assert same.drop("processed_at").collect() == table.drop("processed_at").collect()


def test_many_rows_are_not_broadcast(spark, monkeypatch):
    """What is too much for the driver is merged, however small it is on disk; the rows are the same."""
    rows = typed(spark, [{"transaction_id": f"t{i}", "customer_id": f"c{i % 40}", "amount": 5 + i % 7,
                          "timestamp": datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i)} for i in range(400)])
    came = rows.filter(F.substring("transaction_id", -1, 1) == "3")
    table = medallion.silver(rows).withColumn("features_complete", F.lit(True))
    few = sorted(map(tuple, late.refill_late(table, rows, came).drop("processed_at").collect()))
    kept, plans = late.store, []

    def ran(df):
        found = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return found

    def store(df, name):
        ran(df)
        return kept(df, name)

    monkeypatch.setattr(session, "BROADCAST_ROWS", 3, raising=False)
    monkeypatch.setattr(late, "store", store)
    many = sorted(map(tuple, ran(late.refill_late(table, rows, came).drop("processed_at"))))
    assert many == few and len(many) == 400
    assert len(plans) > 4 and not [p for p in plans if "BroadcastHashJoin" in p]
