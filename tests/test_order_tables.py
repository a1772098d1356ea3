"""The stored order lines and the gold made from them, on tables with a large customer, missing times and keys."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerwatch.config import FeatureConfig
from ledgerwatch.operators import features, gold, increments
from ledgerwatch.plans import catalog, medallion, standins

CHECKED = ["velocity_1h", "velocity_6h", "velocity_24h", "amount_zscore", "distance_from_last_km",
           "time_since_last_minutes"]


def rows_of(df):
    return sorted(map(repr, df.collect()))


def order_tables(spark, folder):
    """Small tables of order lines: customer 1 buys most, order 3 has no time, customers 8 and 9 no order or no line."""
    rng = random.Random(5)
    orders = [(o, 1 if o % 2 else 2 + o % 7, None if o == 3 else datetime(2024, 1, 1) + timedelta(days=o % 20), "x")
              for o in range(60)]
    lines = [(o, rng.randrange(12), rng.randrange(5), n, 100.0 * rng.randrange(1, 300), 1.0 + n, rng.choice("RAN"),
              rng.choice("OF")) for o in range(62) for n in range(1, 4)] + [(1, None, 1, 1, 5.0, 1.0, "R", "O")]
    made = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                            "l_extendedprice double, l_quantity double, l_returnflag string, l_linestatus string"),
        "customer": ([(c, c % 3, "s") for c in range(10)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(p, "t", 1) for p in range(11)], "p_partkey long, p_type string, p_size int")}
    for name, (data, ddl) in made.items():
        spark.createDataFrame(data, ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_features_of_stored_order_lines_are_made_as_they_are_read(spark, tmp_path, monkeypatch):
    d = order_tables(spark, tmp_path)
    cut = features.clustered_rows
    monkeypatch.setattr(features, "clustered_rows", lambda *of: cut(*of, FeatureConfig(whole_rows=60)))
    first, rest = catalog._order_tables(spark, d)
    stored = {f.rsplit("/", 2)[-2] for f in first.inputFiles()}
    kept = spark.read.parquet(first.inputFiles()[0].rsplit("/", 1)[0]).columns
    assert len(stored) == 1 and set(kept) == {*standins.order_lines(spark, d).columns, "customer_id_hash"}
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    assert first.columns == rest.columns and first.count() and rest.filter("velocity_1h IS NOT NULL").count()
    want = features.add_features(medallion.secured(
        standins.txn_orders(spark, d).cache(), catalog.STANDINS, catalog.AS_OF))
    assert sorted(want.columns) == sorted(first.columns)
    columns = ["transaction_id", "customer_id_hash", "customer_id_original", "amount", *CHECKED]
    rounded = [F.round(c, 6) if dict(want.dtypes)[c] == "double" else F.col(c) for c in columns]
    assert rows_of(first.unionByName(rest).select(rounded)) == rows_of(want.select(rounded))


def test_gold_of_parts_is_that_of_all_rows_and_shuffles_no_clustered_rows(spark, tmp_path, monkeypatch):
    d = order_tables(spark, tmp_path)
    cut = features.clustered_rows
    monkeypatch.setattr(features, "clustered_rows", lambda *of: cut(*of, FeatureConfig(whole_rows=60)))
    # order 3 has no time, so rows of its customer, of many rows, lie in the second part only
    parts, found = catalog._order_silver_parts(spark, d), catalog._order_alerts(spark, d)
    whole, day = catalog._order_silver(spark, d), "2024-01-31"
    assert not set(catalog._order_tables(spark, d)[0].select("customer_id").distinct().collect()) & set(
        catalog._order_tables(spark, d)[1].filter("timestamp IS NOT NULL").select("customer_id").distinct().collect())
    for make in (gold.customer_patterns, gold.merchant_analytics):
        assert rows_of(make(parts, found, day)) == rows_of(make(whole, found, day))
    first = catalog._as_silver(catalog._order_tables(spark, d)[0])
    plan = gold.customer_patterns([first], found, day)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1, plan  # the scores of the alerts, nothing of the rows
    made = {}
    for n, rows in enumerate([whole, [first, catalog._as_silver(catalog._order_tables(spark, d)[1])]]):
        for kind in ("customer", "merchant"):
            r = increments.Refresh(f"{tmp_path}/gold-{n}-{kind}", kind)
            ids = whole.select("transaction_id", "merchant_id").join(found, "transaction_id", "left_semi")
            increments.refresh(spark, r, "some", 0, rows, found, ids, day)
            made[n, kind] = rows_of(increments.read(spark, r))
    assert made[0, "customer"] == made[1, "customer"] and made[0, "merchant"] == made[1, "merchant"]


def test_rows_without_a_time_keep_gold_of_their_customer_whole(spark, tmp_path):
    d = order_tables(spark, tmp_path)
    parts = catalog._order_silver_parts(spark, d)
    assert len(parts) == 1  # customer 1 has rows without a time beside clustered ones
    got = gold.customer_patterns(parts, catalog._order_alerts(spark, d), "2024-01-31")
    assert got.count() == got.select("customer_id_hash").distinct().count()


def test_order_lines_are_joined_in_buckets_without_a_shuffle(spark, tmp_path, monkeypatch):
    d = order_tables(spark, tmp_path)
    # part 5 is missing, part 6 there twice, one part and one line without a key
    spark.createDataFrame([(p, "t", 1) for p in [None, 0, 1, 2, 3, 4, 6, 6, 7, 8, 9, 10]],
                          "p_partkey long, p_type string, p_size int").write.mode("overwrite").parquet(
        f"{d}/part.parquet")
    monkeypatch.setattr(standins, "LINE_BUCKET_ROWS", 50)
    names = []
    plain = catalog.store
    monkeypatch.setattr(catalog, "store", lambda df, name: names.append(name) or plain(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = standins.order_lines_in_buckets(spark, d, lambda rows: rows)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        want = standins.order_lines(spark, d)
        assert sorted(lines.columns) == sorted(want.columns)
        got = rows_of(lines.select(want.columns))
        assert got == rows_of(want) and len(got) > len(set(got))
        catalog._order_rows(spark, d)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "orders-joined" not in names  # the joined rows are stored once, in buckets of customers
