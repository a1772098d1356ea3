import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import DetectorConfig, FeatureConfig
from ledgerwatch import session
from ledgerwatch.operators import alerts, dedup, detect, features, gold, skew, validate

SMALL_CHUNKS = FeatureConfig(chunk_rows=60)
CHECKED = ["velocity_1h", "velocity_6h", "velocity_24h", "amount_zscore",
           "distance_from_last_km", "time_since_last_minutes"]


def at(minutes, seconds=0):
    total = minutes * 60 + seconds
    day, rest = divmod(total, 86400)
    return f"2024-01-{1 + day:02d} {rest // 3600:02d}:{rest % 3600 // 60:02d}:{rest % 60:02d}"


def skewed_rows(n=600, seed=3):
    """One customer holds most rows; bursts, ties and gaps included."""
    rng = random.Random(seed)
    rows, minute = [], 0
    for i in range(n):
        minute += rng.choice([0, 0, 0, 1, 1, 5, 40, 300])
        rows.append({
            "timestamp": at(minute, rng.choice([0, 0, 30])),
            "customer_id_hash": rng.choice(["hot", "hot", "hot", "a", "b"]),
            "amount": round(rng.choice([1, 4, 30, 600, 1600, 9000]) * rng.uniform(0.5, 1.5), 2),
            "merchant_id": rng.choice(["m1", "m2", "m3"]),
            "merchant_category": rng.choice(["RETAIL", "ONLINE", "GROCERY"]),
            "status": rng.choice(["APPROVED", "DECLINED"]),
            "is_international": rng.random() < 0.5, "customer_present": rng.random() < 0.3,
            "lat": rng.choice([10, 20, None]), "lon": rng.choice([5, 50]),
        })
    return rows


def frame(df, columns):
    rows = df.select("transaction_id", *columns).collect()
    return {r["transaction_id"]: tuple(r)[1:] for r in rows}


def test_features_against_brute_force(transactions):
    rows = skewed_rows()
    got = frame(features.add_features(transactions(rows), keep_statistics=True),
                ["velocity_1h", "velocity_24h", "customer_avg_amount", "customer_stddev_amount",
                 "time_since_last_minutes"])
    import datetime as dt
    keyed = [(r["customer_id_hash"], dt.datetime.fromisoformat(r["timestamp"]), f"t{i:05d}",
              r["amount"]) for i, r in enumerate(rows)]
    for customer, t, name, _ in keyed:
        same = [x for x in keyed if x[0] == customer]
        count = lambda h: sum(
            0 <= (t - x[1]).total_seconds() <= 3600 * h for x in same) - 1
        before = sorted((x for x in same if (x[1], x[2]) < (t, name)), key=lambda x: (x[1], x[2]))
        past = [x[3] for x in before[-50:]]
        v1, v24, mean, sd, gap = got[name]
        assert (v1, v24) == (count(1), count(24))
        assert mean == (pytest.approx(statistics.mean(past)) if past else None)
        assert sd == (pytest.approx(statistics.stdev(past)) if len(past) > 1 else None)
        assert gap == (
            pytest.approx((t - before[-1][1]).total_seconds() / 60) if before else 0.0)


def test_chunk_size_does_not_matter(transactions):
    df = transactions(skewed_rows())
    assert frame(features.add_features(df, SMALL_CHUNKS), CHECKED) == frame(
        features.add_features(df), CHECKED)


def row_shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_rows_of_small_customers_are_shuffled_once(transactions):
    df = session.store(transactions(skewed_rows()), "transactions")
    featured = features.add_features(df)
    assert row_shuffles(featured) == 1
    featured = session.store(featured, "features")
    assert row_shuffles(detect.add_patterns(featured)) == 1
    assert row_shuffles(detect.add_patterns(featured, patterns=["velocity_attack", "impossible_travel"])) == 0
    assert row_shuffles(detect.add_patterns(featured, patterns=["amount_probing"])) == 1


def test_customers_of_every_size(transactions):
    """The same rows with all customers, the largest and none of them in smaller groups."""
    df = transactions(skewed_rows())
    sizes = [r["count"] for r in df.groupBy("customer_id_hash").count().collect()]
    assert min(sizes) <= 200 < max(sizes)
    want, patterns = frame(features.add_features(df, FeatureConfig(whole_rows=0)), CHECKED), {}
    for most in (200, 1000):
        assert frame(features.add_features(df, FeatureConfig(whole_rows=most)), CHECKED) == want
    featured = session.store(features.add_features(df), "features")
    cfg = dict(takeover_rows=2, testing_rows=2, attack_rows=4, probing_rows=3, collusion_merchants=2,
               collusion_spread=5000.0, bustout_earlier_rows=2, bustout_recent_rows=1, bustout_factor=1.5,
               identity_rows=2)
    for most in (0, 200, 1000):
        patterns[most] = frame(
            detect.add_patterns(featured, DetectorConfig(**cfg, whole_rows=most)), detect.PATTERNS)
    assert patterns[0] == patterns[200] == patterns[1000]
    assert all(any(row[i] for row in patterns[0].values()) for i in range(len(detect.PATTERNS)))


def test_one_customer_with_many_rows_takes_linear_time(spark):
    import time

    def seconds(n):
        rows = spark.range(n).select(
            F.col("id").cast("string").alias("transaction_id"), F.lit("c").alias("customer_id_hash"),
            (F.lit(1704067200) + F.col("id") * 1728000 / n).cast("timestamp").alias("timestamp"),
            (F.col("id") % 97).cast("decimal(10,2)").alias("amount"),
            F.concat(F.lit("m"), F.col("id") % 5).alias("merchant_id"),
            F.lit("RETAIL").alias("merchant_category"), F.lit("DECLINED").alias("status"),
            F.lit(True).alias("is_international"), F.lit(False).alias("customer_present"),
            F.struct(F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude")).alias("location"),
            F.lit(None).cast("map<string,string>").alias("metadata"))
        start = time.time()
        featured = session.store(features.add_features(rows), "features")
        detect.add_patterns(featured).write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds(1000)
    assert seconds(200_000) < 10 * seconds(25_000)


def test_edge_rows(transactions):
    df = transactions([
        {"timestamp": at(0), "lat": 10, "lon": 20}, {"timestamp": at(60), "lat": 10, "lon": 20},
        {"timestamp": at(60), "lat": None, "lon": 20},
        {"timestamp": at(0), "customer_id_hash": "UNKNOWN"},
        {"timestamp": at(0), "customer_id_hash": None},
    ])
    got = frame(features.add_features(df), [*CHECKED, "hour_of_day", "day_of_week"])
    assert got["t00000"] == (0, 0, 0, 0.0, 0.0, 0.0, 0, 2)
    # the row one hour later still sees the first, and both rows of a second see each other
    assert got["t00001"][:5] == (2, 2, 2, 0.0, 0.0) and got["t00001"][5] == 60.0
    assert got["t00002"][:5] == (2, 2, 2, 0.0, 0.0) and got["t00002"][5] == 0.0
    assert got["t00003"][:6] == (None,) * 6 and got["t00004"][:6] == (None,) * 6
    assert got["t00003"][6:] == (0, 2)


def test_patterns_against_brute_force(transactions):
    cfg = DetectorConfig(
        takeover_rows=2, testing_rows=2, attack_rows=4, probing_rows=3, collusion_merchants=2,
        collusion_spread=5000.0, bustout_earlier_rows=2, bustout_recent_rows=1,
        bustout_factor=1.5, identity_rows=2)
    df = session.store(features.add_features(transactions(skewed_rows(900))), "features")
    rows = [r.asDict() for r in df.collect()]
    for r in rows:
        r["sec"] = int(r["timestamp"].timestamp())
    got = frame(detect.add_patterns(df, cfg), detect.PATTERNS)
    want = {r["transaction_id"]: brute_patterns(r, rows, cfg) for r in rows}
    assert got == want
    assert all(any(row[i] for row in got.values()) for i in range(len(detect.PATTERNS)))
    for i, name in enumerate(detect.PATTERNS):
        alone = frame(detect.add_patterns(df, cfg, [name]), [name])
        assert alone == {k: (v[i],) for k, v in want.items()}


def brute_patterns(r, rows, cfg):
    mine = [x for x in rows if x["customer_id_hash"] == r["customer_id_hash"]]
    last = lambda span: [x for x in mine if 0 <= r["sec"] - x["sec"] <= span]

    def takeover(x):
        far = x["is_international"] or (x["distance_from_last_km"] or 0) > cfg.distance_km
        return x["amount"] >= cfg.takeover_amount and not x["customer_present"] and far

    small = [x for x in last(cfg.testing_minutes * 60) if x["amount"] < cfg.testing_amount]
    declined = [x for x in small if x["status"] == "DECLINED"]
    risky = lambda x: x["merchant_category"] in cfg.collusion_categories
    near = [x for x in last(cfg.collusion_minutes * 60) if risky(x)]
    large = lambda x: x["amount"] >= cfg.identity_amount
    day, month = last(86400), last(86400 * cfg.bustout_days)
    earlier = sum(x["amount"] for x in month) - sum(x["amount"] for x in day)
    n_earlier = len(month) - len(day)
    key = lambda x: (x["sec"], x["timestamp"], x["transaction_id"])
    shop = sorted((x for x in mine if x["merchant_id"] == r["merchant_id"] and key(x) <= key(r)), key=key)
    run = shop[-cfg.probing_rows:]
    return (
        takeover(r) and sum(map(takeover, last(cfg.takeover_minutes * 60))) >= cfg.takeover_rows,
        r["amount"] < cfg.testing_amount and len(small) >= cfg.testing_rows
        and len(declined) / len(small) >= cfg.testing_declined_share,
        r["velocity_1h"] + 1 >= cfg.attack_rows,
        r["distance_from_last_km"] > cfg.travel_min_km
        and r["distance_from_last_km"] > cfg.travel_speed_kmh * r["time_since_last_minutes"] / 60,
        len(run) == cfg.probing_rows and all(
            b["amount"] > a["amount"] and b["sec"] - a["sec"] <= cfg.probing_gap_minutes * 60
            for a, b in zip(run, run[1:])),
        risky(r) and len({x["merchant_id"] for x in near}) >= cfg.collusion_merchants
        and max(x["amount"] for x in near) - min(x["amount"] for x in near) <= cfg.collusion_spread,
        large(r) and r["sec"] <= min(x["sec"] for x in mine) + cfg.identity_hours * 3600
        and sum(map(large, last(cfg.identity_hours * 3600))) >= cfg.identity_rows,
        n_earlier >= cfg.bustout_earlier_rows and len(day) >= cfg.bustout_recent_rows
        and float(sum(x["amount"] for x in day)) * n_earlier
        >= cfg.bustout_factor * float(earlier) * len(day),
    )


def fired(transactions, rows, pattern):
    # a stored frame between the two steps, as in the pipeline, keeps the plans small
    df = detect.add_patterns(features.add_features(transactions(rows)).persist())
    return sorted(r[0] for r in df.filter(pattern).select("transaction_id").collect())


def names(*numbers):
    return [f"t{n:05d}" for n in numbers]


@pytest.mark.parametrize("pattern, rows, expected", [
    ("account_takeover", [{"timestamp": at(10 * i), "amount": 700, "customer_present": False,
                           "is_international": True} for i in range(6)], names(4, 5)),
    ("card_testing", [{"timestamp": at(i), "amount": 1 + i / 100,
                       "status": "DECLINED" if i % 2 == 0 else "APPROVED"}
                      for i in range(11)], names(9, 10)),
    ("velocity_attack", [{"timestamp": at(i), "amount": 50} for i in range(21)], names(19, 20)),
    ("impossible_travel", [
        {"timestamp": at(0), "lat": 40.7, "lon": -74}, {"timestamp": at(45), "lat": 51.5, "lon": 0},
        {"timestamp": at(45 + 900), "lat": 40.7, "lon": -74}], names(1)),
    ("amount_probing", [{"timestamp": at(5 * i), "amount": a} for i, a in enumerate(
        [10, 25, 50, 100, 250, 500, 400])], names(4, 5)),
    ("merchant_collusion", [
        {"timestamp": at(15 * i), "amount": 300 + 10 * i, "merchant_id": f"m{i}",
         "merchant_category": c} for i, c in enumerate(["RETAIL", "RETAIL", "ONLINE", "OTHER"])],
     names(2, 3)),
    ("synthetic_identity", [{"timestamp": at(120 * i), "amount": a} for i, a in enumerate(
        [1500, 2000, 2500, 3000])], names(2, 3)),
    ("bust_out", [{"timestamp": at(1440 * i), "amount": 50} for i in range(7)]
     + [{"timestamp": at(1440 * 12 + 60 * i), "amount": 3000} for i in range(4)],
     names(9, 10)),
])
def test_each_pattern(transactions, pattern, rows, expected):
    assert fired(transactions, rows, pattern) == expected


def test_alerts_are_idempotent_and_scored(transactions):
    rows = [{"timestamp": at(i), "amount": 50, "is_international": True} for i in range(21)]
    df = detect.add_patterns(features.add_features(transactions(rows)).persist()).persist()
    found = alerts.build_alerts(df, as_of="2024-02-01 00:00:00")
    ids = [r["alert_id"] for r in found.collect()]
    assert len(ids) == len(set(ids)) and ids and sorted(ids) == sorted(
        r["alert_id"] for r in found.collect())
    last = {r["alert_type"]: r for r in found.filter("transaction_id = 't00020'").collect()}
    assert set(last) == {"VELOCITY_ANOMALY", "CROSS_BORDER", "SUSPICIOUS_PATTERN"}
    row = last["CROSS_BORDER"]
    assert row["risk_score"] == 0.8 and row["severity"] == "HIGH"
    assert row["recommended_action"] == "REQUEST_VERIFICATION" and row["status"] == "OPEN"
    assert set(row["rules_triggered"]) == {"VELOCITY_ANOMALY", "CROSS_BORDER", "velocity_attack"}
    assert row["features"]["day_of_week"] == 1  # Monday, first of January 2024
    assert validate.validate_alerts(found).filter("not is_valid").count() == 0


def test_stored_features_need_no_shuffle_and_equal_the_others(transactions, spark):
    rows = skewed_rows() + [{"timestamp": at(5), "customer_id_hash": c} for c in ("UNKNOWN", None, "b")]
    df, cfg, low = transactions(rows), FeatureConfig(whole_rows=200), DetectorConfig(takeover_rows=2, probing_rows=2)
    want = features.add_features(df, cfg)
    name, rest = features.feature_tables(df, "some-features", cfg)
    first = spark.table(name)
    assert {r[0] for r in first.select("customer_id_hash").distinct().collect()} == {"a", "b"}
    assert first.columns == rest.columns == want.columns
    assert frame(first.unionByName(rest), CHECKED) == frame(want, CHECKED)
    found = detect.add_patterns(first, low, clustered=True)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rising = detect.add_patterns(first, low, ["amount_probing"], clustered=True)
    assert "Exchange" not in rising._jdf.queryExecution().executedPlan().toString()
    every = found.unionByName(detect.add_patterns(rest, low))
    assert frame(every, detect.PATTERNS) == frame(detect.add_patterns(want, low), detect.PATTERNS)


def test_median_and_running_sums(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.randint(0, 5000)) for _ in range(501)] + [("c", 7)]
    df = spark.createDataFrame(data, "g string, v long")
    got = {r[0]: r[1] for r in skew.exact_median(df, "g", "v", 50).collect()}
    assert got == {g: statistics.median(v for k, v in data if k == g) for g in "abc"}


def test_duplicates_with_one_hot_key(spark):
    rows = [("k", 1, "x")] * 30 + [("k", 2, "x")] + [("a", 1, "y"), ("b", 1, "z"), ("b", 3, "w")]
    df = spark.createDataFrame(rows, "id string, seq int, v string").withColumn(
        "m", F.create_map(F.lit("key"), F.col("v")))
    flagged = dedup.flag_duplicates(df, ["id"], ["seq"])
    assert flagged.columns == [*df.columns, "is_duplicate"] and flagged.count() == len(rows)
    firsts = flagged.filter("not is_duplicate").select("id", "seq", "m.key").collect()
    assert sorted(tuple(r) for r in firsts) == [("a", 1, "y"), ("b", 1, "z"), ("k", 1, "x")]
    assert dedup.keep_first(df, ["id"], ["seq"]).count() == 3
    assert {r["id"]: r["copies"] for r in dedup.repeated_keys(df, ["id"]).collect()} == {
        "k": 31, "b": 2}


def test_daily_limit(transactions):
    df = transactions([
        {"timestamp": at(0), "amount": 6000}, {"timestamp": at(1), "amount": 4000.01},
        {"timestamp": at(1440), "amount": 10000}, {"timestamp": at(0), "amount": 99,
                                                   "customer_id_hash": "d"}])
    flagged = validate.flag_daily_limit(df, customer="customer_id_hash")
    assert sorted(r[0] for r in flagged.filter("exceeds_daily_limit").select(
        "transaction_id").collect()) == names(0, 1)


def test_gold_ties_and_missing_alerts(transactions, spark):
    df = features.add_features(transactions([
        {"timestamp": at(0), "merchant_category": "B"}, {"timestamp": at(1),
                                                         "merchant_category": "A"},
        {"timestamp": at(2), "merchant_category": "C", "status": "DECLINED"},
        {"timestamp": at(3), "merchant_category": "D"}])).select(
        "*", F.to_date("timestamp").alias("transaction_date"), F.lit("n").alias("merchant_name"),
        "location.country", "location.state", "location.city")
    none = spark.createDataFrame(
        [], "transaction_id string, customer_id_hash string, risk_score double")
    customer = gold.customer_patterns(df, none, "2024-01-02").first()
    assert customer["preferred_merchant_categories"] == ["A", "B", "C"]
    assert (customer["home_city"], customer["risk_profile"], customer["fraud_score"]) == (
        "SF", "LOW", 0.0)
    merchant = gold.merchant_analytics(df, none, "2024-01-02").first()
    assert (merchant["decline_rate"], merchant["fraud_rate"]) == (25.0, 0.0)
    day = gold.daily_summary(df, none).first()
    assert (day["total_transactions"], day["fraud_alerts"], day["median_transaction_amount"]) == (
        4, 0, 10.0)


def test_daily_summary_reads_silver_twice(spark, transactions):
    """Values are counted in one pass over silver; rows without a date, an amount or names count as before."""
    none = spark.createDataFrame([], "transaction_id string, risk_score double")
    df = transactions([
        {"timestamp": "2024-01-01 10:00:00", "amount": 10, "status": "APPROVED", "merchant_id": "a"},
        {"timestamp": "2024-01-01 11:00:00", "amount": 10, "status": "DECLINED", "merchant_id": None},
        {"timestamp": "2024-01-01 12:00:00", "amount": None, "status": None, "customer_id_hash": None},
        {"timestamp": "2024-01-02 12:00:00", "amount": None, "status": "DECLINED", "is_international": True},
        {"timestamp": None, "amount": 7, "status": "APPROVED"},
    ]).withColumn("transaction_date", F.to_date("timestamp"))
    read = spark.sparkContext.accumulator(0)

    def seen(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    watched = df.drop("metadata").mapInPandas(seen, df.drop("metadata").schema)
    rows = {str(r["transaction_date"]): r for r in gold.daily_summary(watched, none).collect()}
    first, second, undated = rows["2024-01-01"], rows["2024-01-02"], rows["None"]
    assert (first["total_transactions"], float(first["total_amount"]), first["unique_customers"],
            first["unique_merchants"]) == (3, 20.0, 1, 2)
    assert (float(first["approved_amount"]), float(first["declined_amount"]), first["approved_transactions"],
            first["declined_transactions"]) == (10.0, 10.0, 1, 1)
    assert first["avg_transaction_amount"] == first["median_transaction_amount"] == 10.0
    assert (second["total_amount"], second["avg_transaction_amount"], second["max_transaction_amount"]) == (
        None, None, None)
    assert (float(second["declined_amount"]), second["international_transactions"]) == (0.0, 1)
    assert (undated["total_transactions"], undated["median_transaction_amount"], undated["fraud_alerts"]) == (1, None, 0)
    assert read.value <= 10
