import json
import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import detect
from ledgerwatch.plans import medallion, standins
from ledgerwatch.session import fresh_dir
from ledgerwatch.sources import messages
from ledgerwatch.sources.commits import Commits
from ledgerwatch.streaming import ids, job, state

SF = "/root/testdata/sf0.001"
WINDOWED = ["velocity_1h", "velocity_6h", "velocity_24h", "amount_zscore",
            "distance_from_last_km", "time_since_last_minutes"]


def new_job(spark):
    root = fresh_dir(spark, "stream")
    return job.Job(f"{root}/tables", f"{root}/checkpoint", as_of=standins.AS_OF), f"{root}/in"


def run(spark, path, j, **options):
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).options(**options).parquet(path)
    q = job.start(standins.events_as_transactions(stream), j, available_now=True)
    q.awaitTermination()
    return q


def by_id(df, columns):
    rounded = [F.round(c, 6).alias(c) if c in WINDOWED[3:] else F.col(c) for c in columns]
    return {r[0]: tuple(r)[1:] for r in df.select("transaction_id", *rounded).collect()}


def add(events, path, low, high):
    events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode(
        "append").parquet(path)


def test_batches_restart_and_duplicates(spark):
    """Four micro-batches with a restart and a redelivered slice give the batch result."""
    j, path = new_job(spark)
    events = spark.read.parquet(f"{SF}/events.parquet")
    for low, high in [(0, 250), (250, 500)]:
        add(events, path, low, high)
        run(spark, path, j)
    add(events, path, 500, 1000)
    run(spark, path, j)
    expected = medallion.silver(standins.txn_events(spark, SF), as_of=standins.AS_OF)
    silver = job.read_table(spark, j, "silver")
    columns = [*WINDOWED, "amount", "status", "transaction_date", "merchant_risk_score"]
    assert by_id(silver, columns) == by_id(expected, columns)
    assert silver.filter("not features_complete").count() == 0
    assert silver.count() == expected.count() == 964
    assert job.read_table(spark, j, "bronze").count() == 1000
    assert job.read_table(spark, j, "quality").count() == 3

    add(events, path, 900, 1000)  # the same messages again
    q = run(spark, path, j)
    again = job.read_table(spark, j, "silver")
    assert again.count() == 964 and again.select("transaction_id").distinct().count() == 964
    assert job.read_table(spark, j, "bronze").count() == 1100
    shown = job.status(spark, [q]).first()
    assert (shown["name"], shown["state"]) == ("transactions", "TERMINATED")


def test_a_replayed_batch_overwrites_itself(spark):
    j, path = new_job(spark)
    events = spark.read.parquet(f"{SF}/events.parquet")
    enriched = medallion.enriched(
        standins.events_as_transactions(events), j.cfg, j.as_of
    ).withColumns({
        "features_complete": F.lit(True), "stream_patterns": F.array().cast("array<string>")})
    write = job.write_batch(j)
    write(enriched, 0)
    write(enriched, 1)  # a redelivery: nothing new for silver
    write(enriched, 1)  # and its replay
    assert job.read_table(spark, j, "silver").count() == 964
    assert job.read_table(spark, j, "bronze").count() == 2000
    ids = job.read_table(spark, j, "alerts").groupBy("alert_id").count()
    assert ids.filter("count > 1").count() == 0


def test_late_rows_are_kept_and_marked(spark):
    j, path = new_job(spark)
    base = dict(customer_id="c", amount="10", merchant_id="m", currency="USD", status="APPROVED")
    rows = lambda ids, minutes: [
        json.dumps({**base, "transaction_id": i, "timestamp": 1704067200000 + 60000 * m})
        for i, m in zip(ids, minutes)]
    stream = lambda: job.from_messages(messages.read_message_files(spark, path, stream=True))

    def feed(lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append").text(path)
        job.start(stream(), j, available_now=True).awaitTermination()

    feed(rows(["a", "b"], [3000, 3010]) + ["{broken"])
    feed(rows(["near", "old"], [2990, 60]))
    got = {r["transaction_id"]: r for r in job.read_table(spark, j, "silver").collect()}
    assert got["b"]["velocity_1h"] == 1 and got["b"]["features_complete"]
    # ten minutes late: exact, sees only what came before it in event time
    assert got["near"]["features_complete"] and got["near"]["velocity_1h"] == 0
    # two days late: kept, marked, window features empty
    assert not got["old"]["features_complete"] and got["old"]["velocity_1h"] is None
    assert job.read_table(spark, j, "quarantine").select("raw").collect()[0]["raw"] == "{broken"
    assert job.read_table(spark, j, "bronze").count() == 4


def test_more_rows_than_the_stored_tail(spark):
    """One busy customer over several batches: the tail is cut, the features stay exact."""
    j, path = new_job(spark)
    events = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("user_id"), F.lit("purchase").alias("event_type"),
        ((F.col("id") * 37 % 101) / 4).alias("value"), F.lit('{"k": 5}').alias("props"))
    for low in range(0, 400, 100):
        add(events, path, low, low + 100)
        run(spark, path, j)
    rows = standins.events_as_transactions(events)
    expected = medallion.silver(rows, as_of=standins.AS_OF)
    assert by_id(job.read_table(spark, j, "silver"), WINDOWED) == by_id(expected, WINDOWED)


def test_late_row_of_a_busy_customer_keeps_its_velocities(spark):
    """300 rows in ten minutes, then one eleven minutes late: the counters know it exactly."""
    j, path = new_job(spark)
    base = dict(customer_id="c", amount="10", merchant_id="m", currency="USD", status="APPROVED")

    def feed(rows):
        lines = [json.dumps({**base, "transaction_id": i, "timestamp": 1704067200000 + 1000 * s})
                 for i, s in rows]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append").text(path)
        stream = job.from_messages(messages.read_message_files(spark, path, stream=True))
        job.start(stream, j, available_now=True).awaitTermination()

    feed([(f"a{i:03d}", 8000 + 2 * i) for i in range(300)])
    feed([("late", 8000 - 60), ("next", 8700)])
    got = {r["transaction_id"]: r for r in job.read_table(spark, j, "silver").collect()}
    assert got["late"]["velocity_1h"] == 0 and got["late"]["features_complete"]
    assert got["next"]["velocity_1h"] == 301
    rows = messages.parse_transactions(messages.read_message_files(spark, path))
    fixed = {r["transaction_id"]: r for r in medallion.refill(
        job.read_table(spark, j, "silver"), rows, as_of=j.as_of).collect()}
    assert fixed["a000"]["velocity_1h"] == 1 and fixed["a299"]["velocity_1h"] == 300


def test_alerts_go_to_a_topic_too(spark, monkeypatch):
    import dataclasses

    sent = []
    monkeypatch.setattr(messages, "publish", lambda df, servers, topic, key: sent.append(
        (messages.as_messages(df, key).collect(), servers, topic)))
    j, _ = new_job(spark)
    j = dataclasses.replace(j, alert_servers="broker:9092", alert_topic="fraud-alerts")
    events = spark.read.parquet(f"{SF}/events.parquet")
    enriched = medallion.enriched(
        standins.events_as_transactions(events), j.cfg, j.as_of
    ).withColumns({
        "features_complete": F.lit(True), "stream_patterns": F.array().cast("array<string>")})
    job.write_batch(j)(enriched, 0)
    (rows, servers, topic), = sent
    stored = job.read_table(spark, j, "alerts")
    assert (servers, topic, len(rows)) == ("broker:9092", "fraud-alerts", stored.count()) and rows
    assert {json.loads(r["value"])["alert_id"] for r in rows} == {
        r["alert_id"] for r in stored.select("alert_id").collect()}
    assert {r["key"] for r in rows} <= {r["transaction_id"] for r in stored.collect()}


def test_progress_log(spark):
    j, path = new_job(spark)
    add(spark.read.parquet(f"{SF}/events.parquet"), path, 0, 50)
    log = fresh_dir(spark, "progress")
    listener = job.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        run(spark, path, j)
        for _ in range(60):
            try:
                rows = spark.read.parquet(log).collect()
                break
            except Exception:
                import time
                time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert rows[0]["batch_id"] == 0 and rows[0]["input_rows"] == 50


def test_watermark_dedup(spark):
    path, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")
    events = spark.read.parquet(f"{SF}/events.parquet")
    add(events, path, 0, 50)
    add(events, path, 0, 50)
    stream = spark.readStream.schema(events.schema).parquet(path)
    unique = job.drop_duplicates_within_watermark(standins.events_as_transactions(stream))
    unique.select("transaction_id").writeStream.format("parquet").option(
        "checkpointLocation", f"{out}/c").option("path", f"{out}/t").trigger(
        availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{out}/t").count() == 50


@pytest.mark.parametrize("value", [None, ""])
def test_unknown_customers_take_no_state(spark, value):
    j, path = new_job(spark)
    message = json.dumps({"transaction_id": "x", "timestamp": 1704067200000, "customer_id": value,
                          "amount": "1", "merchant_id": "m", "status": "APPROVED"})
    spark.createDataFrame([(message,)], "value string").write.text(path)
    stream = job.from_messages(messages.read_message_files(spark, path, stream=True))
    job.start(stream, j, available_now=True).awaitTermination()
    silver = job.read_table(spark, j, "silver").collect()
    if value == "":
        assert silver[0]["customer_id_hash"] == "UNKNOWN" and silver[0]["velocity_1h"] is None
    else:
        assert silver == []  # a missing customer fails the quality filter
    assert job.read_table(spark, j, "bronze").count() == 1


def test_patterns_over_batches_equal_the_batch_run(spark):
    """Three batches in time order, thresholds under which every pattern fires."""
    from ledgerwatch.plans import catalog

    j, path = new_job(spark)
    j = replace(j, cfg=replace(j.cfg, detectors=catalog.EVENT_DETECTORS))
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.col("user_id") % 9)
    for number in range(3):
        part = F.least(F.floor((F.dayofmonth("ts") - 1) / 11), F.lit(2))
        events.filter(part == number).coalesce(1).write.mode("append").parquet(path)
        run(spark, path, j)
    silver = medallion.silver(standins.events_as_transactions(events), as_of=standins.AS_OF)
    columns = ["alert_id", "transaction_id", "alert_type", "severity", "risk_score", "rules_triggered"]
    want = medallion.silver_alerts(silver, j.cfg, standins.AS_OF).select(columns).collect()
    got = job.read_table(spark, j, "alerts").select(columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    fired = {p for r in want for p in r["rules_triggered"]}
    assert set(detect.PATTERNS) <= fired


def test_a_busy_customer_in_nodes_and_blocks():
    """Inline parts of eight entries: everything else comes from nodes and blocks."""
    from ledgerwatch.streaming import timeline

    class Map(dict):
        def put(self, k, v):
            self[k] = v

        def remove(self, k):
            self.pop(k, None)

    rng = random.Random(4)
    rows, nodes = [], Map()
    parts = ([], [], [], [])
    now = 10 ** 9
    for _ in range(60):
        line = timeline.Timeline(2, nodes, *parts, inline=8)
        secs = [now + rng.randrange(-7000, 9000) for _ in range(rng.randrange(1, 30))]
        values = [[1, rng.randrange(-50, 50)] for _ in secs]
        rows += list(zip(secs, values))
        now += rng.choice([10, 5000, 200_000])
        line.add(secs, values)
        for span in (0, 60, 3600, 86400, 30 * 86400):
            got = line.trailing(secs, span).tolist()
            want = [[sum(v[k] for s, v in rows if t - span <= s <= t) for k in (0, 1)] for t in secs]
            assert got == want
        line.settle(now - 31 * 86400 - 7200)
        parts = (line.secs.tolist(), line.sums.ravel().tolist(), line.days.tolist(),
                 line.day_sums.ravel().tolist())
        assert len(parts[0]) <= 8 and len(parts[2]) <= 33
    assert {k for k in nodes if k[0] == timeline.DAY} == {(timeline.DAY, d) for d in parts[2]}

    held, blocks, at = [], Map(), ([], [])
    for _ in range(60):
        recent = timeline.Recent(blocks, *at, inline=8)
        fresh = [((now + rng.randrange(3000)) * 1_000_000, f"i{rng.random()}", "m", 5, True) for _ in range(9)]
        recent.add(fresh)
        held += fresh
        now += rng.choice([10, 700])
        got = recent.between(now - 3600, now)
        assert got == sorted(r for r in held if now - 3600 <= r[0] // 10 ** 6 <= now)
        recent.settle(now - 4000)
        at = (recent.rows, sorted(recent.blocks))
        assert len(recent.rows) <= 8
    assert len(blocks) < 12


def test_what_a_batch_writes_follows_its_rows():
    """A new row of a customer with a long history writes a few nodes, not the history."""
    from ledgerwatch.streaming import timeline

    class Counting(dict):
        written = 0

        def put(self, k, v):
            self[k] = v
            self.written += len(v[0]) * 8

        def remove(self, k):
            self.pop(k, None)

    store, parts, sizes = Counting(), ([], [], [], []), []
    for batch in range(300):  # 200 rows an hour for 12 days
        line = timeline.Timeline(1, store, *parts)
        line.add(range(batch * 3600, batch * 3600 + 3600, 18), [[1]] * 200)
        before = store.written
        line.settle(0)
        sizes.append(store.written - before)
        parts = (line.secs, line.sums, line.days, line.day_sums)
    assert max(sizes[200:]) <= 2 * max(sizes[:20])


def test_a_fresh_checkpoint_adds_to_old_tables(spark):
    """Ids are unique across dates, batches and checkpoints; nothing is overwritten."""
    j, path = new_job(spark)
    events = spark.read.parquet(f"{SF}/events.parquet")
    add(events, path, 0, 500)
    run(spark, path, j)
    later = replace(j, checkpoint=f"{j.checkpoint}-2")
    # The first rows once more, 20 days later, and new ones.
    moved = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 20 DAYS"))
    second = f"{path}-2"
    add(moved, second, 0, 100)
    add(events, second, 500, 1000)
    before = by_id(job.read_table(spark, j, "silver"), WINDOWED)
    run(spark, second, later)
    silver = job.read_table(spark, j, "silver")
    assert silver.count() == 964 == silver.select("transaction_id").distinct().count()
    after = by_id(silver, WINDOWED)
    assert before.items() <= after.items() and len(before) < len(after)
    assert job.read_table(spark, j, "bronze").count() == 1100
    assert job.read_table(spark, j, "quality").count() == 2


def test_a_batch_that_dies_before_its_commit_shows_nowhere(spark, monkeypatch):
    from ledgerwatch.operators import monitor

    j, _ = new_job(spark)
    events = spark.read.parquet(f"{SF}/events.parquet")
    enriched = medallion.enriched(standins.events_as_transactions(events), j.cfg, j.as_of).withColumns(
        {"features_complete": F.lit(True), "stream_patterns": F.array().cast("array<string>")})
    write = job.write_batch(j)
    write(enriched.filter("kafka_offset < 100"), 0)

    def broken(*_, **__):
        raise RuntimeError("killed")

    shown = {t: job.read_table(spark, j, t).count() for t in job.TABLES}
    with monkeypatch.context() as m:
        m.setattr(monitor, "batch_summary", broken)
        with pytest.raises(RuntimeError):
            write(enriched, 1)
    assert {t: job.read_table(spark, j, t).count() for t in job.TABLES} == shown
    write(enriched, 1)
    assert job.read_table(spark, j, "silver").count() == 964


def test_compaction_bounds_files_and_keeps_rows(spark):
    j, _ = new_job(spark)
    j = replace(j, compact_every=2, most_folders=1)
    events = spark.read.parquet(f"{SF}/events.parquet")
    enriched = medallion.enriched(standins.events_as_transactions(events), j.cfg, j.as_of).withColumns(
        {"features_complete": F.lit(True), "stream_patterns": F.array("merchant_id")}).persist()
    write = job.write_batch(j)
    for b, own in enumerate(["kafka_offset < 400", "kafka_offset > 300", "kafka_offset BETWEEN 300 AND 420"]):
        write(enriched.filter(own), b)
    commits = Commits(spark, j.root)
    folders = commits.state().folders
    assert all(len(f) <= 1 + 2 for f in folders.values()) and "ids_packed" in folders
    silver = job.read_table(spark, j, "silver")
    assert silver.count() == 964 == silver.select("transaction_id").distinct().count()
    job.maintain(spark, replace(j, most_folders=1), keep_versions=0)
    assert job.read_table(spark, j, "silver").count() == 964
    live = {f for t, fs in commits.state().folders.items() for f in (f"{t}/{x}" for x in fs)}
    there = {f"{t}/{run_}/{b}" for t in commits.state().folders for run_, _ in commits.files.names(t)
             for b, _ in commits.files.names(t, run_)}
    assert there == live


def test_untouched_buckets_of_ids_are_not_read(spark):
    j, _ = new_job(spark)
    commits = Commits(spark, j.root)

    def put(batch):
        def write(df, table):
            df.write.parquet(f"{j.root}/{table}/run=r/batch_id={batch}")
            commits.commit({"add": {table: [f"run=r/batch_id={batch}"]}})
        return write

    for b in range(3):
        ids.write(put(b), spark.range(b * 500, b * 500 + 500).selectExpr("concat('t', id) AS transaction_id"))
    assert ids.compact(commits, most_folders=1)
    state = commits.state()
    new = spark.range(5000, 5400).selectExpr("concat('t', id) AS transaction_id")
    assert ids.repeated(commits, state, new).count() == 0
    some = spark.createDataFrame([("t7",), ("t1499",), ("u1",), (None,)], "transaction_id string")
    found = ids.repeated(commits, state, some)
    assert {r[0] for r in found.collect()} == {"t7", "t1499"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    want = sorted(r.bucket for r in ids.with_bucket(some.filter("transaction_id LIKE 't%'")).collect())
    filters = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
    assert any(all(str(b) in f for b in want) and "bucket" in f for f in filters)


def test_the_log_folds_and_refuses_taken_numbers(spark):
    j, _ = new_job(spark)
    commits = Commits(spark, j.root, fold_every=4)
    for i in range(11):
        commits.commit({"run": "a", "batch": i, "add": {"t": [f"f{i}"]}})
    commits.commit({"remove": {"t": ["f0", "f1"]}, "add": {"t": ["g"]}})
    state = commits.state()
    assert state.folders["t"] == [*[f"f{i}" for i in range(2, 11)], "g"] and state.batches == {"a": 10}
    assert len(commits.files.names(commits.LOG)) <= 6
    assert commits.files.create("x", commits.LOG, f"{state.version:012d}.json") is False
    assert commits.commit(lambda s: None).version == state.version


def test_parts_of_the_late_stream_have_equally_many_files(spark, tmp_path, monkeypatch):
    from ledgerwatch.plans import catalog, standins
    monkeypatch.setattr(standins, "SEGMENT_OFFSETS", 10)
    # 140 rows in the first 16 days, none in the third part but late ones, none in the others
    events = spark.range(1, 141).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") % 16).cast("int"))).alias("ts"))
    assert catalog._late_parts(events, f"{tmp_path}/in") == 3
    found = sorted(tmp_path.glob("in/*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    sizes = [spark.read.schema(events.schema).parquet(*map(str, found[i:i + 3])).count() for i in range(0, 15, 3)]
    assert len(found) == 15 and sizes[0] + sizes[1] + sizes[2] == 140 and sizes[3:] == [0, 0]


def test_a_row_is_carried_as_one_text(spark):
    kind = "a string, m map<string,string>, s struct<x: double, t: timestamp>, d decimal(10,2)"
    rows = [("x\x01b\x02\x01", {"k\x02": "\x01a", "n": None}, (1.5, None), Decimal("1.20")),
            (None, {}, None, None), ("", None, (None, None), Decimal("-3")), ("n", {"": ""}, None, None)]
    df = spark.createDataFrame(rows, kind)
    packed = df.select(state._packed(df).alias("packed_row"))
    assert dict(packed.dtypes) == {"packed_row": "string"}
    back = packed.withColumn("_texts", F.split("packed_row", state.SEPARATOR)).select(*state._unpacked(df.schema))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert back.collect() == df.collect()


def test_one_call_handles_the_customers_of_a_group(spark, monkeypatch):
    """Customers that share a group keep their own histories over batches, and a day's rows lie in few files."""
    monkeypatch.setattr(state, "GROUPS", 1)
    j, path = new_job(spark)
    events = spark.read.parquet(f"{SF}/events.parquet").filter("user_id is not null")
    for low, high in [(0, 500), (500, 1000)]:
        add(events, path, low, high)
        run(spark, path, j)
    silver = job.read_table(spark, j, "silver")
    expected = medallion.silver(standins.txn_events(spark, SF), as_of=standins.AS_OF)
    columns = [*WINDOWED, "amount", "customer_id_hash"]
    assert by_id(silver, columns) == by_id(expected, columns)
    assert silver.filter("not features_complete").count() == 0


def test_a_batch_is_written_with_adaptive_plans(spark):
    """Its files follow its rows, not the number of shuffle partitions; the stream's setting comes back."""
    j, _ = new_job(spark)
    rows = medallion.enriched(
        standins.events_as_transactions(spark.read.parquet(f"{SF}/events.parquet").filter("event_id < 40")), j.cfg,
        j.as_of).withColumns({"features_complete": F.lit(True), "stream_patterns": F.array().cast("array<string>")})
    own = rows.sparkSession
    before = {c: own.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        own.conf.set("spark.sql.adaptive.enabled", "false")
        own.conf.set("spark.sql.shuffle.partitions", "64")
        job.write_batch(j)(rows, 0)
        assert own.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        for c, v in before.items():
            own.conf.set(c, v)
    silver = job.read_table(spark, j, "silver")
    days = silver.select("transaction_date").distinct().count()
    assert silver.count() > 30 and len(silver.inputFiles()) < 12 * days
