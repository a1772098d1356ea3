import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import gold, increments
from ledgerwatch.session import fresh_dir
from ledgerwatch.sources import tables
from ledgerwatch.sources.snapshots import SnapshotTable

DDL = "id long, name string, n int, updated_at timestamp"


@pytest.fixture
def table(spark):
    out = SnapshotTable(spark, fresh_dir(spark, "snapshot"), DDL, ["id"], buckets=8)
    out.replace(rows(spark, [(i, f"n{i}", i) for i in range(200)]))
    return out


def rows(spark, data):
    return spark.createDataFrame(data, "id long, name string, n int").withColumn(
        "updated_at", F.lit("2024-01-01").cast("timestamp"))


def content(df):
    return sorted(map(tuple, df.select("id", "name", "n").collect()), key=str)


def test_upsert_rewrites_the_buckets_of_its_keys(spark, table):
    source = rows(spark, [(3, "new", 33), (900, "added", 1), (None, "no key", 2)])
    want = content(tables.merge_frames(table.read(), source, ["id"], ["n"]))
    before = set(table.commits.state().folders["data"])
    touched = table.upsert(source, ["n"])
    after = set(table.commits.state().folders["data"])
    assert content(table.read()) == want and table.versions() == 2
    assert {f.split("bucket=")[1] for f in before - after} <= {str(b) for b in touched}
    assert len(before & after) == 8 - len(touched) and len(touched) <= 3
    assert table.upsert(source.limit(0)) == []


def test_a_killed_upsert_leaves_the_old_version(spark, table, monkeypatch):
    before = content(table.read())

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(table.commits, "commit", killed)
        with pytest.raises(RuntimeError):
            table.upsert(rows(spark, [(3, "new", 33)]))
    assert content(table.read()) == before and table.versions() == 1
    table.upsert(rows(spark, [(3, "new", 33)]))
    assert (3, "new", 33) in content(table.read())
    assert table.vacuum(keep_versions=0) and (3, "new", 33) in content(table.read())


def test_two_writers_of_one_bucket_lose_no_row(spark, table, monkeypatch):
    other = SnapshotTable(spark, table.commits.root, DDL, ["id"], buckets=8)
    write, calls = table._write, []

    def overtaken(df):
        out = write(df)
        if not calls:
            calls.append(1)
            other.upsert(rows(spark, [(3, "other", 1), (1003, "other", 2)]))
        return out

    monkeypatch.setattr(table, "_write", overtaken)
    table.upsert(rows(spark, [(3, "mine", 5)]))
    got = content(table.read())
    assert (3, "mine", 5) in got and (1003, "other", 2) in got and len(got) == 201


SILVER = ("transaction_id string, customer_id_hash string, merchant_id string, merchant_name string, "
          "merchant_category string, channel string, hour_of_day int, country string, state string, "
          "city string, amount decimal(10,2), status string, is_international boolean, is_weekend boolean, "
          "merchant_risk_score double, transaction_date date")


def silver(spark, low, high):
    import datetime
    from decimal import Decimal

    data = [(f"t{i}", f"c{i % 7}" if i % 11 else None, f"m{i % 5}" if i % 13 else None, f"name{i % 3}", f"k{i % 4}",
             ["WEB", "POS", None][i % 3], i % 24, "US", f"s{i % 2}" if i % 6 else None, f"y{i % 3}",
             Decimal(i % 90) if i % 8 else None, ["APPROVED", "DECLINED"][i % 2], i % 5 == 0, None if i % 9 == 0 else i % 2 == 0,
             (i % 10) / 10, datetime.date(2024, 1, 1 + i % 28)) for i in range(low, high)]
    return spark.createDataFrame(data, SILVER)


def alerts(df, every):
    return df.filter(F.crc32(F.col("transaction_id").cast("binary")) % every == 0).selectExpr(
        "transaction_id", "customer_id_hash", "(crc32(cast(transaction_id AS binary)) % 100) / 100.0D AS risk_score")


@pytest.mark.parametrize("kind", ["customer", "merchant"])
def test_increments_equal_the_full_run(spark, kind):
    r = increments.Refresh(fresh_dir(spark, "refresh"), kind, most_folders=1)
    full = gold.customer_patterns if kind == "customer" else gold.merchant_analytics
    every = silver(spark, 0, 300).persist()
    fired = alerts(every, 5)
    for batch, (low, high) in enumerate([(100, 200), (0, 100), (200, 300)]):  # the second is late
        new = silver(spark, low, high)
        own = alerts(new, 5)
        alerted = new.join(own, "transaction_id", "left_semi").select("transaction_id", "merchant_id")
        assert increments.refresh(spark, r, "run", batch, new, own, alerted, "2024-02-01")
        assert not increments.refresh(spark, r, "run", batch, new, own, alerted, "2024-02-01")
        if batch == 1:
            assert increments.compact(spark, r)
    want = full(every, fired, "2024-02-01")
    got = increments.read(spark, r).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_refresh_writes_gold_rows_of_its_keys_only(spark):
    r = increments.Refresh(fresh_dir(spark, "refresh"), "merchant", "sketch")
    none = alerts(silver(spark, 0, 1), 10 ** 9)
    nobody = none.selectExpr("transaction_id", "'m' AS merchant_id")
    increments.refresh(spark, r, "run", 0, silver(spark, 0, 260), none, nobody, "2024-02-01")
    one = silver(spark, 260, 400).filter("merchant_id = 'm1'")
    increments.refresh(spark, r, "run", 1, one, none, nobody, "2024-02-01")
    stored = spark.read.parquet(f"{r.root}/gold/run=run/batch_id=1").collect()
    assert [x.merchant_id for x in stored] == ["m1"]
    exact = silver(spark, 0, 260).unionAll(one).filter("merchant_id = 'm1'").selectExpr(
        "count(DISTINCT customer_id_hash)", "count(*)").first()
    assert (stored[0].unique_customers, stored[0].total_transactions) == tuple(exact)
