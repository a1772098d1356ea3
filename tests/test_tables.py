import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerwatch.operators import stats
from ledgerwatch.plans import medallion, standins
from ledgerwatch.session import fresh_dir
from ledgerwatch.sources import tables


def name():
    return "t_" + uuid.uuid4().hex


def test_medallion_takes_what_the_pipeline_makes(spark):
    prefix = name() + "_"
    made = tables.create_medallion(spark, prefix)
    assert len(made) == 6 and tables.create_medallion(spark, prefix) == made
    rows = standins.txn_events(spark, "/root/testdata/sf0.001")
    silver = medallion.silver(rows, as_of=standins.AS_OF)
    target = spark.table(f"{prefix}silver.transactions_clean")
    assert set(target.columns) == set(silver.columns)
    silver.select(target.columns).write.insertInto(f"{prefix}silver.transactions_clean")
    assert spark.table(f"{prefix}silver.transactions_clean").count() == 964
    bronze = medallion.bronze(rows).withColumn("ingest_date", F.to_date("ingested_at"))
    bronze.write.insertInto(f"{prefix}bronze.transactions_raw")
    one_day = spark.table(f"{prefix}bronze.transactions_raw").filter(
        "ingest_date = DATE'2024-01-05'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_bulk_load_modes(spark):
    table, df = name(), spark.range(10)
    tables.bulk_load(df, table, "fail")
    tables.bulk_load(df, table, "append", rows_per_file=3)
    assert spark.table(table).count() == 20
    with pytest.raises(AnalysisException):
        tables.bulk_load(df, table, "fail")
    tables.bulk_load(df, table, "replace")
    assert spark.table(table).count() == 10


def test_upsert_whole_table_and_touched_partitions(spark):
    table = name()
    spark.sql(f"""CREATE TABLE {table} (id INT, v STRING, updated_at TIMESTAMP, day DATE)
                  USING parquet PARTITIONED BY (day)""")
    spark.sql(f"""INSERT INTO {table} VALUES
        (1, 'a', TIMESTAMP'2024-01-01', DATE'2024-01-01'),
        (2, 'b', TIMESTAMP'2024-01-01', DATE'2024-01-01'),
        (3, 'c', TIMESTAMP'2024-01-01', DATE'2024-01-02')""")
    source = spark.sql("""SELECT * FROM VALUES (2, 'B', DATE'2024-01-01'),
        (4, 'D', DATE'2024-01-01') AS t(id, v, day)""")
    tables.upsert(spark, table, source, ["id"], partition="day")
    rows = {r["id"]: r for r in spark.table(table).collect()}
    assert {i: r["v"] for i, r in rows.items()} == {1: "a", 2: "B", 3: "c", 4: "D"}
    assert rows[1]["updated_at"].year == 2024 and rows[1]["updated_at"].month == 1
    assert rows[2]["updated_at"] > rows[1]["updated_at"]
    assert rows[4]["updated_at"] is not None
    tables.upsert(spark, table, source.withColumn("v", F.lit("Z")), ["id"], ["day"])
    assert {r["id"]: r["v"] for r in spark.table(table).collect()} == {
        1: "a", 2: "B", 3: "c", 4: "D"}


def test_upsert_matches_null_keys(spark):
    t = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'n') AS t(id, v)")
    s = spark.sql("SELECT * FROM VALUES (NULL, 'N'), (2, 'b') AS t(id, v)")
    got = {r["id"]: r["v"] for r in tables.merge_frames(t, s, ["id"]).collect()}
    assert got == {1: "a", None: "N", 2: "b"}


def test_export_writes_one_audit_row(spark):
    audit, path = name(), fresh_dir(spark, "export")
    tables.export(spark.range(7), path, "ann", audit)
    row = spark.table(audit).first()
    assert (row["row_count"], row["user_id"], row["event_type"]) == (7, "ann", "DATA_EXPORT")
    assert spark.read.parquet(path).count() == 7


def test_clustered_layout_keeps_rows(spark):
    df = spark.range(1000).select(
        F.to_date(F.lit("2024-01-01")).alias("d"), (F.col("id") % 7).alias("c"))
    assert tables.clustered(df, "d", "c").groupBy("c").count().count() == 7


def test_sql_parameters_and_stats(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("a", 5.0)], "customer_id string, amount double")
    got = tables.run_sql(spark, "SELECT sum(amount) s FROM v WHERE customer_id = :c", {"c": "a"},
                         v=df).first()["s"]
    assert got == 6.0
    row = stats.table_stats(df.withColumn("timestamp", F.lit(1))).first()
    assert (row["row_count"], row["unique_customers"], row["total_amount"]) == (3, 2, 9.0)
    near = stats.table_stats(df.withColumn("timestamp", F.lit(1)), approximate=True).first()
    assert near["unique_customers"] == 2
