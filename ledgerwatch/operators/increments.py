"""Customer and merchant gold kept up to date from partial aggregates.

A batch of silver rows is reduced to partials that can be added up: sums and extremes per key, and counts
per (key, kind, value) for top lists, most frequent places and exact distinct customers.  Partials are
appended, never rewritten; a compaction adds them up.  Then the gold rows of the keys that the batch
touches are made from all their partials and appended with a version; readers take the last version of
a key.  So a refresh costs the batch and the partials of its keys, not the history.

Partials and gold rows of a batch show in one commit, named by run and batch: a repeated batch is left
alone.  The results are those of ``gold.customer_patterns`` and ``gold.merchant_analytics`` over all rows.
``distinct="sketch"`` counts customers by mergeable sketches, with an error of about 2 %.
"""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.operators.features import CUSTOMER
from ledgerwatch.operators.gold import MONEY, TOP, parts_of
from ledgerwatch.sources.commits import Commits

BUCKETS = 64
PLACE = ["country", "state", "city"]
TOTALS = {  # name -> (type, how it adds up)
    "customer": {"n": ("long", "sum"), "money": ("decimal(28,2)", "sum"), "n_money": ("long", "sum"),
                 "n_abroad": ("long", "sum"), "n_weekend": ("long", "sum"), "last": ("date", "max"),
                 "risk": ("double", "max")},
    "merchant": {"n": ("long", "sum"), "money": ("decimal(28,2)", "sum"), "n_money": ("long", "sum"),
                 "n_declined": ("long", "sum"), "n_alerted": ("long", "sum"), "risk": ("double", "max"),
                 "name": ("string", "min"), "sketch": ("binary", "sketch")},
}
GOLD = {
    "customer": f"total_transactions long, total_amount {MONEY}, avg_transaction_amount double, "
                "international_transaction_pct double, weekend_transaction_pct double, "
                "last_transaction_date date, preferred_merchant_categories array<string>, "
                "preferred_channels array<string>, typical_transaction_hours array<string>, "
                "home_country string, home_state string, home_city string, fraud_score double, "
                "risk_profile string, analysis_date date",
    "merchant": f"total_transactions long, total_amount {MONEY}, unique_customers long, "
                "avg_transaction_amount double, decline_rate double, risk_score double, "
                "merchant_name string, merchant_category string, country string, state string, "
                "city string, fraud_rate double, analysis_date date",
}
KEY = {"customer": CUSTOMER, "merchant": "merchant_id"}
HOW = {"sum": F.sum, "max": F.max, "min": F.min, "sketch": F.hll_union_agg}

@dataclass(frozen=True)
class Refresh:
    root: str
    kind: str  # customer or merchant
    distinct: str = "exact"  # or sketch; of a merchant's customers
    most_folders: int = 8

    def totals_schema(self):
        return "key string, bucket int, " + ", ".join(
            f"{n} {t}" for n, (t, _) in TOTALS[self.kind].items()) + ", batch_id long"

    def values_schema(self):
        return "key string, bucket int, kind string, value array<string>, n long, batch_id long"

    def gold_schema(self):
        return f"{KEY[self.kind]} string, bucket int, version long, {GOLD[self.kind]}, batch_id long"


def _bucketed(rows):
    return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


def _totals(r, parts, alerts, alerted):
    """Partials of a batch, one row per key, part and source."""
    kind = TOTALS[r.kind]
    if r.kind == "customer":
        own = lambda rows: rows.groupBy("key").agg(
            F.count("*").alias("n"), F.sum("amount").alias("money"), F.count("amount").alias("n_money"),
            F.count_if("is_international").alias("n_abroad"), F.count_if("is_weekend").alias("n_weekend"),
            F.max("transaction_date").alias("last"))
        more = alerts.filter(F.col(CUSTOMER).isNotNull()).groupBy(F.col(CUSTOMER).alias("key")).agg(
            F.max("risk_score").alias("risk"))
    else:
        sketch = [F.hll_sketch_agg(CUSTOMER).alias("sketch")] if r.distinct == "sketch" else []
        own = lambda rows: rows.groupBy("key").agg(
            F.count("*").alias("n"), F.sum("amount").alias("money"), F.count("amount").alias("n_money"),
            F.count_if(F.col("status") == "DECLINED").alias("n_declined"),
            F.max("merchant_risk_score").alias("risk"), F.min("merchant_name").alias("name"), *sketch)
        more = alerted.filter(F.col("merchant_id").isNotNull()).groupBy(F.col("merchant_id").alias("key")).agg(
            F.count("*").alias("n_alerted"))
    every = reduce(DataFrame.unionByName, map(own, parts)).unionByName(more, allowMissingColumns=True)
    return every.select("key", *[
        (F.col(n) if n in every.columns else F.lit(None)).cast(t).alias(n) for n, (t, _) in kind.items()])


def _values(r, rows):
    """(key, kind, value, n) of a part of a batch: every counted value, in one pass over its rows."""
    text = F.array  # values are arrays of text: one entry, or the parts of a place
    if r.kind == "customer":
        kinds = {
            "preferred_merchant_categories": text("merchant_category"), "preferred_channels": text("channel"),
            "typical_transaction_hours": text(F.lpad(F.col("hour_of_day").cast("string"), 2, "0")),
            "place": text(*PLACE)}
    else:
        kinds = {"place": text("merchant_category", *PLACE)}
        if r.distinct == "exact":
            kinds["customers"] = text(CUSTOMER)
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])
    return rows.select("key", F.explode(pairs).alias("p")).select("key", "p.*").filter(
        "kind = 'place' OR value[0] IS NOT NULL").groupBy("key", "kind", "value").agg(F.count("*").alias("n"))


def _summed(r, parts, table):
    """Partials added up."""
    if table == "values":
        return parts.groupBy("key", "bucket", "kind", "value").agg(F.sum("n").alias("n"))
    return parts.groupBy("key", "bucket").agg(*[
        HOW[how](n).cast(kind).alias(n) for n, (kind, how) in TOTALS[r.kind].items()])


def _gold(r, totals, values, analysis_date):
    """Gold rows from summed partials; keys without transactions have none."""
    n = F.col("n")
    best = values.filter("kind = 'place'").groupBy("key").agg(
        F.min(F.struct((-n).alias("m"), F.col("value").alias("v"))).alias("b")).select("key", "b.v")
    mean = F.col("money").cast("double") / F.col("n_money")
    common = [F.col("key").alias(KEY[r.kind]), n.alias("total_transactions"),
              F.col("money").cast(MONEY).alias("total_amount"), mean.alias("avg_transaction_amount")]
    day = F.lit(analysis_date).cast("date").alias("analysis_date")
    rows = totals.filter("n > 0").join(best, "key", "left")
    if r.kind == "merchant":
        if r.distinct == "exact":
            rows = rows.join(values.filter("kind = 'customers'").groupBy("key").agg(
                F.count("*").alias("customers")), "key", "left")
            customers = F.coalesce("customers", F.lit(0))
        else:
            customers = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0))
        part = [F.col("v")[i].alias(c) for i, c in enumerate(["merchant_category", *PLACE])]
        return rows.select(
            *common, customers.cast("long").alias("unique_customers"),
            (F.col("n_declined") * 100.0 / n).alias("decline_rate"), F.col("risk").alias("risk_score"),
            F.col("name").alias("merchant_name"), *part,
            (F.coalesce("n_alerted", F.lit(0)) * 100.0 / n).alias("fraud_rate"), day)
    lists = ["preferred_merchant_categories", "preferred_channels", "typical_transaction_hours"]
    order = Window.partitionBy("key", "kind").orderBy(F.desc("n"), "value")
    tops = values.filter("kind <> 'place'").withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= TOP).groupBy("key").agg(*[
            F.transform(F.array_sort(F.collect_list(F.when(
                F.col("kind") == k, F.struct("rank", F.col("value")[0].alias("x"))))), lambda e: e["x"]).alias(k)
            for k in lists])
    score = F.coalesce("risk", F.lit(0.0))
    return rows.join(tops, "key", "left").select(
        *common, (F.col("n_abroad") * 100.0 / n).alias("international_transaction_pct"),
        (F.col("n_weekend") * 100.0 / n).alias("weekend_transaction_pct"),
        F.col("last").alias("last_transaction_date"), *lists,
        *[F.col("v")[i].alias(f"home_{c}") for i, c in enumerate(PLACE)], score.alias("fraud_score"),
        F.when(score >= 0.6, "HIGH").when(score >= 0.3, "MEDIUM").otherwise("LOW").alias("risk_profile"), day)


def refresh(spark, r, run, batch, rows, alerts, alerted, analysis_date):
    """Take a batch into the gold table of ``r``; False if it was taken before.

    ``rows`` are its new silver rows, in one frame or in parts (partials of parts add up like those of
    batches, so a part in buckets of customers needs no shuffle for its customers); ``alerts`` its new alerts, ``alerted`` the transactions
    (transaction_id, merchant_id), new or old, that have an alert since this batch.
    """
    commits = Commits(spark, r.root)
    state = commits.state()
    if state.batches.get(run, -1) >= batch:
        return False
    folder = f"run={run}/batch_id={batch}"
    keyed = [part.withColumn("key", F.col(KEY[r.kind]).cast("string")).filter("key IS NOT NULL")
             for part in parts_of(rows)]
    schemas = {"totals": r.totals_schema(), "values": r.values_schema()}
    made = {"totals": _totals(r, keyed, alerts, alerted), "values": reduce(
        DataFrame.unionByName, [_values(r, part) for part in keyed])}
    added = {}
    for table, part in made.items():
        _bucketed(part).sortWithinPartitions("bucket", "key").write.mode("overwrite").parquet(
            f"{r.root}/{table}/{folder}")
        added[table] = [folder]
    now = {t: commits.read_folders(t, schemas[t], [folder]) for t in made}
    touched = now["totals"].select("key").unionAll(now["values"].select("key")).distinct()
    buckets = [x[0] for x in now["totals"].select("bucket").distinct().collect()]  # at most BUCKETS

    def of_touched(table):
        old = commits.read(table, schemas[table], state).filter(F.col("bucket").isin(buckets))
        return _summed(r, old.unionByName(now[table]).join(touched, "key", "left_semi"), table)

    gold = _gold(r, of_touched("totals"), of_touched("values"), analysis_date)
    gold = gold.withColumns({"version": F.lit(state.version + 1).cast("long"), "bucket": F.pmod(
        F.xxhash64(KEY[r.kind]), F.lit(BUCKETS)).cast("int")})
    gold.write.mode("overwrite").parquet(f"{r.root}/gold/{folder}")
    commits.commit({"run": run, "batch": batch, "add": {**added, "gold": [folder]}})
    return True


def read(spark, r, state=None):
    """The gold table: the last version of every key."""
    commits = Commits(spark, r.root)
    rows = commits.read("gold", r.gold_schema(), state)
    key, rest = KEY[r.kind], [c for c in rows.columns if c not in (KEY[r.kind], "bucket", "batch_id")]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("x"))
    return last.select(key, "x.*").drop("version")


def compact(spark, r):
    """Add up the partials and keep the last gold rows, in one commit; False if there are few folders."""
    commits = Commits(spark, r.root)
    state = commits.state()
    old = {t: list(state.folders.get(t, [])) for t in ("totals", "values", "gold")}
    if len(old["totals"]) <= r.most_folders:
        return False
    name = f"run=compacted-{uuid.uuid4().hex[:12]}/batch_id=-1"
    for table, schema in (("totals", r.totals_schema()), ("values", r.values_schema())):
        _summed(r, commits.read(table, schema, state), table).hint("rebalance", "bucket").sortWithinPartitions(
            "bucket", "key").write.parquet(f"{r.root}/{table}/{name}")
    last = read(spark, r, state).withColumns({
        "version": F.lit(state.version).cast("long"),
        "bucket": F.pmod(F.xxhash64(KEY[r.kind]), F.lit(BUCKETS)).cast("int")})
    last.write.parquet(f"{r.root}/gold/{name}")

    def change(now):
        if any(set(old[t]) - set(now.folders.get(t, [])) for t in old):
            return None
        return {"remove": old, "add": {t: [name] for t in old}}

    return name in commits.commit(change).folders.get("totals", [])
