"""Gold tables over silver transactions and alerts.

Every measure is a map-side-combined aggregate or works on pre-counted values;
alerts meet transactions on narrow projections, and only where needed.
Customer and merchant gold take silver as one frame or as parts that share no
customer; a part in buckets of customers is not shuffled to group by them.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.operators import skew
from ledgerwatch.operators.features import CUSTOMER
from ledgerwatch.session import store

TOP = 3
MONEY = "decimal(18,2)"


def _values_by_date(silver):
    """(date, kind, amount, name) with the counts of its rows, in one pass: amounts, customers and merchants.

    Sums, the median and the numbers of distinct names all follow from it.
    """
    nothing = {"amount": F.lit(None).cast(silver.schema["amount"].dataType), "name": F.lit(None).cast("string")}
    kinds = {"amount": {"amount": F.col("amount")}, "customer": {"name": F.col(CUSTOMER)},
             "merchant": {"name": F.col("merchant_id")}}
    values = F.array(*[
        F.struct(F.lit(kind).alias("kind"), *[c.alias(n) for n, c in {**nothing, **given}.items()])
        for kind, given in kinds.items()])
    return silver.select("transaction_date", "status", "is_international", F.explode(values).alias("_v")).select(
        "transaction_date", "status", "is_international", "_v.*").groupBy(
        "transaction_date", "kind", "amount", "name").agg(
        F.count("*").alias("_n"), F.count_if(F.col("status") == "APPROVED").alias("_approved"),
        F.count_if(F.col("status") == "DECLINED").alias("_declined"), F.count_if("is_international").alias("_abroad"))


def daily_summary(silver, alerts, high_risk=0.7):
    """Fifteen measures per transaction date.

    ``fraud_alerts`` counts alerts, ``high_risk_transactions`` the transactions
    with an alert scored above ``high_risk``.  Silver is read twice: once for its values, which are counted
    and stored, once for the ids that meet the alerts.
    """
    values = store(_values_by_date(silver), "daily-values")
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    money = lambda n: F.sum(F.col("amount") * F.col(n))
    rows = lambda n: F.sum(of("amount", n))
    known = F.sum(F.when(F.col("amount").isNotNull(), F.col("_n")))
    totals = values.groupBy("transaction_date").agg(
        rows("_n").alias("total_transactions"),
        money("_n").cast(MONEY).alias("total_amount"),
        rows("_approved").alias("approved_transactions"),
        F.coalesce(money("_approved"), F.lit(0)).cast(MONEY).alias("approved_amount"),
        rows("_declined").alias("declined_transactions"),
        F.coalesce(money("_declined"), F.lit(0)).cast(MONEY).alias("declined_amount"),
        F.count(of("customer", "name")).alias("unique_customers"),
        F.count(of("merchant", "name")).alias("unique_merchants"),
        rows("_abroad").alias("international_transactions"),
        F.coalesce(money("_abroad"), F.lit(0)).cast(MONEY).alias("international_amount"),
        (money("_n").cast("double") / known).alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
    )
    amounts = values.filter("kind = 'amount' AND amount IS NOT NULL").select("transaction_date", "amount", "_n")
    median = skew.counted_median(amounts, "transaction_date", "amount").select(
        "transaction_date",
        F.col("median_amount").cast("double").alias("median_transaction_amount"),
    )
    # alerts first, so only ids and dates of silver are shuffled
    per_transaction = alerts.groupBy("transaction_id").agg(
        F.count("*").alias("_alerts"), F.max("risk_score").alias("_risk"))
    alert_counts = (
        silver.select("transaction_id", "transaction_date")
        .join(per_transaction, "transaction_id")
        .groupBy("transaction_date")
        .agg(F.sum("_alerts").alias("fraud_alerts"),
             F.count_if(F.col("_risk") > high_risk).alias("high_risk_transactions"))
    )
    return (
        totals.join(median, "transaction_date", "left")
        .join(alert_counts, "transaction_date", "left")
        .fillna(0, ["fraud_alerts", "high_risk_transactions"])
    )


def _most_frequent(silver, key, place):
    """The most frequent combination of ``place`` columns per key, ties by name.

    Counted first, then reduced with ``min(struct)``: no window over the key.
    """
    counted = silver.groupBy(key, *place).agg(F.count("*").alias("_n"))
    best = counted.groupBy(key).agg(F.min(F.struct(-F.col("_n"), *place)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}") for c in place])


def _top_values(silver, kinds):
    """The TOP most frequent values per customer for each of ``kinds``, as sorted arrays.

    One pass: every row gives a value of each kind, a group-limited row_number keeps three per
    (customer, kind), one small aggregation turns them into columns.  Rows in buckets of customers
    are not shuffled.
    """
    names = list(kinds)
    pairs = F.array(*[F.struct(F.lit(n).alias("_kind"), c.cast("string").alias("_value")) for n, c in kinds.items()])
    ranked = silver.select(CUSTOMER, F.explode(pairs).alias("_p")).select(CUSTOMER, "_p.*").filter(
        F.col("_value").isNotNull()).groupBy(CUSTOMER, "_kind", "_value").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(CUSTOMER, "_kind").orderBy(F.desc("_n"), "_value")
    kept = ranked.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= TOP)
    return kept.groupBy(CUSTOMER).agg(*[
        F.transform(
            F.array_sort(F.collect_list(
                F.when(F.col("_kind") == n, F.struct("_rank", "_value")))),
            lambda e: e["_value"],
        ).alias(n)
        for n in names
    ])


def parts_of(silver):
    return silver if isinstance(silver, list) else [silver]


def customer_patterns(silver, alerts, analysis_date):
    """Spending pattern per customer: totals, top lists, home, shares, risk."""
    return reduce(DataFrame.unionByName, [
        _patterns_of_part(part, alerts, analysis_date) for part in parts_of(silver)])


def _patterns_of_part(silver, alerts, analysis_date):
    rows = silver.filter(F.col(CUSTOMER).isNotNull())
    n = F.count("*")
    totals = rows.groupBy(CUSTOMER).agg(
        n.alias("total_transactions"),
        F.sum("amount").cast(MONEY).alias("total_amount"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("avg_transaction_amount"),
        (F.count_if(F.col("is_international")) * 100.0 / n)
        .alias("international_transaction_pct"),
        (F.count_if(F.col("is_weekend")) * 100.0 / n).alias("weekend_transaction_pct"),
        F.max("transaction_date").alias("last_transaction_date"),
    )
    tops = _top_values(rows, {
        "preferred_merchant_categories": F.col("merchant_category"),
        "preferred_channels": F.col("channel"),
        "typical_transaction_hours": F.lpad(F.col("hour_of_day").cast("string"), 2, "0"),
    })
    home = _most_frequent(rows, CUSTOMER, ["country", "state", "city"]).toDF(
        CUSTOMER, "home_country", "home_state", "home_city")
    # the alert carries the customer, so no transaction is needed here
    fraud = alerts.groupBy(CUSTOMER).agg(F.max("risk_score").alias("_risk"))
    score = F.coalesce("_risk", F.lit(0.0))
    return (
        totals.join(tops, CUSTOMER, "left").join(home, CUSTOMER, "left")
        .join(fraud, CUSTOMER, "left")
        .withColumns({
            "fraud_score": score,
            "risk_profile": F.when(score >= 0.6, "HIGH").when(score >= 0.3, "MEDIUM")
            .otherwise("LOW"),
            "analysis_date": F.lit(analysis_date).cast("date"),
        })
        .drop("_risk")
    )


def merchant_analytics(silver, alerts, analysis_date):
    """Volume, decline and fraud rate, risk and place per merchant."""
    parts = [part.filter(F.col("merchant_id").isNotNull()) for part in parts_of(silver)]
    rows = reduce(DataFrame.unionByName, parts)
    # a merchant's customers: pairs first, which need no shuffle where customers lie together
    customers = reduce(DataFrame.unionByName, [part.select(CUSTOMER, "merchant_id").distinct() for part in parts])
    customers = customers.groupBy("merchant_id").agg(F.count(CUSTOMER).alias("unique_customers"))
    n = F.count("*")
    totals = rows.groupBy("merchant_id").agg(
        n.alias("total_transactions"),
        F.sum("amount").cast(MONEY).alias("total_amount"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("avg_transaction_amount"),
        (F.count_if(F.col("status") == "DECLINED") * 100.0 / n).alias("decline_rate"),
        F.max("merchant_risk_score").alias("risk_score"),
        F.min("merchant_name").alias("merchant_name"),
    )
    place = _most_frequent(
        rows, "merchant_id", ["merchant_category", "country", "state", "city"])
    ids = alerts.select("transaction_id")
    fraud = (
        rows.select("transaction_id", "merchant_id").join(ids, "transaction_id", "left_semi")
        .groupBy("merchant_id").agg(F.count("*").alias("_alerted"))
    )
    return (
        totals.join(customers, "merchant_id").join(place, "merchant_id", "left")
        .join(fraud, "merchant_id", "left")
        .withColumns({
            "fraud_rate": F.coalesce("_alerted", F.lit(0)) * 100.0 / F.col("total_transactions"),
            "analysis_date": F.lit(analysis_date).cast("date"),
        })
        .drop("_alerted")
    )


def labelled_fraud(transactions):
    """Share of rows carrying a ``fraud_pattern`` label, per label and in total."""
    label = F.coalesce(F.col("metadata").getItem("fraud_pattern"), F.lit("none"))
    per_label = transactions.groupBy(label.alias("fraud_pattern")).agg(F.count("*").alias("n"))
    labelled = F.when(F.col("fraud_pattern") != "none", F.col("n")).otherwise(0)
    # a combined count, one row, joined to every label
    total = per_label.agg(
        F.sum(labelled).alias("_labelled"), F.sum("n").alias("_all")).withColumn("_one", F.lit(1))
    shares = per_label.filter("fraud_pattern <> 'none'").withColumn("_one", F.lit(1)).join(
        F.broadcast(total), "_one").select("fraud_pattern", "n", "_all")
    every = total.select(F.lit("ALL").alias("fraud_pattern"), F.col("_labelled").alias("n"), "_all")
    return shares.unionByName(every).withColumn("rate", F.col("n") / F.col("_all")).drop("_all")
