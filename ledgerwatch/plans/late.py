"""Late rows brought into silver by recomputing only the customers and days that they change.

A late row changes the look-back features of its customer for as long as a window reaches: the rows of the
next hours and the next ``history_rows`` rows.  Rows are counted by (customer, day), so both reaches become
days: *updated* days, whose rows may have changed, and before them *context* days, which hold everything
that updated rows look back on.  Only those days of those customers are read with all columns.
"""

from math import ceil

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch import session
from ledgerwatch.config import FeatureConfig, PipelineConfig
from ledgerwatch.operators import features
from ledgerwatch.operators.features import CUSTOMER
from ledgerwatch.plans import medallion
from ledgerwatch.schema import UNKNOWN_CUSTOMER
from ledgerwatch.session import beside, store

PLACE = [CUSTOMER, "_day"]


def affected_days(days, late, cfg=FeatureConfig()):
    """(customer, day, updated) of the days to read.

    ``days`` holds the rows ``_rows`` of each (customer, day), ``late`` the distinct days of late rows; a
    late day may hold no row.  A window holds one customer's days, not its rows.
    """
    ordered = Window.partitionBy(CUSTOMER).orderBy("_day")
    past, future = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(
        0, Window.unboundedFollowing)
    reach, span = max(cfg.history_rows, 1), ceil(max(cfg.velocity_hours, default=0) / 24)
    known = days.join(late.withColumn("_late", F.lit(True)), PLACE, "full_outer").withColumn(
        "_rows", F.coalesce("_rows", F.lit(0)))
    counted = known.withColumn("_upto", F.sum("_rows").over(past)).withColumn(
        "_before", F.col("_upto") - F.col("_rows"))
    seen = counted.withColumns({
        "_late_day": F.last(F.when(F.col("_late"), F.col("_day")), True).over(past),
        "_late_upto": F.last(F.when(F.col("_late"), F.col("_upto")), True).over(past),
    })
    updated = F.coalesce(
        (F.datediff("_day", "_late_day") <= span) | (F.col("_before") - F.col("_late_upto") < reach), F.lit(False))
    marked = seen.withColumn("updated", updated).withColumns({
        "_next_day": F.first(F.when(F.col("updated"), F.col("_day")), True).over(future),
        "_next_before": F.first(F.when(F.col("updated"), F.col("_before")), True).over(future),
    })
    needed = (F.datediff("_next_day", "_day") <= span) | (F.col("_next_before") - F.col("_upto") < reach)
    return marked.filter(needed).select(*PLACE, "updated")


def refill_late(silver_rows, transactions, late, cfg=PipelineConfig(), as_of=None):
    """``medallion.refill`` for the rows that ``late`` rows change; other rows stay as they are.

    ``late`` are the late transactions, typed like ``transactions``, which hold them too.  A late row may be
    the first delivery of an id that is known already: all deliveries of a late id count as late.  Rows
    without a customer or a time change no other row and keep what they have.  Returns all silver rows.
    """
    order = [c for c in ("kafka_partition", "kafka_offset") if c in transactions.columns]

    def placed(rows):
        found = medallion.secured(rows, cfg, as_of)
        return found.filter(F.col("timestamp").isNotNull() & (F.col(CUSTOMER) != UNKNOWN_CUSTOMER)).withColumn(
            "_day", F.to_date("timestamp"))

    narrow = placed(transactions).select("transaction_id", "timestamp", *order, *PLACE)
    late_ids = store(late.select("transaction_id").filter("transaction_id IS NOT NULL").distinct(), "late-ids")
    late_days = store(placed(late).select(PLACE).unionByName(
        narrow.join(beside(late_ids), "transaction_id", "left_semi").select(PLACE)).distinct(), "late-days")
    customers = beside(store(late_days.select(CUSTOMER).distinct(), "late-customers"))

    theirs = store(narrow.join(customers, CUSTOMER, "left_semi"), "late-theirs")
    deliveries = narrow.join(beside(theirs.select("transaction_id")), "transaction_id", "left_semi")
    once = store(medallion.first_of_each(
        deliveries.unionByName(theirs.filter("transaction_id IS NULL"))).join(
            customers, CUSTOMER, "left_semi"), "late-once")
    plan = beside(store(
        affected_days(once.groupBy(PLACE).agg(F.count("*").alias("_rows")), late_days, cfg.features), "late-plan"))

    ids = store(once.join(plan, PLACE, "left_semi").select("transaction_id").distinct(), "late-again")
    again = transactions.join(beside(ids), "transaction_id", "left_semi").unionByName(
        transactions.filter("transaction_id IS NULL"))
    rows = store(placed(medallion.first_of_each(again)).join(plan, PLACE), "late-rows")
    fresh = features.add_features(rows, cfg.features).filter("updated")
    few = rows.filter("updated").count() <= session.BROADCAST_ROWS
    return medallion.with_fresh_features(silver_rows, fresh, cfg, few)
