import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", 4, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "shared"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TRANSACTION_DDL = (
    "transaction_id string, timestamp string, customer_id_hash string, amount decimal(10,2), "
    "merchant_id string, merchant_category string, status string, is_international boolean, "
    "customer_present boolean, lat double, lon double")


@pytest.fixture(scope="session")
def transactions(spark):
    """Make a transaction frame from short dicts."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    names = [c.split()[0] for c in TRANSACTION_DDL.split(", ")]

    def make(rows):
        base = {"customer_id_hash": "c", "amount": 10, "merchant_id": "m",
                "merchant_category": "GROCERY", "status": "APPROVED", "is_international": False,
                "customer_present": True, "lat": None, "lon": None}
        data = []
        for i, row in enumerate(rows):
            full = {"transaction_id": f"t{i:05d}", **base, **row}
            if full["amount"] is not None:
                full["amount"] = Decimal(str(full["amount"]))
            for c in ("lat", "lon"):
                full[c] = None if full[c] is None else float(full[c])
            data.append(tuple(full[n] for n in names))
        df = spark.createDataFrame(data, TRANSACTION_DDL)
        return df.withColumns({
            "timestamp": F.col("timestamp").cast("timestamp"),
            "location": F.struct(
                F.lit("US").alias("country"), F.lit("CA").alias("state"),
                F.lit("SF").alias("city"), F.lit(None).cast("string").alias("zip_code"),
                F.col("lat").alias("latitude"), F.col("lon").alias("longitude")),
            "metadata": F.lit(None).cast("map<string,string>"),
            "currency": F.lit("USD"), "channel": F.lit("POS"),
        }).drop("lat", "lon")

    return make
