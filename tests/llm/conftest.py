import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def real(spark):
    """Documents of the smallest tables as (id, text) rows."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture
def docs(spark):
    """A documents frame from (id, text[, source]) rows."""
    def make(rows, extra=False):
        full = [(*r, *(None, None)[len(r) - 2:]) if len(r) < 3 else r for r in rows]
        df = spark.createDataFrame([r[:3] for r in full], "doc_id long, text string, source string")
        if extra:  # names that the operators use inside
            for name in ("id", "size", "key", "node", "row", "name", "bucket", "class_id", "digest"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


def words_of(n, seed=0):
    """n words, different for every seed."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
