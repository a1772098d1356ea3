import compare
import pytest

import corpus_pipeline
from ledgerwatch.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf, name):
    left = compare.spark_result(queries.QUERIES[name](spark, sf))
    right = compare.duck_result(compare.duck(sf), queries.SQL[name])
    assert compare.difference(left, right) is None and left[1]


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name, columns", [
    ("op2_probminhash", {"doc_id", "class_id", "class_size", "copies"}),
    ("op3_token_counts", {"doc_id", "n_bytes", "n_tokens", "over_limit"}),
    ("op8_splitters", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    ("op9_quality", {"doc_id", "held_out", "score", "predicted"}),
    ("op11_recompression", {"doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                            "runs_sha256", "collapsed_sha256"}),
    ("op12_byte_bpe", {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}),
    ("op10_deobfuscation", {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"})])
def test_a_row_per_document(spark, sf, name, columns):
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES[name](spark, sf)
    assert set(got.columns) == columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(ids)
