"""Columns computed from whole texts, slice by slice of Arrow batches.

Ids cross Python as Arrow values, so large numbers beside nulls stay exact.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerwatch.llm import words


def map_texts(docs, make, schema, id_col="doc_id", text_col="text", most_bytes=words.SLICE_BYTES):
    """(id, *schema) of every row; ``make(ids, raws)`` gives the Arrow columns of one slice.

    ``raws`` are texts in UTF-8 (null: empty) of bounded total bytes, or one longer text.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for first, raws in words.slices((t.as_py() for t in b.column(1)), most_bytes):
                part = ids.slice(first, len(raws))
                made = make(part, raws)
                yield pa.RecordBatch.from_arrays([part, *made.values()], ["id", *made])

    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)
