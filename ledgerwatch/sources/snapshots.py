"""A keyed table of versions: an upsert writes beside the old rows and switches over in one commit.

Rows lie in hash buckets of their key, a folder each.  An upsert reads and rewrites the buckets of the
source's keys alone.  Readers follow the log of commits, so they see the table before or after an upsert,
never between; a writer that dies leaves files that nothing lists.  Two writers of one bucket do not
lose rows: the later one finds its folders replaced and starts again from the new ones.
"""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.sources import tables
from ledgerwatch.sources.commits import Commits


class SnapshotTable:
    """A table below ``path`` with declared ``schema`` (DDL) and ``keys``."""

    DATA = "data"

    def __init__(self, spark, path, schema, keys, buckets=64):
        self.spark, self.schema, self.keys, self.buckets = spark, schema, list(keys), buckets
        self.commits = Commits(spark, path)
        self.names = T.StructType.fromDDL(schema).names

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _folders(self, state, buckets=None):
        """Live folders, of all buckets or of those given."""
        live = state.folders.get(self.DATA, [])
        if buckets is None:
            return live
        wanted = {f"bucket={b}" for b in buckets}
        return [f for f in live if f.split("/")[1] in wanted]

    def _read(self, folders):
        return self.commits.read_folders(self.DATA, self.schema, folders)

    def read(self):
        """The rows of the last committed version."""
        return self._read(self._folders(self.commits.state()))

    def versions(self):
        return self.commits.state().version + 1

    def _write(self, rows):
        """Write rows to a new folder of buckets; returns those that came to be."""
        name = f"v={uuid.uuid4().hex[:12]}"
        rows = rows.select(*self.names).withColumn("_b", self._bucket()).hint("rebalance", "_b")
        rows.withColumnRenamed("_b", "bucket").write.partitionBy("bucket").parquet(
            f"{self.commits.root}/{self.DATA}/{name}")
        return [f"{name}/{n}" for n, _ in self.commits.files.names(self.DATA, name) if n.startswith("bucket=")]

    def replace(self, rows):
        """The whole table anew."""
        added = self._write(rows)
        self.commits.commit(lambda now: {
            "remove": {self.DATA: self._folders(now)}, "add": {self.DATA: added}})

    def upsert(self, source, update_columns=None, now=None):
        """Update the rows whose key ``source`` has and add the others; see ``tables.merge_frames``.

        Returns the numbers of the buckets that were rewritten.
        """
        touched = [r[0] for r in source.select(self._bucket().alias("b")).distinct().collect()]
        while touched:
            old = self._folders(self.commits.state(), touched)
            added = self._write(tables.merge_frames(
                self._read(old), source, self.keys, update_columns, now))
            done = []

            def change(state):
                done.clear()
                if sorted(self._folders(state, touched)) != sorted(old):
                    return None  # another writer was here: start from its rows
                done.append(True)
                return {"remove": {self.DATA: old}, "add": {self.DATA: added}}

            self.commits.commit(change)
            if done:
                break
        return sorted(touched)

    def vacuum(self, keep_versions=10):
        """Delete the folders of versions that lie far back; returns their names."""
        return self.commits.vacuum(keep_versions)
