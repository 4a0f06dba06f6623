"""A table of the newest revision of each event that a poll updates in place.

Batches are appended as folders, one per batch id; now and then they are merged into the base, which is cut into
buckets by a hash of the key. A merge rewrites only buckets that the batches touch, each as a new version, and then
commits a manifest, a small file that names the version of every bucket and the last batch merged. The commit is one
atomic rename to the next number. A reader takes the newest manifest, the versions it names and the batches after it,
so it sees the table before or after a merge and never a mixture; its reads are bounded by the buckets and by the
batches between two merges, however many batches there were.

After a crash: a batch folder without its success mark is not read, and a retried batch overwrites its own folder; a
merge that stopped before its commit leaves versions that no manifest names, and the next merge goes by the old one.
Old versions and merged batches go at the merge after the next, so that readers of the manifest before can finish.
One writer at a time: a second commit of the same number fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from seisflow.streaming.ingest import latest_revisions

#: Buckets of the base, and batches after which the sink merges.
BUCKETS, MERGE_EVERY = 64, 8


class RevisionTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "id", version: str = "updated", buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.version, self.buckets = spark, path.rstrip("/"), key, version, buckets
        self.schema = spark.createDataFrame([], schema).schema
        jvm = spark._jvm.org.apache.hadoop.fs
        self._to_path, self._files = jvm.Path, jvm.FileContext
        self._fs = jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ files

    def _names(self, folder: str) -> list[str]:
        at = self._to_path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._to_path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def manifest(self, back: int = 0) -> dict:
        """The newest manifest, or the one ``back`` commits before it: its number, the last merged batch, and the version of each bucket."""
        numbers = sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json"))
        if len(numbers) <= back:
            return {"number": 0, "through": -1, "versions": {}}
        return json.loads(self._text(f"{self.path}/manifests/{numbers[-1 - back]:010d}.json"))

    def _commit(self, manifest: dict) -> None:
        """One rename, which fails if that number is there already."""
        spare = self._to_path(f"{self.path}/manifests/{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(spare)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        final = self._to_path(f"{self.path}/manifests/{manifest['number']:010d}.json")
        plain = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._files.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(spare, final, plain)

    def _batches(self, after: int) -> list[int]:
        """Numbers of the complete batches after one, ascending."""
        numbers = sorted(int(n[6:]) for n in self._names("batches") if n.startswith("batch=") and int(n[6:]) > after)
        return [b for b in numbers if self._fs.exists(self._to_path(f"{self.path}/batches/batch={b}/_SUCCESS"))]

    # ------------------------------------------------------------------ reading and writing

    def _folders(self, manifest: dict) -> list[str]:
        return [f"{self.path}/base/{v}/bucket={b}" for b, v in manifest["versions"].items()]

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def paths(self) -> list[str]:
        """The folders that a read takes now."""
        m = self.manifest()
        return self._folders(m) + [f"{self.path}/batches/batch={b}" for b in self._batches(m["through"])]

    def read(self) -> DataFrame:
        """The newest revision of every key (of equal versions the greatest row)."""
        return latest_revisions(self._rows(self.paths()), self.key, self.version)

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """One batch's newest revisions; the same id again overwrites its folder, or does nothing once it is merged."""
        if batch_id > self.manifest()["through"]:
            rows = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
            latest_revisions(rows, self.key, self.version).write.mode("overwrite").parquet(f"{self.path}/batches/batch={batch_id}")

    def merge(self) -> bool:
        """Take all complete batches into the base; False if there are none."""
        old = self.manifest()
        batches = self._batches(old["through"])
        if not batches:
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        fresh = self._rows([f"{self.path}/batches/batch={b}" for b in batches])
        touched = sorted(r["b"] for r in fresh.select(bucket.alias("b")).distinct().collect())  # at most ``buckets`` numbers
        kept = self._rows(self._folders({"versions": {b: v for b, v in old["versions"].items() if int(b) in touched}}))
        merged = latest_revisions(kept.unionByName(fresh), self.key, self.version)
        version = f"v{old['number'] + 1}-{uuid.uuid4().hex[:8]}"
        merged.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(f"{self.path}/base/{version}")
        new = {"number": old["number"] + 1, "through": batches[-1], "versions": old["versions"] | {str(b): version for b in touched}}
        self._commit(new)
        self._sweep(new, old)
        return True

    def _sweep(self, new: dict, old: dict) -> None:
        """Delete versions that neither of the two newest manifests names, and batches merged before the older one."""
        named = {(b, v) for m in (new, old) for b, v in m["versions"].items()}
        for version in self._names("base"):
            for name in self._names(f"base/{version}"):
                if name.startswith("bucket=") and (name[7:], version) not in named:
                    self._fs.delete(self._to_path(f"{self.path}/base/{version}/{name}"), True)
            if not any(v == version for _, v in named):
                self._fs.delete(self._to_path(f"{self.path}/base/{version}"), True)
        for name in self._names("batches"):
            if name.startswith("batch=") and int(name[6:]) <= old["through"]:
                self._fs.delete(self._to_path(f"{self.path}/batches/{name}"), True)
        for name in self._names("manifests"):
            if name.endswith(".json") and int(name[:-5]) < old["number"]:
                self._fs.delete(self._to_path(f"{self.path}/manifests/{name}"), True)


def merging_sink(table: RevisionTable, every: int = MERGE_EVERY):
    """``foreachBatch`` sink: append the batch, and merge once ``every`` batches wait."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id)
        if len(table._batches(table.manifest()["through"])) >= every:
            table.merge()
    return write
