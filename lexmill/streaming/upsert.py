"""Page terms kept up to date as pages arrive.

Each micro-batch brings revisions, of which the latest N of every page count.  A batch is written as a delta; every
``compact`` batches, base and deltas are merged into a new base.  A manifest names the base and the deltas that hold.
It is written beside and renamed, under the batch's number, when everything it names is there: a batch that fails or is run
twice changes nothing, and a crash leaves the manifest before.  Files that neither of the last two manifests names are deleted.
Document frequencies need the whole corpus and are computed in batch from the table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators import pages

COLUMNS = "lang string, page_id bigint, topic_id bigint, rev_id bigint, ts timestamp, text string"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


class RevisionStore:
    def __init__(self, spark: SparkSession, folder: str, keep: int = 10, compact: int = 16):
        self.spark, self.folder, self.keep, self.compact = spark, folder, keep, compact
        self._path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        self._fs = self._path("manifest").getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, of: str) -> list[str]:
        p = self._path(of)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _manifests(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("manifest") if n.endswith(".json"))

    def _manifest(self, batch: int | None = None) -> dict:
        """The manifest of a batch, by default the last one."""
        known = self._manifests()
        if not known:
            return {"batch": -1, "base": None, "deltas": []}
        path = self._path(f"manifest/{known[-1] if batch is None else batch}.json").toString()
        return json.loads("".join(r[0] for r in self.spark.read.text(path).collect()))

    def _publish(self, manifest: dict) -> None:
        beside, to = self._path(f"manifest/{uuid.uuid4().hex}.new"), self._path(f"manifest/{manifest['batch']}.json")
        out = self._fs.create(beside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(beside, to):
            raise OSError(f"can't publish {to}")
        last = self._manifests()[-2:]
        for n in self._names("manifest"):
            if n not in {f"{m}.json" for m in last}:
                self._fs.delete(self._path(f"manifest/{n}"), False)
        named = {x for m in last for x in (lambda d: [d["base"], *d["deltas"]])(self._manifest(m))}
        for n in self._names(""):
            if n.startswith(("base-", "delta-")) and n not in named:
                self._fs.delete(self._path(n), True)

    def _merged(self, manifest: dict) -> DataFrame:
        parts = [x for x in (manifest["base"], *manifest["deltas"]) if x]
        if not parts:
            return self.spark.createDataFrame([], COLUMNS)
        every = self.spark.read.schema(COLUMNS).parquet(*(f"{self.folder}/{x}" for x in parts))
        return every if not manifest["deltas"] else pages.latest_revisions(every, self.keep)

    def read(self) -> DataFrame:
        """The revisions kept."""
        return self._merged(self._manifest())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Merge a batch (for ``foreachBatch``): what is written grows with the batch, but for the merge once in ``compact`` batches."""
        manifest = self._manifest()
        if batch_id <= manifest["batch"]:
            return
        delta = f"delta-{batch_id}"
        new = pages.latest_revisions(batch.select(*NAMES).where("page_id IS NOT NULL"), self.keep)
        new.write.mode("overwrite").parquet(f"{self.folder}/{delta}")
        manifest = {"batch": batch_id, "base": manifest["base"], "deltas": [*manifest["deltas"], delta]}
        if len(manifest["deltas"]) >= self.compact:
            base = f"base-{batch_id}"
            self._merged(manifest).write.mode("overwrite").parquet(f"{self.folder}/{base}")
            manifest |= {"base": base, "deltas": []}
        self._publish(manifest)


def follow(stream: DataFrame, store: RevisionStore, checkpoint: str):
    """Start the query that feeds a stream of revisions into the store, for all that is there now."""
    return stream.writeStream.foreachBatch(store.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
