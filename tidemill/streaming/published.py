"""Output and source offsets published as one: a manifest per micro-batch.

A batch's part files lie in a folder of their own attempt. The manifest that names them and the
batch's source offsets appears whole, by a move that fails where one is already; readers see only
files a manifest names, so a crash before that moment leaves nothing behind but unread files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Fenced(RuntimeError):
    """A producer with a newer epoch has taken over."""


class PublishedLog:
    """``<root>/manifests/<batch>.json``, ``<root>/epochs/<n>``, ``<root>/parts/<attempt>``.

    A producer takes an epoch with :meth:`begin`, the exclusive creation of the next number's
    file. One with an older epoch is refused before it publishes; should it come between the check
    and the move, the batch is published once all the same, and whoever comes second finds equal
    offsets (the batch is done) or others (:class:`Fenced`).
    """

    def __init__(self, spark: SparkSession, root: str, checkpoint: str):
        self.spark, self.root, self.checkpoint = spark, root.rstrip("/"), checkpoint.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self.epoch: int | None = None

    def _names(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or []
        return [s.getPath().getName() for s in found]

    def _text(self, place: str) -> str:
        path = self._path(place)
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def begin(self) -> int:
        """Take the next epoch; of two producers that try the same number one gets it."""
        epoch = self._newest_epoch() + 1
        try:
            self._fs.create(self._path(f"{self.root}/epochs/{epoch}"), False).close()
        except Exception as exc:
            raise Fenced(f"epoch {epoch} was taken") from exc
        self.epoch = epoch
        return epoch

    def _newest_epoch(self) -> int:
        return max((int(n) for n in self._names("epochs/*")), default=0)

    def offsets(self, batch_id: int) -> list:
        """End offsets of the batch's sources, as the stream logged them before it ran."""
        lines = self._text(f"{self.checkpoint}/offsets/{batch_id}").splitlines()
        return [None if line == "-" else json.loads(line) for line in lines[2:]]

    def stage(self, batch: DataFrame, batch_id: int) -> dict:
        """Write the part files; nobody reads them yet."""
        folder = f"epoch={self.epoch}-batch={batch_id}-{uuid.uuid4().hex[:12]}"
        batch.write.parquet(f"{self.root}/parts/{folder}")
        files = [f"{folder}/{n}" for n in self._names(f"parts/{folder}/part-*")]
        return {"batch": batch_id, "epoch": self.epoch, "offsets": self.offsets(batch_id),
                "files": sorted(files)}

    def publish(self, manifest: dict) -> bool:
        """Make the batch visible; False if it was published before."""
        if self.epoch is None or self._newest_epoch() != self.epoch:
            raise Fenced(f"epoch {self.epoch} is not the newest")
        aside = f"{self.root}/aside/{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(aside), False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        place = f"{self.root}/manifests/{manifest['batch']}.json"
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))
        options = self._jvm.org.apache.hadoop.fs.Options
        rule = self.spark.sparkContext._gateway.new_array(options.Rename, 1)
        rule[0] = options.Rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(self.root).toUri(), self._conf)
        try:
            context.rename(self._path(aside), self._path(place), rule)
            return True
        except Exception:
            if not self._fs.exists(self._path(place)):
                raise
        if json.loads(self._text(place))["offsets"] != manifest["offsets"]:
            raise Fenced(f"batch {manifest['batch']} was published with other offsets")
        return False

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``: a batch that was published is not written again."""
        if self.epoch is None:
            self.begin()
        if f"{batch_id}.json" in self._names(f"manifests/{batch_id}.json"):
            if self.manifest(batch_id)["offsets"] != self.offsets(batch_id):
                raise Fenced(f"batch {batch_id} was published with other offsets")
            return
        self.publish(self.stage(batch, batch_id))

    def manifest(self, batch_id: int) -> dict:
        return json.loads(self._text(f"{self.root}/manifests/{batch_id}.json"))

    def manifests(self) -> list[dict]:
        ids = sorted(int(n.split(".")[0]) for n in self._names("manifests/*.json"))
        return [self.manifest(i) for i in ids]

    def rows(self, schema) -> DataFrame:
        """Rows of published batches only."""
        files = [f"{self.root}/parts/{f}" for m in self.manifests() for f in m["files"]]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def unpublished(self) -> list[str]:
        """Folders of older epochs that no manifest names, free to be removed."""
        used = {f.split("/")[0] for m in self.manifests() for f in m["files"]}
        return sorted(n for n in self._names("parts/*") if n not in used
                      and int(n.split("-")[0].split("=")[1]) < self._newest_epoch())
