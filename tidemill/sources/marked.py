"""Streaming source of our own: Parquet files in order, with marks that end a batch.

``spark.readStream.format("tidemill_marked").schema(s).load(uri)`` reads the files of a folder in
name order; a file that comes later must have a later name. Every ``mark_every``-th record is a
mark: it ends its micro-batch, and Spark moves the watermark between batches (windows close at the
next mark, its late filter for rows follows one mark later). The files are listed again for each
batch, and a batch is cut into one split per row group it touches.

``progress`` names a folder of the stream where the source notes the end of the batch it planned
last, which Spark has logged by then; it belongs to one checkpoint, as an offset does. Offsets are
``{"file": name, "row": n}``: the next record to be read. ``uri`` and ``progress`` need a scheme
(``tidemill.session.qualified``).
"""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemill.sources.rowgroups import _files, _system


class GroupSplit(InputPartition):
    """Rows ``start`` to ``stop`` of one row group."""

    def __init__(self, path: str, group: int, start: int, stop: int):
        super().__init__(f"{path}#{group}")
        self.path, self.group, self.start, self.stop = path, group, start, stop


class MarkedReader(DataSourceStreamReader):
    """Only the footers of the files a batch reaches are read on the driver."""

    def __init__(self, uri: str, columns: list[str], mark_every: int, progress: str):
        if mark_every < 1:
            raise ValueError("mark_every must be at least 1")
        self.uri, self.columns, self.mark_every, self.progress = uri, columns, mark_every, progress
        self._groups: dict[str, list[int]] = {}
        self._at = None

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def latestOffset(self) -> dict:
        """One mark after the offset given before; the same again while nothing is there."""
        if self._at is None:
            self._at = self._noted()
        wanted, at = self.mark_every, dict(self._at)
        for path in self._paths(at["file"]):
            rows = sum(self._rows(path))
            begin = at["row"] if path == at["file"] else 0
            take = min(wanted, rows - begin)
            if take > 0:
                at, wanted = {"file": path, "row": begin + take}, wanted - take
            if not wanted:
                break
        self._at = at
        return dict(at)

    def partitions(self, start: dict, end: dict):
        self._at = dict(end)
        self._note(end)
        splits = []
        for path in self._paths(start["file"]):
            if path > end["file"]:
                break
            low = start["row"] if path == start["file"] else 0
            base = 0
            for group, rows in enumerate(self._rows(path)):
                high = end["row"] if path == end["file"] else base + rows
                first, last = max(low, base), min(high, base + rows)
                if first < last:
                    splits.append(GroupSplit(path, group, first - base, last - base))
                base += rows
        return splits

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, _ = _system(self.uri)
        with system.open_input_file(partition.path) as handle:
            table = pq.ParquetFile(handle).read_row_group(partition.group, columns=self.columns)
        part = table.slice(partition.start, partition.stop - partition.start).select(self.columns)
        for batch in part.to_batches(max_chunksize=8192):
            yield pa.RecordBatch.from_arrays(batch.columns, names=self.columns)

    def commit(self, end: dict) -> None:
        """Footers of files before the end of a finished batch are not needed again."""
        self._groups = {p: g for p, g in self._groups.items() if p >= end["file"]}

    def _note(self, end: dict) -> None:
        """Written under a name of its own and moved, so it is read whole or not at all."""
        system, root = _system(self.progress)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_next") as out:
            out.write(json.dumps(end).encode())
        system.move(f"{root}/_next", f"{root}/planned.json")

    def _noted(self) -> dict:
        from pyarrow import fs

        system, root = _system(self.progress)
        if system.get_file_info(f"{root}/planned.json").type == fs.FileType.NotFound:
            return self.initialOffset()
        with system.open_input_stream(f"{root}/planned.json") as source:
            return json.loads(source.read())

    def _paths(self, since: str) -> list[str]:
        return [path for path, _ in _files(self.uri) if path >= since]

    def _rows(self, path: str) -> list[int]:
        """Rows of each row group, from the footer."""
        if path not in self._groups:
            import pyarrow.parquet as pq

            system, _ = _system(self.uri)
            with system.open_input_file(path) as handle:
                meta = pq.ParquetFile(handle).metadata
            self._groups[path] = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        return self._groups[path]


class MarkedSource(DataSource):
    @classmethod
    def name(cls):
        return "tidemill_marked"

    def streamReader(self, schema):
        return MarkedReader(self.options["path"], [f.name for f in schema.fields],
                            int(self.options.get("mark_every", 100_000)), self.options["progress"])
