"""Bounded custom source with enumerated splits (Python Data Source API).

``spark.read.format("tidemill_rowgroups").schema(s).load(uri)`` cuts every
Parquet file into byte ranges. A split reads the row groups whose middle lies
in its range, so the driver only lists files and each footer is opened by the
tasks of its file. ``uri`` needs a scheme (``tidemill.session.qualified``).
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 128 << 20


class RangeSplit(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        super().__init__(f"{path}#{start}")
        self.path, self.start, self.stop = path, start, stop


def _system(uri: str):
    from pyarrow import fs

    if "://" not in uri:
        raise ValueError(f"{uri} has no scheme; see tidemill.session.qualified")
    return fs.FileSystem.from_uri(uri)


def _files(uri: str) -> list[tuple[str, int]]:
    from pyarrow import fs

    system, root = _system(uri)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(root, info.size)]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f.path, f.size) for f in found if f.path.endswith(".parquet"))


class RowGroupReader(DataSourceReader):
    def __init__(self, uri: str, columns: list[str], split_bytes: int = SPLIT_BYTES):
        self.uri, self.columns, self.split_bytes = uri, columns, split_bytes

    def partitions(self):
        return [RangeSplit(path, start, min(start + self.split_bytes, size))
                for path, size in _files(self.uri)
                for start in range(0, size, self.split_bytes)]

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, _ = _system(self.uri)
        with system.open_input_file(partition.path) as handle:
            source = pq.ParquetFile(handle)
            for k in range(source.num_row_groups):
                group = source.metadata.row_group(k)
                chunks = [group.column(c) for c in range(group.num_columns)]
                begin = min(c.dictionary_page_offset or c.data_page_offset for c in chunks)
                middle = begin + sum(c.total_compressed_size for c in chunks) // 2
                if not partition.start <= middle < partition.stop:
                    continue
                table = source.read_row_group(k, columns=self.columns)
                for batch in table.to_batches(max_chunksize=8192):
                    yield pa.RecordBatch.from_arrays(batch.columns, names=self.columns)


class RowGroupSource(DataSource):
    @classmethod
    def name(cls):
        return "tidemill_rowgroups"

    def reader(self, schema):
        return RowGroupReader(self.options["path"], [f.name for f in schema.fields],
                              int(self.options.get("split_bytes", SPLIT_BYTES)))
