"""A prediction file in row order, published as a whole.

Tasks write consecutive ranges of rows, without headers, into a folder that
no reader looks at.  The commit step puts the ranges of the successful tasks, in order, into a
manifest beside one header and moves the manifest into place: that one rename publishes the
file.  A failed job leaves the earlier file as it was, a retried task leaves
an orphan that the commit deletes.
"""

from __future__ import annotations

import json
import posixpath
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no copy of the package

FORMAT = "ordered_csv"
MANIFEST = "_manifest.json"


@dataclass
class Range(WriterCommitMessage):
    partition: int
    file: str
    rows: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class OrderedCsv(DataSource):
    """``df.sort(...).write.format("ordered_csv").mode("overwrite").save(path)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> OrderedWriter:
        return OrderedWriter(self.options["path"], [f.name for f in schema.fields], overwrite)


class OrderedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = path, columns, overwrite
        self.folder = f"data-{uuid.uuid4().hex}"

    def write(self, batches) -> Range:
        """One range: the rows of this task, under a name of its own for each attempt."""
        files, root = _open(self.path)
        partition = TaskContext.get().partitionId()
        file = f"{self.folder}/{partition:06d}-{uuid.uuid4().hex}.csv"
        files.create_dir(posixpath.join(root, self.folder), recursive=True)
        rows, out = 0, None
        with files.open_output_stream(posixpath.join(root, file)) as sink:
            for b in batches:
                if out is None:
                    out = pacsv.CSVWriter(sink, b.schema, write_options=pacsv.WriteOptions(include_header=False))
                out.write_batch(b)
                rows += b.num_rows
            if out is not None:
                out.close()
        return Range(partition, file, rows)

    def commit(self, messages: list[Range]) -> None:
        files, root = _open(self.path)
        done = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        old = _manifest(files, root)
        if old is not None and not self.overwrite:
            raise ValueError(f"{self.path} exists; write with mode overwrite")
        keep = {posixpath.basename(m.file) for m in done if m.rows}
        folder = posixpath.join(root, self.folder)
        files.create_dir(folder, recursive=True)
        for info in files.get_file_info(fs.FileSelector(folder)):
            if info.base_name not in keep:
                files.delete_file(info.path)
        body = json.dumps({"header": self.columns, "ranges": [{"file": m.file, "rows": m.rows} for m in done if m.rows]})
        draft = posixpath.join(root, f"{self.folder}.json")
        with files.open_output_stream(draft) as f:
            f.write(body.encode())
        files.move(draft, posixpath.join(root, MANIFEST))       # this publishes the file
        for info in files.get_file_info(fs.FileSelector(root)):
            if info.type == fs.FileType.Directory and info.base_name.startswith("data-") and info.base_name != self.folder \
                    and old is not None and any(r["file"].startswith(info.base_name) for r in old["ranges"]):
                files.delete_dir(info.path)

    def abort(self, messages) -> None:
        files, root = _open(self.path)
        folder = posixpath.join(root, self.folder)
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)


def _manifest(files: fs.FileSystem, root: str) -> dict | None:
    at = posixpath.join(root, MANIFEST)
    if files.get_file_info(at).type != fs.FileType.File:
        return None
    with files.open_input_stream(at) as f:
        return json.loads(f.read())


def write_ordered(df: DataFrame, path: str, row_id: str = "row_id", c: str = "target") -> None:
    """Write one integer column (truncated toward zero) in ``row_id`` order, replacing what is at ``path``.

    The sort deals consecutive ranges to tasks; ``path`` is absolute or a URI that every executor reaches.
    """
    df.sparkSession.dataSource.register(OrderedCsv)
    out = df.select(row_id, F.col(c).cast("bigint").alias(c)).orderBy(row_id).select(c)
    out.write.format(FORMAT).mode("overwrite").save(path)


def read_ordered(spark: SparkSession, path: str, schema: str, row_id: str = "row_id") -> DataFrame:
    """The published rows with their position, 0 first."""
    from tablewright.sources.tables import read_table
    files, root = _open(path)
    ranges = _manifest(files, root)["ranges"]
    if not ranges:
        return spark.createDataFrame([], f"{schema}, {row_id} long")
    # the names of the ranges sort in their order
    return read_table(spark, [posixpath.join(path, r["file"]) for r in ranges], schema, fmt="csv", header=False, row_id=row_id)
