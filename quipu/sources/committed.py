"""Full refresh of a folder with a commit protocol, as a Python Data Source writer.

Every task attempt writes a file of its own below the new version's folder and names it in
its commit message.  Only if all tasks succeed does the driver write the version's manifest,
one small file that lists exactly the committed files.  So readers meet the old rows until
then; a job that fails, or is killed, leaves the old version current, and the files of
speculative or repeated attempts are in no manifest.  A failed job's files are removed.

``columns`` states the target's columns in order; a frame with others is refused before
anything is written, as an insert by position would mix them up.  Paths may be any that
pyarrow's file systems open (local and shared folders, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quipu.sources.workbook import read_workbooks, write_workbook

NAME = "quipu-committed"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file://" + path[len("file:") :].replace("//", "/").replace("//", "/")
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, root: str, kind: str, schema: StructType):
        self.root, self.kind, self.names = root.rstrip("/"), kind, schema.names
        self.schema = to_arrow_schema(schema)
        self.version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        store, folder = _open(f"{self.root}/data/{self.version}")
        store.create_dir(folder, recursive=True)  # here and not by tasks: one that outlives its failed job would bring it back

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.root)
        folder = f"{root}/data/{self.version}"
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.{self.kind}"
        rows = 0
        with store.open_output_stream(f"{folder}/{name}") as out:
            if self.kind == "xlsx":
                rows = write_workbook(out, self.names, (r for b in iterator for r in zip(*(c.to_pylist() for c in b.columns))))
            else:
                with pq.ParquetWriter(out, self.schema) as file:
                    for batch in iterator:
                        file.write_batch(pa.RecordBatch.from_arrays(batch.columns, schema=batch.schema).cast(self.schema))
                        rows += batch.num_rows
        return Written(f"data/{self.version}/{name}", rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.root)
        done = [m for m in messages if m is not None]
        manifest = {"version": self.version, "files": sorted(m.file for m in done), "rows": sum(m.rows for m in done)}
        store.create_dir(f"{root}/manifests", recursive=True)
        hidden, final = f"{root}/manifests/_{self.version}", f"{root}/manifests/{self.version}.json"
        with store.open_output_stream(hidden) as out:
            out.write(json.dumps(manifest).encode())
        store.move(hidden, final)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _open(self.root)
        if store.get_file_info(f"{root}/data/{self.version}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/data/{self.version}")


class CommittedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        wanted = self.options.get("columns")
        if wanted is not None:
            given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            if given != wanted:
                raise ValueError(f"the target has the columns ({wanted}), the frame ({given})")
        return CommittedWriter(self.options["path"], self.options.get("kind", "parquet"), schema)


def refresh(df: DataFrame, path: str, kind: str = "parquet", columns: str | None = None) -> None:
    """Replace the rows of the folder by those of ``df``, all or none; ``kind`` is ``parquet`` or ``xlsx``.

    ``columns`` lists the target's columns as ``name type, name type``.
    """
    df.sparkSession.dataSource.register(CommittedSource)
    writer = df.write.format(NAME).mode("append").option("path", path).option("kind", kind)
    (writer if columns is None else writer.option("columns", columns)).save()


def read_refreshed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the last committed refresh."""
    root = path.rstrip("/")
    manifests = spark.read.schema("version string, files array<string>, rows long").json(f"{root}/manifests")
    last = manifests.orderBy("version", ascending=False).first()
    files = [f"{root}/{f}" for f in last["files"]] if last else []
    if not files:
        return spark.createDataFrame([], schema)
    if files[0].endswith(".xlsx"):
        return read_workbooks(spark, files, schema)
    return spark.read.schema(schema).parquet(*files)
