"""One output file for each input file: a Python data source that commits whole files or none.

Tasks write to a folder of the job's own; only when all have ended are the files moved to their names, and a job
that fails takes its folder away. So a file that is there is whole, whatever happens to tasks or the driver. Paths are
those that pyarrow's file systems open (a shared mount, hdfs, object stores); executors must reach them.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: where they lie now, and their names."""

    files: list[tuple[str, str]]


class FileWriter(DataSourceWriter):
    def __init__(self, folder: str, indent: int | None, ascii_: bool):
        self.folder, self.indent, self.ascii = folder, indent, ascii_
        self.job = uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str, str]:
        system, root = fs.FileSystem.from_uri(self.folder)
        return system, root, f"{root}/_writing-{self.job}"

    def write(self, iterator) -> Written:
        system, _, own = self._at()
        system.create_dir(own, recursive=True)
        files = []
        for row in iterator:
            if not row["file_name"] or "/" in row["file_name"]:
                raise ValueError(f"not a file name: {row['file_name']!r}")
            text = row["json"] if self.indent is None else json.dumps(json.loads(row["json"]), indent=self.indent, ensure_ascii=self.ascii)
            path = f"{own}/{uuid.uuid4().hex}"  # another attempt of the task has names of its own
            with system.open_output_stream(path) as out:
                out.write(text.encode())
            files.append((path, row["file_name"]))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root, own = self._at()
        files = [x for m in messages if m is not None for x in m.files]
        if twice := [name for name, n in Counter(name for _, name in files).items() if n > 1]:
            self.abort(messages)
            raise ValueError(f"several rows for one file: {twice[:3]}")
        system.create_dir(root, recursive=True)
        for path, name in files:
            system.move(path, f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, own = self._at()
        if system.get_file_info(own).type != fs.FileType.NotFound:
            system.delete_dir(own)


class CollectionFiles(DataSource):
    """Rows (file_name, json) as files; options: path, indent (none: as it is), ascii (other characters as escapes)."""

    @classmethod
    def name(cls) -> str:
        return "collection_files"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        indent = self.options.get("indent", "")
        return FileWriter(self.options["path"], int(indent) if indent else None, self.options.get("ascii", "true") == "true")


def write_collections(rows: DataFrame, folder: str, indent: int | None = 4, ascii: bool = True) -> None:  # noqa: A002
    """Writes each row (file_name, json) to a file of that name, replacing one that is there; others stay.

    ``folder`` is an absolute path or a URI. Two rows of one name are an error, and nothing is written then.
    """
    spark = rows.sparkSession
    spark.dataSource.register(CollectionFiles)
    out = rows.select("file_name", "json").write.format("collection_files").mode("append").option("path", folder).option("ascii", str(ascii).lower())
    (out if indent is None else out.option("indent", str(indent))).save()


def finished(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """file_name of the files that a folder holds; none where there is no such folder. Nothing is read but the listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "file_name string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listed.select(F.col("_metadata.file_name").alias("file_name"))
