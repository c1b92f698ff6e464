"""Tables that are kept between runs, by content: only rows that are new are made again.

A folder holds parts (Parquet, by buckets of the key's first two hexadecimal digits) and numbered manifests. The manifest of the highest number says
which parts count and for which version. A part is written whole before a manifest names it, and a manifest is a new file that none may
replace, so a run that fails changes nothing, and of two runs at once the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifest(spark: SparkSession, folder: str) -> dict:
    """number, version, schema, parts of the last manifest; of an empty folder number 0 and no parts."""
    system, path = _folder(spark, folder)
    numbers = [int(s.getPath().getName()[9:-5]) for s in (system.listStatus(path) if system.exists(path) else []) if s.getPath().getName().startswith("manifest-")]
    if not numbers:
        return {"number": 0, "version": None, "schema": None, "parts": []}
    rows = spark.read.option("wholetext", True).text(f"{folder}/manifest-{max(numbers):012d}.json").collect()
    return json.loads(rows[0][0])


def _commit(spark: SparkSession, folder: str, after: dict, version: str, schema: StructType, parts: list[str]) -> None:
    system, _ = _folder(spark, folder)
    number = after["number"] + 1
    text = json.dumps({"number": number, "version": version, "schema": schema.jsonValue(), "parts": parts})
    out = system.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest-{number:012d}.json"), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read(spark: SparkSession, folder: str, schema: StructType, parts: list[str]) -> DataFrame:
    whole = StructType([*schema.fields, *StructType.fromDDL("bucket string").fields])
    if not parts:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", folder).parquet(*[f"{folder}/{p}" for p in parts]).drop("part")


def _write(rows: DataFrame, folder: str) -> str:
    part = f"part={uuid.uuid4().hex}"
    rows.write.partitionBy("bucket").parquet(f"{folder}/{part}")
    return part


def _keyed(rows: DataFrame, content: list[str]) -> DataFrame:
    """key: the digest of the content columns, null and text told apart; bucket: its first two digits."""
    said = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in content]
    return rows.withColumn("key", F.sha2(F.concat(*said).cast("binary"), 256)).withColumn("bucket", F.substring("key", 1, 2))


def refresh(spark: SparkSession, folder: str, rows: DataFrame, content: list[str], make: Callable[[DataFrame], DataFrame], version: str) -> DataFrame:
    """``rows`` with what ``make`` adds to their content columns, made for those alone that the folder does not have in this version.

    ``make`` gets the different new contents and returns them with more columns; it must be a function of the content. Rows of the folder that
    ``rows`` does not have stay for later (see compact). Another version starts anew.
    """
    now = manifest(spark, folder)
    keyed = _keyed(rows, content)
    wanted = keyed.select("bucket", "key", *content).dropDuplicates(["key"])
    shape = make(spark.createDataFrame([], wanted.select(*content).schema)).schema
    schema = StructType([wanted.schema["key"], *shape.fields])
    parts = now["parts"] if (now["version"], now["schema"]) == (version, schema.jsonValue()) else []
    if parts:
        wanted = wanted.join(_read(spark, folder, schema, parts).select("bucket", "key"), ["bucket", "key"], "left_anti")
    if wanted.limit(1).count():
        part = _write(_keyed(make(wanted.select(*content)), content).select(*schema.names, "bucket"), folder)
        parts = [*parts, part]
        _commit(spark, folder, now, version, schema, parts)
    kept = _read(spark, folder, schema, parts)
    more = [c for c in shape.names if c not in content]
    return keyed.join(kept.select("bucket", "key", *more), ["bucket", "key"]).select(*rows.columns, *more)


def compact(spark: SparkSession, folder: str, rows: DataFrame, content: list[str]) -> None:
    """One part of the contents that ``rows`` has, in place of all parts; files of earlier parts stay until they are removed by hand."""
    now = manifest(spark, folder)
    schema = StructType.fromJson(now["schema"])
    kept = _read(spark, folder, schema, now["parts"]).join(_keyed(rows, content).select("bucket", "key").distinct(), ["bucket", "key"], "left_semi")
    _commit(spark, folder, now, now["version"], schema, [_write(kept.select(*schema.names, "bucket"), folder)])


def save(spark: SparkSession, folder: str, rows: DataFrame, content: list[str], version: str = "1") -> None:
    """Keeps a table as it is (a layout, say), by the columns that identify a row; it replaces what the folder had."""
    schema = _keyed(rows, content).drop("bucket").schema
    _commit(spark, folder, manifest(spark, folder), version, schema, [_write(_keyed(rows, content), folder)])


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The table that save or refresh has kept."""
    now = manifest(spark, folder)
    if not now["parts"]:
        raise ValueError(f"nothing is kept in {folder}")
    return _read(spark, folder, StructType.fromJson(now["schema"]), now["parts"]).drop("key", "bucket")
