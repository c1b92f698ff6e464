"""Articles from a service: fetched in paced lanes, kept as files, converted to collections; what fails is set aside, not lost.

The transport is injected (``load`` gives a function from an id to (status, text)), so nothing here knows a service. Ids are dealt
to lanes, each a task of its own that makes one request at a time. A fetched text is written before anything reads it again: first to a table in the
folder, from there to a file of its own, so no request is made twice, and a run that was broken off goes on with the ids that have no file.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut
from spanloom.sources.articles import article_passages, read_articles
from spanloom.sources.files import annotated_json
from spanloom.sources.sink import finished, write_collections

#: Answers that are worth another try; the first of them ends a lane when it stays.
AGAIN = (429, 500, 502, 503, 504)
STOP = 429
_LOG = pa.schema([("id", pa.string()), ("state", pa.string()), ("status", pa.int32()), ("tries", pa.int32()), ("error", pa.string()), ("text", pa.string())])
_LOG_DDL = "id string, state string, status int, tries int, error string, text string"


def _tried(get: Callable[[str], tuple[int, str]], one: str, attempts: int, back_off: float, sleep: Callable[[float], None]) -> tuple[str, int | None, int, str | None, str | None]:
    """state, status, tries, error, text of one id, asked again after AGAIN and errors of the transport, each time after twice the wait."""
    status = error = None
    for n in range(1, attempts + 1):
        if n > 1:
            sleep(back_off * 2 ** (n - 2))
        try:
            status, text = get(one)
            error = None
        except Exception as e:  # whatever a transport raises is a failed request
            status, text, error = None, None, f"{type(e).__name__}: {e}"
        if status == 200:
            return "fetched", status, n, None, text
        if error is None and status not in AGAIN:
            break
    return "failed", status, n, error, None


def fetched(ids: DataFrame, load: Callable[[], Callable[[str], tuple[int, str]]], lanes: int = 1, pause: float = 1.0, attempts: int = 3, back_off: float = 1.0) -> DataFrame:
    """id, state (fetched, failed, stopped), status, tries, error, text. A lane that is told to slow down and stays so asks for no more: its other
    ids are 'stopped'. Not to be computed twice: every evaluation makes the requests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, stopped, first = load(), False, True
        for b in batches:
            for one in b.column("id").to_pylist():
                row: tuple = ("stopped", None, 0, None, None)
                if not stopped:
                    if not first:
                        time.sleep(pause)
                    first = False
                    row = _tried(get, one, attempts, back_off, time.sleep)
                    stopped = row[0] == "failed" and row[1] == STOP
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((one, *row), _LOG.types, strict=True)], schema=_LOG)

    return ids.select("id").repartition(lanes, "id").mapInArrow(run, _LOG_DDL)


def download(spark: SparkSession, ids: DataFrame, folder: str, load: Callable[[], Callable[[str], tuple[int, str]]], **pacing: float) -> DataFrame:
    """Fetches the ids (id: texts fit for file names; blank ones go) that ``folder`` has no xml/<id>.xml of, and returns this run's log: id, state, status, tries, error.

    The log of every run stays in folder/log. Options as for ``fetched``.
    """
    wanted = ids.select(F.trim(F.col("id").cast("string")).alias("id")).where("id <> ''").distinct()
    had = finished(spark, f"{folder}/xml", "*.xml").select(F.regexp_replace("file_name", "[.]xml$", "").alias("id"))
    run = f"{folder}/log/run={uuid.uuid4().hex}"
    fetched(cut(wanted.join(had, "id", "left_anti")), load, **pacing).write.parquet(run)
    log = spark.read.schema(_LOG_DDL).parquet(run)
    write_collections(log.where("state = 'fetched'").select(F.concat("id", F.lit(".xml")).alias("file_name"), F.col("text").alias("json")), f"{folder}/xml", indent=None)
    return log.drop("text")


def convert(spark: SparkSession, folder: str, terms: DataFrame | None = None) -> DataFrame:
    """Writes collections/<id>_bioc.json for the articles of folder/xml that have none yet, and returns what can't be converted: file_name, reason.

    That is kept in folder/quarantine, and left out by later runs; the files stay.
    """
    found = finished(spark, f"{folder}/xml", "*.xml")
    made = finished(spark, f"{folder}/collections", "*_bioc.json").select(F.regexp_replace("file_name", "_bioc[.]json$", ".xml").alias("file_name"))
    aside = _quarantine(spark, folder)
    new = cut(found.join(made, "file_name", "left_anti").join(aside.select("file_name"), "file_name", "left_anti"))
    parts = cut(read_articles(spark, f"{folder}/xml").join(new, "file_name", "left_semi")) if new.limit(1).count() else None
    if parts is None:
        return aside.limit(0)
    bad = parts.where("kind = 'error'").select("file_name", F.col("text").alias("reason"))
    run = f"{folder}/quarantine/run={uuid.uuid4().hex}"
    bad.write.parquet(run)
    passages = article_passages(parts, terms).withColumn("file_name", F.regexp_replace("file_name", "[.]xml$", "_bioc.json"))
    none = spark.createDataFrame([], "file_name string, doc_no int, passage_no int, start long, length long, text string, tax_id string")
    write_collections(annotated_json(passages, none), f"{folder}/collections", indent=2, ascii=False)
    return spark.read.schema("file_name string, reason string").parquet(run)


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/quarantine")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "file_name string, reason string")
    return spark.read.schema("file_name string, reason string").option("recursiveFileLookup", True).parquet(f"{folder}/quarantine")
