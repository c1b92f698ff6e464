"""Numbering rows in order, group by group, and reading ordered rows in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import fresh, staged

#: Up to so many rows of counts (one for each run and group) are broadcast; more are joined by a shuffle.
SMALL_COUNTS = 100_000
#: Rows, and characters of text, of a batch that a task hands on.
OUT_ROWS, OUT_CHARS = 4096, 8 << 20


def ranked(spark: SparkSession, rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with idx (from 0, by ``order`` within the group) and n (rows of the group).

    Rows are sorted into runs by ranges of group, order and arrival, so that neither a group nor equal rows
    need one task; a row's number is its place in the run plus the rows of its group in earlier runs. ``group`` holds no nulls,
    ``order`` short values (ranges are sampled on the driver). ``rows`` is read twice and should be staged.
    """
    tie, at, run, first, m, before = (fresh(x) for x in ("tie", "at", "run", "first", "m", "before"))
    keys = [F.col(group).asc(), *order, F.col(tie).asc()]
    runs = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    place = F.monotonically_increasing_id()
    runs = staged(spark, runs.withColumn(at, place).withColumn(run, F.shiftright(at, 33).cast("int")).withColumn(at, F.col(at).bitwiseAND(F.lit((1 << 33) - 1))))
    counts = runs.groupBy(run, group).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(m))
    earlier = Window.partitionBy(group).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(m).over(earlier), F.lit(0)) - F.col(first)).withColumn("n", F.sum(m).over(Window.partitionBy(group))).drop(first, m)
    counts = staged(spark, counts)
    few = counts.count() <= SMALL_COUNTS
    return runs.join(F.broadcast(counts) if few else counts, [run, group]).withColumn("idx", F.col(at) + F.col(before)).drop(run, at, before)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of at most OUT_ROWS of the rows, and no more than a row beyond OUT_CHARS."""
    held: list[tuple] = []
    chars = 0
    for r in rows:
        held.append(r)
        chars += sum(len(x) for x in r if isinstance(x, str))
        if len(held) == OUT_ROWS or chars > OUT_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
