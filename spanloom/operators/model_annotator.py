"""A span model over whole collections: from a folder of files to a folder of annotated files.

The model is injected: ``load`` is called once in each worker and gives an object with ``predict`` (lists of pieces to lists of labels: 1
begins a mention, 0 is outside, anything else goes on) and, if its pieces aren't words, ``pieces`` (a text to (piece, start, end)).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.operators import boundaries, spans
from spanloom.operators.lineage import cut
from spanloom.sources.files import annotated_json, passages, read_collections
from spanloom.sources.sink import finished, write_collections

#: Windows that a model gets at once.
BATCH = 64
_PIECE = re.compile(r"\w+|[^\w\s]")
_LOADED: dict[str, Any] = {}
_KEY = "file_name string, doc_no int, passage_no int"
_ARROW = pa.schema(
    [("file_name", pa.string()), ("doc_no", pa.int32()), ("passage_no", pa.int32()), ("window", pa.int32()), ("windows", pa.int32()), ("pieces", pa.list_(pa.string()))]
    + [(c, pa.list_(pa.int32())) for c in ("labels", "starts", "ends")]
)


def _model(token: str, load: Callable[[], Any]) -> Any:
    """Loaded once in a worker; another run's model goes."""
    if token not in _LOADED:
        _LOADED.clear()
        _LOADED[token] = load()
    return _LOADED[token]


def text_pieces(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in _PIECE.finditer(text)]


def labelled_windows(rows: DataFrame, load: Callable[[], Any], size: int = 512, stride: int = 50) -> DataFrame:
    """A row for each window of ``size`` pieces, sharing ``stride`` with the one before: the keys, window, windows (of the text), pieces,
    labels, starts, ends. rows: file_name, doc_no, passage_no, text. A text without pieces has no window.
    """
    if not 0 <= stride < size:
        raise ValueError("stride must lie between 0 and size")
    token = uuid.uuid4().hex

    def windows(batch: pa.RecordBatch, cut_up: Callable) -> Iterator[tuple]:
        for *key, text in zip(*[batch.column(c).to_pylist() for c in ("file_name", "doc_no", "passage_no", "text")], strict=True):
            found = cut_up(text or "")
            first = range(0, max(1, len(found) - stride), size - stride) if found else []
            for k, at in enumerate(first):
                part = found[at : at + size]
                yield (*key, k, len(first), *(list(x) for x in zip(*part, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(token, load)
        held: list[tuple] = []
        for b in batches:
            for w in windows(b, getattr(model, "pieces", text_pieces)):
                held.append(w)
                if len(held) == BATCH:
                    yield labelled(model, held)
                    held = []
        if held:
            yield labelled(model, held)

    def labelled(model: Any, held: list[tuple]) -> pa.RecordBatch:
        labels = [[int(x) for x in got] for got in model.predict([w[5] for w in held])]
        if [len(x) for x in labels] != [len(w[5]) for w in held]:
            raise ValueError("the model must give a label for each piece")
        rows = [(*w[:6], got, *w[6:]) for w, got in zip(held, labels, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return rows.select("file_name", "doc_no", "passage_no", "text").mapInArrow(run, f"{_KEY}, window int, windows int, pieces array<string>, labels array<int>, starts array<int>, ends array<int>")


def model_mentions(rows: DataFrame, load: Callable[[], Any], size: int = 512, stride: int = 50, agreement: float = 0.0, skip_start: bool = True, repair_offsets: bool = False) -> DataFrame:
    """file_name, doc_no, passage_no, start, length, text: a model's mentions in passages (sources.files.passages).

    Every window's labels are decoded (spans.decode_labels), and windows vote: a mention stays if, of the windows that hold it whole, the
    share that found it reaches ``agreement`` (0: any). A mention at the very start of a passage is left out unless ``skip_start`` is false, as
    existing annotations have it. Then boundaries.settle. Line ends count as spaces. The model runs at once, on every passage once (a checkpoint).
    """
    plain = rows.select("file_name", "doc_no", "passage_no", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    seen = cut(labelled_windows(plain.where("text IS NOT NULL"), load, size, stride)).withColumn("doc_id", F.struct("file_name", "doc_no", "passage_no", "window"))
    each = seen.select("doc_id", F.posexplode(F.arrays_zip("pieces", "labels")).alias("pos", "p")).select("doc_id", "pos", "p.pieces", "p.labels").toDF("doc_id", "pos", "piece", "label")
    decoded = spans.decode_labels(each).join(seen.select("doc_id", "windows", "starts", "ends"), "doc_id")
    step = size - stride
    first, stop = F.col("doc_id.window") * step + F.col("first"), F.col("doc_id.window") * step + F.col("stop")
    holders = F.least(F.floor(first / step), F.col("windows") - 1) - F.greatest(F.lit(0), F.ceil((stop - size) / step)) + 1
    passage = F.struct("doc_id.file_name", "doc_id.doc_no", "doc_id.passage_no")
    found = decoded.select(passage.alias("doc_id"), F.get("starts", F.col("first")).cast("long").alias("start"), F.get("ends", F.col("stop") - 1).cast("long").alias("end"), holders.alias("holders"), F.col("doc_id.window").alias("window"))
    votes = found.groupBy("doc_id", "start", "end").agg(F.countDistinct("window").alias("n"), F.max("holders").alias("holders")).where(F.col("n") >= F.lit(agreement) * F.col("holders"))
    if skip_start:
        votes = votes.where("start <> 0")
    docs = plain.select(F.struct("file_name", "doc_no", "passage_no").alias("doc_id"), "text")
    out = boundaries.settle(votes.select("doc_id", "start", (F.col("end") - F.col("start")).alias("length")), docs, repair_offsets)
    return out.select("doc_id.*", "start", "length", "text")


def annotate_collections_by_model(
    spark: SparkSession, folder: str, out: str, load: Callable[[], Any], link: Callable[[DataFrame], DataFrame] | None = None, pattern: str = "*_bioc.json",
    kind: str = "microbiome", annotator: str = "spanloom", at: datetime | None = None, **options: Any,
) -> None:
    """Reads the collections of ``folder`` that ``out`` does not have yet, annotates them by a model and writes each to a file of its name.

    ``link`` adds tax_id to mentions (with their text); without it identifiers are empty. The passages' annotations are replaced; ids count from 1 in a
    file, by document, passage and start. Further options as for model_mentions. Files without documents are written as they are.
    """
    files = cut(read_collections(spark, folder, pattern).join(finished(spark, out, pattern), "file_name", "left_anti"))
    rows = passages(files)
    mentions = model_mentions(rows, load, **options)
    mentions = link(mentions) if link else mentions.withColumn("tax_id", F.lit(None).cast("string"))
    offset = rows.select("file_name", "doc_no", "passage_no", F.coalesce("offset", F.lit(0)).alias("offset"))
    stamp = (at or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    info = F.create_map(
        F.lit("type"), F.lit(kind), F.lit("identifier"), F.coalesce(F.col("tax_id").cast("string"), F.lit("")), F.lit("annotator"), F.lit(annotator), F.lit("updated_at"), F.lit(stamp)
    )
    nth = F.row_number().over(Window.partitionBy("file_name").orderBy("doc_no", "passage_no", "start", "length")).cast("string")
    notes = mentions.join(offset, ["file_name", "doc_no", "passage_no"]).withColumn("start", F.col("start") + F.col("offset")).select("file_name", "doc_no", "passage_no", "start", "length", "text", info.alias("infons"), nth.alias("id"))
    write_collections(annotated_json(rows.withColumn("annotations", F.lit(None).cast(rows.schema["annotations"].dataType)), notes, files), out, indent=2, ascii=False)
