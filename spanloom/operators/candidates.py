"""From names to candidates: exact top-k by a sparse and a dense score, with bounds in place of all pairs.

The vocabulary is cut into cells of at most about CELL_ROWS names that lie near one of PIVOTS vectors and begin alike. Of a cell are
known its centre, its radius, and each term's greatest weight: the inverted list of its terms, cut down to one posting. For a query q they
bound any score in the cell: ``weight * sum(q[t] * most[t]) + q . centre + |q| * radius``. A query is scored in its most
promising cells first; the k-th best score found is then its threshold, and only cells whose bound reaches it are scored as well. Nothing that
could be among the best k is left out. Bounds are taken in blocks of queries and cells, scores in blocks of queries and one
cell's rows, so no task holds more than a block of either.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions.text import text_preprocess
from spanloom.operators.lineage import cut
from spanloom.sources.store import refresh

PIVOTS, CELL_ROWS, CELL_BLOCK, QUERY_BLOCK = 64, 2048, 512, 1024
#: Scores closer than this count as equal, so that rounding leaves nothing out.
SLACK = 1e-9
_VECTOR = "terms array<string>, weights array<double>, dense array<double>"


# ------------------------------------------------------------------ the sparse encoder
def grams(name: Column) -> Column:
    """Characters and pairs of neighbours, repeated as they occur."""
    chars = F.filter(F.split(name, ""), lambda c: c != "")
    pairs = F.transform(F.sequence(F.lit(1), F.length(name) - 1), lambda i: name.substr(i, F.lit(2)))
    return F.concat(chars, F.when(F.length(name) > 1, pairs).otherwise(F.array().cast("array<string>")))


def fit(names: DataFrame) -> DataFrame:
    """term, idf: smoothed, over the rows of ``names`` (name); one row for each different character and pair."""
    n = names.count()
    df = names.select(F.explode(F.array_distinct(grams(F.col("name")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.select("term", (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def encode(rows: DataFrame, encoder: DataFrame, key: str = "id") -> DataFrame:
    """``rows`` (key, name, ...) with terms and weights of length one; terms that the encoder does not know don't count."""
    tf = rows.select(key, F.explode(grams(F.col("name"))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    raw = tf.join(encoder, "term").select(key, F.struct("term", (F.col("tf") * F.col("idf")).alias("w")).alias("p"))
    vector = raw.groupBy(key).agg(F.array_sort(F.collect_list("p")).alias("p"))
    norm = F.sqrt(F.aggregate("p", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    vector = vector.select(key, F.transform("p", lambda x: x["term"]).alias("terms"), F.transform("p", lambda x: x["w"] / norm).alias("weights"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return rows.join(vector, key, "left").select(*rows.columns, none("terms", "array<string>"), none("weights", "array<double>"))


#: Names that a model gets at once.
EMBED_BATCH = 1024
_LOADED: dict[str, Any] = {}


def embedded(names: DataFrame, load: Callable[[], Any]) -> DataFrame:
    """name, dense: the vectors that a model (``embed``, a list of names to a matrix) gives; it is loaded once in a worker."""
    token = uuid.uuid4().hex

    def run(batches):
        if token not in _LOADED:
            _LOADED.clear()
            _LOADED[token] = load()
        for pdf in batches:
            for i in range(0, len(pdf), EMBED_BATCH):
                part = pdf.iloc[i : i + EMBED_BATCH]
                yield pd.DataFrame({"name": part["name"], "dense": [[float(x) for x in v] for v in _LOADED[token].embed(part["name"].tolist())]})

    return names.select("name").mapInPandas(run, "name string, dense array<double>")


def stored_vocabulary(spark: SparkSession, folder: str, names: DataFrame, load: Callable[[], Any], version: str) -> DataFrame:
    """id, name, dense of a vocabulary (id, name), vectors from the folder where it has them: only names that are new to it are embedded, and
    all of them after a change of ``version`` (the model's)."""
    return refresh(spark, folder, names.select("id", "name"), ["name"], lambda new: embedded(new, load), version)


# ------------------------------------------------------------------ cells
def _dense(rows: pd.Series, width: int) -> np.ndarray:
    return np.stack([np.asarray(x, float) for x in rows]) if width else np.zeros((len(rows), 0))


def _sparse(terms: pd.Series, weights: pd.Series, index: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(terms), len(index)))
    for i, (ts, ws) in enumerate(zip(terms, weights, strict=True)):
        for t, w in zip(ts, ws, strict=True):
            if t in index:
                out[i, index[t]] = w
    return out


def cells(spark: SparkSession, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (id, name, terms, weights, dense) with its cell, and the cells: cell, n, centre, radius, terms, most.

    Pivots are the rows with the least hashes of their ids, at most PIVOTS. Both tables are kept (checkpoints).
    """
    width = vocabulary.select(F.max(F.size("dense"))).first()[0] or 0
    chosen = [r["dense"] for r in vocabulary.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("dense").collect()]
    chosen = np.array(chosen, float).reshape(len(chosen), width)

    def nearest(batches):
        for pdf in batches:
            at = np.zeros(len(pdf), int)
            if width and len(pdf):
                x = _dense(pdf["dense"], width)
                at = ((chosen**2).sum(1) - 2 * x @ chosen.T).argmin(1)
            yield pdf.assign(pivot=at.astype("int32"))

    kinds = f"id {vocabulary.schema['id'].dataType.simpleString()}, name string, {_VECTOR}, pivot int"
    placed = vocabulary.select("id", "name", "terms", "weights", F.col("dense").cast("array<double>").alias("dense")).mapInPandas(nearest, kinds)
    placed = cut(placed.withColumn("start", F.substring("name", 1, 1)))
    many = placed.groupBy("pivot", "start").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("string")
    rows = cut(placed.join(many, ["pivot", "start"]).select("id", "name", "terms", "weights", "dense", F.concat_ws("/", F.col("pivot").cast("string"), part, "start").alias("cell")))

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _dense(pdf["dense"], width)
        most: dict[str, float] = {}
        for ts, ws in zip(pdf["terms"], pdf["weights"], strict=True):
            for t, w in zip(ts, ws, strict=True):
                most[t] = max(most.get(t, 0.0), w)
        c = x.mean(0)
        return pd.DataFrame([{"cell": pdf["cell"].iloc[0], "n": len(pdf), "centre": c, "radius": float(np.sqrt(((x - c) ** 2).sum(1)).max()), "terms": list(most), "most": list(most.values())}])

    return rows, cut(rows.groupBy("cell").applyInPandas(summary, "cell string, n long, centre array<double>, radius double, terms array<string>, most array<double>"))


# ------------------------------------------------------------------ bounds and scores
def _bounded(queries: DataFrame, about: DataFrame, k: int, weight: float) -> DataFrame:
    """query_id, cell, n, bound. Without thresholds (least null): of each block of cells the best that together hold k rows; with: all that reach it."""
    nq, nc = (max(1, -(-df.count() // size)) for df, size in ((queries, QUERY_BLOCK), (about, CELL_BLOCK)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    qs = queries.select("*", block("query_id", nq).alias("qb"), every(nc).alias("cb"))
    cs = about.select("*", block("cell", nc).alias("cb"), every(nq).alias("qb"))

    def bounds(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "cell": [], "n": [], "bound": []}).astype({"query_id": "int64", "cell": str, "n": "int64", "bound": float})
        if not len(q) or not len(c):
            return out
        index = {t: i for i, t in enumerate(sorted({t for ts in q["terms"] for t in ts}))}
        width = len(q["dense"].iloc[0])
        x = _dense(q["dense"], width)
        high = weight * _sparse(q["terms"], q["weights"], index) @ _sparse(c["terms"], c["most"], index).T
        high += x @ _dense(c["centre"], width).T + np.sqrt((x**2).sum(1))[:, None] * c["radius"].to_numpy()[None]
        order, n = np.argsort(-high, axis=1, kind="stable"), c["n"].to_numpy()
        least = q["least"].to_numpy(float)
        before = np.cumsum(n[order], axis=1) - n[order]
        take = np.where(np.isnan(least)[:, None], before < k, np.take_along_axis(high, order, 1) >= least[:, None] - SLACK)
        i, j = np.nonzero(take)
        at = order[i, j]
        return pd.DataFrame({"query_id": q["query_id"].to_numpy()[i], "cell": c["cell"].to_numpy()[at], "n": n[at], "bound": high[i, at]})

    return qs.groupBy("qb", "cb").cogroup(cs.groupBy("qb", "cb")).applyInPandas(bounds, "query_id long, cell string, n long, bound double")


def _scored(pairs: DataFrame, queries: DataFrame, rows: DataFrame, k: int, weight: float) -> DataFrame:
    """query_id, id, name, score: the best k rows of each cell for each query that is paired with it."""
    load = pairs.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")
    qs = pairs.select("query_id", "cell").join(load, "cell").select("cell", part.alias("part"), "query_id").join(queries, "query_id")
    vs = rows.join(load, "cell").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    kind = rows.schema["id"].dataType.simpleString()

    def best(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "id": [], "name": [], "score": []})
        v = v.sort_values("id")
        index = {t: i for i, t in enumerate(sorted({t for ts in q["terms"] for t in ts}))}
        width = len(q["dense"].iloc[0])
        score = weight * _sparse(q["terms"], q["weights"], index) @ _sparse(v["terms"], v["weights"], index).T + _dense(q["dense"], width) @ _dense(v["dense"], width).T
        at = np.argsort(-np.round(score, 9), axis=1, kind="stable")[:, :k]
        return pd.DataFrame({"query_id": np.repeat(q["query_id"].to_numpy(), at.shape[1]), "id": v["id"].to_numpy()[at.reshape(-1)], "name": v["name"].to_numpy()[at.reshape(-1)], "score": np.take_along_axis(score, at, 1).reshape(-1)})

    return qs.groupBy("cell", "part").cogroup(vs.groupBy("cell", "part")).applyInPandas(best, f"query_id long, id {kind}, name string, score double")


def top_candidates(spark: SparkSession, vocabulary: DataFrame, queries: DataFrame, k: int = 5, weight: float = 1.0) -> DataFrame:
    """query_id, id, name, score, rank, compared: the best k names of the vocabulary for each query, exactly.

    vocabulary: id, name, terms, weights, dense (see encode; dense of one length, empty ones allowed); queries: query_id (a long), terms, weights,
    dense. The score is weight * sparse + dense; of equal scores (to nine digits) the least ids. compared: the rows that were scored for the query.
    Runs at once; an empty vocabulary or no query gives no rows.
    """
    if weight < 0:
        raise ValueError("the sparse weight must not be negative")
    rows, about = cells(spark, vocabulary)
    queries = cut(queries.select("query_id", "terms", "weights", F.col("dense").cast("array<double>").alias("dense")))
    of = Window.partitionBy("query_id")
    first = _bounded(queries.withColumn("least", F.lit(None).cast("double")), about, k, weight)
    held = F.coalesce(F.sum("n").over(of.orderBy(F.col("bound").desc(), "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = cut(first.withColumn("held", held).where(F.col("held") < k).drop("held"))
    one = cut(_scored(first, queries, rows, k, weight))
    nth = F.row_number().over(of.orderBy(F.col("score").desc(), "id"))
    least = one.withColumn("nth", nth).where(F.col("nth") == k).select("query_id", F.col("score").alias("least"))
    open_ = queries.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    more = cut(_bounded(open_, about, k, weight).join(first.select("query_id", "cell"), ["query_id", "cell"], "left_anti"))
    both = one.unionByName(_scored(more, queries, rows, k, weight))
    rank = F.row_number().over(of.orderBy(F.round("score", 9).desc(), "id"))
    compared = first.unionByName(more).groupBy("query_id").agg(F.sum("n").alias("compared"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).join(compared, "query_id")


# ------------------------------------------------------------------ from names
def link_names(spark: SparkSession, names: DataFrame, vocabulary: DataFrame, encoder: DataFrame, k: int = 5, weight: float = 1.0) -> DataFrame:
    """mention, rank, id, name, score: candidates of each different name (mention, dense: its vector, any length of its own column kind).

    A mention is lower-cased and loses its punctuation before it is encoded, as the vocabulary's names did. Without a column dense only the sparse score counts
    (the vocabulary's dense vectors must be empty then). A null mention has no candidates.
    """
    dense = "dense" in names.columns
    each = names.where("mention IS NOT NULL").groupBy("mention").agg(F.first("dense").alias("dense") if dense else F.first(F.array().cast("array<double>")).alias("dense"))
    each = cut(each.withColumn("query_id", F.monotonically_increasing_id()))
    queries = encode(each.select("query_id", text_preprocess(F.col("mention")).alias("name"), "dense"), encoder, "query_id")
    found = top_candidates(spark, vocabulary, queries, k, weight)
    return found.join(each.select("query_id", "mention"), "query_id").select("mention", "rank", "id", "name", "score")


def candidates_json(found: DataFrame) -> DataFrame:
    """mention, candidates (a JSON list of {id: name}, best first) of link_names."""
    per = found.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").cast("string").alias("id"), "name"))).alias("c"))
    return per.select("mention", F.to_json(F.transform("c", lambda x: F.create_map(x["id"], x["name"]))).alias("candidates"))


def save_candidates(found: DataFrame, folder: str) -> None:
    """A JSON line {mention, candidates: [{id: name}, ...]} for each mention, in a new folder."""
    rows = candidates_json(found)
    rows.select(F.concat(F.lit('{"mention":'), F.to_json(F.array("mention")).substr(F.lit(2), F.length(F.to_json(F.array("mention"))) - 2), F.lit(',"candidates":'), "candidates", F.lit("}")).alias("value")).write.text(folder)
