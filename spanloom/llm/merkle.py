"""A Merkle manifest of a data set, in an external-memory node store.

Leaves are hashed in the JVM and sorted into runs (by group and key), which number them. Nodes live in Parquet,
partitioned by level, at coordinates (group, level, idx). A step reads one level in order, in blocks of 2 ** STEP
nodes, and writes the STEP levels above it; a block is all that a task holds. Proofs come from scans in the other
direction: per block, the nodes of the step's levels are merged with the block root's own path, in the order of their
coordinates, and every node of the lowest level takes its siblings from there. A group of any size is spread over its
blocks; nothing but the size of the largest group reaches the driver.

A proof is text: for each level from the leaf to the root a side (``L``: the sibling stands left, ``R``: right, ``U``: the run
is this node alone) and, but for ``U``, the sibling's 64 hexadecimal digits.
"""

from __future__ import annotations

import atexit
import hashlib
import uuid
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import _remove, crc_mod, shared_dir, staged, table
from spanloom.llm.oracle import crc_sql
from spanloom.llm.ordered import batched, ranked, rows_of

#: Levels that a step builds; 2 ** STEP nodes of a level and those above them are a block.
STEP = 12
_NODE = "grp string, n long, level int, idx long, hash string"
_NODE_ARROW = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("hash", pa.string())])


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def _height(n: Column) -> Column:
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and a proof give."""
    at = 0
    while at < len(proof):
        side, sibling = proof[at], proof[at + 1 : at + 65]
        if side == "U":
            leaf, at = digest(leaf), at + 1
        else:
            leaf, at = digest(sibling, leaf) if side == "L" else digest(leaf, sibling), at + 65
    return leaf


def siblings(proof: str) -> str:
    """The siblings of a proof, joined."""
    out, at = [], 0
    while at < len(proof):
        if proof[at] == "U":
            at += 1
        else:
            out.append(proof[at + 1 : at + 65])
            at += 65
    return "".join(out)


# ------------------------------------------------------------------ leaves
def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of each value as ``-`` (null) or its number of UTF-8 bytes, ``:`` and itself."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in values]
    return F.sha2(F.concat(*said).cast("binary"), 256)


# ------------------------------------------------------------------ bottom up
def _grow(batches, base: int, step: int):
    def out():
        for (grp, block, n), rows in groupby(rows_of(batches), key=lambda r: r[:3]):
            hashes, first = [r[4] for r in rows], block << step
            for level in range(base + 1, min(base + step, height(n)) + 1):
                hashes = [digest(*hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
                first >>= 1
                for i, h in enumerate(hashes):
                    yield grp, n, level, first + i, h

    return batched(out(), _NODE_ARROW)


def build(spark: SparkSession, leaves: DataFrame, step: int = STEP) -> tuple[DataFrame, int]:
    """The node store over leaves (grp, n, idx, hash): grp, n, level (1 and up), idx, hash; and its greatest height.

    One read of a level makes ``step`` levels. The store is a folder of Parquet, partitioned by level.
    """
    top = height(leaves.agg(F.max("n")).first()[0] or 1)
    path = f"{shared_dir(spark)}/spanloom-nodes-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    level = leaves.select("grp", "n", "idx", "hash")
    for base in range(0, max(top, 1), step):
        blocks = level.where(F.col("n") > 1).select("grp", F.shiftright("idx", step).alias("block"), "n", "idx", "hash")
        blocks = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
        blocks.mapInArrow(lambda b, base=base: _grow(b, base, step), _NODE).write.mode("append").partitionBy("level").parquet(path)
        level = _store(spark, path).where((F.col("level") == base + step) & (_height(F.col("n")) > base + step))
    return _store(spark, path), top


def _store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("grp string, n long, idx long, hash string, level int").parquet(path).select("grp", "n", "level", "idx", "hash")


def roots(leaves: DataFrame, store: DataFrame) -> DataFrame:
    """grp, n, hash of each group's root; the only leaf of a group is its root."""
    return leaves.where("n = 1").select("grp", "n", "hash").unionByName(store.where(F.col("level") == _height(F.col("n"))).select("grp", "n", "hash"))


# ------------------------------------------------------------------ top down
def _path(idx: int, low: int, high: int, levels: list[list[str]], first: int) -> str:
    """Sides and siblings of a node of level ``low`` up to level ``high``; levels[k] starts at first >> k."""
    out = []
    for k in range(high - low):
        at = (idx >> k) - (first >> k)
        if (idx >> k) & 1:
            out.append("L" + levels[k][at - 1])
        elif at + 1 < len(levels[k]):
            out.append("R" + levels[k][at + 1])
        else:
            out.append("U")
    return "".join(out)


def _descend(batches, base: int, step: int, schema: pa.Schema):
    """Of each block: a first row with its root's path, then its nodes by level; the lowest level goes out with its paths."""

    def out():
        for (_, block), rows in groupby(rows_of(batches), key=lambda r: r[:2]):
            head = next(rows)
            assert head[2] < 0, "a block without a root"
            n, above, tops = head[3], head[6], head[7:9]
            high = min(base + step, height(n))
            levels: list[list[str]] = [[] for _ in range(step + 1)]
            lowest = []
            for r in rows:
                levels[r[2] - base].append(r[5])
                if r[2] == base:
                    lowest.append((r[4], r[5], r[9:]))
            for idx, h, more in lowest:
                yield head[0], n, idx, h, _path(idx, base, high, levels, block << step) + above, *tops, *more

    return batched(out(), schema)


def proofs(spark: SparkSession, leaves: DataFrame, store: DataFrame, top: int, heads: DataFrame, carry: str = "", step: int = STEP) -> DataFrame:
    """grp, n, idx, hash, proof, subroot, root and the ``carry`` columns (a DDL list) of each leaf.

    heads: grp, n, proof, subroot, root of each group's root: what its nodes' paths go on with.
    """
    plain = "grp string, n long, idx long, hash string, proof string, subroot string, root string"
    low = None
    for base in reversed(range(0, max(top, 1), step)):
        more = carry if base == 0 and carry else ""
        names = [x.split()[0] for x in more.split(", ") if x]
        schema = f"{plain}, {more}" if more else plain
        none = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in more.split(", ") if x]
        h = _height(F.col("n"))
        starts = heads.where((h <= base + step) & ((h > base) | ((h == 0) if base == 0 else F.lit(False)))).select("grp", F.lit(0).cast("long").alias("block"), "n", "proof", "subroot", "root")
        if low is not None:
            starts = starts.unionByName(low.select("grp", F.col("idx").alias("block"), "n", "proof", "subroot", "root"))
        text = lambda c: F.lit(None).cast("string").alias(c)
        starts = starts.select("grp", "block", F.lit(-1).alias("level"), "n", F.lit(0).cast("long").alias("idx"), text("hash"), "proof", "subroot", "root", *none)
        nodes = store.where((F.col("level") >= max(base, 1)) & (F.col("level") < base + step) & (F.col("level") < h))
        nodes = nodes.select("grp", "n", "level", "idx", "hash", *none)
        if base == 0:
            nodes = nodes.unionByName(leaves.select("grp", "n", F.lit(0).alias("level"), "idx", "hash", *names))
        else:
            nodes = nodes.where(h > base)
        block = F.expr(f"shiftright(idx, {step} - (level - {base}))")
        nodes = nodes.select("grp", block.alias("block"), "level", "n", "idx", "hash", text("proof"), text("subroot"), text("root"), *names)
        rows = starts.unionByName(nodes).repartition("grp", "block").sortWithinPartitions("grp", "block", "level", "idx")
        arrow = pa.schema([(f.name, pa.int64() if f.dataType.simpleString() == "bigint" else pa.string()) for f in _fields(schema)])
        low = rows.mapInArrow(lambda b, base=base, arrow=arrow: _descend(b, base, step, arrow), schema)
        if base:
            low = staged(spark, low)
    return low


def _fields(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fields


# ------------------------------------------------------------------ the manifest
def manifest(spark: SparkSession, docs: DataFrame, key: str = "doc_id", group: str = "lang", values: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), other: Column | None = None, step: int = STEP) -> DataFrame:
    """Per row of ``docs``: key, leaf, proof (see the module), subroot, root and other_leaf.

    Leaves of a group ascend by the key (nulls first; equal keys by their leaves); groups ascend bytewise, null first.
    A null value, an empty text and a text of any length are hashed as such. Rows that repeat all values are
    leaves of their own. An empty table gives no rows; a table of one row has the leaf as its root and an empty proof.
    Columns that are not named in ``values`` are ignored, whatever their names. other_leaf is ``other`` (a hash to be
    checked against the proof), or null.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("-"))
    held = staged(spark, docs.select(F.col(key).cast("long").alias("key"), grp.alias("grp"), leaf_hash([F.col(c) for c in values]).alias("hash"), (F.lit(None).cast("string") if other is None else other).alias("other")))
    leaves = staged(spark, ranked(spark, held, "grp", [F.col("key").asc_nulls_first(), F.col("hash").asc()]))
    store, top = build(spark, leaves, step)
    subroots = staged(spark, roots(leaves, store))
    upper = staged(spark, ranked(spark, subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("n").alias("size"), "hash"), "grp", [F.col("name").asc()]))
    upper_store, upper_top = build(spark, upper, step)
    heads = roots(upper, upper_store).select("grp", "n", F.lit("").alias("proof"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    above = proofs(spark, upper, upper_store, upper_top, heads, "name string, size long", step)
    heads = staged(spark, above.select(F.col("name").alias("grp"), F.col("size").alias("n"), "proof", F.col("hash").alias("subroot"), "root"))
    out = proofs(spark, leaves, store, top, heads, "key long, other string", step)
    return out.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "proof", "subroot", "root", F.col("other").alias("other_leaf"))


def _verified(batches):
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]])
    return batched(((k, leaf, sub, root, digest(siblings(proof)), fold(other or leaf, proof)) for k, leaf, proof, sub, root, other in rows_of(batches)), schema)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digests of every document's proof, each checked with its leaf, tampered where 7 divides crc32.

    A null id counts as the empty text there. Other cases as in ``manifest``.
    """
    changed = leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    proofs = manifest(spark, table(spark, sf_dir, "documents"), other=F.when(crc_mod("doc_id", 7) == 0, changed))
    out = proofs.mapInArrow(_verified, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_SIBLING = "CASE WHEN s.hash IS NULL THEN sha256(w.h) WHEN w.idx % 2 = 1 THEN sha256(s.hash || w.h) ELSE sha256(w.h || s.hash) END"
OP13_SQL = f"""
WITH RECURSIVE said AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, coalesce({crc_sql("doc_id::VARCHAR")}, 0) % 7 = 0 AS bad,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS start,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
         coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents
), hashed AS (
  SELECT doc_id, grp, sha256(start || chars || body) AS leaf, CASE WHEN bad THEN sha256(start || more || body) ELSE sha256(start || chars || body) END AS given FROM said
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY 1) AS rid, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM hashed
), node(grp, level, idx, n, hash) AS (
  SELECT grp, 0, idx, n, leaf FROM leaves
  UNION ALL
  SELECT grp, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY grp, level, idx // 2, n
), subroots AS MATERIALIZED (
  SELECT grp, hash, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1
), upper_node(level, idx, n, hash) AS (
  SELECT 0, idx, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM upper_node WHERE n > 1 GROUP BY level, idx // 2, n
), walk(rid, grp, level, idx, n, h, proof) AS (
  SELECT rid, grp, 0, idx, n, given, '' FROM leaves
  UNION ALL
  SELECT w.rid, w.grp, w.level + 1, w.idx // 2, (w.n + 1) // 2, {_SIBLING}, w.proof || coalesce(s.hash, '')
  FROM walk w LEFT JOIN node s ON s.grp = w.grp AND s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.n > 1
), upper_walk(rid, level, idx, n, h, proof) AS (
  SELECT w.rid, 0, s.idx, s.n, w.h, w.proof FROM walk w JOIN subroots s ON w.n = 1 AND s.grp = w.grp
  UNION ALL
  SELECT w.rid, w.level + 1, w.idx // 2, (w.n + 1) // 2, {_SIBLING}, w.proof || coalesce(s.hash, '')
  FROM upper_walk w LEFT JOIN upper_node s ON s.level = w.level AND s.idx = xor(w.idx, 1) WHERE w.n > 1
)
SELECT l.doc_id, l.leaf, s.hash AS subroot, u.hash AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = u.hash AS verified
FROM leaves l JOIN subroots s ON s.grp = l.grp JOIN upper_walk w ON w.rid = l.rid AND w.n = 1 JOIN upper_node u ON u.n = 1
"""
