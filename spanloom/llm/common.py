"""Helpers that the training-data operators share.

Text is bytes here: ``bytes.split()`` splits on exactly [\\x20\\x09-\\x0D], which is
the white space of every contract, and ``bytes.lower()`` lowers exactly A-Z.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, for Spark's regular expressions.
WS = "[\\x20\\x09-\\x0D]"
#: A group with at least one row in so many is "hot": there are at most HOT of them,
#: whatever the size of the data, so they may be broadcast.
HOT = 1000
#: Spark's switch to remove a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; in local mode one of our own where it is unset, an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='spanloom-')}"
        spark.conf.set("spark.checkpoint.dir", at)
        atexit.register(_remove, spark, at)
    return at


def staged(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor costs only the tasks it ran; later stages reread the files. The
    files go when the driver ends, as the returned plan may be run at any time; the shuffles of
    the write go at once.
    """
    before = spark.conf.get(CLEANUP, None)
    path = f"{shared_dir(spark)}/spanloom-{uuid.uuid4().hex}"
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % m


def crc_mod_py(value: object, m: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % m


def lookup(rows: DataFrame, groups: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """Inner join of many rows with one row per key; ``groups[n]`` is the key's number of rows.

    Keys with one row in HOT or more (at most HOT keys, by counting) come by broadcast,
    so that no task gets a hot key; all others by a shuffle on the key. ``rows`` is read
    twice and should be staged.
    """
    hot = groups.where(F.col(n) * HOT >= total)
    cold = groups.where(F.col(n) * HOT < total)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cold, key)
    )


# ------------------------------------------------------------------ hashing of words
_RNG = np.random.default_rng(20240229)
BYTE_KEYS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_K = np.uint64(0x9E3779B97F4A7C15)
_KINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POW = [np.ones(1, np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: spreads every bit over the 64."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW) == 1 or len(_POW[0]) < n + 1:
        size = max(n + 1, 1 << 16)
        up = np.full(size, _K)
        up[0] = 1
        down = np.full(size, _KINV)
        down[0] = 1
        _POW[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POW[0], _POW[1]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of key(byte) * K**position over raw[i:j], modulo 2**64."""
    up, _ = _powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_KEYS[raw] * up[: len(raw)], dtype=np.uint64, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, equal for equal bytes wherever they stand."""
    _, down = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word [^\\x20\\x09-\\x0D]+."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[raw], [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    start, end = word_bounds(raw)
    return range_hash(prefix_hash(raw), start, end) if len(start) else np.zeros(0, np.uint64)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """64-bit hashes of every run of ``size`` words; a shorter text is one run; no word: none."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - size + 1)
    out = np.full(n, np.uint64(min(len(w), size)))
    for i in range(min(size, len(w))):
        out = mix(out * _K + w[i : i + n])
    return out


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
