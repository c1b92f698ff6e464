"""Hierarchical multi-length packing.

A document's ids are first cut into full windows of the largest context size. What remains is
routed to the smallest context-size tier that holds it. Each tier is packed on its own: a window opens
with the longest piece waiting in the tier, its gap is filled from the same and then from shorter tiers,
longest fitting piece first, and what is still open takes the start of one more piece, whose rest is
routed anew. So windows of every tier are full, and a tier's size is a power of two, so they need no
padding; only what is left at the end of a task is joined into windows of the largest size, the last of
which is padded. Finished windows are dealt to step groups in serpentine order of attention
cost (the sum of squared piece lengths), so that groups of a step cost about the same.

Each task packs the rows it reads: there is no shuffle, memory is bounded by POOL waiting
pieces of less than a window each, and a lost task repeats on the same rows.
"""

from __future__ import annotations

import base64
import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.common import table

TIERS = (128, 256, 512, 1024)
#: Waiting pieces per task before windows are closed; GROUP windows make a set of GROUP / LANES step groups.
POOL, GROUP, LANES = 512, 64, 8
TOKENIZER = "byte_bpe_50k"
SCHEMA = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
)
_LOADED: dict[str, object] = {}


def encoder(name: str = TOKENIZER):
    """text -> ids of the byte-level BPE, special strings as the tokenizer file has them.

    The rank file holds the same vocabulary and merges as the tokenizer file and encodes four times as
    fast; a text that holds a special token's string goes through the tokenizer file itself.
    """
    if name not in _LOADED:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

        def encode(text: str) -> list[int]:
            if "<|endoftext|>" in text:
                return whole.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _LOADED[name] = encode
    return _LOADED[name]


def widths(name: str = TOKENIZER) -> np.ndarray:
    """Bytes of each id, without special ones."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        size = {int(b): len(base64.b64decode(a)) for a, b in map(bytes.split, f)}
    out = np.zeros(max(size) + 1, np.int64)
    out[list(size)] = list(size.values())
    return out


class Packer:
    """Packs pieces (row, start, ids, doc_tokens); done() takes rows of finished windows."""

    def __init__(self, base: int):
        self.wait: list[list[tuple]] = [[] for _ in TIERS]  # each sorted by length
        self.windows: list[tuple[int, list[tuple]]] = []
        self.rows: list[tuple] = []
        self.next, self.n, self.base = base, 0, base
        self.order = 0

    def add(self, doc: object, ids: np.ndarray) -> None:
        top, at, n = TIERS[-1], 0, len(ids)
        while n - at >= top:
            self.close(top, [(doc, at, ids[at : at + top], n)])
            at += top
        if at < n:
            self.route((doc, at, ids[at:], n))
        for t in range(len(TIERS)):
            while len(self.wait[t]) > POOL // len(TIERS):
                self.window(t)

    def route(self, piece: tuple) -> None:
        t = next(i for i, size in enumerate(TIERS) if len(piece[2]) <= size)
        self.order += 1
        bisect.insort(self.wait[t], (len(piece[2]), self.order, piece))
        self.n += 1

    def take(self, tier: int, room: int) -> tuple | None:
        """The longest waiting piece of this or a shorter tier with at most ``room`` ids."""
        for t in range(tier, -1, -1):
            if k := bisect.bisect_right(self.wait[t], (room, 1 << 62)):
                self.n -= 1
                return self.wait[t].pop(k - 1)[2]
        return None

    def window(self, tier: int, last: bool = False) -> None:
        room, pieces = TIERS[tier], []
        while room and self.n:
            piece = self.take(tier, room)
            if piece is None:  # none fits: the shortest piece of the shortest tier gives its start
                t = next((t for t in range(tier + 1) if self.wait[t]), None)
                if t is None:
                    break
                doc, at, ids, n = self.wait[t].pop(0)[2]
                self.n -= 1
                piece = (doc, at, ids[:room], n)
                self.route((doc, at + room, ids[room:], n))
            pieces.append(piece)
            room -= len(piece[2])
        if room and not last:  # this and all shorter tiers ran dry
            for p in pieces:
                self.route(p)
            self.pool_up()
        elif pieces:
            self.close(TIERS[tier], pieces)

    def pool_up(self) -> None:
        """With too little left for a tier's window, fill a window of the largest size from all tiers."""
        self.window(len(TIERS) - 1, last=True)

    def close(self, tier: int, pieces: list[tuple]) -> None:
        self.windows.append((tier, pieces))
        if len(self.windows) >= GROUP:
            self.deal()

    def deal(self) -> None:
        cost = lambda w: -sum(len(p[2]) ** 2 for p in w[1])
        lanes = GROUP // LANES
        for k, (tier, pieces) in enumerate(sorted(self.windows, key=cost)):
            turn, lane = divmod(k, lanes)
            group = self.base + (self.next - self.base - k) // GROUP * lanes + (lane if turn % 2 == 0 else lanes - 1 - lane)
            at = 0
            for doc, start, ids, n in pieces:
                crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
                self.rows.append((doc, start, len(ids), crc, n, self.next, at, tier, group))
                at += len(ids)
            self.next += 1
        self.windows = []

    def finish(self) -> None:
        for t in reversed(range(len(TIERS))):
            while sum(p[0] for u in range(t + 1) for p in self.wait[u]) >= TIERS[t] and self.n:
                self.window(t)
        while self.n:
            self.pool_up()
        self.deal()


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = 0) -> DataFrame:
    """Per piece of a document: where it stands in its document and in its sequence.

    A null or empty text is the single id ``end_id``; a repeated row is packed again; an empty table
    gives no pieces; other columns are ignored. ``tier`` is the size of the piece's window and
    ``step_group`` numbers sets of windows of about equal cost.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        encode = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 40)

        def flush():
            rows, packer.rows = packer.rows, []
            cols = list(zip(*rows)) if rows else [[]] * 9
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:7]), pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"],
            )

        id_type = pa.int64()
        for b in batches:
            id_type = b.column("doc_id").type
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                packer.add(doc, np.array([*encode(text or ""), end_id], np.uint32))
                if len(packer.rows) > 20_000:
                    yield flush()
        packer.finish()
        if packer.rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(id=kind.simpleString()))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
