"""Language-model scoring: a causal self-attention model in numpy, and a word-count base score.

The model reads the byte-level BPE ids of the lower-cased text, closed by an end id. A place sees the id before it, the
one before that, and, by one causal self-attention layer, all ids of its window. Windows hold WINDOW ids and overlap by
half: a window scores the STEP ids of its second half (a document's first also those of its first), so every id is scored once,
with STEP to WINDOW ids before it. Keys and values of an id do not depend on its window, so they are made once, and a batch of
windows is scored with one mask. An id's probability is that of its class times that of the id within its class, both from the
hidden state; ids beyond the CLASSES * MEMBERS most frequent ones share a class by their frequency and are told apart in it
by their share of all ids.

Frequencies are counted over all training documents. The weights are learned by gradient descent from every id of every training
document: texts are dealt by a hash to parts of about PART bytes, each part goes once over all its ids from the same start, and the parts'
weights are averaged by their numbers of ids. The start comes from BLOCKS places drawn over all training texts, on the driver: every
GRAIN-th byte of every text has the same chance, wherever it stands and however long its text is.

The base score needs the count of every word. Counts are summed over all training documents by a hash of
the word (64 bits). Words with one in FREQUENT of all tokens or more - at most FREQUENT words, whatever the
corpus - go to the tasks; all rarer words of a document are joined with their counts by the hash, in a
shuffle no key of which is hot.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import nn
from spanloom.llm.common import as_bytes, crc_mod, mix, prefix_hash, range_hash, staged, table, word_bounds
from spanloom.llm.packing import TOKENIZER, encoder, widths

FOLDS, HELD = 7, 2
VOCAB, END = 50_257, 50_256
WINDOW, STEP = 32, 16
#: Width of keys and values, of the hidden state; input rows of frequent ids and, by their remainder, of all others.
WIDE, HIDDEN, OWN_ROWS, SHARED_ROWS = 16, 32, 3_840, 256
CLASSES, MEMBERS = 32, 32
#: First ranks of the classes of ids without members of their own.
TAILS = (CLASSES * MEMBERS, 2 * CLASSES * MEMBERS, 4 * CLASSES * MEMBERS, 12 * CLASSES * MEMBERS)
#: Places that the weights are learned from (on average), the bytes between two that may be drawn, and windows of each.
BLOCKS, GRAIN, BLOCK_STEPS = 16_384, 64, 5
STEPS, BATCH, RATE, TOP = 600, 64, 0.05, 6.0
#: Bytes of a part of the training texts; blocks of a step, their rate, and blocks that are mixed at once, where all ids are learned from.
PART, ALL_BATCH, ALL_RATE, MIXED = 16_000_000, 128, 0.003, 1280
FREQUENT = 4_000_000
_END_WORD = np.uint64(0)
_WORDS, _IDS, _PLACES = 0, 1, 2
#: Documents and windows that are taken at once, and rows that are added at once.
SOME, SLICE, LANES = 128, 1024, 8


# ------------------------------------------------------------------ text to ids and words
def slices(big: bytes, most: int = 500_000):
    """A text in slices of about that many bytes, cut at spaces, which go."""
    i = 0
    while len(big) - i > most:
        j = big.find(b" ", i + most)
        if j < 0:
            break
        yield big[i:j]
        i = j + 1
    yield big[i:]


_INK = frozenset(i for i in range(128) if not chr(i).isspace())


class Pieces:
    """Ids of texts by a table of the pieces between spaces that were met before, by the pieces' hashes.

    The tokenizer never joins a space to what stands before it, unless that is white space too: texts where it is are
    encoded whole. Pieces that were not met before are encoded together, each after a space, and cut by the bytes of their ids.
    """

    def __init__(self, encode, width: np.ndarray, most: int = 1_000_000):
        self.encode, self.width, self.most = encode, width, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u2")

    def whole(self, raw: bytes) -> np.ndarray:
        return np.array(self.encode(raw.decode("utf-8", "surrogatepass")), "<u2")

    def meet(self, pieces: list[bytes], keys: np.ndarray) -> None:
        """Takes up new pieces, in the order of their keys; those that are empty or end in white space have no ids."""
        size, ids = np.zeros(len(pieces), np.int64), np.zeros(0, "<u2")
        plain = [i for i, x in enumerate(pieces) if x and (x[-1] in _INK or x[-1] > 127 and not x.decode("utf-8", "surrogatepass")[-1].isspace())]
        if plain:
            joined = b" " + b" ".join([pieces[i] for i in plain])
            ids = self.whole(joined)
            stop, end = np.cumsum([len(pieces[i]) + 1 for i in plain]), np.cumsum(self.width[ids])
            last = np.minimum(np.searchsorted(end, stop), len(end) - 1)
            if (end[last] == stop).all():
                size[plain] = np.diff(last, prepend=-1)
            else:  # lone surrogates
                got = [self.whole(b" " + pieces[i]) for i in plain]
                size[plain], ids = [len(x) for x in got], np.concatenate(got)
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, len(self.pool) + np.cumsum(size) - size)
        self.size, self.keys = np.insert(self.size, where, size), np.insert(self.keys, where, keys)
        self.pool = np.concatenate([self.pool, ids])

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        cuts = [self.cut(raw) for raw in texts]
        some = [i for i, c in enumerate(cuts) if c]
        out = [None if c else self.whole(raw) for raw, c in zip(texts, cuts)]
        if not some:
            return out
        middle = [texts[i][cuts[i][0] + 1 : cuts[i][1]] for i in some]
        got = [self.between(x) for x in slices(b" ".join(middle))]
        flat, size = (np.concatenate(x) for x in zip(*got))
        stop = np.cumsum(size)
        last = np.cumsum([m.count(b" ") + 1 for m in middle])
        bad = np.zeros(len(some), bool)
        bad[np.searchsorted(last, np.flatnonzero(size == 0), "right")] = True
        stop = stop[last - 1].tolist()
        for i, x, y, spaced in zip(some, [0, *stop], stop, bad.tolist()):
            t, (a, b) = texts[i], cuts[i]
            out[i] = self.whole(t) if spaced else np.concatenate([self.whole(t[:a]), flat[x:y], self.whole(t[b:])])
        return out

    def between(self, big: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces between spaces, one after the other, and each piece's number of ids."""
        raw = np.frombuffer(big, np.uint8)
        space = np.flatnonzero(raw == 32)
        begin, end = np.append(0, space + 1), np.append(space, len(raw))
        h = range_hash(prefix_hash(raw), begin, end)
        order = np.argsort(h)
        h = h[order]
        new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        keys, first = h[new], order[new]
        if len(self.keys) > self.most:
            self.clear()
        unmet = np.flatnonzero(~find(self.keys, keys)[1])
        if len(unmet):
            i = first[unmet]
            self.meet([big[x:y] for x, y in zip(begin[i].tolist(), end[i].tolist())], keys[unmet])
        at = np.empty(len(h), np.int64)
        at[order] = np.repeat(np.searchsorted(self.keys, keys), np.diff(new, append=len(h)))
        size = self.size[at]
        stop = np.cumsum(size)
        return self.pool[np.repeat(self.at[at] - (stop - size), size) + np.arange(stop[-1])], size

    def cut(self, raw: bytes) -> tuple[int, int] | None:
        """The first and the last space, or nothing if the text has to be encoded whole."""
        a = raw.find(b" ")
        if raw.count(b" ") < 3 or b"<|endoftext|>" in raw or raw[:a].decode("utf-8", "surrogatepass")[-1:].isspace():
            return None
        return a, raw.rfind(b" ")


_PIECES: dict[str, Pieces] = {}
_CLOSE = np.array([END], "<u2")


def ids_of(texts: list[bytes], tokenizer: str = TOKENIZER) -> list[np.ndarray]:
    if tokenizer not in _PIECES:
        _PIECES[tokenizer] = Pieces(encoder(tokenizer), widths(tokenizer))
    return [np.concatenate([x, _CLOSE]) for x in _PIECES[tokenizer].ids(texts)]


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts, one text after the other, and each text's number of words."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, end = word_bounds(raw)
    count = np.diff(np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts])), prepend=0)
    return np.maximum(range_hash(prefix_hash(raw), start, end), np.uint64(1)), count


def _lower(column) -> list[bytes]:
    return [as_bytes(t).lower() for t in column.to_pylist()]


# ------------------------------------------------------------------ what is gathered from all training texts
def count_tokens(learn: DataFrame, tokenizer: str) -> DataFrame:
    """kind, key, n: training counts of word hashes (the end is 0), of subword ids, and the number of places."""

    def run(batches):
        def rows(kind, keys, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

        seen, places = np.zeros(VOCAB, np.int64), 0
        for b in batches:
            for i in range(0, b.num_rows, 6 * SOME):
                texts = _lower(b.column("text").slice(i, 6 * SOME))
                keys, n = np.unique(words_of(texts)[0], return_counts=True)
                yield rows(_WORDS, np.append(keys, _END_WORD), np.append(n, len(texts)))
                seen += np.bincount(np.concatenate(ids_of(texts, tokenizer)), minlength=VOCAB)
                places += sum(len(t) // GRAIN + 1 for t in texts)
        keys = np.flatnonzero(seen)
        yield rows(_IDS, keys, seen[keys])
        yield rows(_PLACES, np.zeros(1, np.int64), np.array([places]))

    return learn.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def drawn(learn: DataFrame, share: float, tokenizer: str) -> DataFrame:
    """place, ids: the ids from each drawn place on; the first only stands before the others, it is the end where the text begins."""
    most = BLOCK_STEPS * STEP

    def run(batches):
        for b in batches:
            keys, heads, pieces, tails = [], [], [], []
            for raw in _lower(b.column("text")):
                k = np.arange(len(raw) // GRAIN + 1, dtype=np.uint64)
                key = mix((k + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(zlib.crc32(raw)))
                hit = np.flatnonzero(key < np.uint64(min(share, 1.0) * (2.0**64 - 2048)))
                for at in (hit * GRAIN).tolist():
                    cut = raw[at : at + 8 * most]
                    space = cut.find(b" ") if at else 0
                    if space < 0:
                        continue
                    keys.append(key[at // GRAIN])
                    heads.append(b"" if at else _CLOSE.tobytes())
                    pieces.append(cut[space:].decode("utf-8", "ignore").encode())
                    tails.append(b"" if at + 8 * most < len(raw) else _CLOSE.tobytes())
            if keys:
                out = [(head + x[:-1].tobytes() + tail)[: 2 * (most + 1)] for head, x, tail in zip(heads, ids_of(pieces, tokenizer), tails)]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(keys).astype(np.int64)), pa.array(out, pa.binary())], ["place", "ids"])

    return learn.select("text").mapInArrow(run, "place long, ids binary")


# ------------------------------------------------------------------ the model
def tables(counts: np.ndarray) -> dict[str, np.ndarray]:
    """By id: its input row, its class, its place among the class's members, and its log share of its class; by class: its log share."""
    rank = np.empty(VOCAB, np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(VOCAB)
    row = np.where(rank < OWN_ROWS, rank, OWN_ROWS + np.arange(VOCAB) % SHARED_ROWS)
    which = np.where(rank < TAILS[0], rank // MEMBERS, CLASSES - 1 + np.searchsorted(TAILS, rank, "right"))
    smooth = counts + 0.5
    share = np.bincount(which, smooth, CLASSES + len(TAILS))
    return {
        "row": row.astype(np.int32), "class": which.astype(np.int16), "member": np.where(rank < TAILS[0], rank % MEMBERS, 0).astype(np.int16),
        "inside": np.log(smooth / share[which]).astype(np.float32), "share": np.log(share / share.sum()).astype(np.float32),
    }


def start(t: dict, rng: np.random.Generator) -> dict[str, np.ndarray]:
    rows = OWN_ROWS + SHARED_ROWS
    p = nn.init(rng, q=(WIDE, WIDE), k=(WIDE, WIDE), v=(WIDE, WIDE), one=(WIDE, HIDDEN), more=(WIDE, HIDDEN), mbias=(HIDDEN,), out=(HIDDEN, CLASSES + len(TAILS)))
    p["ids"] = rng.normal(0, 0.5, (rows, WIDE)).astype(np.float32)
    p["two"] = rng.normal(0, 0.3, (rows, HIDDEN)).astype(np.float32)
    p["far"] = np.zeros((WINDOW, 1), np.float32)  # what each distance adds before the softmax
    p["out"] *= 0.3
    p["obias"] = t["share"].copy()
    p["member"] = rng.normal(0, 0.1, (CLASSES, HIDDEN, MEMBERS)).astype(np.float32)
    p["mbias_in"] = np.zeros((CLASSES, MEMBERS), np.float32)
    own = np.flatnonzero(t["class"] < CLASSES)
    p["mbias_in"][t["class"][own], t["member"][own]] = t["inside"][own]
    return p


def steps_of(docs: list[np.ndarray], bare: bool = True) -> tuple[np.ndarray, ...]:
    """Rows of STEP places: ids before, ids before these, ids to score (-1: none), and whether a row begins its document.

    bare: a document is what is scored, after an end; else its first id only stands before the others.
    """
    n = np.array([len(d) - (not bare) for d in docs])
    rows = -(-n // STEP)
    first = np.zeros(rows.sum(), bool)
    first[np.cumsum(rows) - rows] = True
    at = np.repeat((np.cumsum(rows) - rows) * STEP - (np.cumsum(n) - n), n) + np.arange(n.sum())
    flat = np.concatenate([d if bare else d[1:] for d in docs]).astype(np.int64)
    begin = np.cumsum(n) - n
    before = np.roll(flat, 1)
    before[begin] = END if bare else [d[0] for d in docs]
    two = np.roll(before, 1)
    two[begin] = END
    out = [np.full(len(first) * STEP, x, np.int64) for x in (END, END, -1)]
    for x, v in zip(out, (before, two, flat)):
        x[at] = v
    return (*(x.reshape(-1, STEP) for x in out), first)


_APART = np.arange(STEP)[:, None] + STEP - np.arange(WINDOW)[None]  # from a place back to each id of its window
_CAUSAL = np.where(_APART >= 0, 0, -1e4).astype(np.float32)


def _shift(y):
    """Each row's neighbour before it; the first has none."""
    a = nn.val(y)
    out = np.zeros_like(a)
    out[1:] = a[:-1]
    return nn._op(out, lambda g: (np.concatenate([g[1:], np.zeros_like(g[:1])]),), y)


def _clip(y):
    a = nn.val(y)
    return nn._op(np.clip(a, 0, TOP), lambda g: (g * ((a > 0) & (a < TOP)),), y)


def _rows(y, index: np.ndarray):
    """Rows of a table, each at most once."""
    a = nn.val(y)

    def back(g):
        out = np.zeros_like(a)
        out[index] = g
        return (out,)

    return nn._op(a[index], back, y)


def hidden(p: dict, row: np.ndarray, row_two: np.ndarray, first: np.ndarray):
    """(places, HIDDEN), for learning."""
    n = len(row)
    x = nn.take(p["ids"], row.reshape(-1))
    q, k, v = (nn.reshape(nn.matmul(x, p[c]), n, STEP, WIDE) for c in "qkv")
    far = nn.reshape(nn.take(p["far"], np.maximum(_APART, 0).reshape(-1)), 1, STEP, WINDOW)
    mask = _CAUSAL + np.where(first[:, None, None] & (np.arange(WINDOW) < STEP), -1e4, 0).astype(np.float32)
    weight = nn.softmax(nn.add(nn.add(nn.matmul(q, nn.swap(nn.concat([_shift(k), k], 1))), far), mask))
    seen = nn.reshape(nn.matmul(weight, nn.concat([_shift(v), v], 1)), n * STEP, WIDE)
    z = nn.add(nn.add(nn.matmul(x, p["one"]), nn.matmul(seen, p["more"])), p["mbias"])
    return _clip(nn.add(z, nn.take(p["two"], row_two.reshape(-1))))


def _groups(which: np.ndarray):
    """(class, places) of every class with members."""
    order = np.argsort(which, kind="stable")
    cut = np.searchsorted(which[order], np.arange(CLASSES + 1))
    return [(c, order[cut[c] : cut[c + 1]]) for c in range(CLASSES) if cut[c] < cut[c + 1]]


def member_loss(h, w, b, which: np.ndarray, y: np.ndarray):
    """Sum of -log P(member | class) over n places, divided by n."""
    a, W, B = nn.val(h), nn.val(w), nn.val(b)
    total, kept, n = 0.0, [], max(1, len(y))
    for c, i in _groups(which):
        z = a[i] @ W[c] + B[c]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        mine = (np.arange(len(i)), y[i])
        total -= np.log(z[mine]).sum()
        z[mine] -= 1
        kept.append((c, i, z))

    def back(g):
        da, dW, dB = np.zeros_like(a), np.zeros_like(W), np.zeros_like(B)
        for c, i, z in kept:
            d = z * (g / n)
            da[i], dW[c], dB[c] = d @ W[c].T, a[i].T @ d, d.sum(0)
        return da, dW, dB

    return nn._op(np.float64(total / n), back, h, w, b)


def loss(p: dict, t: dict, before, two, target, first):
    """Mean -log P of the ids, without the shares within the last classes (these are counts)."""
    y = target.reshape(-1)
    live = np.flatnonzero(y >= 0)
    y = y[live]
    h = _rows(hidden(p, t["row"][before], t["row"][two], first), live)
    which = t["class"][y].astype(np.int64)
    own = np.flatnonzero(which < CLASSES)
    apart = nn.cross_entropy(nn.add(nn.matmul(h, p["out"]), p["obias"]), which)
    if not len(own):
        return apart
    inside = member_loss(_rows(h, own), p["member"], p["mbias_in"], which[own], t["member"][y[own]].astype(np.int64))
    return nn.add(apart, nn.mul(inside, np.float64(len(own) / len(y))))


def gradient(p: dict, t: dict, before, two, target, first) -> dict[str, np.ndarray]:
    """The derivatives of ``loss`` by all weights, with the powers that documents are scored with.

    Written out, as each pass over the places counts: places are in the order of their classes from the hidden state on, so that
    those of one class stand together, and what belongs to one input row is summed once for its part as the id before and as the one before that.
    """
    n, row = len(before), t["row"].take(before.reshape(-1))
    x = p["ids"].take(row, 0)
    q, k, v = (x @ p[c] for c in "qkv")
    v = np.concatenate([v, np.ones((len(v), 1), np.float32)], 1)  # the last sums the weights
    k, v = (_windows(np.concatenate([np.zeros((STEP, y.shape[1]), np.float32), y])) for y in (k, v))
    near = np.exp(np.where(_APART >= 0, p["far"][np.maximum(_APART, 0), 0], -1e4)).astype(np.float32)
    q = q.reshape(n, STEP, WIDE)
    weight = power(np.matmul(q, k.swapaxes(1, 2)))
    weight *= near
    weight[first, :, :STEP] = 0
    seen = np.matmul(weight, v).reshape(-1, WIDE + 1)
    all_ = np.ascontiguousarray(seen[:, WIDE:])
    seen = seen[:, :WIDE] / all_
    h = x @ p["one"]
    h += seen @ p["more"]
    h += p["mbias"]
    h += p["two"].take(t["row"].take(two.reshape(-1)), 0)
    np.clip(h, 0, TOP, out=h)

    # the id's class and its member, place by place in the order of classes
    y = target.reshape(-1)
    live = np.flatnonzero(y >= 0)
    which = t["class"].take(y.take(live))
    order = np.argsort(which, kind="stable")
    live, which = live.take(order), which.take(order)
    cut = np.searchsorted(which, np.arange(CLASSES + 1)).tolist()
    hs, places, m = h.take(live, 0), np.arange(len(live)), np.float32(max(1, len(live)))
    z = hs @ p["out"]
    z += p["obias"]
    z = power(z)
    z /= (z @ np.full(z.shape[1], m, np.float32))[:, None]
    z[places, which] -= 1 / m
    ones = np.ones(len(h), np.float32)
    g = {"out": hs.T @ z, "obias": ones[: len(z)] @ z, "member": np.zeros_like(p["member"]), "mbias_in": np.zeros_like(p["mbias_in"])}
    back = z @ p["out"].T
    some = [(c, slice(cut[c], cut[c + 1])) for c in range(CLASSES) if cut[c] < cut[c + 1]]
    z = np.empty((cut[-1], MEMBERS), np.float32)
    for c, i in some:
        np.matmul(hs[i], p["member"][c], out=z[i])
        z[i] += p["mbias_in"][c]
    z = power(z)
    z /= (z @ np.full(MEMBERS, m, np.float32))[:, None]
    z[places[: cut[-1]], t["member"].take(y.take(live[: cut[-1]]))] -= 1 / m
    for c, i in some:
        g["member"][c], g["mbias_in"][c] = hs[i].T @ z[i], ones[i] @ z[i]
        back[i] += z[i] @ p["member"][c].T

    # the hidden state, and the attention
    dz = np.zeros_like(h)
    dz[live] = back
    dz *= (h > 0) & (h < TOP)
    g["mbias"], g["one"], g["more"] = ones @ dz, x.T @ dz, seen.T @ dz
    ds = dz @ p["more"].T
    ds /= all_
    inside = np.matmul(ds.reshape(n, STEP, WIDE), v[:, :, :WIDE].swapaxes(1, 2))
    inside -= np.einsum("ij,ij->i", ds, seen).reshape(n, STEP, 1)
    inside *= weight
    g["far"] = np.bincount(np.maximum(_APART, 0).reshape(-1), np.where(_APART >= 0, inside.sum(0), 0).reshape(-1), WINDOW).astype(np.float32)[:, None]
    dx = dz @ p["one"].T
    own = (np.matmul(inside, k).reshape(-1, WIDE), _folded(np.matmul(inside.swapaxes(1, 2), q)), _folded(np.matmul(weight.swapaxes(1, 2), ds.reshape(n, STEP, WIDE))))
    for c, d in zip("qkv", own):
        g[c] = x.T @ d
        dx += d @ p[c].T

    # the id before that is the id before of the place before, but at a block's first place, where it is an end
    both = np.empty((len(dx) + 1, WIDE + HIDDEN), np.float32)
    both[:-1, :WIDE], both[:-2, WIDE:] = dx, dz[1:]
    begin = np.flatnonzero(first) * STEP
    both[begin[1:] - 1, WIDE:] = both[-2, WIDE:] = both[-1] = 0
    rows = _by_row(both, row, len(p["ids"]))
    rows[t["row"][END], WIDE:] += dz.take(begin, 0).sum(0)
    return g | {"ids": rows[:, :WIDE], "two": rows[:, WIDE:]}


def _by_row(y: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sums by row of a table of n rows; y has a row of zeros at its end. LANES rows are added at once, what is left of them by reduceat."""
    order = np.argsort(row.astype(np.uint16), kind="stable")
    row = row.take(order)
    new = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    count = np.diff(new, append=len(row))
    lanes = -(-count // LANES)
    at = np.cumsum(lanes) - lanes
    places = np.full(lanes.sum() * LANES, len(row))
    places[np.arange(len(row)) + np.repeat(at * LANES - new, count)] = order
    out = np.zeros((n, y.shape[1]), np.float32)
    out[row[new]] = np.add.reduceat(y.take(places.reshape(-1, LANES).T, 0).sum(0), at, 0)
    return out


def _folded(y: np.ndarray) -> np.ndarray:
    """(n * STEP, width) from windows (n, WINDOW, width): what each place gets from its own window and from the next."""
    out = y[:, STEP:].copy()
    out[:-1] += y[1:, :STEP]
    return out.reshape(-1, y.shape[2])


def train(blocks: list[np.ndarray], t: dict, seed: int = 23) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p, blocks = start(t, rng), [b for b in blocks if len(b) > 1]
    if not blocks:
        return p
    adam, steps = nn.Adam(p, RATE), min(STEPS, 40 + len(blocks) // 4)
    for step in range(steps):
        adam.rate = RATE * min(1, (step + 1) / 50) * (1 - 0.95 * step / steps)
        some = steps_of([blocks[i] for i in rng.integers(0, len(blocks), BATCH)], False)
        adam.move(gradient(adam.p, t, *some))
    return adam.p


def blocks_of(doc: np.ndarray) -> list[np.ndarray]:
    """A document's ids in blocks, each id in one, after the id before the block (an end at first)."""
    most = BLOCK_STEPS * STEP
    whole = np.concatenate([np.array([END], doc.dtype), doc])
    return [whole[i : i + most + 1] for i in range(0, len(doc), most)]


def learn_all(p: dict, t: dict, docs, seed: int, batch: int = ALL_BATCH, rate: float = ALL_RATE) -> tuple[dict[str, np.ndarray], int]:
    """Weights after one pass over all ids of an iterable of documents, and their number."""
    rng, adam, waiting, seen, step = np.random.default_rng(seed), nn.Adam({k: v.copy() for k, v in p.items()}, rate), [], 0, 0

    def go(blocks):
        nonlocal step
        order = rng.permutation(len(blocks))
        for i in range(0, len(blocks), batch):
            adam.rate = rate * min(1, (step + 1) / 20)
            some = steps_of([blocks[j] for j in order[i : i + batch]], False)
            adam.move(gradient(adam.p, t, *some))
            step += 1

    for doc in docs:
        seen += len(doc)
        for block in blocks_of(doc):
            waiting.append(block)
            if len(waiting) == MIXED:
                go(waiting)
                waiting = []
    if waiting:
        go(waiting)
    return adam.p, seen


def ready(p: dict) -> dict[str, np.ndarray]:
    """Tables by input row of all that does not depend on other ids, for scoring."""
    x = p["ids"]
    far = np.exp(np.where(_APART >= 0, p["far"][np.maximum(_APART, 0), 0], -1e4)).astype(np.float32)
    value = np.concatenate([x @ p["v"], np.ones((len(x), 1), np.float32)], 1)  # the last sums the weights
    keep = {c: p[c] for c in ("more", "two", "out", "obias", "member", "mbias_in")}
    return keep | {"q": x @ p["q"], "k": x @ p["k"], "value": value, "one": x @ p["one"] + p["mbias"], "near": far}


def power(z: np.ndarray) -> np.ndarray:
    """e ** z to within 3 %, in place: linear between powers of two, from the bits of the number. What is divided by a sum of
    such powers still adds to one."""
    z *= np.float32(2**23 / np.log(2))
    z += np.float32(127 * 2**23 - 366_000)
    return z.astype(np.int32).view(np.float32)


def score_ids(p: dict, t: dict, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each document; p from ``ready``."""
    before, two, target, first = steps_of(docs)
    # a row of places more in front, so that each window is STEP rows on from the one before
    row, row_two, out = t["row"].take(np.concatenate([before[:1], before])), t["row"].take(two), np.zeros(len(first))
    ones = np.ones(CLASSES + len(TAILS), np.float32)
    for i in range(0, len(first), SLICE):
        r, n = row[i : i + SLICE + 1].reshape(-1), len(first[i : i + SLICE])
        own = r[STEP:]
        k, v = (_windows(p[c].take(r, 0)) for c in ("k", "value"))
        weight = power(np.matmul(p["q"].take(own, 0).reshape(n, STEP, WIDE), k.swapaxes(1, 2)))
        weight *= p["near"]
        weight[first[i : i + SLICE], :, :STEP] = 0
        seen = np.matmul(weight, v).reshape(n * STEP, WIDE + 1)
        h = (seen[:, :WIDE] / seen[:, WIDE:]) @ p["more"]
        h += p["one"].take(own, 0)
        h += p["two"].take(row_two[i : i + SLICE].reshape(-1), 0)
        np.clip(h, 0, TOP, out=h)
        y = target[i : i + SLICE].reshape(-1)
        live = np.flatnonzero(y >= 0)
        if len(live) < len(y):
            y, h = y.take(live), h.take(live, 0)
        which = t["class"].take(y)
        z = h @ p["out"]
        z += p["obias"]
        z = power(z)
        places = np.arange(len(y))
        log = np.log(z[places, which] / (z @ ones))
        order = np.argsort(which, kind="stable")
        cut = np.searchsorted(which.take(order), np.arange(CLASSES + 1))
        h, y = h.take(order, 0), y.take(order)
        z = np.empty((cut[-1], MEMBERS), np.float32)  # by class, one after the other
        for c in np.flatnonzero(np.diff(cut)):
            part = z[cut[c] : cut[c + 1]]
            np.matmul(h[cut[c] : cut[c + 1]], p["member"][c], out=part)
            part += p["mbias_in"][c]
        z = power(z)
        inside = t["inside"].take(y)  # what the last classes go by
        inside[: cut[-1]] = np.log(z[places[: cut[-1]], t["member"].take(y[: cut[-1]])] / (z @ ones[:MEMBERS]))
        log[order] += inside
        out[i : i + SLICE] = np.bincount(live // STEP, log, n)
    return np.add.reduceat(out, np.flatnonzero(first)) / np.log(10)


def _windows(x: np.ndarray) -> np.ndarray:
    """(n, WINDOW, width) from (n * STEP + STEP, width), without a copy."""
    a, b = x.strides
    return np.lib.stride_tricks.as_strided(x, (len(x) // STEP - 1, WINDOW, x.shape[1]), (STEP * a, a, b))


# ------------------------------------------------------------------ Spark
def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the sorted keys of each wanted one, and whether it is there; looked up in order, as neighbours share cache lines."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    order = np.argsort(wanted)
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
    return at, keys[at] == wanted


def learned_by_all(spark: SparkSession, learn: DataFrame, p: dict, t: dict, size: int, tokenizer: str) -> dict[str, np.ndarray]:
    """The weights after every training id was learned from once: parts learn side by side, their weights are averaged by their ids."""
    names, shapes = list(p), {k: p[k].shape for k in p}
    flat = lambda q: np.concatenate([np.asarray(q[k], np.float32).ravel() for k in names])
    shared, batch, rate = spark.sparkContext.broadcast((p, t)), ALL_BATCH, ALL_RATE

    def rows(total, n):
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["total", "n"])

    def part(batches):
        def docs():
            for b in batches:
                for i in range(0, b.num_rows, 6 * SOME):
                    yield from ids_of(_lower(b.column("text").slice(i, 6 * SOME)), tokenizer)

        q, n = learn_all(*shared.value, docs(), 29, batch, rate)
        if n:
            yield rows(flat(q), n)

    def added(batches):
        total, n = 0, 0
        for b in batches:
            for x, m in zip(b.column("total"), b.column("n").to_pylist()):
                total, n = total + m * np.frombuffer(x.as_buffer(), np.float32).astype(np.float64), n + m
        if n:
            yield rows(total, n)

    # by the hash of id and text, in its order: the same parts in the same order whatever the files are, and copies in all parts
    dealt = learn.select("text", F.xxhash64("doc_id", "text").alias("key")).repartition(max(1, -(-size // PART)), "key").sortWithinPartitions("key")
    weights = dealt.select("text").mapInArrow(part, "total binary, n long")
    sums = weights.repartition(16).mapInArrow(added, "total binary, n long").collect()  # 16 rows of weights
    if not sums:
        return p
    mean = sum(np.frombuffer(r[0], np.float64) for r in sorted(sums)) / sum(r[1] for r in sums)
    cuts = np.cumsum([int(np.prod(shapes[k])) for k in names])[:-1]
    return {k: x.reshape(shapes[k]).astype(p[k].dtype) for k, x in zip(names, np.split(mean, cuts))}


def fit(spark: SparkSession, learn: DataFrame, counts: DataFrame, tokenizer: str) -> tuple[dict, dict]:
    """Weights and tables, from the staged counts and all training texts."""
    ids = counts.where(F.col("kind") == _IDS).select("key", "n").toPandas()  # at most VOCAB rows
    id_counts = np.zeros(VOCAB)
    id_counts[ids["key"].to_numpy(np.int64)] = ids["n"]
    places = counts.where(F.col("kind") == _PLACES).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    t = tables(id_counts)
    blocks = drawn(learn, BLOCKS / max(1, places), tokenizer).collect()  # about BLOCKS rows of at most BLOCK_STEPS * STEP + 1 ids
    start_ = train([np.frombuffer(r[1], "<u2") for r in sorted(blocks)], t)
    return learned_by_all(spark, learn, start_, t, places * GRAIN, tokenizer), t


def score_documents(spark: SparkSession, docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone; a text is read whole, however long; repeated rows count and score alike; a null id is in
    the training fold or not as the empty text is; without training documents N and V are 0 and the model is as it starts; an empty
    table gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    learn = docs.where(crc_mod("doc_id", FOLDS) != HELD)
    counts = staged(spark, count_tokens(learn, tokenizer))
    n_all, v_all = counts.where(F.col("kind") == _WORDS).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.where((F.col("kind") == _WORDS) & (F.col("key") == int(_END_WORD))).select("n").first()
    ends = int(ends[0]) if ends else 0
    frequent = counts.where((F.col("kind") == _WORDS) & (F.col("n") * FREQUENT >= n_all)).select("key", "n").toPandas()  # at most FREQUENT rows
    frequent = frequent.sort_values("key")
    p, t = fit(spark, learn, counts, tokenizer)
    shared = spark.sparkContext.broadcast((ready(p), t, frequent["key"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64)))
    unit = float(n_all + v_all + 1)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "key", "tf"]

    def run(batches):
        p, t, keys, n = shared.value
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for i in range(0, b.num_rows, SOME):
                some = _lower(b.column("text").slice(i, SOME))
                hashes, count = words_of(some)
                hashes = hashes.astype(np.int64)
                owner = np.repeat(np.arange(len(some)), count)
                at, hit = find(keys, hashes)
                base = np.bincount(owner[hit], np.log10((n[at[hit]] + 1) / unit), len(some)) + np.log10((ends + 1) / unit)
                known = np.bincount(owner[hit], minlength=len(some)) + (ends > 0)
                score = score_ids(p, t, ids_of(some, tokenizer))
                k = len(some)
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + k)), b.column("doc_id").slice(i, k), pa.array(count + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score), none, none], names
                )
                who, key = owner[~hit], hashes[~hit]  # the other words, once for each document
                if len(who):
                    order = np.lexsort((key, who))
                    who, key = who[order], key[order]
                    new = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (key[1:] != key[:-1]))))
                    m = len(new)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row + who[new]), pa.nulls(m, b.column("doc_id").type), *(pa.nulls(m, x) for x in (pa.int64(), pa.int64(), pa.float64(), pa.float64())),
                         pa.array(key[new]), pa.array(np.diff(np.append(new, len(who))))], names,
                    )
                row += k

    found = staged(spark, docs.mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, n_known long, base double, score double, key long, tf long"))
    cold = counts.where((F.col("kind") == _WORDS) & (F.col("n") * FREQUENT < n_all)).select("key", "n")
    joined = found.where("key IS NOT NULL").select("row", "key", "tf").join(cold, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    more = joined.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10((F.col("n") + 1) / F.lit(unit))).alias("__base"), F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("__known")
    )
    return found.where("key IS NULL").join(more, "row", "left").select(
        "doc_id",
        (crc_mod("doc_id", FOLDS) == HELD).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("__base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, table(spark, sf_dir, "documents"))
