"""The language model against plain loops, and its held-out scores against the word count's."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import lm, nn, packing
from tests.llm.test_operators import BASE, ROWS, SCHEMA


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_base_score(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)  # so that some words go through the join
    monkeypatch.setattr(lm, "STEPS", 10)
    got = {r["doc_id"]: r for r in lm.score_documents(spark, docs).collect()}
    toks = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter()
    for i, t, *_ in ROWS:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            count.update(toks(t))
    n, v = sum(count.values()), len(count)
    for i, t, *_ in ROWS:
        assert got[i]["n_tokens"] == len(toks(t)) and got[i]["n_known"] == sum(count[w] > 0 for w in toks(t)) and got[i]["train_tokens"] == n
        assert math.isclose(got[i]["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks(t)), rel_tol=1e-9)
        assert got[i]["score"] < 0


def test_ids_equal_the_tokenizer():
    encode = packing.encoder()
    for text in ("", " ", "a", "a b", "a b c d e", " lead a b c", "trail a b c ", "two  spaces a b", "tab\t a b c", "line\n a b c d", "line a\nb c d e", "no\u00a0break a b c", "end\u00a0 a b c", "x it's 12'll b c é 中 \U0001f600 d",
                 "x <|endoftext|> y z w", "\u3000 a b c d", "a b c\u2003 d e f", BASE):
        assert lm.ids_of([text.encode()])[0].tolist() == [*encode(text), lm.END], text


def test_every_place_of_every_text_may_be_drawn(spark):
    texts = [" ".join(f"w{i}" for i in range(20_000)), "a b c", "", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert len(texts[0]) > 100_000
    rows = [np.frombuffer(r[1], "<u2") for r in lm.drawn(d, 1.0, packing.TOKENIZER).collect()]
    # the last places of a text may have no word of their own
    assert sum(len(t or "") // lm.GRAIN + 1 for t in texts) - 2 <= len(rows) <= sum(len(t or "") // lm.GRAIN + 1 for t in texts)
    assert sum(r[0] == lm.END for r in rows) == 4 and sum(r[-1] == lm.END and len(r) < 81 for r in rows) >= 4
    some = lm.drawn(d, 0.1, packing.TOKENIZER).count()
    assert 0.05 * len(rows) < some < 0.15 * len(rows)


def model(steps=60, seed=3):
    rng = np.random.default_rng(seed)
    docs = [rng.choice([5, 7, 11, 40_000, 1234, 300], n).astype(np.uint16) for n in (1, 15, 16, 17, 31, 32, 33, 70, 200)]
    t = lm.tables(np.bincount(np.concatenate(docs), minlength=lm.VOCAB).astype(float))
    return lm.train([d for d in docs for _ in range(30)], t), t, docs


def plainly(p, t, doc):
    """log10 P(doc), one id after the other, by the full distribution over all ids."""
    e = lambda z: lm.power(np.array(z, np.float32)).astype(float)
    ids, out = [lm.END, lm.END, *map(int, doc)], 0.0
    for i in range(len(doc)):
        begin = max(0, i // lm.STEP * lm.STEP - lm.STEP)  # the window: the half before and its own up to here
        x = p["ids"][t["row"][[ids[j + 1] for j in range(begin, i + 1)]]]
        far = np.exp(p["far"][i - np.arange(begin, i + 1), 0])
        w = e((x[-1] @ p["q"]) @ (x @ p["k"]).T) * far
        seen = (w / w.sum()) @ (x @ p["v"])
        h = np.clip(x[-1] @ p["one"] + seen @ p["more"] + p["mbias"] + p["two"][t["row"][ids[i]]], 0, lm.TOP)
        of_class = e(h @ p["out"] + p["obias"])
        of_class /= of_class.sum()
        inside = np.exp(t["inside"].astype(float))
        for c in range(lm.CLASSES):
            own = np.flatnonzero(t["class"] == c)
            z = e(h @ p["member"][c] + p["mbias_in"][c])
            inside[own] = (z / z.sum())[t["member"][own]]
        all_ids = of_class[t["class"]] * inside
        assert abs(all_ids.sum() - 1) < 1e-3
        out += math.log10(all_ids[doc[i]])
    return out


def test_score_equals_a_plain_loop(monkeypatch):
    p, t, docs = model()
    want = [plainly(p, t, d) for d in docs]
    for size in (1024, 3):
        monkeypatch.setattr(lm, "SLICE", size)
        assert np.allclose(lm.score_ids(lm.ready(p), t, docs), want, rtol=2e-3)
    # the fast power is close to the one that the model learns with
    exact = -float(lm.loss(p, t, *lm.steps_of(docs))) * sum(map(len, docs)) / math.log(10) + sum(float(t["inside"][d[t["class"][d] >= lm.CLASSES]].sum()) for d in docs) / math.log(10)
    assert abs(sum(want) - exact) < 0.02 * abs(exact)


def test_windows_overlap_by_half_and_score_every_id_once():
    assert lm.WINDOW == 2 * lm.STEP
    docs = [np.arange(n, dtype=np.uint16) + 1 for n in (1, 16, 17, 50)]
    before, two, target, first = lm.steps_of(docs)
    assert target[target >= 0].tolist() == [int(i) for d in docs for i in d] and first.sum() == 4
    assert before[0, 0] == lm.END and before[1, 1] == 1 and two[1, 2] == 1 and two[1, 1] == lm.END


def test_held_out_beats_the_word_count_and_needs_attention(spark, monkeypatch):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    kept = {}
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda *a: kept.setdefault("it", fit(*a)))
    got = lm.score_documents(spark, d).where("held_out")
    words, score, base = got.agg(F.sum("n_tokens"), F.sum("score"), F.sum("base_score")).first()
    assert score / words > base / words + 0.05
    p, t = kept["it"]
    some = [r[0] for r in d.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2) & (F.col("doc_id") % 20 == 0)).select("text").collect()]
    ids, words = lm.ids_of([x.encode().lower() for x in some]), sum(len(x.split()) + 1 for x in some)
    full = lm.score_ids(lm.ready(p), t, ids).sum() / words
    without = lm.score_ids(lm.ready(p | {"more": p["more"] * 0}), t, ids).sum() / words
    assert without < full - 0.3


def test_weights_are_learned_from_every_training_id(spark, monkeypatch):
    doc = np.arange(205, dtype=np.uint16)
    assert np.concatenate([b[1:] for b in lm.blocks_of(doc)]).tolist() == doc.tolist() and [b[0] for b in lm.blocks_of(doc)] == [lm.END, 79, 159]
    monkeypatch.setattr(lm, "train", lambda blocks, t: lm.start(t, np.random.default_rng(23)))  # nothing comes from drawn places
    monkeypatch.setattr(lm, "PART", 20_000)
    monkeypatch.setattr(lm, "ALL_BATCH", 4)
    monkeypatch.setattr(lm, "ALL_RATE", 0.02)
    learn = spark.createDataFrame([(i, f"some words {i} of text {i % 7} " * 20) for i in range(200)] + [(200, None), (201, "")], "doc_id long, text string")
    counts = lm.count_tokens(learn, packing.TOKENIZER)
    p, t = lm.fit(spark, learn, counts, packing.TOKENIZER)
    first = lm.start(t, np.random.default_rng(23))
    steps = lm.steps_of(lm.ids_of([(r[1] or "").encode() for r in learn.collect()]))
    assert float(lm.loss(p, t, *steps)) < float(lm.loss(first, t, *steps)) - 0.05
    again, _ = lm.fit(spark, learn.repartition(7), counts, packing.TOKENIZER)
    assert all(np.allclose(p[k], again[k], atol=1e-4) for k in p)


def test_new_pieces_are_encoded_together():
    texts = [" ".join(f"word{i}x{j}" for j in range(50)).encode() for i in range(100)]
    encode, calls = packing.encoder(), []
    pieces = lm.Pieces(lambda t: calls.append(t) or encode(t), packing.widths())
    got = pieces.ids(texts)
    assert [g.tolist() for g in got] == [encode(t.decode()) for t in texts] and len(calls) <= 2 * len(texts) + 1  # not one call for each of 4,800 words
    pieces.most = 10
    assert all(np.array_equal(x, y) for x, y in zip(got[::-1], pieces.ids(texts[::-1])))
    big = b" ".join(texts)
    assert b" ".join(lm.slices(big, 100)) == big and max(map(len, lm.slices(big, 100))) < 120 and [*lm.slices(b"", 5)] == [b""] and [*lm.slices(b"abcdefgh i", 3)] == [b"abcdefgh", b"i"]
    odd = ["a b c d  e f", "x \ud800 y z w", "x 𐀀 y z w", "a  b c d", "a b c\n d e", "a b <|endofte xt c"]
    whole = lambda t: encode(t)
    assert [x.tolist() for x in pieces.ids([t.encode("utf-8", "surrogatepass") for t in odd])] == [whole(t) for t in odd]


def test_gradient_equals_the_derivatives_of_the_loss(monkeypatch):
    rng = np.random.default_rng(7)
    docs = [(rng.integers(0, 70, n) ** 2).astype(np.uint16) for n in (1, 15, 16, 17, 33, 70, 400)]  # ids of many classes
    t = lm.tables(np.bincount(np.concatenate(docs), minlength=lm.VOCAB).astype(float))
    p = lm.start(t, rng)
    p["far"], p["mbias"] = (p[k] + rng.normal(0, 0.1, p[k].shape).astype(np.float32) for k in ("far", "mbias"))
    blocks = [b for d in docs for b in lm.blocks_of(d)]
    for steps in (lm.steps_of(docs), lm.steps_of(blocks, False), lm.steps_of(blocks[:1], False)):
        live = {k: nn.Var(v) for k, v in p.items()}
        nn.backward(lm.loss(live, t, *steps))
        with monkeypatch.context() as m:
            m.setattr(lm, "power", np.exp)
            exact = lm.gradient(p, t, *steps)
        fast = lm.gradient(p, t, *steps)
        for k in p:
            want = live[k].grad if live[k].grad is not None else np.zeros_like(p[k])
            most = max(float(np.abs(want).max()), 1e-3)
            assert np.abs(exact[k] - want).max() < 1e-3 * most and np.abs(fast[k] - want).max() < 0.3 * most, k


def test_every_id_is_learned_from_without_a_graph(monkeypatch):
    p, t, docs = model(5)
    monkeypatch.setattr(nn, "backward", lambda loss: 1 / 0)
    q, n = lm.learn_all(p, t, docs, 1)
    assert n == sum(map(len, docs)) and float(lm.loss(q, t, *lm.steps_of(docs))) < float(lm.loss(p, t, *lm.steps_of(docs)))
