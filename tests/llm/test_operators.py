"""The training-data operators against plain Python, on small tables with nulls, empties, repeats and clashing columns."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanloom.llm import exact, html_text, lm, mixing, near, packing, quality_cnn, quality_rules, repeats, toxicity
from spanloom.llm.common import shingles

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = " ".join(f"word{i % 37}x{i}" for i in range(120))
ROWS = [
    (1, BASE, "en", "a", 1), (2, BASE, "en", "b", 1), (3, BASE.replace("word3x3 ", "changed "), "en", None, 1), (4, None, None, "a", None), (5, "", "en", "b", 0),
    (6, "tiny", "en", "a", 4), (7, "tiny", "en", None, 4), (8, "x\n" * 70 + "é\t\x0b!", "fr", "c", 9), (8, "x\n" * 70 + "é\t\x0b!", "fr", "c", 9), (None, "no id here", "en", "a", 1),
    (10, " ".join(f"long{i}" for i in range(9000)), "en", "c", 1), (11, "START " + BASE[100:400] + " END", "en", "d", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clash(docs):
    return docs.withColumns({c: F.lit("other") for c in ("keep_id", "kept", "row", "band", "key", "hash", "size", "n", "rep", "digest", "taken")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


ALL = [
    (quality_rules.quality_rules, True), (lambda s, d: packing.pack(d), False), (mixing.mix_sources, True), (exact.exact_dedup, True), (near.near_duplicates, True),
    (lm.score_documents, True), (repeats.remove_repeats, True),
]


@pytest.mark.parametrize("op,one_each", ALL)
def test_any_table(spark, docs, clash, empty, op, one_each):
    assert op(spark, empty).count() == 0
    got = op(spark, clash).collect()
    if one_each:
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)


def test_quality_rules(spark, docs):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark, docs).collect()}
    for i, text, *_ in ROWS:
        words = (text or "").encode().split()
        three = Counter(zip(words, words[1:], words[2:]))
        covered = {j + k for j in range(len(words) - 2) if three[tuple(words[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert got[i]["n_words"] == len(words)
        assert got[i]["n_repeat_words"] == len(covered)
        assert got[i]["n_dup_lines"] == len(lines) - len(set(lines))
        assert got[i]["word_chars"] == sum(len(w.decode()) for w in words)
        assert got[i]["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (got[i]["kept"] and got[i]["base_failed"])
    assert got[1]["kept"] and not got[8]["kept"]


def test_rules_recover_simulated_accuracies():
    """Votes of either side, as the model has them: the accuracies within the bounds and the share come back."""
    rng = np.random.default_rng(0)
    n, k = 40_000, len(quality_rules.RULES)
    kind = np.array([0] * (k - quality_rules.GOOD - quality_rules.SEVERE) + [1] * quality_rules.SEVERE + [2] * quality_rules.GOOD)
    right = np.where(kind == 0, rng.uniform(0.65, 0.95, k), np.where(kind == 1, 0.97, 0.55))
    good = rng.random(n) < 0.75
    side = np.where(good, 1, -1)[:, None] * np.where(rng.random((n, k)) < right, 1, -1)
    votes = side * (rng.random((n, k)) < 0.4)
    model = quality_rules.fit(Counter(quality_rules.pattern_of(list(v)) for v in votes))
    assert np.abs(model["accuracy"] - right).max() < 0.03 and abs(model["share"] - 0.75) < 0.02
    assert ((quality_rules.posterior(model, votes) >= 0.5) == good).mean() > 0.95


def test_symbols_of_the_contract():
    text = "#a *b $c %d &e |f <g> plain - = + @"
    assert quality_rules.measure(text)[0][2] == 8 and quality_rules.measure(None)[0] == [0, 0, 0, 0, 0]


def test_packing_round_trip(spark, docs):
    rows = packing.pack(docs).collect()
    encode = packing.encoder()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, text, *_ in ROWS:
        ids = [*encode(text or ""), 0]
        times = sum(x[0] == i for x in ROWS)
        assert sum(r["length"] for r in by_doc[i]) == times * len(ids)
        for r in by_doc[i]:
            piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


def test_fast_and_plain_tokenizer_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("", " a  b\n\n c\té中 12'll", BASE, "x <|endoftext|> y", "\U0001f600   tail  "):
        assert packing.encoder()(text) == plain.encode(text, add_special_tokens=False).ids


def test_mixing(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix_sources(spark, d).collect()
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(spark, d.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(100, 0.05 * t)
    assert mixing.targets([10, 10, 100], [1, 1, 1]) == [30.0, 30.0, 60.0]
    assert sorted(mixing.permute(np.arange(101), np.full(101, 101), np.full(101, np.uint64(9)))) == list(range(101))


def test_exact(spark, docs):
    got = {}
    for r in exact.exact_dedup(spark, docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[1][0]["keep_id"] == 2 and not got[1][0]["kept"] and got[2][0]["kept"]
    assert got[4][0]["keep_id"] == 5 and got[5][0]["group_size"] == 2
    assert sorted(r["kept"] for r in got[8]) == [False, True]
    assert got[5][0]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    assert exact.drop_copies(spark, docs).count() == 8 and exact.drop_copies(spark, docs).columns == docs.columns


def brute_classes(rows):
    sets = {i: set(shingles((t or "").encode()).tolist()) for i, t in rows}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    return root


def test_near(spark, docs):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_classes([(r[0], r[1]) for r in d.select("doc_id", "text").collect()])
    assert {r["doc_id"]: r["class_id"] for r in near.near_duplicates(spark, d).collect()} == want
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(spark, docs).collect()}
    assert got[3] == got[2] == got[1] == 1 and got[7] == 6 and got[4] == 4 and got[5] == 5


def test_near_finds_a_copy_with_a_repeated_passage(spark):
    rows = []
    for k in range(10):
        words = [f"w{k}x{i}" for i in range(204)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:100] + words[80:100] * 19 + words[100:]))]
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) == {i: i // 2 * 2 for i in range(20)}


@pytest.mark.parametrize("small,block", [(1, 3), (6, 512)])
def test_near_large_bucket_is_searched_whole(spark, monkeypatch, small, block):
    signed = near._signatures
    one = lambda docs: signed(docs).withColumn("bands", F.expr("if(digest IS NULL, null, array(1L))"))
    monkeypatch.setattr(near, "_signatures", one)  # one bucket for all
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "BLOCK", block)
    rows = [(0, BASE)]
    for k in range(12):
        words = [f"q{k}x{i}" if i < 60 else f"all{i}" for i in range(100)]
        rows += [(3 * k + 1 + j, " ".join(words[: 70 + 8 * j] + [f"end{k}"] + words[71 + 8 * j :])) for j in range(3)]
    got = {r["doc_id"]: r["class_id"] for r in near.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows) and len(set(got.values())) == 13


def test_prob_min_hash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(1, 2**63, 60, dtype=np.uint64))
    a, b = np.r_[x[:45]], np.r_[x[15:]]
    wa, wb = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
    held = near.prob_min_hash(np.r_[a, b], np.r_[wa, wb], np.repeat([0, 1], [len(a), len(b)]), 2, 4000)
    A, B = dict(zip(a, wa)), dict(zip(b, wb))
    exact_ = sum(1 / sum(max(A.get(j, 0) / A[i], B.get(j, 0) / B[i]) for j in x) for i in x if i in A and i in B)
    assert abs((held[0] == held[1]).mean() - exact_) < 0.03


def test_near_ids_with_two_texts(spark):
    """Rows are judged by their own texts: no row more, no link lost, one kept in each class."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    a2, b2 = a + " more", "more " + b
    rows = [(1, a), (1, b), (2, a2), (3, b2), (2, "alone here, but for its id, with more than five words"), (3, b2), (None, a), (None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.near_duplicates(spark, d).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert Counter((r["doc_id"], r["class_id"], r["class_size"], r["kept"]) for r in got) == Counter(
        [(1, 1, 2, True), (2, 1, 2, False), (1, 1, 3, True), (3, 1, 3, False), (3, 1, 3, False), (2, 2, 1, True), (None, None, 1, True), (None, None, 1, True)]
    )
    assert Counter(map(tuple, near.drop_near(spark, d).collect())) == Counter([r for r in rows if r not in [(2, a2), (3, b2)]])


@pytest.mark.parametrize("large", [repeats.LARGE, 1])
def test_repeats(spark, docs, large):
    d = docs.where("doc_id IS NOT NULL").select("doc_id", "text").dropDuplicates()
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark, d, large).collect()}
    seen = {}
    for i, text in sorted((r[0], (r[1] or "").encode()) for r in d.collect()):
        cut = bytearray(len(text))
        windows = [text[j : j + 50] for j in range(len(text) - 49)]
        for j, w in enumerate(windows):
            if seen.get(w, i) < i:
                cut[j : j + 50] = b"\1" * 50
        for w in windows:
            seen.setdefault(w, i)
        assert got[i]["n_removed"] == sum(cut) and got[i]["n_spans"] == len(bytes(cut).split(b"\0")) - bytes(cut).split(b"\0").count(b"")
        assert got[i]["kept_sha256"] == hashlib.sha256(bytes(b for b, c in zip(text, cut) if not c)).hexdigest()
    assert got[2]["n_removed"] == got[2]["n_bytes"]


def test_run_index():
    rng = np.random.default_rng(5)
    base = bytes(rng.integers(97, 100, 400, dtype=np.uint8))
    cut = [(base if i % 3 else b"ab" * 200)[a : a + int(rng.integers(50, 81))] for i, a in enumerate(rng.integers(0, 300, 300))]
    doc = rng.integers(0, 40, len(cut))
    least = {}
    for c, d in zip(cut, doc):
        for j in range(len(c) - 49):
            least[c[j : j + 50]] = min(least.get(c[j : j + 50], d), d)
    want = [sum((least[c[j : j + 50]] < d) << j for j in range(len(c) - 49)) for c, d in zip(cut, doc)]
    got = repeats.marks(np.array([len(c) for c in cut]), b"".join(cut), doc)
    assert got.tolist() == want and any(want)


@pytest.mark.parametrize("mod,label", [(quality_cnn, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, docs, mod, label):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    got = mod.classify(spark, docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % mod.FOLDS == mod.HELD) for r in got)
    none = mod.classify(spark, docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_cnn.op6_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.93


def test_toxicity_reads_all_bytes_of_a_word_and_starts_from_no_counts():
    a, b = "x" * 40 + "good", "x" * 40 + "evil"
    w = toxicity.Words([f"{a} {b}", "", None])
    slot, grams, n, at = w.inputs(np.array([[0, 1, -1]]))
    assert n.tolist() == [44, 44] and w.count.tolist() == [2, 0, 0] and at.tolist()[0][2] == -1
    assert set(grams[:44]) != set(grams[44:])
    p = toxicity.train([a, b] * 4, np.array([0, 1] * 4, np.float32))
    assert p["out"].shape[0] == 2 * toxicity.HIDDEN  # the output sees words through the recurrent states only
    got = toxicity.scores(p, [a, b, None])
    assert got[1] > got[0]


def test_toxicity_held_out():
    read = lambda name: pq.read_table(f"/root/testdata/sf0.1/{name}.parquet").to_pydict()
    docs, labels = read("documents"), read("labels")
    toxic = dict(zip(labels["doc_id"], labels["toxic"]))
    rows = [(zlib.crc32(str(i).encode()) % 5 == 0, t, toxic[i]) for i, t in zip(docs["doc_id"], docs["text"]) if toxic.get(i) is not None]
    learn, held = [r for r in rows if not r[0]], [r for r in rows if r[0]]
    learn = [r for r in learn if r[2]] + [r for r in learn if not r[2]][:1200]
    p = toxicity.train([r[1] for r in learn], np.array([r[2] for r in learn], np.float32))
    held = [r for r in held if r[2]] + [r for r in held if not r[2]][:400]
    got, y = toxicity.scores(p, [r[1] for r in held]), np.array([r[2] for r in held])
    assert np.mean(got[y == 1][:, None] > got[y == 0][None]) > 0.85  # the area under the curve


def test_toxic_windows_cover_all_words():
    at, owner = toxicity.windows(np.array([0, 1, 32, 33, 200]))
    assert (at[owner == 0] == -1).all()
    assert set(at.reshape(-1)) - {-1} == set(range(266))


def test_html(spark):
    page = '<body><header>Site</header><article><h1>T</h1><p>A &amp; b<br>c</p><script>x="</p>"</script><p>Last  one.</article><footer>foot</footer>'
    d = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", ""), (3, "v", "")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_text.extract(spark, d).collect()}
    assert got[1]["text"] == "T\nA & b c\nLast one." and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == ""
    assert html_text.extract(spark, d.limit(0)).count() == 0


def test_html_that_leaves_tags_out():
    says = lambda page: [b[1] for b in html_text.blocks(page)]
    assert says("<html><head><title>T</title><meta a><body><p>Hi<p>there") == ["Hi", "there"]
    assert says("<head><title>T</title>plain<p>x") == ["plain", "x"] and says("<title>T</title>x") == ["x"]
    assert says("<p>a<select><option>x<p>b<svg><p>c<noscript>d") == ["a", "x", "b", "cd"]
    assert says("<p>a<script>if (x<y)</p>") == ["a"] and says("<p>a<!-- b<p>c") == ["a"] and says("<header>h</header><p>z") == ["h", "z"]
    assert says("<p>" + "w " * 200_000) == [("w " * 200_000).strip()]
    long = "<article>" + "<p>word again and again.</p>" * 20_000 + "</article><nav>off</nav>"
    (paths, words, nums), y = html_text.sure(long)
    assert len(paths) == len(words) == len(nums) == len(y) == html_text.LONGEST and html_text.sure("<p>doubt") is None and html_text.sure(None) is None


def test_html_label_needs_the_blocks_around_it():
    p = html_text.train([])
    words = "one plain line of some words that says little."
    page = lambda near: f"<html><body><div class='post-body'><h1>Title of it</h1>{'<p>A long paragraph of the story that goes on for a while, as they do.</p>' * 4}</div>{near}</body></html>"
    inner = [html_text.vectors(html_text.blocks(page(f"<p>{words}</p>")))]
    alone = [html_text.vectors(html_text.blocks(f"<html><body><p>{words}</p></body></html>"))]
    with_, without = html_text.forward(p, inner)[-1], html_text.forward(p, alone)[-1]
    assert abs(with_ - without) > 0.1  # the same block, another context


def test_html_labels_of_held_out_pages_come_through_the_recurrence():
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).to_pylist()]
    p = html_text.train([x for x in map(html_text.sure, pages[:150]) if x])
    found = [html_text.blocks(h) for h in pages[150:]]
    y = np.concatenate([html_text.plain_labels(f) for f in found]) > 0
    whole = [html_text.vectors(f) for f in found]
    right = lambda p, seen: np.mean((html_text.forward(p, seen) > 0) == y)
    assert right(p, whole) == 1 and html_text.texts(p, pages[150:])[0].count("\n") > 0
    # half of the blocks without their paths: neighbours tell, if they can be seen
    rng = np.random.default_rng(3)
    seen = [html_text.hide(rng, v, 0.5) for v in whole]
    still = {**p, "hf": 0 * p["hf"], "hb": 0 * p["hb"]}
    apart = [([a], [b], c[None]) for v in seen for a, b, c in zip(*v)]
    assert right(p, seen) > 0.98 and right(still, seen) < right(p, seen) - 0.015 and right(p, apart) < 0.93


def test_stages_keep_rows_that_only_share_an_id_and_any_column_names(spark):
    rows = [(1, "a", "s"), (1, "b", "s"), (2, "b", "s"), (5, None, "s"), (5, "", "s"), (None, "c", None), (None, "d", None), (None, "c", "t"), (9, "e f", "u"), (9, "e f", "u")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("__rn", "__mixed", "__keep", "times", "digest", "kept", "row", "size", "taken", "__dropped")})
    kept = exact.drop_copies(spark, d)
    assert kept.columns == d.columns
    assert Counter((r[0], r[1] or "") for r in kept.collect()) == Counter([(1, "a"), (2, "b"), (5, ""), (None, "c"), (None, "d"), (9, "e f")])
    few = exact.drop_copies(spark, d, largest=False)
    assert Counter((r[0], r[1] or "") for r in few.collect()) == Counter([(1, "a"), (1, "b"), (5, ""), (None, "c"), (None, "d"), (9, "e f")])
    mixed = mixing.mixed_documents(spark, d)
    assert mixed.columns == d.columns and Counter((r[0], r[1]) for r in mixed.collect() if not r[1]) == Counter([(5, None), (5, "")])
    assert near.drop_near(spark, d).columns == quality_rules.keep_good(spark, d).columns == d.columns
    for stage in (exact.drop_copies, mixing.mixed_documents, near.drop_near, quality_rules.keep_good):
        assert stage(spark, d.limit(0)).count() == 0


def test_exact_merges_sorted_runs(spark, docs):
    plan = exact.merge_runs(exact.text_digests(docs))._jdf.queryExecution().executedPlan().toString()
    # each level: an exchange by run and slice, a sort by the text's key, the merge
    assert plan.count("Window [") >= exact.LEVELS and plan.count("Sort [run") >= exact.LEVELS and "Python" not in plan and "Arrow" not in plan


def test_mixing_offsets_do_not_depend_on_shelves(spark, monkeypatch):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    want = {(r["doc_id"], r["taken"]) for r in mixing.mix_sources(spark, d).collect()}
    monkeypatch.setattr(mixing, "SHELF", 3)
    got = mixing.mix_sources(spark, d).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == want
    size, total = Counter(), 0
    for r in d.select("source", "text").collect():
        size[r[0]] += len((r[1] or "").encode().split())
    target = dict(zip(sorted(size), mixing.targets([size[s] for s in sorted(size)], [1 + i % 3 for i in range(len(size))])))
    sizes = {r[0]: len((r[1] or "").encode().split()) for r in d.select("doc_id", "text").collect()}
    source = {r[0]: r[1] for r in d.select("doc_id", "source").collect()}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == size[s] and math.isclose(r["target"], target[s])


def test_mixing_broadcasts_only_the_sources(spark, monkeypatch):
    seen, staged = [], mixing.staged
    monkeypatch.setattr(mixing, "staged", lambda s, df: staged(s, seen.append(df) or df))
    d = spark.read.parquet(f"{SF}/documents.parquet")
    seen += [mixing.mix_sources(spark, d), mixing.mixed_documents(spark, d)]
    merged = ""
    for df in seen:
        assert df.collect()
        for x in df._jdf.queryExecution().executedPlan().toString().splitlines():
            assert "BroadcastHashJoin" not in x or "__source#" in x
            merged += x * ("SortMergeJoin" in x)
    assert all(f"{c}#" in merged for c in ("shelf", "__bucket", "block", "rn"))


def test_long_texts_and_contradicting_labels_are_learned_from(spark):
    from spanloom.llm.labelled import CAP, PARTS, sample

    text = "".join(f"{i:07d} " for i in range(20_000))
    d = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    texts, y = sample(spark, d, labels, "quality", 10_000, -1, 10)
    assert y.tolist() == [1, 1] and texts[1] == "short" and len(texts[0]) == CAP + PARTS - 1
    parts = texts[0].split(" ")
    assert parts[0] == "0000000" and text.endswith(texts[0][-1000:])


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, step = [n for n, _ in corpus_pipeline.STAGES], docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = stage(spark, step, SF)
        assert step.columns == docs.columns
    kept = {r["doc_id"] for r in quality_rules.quality_rules(spark, docs).where("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    last = {}
    for i in sorted(kept):
        last[texts[i]] = i
    want = {c for c in brute_classes([(i, t) for t, i in last.items()]).values()}
    assert {r["doc_id"] for r in step.collect()} == want
    assert names == ["quality rules", "exact dedup", "near dedup", "mixing", "packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0
