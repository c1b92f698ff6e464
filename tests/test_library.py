"""What SQL does not cover: resampling, files in and out, streams."""

import json
import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import annotate, link, model, spans, stats, taxonomy
from spanloom.operators.annotator import annotate_passages
from spanloom.sources import articles, files
from spanloom.streaming.incremental import annotate_new_files


def test_resampling_matches_the_binomial_tail(spark):
    front = spark.createDataFrame([("g", "a", 12), ("g", "b", 5), ("g", "c", 3), ("h", "z", 4)], "rank string, tax_id string, n long")
    back = spark.createDataFrame([("g", "a", 50), ("g", "b", 30), ("g", "c", 20), ("h", "z", 9)], "rank string, tax_id string, n long")
    got = {(r[0], r[1]): r[2] for r in stats.resampled_p_values(front, back, 2000).collect()}
    for tax, seen, w in (("a", 12, 0.5), ("b", 5, 0.3), ("c", 3, 0.2)):
        tail = sum(math.comb(20, i) * w**i * (1 - w) ** (20 - i) for i in range(seen, 21))
        assert abs(got[("g", tax)] - tail) < 0.05
    assert got[("h", "z")] == 1
    assert got == {(r[0], r[1]): r[2] for r in stats.resampled_p_values(front, back, 2000).collect()}


def test_resampling_of_a_split_rank(spark, monkeypatch):
    """Leaves of a few taxa: each resample's counts add up to the total, whatever leaf they fall in; the tail is the binomial's."""
    monkeypatch.setattr(stats, "BLOCK_TAXA", 3)
    rng = random.Random(3)
    front = [("hot", f"t{i:02d}", rng.randrange(0, 9)) for i in range(40)]
    back = [("hot", f"t{i:02d}", rng.randrange(0, 50)) for i in range(44)]
    make = lambda rows: spark.createDataFrame(rows, "rank string, tax_id string, n long")
    got = {r["tax_id"]: r["p_value"] for r in stats.resampled_p_values(make(front), make(back), 3000).collect()}
    weights = {t: n for _, t, n in back}
    whole, total = sum(weights[t] for _, t, _ in front), sum(n for *_, n in front)
    for _, tax, seen in front:
        w = weights[tax] / whole
        tail = sum(math.comb(total, i) * w**i * (1 - w) ** (total - i) for i in range(seen, total + 1))
        assert abs(got[tax] - tail) < 0.05
    # a rank whose counts are the background's is drawn evenly
    same = {r["tax_id"]: r["p_value"] for r in stats.resampled_p_values(make([("s", "a", 9), ("s", "b", 1)]), make([("s", "a", 9), ("s", "b", 1)]), 3000).collect()}
    tail = lambda seen: sum(math.comb(10, i) * 0.5**10 for i in range(seen, 11))
    assert abs(same["a"] - tail(9)) < 0.02 and abs(same["b"] - tail(1)) < 0.02
    w = np.arange(1, 9)
    sums = [w[i : i + 2].sum() for i in (0, 2, 4, 6)]
    paths = {0: [(36, sums[0] + sums[1]), (sums[0] + sums[1], sums[0])], 1: [(36, sums[0] + sums[1]), (sums[0] + sums[1], sums[0])], 2: [(36, sums[0] + sums[1]), (sums[2] + sums[3], sums[2])], 3: [(36, sums[0] + sums[1]), (sums[2] + sums[3], sums[2])]}
    drawn = np.hstack([stats._drawn(1, "r", 0, 500, 70, paths[i], i, w[2 * i : 2 * i + 2]) for i in range(4)])
    assert (drawn.sum(1) == 70).all() and np.abs(drawn.mean(0) - 70 * w / 36).max() < 0.6


def _collection(i):
    return {"source": "s", "documents": [{"id": f"D{i}", "passages": [{"offset": 0, "infons": {"section_title_1": "t"}, "text": f"Helicobacter pylori {i}"}, {"offset": 30, "infons": {}, "text": "none"}]}]}


def test_files_round_trip(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in (1, 2):
        (src / f"a{i}_bioc.json").write_text(json.dumps(_collection(i)))
    (src / "other.json").write_text("{}")
    rows = files.passages(files.read_collections(spark, str(src)))
    assert rows.count() == 4
    m = spark.createDataFrame([("a1_bioc.json", "D1", 0, "Helicobacter pylori", 0, 19, "T1")], "file_name string, doc_id string, passage_no int, text string, start long, length long, tax_id string")
    out = str(tmp_path / "out")
    files.write_annotated(files.annotated_json(rows, m), out)
    got = {r["file_name"]: json.loads(r["value"]) for r in spark.read.text(out).collect()}
    p = got["a1_bioc.json"]["documents"][0]["passages"]
    assert p[0]["annotations"][0]["locations"] == [{"offset": 0, "length": 19}] and p[0]["annotations"][0]["infons"] == {"identifier": "T1"}
    assert p[1]["text"] == "none" and len(got) == 2
    done = tmp_path / "done"
    done.mkdir()
    (done / "a1_bioc.json").write_text("{}")
    assert [r["file_name"] for r in files.read_collections(spark, str(src), done=str(done)).collect()] == ["a2_bioc.json"]


def test_id_lists_and_pairs(spark, tmp_path):
    for name, text in (("x.csv", "a,1\nb,2\n"), ("x.tsv", "a\t1\nb\t2\n"), ("x.txt", " a \n\nb\n")):
        (tmp_path / name).write_text(text)
        assert sorted(r[0] for r in files.read_ids(spark, str(tmp_path / name)).collect()) == ["a", "b"]
    (tmp_path / "names").write_text("T1||one\n\nT2\n")
    assert sorted(tuple(r) for r in files.read_pairs(spark, str(tmp_path / "names")).collect()) == [("T1", "one"), ("T2", "")]


def test_stream_sees_each_file_once(spark, tmp_path):
    src, out, ck = (tmp_path / x for x in ("in", "out", "ck"))
    src.mkdir()
    for i in (1, 2):
        (src / f"a{i}_bioc.json").write_text(json.dumps(_collection(i)))
        annotate_new_files(spark, str(src), str(out), str(ck), lambda p: p.select("doc_id", "passage_no")).awaitTermination(60)
    rows = [tuple(r) for r in spark.read.parquet(str(out)).select("doc_id", "passage_no").collect()]
    assert sorted(rows) == [("D1", 0), ("D1", 1), ("D2", 0), ("D2", 1)]


def test_lineages_of_any_depth_and_of_none(spark):
    deep = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(60)] + [("n60", "n60")], "child string, parent string")
    got = taxonomy.ancestors(deep, spark.createDataFrame([("n00",), ("n59",), ("alone",)], "tax_id string")).collect()
    assert sorted(r["distance"] for r in got if r["tax_id"] == "n00") == list(range(61)) and sum(r["tax_id"] == "alone" for r in got) == 1
    order = taxonomy.depth_first(taxonomy.attach_root(spark.createDataFrame([(f"n{i:02d}", "x") for i in range(61)], "tax_id string, rank string"), deep)).collect()
    assert {r["tax_id"]: r["dfs_order"] for r in order} == {f"n{60 - i:02d}": i for i in range(61)}
    with pytest.raises(ValueError):
        taxonomy.ancestors(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], deep.schema), spark.createDataFrame([("a",)], "tax_id string"))


def test_roll_up_passes_over_ranks_that_are_not_there(spark):
    nodes = spark.createDataFrame([("s1", "species", 8.0), ("s2", "species", 4.0), ("g", "genus", 1.0), ("f", "family", 0.0), ("x", "clade", 5.0), ("k", "superkingdom", 0.0)], "tax_id string, rank string, abundance double")
    edges = spark.createDataFrame([("s1", "g"), ("g", "f"), ("s2", "f"), ("f", "k"), ("x", "k"), ("k", "k")], "child string, parent string")
    got = {r[0]: r[2] for r in taxonomy.roll_up(nodes, edges, ["species", "genus", "family", "superkingdom"]).collect()}
    assert got == {"s1": 8, "s2": 4, "g": 9, "f": 9 / 2 + 4 / 2, "k": pytest.approx((9 / 2 + 2) / 3)}


def test_quartiles_equal_the_sorted_list(spark):
    for values in ([5], [3, 1], [1, 1, 1, 9], [random.Random(4).randint(0, 30) for _ in range(101)]):
        order = sorted(values)
        q = [order[int(len(order) * x)] for x in (0.25, 0.5, 0.75)]
        got = taxonomy.quartile_class(spark.createDataFrame([(v,) for v in values], "v int"), "v").collect()
        assert all(r["quartile"] == next((i + 1 for i in range(3) if r["v"] <= q[i]), 4) for r in got)


def test_tokens_equal_a_plain_loop_without_a_shuffle(spark):
    texts = ["", "a", " a", "a  b ", "x\ty z", "é 中 \U0001f600 end", None, " ".join("w" * (i % 7) for i in range(3000))]
    d = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, at int")
    toks = annotate.tokens(d, "at")
    assert "Exchange" not in toks._jdf.queryExecution().executedPlan().toString()
    want = []
    for i, text in enumerate(texts):
        at, words = i, [] if text is None else text.split(" ")
        for k, w in enumerate(words):
            want.append((i, k, w, at, words[k + 1] if k + 1 < len(words) else None))
            at += len(w) + 1
    assert sorted(tuple(r) for r in toks.select("doc_id", "pos", "w", "start", "next").collect()) == sorted(want)


def test_top_k_over_many_blocks_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(link, "QUERY_BLOCK", 5)
    monkeypatch.setattr(link, "ROW_BLOCK", 30)
    got = {}
    for r in link.top_k(e, e.where("vec_id % 10 = 0"), 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    for q in range(0, 120, 10):
        best = sorted(rows, key=lambda r: (-sum(a * b for a, b in zip(r[1], rows[q][1])), r[0]))[:4]
        assert [got[q][k] for k in range(1, 5)] == [r[0] for r in best]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_edit_ratio_and_headings(spark):
    pairs = [("", ""), ("a", ""), ("methods", "method"), ("kitten", "sitting"), ("abcbdab", "bdcaba"), ("é中x", "xé中")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", tx.edit_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(r["r"] == (100 if not r["a"] + r["b"] else round(200 * lcs(r["a"], r["b"]) / len(r["a"] + r["b"]))) for r in got)
    terms = spark.createDataFrame([("methods section", "materials", 1), ("methods section", "methods", 2), ("results section", "results", 3)], "term string, name string, ord int")
    heads = spark.createDataFrame([("Materials and Methods",), ("2. Result",), ("Thoughts",), ("Results & Methods",)], "heading string")
    found = sorted(tuple(r) for r in model.match_headings(heads, terms).collect())
    assert found == [("2. Result", "results section"), ("Materials and Methods", "methods section"), ("Results & Methods", "methods section"), ("Results & Methods", "results section"), ("Thoughts", "document part")]


def test_model_spans_over_windows(spark):
    text = " ".join(f"w{i}" for i in range(40)) + " Big Name tail"
    d = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "Big Name end")], "doc_id long, text string")
    predict = lambda windows: [[1 if w == "Big" else 0 if w == "tail" or w == "end" else 2 for w in ws] for ws in windows]
    lexicon = spark.createDataFrame([("big name", "T1", 1)], "name string, tax_id string, ord int")
    got = {r["doc_id"]: r for r in model.recognise(d, predict, lexicon, size=10, stride=3).collect()}
    assert set(got) == {1, 4} and got[1]["mention"] == "Big Name" and got[1]["tax_id"] == "T1" and text[got[1]["start"] :][: got[1]["length"]] == "Big Name"
    with pytest.raises(TypeError):
        model.recognise(d, "none")


def test_draws_with_replacement_follow_the_weights(spark):
    df = spark.createDataFrame([("a", 6.0), ("b", 3.0), ("c", 1.0), ("d", 0.0)], "key string, w double")
    rows = stats.sample_with_replacement(df, "key", "w", 2000, 3).collect()
    share = {k: sum(r["key"] == k for r in rows) / 2000 for k in "abcd"}
    assert sorted(r["draw"] for r in rows) == list(range(1, 2001)) and share["d"] == 0
    assert abs(share["a"] - 0.6) < 0.04 and abs(share["b"] - 0.3) < 0.04


def test_storey_bootstrap(spark):
    rng = np.random.default_rng(0)
    p = np.concatenate([rng.random(300), rng.random(100) * 0.01])
    df = spark.createDataFrame([("g", f"t{i}", float(x)) for i, x in enumerate(p)], "rank string, tax_id string, p_value double")
    got = stats.storey(df, ["rank"], method="bootstrap").collect()
    assert 0.6 < got[0]["pi0"] <= 1 and all(r["q_value"] <= 1 for r in got)
    with pytest.raises(ValueError):
        stats.storey(df, ["rank"], method="other")


LEXICON = [("helicobacter", "T1", "bacteria", "genus", 1), ("helicobacter pylori", "T2", "bacteria", "species", 2), ("hafnia pylori", "T3", "bacteria", "species", 3), ("bacillus", "T4", "bacteria", "genus", 4), ("bacillus", "T5", "animals", "genus", 5), ("proteus mirabilis", "T6", "bacteria", "species", 6)]


def test_annotator_compares_names_as_written(spark):
    names = [("Helicobacter", "T1", "bacteria", "genus", 1), ("Helicobacter pylori", "T2", "bacteria", "species", 2), ("hafnia pylori", "T3", "bacteria", "species", 3),
             ("Bacillus", "T4", "bacteria", "genus", 4), ("bacillus", "T5", "animals", "genus", 5), ("Proteus Mirabilis", "T6", "bacteria", "species", 6)]
    lexicon = spark.createDataFrame(names, "name string, tax_id string, kingdom string, rank string, ord int")
    texts = ["Helicobacter pylori and helicobacter pylori", "H. pylori or P. mirabilis or P. Mirabilis", "Bacillus", "a bacillus", "Helicobacter sp. here", "Helicobacter Sp here", "Helicobacter gen., here", None, ""]
    d = spark.createDataFrame([("f", "d", i, 0, x) for i, x in enumerate(texts)], "file_name string, doc_id string, passage_no int, offset int, text string")
    found = lambda cased: sorted((r["passage_no"], r["start"], r["text"], r["tax_id"], r["type"]) for r in annotate_passages(d, lexicon, cased).collect())
    # of names in lower case, the pair 'hafnia pylori' stands for no 'H.'; both rows named bacillus are names of their own
    assert [x[:4] for x in found(True)] == [
        (0, 0, "Helicobacter pylori", "T2"), (1, 0, "H. pylori", "T2"), (1, 29, "P. Mirabilis", "T6"), (2, 0, "Bacillus", "T4"), (3, 2, "bacillus", "T5"),
        (4, 0, "Helicobacter sp.", "T1"), (5, 0, "Helicobacter", "T1"), (6, 0, "Helicobacter", "T1"),
    ]
    kinds = {x[0]: x[4] for x in found(True)}
    assert [kinds[i] for i in (2, 3, 4, 5, 6)] == ["bacteria_genus", "animals_genus", "bacteria_species", "bacteria_genus", "bacteria_genus"]
    loose = found(False)
    assert [x[2] for x in loose if x[0] == 0] == ["Helicobacter pylori", "helicobacter pylori"] and len([x for x in loose if x[0] == 1]) == 3
    assert annotate_passages(d.limit(0), lexicon, True).count() == 0


def test_one_call_annotates_collections(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    texts = ["Seen: (Helicobacter pylori) grew.", "then H. pylori and P. mirabilis", "Bacillus alone", "Helicobacter sp. here", ""]
    old = {"id": "9", "text": "Seen", "infons": {"k": "v"}, "locations": [{"offset": 0, "length": 4}]}
    rows = [{"offset": 100 * i, "infons": {"t": "x"}, "text": x, "annotations": [old] if i == 0 else []} for i, x in enumerate(texts)]
    whole = {"source": "s", "date": "d", "key": "k", "infons": {"a": "b"}, "documents": [{"id": "Z", "infons": {"y": "1"}, "passages": rows}, {"id": "A", "infons": {}, "passages": [{"offset": 0, "infons": {}, "text": "H. pylori", "annotations": []}]}, {"id": "E", "passages": []}]}
    (src / "a_bioc.json").write_text(json.dumps(whole))
    lexicon = spark.createDataFrame(LEXICON, "name string, tax_id string, kingdom string, rank string, ord int")
    files.annotate_collections(spark, str(src), out, lexicon)
    read = lambda: {p.name: json.loads(p.read_text()) for p in Path(out).iterdir()}
    got = read()["a_bioc.json"]
    assert {k: got[k] for k in ("source", "date", "key", "infons")} == {k: whole[k] for k in ("source", "date", "key", "infons")}
    assert [d["id"] for d in got["documents"]] == ["Z", "A", "E"] and got["documents"][0]["infons"] == {"y": "1"} and got["documents"][2]["passages"] == []
    p = got["documents"][0]["passages"]
    brief = lambda q: [(a["text"], a["infons"].get("identifier"), a["locations"][0]["offset"]) for a in q["annotations"] if a.get("id") != "9"]
    assert p[0]["annotations"][0] == old and brief(p[0]) == [("Helicobacter pylori", "T2", 7)]
    assert brief(p[1]) == [("H. pylori", "T2", 105), ("P. mirabilis", "T6", 119)]
    assert brief(p[2]) == [("Bacillus", "T4,T5", 200)] and p[2]["annotations"][0]["infons"]["type"] == "unresolved"
    assert brief(p[3]) == [("Helicobacter sp.", "T1", 300)] and p[3]["annotations"][0]["infons"]["type"] == "bacteria_species" and p[4]["annotations"] == []
    assert brief(got["documents"][1]["passages"][0]) == [("H. pylori", "T3,T2", 0)] or brief(got["documents"][1]["passages"][0]) == [("H. pylori", "T2,T3", 0)]
    (src / "b_bioc.json").write_text(json.dumps({"documents": [{"id": "B", "passages": [{"offset": 0, "infons": {}, "text": "Proteus mirabilis", "annotations": []}]}]}))
    files.annotate_collections(spark, str(src), out, lexicon)
    again = read()
    assert again["a_bioc.json"] == got and brief(again["b_bioc.json"]["documents"][0]["passages"][0]) == [("Proteus mirabilis", "T6", 0)]


def test_spans_that_lost_parentheses(spark):
    rows = [(1, 0, 7, "ab (c) d e", "ab c d e"), (2, 0, 6, "(ab) c d", "ab c d"), (3, 0, 16, "Escherichia. coli x", "Escherichia coli"), (4, 0, 2, "ab sp. x", "ab")]
    d = spark.createDataFrame(rows, "doc_id int, start long, length int, passage string, text string")
    got = {r["doc_id"]: (r["start"], r["text"]) for r in spans.repair(d).collect()}
    assert got[4] == (0, "ab sp.") and got[2] == (0, "(ab) c d")


def test_escapes_and_mojibake(spark):
    texts = ["plain", "a\\u00e9b", "\\ud83d\\ude00!", "lone \\ud83d x", "\\", "\\u12", "C:\\users \\u0041", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").orderBy("i").select(tx.unescape(F.col("x"))).collect()]
    assert got == ["plain", "aéb", "\U0001f600!", "lone \\ud83d x", "\\", "\\u12", "C:\\users A", "", None]

    def plain(s):
        for a, b in (("latin1", "utf-8"), ("utf-8", "latin1")):
            try:
                return s.encode(a).decode(b)
            except UnicodeError:
                pass

    bad = ["plain", "Ã©", "é", "中", "Ã", "caf\u00c3\u00a9 \u00e2\u0082\u00ac", "", "\U0001f600"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(bad)], "i int, x string").orderBy("i").select(tx.fix_mojibake(F.col("x"))).collect()]
    assert got == [plain(s) for s in bad]


def test_layout_is_kept_and_grown(spark):
    rooted = spark.createDataFrame([("r", "root"), ("a", "r"), ("b", "r"), ("a1", "a"), ("a2", "a"), ("b1", "b")], "tax_id string, parent string").withColumn("rank", F.lit("x"))
    at = taxonomy.layout(rooted, rooted.select("tax_id", F.lit(1.0).alias("radius")))
    got = {r["tax_id"]: r["angle"] for r in at.collect()}
    third = 2 * math.pi / 3
    want = {"a1": 0, "a2": third, "b1": 2 * third, "a": third / 2, "b": 2 * third, "r": math.pi + third / 2 + third - math.pi}
    lo, hi = got["a"], got["b"]
    want["r"] = (lo + hi) / 2 if hi - lo <= math.pi else ((lo + hi - 2 * math.pi) / 2) % (2 * math.pi)
    assert got == pytest.approx(want)
    edges = spark.createDataFrame([("n1", "a"), ("n2", "n1"), ("z", "y")], "child string, parent string")
    nodes = spark.createDataFrame([("a", 5.0), ("n1", 2.0), ("n2", None), ("z", 1.0)], "tax_id string, radius double")
    more = {r["tax_id"]: (r["angle"], r["radius"]) for r in taxonomy.reuse_layout(nodes, edges, at).collect()}
    assert set(more) == {"a", "n1", "n2"}
    assert more["a"] == pytest.approx((got["a"], 1.0)) and more["n1"] == pytest.approx((got["a"] + 0.1, 2.0)) and more["n2"] == pytest.approx((got["a"] + 0.2, 1.2))


ARTICLE = """<article article-type="research-article"><front><journal-meta><journal-title-group><journal-title>J</journal-title></journal-title-group></journal-meta><article-meta>
<article-id pub-id-type="pmc">PMC1</article-id><article-id pub-id-type="doi">10/x</article-id><title-group><article-title>On <italic>H. pylori</italic></article-title></title-group>
<pub-date><year>2020</year></pub-date><abstract><sec><title>Aims</title><p>We  ask.</p></sec></abstract>
<kwd-group><title>Keywords</title><kwd>gut</kwd><kwd>liver</kwd></kwd-group><kwd-group xml:lang="fr"><kwd>foie</kwd></kwd-group><kwd-group><title>Abbreviations</title><kwd>HP</kwd></kwd-group></article-meta></front>
<body><p>Loose.</p><sec><title>1. Methods</title><p>Cut <table-wrap><p>hidden</p></table-wrap>here.</p><p>Loose.</p><sec><title>Strains</title><p>Helicobacter pylori grew.</p><p> </p></sec></sec><sec><title>Odd</title><notes><p>gone</p></notes><p>Last.</p></sec></body>
<back><ref-list><ref><label>1</label><element-citation><name><surname>Li</surname><given-names>A</given-names></name><article-title>T</article-title><source>S</source><year>2001</year><volume>7</volume><pub-id pub-id-type="pmid">99</pub-id></element-citation></ref></ref-list></back></article>"""


def test_articles_become_passages_and_are_annotated(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ARTICLE)
    (tmp_path / "b.xml").write_text("<article><front>")
    parts = articles.read_articles(spark, str(tmp_path))
    assert [r["file_name"] for r in parts.where("kind = 'error'").collect()] == ["b.xml"]
    terms = spark.createDataFrame([("methods section", "methods", 1), ("abstract", "abstract", 2)], "term string, name string, ord int")
    got = sorted(articles.article_passages(parts, terms).collect(), key=lambda r: r["passage_no"])
    texts = ["On H. pylori", "gut; liver", "We ask.", "Loose.", "Cut here.", "Helicobacter pylori grew.", "Last.", "1. Li A. T. S. 2001;7."]
    assert [r["text"] for r in got] == texts and [r["passage_no"] for r in got] == list(range(8))
    assert [r["offset"] for r in got] == [sum(len(x) + 1 for x in texts[:i]) for i in range(8)]
    assert got[0]["doc_id"] == "PMC1" and got[0]["doc_infons"] == {"pmcid": "PMC1", "doi": "10/x", "journal": "J", "pub_type": "research-article", "year": "2020"}
    assert got[5]["infons"] == {"section_title_1": "Methods", "section_title_2": "Strains", "term_1": "methods section", "term_id_1": "IAO:0000317"}
    assert got[2]["infons"] == {"section_title_1": "Abstract", "section_title_2": "Aims", "term_1": "abstract", "term_id_1": ""}
    assert got[6]["infons"] == {"section_title_1": "Odd", "term_1": "document part", "term_id_1": "IAO:0000314"}
    assert got[7]["infons"] == {"section_title_1": "References", "term_1": "references section", "term_id_1": "IAO:0000320", "journal": "S", "year": "2001", "volume": "7", "pmid": "99"}
    lexicon = spark.createDataFrame(LEXICON, "name string, tax_id string, kingdom string, rank string, ord int")
    m = annotate_passages(articles.article_passages(parts), lexicon).where("passage_no = 5").collect()
    assert [(r["text"], r["tax_id"], r["start"]) for r in m] == [("Helicobacter pylori", "T2", got[5]["offset"])]
