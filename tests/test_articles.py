"""Articles: all their parts, odd entities, terms with ids; fetching with a transport that fails."""

import json
import random
import sys
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import functions as F

from spanloom.operators import model
from spanloom.sources import articles, download, files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file

FRONT = "<front><article-meta><article-id pub-id-type='pmc'>PMC{0}</article-id><title-group><article-title>On {0}</article-title></title-group></article-meta></front>"
WHOLE = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//X//DTD" "x.dtd" [<!ENTITY own "declared">]>
<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><record><metadata><article xmlns="https://jats.nlm.nih.gov/ns/archiving/1.0/" article-type="research-article">""" + FRONT.format(7).replace("On 7", "Na&iuml;ve &own; &unknown; A&amp;B <![CDATA[&raw;]]>") + """
<body><p>First loose one.</p><p>Second loose.</p><sec><title>Results</title><p>In section.</p><boxed-text><p>Boxed in section.</p></boxed-text></sec><p>Lonely one.</p><sec><p>Untitled.</p></sec><p>short</p><boxed-text><p>In a box.</p></boxed-text></body>
<back><ack><title>Thanks</title><p>To all.</p><p>To more.</p><sec/><p>Not this.</p></ack><ack><p>No title here.</p></ack><fn-group><fn><p>A footnote.</p></fn></fn-group><fn-group><fn><p>Second group.</p></fn></fn-group>
<app-group><app><title>Appendix A</title><label>x</label><p>Appended.</p></app></app-group><notes><title>Data</title><p>On request.</p></notes><notes><p>Untitled note.</p></notes>
<funding-statement>Paid by <b>X</b>.</funding-statement><ref-list><ref><label>1</label><element-citation><source>S</source></element-citation></ref></ref-list></back></article></metadata></record></OAI-PMH>"""


def test_every_part_of_an_article(spark, tmp_path):
    (tmp_path / "a.xml").write_text(WHOLE)
    (tmp_path / "b.xml").write_text(f"<article>{FRONT.format(8)}</article>")
    (tmp_path / "c.xml").write_text("<article><body><p>x</p></body></article>")
    parts = articles.read_articles(spark, str(tmp_path))
    assert {(r["file_name"], r["text"]) for r in parts.where("kind = 'error'").collect()} == {("b.xml", "no body"), ("c.xml", "no front")}
    terms = spark.createDataFrame([("results section", "results", 1), ("acknowledgements section", "thanks", 2), ("disclosure section", "data", 3), ("highlights section", "untitled data", 4)], "term string, name string, ord int")
    rows = sorted(articles.article_passages(parts, terms).collect(), key=lambda r: r["passage_no"])
    got = [(r["infons"]["section_title_1"], r["text"]) for r in rows]
    assert got == [
        ("document title", "Naïve declared &unknown; A&B &raw;"), ("introduction", "First loose one."), ("introduction", "Second loose."), ("Results", "In section."), ("Results", "Boxed in section."),
        ("document part", "Lonely one."), ("document part", "Untitled."), ("document part", "In a box."), ("Thanks", "To all."), ("Thanks", "To more."), ("Acknowledgments", "No title here."),
        ("Funding Statement", "Paid by X."), ("Footnotes", "A footnote."), ("Appendix A", "Appended."), ("Data", "On request."), ("References", "1. S."),
    ]
    by = {r["text"]: r["infons"] for r in rows}
    assert (by["In section."]["term_1"], by["In section."]["term_id_1"]) == ("results section", "IAO:0000318")
    assert (by["To all."]["term_1"], by["To all."]["term_id_1"]) == ("acknowledgements section", "IAO:0000324")
    assert (by["Lonely one."]["term_1"], by["Lonely one."]["term_id_1"]) == ("document part", "IAO:0000314")
    assert rows[0]["doc_id"] == "PMC7" and rows[0]["doc_infons"]["pub_type"] == "research-article"


def test_terms_are_once_by_id(spark):
    terms = spark.createDataFrame([("disclosure section", "disclosure", 1), ("methods section", "methods", 2), ("highlights section", "highlights", 3)], "term string, name string, ord int")
    heads = spark.createDataFrame([("Disclosure and Methods & Highlights",), ("Nothing alike",), ("methods",)], "heading string")
    got = {r["heading"]: [tuple(x) for x in r["terms"]] for r in model.heading_terms(heads, terms, articles.TERM_IDS).collect()}
    assert got == {
        "Disclosure and Methods & Highlights": [("IAO:CUIless", "highlights section"), ("IAO:0000317", "methods section")], "Nothing alike": [("IAO:0000314", "document part")], "methods": [("IAO:0000317", "methods section")]
    }


def test_similar_pairs_are_all_pairs(spark):
    rng = random.Random(6)
    words = ["method", "methods", "result", "and", "discussion", "of", "data", "a", "aa", "é", "section"]
    make = lambda: " ".join(rng.choices(words, k=rng.randrange(1, 4)))
    worn = lambda s: "".join(c for c in s if rng.random() > 0.12)
    left, right = sorted({make() for _ in range(120)} | {"", "a"}), sorted({worn(make()) for _ in range(120)} | {"", "ab"})

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for least in (80, 60, 100):
        want = set()
        for a in left:
            for b in right:
                n = len(a) + len(b)
                r = 100 if n == 0 else int(200 * common(a, b) / n + 0.5)
                if r >= least:
                    want.add((a, b, r))
        got = model.similar_pairs(spark.createDataFrame([(x,) for x in [*left, None]], "a string"), spark.createDataFrame([(x,) for x in [*right, None]], "b string"), least)
        assert {tuple(r) for r in got.collect()} == want and len(want) > 5


def transport(folder):
    """Counts its requests in a folder; answers by the id."""

    def load():
        import uuid
        from pathlib import Path

        def get(one):
            before = sum(p.read_text() == one for p in Path(folder).iterdir())
            (Path(folder) / uuid.uuid4().hex).write_text(one)
            if one.startswith("E") and before < 1:
                raise ConnectionError("reset")
            if one.startswith("S") and before < 2:
                return 503, ""
            if one.startswith("N"):
                return 404, ""
            if one.startswith("Z"):
                return 429, ""
            return 200, {"X": "<article><front>", "Y": f"<article>{FRONT.format(one)}</article>"}.get(one[0]) or f"<article>{FRONT.format(one)}<body><p>Text of {one} é.</p></body></article>"

        return get

    return load


def test_download_retries_resumes_and_sets_aside(spark, tmp_path):
    calls, folder = tmp_path / "calls", str(tmp_path / "out")
    calls.mkdir()
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    run = lambda df: {r["id"]: (r["state"], r["status"], r["tries"]) for r in download.download(spark, df, folder, transport(str(calls)), lanes=2, pause=0.0, back_off=0.01).collect()}
    asked = lambda: sorted(p.read_text() for p in calls.iterdir())
    log = run(ids("A1", "A2", " A2 ", "", "E1", "S1", "N1", "X1", "Y1"))
    assert log == {"A1": ("fetched", 200, 1), "A2": ("fetched", 200, 1), "E1": ("fetched", 200, 2), "S1": ("fetched", 200, 3), "N1": ("failed", 404, 1), "X1": ("fetched", 200, 1), "Y1": ("fetched", 200, 1)}
    assert asked() == sorted(["A1", "A2", "E1", "E1", "S1", "S1", "S1", "N1", "X1", "Y1"])  # no request twice
    assert {p.name for p in (Path(folder) / "xml").iterdir()} == {f"{x}.xml" for x in ("A1", "A2", "E1", "S1", "X1", "Y1")}
    assert run(ids("A1", "B1")) == {"B1": ("fetched", 200, 1)}  # what is there isn't fetched again

    aside = {r["file_name"]: r["reason"] for r in download.convert(spark, folder).collect()}
    assert set(aside) == {"X1.xml", "Y1.xml"} and aside["Y1.xml"] == "no body"
    out = Path(folder) / "collections"
    assert {p.name for p in out.iterdir()} == {f"{x}_bioc.json" for x in ("A1", "A2", "E1", "S1", "B1")}
    assert [p["text"] for p in json.loads((out / "A1_bioc.json").read_text())["documents"][0]["passages"]] == ["On A1", "Text of A1 é."]
    assert files.passages(files.read_collections(spark, str(out))).count() == 10
    assert download.convert(spark, folder).count() == 0  # neither made again nor tried again

    log = download.download(spark, ids(*[f"Z{i}" for i in range(5)]), folder, transport(str(calls)), lanes=1, pause=0.0, back_off=0.0).collect()
    assert sorted(r["state"] for r in log) == ["failed"] + ["stopped"] * 4 and sum(r["tries"] for r in log) == 3
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/log").where(F.col("state") == "stopped").count() == 4
