"""A rule model over collections against a plain program, and files that are written whole or not at all."""

import json
import random
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_boundaries import model as settled

from spanloom.operators import annotate, model_annotator
from spanloom.sources import files, sink

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file
NAMES = ["Helicobacter", "Bacillus", "E.", "Proteus"]
NEXT = ["pylori", "coli", "cereus", "sp"]


def labels(window):
    """1 begins, 2 goes on, 0 is outside."""
    out = []
    for i, w in enumerate(window):
        out.append(1 if w.rstrip(".") in ("Helicobacter", "Bacillus", "Proteus", "E") else 2 if i and out[-1] and (w in NEXT or w == ".") else 0)
    return out


class Rule:
    def predict(self, windows):
        return [labels(w) for w in windows]


def plain(text, size, stride, agreement):
    text = text.replace("\n", " ")
    pieces, found, starts = model_annotator.text_pieces(text), {}, []
    n = len(pieces)
    at = 0
    while pieces and (at == 0 or at < n - stride):
        starts.append(at)
        part, begun = pieces[at : at + size], None
        for i, x in enumerate(labels([p[0] for p in part])):
            if x == 1:
                begun = i
            elif x == 0 and begun is not None:
                found.setdefault((at + begun, at + i), set()).add(at)
                begun = None
        at += size - stride
    votes = [(a, b) for (a, b), w in found.items() if len(w) >= agreement * sum(s <= a and b <= s + size for s in starts)]
    spans = {(pieces[a][1], pieces[b - 1][2]) for a, b in votes if pieces[a][1]}
    made = {m for a, b in spans if (m := settled(text, a, b - a, False)) is not None and m[0]}
    kept, out = [], []
    for e, o, k in sorted(made, key=lambda m: (m[1], -m[2], m[0])):
        if not any(o >= b and o + k <= b + j for _, b, j in kept):
            kept.append((e, o, k))
    for e, o, k in kept:
        if out and o <= out[-1][1] + out[-1][2]:
            b, end = out[-1][1], max(o + k, out[-1][1] + out[-1][2])
            out[-1] = (text[b:end].strip(), b, end - b)
        else:
            out.append((e, o, k))
    return out


def collection(rng, i):
    word = lambda: rng.choice([*NAMES, *NEXT, "grew", "in", "the", "(gut)", "and", "E.coli", "Bacillus-like"])
    text = lambda n: " ".join(word() + rng.choice(["", "", ",", "\n"]) for _ in range(n))
    old = [{"id": "9", "text": "x", "infons": {}, "locations": [{"offset": 0, "length": 1}]}]
    rows = [{"offset": 1000 * k, "infons": {"section": "é"}, "text": text(rng.choice([0, 3, 40, 90])), "annotations": old} for k in range(4)]
    return {"source": "s", "date": "d", "key": "k", "infons": {}, "documents": [{"id": f"D{i}", "infons": {}, "passages": rows}, {"id": f"D{i}", "infons": {}, "passages": rows[:1]}]}


@pytest.mark.parametrize("size,stride,agreement", [(512, 50, 0.0), (11, 4, 0.0), (11, 4, 1.0), (5, 0, 0.6)])
def test_folder_to_folder(spark, tmp_path, size, stride, agreement):
    rng, src, out = random.Random(size + stride), tmp_path / "in", tmp_path / "out"
    src.mkdir()
    whole = {f"f{i}_bioc.json": collection(rng, i) for i in range(5)}
    for name, d in whole.items():
        (src / name).write_text(json.dumps(d))
    lexicon = spark.createDataFrame([("bacillus cereus", "T1", 1), ("Helicobacter pylori", "T2", 2)], "name string, tax_id string, ord int")
    link = lambda m: annotate.normalise_exact(m.withColumnRenamed("text", "mention"), lexicon).withColumnRenamed("mention", "text")
    run = lambda: model_annotator.annotate_collections_by_model(spark, str(src), str(out), Rule, link, at=datetime(2020, 1, 2), size=size, stride=stride, agreement=agreement)
    run()
    assert {p.name for p in out.iterdir()} == set(whole)
    n = 0
    for name, d in whole.items():
        text = (out / name).read_text()
        got = json.loads(text)
        assert "é" in text and text.startswith('{\n  "')
        k = 0
        for doc, want in zip(got["documents"], d["documents"], strict=True):
            for p, q in zip(doc["passages"], want["passages"], strict=True):
                assert (p["text"], p["offset"], p["infons"]) == (q["text"], q["offset"], q["infons"])
                notes = []
                for e, o, length in plain(q["text"], size, stride, agreement):
                    k += 1
                    ids = {"bacillus cereus": "T1", "helicobacter pylori": "T2"}
                    notes.append({"id": str(k), "text": e, "infons": {"type": "microbiome", "identifier": ids.get(e.lower(), ""), "annotator": "spanloom", "updated_at": "2020-01-02T00:00:00Z"}, "locations": [{"offset": o + q["offset"], "length": length}]})
                assert p["annotations"] == notes
        n += k
    assert n > 20
    # what is there stays; what is missing is made again
    before = {p.name: p.stat().st_mtime_ns for p in out.iterdir()}
    text = (out / "f2_bioc.json").read_text()
    (out / "f2_bioc.json").unlink()
    run()
    after = {p.name: p.stat().st_mtime_ns for p in out.iterdir()}
    assert (out / "f2_bioc.json").read_text() == text and all(after[x] == before[x] for x in before if x != "f2_bioc.json")
    assert files.read_collections(spark, str(out)).count() == 5  # its own output can be read
    run()
    assert {p.name: p.stat().st_mtime_ns for p in out.iterdir()} == after


def test_vote_of_windows(spark):
    rows = spark.createDataFrame([("f", 0, 0, "x a Bee c d e f g")], "file_name string, doc_no int, passage_no int, text string")

    class Left:
        def predict(self, windows):
            return [[1 if p == "Bee" and i == 2 else 0 for i, p in enumerate(w)] for w in windows]

    take = lambda share: [r["text"] for r in model_annotator.model_mentions(rows, Left, size=5, stride=3, agreement=share).collect()]
    assert take(0.5) == ["Bee"] and take(0.6) == []
    with pytest.raises(ValueError):
        model_annotator.labelled_windows(rows, Left, size=5, stride=5)


def test_files_are_whole_or_not_there(spark, tmp_path):
    out = tmp_path / "new" / "out"
    rows = spark.createDataFrame([(f"a{i}.json", json.dumps({"n": i, "é": "ü"})) for i in range(20)], "file_name string, json string").repartition(5)
    sink.write_collections(rows, str(out))
    assert {p.name for p in out.iterdir()} == {f"a{i}.json" for i in range(20)}
    assert (out / "a7.json").read_text() == json.dumps({"n": 7, "é": "ü"}, indent=4)
    bad = rows.where("file_name = 'a7.json'").select("file_name", F.lit('{"n": 70}').alias("json"))
    fails = bad.unionByName(spark.createDataFrame([("b.json", "no json")], "file_name string, json string"))
    with pytest.raises(Exception, match="Expecting value"):
        sink.write_collections(fails, str(out))
    assert {p.name for p in Path(out).iterdir()} == {f"a{i}.json" for i in range(20)} and json.loads((out / "a7.json").read_text())["n"] == 7
    with pytest.raises(Exception, match="several rows"):
        sink.write_collections(bad.unionByName(bad), str(out))
    with pytest.raises(Exception, match="not a file name"):
        sink.write_collections(bad.select(F.lit("../x").alias("file_name"), "json"), str(out))
    sink.write_collections(bad, str(out), indent=None)
    assert (out / "a7.json").read_text() == '{"n": 70}' and len(list(out.iterdir())) == 20
    assert sink.finished(spark, str(tmp_path / "none"), "*").count() == 0
