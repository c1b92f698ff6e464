"""Candidates of names against all pairs."""

import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import candidates


def plain_vectors(names, vocabulary):
    grams = lambda s: list(s) + [s[i : i + 2] for i in range(len(s) - 1)]
    df = Counter(t for s in vocabulary for t in set(grams(s)))
    idf = {t: math.log((1 + len(vocabulary)) / (1 + n)) + 1 for t, n in df.items()}
    out = []
    for s in names:
        v = {t: n * idf[t] for t, n in Counter(grams(s)).items() if t in idf}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        out.append({t: x / size for t, x in v.items()})
    return out


@pytest.mark.parametrize("weight,spread", [(1.0, 0.05), (0.0, 0.05), (2.5, 5.0)])
def test_top_candidates_are_all_pairs(spark, monkeypatch, weight, spread):
    """Small cells and blocks, clustered vectors: exact, and most rows are never scored where clusters are tight."""
    for name, size in (("CELL_ROWS", 16), ("CELL_BLOCK", 8), ("QUERY_BLOCK", 7), ("PIVOTS", 40)):
        monkeypatch.setattr(candidates, name, size)
    rng, r = np.random.default_rng(4), random.Random(4)
    middle = rng.normal(size=(12, 6)) * 3
    parts = ["bac", "hel", "pyl", "ori", "col", "i", "pro", "teus", "é", "x"]
    rows = [(i, "".join(r.choices(parts, k=r.randrange(1, 5))), (middle[i % 12] + spread * rng.normal(size=6)).tolist()) for i in range(600)]
    rows += [(1000 + i, *rows[i][1:]) for i in range(5)]  # ties
    vocabulary = spark.createDataFrame(rows, "id long, name string, dense array<double>")
    encoder = candidates.fit(vocabulary)
    asked = [(i, rows[i * 7][1] + "q", (np.array(rows[i * 7][2]) + 0.01).tolist()) for i in range(40)] + [(99, "", [0.0] * 6), (98, "zzz", middle[3].tolist())]
    queries = candidates.encode(spark.createDataFrame(asked, "query_id long, name string, dense array<double>"), encoder, "query_id")
    got = candidates.top_candidates(spark, candidates.encode(vocabulary, encoder), queries, 4, weight).collect()
    own, other = plain_vectors([x[1] for x in asked], [x[1] for x in rows]), plain_vectors([x[1] for x in rows], [x[1] for x in rows])
    want = {}
    for (q, _, d), s in zip(asked, own):
        scores = [(round(weight * sum(w * v.get(t, 0) for t, w in s.items()) + float(np.dot(d, e)), 9), i) for (i, _, e), v in zip(rows, other)]
        want[q] = [(i, x) for x, i in sorted(scores, key=lambda y: (-y[0], y[1]))[:4]]
    found = {}
    for x in sorted(got, key=lambda x: x["rank"]):
        found.setdefault(x["query_id"], []).append((x["id"], pytest.approx(x["score"], abs=2e-9)))
    assert want == found
    if spread < 1 and weight == 1:
        assert np.mean([x["compared"] for x in got if x["query_id"] not in (98, 99)]) < 0.35 * len(rows)


def test_names_to_candidates(spark, tmp_path):
    vocabulary = spark.createDataFrame([("T1", "helicobacter pylori"), ("T2", "bacillus cereus"), ("T3", "proteus mirabilis")], "id string, name string").withColumn("dense", F.array().cast("array<double>"))
    encoder = candidates.fit(vocabulary)
    names = spark.createDataFrame([("Helicobacter-Pylori",), ("B. cereus",), ("B. cereus",), (None,)], "mention string")
    found = candidates.link_names(spark, names, candidates.encode(vocabulary, encoder), encoder, k=2)
    got = {r["mention"]: [list(x.items())[0] for x in json.loads(r["candidates"])] for r in candidates.candidates_json(found).collect()}
    assert set(got) == {"Helicobacter-Pylori", "B. cereus"} and all(len(x) == 2 for x in got.values())
    assert got["Helicobacter-Pylori"][0] == ("T1", "helicobacter pylori") and got["B. cereus"][0] == ("T2", "bacillus cereus")
    candidates.save_candidates(found, str(tmp_path / "kept"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "kept")).collect()]
    assert {x["mention"]: [list(c.items())[0] for c in x["candidates"]] for x in lines} == got
    assert candidates.link_names(spark, names.limit(0), candidates.encode(vocabulary, encoder), encoder).count() == 0
