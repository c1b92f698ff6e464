"""Typos, corpora and orders of trees on small tables with the odd rows that big ones have."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import corpora, taxonomy, typos


@pytest.mark.parametrize("few", [typos.FEW, 0])
def test_typos(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(typos, "FEW", few)
    (tmp_path / "known").write_text("teh||the\n\nbadd||bad\nteh||THE\ngone\nnew york||x\n")
    known = typos.read_typos(spark, str(tmp_path / "known"))
    assert {tuple(r) for r in known.collect()} == {("teh", "THE"), ("badd", "bad"), ("gone", ""), ("new york", "x")}
    rows = [(1, "teh  badd\tteh."), (2, "gone teh gone badd"), (3, None), (4, ""), (1, "teh  badd\tteh."), (5, "fine"), (6, "Teh-badd, teh")]
    df = spark.createDataFrame(rows, "id int, name string").withColumn("typo", F.lit("kept"))
    plain = {"teh": "THE", "badd": "bad", "gone": ""}
    fixed = lambda s: None if s is None else " ".join(plain.get(w, w) for w in s.split()).strip()
    got = typos.correct(df, known, "name")
    assert got.columns == ["id", "name", "typo"] and sorted(map(tuple, got.collect()), key=str) == sorted([(i, fixed(s), "kept") for i, s in rows], key=str)
    made = {r["id"]: r["name"] for r in typos.preprocess(df, "name", known, ignore="-").collect()}
    assert made == {1: "THE bad teh", 2: "THE bad", 3: None, 4: "", 5: "fine", 6: "teh-badd THE"}


def test_preprocess_flags(spark):
    df = spark.createDataFrame([("  A-b, [c]\\d^e  ",)], "s string")
    got = df.select(tx.text_preprocess(F.col("s")), tx.text_preprocess(F.col("s"), ignore="-^"), tx.text_preprocess(F.col("s"), False, False), tx.text_preprocess(F.col("s"), ignore="[]\\")).first()
    assert tuple(got) == ("a b c d e", "a-b c d^e", "A-b, [c]\\d^e", "a b [c]\\d e")


TREE = [("g1", "s"), ("g2", "s"), ("a", "g1"), ("b", "g1"), ("c", "g2"), ("x", "lost")]
RANKS = {"s": "family", "g1": "genus", "g2": "genus", "a": "species", "b": "species", "c": "species", "x": None}


def test_corpora_with_odd_rows(spark):
    nodes = spark.createDataFrame(list(RANKS.items()), "tax_id string, rank string")
    edges = spark.createDataFrame(TREE, "child string, parent string")
    ids = [("one", "a")] * 4 + [("one", "c"), ("one", "nowhere"), ("two", "x"), ("two", None), (None, "a"), ("three", "nowhere")]
    loaded = corpora.load_corpora(nodes, edges, spark.createDataFrame(ids, "corpus string, tax_id string"), ["species", "genus", "family"])
    got = {(r["corpus"], r["tax_id"]): (r["rank"], r["n"], r["abundance"]) for r in loaded.collect()}
    assert got == {
        ("one", "a"): ("species", 4, 4), ("one", "c"): ("species", 1, 1), ("one", "g1"): ("genus", 0, 2), ("one", "g2"): ("genus", 0, 1), ("one", "s"): ("family", 0, 1.5),
        ("two", "x"): ("no rank", 1, 1), ("two", "lost"): ("no rank", 0, 0),
    }
    q = {(r["corpus"], r["tax_id"]): r["quartile"] for r in corpora.quartiles(loaded).collect()}
    assert q == {("one", "a"): 4, ("one", "c"): 1, ("one", "g1"): 3, ("one", "g2"): 1, ("one", "s"): 2, ("two", "x"): 2, ("two", "lost"): 1}
    master = spark.createDataFrame([("a", 0.5, 3.0), ("g2", 2.0, 2.0)], "tax_id string, angle double, radius double")
    at = {(r["corpus"], r["tax_id"]): (r["angle"], r["radius"]) for r in corpora.placed(loaded, edges, master, spark.createDataFrame([("c", 3.0)], "tax_id string, radius double")).collect()}
    assert at["one", "a"] == (0.5, 3.0) and at["one", "c"] == (pytest.approx(2.1), 3.0) and at["two", "x"] == (None, None) and len(at) == len(got)
    named = lambda **k: [(r["corpus"], r["tax_id"], r["place"]) for r in corpora.labels(loaded, **k).orderBy("corpus", "place").collect()]
    assert named() == [("one", "a", 1), ("one", "g1", 2), ("two", "x", 1)]
    assert named(top=1, least=1.0) == [("one", "a", 1), ("two", "x", 1)] and named(least=3.0) == [("one", "a", 1)]
    assert corpora.quartiles(loaded.limit(0)).count() == 0


def test_preorder_is_the_sorted_paths(spark):
    rng = random.Random(8)
    parent = {f"n{i:03d}": (f"n{rng.randrange(max(0, i - 6), i):03d}" if i and rng.random() < 0.9 else "root") for i in range(150)}
    names = dict(zip(parent, rng.sample(sorted(parent), len(parent))))  # names in no order
    parent = {names[k]: names.get(p, "root") for k, p in parent.items()}

    def path(n):
        return [*path(parent[n]), n] if parent[n] != "root" else [n]

    order = sorted(parent, key=path)
    leaves = [n for n in order if n not in set(parent.values())]
    got = taxonomy.depth_first(spark.createDataFrame(list(parent.items()), "tax_id string, parent string")).collect()
    assert {r["tax_id"]: (r["level"], r["dfs_order"], r["leaf_order"]) for r in got} == {n: (len(path(n)), order.index(n), leaves.index(n) if n in leaves else None) for n in parent}


def test_angle_groups(spark):
    rng = random.Random(9)
    rows = [(f"t{i}", rng.choice([rng.uniform(0, 6.28), round(rng.uniform(0, 6), 1)])) for i in range(25)] + [("u", 1.0), ("v", 1.0)]
    want, grp, place, before = {}, 0, 0, None
    for t, a in sorted(rows, key=lambda r: (r[1], r[0])):
        if before is None or a - before >= 0.4:
            grp, place = grp + 1, 0
        place += 1
        want[t] = (grp, place)
        before = a
    got = taxonomy.angle_groups(spark.createDataFrame(rows, "tax_id string, angle double")).collect()
    assert {r["tax_id"]: (r["grp"], r["place"]) for r in got} == want
