"""Kept tables: only what is new is made, and a failed run changes nothing."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from spanloom.operators import candidates
from spanloom.sources import store

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file


def loader(folder):
    class Model:
        def embed(self, names):
            import pathlib
            import uuid

            (pathlib.Path(folder) / uuid.uuid4().hex).write_text("\n".join(names))
            return [[len(n), ord(n[0])] for n in names]

    return Model


def test_only_new_names_are_embedded(spark, tmp_path):
    calls, folder = tmp_path / "calls", str(tmp_path / "kept")
    calls.mkdir()

    def asked():
        out = sorted(x for p in calls.iterdir() for x in p.read_text().split("\n") if x)
        for p in calls.iterdir():
            p.unlink()
        return out

    names = lambda *x: spark.createDataFrame([(f"T{i}", n) for i, n in enumerate(x)], "id string, name string")
    run = lambda df, version="1": {(r["id"], r["name"]): r["dense"] for r in candidates.stored_vocabulary(spark, folder, df, loader(str(calls)), version).collect()}
    assert run(names("ab", "cde", "ab")) == {("T0", "ab"): [2, 97], ("T1", "cde"): [3, 99], ("T2", "ab"): [2, 97]}
    assert asked() == ["ab", "cde"]
    first = store.manifest(spark, folder)
    assert run(names("cde", "ab")) == {("T0", "cde"): [3, 99], ("T1", "ab"): [2, 97]} and asked() == []
    assert store.manifest(spark, folder) == first  # nothing was written
    assert len(run(names("ab", "x", "cde"))) == 3 and asked() == ["x"]
    assert len(run(names("x"), "2")) == 1 and asked() == ["x"]  # another model
    assert len(run(names("x", "y"), "2")) == 2 and asked() == ["y"]
    store.compact(spark, folder, names("y"), ["name"])
    assert [r["name"] for r in store.load(spark, folder).collect()] == ["y"] and len(store.manifest(spark, folder)["parts"]) == 1
    assert len(run(names("y", "x"), "2")) == 2 and asked() == ["x"]


def test_a_failed_run_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "kept")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    fine = lambda df: df.withColumn("n", F.coalesce(F.length("name"), F.lit(-1)))
    assert sorted(map(tuple, store.refresh(spark, folder, rows, ["name"], fine, "1").collect())) == [(1, "a", 1), (2, None, -1)]
    before = store.manifest(spark, folder)
    broken = lambda df: df.withColumn("n", F.coalesce(F.length("name"), F.lit(-1)) + F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        store.refresh(spark, folder, spark.createDataFrame([(3, "new")], "id int, name string"), ["name"], broken, "1")
    assert store.manifest(spark, folder) == before and store.load(spark, folder).count() == 2
    with pytest.raises(Exception, match="(?i)exist"):  # another run has taken the number
        store._commit(spark, folder, {"number": before["number"] - 1}, "1", store.StructType.fromJson(before["schema"]), [])


def test_a_layout_is_kept(spark, tmp_path):
    folder = str(tmp_path / "layout")
    with pytest.raises(ValueError):
        store.load(spark, folder)
    at = spark.createDataFrame([("a", 1.5, 2.0), ("b", 0.5, 1.0)], "tax_id string, angle double, radius double")
    store.save(spark, folder, at, ["tax_id"])
    store.save(spark, folder, at.where("tax_id = 'b'"), ["tax_id"])
    assert [tuple(r) for r in store.load(spark, folder).collect()] == [("b", 0.5, 1.0)]
