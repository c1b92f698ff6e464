"""Decontamination, conversation repair and the Merkle manifest against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from spanloom.llm import contamination, conversations, merkle

SHA = lambda x: hashlib.sha256(x.encode()).hexdigest()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df, *names):
    return df.withColumns({c: F.lit("other") for c in names})


# ------------------------------------------------------------------ decontamination
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return [] if text is None else WORD.findall("".join(c.lower() if c.isascii() else c for c in text))


def leaks(text, bench, window=10):
    own, hit, items = words(text), set(), set()
    for item, t in bench:
        w = words(t)
        for i in range(max(1, len(w) - window + 1)) if w else []:
            win = w[i : i + window]
            for j in range(len(own) - len(win) + 1):
                if own[j : j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    items.add("" if item is None else str(item))
    return len(own), len(hit), sorted(items)


def _leak_tables():
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "é", "naïve", "x9", "Ünder", "the", "of", "漢字", "q"]
    bench = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([3, 9, 10, 11, 14, 15, 27, 40, 12, 1])]
    bench += [(20, "the " * 30), (21, None), (22, " .. "), (6, "alpha of é"), (None, "null item words"), (30, bench[7][1])]
    docs = [(0, None), (1, ""), (2, " \t"), (3, "the " * 50), (4, "ALPHA, of-É alpha OF é"), (5, "alpha beta " * 400 + bench[7][1].upper() + " end"), (6, bench[6][1]), (6, bench[6][1]), (None, "null-item (words)!")]
    for i in range(60):
        a, b = rng.choice(bench[:9]), rng.choice(bench[:9])
        cut = rng.randrange(0, 8)
        docs.append((100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 30))) + "; " + " ".join(a[1].split()[cut:]) + " -- " + " ".join(b[1].split()[: 14 - cut])))
    return docs, bench


@pytest.mark.parametrize("part_bytes", [contamination.PART_BYTES, 120])
def test_contamination_is_brute_force(spark, part_bytes):
    docs, bench = _leak_tables()
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string"), "row", "spans", "items", "norm", "id", "n_words")
    b = clashing(spark.createDataFrame(bench, "item_id long, text string"), "row", "norm", "id")
    got = contamination.contamination(spark, d, b, part_bytes=part_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == Counter((i, *leaks(t, bench)[:2], tuple(leaks(t, bench)[2])) for i, t in docs)
    texts = {i: t for i, t in docs}
    for r in got:
        said = words(texts[r.doc_id])
        for s in r.spans:  # places in the original are places of the same words
            assert words(texts[r.doc_id][s.start : s.end]) == said[s.first : s.last]


def test_contamination_edges(spark):
    none, item = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination.contamination(spark, none, item).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r.n_hit for r in contamination.contamination(spark, one, item.limit(0)).collect()] == [0]
    long = "w" + " w".join(str(i) for i in range(300_000))
    big = spark.createDataFrame([(1, long), (2, long + " A. b")], "doc_id long, text string")
    assert sorted(r.n_hit for r in contamination.contamination(spark, big, item).collect()) == [0, 2]


def test_decontaminated(spark):
    rows = [(1, "keep A, b keep", "x"), (1, "other text", "x"), (2, None, "y"), (3, "a b", "z"), (None, "é a b", "n"), (None, "é a b", "n")]
    item = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = contamination.decontaminated(spark, spark.createDataFrame(rows, "doc_id long, text string, spans string"), item)
    assert got.columns == ["doc_id", "text", "spans"]
    assert Counter(map(tuple, got.collect())) == Counter([(1, "keep keep", "x"), (1, "other text", "x"), (2, None, "y"), (3, "", "z"), (None, "é", "n"), (None, "é", "n")])


# ------------------------------------------------------------------ conversation repair
def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edits of a short conversation, tried one by one."""
    marks, best = faults(rows), None
    for letters in itertools.product("DKR", repeat=len(rows)):
        if any(x != "D" and m in ("blank", "duplicate") for x, m in zip(letters, marks)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            renamed = letters.count("R")
            inserted = sum(gaps)
            if renamed + inserted > 9:
                continue
            for roles in itertools.product(("user", "assistant"), repeat=renamed + inserted):
                it, out, audit = iter(roles), [], ""
                for i, n in enumerate(gaps):
                    out += [(next(it), "") for _ in range(n)]
                    audit += "I" * n
                    if i < len(rows):
                        audit += letters[i]
                        if letters[i] != "D":
                            out.append((next(it) if letters[i] == "R" else rows[i][1], rows[i][2]))
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)) and all(r for r, _ in out):
                    cost = 3 * letters.count("D") + 2 * (renamed + inserted) + sum(x != "D" and m == "truncated" for x, m in zip(letters, marks))
                    best = min(best or (cost + 1, "", ""), (cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
    return best


def _segments(turns, size):
    con = duckdb.connect()
    cut = [turns[i : i + size] for i in range(0, len(turns), size)]
    solved = conversations.solve(con, [(c, c == 0, len(x)) for c, x in enumerate(cut)], [(c, i, *t) for c, x in enumerate(cut) for i, t in enumerate(x)])
    return conversations.join_segments([r[1:] for r in solved if r[0] == c] for c in range(len(cut)))


CODES = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}


def test_least_edits_are_brute_force():
    rng = random.Random(11)
    for _ in range(40):
        rows = [(i, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "User"]), rng.choice(["Fine.", "Fine?", "Cut", " ", "More!"])) for i in range(rng.randrange(1, 4))]
        cost, audit, _ = cheapest(rows)
        turns = [(r[:1], CODES[m]) for (_, r, _), m in zip(rows, faults(rows))]
        assert _segments(turns, 99) == _segments(turns, 1) == (cost, audit), rows


def test_segments_of_any_size_agree():
    rng = random.Random(12)
    for _ in range(20):
        turns = [(rng.choice("suatuaua"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 60))]
        assert len({_segments(turns, size) for size in (1, 2, 3, 7, 64)}) == 1


def test_repair(spark):
    turns = [
        (1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (2, None, "user", None), (2, 5, "user", "Same."), (2, 5, "user", "Same."), (2, 9, "assistant", "cut"),
        (None, 1, None, "No role."), (None, None, "assistant", "é" * 100_000 + "."), (3, 1, "", "Empty role."), (3, 2, "assistant", "B."), (4, 7, "user", "\t "),
    ]
    df = clashing(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), "grp", "idx", "n", "digest", "pos", "kind")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,), (1,)], "conv_id long")
    for segment in (conversations.SEGMENT, 2):
        rows = conversations.repair(spark, df, ids, segment).collect()
        got = {}
        for r in rows:
            x = got.setdefault(r.grp, [[], None])
            if r.edit is None:
                x[1] = r.summary
            elif r.edit != "D":
                x[0].append(f"{r.role}:{r.text}")
        assert set(got) == {"=1", "=2", "=3", "=4", "=5", "-"}
        for key in ("=1", "=2", "=4", "-"):
            own = sorted([(-1 if t is None else t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if key == ("-" if c is None else f"={c}")])
            cost, audit, text = cheapest(own)
            s, marks, inits = got[key][1], Counter(faults(own)), [r[:1] for _, r, _ in own]
            numbers = [t for t, _, _ in own if t >= 0]
            assert (s.cost, s.audit, "\n".join(got[key][0])) == (cost, audit, text)
            assert (s.blank, s.duplicate, s.truncated) == (marks["blank"], marks["duplicate"], marks["truncated"])
            assert s.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(inits, inits[1:]))
            assert s.gaps == (numbers[-1] - numbers[0] + 1 - len(set(numbers)) if numbers else 0)
        assert got["=3"][1].audit in ("DIK", "RK") and got["=3"][1].cost == 2
        assert tuple(got["=5"][1]) == (0, 0, 0, 0, 0, 0, "") and got["=5"][0] == []
    assert conversations.repair(spark, df.limit(0), ids.limit(0)).count() == 0


def test_damage(spark):
    turns = [(c, t, "assistant", "One. Two!") for c in (1, 2, None) for t in (*range(40), None)]
    got = Counter(map(tuple, conversations.damaged(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()))
    want = Counter()
    for c, t, role, text in turns:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            want[c, t, "user" if kind == 4 else role, "" if kind == 1 else "One Two" if kind == 2 else text] += 2 if kind == 3 else 1
    assert got == want


# ------------------------------------------------------------------ the Merkle manifest
def leaf(doc, text, lang, source, n):
    return SHA("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([SHA("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append(("U",) if j >= len(level) else ("L" if i & 1 else "R", level[j]))
        i >>= 1
    return "".join("".join(x) for x in out)


def manifest_rows():
    rng = random.Random(3)
    rows = [(i, f"text {i} é", "en", "a", i) for i in rng.sample(range(1000), 37)] + [(5000 + i, None if i % 2 else "", "fr", None, None) for i in range(9)]
    return [*rows, (7, "only", "de", "b", 4), (None, "null id", None, "b", 7), (3, "tie", None, "b", 3), (3, "tie", None, "b", 3), (3, "other tie", None, "b", 9), (9, "x" * 200_000, "", "c", 1), (8, "q", "zz", "c", 1), (8, "q", "zz", "c", 1)]


@pytest.mark.parametrize("step", [1, 2, merkle.STEP])
def test_manifest_is_brute_force(spark, step):
    rows = manifest_rows()
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for g in langs}
    trees = {g: tree([leaf(*r) for r in own]) for g, own in groups.items()}
    top = tree([trees[g][-1][0] for g in langs])
    want = Counter()
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            want[r[0], trees[g][0][i], proof(trees[g], i) + proof(top, k), trees[g][-1][0], top[-1][0]] += 1
    df = clashing(spark.createDataFrame(rows, DOCS), "grp", "idx", "n", "hash", "level", "key", "other", "proof", "root")
    got = merkle.manifest(spark, df, step=step).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    for r in got:
        assert merkle.fold(r.leaf, r.proof) == r.root and merkle.fold(SHA("forged"), r.proof) != r.root or r.proof == ""


def test_manifest_of_few_rows(spark):
    df = spark.createDataFrame([(1, "t", "en", "a", 1)], DOCS)
    assert merkle.manifest(spark, df.limit(0)).count() == 0
    (only,) = merkle.manifest(spark, df).collect()
    assert only.leaf == only.subroot == only.root and only.proof == ""
