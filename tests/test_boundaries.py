"""The steps after a span model, against a plain model of each."""

import random
import re

from pyspark.sql import functions as F

from spanloom.operators import boundaries

SPECIES = ("sp", "sp.", "spp", "spp.")


def at_words(text, m):
    e, o, n = m
    a, b = o, o + n
    while a < len(text) and text[a].isspace():
        a += 1
    while b > 0 and text[b - 1].isspace():
        b -= 1
    if b < len(text) and a <= b:
        while a > 0 and text[a - 1].isalpha():
            a -= 1
        while b < len(text) and text[b].isalpha():
            b += 1
    return m if (a, b) == (o, o + n) else (text[a:b], a, b - a)


def full_abbreviations(text, m):
    e, o, n = m
    if len(e) not in (1, 2):
        return m
    here = text[o:].split()
    if not here or len(here[0]) != 2:
        return None
    if here[0][0].isalpha() and here[0][1] == "." and len(here) > 1:
        e = here[0] + " " + here[1][: sum(c.isalpha() for c in here[1])]
        return e, o, len(e)
    return m


def cut_long(text, m, repair):
    e, o, n = m
    w = e.split()
    if len(w) < 3 or w[2] in SPECIES:
        return m
    pair, rest, to = " ".join(w[:2]), " ".join(w[1:]), o
    initial = lambda x: len(x) > 1 and x[0].isalpha() and x[1] == "."
    dotted = lambda x: len(x) > 1 and x[0].isalpha() and x[-1] == "."
    if initial(w[0]):
        e, to, n = (pair, to, len(pair)) if repair else (pair, len(pair), n)
    for holds, first in ((initial(w[1]), False), (dotted(w[0]), True), (dotted(w[1]), False), (w[1] in SPECIES, True), (w[0][0].isupper() and w[1][0].islower(), True), (w[0][0].islower() and w[1][0].isupper(), False)):
        if holds:
            e, n, to = (pair, len(pair), to) if first else (rest, len(rest), (o if repair else to) + len(w[0]) + 1)
    return e, to, n


def with_species_word(text, m):
    e, o, n = m
    own, here = e.split(), text[o:].split()
    k = len(own)
    if k and k < len(here) and here[k] in SPECIES and (k == 1 or here[k - 1] == own[-1]):
        e = " ".join(here[: k + 1])
        return e, o, len(e)
    return m


def model(text, o, n, repair):
    m = (text[o : o + n], o, n)
    for step in (at_words, full_abbreviations, lambda t, x: cut_long(t, x, repair), with_species_word):
        if m is not None:
            m = step(text, m)
    return m


PIECES = ["Helico", "bacter", "pylori", "E.", "e.", "X", "coli", "sp", "sp.", "spp.", "Genus", "ß", "Éa", "é", "a1", "1", "A.b.", "Sp.", ",", ".", "strain", "b."]


def random_text(rng):
    return "".join(rng.choice(PIECES) + rng.choice([" ", " ", " ", "  ", "", "\t", " "]) for _ in range(rng.randrange(1, 14)))


def test_steps_are_the_plain_model(spark):
    rng, rows = random.Random(1), []
    while len(rows) < 10_000:
        text = random_text(rng)
        o = rng.randrange(0, len(text))
        n = rng.randrange(1, min(30, len(text) - o) + 1)
        if text[o : o + n].strip():
            rows.append((len(rows), text, o, n))
    df = spark.createDataFrame(rows, "i long, p string, o long, n long").repartition(4)
    for repair in (False, True):
        made = df.select("i", boundaries.settled(F.col("p"), F.substring("p", F.col("o") + 1, F.col("n")), F.col("o"), F.col("n"), repair).alias("m"))
        got = {r["i"]: None if r["m"]["text"] is None else tuple(r["m"]) for r in made.collect()}
        assert not [(x, got[x[0]], model(x[1], x[2], x[3], repair)) for x in rows if got[x[0]] != model(x[1], x[2], x[3], repair)][:3]


def test_settle_is_the_plain_model(spark):
    rng, docs, found = random.Random(2), [], []
    for i in range(300):
        text = "".join(random_text(rng) for _ in range(3))
        docs.append((i, text))
        for _ in range(rng.randrange(0, 6)):
            o = rng.randrange(0, len(text))
            n = rng.randrange(1, min(25, len(text) - o) + 1)
            if text[o : o + n].strip():
                found += [(i, o, n)] * rng.choice([1, 1, 2])
    docs += [(1000, None), (1001, "")]
    got = boundaries.settle(spark.createDataFrame([*found, (1000, 1, 3), (1001, 0, 0)], "doc_id long, start long, length long"), spark.createDataFrame(docs, "doc_id long, text string"), True)
    want = set()
    for i, text in docs[:300]:
        made = {m for d, o, n in found if d == i and (m := model(text, o, n, True)) is not None and m[0] and m[2] > 0}
        kept, out = [], []
        for e, o, n in sorted(made, key=lambda m: (m[1], -m[2], m[0])):
            if not any(o >= b and o + n <= b + k for _, b, k in kept):
                kept.append((e, o, n))
        for e, o, n in kept:
            if out and o <= out[-1][1] + out[-1][2]:
                b = out[-1][1]
                end = max(o + n, b + out[-1][2])
                out[-1] = (text[b:end].strip(), b, end - b)
            else:
                out.append((e, o, n))
        want |= {(i, o, n, e) for e, o, n in out}
    assert {tuple(r) for r in got.select("doc_id", "start", "length", "text").collect()} == want


def test_plan_grows_by_one_step(spark):
    df = spark.createDataFrame([("a b c", 0, 3)], "p string, o long, n long")
    sizes = []
    for steps in (1, 2, 3):
        m = boundaries._mention(F.col("p"), F.col("o"), F.col("n"))
        for _ in range(steps):
            m = boundaries.let(m, lambda x: boundaries.at_words(F.col("p"), x))
        sizes.append(len(re.sub("#\\d+|_\\d+", "", df.select(m.alias("m"))._jdf.queryExecution().optimizedPlan().toString())))
    assert sizes[2] - sizes[1] < 1.3 * (sizes[1] - sizes[0])
