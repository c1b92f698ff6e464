"""Quality rules as weak supervision.

Each rule votes bad (-1) or good (+1), or abstains (0). Expectation-maximisation over the counts of vote
patterns estimates every rule's accuracy (how often its votes are right) and the share of good
documents; a document is kept if its posterior probability of being good reaches a half, rather
than if it passes all rules. A rule fires or not, so patterns number at most 2 ** rules however many documents there are, so
the driver sees a bounded table. The second pass measures each text again rather than shuffle it.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import as_bytes, table

RULES = (
    "length", "symbols", "dup_lines", "repeats", "capitals", "word_length", "marks", "stutter",
    "many_symbols", "mostly_repeats", "mostly_capitals", "mostly_marks", "mostly_dup_lines",
    "prose", "long",
)
#: The last GOOD rules speak for a document, and only weakly; the others speak against it, the SEVERE ones
#: before these strongly.
GOOD, SEVERE = 2, 5
MIN_WORDS = 50
#: Accuracies start at ACCURACY with PRIOR pseudo-votes, so that a few documents don't swing them, and stay
#: within BOUNDS: better than chance, and never beyond doubt.
ACCURACY, PRIOR, BOUNDS = (0.85, 0.97, 0.55), 20.0, ((0.6, 0.98), (0.95, 0.99), (0.51, 0.58))
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(text: str | None) -> tuple[list[int], list[int]]:
    """The contract's five counts, and the votes. Null and empty texts measure as no words."""
    raw = as_bytes(text)
    text = text or ""
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        grams = Counter(zip(words, words[1:], words[2:]))
        if len(grams) < n - 2:
            twice = np.fromiter((grams[g] > 1 for g in zip(words, words[1:], words[2:])), bool, n - 2)
            covered = np.zeros(n, bool)
            for i in range(3):
                covered[i : i + n - 2] |= twice
            repeat = int(covered.sum())
    upper = sum(map(str.isupper, words_text)) if (words_text := text.split()) else 0
    bangs = raw.count(b"!") + raw.count(b"|")
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    letters = chars / n if n else 0
    stops = sum(w.endswith((b".", b"?", b"!")) for w in words)
    fired = [
        n < MIN_WORDS,
        symbols * 10 > n,
        dup > 2 and dup * 10 > 3 * len(lines),
        repeat * 10 > 3 * n,
        upper * 3 > n,
        n > 0 and not 2.5 <= letters <= 14,
        bangs * 10 > n,
        stutter * 10 > n,
        symbols * 4 > n,
        repeat * 2 > n,
        upper * 2 > n,
        bangs * 3 > n,
        dup > 2 and dup * 2 > len(lines),
        3 <= letters <= 11 and n <= stops * 60 and stops * 3 <= n,
        n >= 4 * MIN_WORDS,
    ]
    votes = [(1 if j >= len(RULES) - GOOD else -1) * int(f) for j, f in enumerate(fired)]
    return [n, chars, symbols, dup, repeat], votes


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > 50 * n_words


def pattern_of(votes: list[int]) -> int:
    code = 0
    for v in votes:
        code = code * 3 + v + 1
    return code


def fit(patterns: dict[int, int], rounds: int = 100) -> dict:
    """EM over pattern counts: the share of good documents and each rule's accuracy."""
    codes = np.array(sorted(patterns), np.int64).reshape(-1)
    count = np.array([patterns[c] for c in codes], float)
    votes = codes[:, None] // 3 ** np.arange(len(RULES) - 1, -1, -1)[None] % 3 - 1
    kind = [0] * (len(RULES) - GOOD - SEVERE) + [1] * SEVERE + [2] * GOOD
    start, (low, high) = np.array(ACCURACY)[kind], np.array(BOUNDS)[kind].T
    model = {"share": 0.8, "accuracy": start}
    for _ in range(rounds):
        good = posterior(model, votes)
        right = np.where(votes > 0, good[:, None], 1 - good[:, None]) * (votes != 0)
        voted = count @ (votes != 0)
        model = {"share": float(np.clip((count @ good + 8) / (count.sum() + 10), 0.5, 0.95)), "accuracy": np.clip((count @ right + PRIOR * start) / (voted + PRIOR), low, high)}
    return model


def posterior(model: dict, votes: np.ndarray) -> np.ndarray:
    odds = votes @ np.log(model["accuracy"] / (1 - model["accuracy"])) + np.log(model["share"] / (1 - model["share"]))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _scan(docs: DataFrame, model: dict | None, keep_rows: bool, schema: str) -> DataFrame:
    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            got = [measure(t) for t in texts]
            if model is None:
                yield pa.RecordBatch.from_arrays([pa.array([pattern_of(v) for _, v in got], pa.int64())], ["pattern"])
                continue
            good = posterior(model, np.array([v for _, v in got], int).reshape(-1, len(RULES)))
            failed = np.array([base_failed(m[0], m[4]) for m, _ in got], bool)
            kept = ~failed & (good >= 0.5)
            if keep_rows:
                yield b.filter(pa.array(kept))
                continue
            cols = np.array([m for m, _ in got], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(cols[:, i]) for i in range(5)), pa.array(failed), pa.array(kept), pa.array(good)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"],
            )

    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame) -> dict:
    found = _scan(docs.select("text"), None, False, "pattern long").groupBy("pattern").count().collect()  # at most 2 ** rules rows
    return fit({r[0]: r[1] for r in found})


def quality_rules(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, p_good. Repeated rows get equal answers; no rows give none."""
    model = learn(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _scan(docs.select("doc_id", "text"), model, False, f"doc_id {id_type}, {_BASE}, base_failed boolean, kept boolean, p_good double")


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that quality_rules keeps, with all their columns."""
    return _scan(docs, learn(docs), True, docs.schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark, table(spark, sf_dir, "documents"))
