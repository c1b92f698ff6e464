"""Text functions as Column expressions: all stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_token(w: Column) -> Column:
    """Drop parentheses; then dots and commas, but keep an initial such as 'X.' whole.

    Most words have none of these and are taken as they are; of the others characters are dropped without a pattern.
    """
    bare = F.translate(w, "()", "")
    marked = w.contains("(") | w.contains(")") | w.contains(".") | w.contains(",")
    return (
        F.when(~marked, w)
        .when(F.length(bare) != 2, F.translate(bare, ".,", ""))
        .when(bare.rlike("^\\p{Lu}[.]$"), bare)
        .otherwise(F.translate(bare, ".", ""))
    )


def latin_singular(w: Column) -> Column:
    """ae to a, else i to us, else a to um, else nothing."""
    but = lambda n: w.substr(F.lit(1), F.length(w) - n)
    return F.when(w.endswith("ae"), but(1)).when(w.endswith("i"), F.concat(but(1), F.lit("us"))).when(w.endswith("a"), F.concat(but(1), F.lit("um"))).otherwise("")


def latin_plurals(name: Column) -> Column:
    """All words whose ``latin_singular`` is the name, as an array."""
    but = lambda n: name.substr(F.lit(1), F.length(name) - n)
    forms = F.array(F.when(name.endswith("a"), F.concat(name, F.lit("e"))), F.when(name.endswith("us"), F.concat(but(2), F.lit("i"))), F.when(name.endswith("um"), F.concat(but(2), F.lit("a"))))
    return F.filter(forms, lambda x: x.isNotNull())


#: Fixed value: what counts as punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def text_preprocess(s: Column, lowercase: bool = True, remove_punctuation: bool = True, ignore: str = "") -> Column:
    """Lower-cased, runs of white space and punctuation (but for ``ignore``) to one space, trimmed."""
    out = F.lower(s) if lowercase else s
    marks = "".join(f"\\{c}" for c in PUNCTUATION if c not in ignore)
    return F.trim(F.regexp_replace(out, f"[\\s{marks}]+", " ")) if remove_punctuation else F.trim(out)


def collapse_spaces(s: Column) -> Column:
    """Runs of spaces to one, then line ends to spaces, in this order."""
    return F.replace(F.regexp_replace(s, " {2,}", " "), F.lit("\n"), F.lit(" "))


def strip_tags(s: Column) -> Column:
    return F.regexp_replace(s, "<[^>]+>", "")


def decode_entities(s: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&apos;", "'"), ("&quot;", '"'), (" ", " ")):
        s = F.replace(s, F.lit(name), F.lit(char))
    return s


def clean_title(s: Column) -> Column:
    return F.translate(strip_tags(s), "'[]\"", "")


def strip_section_number(t: Column) -> Column:
    number = "^\\s*[0-9.,]*[0-9][0-9.,]*[.]\\s+(?=\\S)"
    return F.when(t.rlike(number), F.trim(F.regexp_replace(F.regexp_replace(t, number, ""), "\\s+", " "))).otherwise(t)


def clean_reference(s: Column) -> Column:
    for a, b in ((" ,", ","), (" .", "."), ("..", ".")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def word_punct(s: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(s), F.lit("(?U)\\w+|[^\\w\\s]+"), F.lit(0)), " ")


def neg_log10_q(q: Column) -> Column:
    return -F.log10(F.when(q == 0, F.lit(1e-5)).otherwise(q))


def keyword_matches(infons: Column, keyword: str) -> Column:
    """Any value equal to, or with a word equal to, the keyword with its first letter in either case; 'ALL' is all."""
    if keyword == "ALL":
        return F.lit(True)
    forms = [keyword[:1].upper() + keyword[1:], keyword[:1].lower() + keyword[1:]]
    return F.exists(F.map_values(infons), lambda v: F.arrays_overlap(F.concat(F.array(v), F.split(v, " ")), F.array(*map(F.lit, forms))))


def section_matches(infons: Column, sections: list[str]) -> Column:
    return F.exists(F.map_values(infons), lambda v: F.lower(v).isin(sections)) if sections else F.lit(True)


def parse_ids(s: Column) -> Column:
    """Ids of a printed list with exactly one pair of brackets; null otherwise."""
    inside = F.regexp_extract(s, "^[^\\[\\]]*\\[([^\\[\\]]*)\\][^\\[\\]]*$", 1)
    return F.when(s.rlike("^[^\\[\\]]*\\[[^\\[\\]]*\\][^\\[\\]]*$"), F.filter(F.split(F.translate(inside, "',", ""), "\\s+"), lambda x: x != ""))


def trim_candidates(a: Column) -> Column:
    return F.when(F.size(a) >= 4, F.array(F.element_at(a, 1), F.element_at(a, -1))).otherwise(a)


def citation(label: Column, authors: Column, title: Column, source: Column, year: Column, volume: Column) -> Column:
    """The parts that are there, closed by full stops, and ';volume' after the year."""
    dated = F.when(volume.isNotNull() & (volume != ""), F.concat(F.coalesce(year, F.lit("")), F.lit(";"), volume)).otherwise(year)
    return F.concat_ws(" ", *[F.when(c != "", F.concat(c, F.lit("."))) for c in (label, authors, title, source, dated)])


def identifier_type(kingdom: Column, rank: Column, modifier: Column) -> Column:
    """kingdom_rank, the modifier in place of the rank where there is one."""
    return F.concat_ws("_", kingdom, F.coalesce(modifier, rank, F.lit("no rank")))


def capitalised(first: Column, second: Column) -> Column:
    """The first word with a capital, then the second."""
    return F.concat(F.upper(F.substring(first, 1, 1)), first.substr(F.lit(2), F.length(first)), F.lit(" "), second)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one row of the table for each character of a, as an array over b."""
    chars = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    zero = F.array_repeat(F.lit(0), F.length(b) + 1)
    nth = lambda xs, i: F.element_at(xs, i + 1)

    def row(above, x):
        step = lambda line, i: F.concat(line, F.array(F.when(nth(chars(b), i) == x, nth(above, i) + 1).otherwise(F.greatest(nth(above, i + 1), F.element_at(line, -1)))))
        places = F.when(F.length(b) > 0, F.sequence(F.lit(0), F.length(b) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, F.array(F.lit(0)), step)

    return F.element_at(F.aggregate(chars(a), zero, row), -1)


def edit_ratio(a: Column, b: Column) -> Column:
    """100 * 2 * common / (length of both), rounded; two empty strings are 100."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, F.lit(100)).otherwise(F.round(200.0 * common_length(a, b) / both).cast("int"))


def label_place(angle: Column, radius: Column, n: Column) -> tuple[Column, Column]:
    """Rotation in degrees, turned so that no label stands on its head, and a distance that three neighbours stagger."""
    degrees = angle * 180 / F.pi()
    return F.when((degrees > 90) & (degrees < 270), degrees + 180).otherwise(degrees), radius + F.lit(0.3) * (n % 3)


def kept_passage(text: Column, least: int = 1) -> Column:
    """Not empty, not a single space, and of ``least`` characters or more."""
    return text.isNotNull() & ~text.isin("", " ") & (F.length(text) >= least)


def infons(**fields: Column) -> Column:
    """A map of the fields that are there."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in fields.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull() & (p["value"] != "")))


def unescape(s: Column) -> Column:
    """Written escapes (backslash, u, four hex digits) as their characters, two surrogates as one; a lone surrogate stays as it is written."""
    pair, one = "\\\\u[dD][89abAB][0-9a-fA-F]{2}\\\\u[dD][c-fC-F][0-9a-fA-F]{2}", "\\\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4}"
    parts = F.regexp_extract_all(s, F.lit(f"{pair}|{one}|[^\\\\]+|\\\\"), F.lit(0))
    read = lambda p: F.when(p.startswith("\\u"), F.decode(F.unhex(F.replace(p, F.lit("\\u"), F.lit(""))), "UTF-16BE")).otherwise(p)
    return F.when(s.contains("\\u"), F.array_join(F.transform(parts, read), "")).otherwise(s)


def fix_mojibake(s: Column) -> Column:
    """UTF-8 that was read as Latin-1 is read again; where that fails, the UTF-8 bytes are read as Latin-1.

    The second step never fails, so no other is needed; it turns sound text outside ASCII into the very thing that the first one mends.
    Use it on columns that are known to be damaged.
    """
    again = F.try_validate_utf8(F.encode(s, "ISO-8859-1").cast("string"))
    other = F.decode(F.encode(s, "UTF-8"), "ISO-8859-1")
    return F.when(s.rlike("^[\\x00-\\xff]*$"), F.coalesce(again, other)).otherwise(other)
