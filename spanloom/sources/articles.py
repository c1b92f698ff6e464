"""Article XML to passages: one task parses a file, everything after that is columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from itertools import groupby
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions.text import citation, clean_reference, collapse_spaces, infons, kept_passage, strip_section_number
from spanloom.operators.model import heading_terms

#: Elements that are dropped with all they hold.
DROPPED = {"table-wrap", "table", "table-wrap-foot", "inline-formula", "fig", "graphic", "inline-graphic", "inline-supplementary-material", "media", "tex-math", "sub-article"}
#: The same, in the body only.
DROPPED_IN_BODY = {"def-list", "notes"}
#: Headings of back matter that has none; of runs of paragraphs outside sections, one and several.
BACK = {"ack": "Acknowledgments", "funding-statement": "Funding Statement", "fn-group": "Footnotes", "app-group": "document part"}
LOOSE = ("document part", "introduction")
#: Fixed value: shorter paragraphs outside sections are left out.
LEAST_LOOSE = 6
#: The ids of terms for parts of documents.
TERM_IDS = {
    "version number section": "IAO:0000129", "patent section": "IAO:0000313", "document part": "IAO:0000314", "textual abstract section": "IAO:0000315",
    "graphical abstract section": "IAO:0000315", "introduction section": "IAO:0000316", "methods section": "IAO:0000317", "results section": "IAO:0000318",
    "discussion section": "IAO:0000319", "references section": "IAO:0000320", "author list": "IAO:0000321", "institution list": "IAO:0000322",
    "author contributions section": "IAO:0000323", "acknowledgements section": "IAO:0000324", "footnote section": "IAO:0000325",
    "supplementary material section": "IAO:0000326", "copyright section": "IAO:0000330", "abbreviations section": "IAO:0000606",
    "author information section": "IAO:0000607", "author summary section": "IAO:0000609", "availability section": "IAO:0000611",
    "case report section": "IAO:0000613", "conclusion section": "IAO:0000615", "conflict of interest section": "IAO:0000616", "consent section": "IAO:0000618",
    "ethical approval section": "IAO:0000620", "figures section": "IAO:0000622", "funding source declaration section": "IAO:0000623",
    "future directions section": "IAO:0000625", "genome announcement section": "IAO:0000627", "keywords section": "IAO:0000630",
    "study limitations section": "IAO:0000631", "materials section": "IAO:0000633", "notes section": "IAO:0000634", "patients section": "IAO:0000635",
    "pre-publication history section": "IAO:0000637", "related work section": "IAO:0000639", "requirements section": "IAO:0000641",
    "statistical analysis section": "IAO:0000644", "tables section": "IAO:0000645", "descriptive data section": "IAO:0000701", "document title": "IAO:0000305",
    "disclosure section": "IAO:CUIless", "highlights section": "IAO:CUIless",
}
_FIELDS = ["label", "authors", "title", "source", "year", "volume", "doi", "pmid"]
_SCHEMA = "file_name string, passage_no int, kind string, titles array<string>, text string, reference map<string,string>, article map<string,string>"
_LANG = "{http://www.w3.org/XML/1998/namespace}lang"


def _text(e: ElementTree.Element | None) -> str:
    return "" if e is None else "".join(e.itertext()).strip()


def _prune(e: ElementTree.Element, names: set[str]) -> None:
    """Takes the named elements out, but not the text that follows them."""
    last = None
    for child in list(e):
        if child.tag in names:
            if last is None:
                e.text = (e.text or "") + (child.tail or "")
            else:
                last.tail = (last.tail or "") + (child.tail or "")
            e.remove(child)
        else:
            _prune(child, names)
            last = child


def _paragraphs(e: ElementTree.Element, titles: list[str], loose: bool = True) -> Iterator[tuple[list[str], str, bool]]:
    """Each outermost paragraph with the titles of the sections around it, the top one first, and whether it stands outside sections and boxes."""
    if e.tag == "sec":
        titles = [*titles, own] if (own := _text(e.find("title"))) else titles
    if e.tag == "p":
        yield titles, _text(e), loose
    else:
        for child in e:
            yield from _paragraphs(child, titles, loose and e.tag not in ("sec", "boxed-text"))


def _body(body: ElementTree.Element) -> Iterator[tuple[str, list[str], str]]:
    """kind, titles, text: sections as they are; neighbouring paragraphs outside them are one run, with a heading by their number."""
    for loose, run in groupby(_paragraphs(body, []), key=lambda p: p[2]):
        run = list(run)
        for titles, text, _ in run:
            yield ("loose", [LOOSE[len(run) > 1]], text) if loose else ("body", titles or [LOOSE[0]], text)


def _titled(e: ElementTree.Element) -> Iterator[tuple[str, str]]:
    """Each title within with each paragraph of the unbroken run that comes next among its siblings."""
    for parent in e.iter():
        children = list(parent)
        for i, child in enumerate(children):
            if child.tag == "title":
                first = next((k for k in range(i + 1, len(children)) if children[k].tag == "p"), len(children))
                for p in children[first:]:
                    if p.tag != "p":
                        break
                    yield _text(child), _text(p)


def _back(root: ElementTree.Element) -> Iterator[tuple[str, list[str], str]]:
    """Acknowledgements, funding, footnotes, appendices (the first group of each of the last three) and notes; notes without a title are left out."""
    for tag, heading in BACK.items():
        for e in list(root.iter(tag))[: None if tag == "ack" else 1]:
            if e.find(".//title") is not None:
                yield from (("back", [title], text) for title, text in _titled(e))
            else:
                yield "back", [heading], _text(e)
    for e in root.iter("notes"):
        yield from (("back", [title], text) for title, text in _titled(e))


_ENTITY = re.compile(r"<!\[CDATA\[.*?\]\]>|&([A-Za-z][A-Za-z0-9.-]*);", re.DOTALL)


def known_entities(xml: str) -> str:
    """Entities that only an external document type declares become their characters, unknown ones the text that they are."""
    own = {"lt", "gt", "amp", "apos", "quot", *re.findall(r"<!ENTITY\s+([^\s%]+)", xml)}

    def said(m: re.Match) -> str:
        name = m[1]
        return m[0] if name is None or name in own else html5.get(f"{name};", f"&amp;{name};")

    return _ENTITY.sub(said, xml)


def _reference(ref: ElementTree.Element) -> dict[str, str]:
    first = lambda *tags: next((x for t in tags if (x := _text(ref.find(f".//{t}")))), "")
    names = [" ".join(x for x in (_text(n.find("surname")), _text(n.find("given-names"))) if x) for n in ref.iter("name")]
    ids = {p.get("pub-id-type"): _text(p) for p in ref.iter("pub-id")}
    values = [_text(ref.find("label")), ", ".join(names) or first("collab"), first("article-title"), first("source"), first("year"), first("volume"), ids.get("doi"), ids.get("pmid")]
    return {k: v for k, v in zip(_FIELDS, values) if v}


def _article(xml: str) -> Iterator[tuple[str, list[str], str, dict[str, str], dict[str, str]]]:
    root = ElementTree.fromstring(known_entities(xml))
    if root.tag != "article" and (inner := root.find(".//{*}article")) is not None:  # a record around it, perhaps in a namespace
        root = inner
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2] if isinstance(e.tag, str) else e.tag
    for part in ("front", "body"):
        if root.find(part) is None:
            raise ValueError(f"no {part}")
    _prune(root, DROPPED)
    ids = {x.get("pub-id-type"): _text(x) for x in root.iterfind("front/article-meta/article-id")}
    find = lambda path: _text(root.find(path))
    about = {"pmcid": ids.get("pmc") or ids.get("pmcid"), "pmid": ids.get("pmid"), "doi": ids.get("doi"), "journal": find("front//journal-title"), "pub_type": root.get("article-type"), "year": find("front/article-meta/pub-date/year"), "license": find("front//license")}
    about = {k: v for k, v in about.items() if v}
    yield "title", ["document title"], find("front//article-title"), {}, about
    for group in root.iter("kwd-group"):
        name = _text(group.find("title"))
        if group.get(_LANG, "en") == "en" and "abbr" not in name.lower():
            yield "keywords", ["Keywords", name or "Keywords"], "; ".join(_text(k) for k in group.iter("kwd")), {}, about
    for abstract in root.iterfind("front//abstract"):
        for titles, text, _ in _paragraphs(abstract, ["Abstract"]):
            yield "abstract", titles, text, {}, about
    back = list(_back(root))
    for body in root.iterfind("body"):
        _prune(body, DROPPED_IN_BODY)
        for kind, titles, text in _body(body):
            yield kind, titles, text, {}, about
    for kind, titles, text in back:
        yield kind, titles, text, {}, about
    for ref in root.iterfind("back//ref"):
        yield "reference", ["References"], "", _reference(ref), about


def read_articles(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """file_name, passage_no, kind, titles, text, reference, article: the parts of each article, titles of the sections around them from the top.

    kind: title, keywords, abstract, body, loose (a body's paragraphs outside sections), back (acknowledgements, funding, footnotes, appendices,
    notes) or reference. A file that is no well-formed XML, or has no front or body, gives one row of kind 'error' with the reason as text. A record
    around the article is passed over, namespaces are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("file_name").to_pylist(), b.column("value").to_pylist()):
                try:
                    parts = list(_article(content))
                except (ElementTree.ParseError, ValueError) as e:
                    parts = [("error", [], str(e), {}, {})]
                kinds, titles, texts, refs, about = (list(x) for x in zip(*parts))
                maps = lambda ms: pa.array([list(m.items()) for m in ms], pa.map_(pa.string(), pa.string()))
                cols = [pa.array([name] * len(parts)), pa.array(range(len(parts)), pa.int32()), pa.array(kinds), pa.array(titles, pa.list_(pa.string())), pa.array(texts, pa.string()), maps(refs), maps(about)]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in _SCHEMA.split(", ")])

    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("file_name"), "value").mapInArrow(run, _SCHEMA)


def article_passages(parts: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """file_name, doc_no, doc_id, doc_infons, passage_no, offset, text, infons, annotations: ``read_articles`` as sources.files.passages has it.

    Spaces are collapsed, section numbers go, a reference becomes one line; empty texts and repeats of a text within an article go; offsets
    count the texts and one character between two. With terms (term, name, ord) the infons name the terms of the top heading and their ids.
    """
    field = lambda k: F.col("reference")[k]
    line = clean_reference(citation(*[field(k) for k in _FIELDS[:6]]))
    text = collapse_spaces(F.when(F.col("kind") == "reference", line).otherwise(F.col("text")))
    rows = parts.where("kind <> 'error'").withColumn("text", F.trim(text)).where(kept_passage(F.col("text")) & ((F.col("kind") != "loose") | kept_passage(F.col("text"), LEAST_LOOSE))).withColumn("titles", F.transform("titles", strip_section_number))
    by = Window.partitionBy("file_name").orderBy("passage_no")
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("file_name", "text").orderBy("passage_no"))).where("rn = 1")
    rows = rows.withColumn("offset", F.coalesce(F.sum(F.length("text") + 1).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    rows = rows.withColumn("passage_no", F.row_number().over(by) - 1).withColumn("top", F.col("titles")[0])
    pair = lambda name: F.struct(F.lit(TERM_IDS[name]).alias("id"), F.lit(name).alias("name"))
    if terms is not None:
        found = heading_terms(rows.where("kind NOT IN ('title', 'reference')").select(F.col("top").alias("heading")), terms, TERM_IDS).withColumnRenamed("heading", "top")
        fixed = F.when(F.col("kind") == "title", F.array(pair("document title"))).when(F.col("kind") == "reference", F.array(pair("references section")))
        rows = rows.join(found, "top", "left").withColumn("terms", F.coalesce(fixed, "terms"))
    else:
        rows = rows.withColumn("terms", F.array().cast("array<struct<id:string,name:string>>"))
    numbered = lambda col, name: F.map_from_entries(F.transform(col, lambda x, i: F.struct(F.concat(F.lit(name), (i + 1).cast("string")).alias("k"), x.alias("v"))))
    cited = infons(**{k: F.when(F.col("kind") == "reference", field(s)) for k, s in (("journal", "source"), ("year", "year"), ("volume", "volume"), ("doi", "doi"), ("pmid", "pmid"))})
    distinct = F.filter("titles", lambda x, i: (i == 0) | (x != F.get("titles", i - 1)))
    about = F.map_concat(numbered(distinct, "section_title_"), numbered(F.transform("terms", lambda x: x["name"]), "term_"), numbered(F.transform("terms", lambda x: x["id"]), "term_id_"), cited)
    none = F.array().cast("array<struct<id:string,text:string,infons:map<string,string>,locations:array<struct<offset:bigint,length:bigint>>>>")
    return rows.select("file_name", F.lit(0).alias("doc_no"), F.coalesce(F.col("article")["pmcid"], "file_name").alias("doc_id"), F.col("article").alias("doc_infons"), "passage_no", "offset", "text", about.alias("infons"), none.alias("annotations"))
