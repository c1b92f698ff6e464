"""Queries over the test tables, one or more for each operator, and their oracle SQL.

The tables hold no taxonomy, so names come from benchmark passages (which documents embed) and from
parts, and the tree is region, nation, customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import annotate, boundaries, candidates, corpora, link, rewiring, spans, stats, taxonomy, typos

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ------------------------------------------------------------------ pieces of oracle SQL
def _clean(w: str) -> str:
    b = f"regexp_replace({w}, '[()]', '', 'g')"
    return f"CASE WHEN length({b}) <> 2 THEN regexp_replace({b}, '[.,]', '', 'g') WHEN regexp_matches({b}, '^\\p{{Lu}}[.]$') THEN {b} ELSE regexp_replace({b}, '[.]', '', 'g') END"


_TOK = """tok0 AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS pos FROM documents WHERE text IS NOT NULL),
tok AS (SELECT doc_id, pos, w, coalesce(sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
 lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM tok0)"""
_LEX = f"""lexn AS (SELECT DISTINCT lower({_clean('w')}) AS name FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)),
lex AS (SELECT name, 'G' || row_number() OVER (ORDER BY name) AS tax_id FROM lexn WHERE length(name) >= 6)"""
_BIG = f"""bt AS (SELECT item_id, w, lead(w) OVER (PARTITION BY item_id ORDER BY pos) AS nx FROM (SELECT item_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS pos FROM benchmark)),
bn AS (SELECT DISTINCT a || ' ' || b AS name FROM (SELECT lower({_clean('w')}) AS a, lower({_clean('nx')}) AS b FROM bt WHERE nx IS NOT NULL) WHERE length(a) >= 5 AND length(b) >= 3),
big AS (SELECT name, 'S' || row_number() OVER (ORDER BY name) AS tax_id FROM bn),
bm AS (SELECT doc_id, pos, start, name, tax_id FROM (SELECT doc_id, pos, start, lower({_clean('w')}) || ' ' || lower({_clean('next')}) AS name FROM tok WHERE next IS NOT NULL) JOIN big USING (name))"""


# ------------------------------------------------------------------ text
@query(f"WITH {_TOK} SELECT doc_id, pos::INT AS pos, w, start, next FROM tok")
def tokenize_offsets(spark, sf):
    return annotate.tokens(t(spark, sf, "documents"))


@query(f"WITH {_TOK} SELECT DISTINCT w, {_clean('w')} AS cleaned, CASE WHEN w LIKE '%ae' THEN regexp_replace(w, 'ae$', 'a') WHEN w LIKE '%i' THEN regexp_replace(w, 'i$', 'us') WHEN w LIKE '%a' THEN regexp_replace(w, 'a$', 'um') ELSE '' END AS singular FROM tok")
def clean_token(spark, sf):
    w = t(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("w")).distinct()
    return w.select("w", tx.clean_token(F.col("w")).alias("cleaned"), tx.latin_singular(F.col("w")).alias("singular"))


@query("SELECT doc_id, trim(regexp_replace(lower(text), '[\\s!-/:-@\\[-`{-~]+', ' ', 'g')) AS processed FROM documents")
def text_preprocess(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.text_preprocess(F.col("text")).alias("processed"))


@query("SELECT page_id, replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&apos;', ''''), '&quot;', '\"') AS plain, translate(regexp_replace(html, '<[^>]+>', '', 'g'), '''[]\"', '') AS title FROM pages")
def strip_markup(spark, sf):
    return t(spark, sf, "pages").select("page_id", tx.decode_entities(tx.strip_tags(F.col("html"))).alias("plain"), tx.clean_title(F.col("html")).alias("title"))


@query("SELECT doc_id, replace(regexp_replace(text, ' {2,}', ' ', 'g'), chr(10), ' ') AS collapsed, replace(replace(replace(text, ' ,', ','), ' .', '.'), '..', '.') AS reference FROM documents")
def space_newline_normalise(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.collapse_spaces(F.col("text")).alias("collapsed"), tx.clean_reference(F.col("text")).alias("reference"))


@query("SELECT page_id, array_to_string(regexp_extract_all(lower(url), '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]+'), ' ') AS words FROM pages")
def word_punct_tokens(spark, sf):
    return t(spark, sf, "pages").select("page_id", tx.word_punct(F.col("url")).alias("words"))


# ------------------------------------------------------------------ annotator
@query(f"WITH {_TOK}, {_LEX} SELECT tax_id, name, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, lower({_clean('w')}) AS name FROM tok) JOIN lex USING (name) GROUP BY 1, 2")
def mention_counts(spark, sf):
    return annotate.mention_counts(t(spark, sf, "documents"), annotate.unigram_lexicon(t(spark, sf, "benchmark")))


@query(f"WITH {_TOK}, {_LEX} SELECT doc_id, pos::INT AS pos, start, name, tax_id FROM (SELECT doc_id, pos, start, lower({_clean('w')}) AS name FROM tok) JOIN lex USING (name)")
def unigram_match(spark, sf):
    return annotate.unigram_matches(annotate.tokens(t(spark, sf, "documents")), annotate.unigram_lexicon(t(spark, sf, "benchmark")))


@query(f"WITH {_TOK}, {_BIG} SELECT doc_id, pos::INT AS pos, start, name, tax_id FROM bm")
def bigram_match(spark, sf):
    return annotate.bigram_matches(annotate.tokens(t(spark, sf, "documents")), annotate.bigram_lexicon(t(spark, sf, "benchmark")))


@query(f"WITH {_TOK}, {_BIG}, isl AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM bm), nth AS (SELECT *, row_number() OVER (PARTITION BY doc_id, i ORDER BY pos) AS k FROM isl) SELECT doc_id, pos::INT AS pos, start, name, tax_id FROM nth WHERE k % 2 = 1")
def greedy_skip_mentions(spark, sf):
    return annotate.greedy_skip(bigram_match(spark, sf))


def _settle_sql() -> str:
    """The steps after a span model, one common table expression each, over s0 (doc_id, p, o, n, e)."""
    ws = "[\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
    sp, split = "('sp', 'spp', 'sp.', 'spp.')", lambda x: f"list_filter(string_split_regex({x}, '{ws}+'), lambda w: w <> '')"
    pair, rest = "w[1] || ' ' || w[2]", "array_to_string(w[2:], ' ')"
    rules = [
        ("regexp_matches(w[1], '^\\p{L}[.]')", (pair, "length(e1)", "n")), ("regexp_matches(w[2], '^\\p{L}[.]')", (rest, "o + length(w[1]) + 1", "length(e1)")),
        ("regexp_matches(w[1], '^\\p{L}(.*)[.]$')", (pair, "o", "length(e1)")), ("regexp_matches(w[2], '^\\p{L}(.*)[.]$')", (rest, "o + length(w[1]) + 1", "length(e1)")), (f"w[2] IN {sp}", (pair, "o", "length(e1)")),
        ("regexp_matches(w[1], '^\\p{Lu}') AND regexp_matches(w[2], '^\\p{Ll}')", (pair, "o", "length(e1)")), ("regexp_matches(w[1], '^\\p{Ll}') AND regexp_matches(w[2], '^\\p{Lu}')", (rest, "o + length(w[1]) + 1", "length(e1)")),
    ]
    steps = [
        f"s1 AS (SELECT *, o + length(regexp_extract(substr(p, o + 1), '^{ws}*')) AS a, o + n - length(regexp_extract(substr(p, 1, o + n), '{ws}*$')) AS b FROM s0)",
        "s2 AS (SELECT doc_id, p, o, n, e, CASE WHEN b >= length(p) OR a > b THEN a ELSE a - length(regexp_extract(substr(p, 1, a), '\\p{L}*$')) END AS a, CASE WHEN b >= length(p) OR a > b THEN b ELSE b + length(regexp_extract(substr(p, b + 1), '^\\p{L}*')) END AS b FROM s1)",
        "s3 AS (SELECT doc_id, p, CASE WHEN a = o AND b = o + n THEN e ELSE substr(p, a + 1, b - a) END AS e, a AS o, b - a AS n FROM s2)",
        f"s4 AS (SELECT *, CASE WHEN length(e) IN (1, 2) THEN {split('substr(p, o + 1)')} END AS h FROM s3)",
        "s5 AS (SELECT doc_id, p, o, CASE WHEN regexp_matches(h[1], '^\\p{L}[.]$') AND len(h) > 1 THEN h[1] || ' ' || substr(h[2], 1, length(regexp_replace(h[2], '\\P{L}', '', 'g'))) ELSE e END AS e, n AS n0, e AS e0 FROM s4 WHERE h IS NULL OR length(h[1]) = 2)",
        f"c0 AS (SELECT doc_id, p, o, CASE WHEN e = e0 THEN n0 ELSE length(e) END AS n, e, {split('e')} AS w FROM s5)",
    ]
    for i, (holds, (e, o, n)) in enumerate(rules):
        on = f"len(w) > 2 AND w[3] NOT IN {sp} AND {holds}"
        steps.append(f"c{i + 1} AS (SELECT doc_id, p, CASE WHEN {on} THEN {o} ELSE o END AS o, CASE WHEN {on} THEN {n} ELSE n END AS n, CASE WHEN {on} THEN e1 ELSE e END AS e, w FROM (SELECT *, {e} AS e1 FROM c{i}))")
    return ", ".join([
        *steps, f"d0 AS (SELECT doc_id, p, o, n, e, {split('e')} AS w, {split('substr(p, o + 1)')} AS h FROM c7)",
        f"d1 AS (SELECT doc_id, p, o, n, e, CASE WHEN len(w) > 0 AND h[len(w) + 1] IN {sp} AND (len(w) = 1 OR h[len(w)] = w[-1]) THEN array_to_string(h[:len(w) + 1], ' ') END AS grown FROM d0)",
        "d2 AS (SELECT doc_id, o, n, min(e) AS e, any_value(p) AS p FROM (SELECT doc_id, p, o, coalesce(length(grown), n) AS n, coalesce(grown, e) AS e FROM d1) WHERE e <> '' AND n > 0 GROUP BY 1, 2, 3)",
        "n0 AS (SELECT *, max(o + n) OVER (PARTITION BY doc_id ORDER BY o, n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM d2)",
        "n1 AS (SELECT *, max(o + n) OVER (PARTITION BY doc_id ORDER BY o, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM n0 WHERE most IS NULL OR o + n > most)",
        "n2 AS (SELECT *, sum(CASE WHEN before IS NULL OR o > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY o, n) AS run FROM n1)",
        f"n3 AS (SELECT doc_id, min(o) AS start, max(o + n) - min(o) AS length, count(*) AS k, min(e) AS e, any_value(p) AS p FROM n2 GROUP BY doc_id, run)",
        f"settled AS (SELECT doc_id, start, length, CASE WHEN k > 1 THEN regexp_replace(substr(p, start + 1, length), '^{ws}+|{ws}+$', '', 'g') ELSE e END AS text FROM n3)",
    ])


@query(f"""WITH {_TOK}, {_BIG}, s0 AS (SELECT DISTINCT doc_id, p, o, n, substr(p, o + 1, n) AS e FROM (SELECT m.doc_id, d.text AS p, m.start + 1 AS o, length(a.w) + length(a.next) + length(c.w) AS n
 FROM bm m JOIN tok a ON a.doc_id = m.doc_id AND a.pos = m.pos JOIN tok c ON c.doc_id = m.doc_id AND c.pos = m.pos + 2 JOIN documents d ON d.doc_id = m.doc_id)), {_settle_sql()} SELECT * FROM settled""")
def settled_spans(spark, sf):
    """Mentions of a pair and the word after it, a letter short at either end, through the steps after a span model."""
    docs = t(spark, sf, "documents")
    met = annotate.bigram_matches(annotate.tokens(docs, third=True), annotate.bigram_lexicon(t(spark, sf, "benchmark")), "w", "next", "third").where("third IS NOT NULL")
    return boundaries.settle(met.select("doc_id", (F.col("start") + 1).alias("start"), (F.length("w") + F.length("next") + F.length("third")).cast("long").alias("length")), docs)


_PN = "pn AS (SELECT p_name AS name, min(p_partkey) AS ord FROM part GROUP BY 1), px AS (SELECT name, ord, upper(substr(name, 1, 1)) AS initial, string_split(name, ' ')[2] AS epithet FROM pn)"


def _part_names(spark, sf):
    return t(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ord"))


@query(f"WITH {_PN} SELECT initial, epithet, array_to_string(list(name ORDER BY ord), '|') AS candidates, count(*)::INT AS n FROM px GROUP BY 1, 2")
def abbrev_candidates(spark, sf):
    c = annotate.abbreviation_index(_part_names(spark, sf))
    return c.select("initial", "epithet", F.array_join("candidates", "|").alias("candidates"), F.size("candidates").alias("n"))


@query("""WITH m AS (SELECT l_orderkey AS doc_id, l_linenumber AS pos, upper(substr(p_name, 1, 1)) AS initial, string_split(p_name, ' ')[2] AS epithet,
 CASE WHEN l_linenumber % 2 = 1 THEN p_name END AS name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT doc_id, pos, initial, epithet, coalesce(name, arg_min(name, pos) FILTER (name IS NOT NULL) OVER (PARTITION BY doc_id, initial, epithet ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS resolved FROM m""")
def abbrev_resolve_prior(spark, sf):
    m = t(spark, sf, "lineitem").join(t(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    m = m.select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos"), F.upper(F.substring("p_name", 1, 1)).alias("initial"),
        F.split("p_name", " ")[1].alias("epithet"), F.when(F.col("l_linenumber") % 2 == 1, F.col("p_name")).alias("name"),
    )
    return annotate.resolve_by_history(m).drop("name")


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def ambiguous_names(spark, sf):
    return t(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("WITH a AS (SELECT p_name AS name, list(p_partkey ORDER BY p_partkey) AS ids FROM part GROUP BY 1) SELECT name, CASE WHEN len(ids) >= 4 THEN ids[1] || ',' || ids[len(ids)] ELSE array_to_string(ids, ',') END AS trimmed, len(ids)::INT AS n FROM a")
def trim_candidates(spark, sf):
    a = t(spark, sf, "part").groupBy(F.col("p_name").alias("name")).agg(F.sort_array(F.collect_list("p_partkey")).alias("ids"))
    return a.select("name", F.array_join(tx.trim_candidates(F.col("ids")).cast("array<string>"), ",").alias("trimmed"), F.size("ids").alias("n"))


@query("""WITH m AS (SELECT o_custkey AS d, o_orderkey AS p, o_orderstatus AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'F' END AS b, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS k FROM orders),
w AS (SELECT *, lag(k) OVER x AS bf, lead(k) OVER x AS af, row_number() OVER x AS rn, count(*) OVER (PARTITION BY d) AS n FROM m WINDOW x AS (PARTITION BY d ORDER BY p)),
s AS (SELECT *, CASE WHEN rn = 1 AND n > 1 THEN af WHEN rn = n THEN CASE WHEN n > 1 THEN bf END ELSE coalesce(bf, af) END AS nb FROM w)
SELECT d AS doc_id, p AS pos, CASE WHEN k IS NOT NULL THEN 'first' WHEN a = nb THEN 'first' WHEN b = nb THEN 'second' ELSE 'unresolved' END AS resolved FROM s""")
def neighbour_disambiguation(spark, sf):
    first, second = F.struct(F.col("o_orderstatus").alias("type"), F.lit("first").alias("id")), F.struct(F.lit("F").alias("type"), F.lit("second").alias("id"))
    m = t(spark, sf, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 3 == 0, F.array(first, second)).otherwise(F.array(first)).alias("candidates")
    )
    return annotate.disambiguate_by_neighbour(m).select("doc_id", "pos", "resolved")


@query(f"""WITH {_PN}, k AS (SELECT lower(name) AS key, arg_min('P' || ord, ord) AS tax_id FROM pn WHERE ord % 2 = 0 GROUP BY 1)
SELECT p_partkey, upper(p_name) AS mention, tax_id FROM part LEFT JOIN k ON lower(p_name) = key""")
def normalise_exact(spark, sf):
    lex = _part_names(spark, sf).where("ord % 2 = 0").withColumn("tax_id", F.concat(F.lit("P"), F.col("ord").cast("string")))
    return annotate.normalise_exact(t(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("mention")), lex)


# ------------------------------------------------------------------ scans and filters
@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_scan(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT conv_id, turn, role FROM conversations WHERE role IN ('User', 'user') OR list_contains(string_split(role, ' '), 'user') OR list_contains(string_split(role, ' '), 'User')")
def keyword_filter(spark, sf):
    c = t(spark, sf, "conversations").withColumn("infons", F.create_map(F.lit("section_title_1"), F.col("role")))
    return c.where(tx.keyword_matches(F.col("infons"), "user")).select("conv_id", "turn", "role")


@query("SELECT conv_id, turn FROM conversations WHERE lower(role) IN ('assistant')")
def section_filter(spark, sf):
    c = t(spark, sf, "conversations").withColumn("infons", F.create_map(F.lit("iao_name_1"), F.col("role")))
    return c.where(tx.section_matches(F.col("infons"), ["assistant"])).select("conv_id", "turn")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS id FROM part WHERE p_partkey % 5 <> 0")
def parse_id_lists(spark, sf):
    shown = F.concat(F.lit("['"), F.replace(F.col("p_name"), F.lit(" "), F.lit("', '")), F.lit("']"))
    p = t(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit("[a] [b]")).otherwise(shown).alias("s"))
    return p.select("p_partkey", F.explode(tx.parse_ids(F.col("s"))).alias("id"))


# ------------------------------------------------------------------ spans
_SP = "sp AS (SELECT DISTINCT l_orderkey AS doc_id, l_partkey % 50 AS start, l_quantity::BIGINT AS length FROM lineitem)"


def _spans(spark, sf):
    return t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), (F.col("l_partkey") % 50).alias("start"), F.col("l_quantity").cast("long").alias("length"))


@query(f"WITH {_SP} SELECT * FROM sp")
def dedup_spans(spark, sf):
    return spans.dedup_spans(_spans(spark, sf))


@query(f"WITH {_SP}, m AS (SELECT *, max(start + length) OVER (PARTITION BY doc_id ORDER BY start, length DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM sp) SELECT doc_id, start, length FROM m WHERE e IS NULL OR start + length > e")
def remove_nested_spans(spark, sf):
    return spans.remove_nested(spans.dedup_spans(_spans(spark, sf)))


@query(f"""WITH {_SP}, m AS (SELECT *, max(start + length) OVER (PARTITION BY doc_id ORDER BY start, length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM sp),
g AS (SELECT *, sum(CASE WHEN e IS NULL OR start > e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start, length ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT doc_id, min(start) AS start, max(start + length) - min(start) AS length, count(*) AS n FROM g GROUP BY doc_id, g""")
def merge_spans(spark, sf):
    return spans.merge_overlapping(spans.dedup_spans(_spans(spark, sf)))


@query(f"""WITH {_TOK} SELECT doc_id, CASE WHEN w LIKE '(%' AND w NOT LIKE '%)%' THEN start + 1 ELSE start END AS start, length(x)::INT AS length, x AS text FROM
(SELECT doc_id, start, w, regexp_replace(CASE WHEN w LIKE '(%' AND w NOT LIKE '%)%' THEN substr(w, 2) ELSE w END, '[., ]+$', '') AS x FROM tok WHERE length(w) > 5 AND substr(w, 2, 2) NOT IN (', ', '.,') AND NOT regexp_matches(w, '[(,)](genu|associate)')) WHERE length(x) > 0""")
def span_repair(spark, sf):
    d = t(spark, sf, "documents")
    s = annotate.tokens(d).where("length(w) > 5 AND NOT w RLIKE '[(,)](genu|associate)'").select("doc_id", "start", F.length("w").alias("length"), F.col("w").alias("passage_word"))
    # the span alone as its passage, so that no text is copied for every token
    return spans.repair(s.select("doc_id", F.col("start").alias("at"), F.lit(0).cast("long").alias("start"), "length", F.col("passage_word").alias("passage"))).select(
        "doc_id", (F.col("at") + F.col("start")).alias("start"), "length", "text"
    )


# ------------------------------------------------------------------ taxonomy
_TREE = """nd AS (SELECT 'C' || c_custkey AS tax_id, 'species' AS rank FROM customer UNION ALL SELECT 'N' || n_nationkey, 'family' FROM nation UNION ALL SELECT 'R' || r_regionkey, 'superkingdom' FROM region),
ed AS (SELECT 'C' || c_custkey AS child, 'N' || c_nationkey AS parent FROM customer UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation),
ct AS (SELECT 'C' || o_custkey AS tax_id, count(*) AS n FROM orders GROUP BY 1)"""


def _key(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def _tree(spark, sf):
    c, n, r = (t(spark, sf, x) for x in ("customer", "nation", "region"))
    nodes = c.select(_key("C", "c_custkey").alias("tax_id"), F.lit("species").alias("rank"))
    nodes = nodes.unionByName(n.select(_key("N", "n_nationkey").alias("tax_id"), F.lit("family").alias("rank")))
    nodes = nodes.unionByName(r.select(_key("R", "r_regionkey").alias("tax_id"), F.lit("superkingdom").alias("rank")))
    edges = c.select(_key("C", "c_custkey").alias("child"), _key("N", "c_nationkey").alias("parent"))
    return nodes, edges.unionByName(n.select(_key("N", "n_nationkey").alias("child"), _key("R", "n_regionkey").alias("parent")))


def _counts(spark, sf, where: str = "true"):
    return t(spark, sf, "orders").where(where).groupBy(_key("C", "o_custkey").alias("tax_id")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH RECURSIVE {_TREE}, c AS (SELECT tax_id, tax_id AS ancestor, 0 AS distance FROM nd UNION ALL SELECT tax_id, parent, distance + 1 FROM c JOIN ed ON ancestor = child) SELECT * FROM c")
def ancestor_closure(spark, sf):
    nodes, edges = _tree(spark, sf)
    return taxonomy.ancestors(edges, nodes.select("tax_id"))


@query(f"WITH {_TREE} SELECT rank, tax_id, coalesce(n, 0) AS n FROM nd LEFT JOIN ct USING (tax_id)")
def rank_counts(spark, sf):
    nodes, _ = _tree(spark, sf)
    return nodes.join(_counts(spark, sf), "tax_id", "left").select("rank", "tax_id", F.coalesce("n", F.lit(0)).alias("n"))


# a third of the species hang from their superkingdom, so ranks are skipped
@query(f"""WITH {_TREE}, e2 AS (SELECT child, CASE WHEN child LIKE 'C%' AND substr(child, 2)::BIGINT % 3 = 0 THEN 'R' || (SELECT n_regionkey FROM nation WHERE 'N' || n_nationkey = parent) ELSE parent END AS parent FROM ed),
k AS (SELECT parent, count(*) AS k FROM e2 GROUP BY 1), s AS (SELECT tax_id, rank, coalesce(n, 0)::DOUBLE AS a FROM nd LEFT JOIN ct USING (tax_id) WHERE rank = 'species'),
f AS (SELECT n.tax_id, n.rank, coalesce(sum(a / k), 0) AS a FROM nd n LEFT JOIN e2 ON parent = n.tax_id LEFT JOIN s ON s.tax_id = child LEFT JOIN k ON k.parent = n.tax_id WHERE n.rank = 'family' GROUP BY 1, 2),
b AS (SELECT * FROM s UNION ALL SELECT * FROM f),
r AS (SELECT n.tax_id, n.rank, coalesce(sum(a / k), 0) AS a FROM nd n LEFT JOIN e2 ON parent = n.tax_id LEFT JOIN b ON b.tax_id = child LEFT JOIN k ON k.parent = n.tax_id WHERE n.rank = 'superkingdom' GROUP BY 1, 2)
SELECT tax_id, rank, round(a, 6) AS abundance FROM (SELECT * FROM b UNION ALL SELECT * FROM r)""")
def rank_rollup(spark, sf):
    nodes, edges = _tree(spark, sf)
    far = t(spark, sf, "nation").select(_key("N", "n_nationkey").alias("parent"), _key("R", "n_regionkey").alias("top"))
    skips = F.col("child").startswith("C") & (F.try_to_number(F.substring("child", 2, 12), F.lit("999999999999")) % 3 == 0)
    edges = edges.join(far, "parent", "left").select("child", F.when(skips, F.col("top")).otherwise(F.col("parent")).alias("parent"))
    with_counts = nodes.join(_counts(spark, sf), "tax_id", "left").select("tax_id", "rank", F.coalesce("n", F.lit(0)).cast("double").alias("abundance"))
    return taxonomy.roll_up(with_counts, edges, ["species", "genus", "family", "order", "superkingdom"]).select("tax_id", "rank", F.round("abundance", 6).alias("abundance"))


# every top is its own parent, as in the usual taxonomy dumps
@query(f"WITH {_TREE} SELECT tax_id, rank, coalesce(parent, 'root') AS parent FROM nd LEFT JOIN ed ON tax_id = child")
def root_attach(spark, sf):
    nodes, edges = _tree(spark, sf)
    own = nodes.where("rank = 'superkingdom'").select(F.col("tax_id").alias("child"), F.col("tax_id").alias("parent"))
    return taxonomy.attach_root(nodes, edges.unionByName(own))


@query(f"WITH {_TREE} SELECT tax_id, CASE WHEN tax_id LIKE 'N%' THEN 'no rank' ELSE rank END AS rank FROM nd WHERE tax_id NOT LIKE 'C%' OR tax_id IN (SELECT child FROM ed)")
def missing_ancestors(spark, sf):
    nodes, edges = _tree(spark, sf)
    return taxonomy.with_missing(nodes.where("rank <> 'family'"), edges)


@query(f"WITH {_TREE} SELECT tax_id, CASE WHEN rank = 'family' THEN 'clade' ELSE rank END AS rank, round(CASE rank WHEN 'species' THEN 7 / 8.0 WHEN 'superkingdom' THEN 0.5 / 8 ELSE (0.5 / 8 + CASE WHEN tax_id IN (SELECT parent FROM ed) THEN 7 / 8.0 ELSE 1 END) / 2 END, 9) AS rank_value FROM nd")
def anchor_ranks(spark, sf):
    nodes, edges = _tree(spark, sf)
    nodes = nodes.select("tax_id", F.when(F.col("rank") == "family", "clade").otherwise(F.col("rank")).alias("rank"))
    return taxonomy.rank_values(nodes, edges).select("tax_id", "rank", F.round("rank_value", 9).alias("rank_value"))


_ND = "n AS (SELECT 'N' || n_nationkey AS tax_id, (1 + n_nationkey % 4)::DOUBLE AS radius, ((n_nationkey * n_nationkey) % 63) / 10.0::DOUBLE AS angle FROM nation)"


@query(f"WITH {_ND}, d AS (SELECT a.tax_id, b.tax_id AS parent, round((a.radius - b.radius) + least(abs(a.angle - b.angle), 2 * pi() - abs(a.angle - b.angle)) * a.radius, 9) AS d FROM n a JOIN n b ON b.radius < a.radius) SELECT tax_id, parent FROM (SELECT *, row_number() OVER (PARTITION BY tax_id ORDER BY d, parent) AS k FROM d) WHERE k = 1")
def nearest_parents(spark, sf):
    k = F.col("n_nationkey")
    n = t(spark, sf, "nation").select(_key("N", "n_nationkey").alias("tax_id"), (1 + k % 4).cast("double").alias("radius"), (k * k % 63 / 10.0).cast("double").alias("angle"))
    return taxonomy.nearest_parent(n, n)


_DEPTHS = ", ".join(f"('{r}', {v})" for r, v in taxonomy.RANKS.items())


@query(f"WITH {_TREE}, d(rank, depth) AS (VALUES {_DEPTHS}), e AS (SELECT DISTINCT lower(event_type) AS rank FROM events UNION SELECT rank FROM nd UNION SELECT CASE WHEN p_size % 2 = 0 THEN 'no rank' ELSE 'clade' END FROM part UNION SELECT CASE WHEN p_size > 25 THEN 'genus' ELSE 'strain' END FROM part) SELECT rank, row_number() OVER (ORDER BY CASE WHEN depth IS NOT NULL THEN 0 WHEN rank IN ('tribe', 'forma', 'clade', 'no rank') THEN 1 ELSE 2 END, coalesce(depth, 0), rank)::INT AS place FROM e LEFT JOIN d USING (rank)")
def legend_order(spark, sf):
    """Ranks of the tree, with other kinds that the tables name."""
    size, part = F.col("p_size"), t(spark, sf, "part")
    kinds = [F.when(size % 2 == 0, "no rank").otherwise("clade"), F.when(size > 25, "genus").otherwise("strain")]
    ranks = _tree(spark, sf)[0].select("rank").union(t(spark, sf, "events").select(F.lower("event_type")))
    for kind in kinds:
        ranks = ranks.union(part.select(kind))
    return taxonomy.legend(ranks)


_DFS = f"""{_TREE}, c AS (SELECT tax_id, [tax_id] AS path FROM nd WHERE rank = 'superkingdom' UNION ALL SELECT child, list_append(path, child) FROM c JOIN ed ON parent = tax_id),
o AS (SELECT tax_id, len(path)::INT AS level, row_number() OVER (ORDER BY path) - 1 AS dfs_order FROM c)"""


@query(f"WITH RECURSIVE {_DFS} SELECT tax_id, level, dfs_order::INT AS dfs_order FROM o")
def dfs_order(spark, sf):
    return taxonomy.depth_first(taxonomy.attach_root(*_tree(spark, sf))).select("tax_id", "level", F.col("dfs_order").cast("int").alias("dfs_order"))


@query(f"WITH RECURSIVE {_DFS}, l AS (SELECT tax_id, row_number() OVER (ORDER BY dfs_order) - 1 AS i, count(*) OVER () AS n FROM o WHERE level = 3) SELECT tax_id, round(i * 2 * pi() / n, 6) AS angle, round(8 * cos(i * 2 * pi() / n), 6) AS x, round(8 * sin(i * 2 * pi() / n), 6) AS y FROM l")
def leaf_angles(spark, sf):
    leaves = taxonomy.depth_first(taxonomy.attach_root(*_tree(spark, sf))).where("leaf_order IS NOT NULL AND level = 3")
    every = t(spark, sf, "customer").count()
    leaves = leaves.withColumn("a", F.col("leaf_order") * 2 * F.pi() / every)
    return leaves.select("tax_id", F.round("a", 6).alias("angle"), F.round(8 * F.cos("a"), 6).alias("x"), F.round(8 * F.sin("a"), 6).alias("y"))


@query(f"""WITH RECURSIVE {_DFS}, l0 AS (SELECT tax_id, level FROM o WHERE tax_id NOT IN (SELECT parent FROM ed)), l AS (SELECT tax_id, row_number() OVER (ORDER BY dfs_order) - 1 AS i, count(*) OVER () AS n FROM o WHERE tax_id IN (SELECT tax_id FROM l0)),
la AS (SELECT tax_id, i * 2 * pi() / n AS a FROM l), f0 AS (SELECT parent AS tax_id, a FROM la JOIN ed ON tax_id = child WHERE child LIKE 'C%'),
f1 AS (SELECT tax_id, min(a) AS lo, max(a) AS hi, min(CASE WHEN a > pi() THEN a - 2 * pi() ELSE a END) AS tlo, max(CASE WHEN a > pi() THEN a - 2 * pi() ELSE a END) AS thi FROM f0 GROUP BY 1),
f AS (SELECT tax_id, CASE WHEN hi - lo > pi() THEN (tlo + thi) / 2 + CASE WHEN tlo + thi < 0 THEN 2 * pi() ELSE 0 END ELSE (lo + hi) / 2 END AS a FROM f1),
g0 AS (SELECT parent AS tax_id, a FROM (SELECT * FROM f UNION ALL SELECT * FROM la WHERE tax_id LIKE 'N%') x JOIN ed ON x.tax_id = child),
g1 AS (SELECT tax_id, min(a) AS lo, max(a) AS hi, min(CASE WHEN a > pi() THEN a - 2 * pi() ELSE a END) AS tlo, max(CASE WHEN a > pi() THEN a - 2 * pi() ELSE a END) AS thi FROM g0 GROUP BY 1),
g AS (SELECT tax_id, CASE WHEN hi - lo > pi() THEN (tlo + thi) / 2 + CASE WHEN tlo + thi < 0 THEN 2 * pi() ELSE 0 END ELSE (lo + hi) / 2 END AS a FROM g1),
p AS (SELECT tax_id, a, level::DOUBLE AS radius FROM (SELECT * FROM la UNION ALL SELECT * FROM f UNION ALL SELECT * FROM g) JOIN o USING (tax_id))
SELECT tax_id, round(a, 6) AS angle, radius, round(radius * cos(a), 6) AS x, round(radius * sin(a), 6) AS y FROM p""")
def node_layout(spark, sf):
    rooted = taxonomy.attach_root(*_tree(spark, sf))
    level = F.when(F.col("rank") == "species", 3.0).when(F.col("rank") == "family", 2.0).otherwise(1.0)
    at = taxonomy.layout(rooted, rooted.select("tax_id", level.alias("radius")))
    return at.select("tax_id", F.round("angle", 6).alias("angle"), "radius", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"WITH {_TREE}, s AS (SELECT list_sort(list(n)) AS v, count(*) AS k FROM ct) SELECT tax_id, n, CASE WHEN n <= v[1 + floor(k * 0.25)::INT] THEN 1 WHEN n <= v[1 + floor(k * 0.5)::INT] THEN 2 WHEN n <= v[1 + floor(k * 0.75)::INT] THEN 3 ELSE 4 END AS quartile FROM ct, s")
def abundance_quartiles(spark, sf):
    return taxonomy.quartile_class(_counts(spark, sf), "n")


@query(f"WITH {_TREE}, st AS (SELECT 'C' || o_custkey AS tax_id, count(*) AS m FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1), b AS (SELECT 'C' || o_custkey AS tax_id, count(*) AS n FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1) SELECT tax_id, coalesce(m, n) AS abundance, CASE WHEN n IS NULL THEN 'new' WHEN m IS NULL THEN 'base' ELSE 'study' END AS class FROM b FULL JOIN st USING (tax_id)")
def study_overlay(spark, sf):
    base, study = _counts(spark, sf, "o_orderpriority <> '1-URGENT'"), _counts(spark, sf, "o_orderpriority = '1-URGENT'").withColumnRenamed("n", "m")
    kind = F.when(F.col("n").isNull(), "new").when(F.col("m").isNull(), "base").otherwise("study")
    return base.join(study, "tax_id", "full").select("tax_id", F.coalesce("m", "n").alias("abundance"), kind.alias("class"))


# ------------------------------------------------------------------ statistics
_ENR = """fr AS (SELECT c_mktsegment AS rank, 'C' || o_custkey AS tax_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
bk AS (SELECT c_mktsegment AS rank, 'C' || o_custkey AS tax_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
ft AS (SELECT rank, sum(n) AS t FROM fr GROUP BY 1), bt AS (SELECT rank, sum(bk.n) AS t FROM fr JOIN bk USING (rank, tax_id) GROUP BY 1),
en AS (SELECT fr.rank, fr.tax_id, fr.n AS front_count, coalesce(bk.n, 0) AS background_count, fr.n / ft.t AS ff, coalesce(bk.n, 0) / bt.t AS bf, ft.t AS tot FROM fr LEFT JOIN bk USING (rank, tax_id) JOIN ft USING (rank) JOIN bt USING (rank)),
pv AS (SELECT rank, tax_id, (('0x' || substr(md5(rank || '|' || tax_id), 1, 8))::BIGINT / 4294967296.0) AS p_value FROM fr),
ra AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY p_value, tax_id) AS rn, count(*) OVER (PARTITION BY rank) AS m, least(1.0, avg(CASE WHEN p_value >= 0.85 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY rank) / (1 - 0.85::DOUBLE)) AS pi0 FROM pv)"""


def _front_back(spark, sf):
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    of = lambda df: df.groupBy(F.col("c_mktsegment").alias("rank"), _key("C", "o_custkey").alias("tax_id")).agg(F.count(F.lit(1)).alias("n"))
    return of(o.where("o_orderpriority = '1-URGENT'")), of(o)


@query(f"WITH {_ENR} SELECT rank, tax_id, front_count, background_count, round(ff, 9) AS front_fraction, round(bf, 9) AS background_fraction, ceil(round(bf * tot, 9))::BIGINT AS expected_count, round(ff / greatest(bf, 1e-10), 6) AS enrichment FROM en")
def enrichment_stats(spark, sf):
    e = stats.enrichment(*_front_back(spark, sf))
    return e.select("rank", "tax_id", "front_count", "background_count", F.round("front_fraction", 9).alias("front_fraction"), F.round("background_fraction", 9).alias("background_fraction"),
                    "expected_count", F.round("enrichment", 6).alias("enrichment"))


def _p_values(spark, sf):
    return _front_back(spark, sf)[0].select("rank", "tax_id", stats.uniform(F.col("rank"), F.col("tax_id")).alias("p_value"))


@query(f"WITH {_ENR} SELECT rank, tax_id, round(least(1.0, min(p_value * m / rn) OVER (PARTITION BY rank ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)), 9) AS q_value FROM ra")
def bh_qvalue(spark, sf):
    return stats.benjamini_hochberg(_p_values(spark, sf), ["rank"]).select("rank", "tax_id", F.round("q_value", 9).alias("q_value"))


@query(f"WITH {_ENR}, q AS (SELECT rank, tax_id, least(1.0, min(p_value * m * pi0 / rn) OVER (PARTITION BY rank ORDER BY rn DESC ROWS UNBOUNDED PRECEDING)) AS q FROM ra) SELECT rank, tax_id, round(q, 9) AS q_value, round(-log10(CASE WHEN q = 0 THEN 1e-5 ELSE q END), 6) AS neg_log, q <= 0.05 AS significant FROM q")
def storey_qvalue(spark, sf):
    q = stats.storey(_p_values(spark, sf), ["rank"])
    return q.select("rank", "tax_id", F.round("q_value", 9).alias("q_value"), F.round(tx.neg_log10_q(F.col("q_value")), 6).alias("neg_log"), (F.col("q_value") <= 0.05).alias("significant"))


# ------------------------------------------------------------------ linking, passages
@query("""WITH nm AS (SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1), g AS (SELECT id, unnest(list_concat(string_split(name, ''), list_transform(range(1, length(name)), lambda x: substr(name, x, 2)))) AS term FROM nm),
tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), r AS (SELECT id, term, tf * (ln((1.0 + (SELECT count(*) FROM nm)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term))
SELECT id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)), 9) AS weight FROM r""")
def char_tfidf(spark, sf):
    return link.char_tfidf(_part_names(spark, sf).withColumnRenamed("ord", "id")).select("id", "term", F.round("weight", 9).alias("weight"))


@query("""WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 5""")
def hybrid_topk(spark, sf):
    e = t(spark, sf, "embeddings")
    return link.top_k(e, e.where("vec_id % 100 = 0"), 5).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query("SELECT conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS passage_offset FROM conversations")
def passage_offsets(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return t(spark, sf, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)).alias("passage_offset"))


@query("SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS title FROM conversations")
def carry_forward_title(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return t(spark, sf, "conversations").select("conv_id", "turn", F.last(F.when(F.col("turn") % 3 == 0, F.col("role")), ignorenulls=True).over(w).alias("title"))


@query("SELECT conv_id, min(turn) AS turn, text FROM conversations GROUP BY conv_id, text")
def dedup_passages(spark, sf):
    return t(spark, sf, "conversations").groupBy("conv_id", "text").agg(F.min("turn").alias("turn"))


# ------------------------------------------------------------------ titles, references, word rules
@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size || '.1. ' || p_name WHEN p_partkey % 3 = 1 THEN p_name ELSE p_size || ' ' || p_name END AS t FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(t, '^\\s*[0-9.,]*[0-9][0-9.,]*[.]\\s+\\S') THEN trim(regexp_replace(regexp_replace(t, '^\\s*[0-9.,]*[0-9][0-9.,]*[.]\\s+', ''), '\\s+', ' ', 'g')) ELSE t END AS title FROM s""")
def section_numbers(spark, sf):
    size, name, k = F.col("p_size").cast("string"), F.col("p_name"), F.col("p_partkey") % 3
    shown = F.when(k == 0, F.concat(size, F.lit(".1. "), name)).when(k == 1, name).otherwise(F.concat_ws(" ", size, name))
    return t(spark, sf, "part").select("p_partkey", tx.strip_section_number(shown).alias("title"))


@query("""SELECT p_partkey, concat_ws(' ', p_brand || '.', p_name || '.', p_type || '.', CASE WHEN p_size % 2 = 0 THEN '2020;' || p_size ELSE '2020' END || '.') AS citation,
 concat_ws('_', p_type, coalesce(CASE WHEN p_size % 2 = 0 THEN 'species' END, p_brand)) AS kind FROM part""")
def citations(spark, sf):
    even = F.col("p_size") % 2 == 0
    volume = F.when(even, F.col("p_size").cast("string"))
    return t(spark, sf, "part").select(
        "p_partkey", tx.citation(F.lit(""), F.col("p_brand"), F.col("p_name"), F.col("p_type"), F.lit("2020"), volume).alias("citation"),
        tx.identifier_type(F.col("p_type"), F.col("p_brand"), F.when(even, F.lit("species"))).alias("kind"),
    )


def _singular(w: str) -> str:
    return f"nullif(CASE WHEN {w} LIKE '%ae' THEN regexp_replace({w}, 'ae$', 'a') WHEN {w} LIKE '%i' THEN regexp_replace({w}, 'i$', 'us') WHEN {w} LIKE '%a' THEN regexp_replace({w}, 'a$', 'um') ELSE '' END, '')"


def _word_rules(case_sensitive: bool) -> str:
    low, word = ("", "nx") if case_sensitive else ("lower", "lower(next)")
    lex, big = (x.replace("lower(", f"{low}(") for x in (_LEX, _BIG))
    return f"""WITH {_TOK}, {lex}, {big}, a AS (SELECT doc_id, pos, start, next, {low}({_clean('w')}) AS one, {low}({_clean('next')}) AS nx FROM tok),
b AS (SELECT *, one || ' ' || nx AS two, one || ' ' || {_singular('nx')} AS two_s, {_singular('one')} AS one_s FROM a WHERE length(one) >= 1),
g AS (SELECT DISTINCT unnest(string_split(name, ' ')) AS one FROM big),
m AS (SELECT b.*, l1.tax_id AS i1, b1.tax_id AS i2, b2.tax_id AS i3, l2.tax_id AS i4, g.one IS NOT NULL AS begins FROM b LEFT JOIN lex l1 ON l1.name = b.one LEFT JOIN big b1 ON b1.name = two LEFT JOIN big b2 ON b2.name = two_s LEFT JOIN lex l2 ON l2.name = one_s LEFT JOIN g ON g.one = b.one),
r AS (SELECT *, CASE WHEN i1 IS NOT NULL THEN CASE WHEN i2 IS NOT NULL THEN 'pair' WHEN i3 IS NOT NULL THEN 'pair in the singular' WHEN {word} IN ('sp', 'spp', 'sp.', 'spp.') THEN 'species word' WHEN {word} IN ('genus', 'gen', 'gen.') THEN 'genus word' ELSE 'word' END
 WHEN begins AND next IS NOT NULL THEN CASE WHEN i2 IS NOT NULL THEN 'pair of an unlisted word' END WHEN i4 IS NOT NULL THEN 'word in the singular' END AS rule FROM m)
SELECT doc_id, pos::INT AS pos, start, CASE WHEN rule = 'pair in the singular' THEN two_s WHEN rule LIKE 'pair%' THEN two WHEN rule = 'word in the singular' THEN one_s ELSE one END AS name,
 CASE WHEN rule = 'pair in the singular' THEN i3 WHEN rule LIKE 'pair%' THEN i2 WHEN rule = 'word in the singular' THEN i4 ELSE i1 END AS tax_id, rule FROM r WHERE rule IS NOT NULL"""


@query(_word_rules(False))
def rule_matches(spark, sf):
    b = t(spark, sf, "benchmark")
    return annotate.rule_matches(annotate.tokens(t(spark, sf, "documents")), annotate.unigram_lexicon(b), annotate.bigram_lexicon(b))


@query(_word_rules(True))
def rule_matches_case_sensitive(spark, sf):
    b = t(spark, sf, "benchmark")
    uni, bi = annotate.unigram_lexicon(b, case_sensitive=True), annotate.bigram_lexicon(b, case_sensitive=True)
    return annotate.rule_matches(annotate.tokens(t(spark, sf, "documents")), uni, bi, case_sensitive=True)


# ------------------------------------------------------------------ model spans
@query("""WITH p AS (SELECT l_orderkey AS d, l_linenumber AS pos, l_suppkey % 4 = 0 AS cont, l_partkey % 3 AS label FROM (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS l_suppkey, max(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2)),
w AS (SELECT *, max(CASE WHEN NOT cont THEN pos END) OVER (PARTITION BY d ORDER BY pos) AS w0, min(pos) OVER (PARTITION BY d) AS lo, max(pos) OVER (PARTITION BY d) AS hi,
 min(CASE WHEN NOT cont THEN pos END) OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nw,
 max(CASE WHEN label = 1 THEN pos END) OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
 max(CASE WHEN label = 0 THEN pos END) OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM p)
SELECT w.d AS doc_id, coalesce(s.w0, s.lo) AS first, CASE WHEN w.cont THEN coalesce(w.nw, w.hi + 1) ELSE w.pos END AS stop FROM w JOIN w s ON s.d = w.d AND s.pos = w.b WHERE w.label = 0 AND (w.e IS NULL OR w.b > w.e)""")
def label_spans(spark, sf):
    p = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos")).agg(F.max("l_suppkey").alias("s"), F.max("l_partkey").alias("l"))
    return spans.decode_labels(p.select("doc_id", "pos", F.when(F.col("s") % 4 == 0, "##x").otherwise("x").alias("piece"), (F.col("l") % 3).alias("label")))


@query("""WITH n AS (SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents WHERE text IS NOT NULL), k AS (SELECT *, unnest(range(0, greatest(0, ceil((n - 512) / 462.0))::BIGINT + 1)) AS k FROM n)
SELECT doc_id, k * 462 AS first, least(n, k * 462 + 512) AS stop FROM k""")
def piece_windows(spark, sf):
    n = t(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.size(F.split("text", " ")).cast("long").alias("n"))
    return spans.piece_windows(n)


# ------------------------------------------------------------------ sampling and reports
@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 0 ORDER BY -ln(1 - ('0x' || substr(md5('11|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0) / o_totalprice, o_orderkey LIMIT 50")
def weighted_sample(spark, sf):
    return stats.weighted_sample(t(spark, sf, "orders"), "o_orderkey", "o_totalprice", 50, 11).select("o_orderkey")


@query()
def resampled_p_values(spark, sf):
    return stats.resampled_p_values(*_front_back(spark, sf))


@query("""WITH f AS (SELECT 'C' || o_custkey AS tax_id, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1), b AS (SELECT 'C' || o_custkey AS tax_id, count(*) AS m FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1),
s AS (SELECT f.tax_id, n, coalesce(m, 0) AS m, coalesce(c_name, '') AS name FROM f LEFT JOIN b USING (tax_id) LEFT JOIN customer ON tax_id = 'C' || c_custkey) SELECT *, row_number() OVER (ORDER BY n DESC, tax_id)::INT AS place FROM s ORDER BY place LIMIT 10""")
def top_report(spark, sf):
    f, b = _counts(spark, sf, "o_orderpriority = '1-URGENT'"), _counts(spark, sf, "o_orderpriority <> '1-URGENT'").withColumnRenamed("n", "m")
    named = t(spark, sf, "customer").groupBy(_key("C", "c_custkey").alias("tax_id")).agg(F.min("c_name").alias("name"))
    top = f.join(b, "tax_id", "left").join(named, "tax_id", "left").select("tax_id", "n", F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("name", F.lit("")).alias("name")).orderBy(F.col("n").desc(), "tax_id").limit(10)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "tax_id")))  # ten rows


@query("SELECT p_brand AS tax_id, arg_max(p_name, p_partkey) AS last_name, arg_max(p_type, p_retailprice * 1000000 + p_partkey) AS best FROM part GROUP BY 1")
def last_name_and_best(spark, sf):
    return t(spark, sf, "part").groupBy(F.col("p_brand").alias("tax_id")).agg(F.max_by("p_name", "p_partkey").alias("last_name"), F.max_by("p_type", F.col("p_retailprice") * 1000000 + F.col("p_partkey")).alias("best"))


# ------------------------------------------------------------------ sets, more of the tree
@query(f"WITH RECURSIVE {_TREE}, c AS (SELECT tax_id FROM ct UNION SELECT parent FROM c JOIN ed ON tax_id = child) SELECT tax_id, rank FROM nd WHERE tax_id IN (SELECT tax_id FROM c)")
def relevant_taxa(spark, sf):
    return taxonomy.relevant(*_tree(spark, sf), _counts(spark, sf))


@query(f"WITH {_TREE}, s AS (SELECT list_sort(list(n)) AS v, count(*) AS k FROM ct), q AS (SELECT tax_id, CASE WHEN n <= v[1 + floor(k * 0.25)::INT] THEN 1 WHEN n <= v[1 + floor(k * 0.5)::INT] THEN 2 WHEN n <= v[1 + floor(k * 0.75)::INT] THEN 3 ELSE 4 END AS c FROM ct, s) SELECT child, parent, coalesce(c, 0) AS class FROM ed LEFT JOIN q ON tax_id = child")
def edge_classes(spark, sf):
    return taxonomy.edge_classes(_tree(spark, sf)[1], abundance_quartiles(spark, sf))


@query("WITH a AS (SELECT 'N' || n_nationkey AS tax_id, round((n_nationkey * n_nationkey % 63) / 10.0, 6) AS angle FROM nation), b AS (SELECT *, CASE WHEN angle - lag(angle) OVER (ORDER BY angle, tax_id) < 0.4 THEN 0 ELSE 1 END AS new FROM a), c AS (SELECT *, sum(new) OVER (ORDER BY angle, tax_id ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM b) SELECT tax_id, angle, grp, row_number() OVER (PARTITION BY grp ORDER BY angle, tax_id)::INT AS place FROM c")
def angle_groups(spark, sf):
    k = F.col("n_nationkey")
    return taxonomy.angle_groups(t(spark, sf, "nation").select(_key("N", "n_nationkey").alias("tax_id"), F.round((k * k % 63) / 10.0, 6).alias("angle")))


_UD = "u AS (SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'), l AS (SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '5-LOW')"


@query(f"WITH {_UD} SELECT 'union' AS kind, id FROM (SELECT id FROM u UNION SELECT id FROM l) UNION ALL SELECT 'difference', id FROM (SELECT id FROM u EXCEPT SELECT id FROM l) UNION ALL SELECT 'both', id FROM (SELECT id FROM u INTERSECT SELECT id FROM l) UNION ALL SELECT 'all', id FROM (SELECT id FROM u UNION ALL SELECT id FROM l)")
def taxa_sets(spark, sf):
    of = lambda p: t(spark, sf, "orders").where(F.col("o_orderpriority") == p).select(F.col("o_custkey").alias("id"))
    u, low = of("1-URGENT"), of("5-LOW")
    parts = {"union": u.union(low).distinct(), "difference": u.distinct().join(low, "id", "left_anti"), "both": u.distinct().join(low, "id", "left_semi"), "all": u.union(low)}
    out = None
    for kind, df in parts.items():
        df = df.select(F.lit(kind).alias("kind"), "id")
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT l_orderkey AS doc_id, string_agg(p_name, '|' ORDER BY l_linenumber, p_partkey) AS taxa, count(DISTINCT p_name)::INT AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def taxa_per_document(spark, sf):
    m = t(spark, sf, "lineitem").join(t(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    taxa = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_partkey", "p_name"))), lambda s: s["p_name"])
    return m.groupBy(F.col("l_orderkey").alias("doc_id")).agg(taxa.alias("taxa")).select("doc_id", F.array_join("taxa", "|").alias("taxa"), F.size(F.array_distinct("taxa")).alias("n"))


# ------------------------------------------------------------------ ambiguous names, hybrid scores, small functions
@query("""WITH l AS (SELECT p_name AS name, list(p_partkey ORDER BY p_partkey) AS ids, list(p_type || '_' || p_brand ORDER BY p_partkey) AS kinds, list(p_type ORDER BY p_partkey) AS tops FROM part GROUP BY 1),
m AS (SELECT DISTINCT p_name AS name, CASE WHEN length(p_name) % 3 = 0 THEN 'species' END AS modifier FROM part)
SELECT name, modifier, CASE WHEN len(ids) > 1 AND modifier IS NULL THEN array_to_string(ids, ',') WHEN modifier IS NULL THEN ids[1]::VARCHAR ELSE ids[len(ids)]::VARCHAR END AS identifier,
 CASE WHEN modifier IS NULL THEN array_to_string(kinds, ',') ELSE tops[len(tops)] || '_species' END AS types, len(ids) > 1 AND modifier IS NULL AS ambiguous FROM l JOIN m USING (name)""")
def ambiguous_identifiers(spark, sf):
    p = t(spark, sf, "part")
    lexicon = p.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("tax_id"), F.col("p_type").alias("kingdom"), F.col("p_brand").alias("rank"), F.col("p_partkey").alias("ord"))
    matches = p.select(F.col("p_name").alias("name"), F.when(F.length("p_name") % 3 == 0, "species").alias("modifier")).distinct()
    out = annotate.identify(matches, lexicon)
    return out.select("name", "modifier", F.array_join(F.col("identifier").cast("array<string>"), ",").alias("identifier"), F.array_join("types", ",").alias("types"), "ambiguous")


@query("""WITH v AS (SELECT vec_id AS id, p_name AS name, embedding FROM embeddings JOIN part ON p_partkey = vec_id),
g AS (SELECT id, unnest(list_concat(string_split(name, ''), list_transform(range(1, length(name)), lambda x: substr(name, x, 2)))) AS term FROM v),
tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), r AS (SELECT id, term, tf * (ln((1.0 + (SELECT count(*) FROM v)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term)),
w AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS w FROM r),
s AS (SELECT a.id AS query_id, b.id, sum(a.w * b.w) AS s FROM w a JOIN w b USING (term) WHERE a.id % 100 = 0 GROUP BY 1, 2),
d AS (SELECT q.id AS query_id, v.id, list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) AS d FROM v q, v WHERE q.id % 100 = 0),
h AS (SELECT query_id, id, 0.5 * coalesce(s, 0) + d AS score FROM d LEFT JOIN s USING (query_id, id))
SELECT query_id, id, name, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM h) JOIN v USING (id) WHERE rank <= 5""")
def sparse_dense_topk(spark, sf):
    """Part names with the given vectors; every row whose id 100 divides asks for its candidates among all."""
    rows = t(spark, sf, "embeddings").join(t(spark, sf, "part"), F.col("p_partkey") == F.col("vec_id")).select(F.col("vec_id").alias("id"), F.col("p_name").alias("name"), F.col("embedding").alias("dense"))
    encoder = candidates.fit(rows)
    known = candidates.encode(rows, encoder)
    found = candidates.top_candidates(spark, known, known.where("id % 100 = 0").withColumnRenamed("id", "query_id"), 5, 0.5)
    return found.select("query_id", "id", "name", F.round("score", 6).alias("score"), "rank")


@query("""SELECT conv_id, turn, length(text) >= 6 AND text NOT IN ('', ' ') AS kept, upper(substr(role, 1, 1)) || substr(role, 2) || ' turn' AS title,
 CASE WHEN turn % 2 = 0 THEN 'role=' || role || ';turn=' || turn ELSE 'role=' || role END AS infons, round(CASE WHEN d > 90 AND d < 270 THEN d + 180 ELSE d END, 6) AS rotation, 8 + 0.3 * (turn % 3) AS distance
 FROM (SELECT *, (turn * 37 % 360)::DOUBLE AS d FROM conversations) WHERE text IS NOT NULL AND role IS NOT NULL""")
def passage_helpers(spark, sf):
    c = t(spark, sf, "conversations").where("text IS NOT NULL AND role IS NOT NULL")
    rotation, distance = tx.label_place(F.col("turn") * 37 % 360 * F.pi() / 180, F.lit(8.0), F.col("turn"))
    shown = tx.infons(role=F.col("role"), turn=F.when(F.col("turn") % 2 == 0, F.col("turn")))
    return c.select(
        "conv_id", "turn", tx.kept_passage(F.col("text"), 6).alias("kept"), tx.capitalised(F.col("role"), F.lit("turn")).alias("title"),
        F.array_join(F.transform(F.map_entries(shown), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("infons"), F.round(rotation, 6).alias("rotation"), distance.alias("distance"),
    )


@query("SELECT doc_id, text AS unescaped, text AS repaired FROM documents")
def text_repair(spark, sf):
    """Texts that were escaped, and texts that were read in the wrong encoding, come back whole."""
    d = t(spark, sf, "documents")
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return d.select("doc_id", tx.unescape(F.replace("text", F.lit("e"), F.lit("\\u0065"))).alias("unescaped"), tx.fix_mojibake(damaged).alias("repaired"))


# ------------------------------------------------------------------ typos
@query("""WITH ty AS (SELECT DISTINCT w AS typo, CASE WHEN length(w) % 5 = 0 THEN '' ELSE substr(w, 1, 3) END AS correction FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE length(w) >= 6),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'), lambda x: x <> '') AS ws FROM documents)),
c AS (SELECT doc_id, string_agg(coalesce(correction, w), ' ' ORDER BY pos) AS name FROM w LEFT JOIN ty ON typo = w GROUP BY 1)
SELECT d.doc_id, trim(regexp_replace(coalesce(c.name, lower(d.text)), '[\\s!-,/:-@\\[-`{-~.]+', ' ', 'g')) AS name FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id""")
def typo_correction(spark, sf):
    """Long words of the benchmark as typos of their beginnings, in all documents; hyphens stay."""
    w = t(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("typo")).where("length(typo) >= 6").distinct()
    known = w.select("typo", F.when(F.length("typo") % 5 == 0, "").otherwise(F.substring("typo", 1, 3)).alias("correction"))
    return typos.preprocess(t(spark, sf, "documents").select("doc_id", F.col("text").alias("name")), "name", known, ignore="-")


# ------------------------------------------------------------------ anchors, corpora
@query(f"""WITH s AS (SELECT DISTINCT 'S' || c_nationkey || c_mktsegment AS tax_id, c_nationkey AS n, c_mktsegment AS m FROM customer),
so AS (SELECT tax_id, n, row_number() OVER (ORDER BY n, m) AS ord FROM s), sc AS (SELECT 'S' || c_nationkey || c_mktsegment AS seg, 'C' || min(c_custkey) AS first FROM customer GROUP BY 1),
nf AS (SELECT 'N' || n AS tax_id, arg_min(first, ord) AS first FROM so JOIN sc ON seg = tax_id GROUP BY 1),
v AS (SELECT 'C' || c_custkey AS tax_id, 7.0 / 8 AS rank_value, 'S' || c_nationkey || c_mktsegment AS p0 FROM customer UNION ALL SELECT tax_id, (0.5 / 8 + 7.0 / 8) / 2, 'R' || n_regionkey FROM so JOIN nation ON n_nationkey = n
 UNION ALL SELECT 'N' || n_nationkey, (0.5 / 8 + CASE WHEN 'N' || n_nationkey IN (SELECT tax_id FROM nf) THEN 7.0 / 8 ELSE 1 END) / 2, 'R' || n_regionkey FROM nation UNION ALL SELECT 'R' || r_regionkey, 0.5 / 8, NULL FROM region)
SELECT v.tax_id, round(rank_value, 9) AS rank_value, coalesce(nf.tax_id, p0) AS parent FROM v LEFT JOIN nf ON nf.first = v.tax_id""")
def anchor_rewiring(spark, sf):
    """Regions, nations (clades), their market segments (no rank), customers; segments are taken first, then nations."""
    c, seg = t(spark, sf, "customer"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment"))
    segments = c.select(seg.alias("tax_id"), "c_nationkey", "c_mktsegment").distinct()
    at = F.row_number().over(Window.orderBy("c_nationkey", "c_mktsegment"))  # five a nation
    n, r = t(spark, sf, "nation"), t(spark, sf, "region")
    big = lambda i, key: (F.lit(i * 10**10) + F.col(key)).cast("long")
    nodes = (
        segments.select("tax_id", F.lit("no rank").alias("rank"), at.cast("long").alias("ord")).union(n.select(_key("N", "n_nationkey"), F.lit("clade"), big(1, "n_nationkey")))
        .union(c.select(_key("C", "c_custkey"), F.lit("species"), big(2, "c_custkey"))).union(r.select(_key("R", "r_regionkey"), F.lit("superkingdom"), big(3, "r_regionkey")))
    )
    edges = c.select(_key("C", "c_custkey").alias("child"), seg.alias("parent")).union(segments.select("tax_id", _key("N", "c_nationkey"))).union(n.select(_key("N", "n_nationkey"), _key("R", "n_regionkey")))
    values, after = rewiring.rewire(nodes, edges)
    return values.join(after.select(F.col("child").alias("tax_id"), "parent"), "tax_id", "left").select("tax_id", F.round("rank_value", 9).alias("rank_value"), "parent")


_CORPORA = f"""{_DFS}, m AS (SELECT o_orderpriority AS corpus, 'C' || o_custkey AS tax_id FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
c1 AS (SELECT corpus, tax_id, count(*) AS n FROM m GROUP BY 1, 2), k AS (SELECT parent, count(*) AS kids FROM ed GROUP BY 1),
c2 AS (SELECT corpus, e.parent AS tax_id, sum(n * (1.0::DOUBLE / kids)) AS a FROM c1 JOIN ed e ON child = tax_id JOIN k ON k.parent = e.parent GROUP BY 1, 2),
c3 AS (SELECT corpus, e.parent AS tax_id, sum(a * (1.0::DOUBLE / kids)) AS a FROM c2 JOIN ed e ON child = tax_id JOIN k ON k.parent = e.parent GROUP BY 1, 2),
al AS (SELECT corpus, tax_id, 'species' AS rank, n, n::DOUBLE AS abundance FROM c1 UNION ALL SELECT corpus, tax_id, 'family', 0, a FROM c2 UNION ALL SELECT corpus, tax_id, 'superkingdom', 0, a FROM c3),
rd AS (SELECT corpus, tax_id, rank, n, round(abundance, 9) AS abundance FROM al), st AS (SELECT corpus, list_sort(list(abundance)) AS v, count(*) AS z FROM rd GROUP BY 1),
qu AS (SELECT rd.*, CASE WHEN abundance <= v[1 + floor(z * 0.25)::INT] THEN 1 WHEN abundance <= v[1 + floor(z * 0.5)::INT] THEN 2 WHEN abundance <= v[1 + floor(z * 0.75)::INT] THEN 3 ELSE 4 END AS quartile FROM rd JOIN st USING (corpus))"""


def _corpora(spark, sf):
    o = t(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
    nodes, edges = _tree(spark, sf)
    loaded = corpora.load_corpora(nodes, edges, o.select(F.col("o_orderpriority").alias("corpus"), _key("C", "o_custkey").alias("tax_id")), ["species", "family", "superkingdom"])
    return corpora.quartiles(loaded.withColumn("abundance", F.round("abundance", 9))), nodes, edges


@query(f"WITH RECURSIVE {_CORPORA}, lv AS (SELECT tax_id, row_number() OVER (ORDER BY dfs_order) - 1 AS i, count(*) OVER () AS z FROM o WHERE tax_id NOT IN (SELECT parent FROM ed)) SELECT corpus, tax_id, rank, n, abundance, quartile, round(i * 2 * pi() / z, 6) AS angle, CASE WHEN i IS NULL THEN NULL ELSE 3.0 END AS radius FROM qu LEFT JOIN lv USING (tax_id) WHERE rank = 'species'")
def corpora_on_one_layout(spark, sf):
    """Orders of three priorities as corpora, on the layout of the whole tree; the leaves' places."""
    loaded, nodes, edges = _corpora(spark, sf)
    rooted = taxonomy.attach_root(nodes, edges)
    level = F.when(F.col("rank") == "species", 3.0).when(F.col("rank") == "family", 2.0).otherwise(1.0)
    radii = rooted.select("tax_id", level.alias("radius"))
    out = corpora.placed(loaded, edges, taxonomy.layout(rooted, radii), radii).where("rank = 'species'")
    return out.select("corpus", "tax_id", "rank", "n", "abundance", "quartile", F.round("angle", 6).alias("angle"), "radius")


@query(f"WITH RECURSIVE {_CORPORA}, hi AS (SELECT *, v[1 + floor(z * 0.75)::INT] AS third FROM rd JOIN st USING (corpus)), pl AS (SELECT corpus, tax_id, abundance, row_number() OVER (PARTITION BY corpus ORDER BY abundance DESC, tax_id)::INT AS place FROM hi WHERE abundance >= third) SELECT * FROM pl WHERE place <= 10")
def corpora_labels(spark, sf):
    return corpora.labels(_corpora(spark, sf)[0]).select("corpus", "tax_id", "abundance", "place")
