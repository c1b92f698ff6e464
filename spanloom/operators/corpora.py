"""Many corpora on one tree and one layout: the corpus is a column from the counts to the placement.

What belongs to the tree - lineages, shares passed up, places - is computed once; each corpus is rows of its own in the aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut
from spanloom.operators.taxonomy import ancestors, reuse_layout, shares


def load_corpora(nodes: DataFrame, edges: DataFrame, ids: DataFrame, levels: list[str]) -> DataFrame:
    """corpus, tax_id, rank, n, abundance: of each corpus (corpus, tax_id, a row a mention) the taxa that it names and all above them.

    n: mentions; abundance: with what lower ranks pass up (taxonomy.roll_up). Ids that are no node, and a null corpus or id, are left out; ends of edges
    that are no node are 'no rank'. A corpus without a known id has no rows.
    """
    counts = ids.where("corpus IS NOT NULL AND tax_id IS NOT NULL").groupBy("corpus", "tax_id").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts.join(nodes.select("tax_id"), "tax_id", "left_semi"))
    way = ancestors(edges, counts.select("tax_id").distinct()).select("tax_id", F.col("ancestor"))
    named = counts.join(way, "tax_id").select("corpus", F.col("ancestor").alias("tax_id")).distinct()
    more = counts.join(shares(nodes, edges, levels), "tax_id").groupBy("corpus", F.col("ancestor").alias("tax_id")).agg(F.sum(F.col("weight") * F.col("n")).alias("more"))
    ranks = nodes.select("tax_id", F.coalesce("rank", F.lit("no rank")).alias("rank"))
    out = named.join(counts, ["corpus", "tax_id"], "left").join(more, ["corpus", "tax_id"], "left").join(ranks, "tax_id", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("corpus", "tax_id", F.coalesce("rank", F.lit("no rank")).alias("rank"), n.alias("n"), (n + F.coalesce("more", F.lit(0.0))).alias("abundance"))


def quartiles(loaded: DataFrame, value: str = "abundance") -> DataFrame:
    """``loaded`` with quartile 1 to 4 of the value within its corpus, by nearest-rank quartiles (sorted[int(n * q)]).

    Values are counted first; a corpus's different values are what is ordered.
    """
    steps = loaded.groupBy("corpus", value).agg(F.count(F.lit(1)).alias("rows"))
    by = Window.partitionBy("corpus").orderBy(value)
    steps = steps.withColumn("upto", F.sum("rows").over(by)).withColumn("all", F.sum("rows").over(Window.partitionBy("corpus")))
    at = [F.min(F.when(F.col("upto") > F.floor(F.col("all") * q), F.col(value))).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75), 1)]
    limits = steps.groupBy("corpus").agg(*at)
    v = F.col(value)
    return loaded.join(limits, "corpus").withColumn("quartile", F.when(v <= F.col("q1"), 1).when(v <= F.col("q2"), 2).when(v <= F.col("q3"), 3).otherwise(4)).drop("q1", "q2", "q3")


def placed(loaded: DataFrame, edges: DataFrame, master: DataFrame, radii: DataFrame) -> DataFrame:
    """``loaded`` with angle, radius, x, y of one layout: ``master`` (tax_id, angle, radius, as taxonomy.layout gives or sources.store keeps it), grown for
    taxa that it lacks (taxonomy.reuse_layout; radii: tax_id, radius). A taxon is placed once, whatever corpora have it; one that can't be placed has nulls."""
    each = loaded.select("tax_id").distinct().join(radii, "tax_id", "left")
    at = reuse_layout(each, edges, master)
    return loaded.join(at, "tax_id", "left")


def labels(loaded: DataFrame, top: int = 10, least: float | None = None) -> DataFrame:
    """The ``top`` most abundant taxa of each corpus that reach a threshold, with their place: ``least``, or else the corpus's third quartile of the
    abundances above zero. Of equal ones the least ids."""
    some = loaded.where("abundance > 0")
    if least is not None:
        some = some.where(F.col("abundance") >= least)
    else:
        counted = some.groupBy("corpus", "abundance").agg(F.count(F.lit(1)).alias("rows"))
        upto = F.sum("rows").over(Window.partitionBy("corpus").orderBy("abundance"))
        whole = F.sum("rows").over(Window.partitionBy("corpus"))
        third = counted.withColumn("upto", upto).withColumn("whole", whole).where("upto > floor(whole * 0.75)").groupBy("corpus").agg(F.min("abundance").alias("third"))
        some = some.join(third, "corpus").where("abundance >= third").drop("third")
    place = F.row_number().over(Window.partitionBy("corpus").orderBy(F.col("abundance").desc(), "tax_id"))
    return some.withColumn("place", place).where(F.col("place") <= top)
