"""Anchors of a tree: what their order does to it, by rounds.

Anchors (taxa whose rank has no depth of its own) are taken one after the other. Each takes its nearest ranked ancestor as its parent, and the
first ranked taxon below it, breadth first, as a child; that child hangs from it from then on, so an anchor above that comes later finds
it a step below. What an anchor finds therefore depends on earlier anchors below it, with no ranked taxon between, and on nothing else: in each
round all anchors are settled whose earlier ones are, each by one comparison of what is still as it was and of what those have found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut
from spanloom.operators.taxonomy import ANCHOR_RANKS, RANKS, closure


def rewire(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """tax_id, rank, rank_value of all nodes, and the edges (child, parent) afterwards.

    nodes: tax_id, rank, ord (the order, no two alike); edges: child, parent, a child once, no self-parents and no circles. A ranked taxon's value is
    its depth over the deepest one's; an anchor's is the mean of its ranked ancestor's (none: 0) and of the ranked taxon's that it found (none: 1); others
    have none. An anchor without a ranked ancestor hangs from its topmost one. Of several anchors that find one taxon it stays with the last. A null rank is
    'no rank'.
    """
    depth = F.create_map(*[x for r, v in RANKS.items() for x in (F.lit(r), F.lit(v / max(RANKS.values())))])
    told = cut(nodes.select("tax_id", F.coalesce(F.lower("rank"), F.lit("no rank")).alias("rank"), "ord").withColumn("own", F.try_element_at(depth, F.col("rank"))))
    anchor = F.col("own").isNull() & F.col("rank").isin(*ANCHOR_RANKS)
    kids = edges.join(told.select(F.col("tax_id").alias("child"), "ord"), "child")
    kids = cut(kids.withColumn("nth", F.row_number().over(Window.partitionBy("parent").orderBy("ord"))).select("child", "parent", "nth"))
    far = cut(closure(kids.select("child", "parent", F.lit(1.0).alias("weight"))).select("tax_id", "ancestor", "distance"))

    # a node's place: the numbers of its lineage among their siblings, from the top
    own = kids.select(F.col("child").alias("tax_id"), F.lit(0).alias("distance"), "nth")
    steps = far.join(kids.select(F.col("child").alias("ancestor"), "nth"), "ancestor").select("tax_id", "distance", "nth").unionByName(own)
    places = steps.groupBy("tax_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("distance", "nth")), asc=False), lambda x: x["nth"]).alias("place"))
    places = cut(told.select("tax_id").join(places, "tax_id", "left").select("tax_id", F.coalesce("place", F.array().cast("array<int>")).alias("place")))

    # above: the nearest ranked ancestor, or the topmost one
    values = told.select(F.col("tax_id").alias("ancestor"), F.col("own").alias("value"))
    anchors = cut(told.where(anchor).select("tax_id", "ord"))
    up = far.join(anchors.select("tax_id"), "tax_id", "left_semi").join(values, "ancestor")
    top = F.max_by("ancestor", "distance")
    ranked = F.when(F.col("value").isNotNull(), F.struct("distance", "ancestor", "value"))
    above = up.groupBy("tax_id").agg(F.min(ranked).alias("near"), top.alias("top"))
    above = above.select("tax_id", F.coalesce("near.ancestor", "top").alias("parent"), F.col("near.value").alias("above"))

    # below: pairs of an anchor and an unranked node with none ranked between, the anchor itself among them
    open_ = told.where("own IS NULL").select("tax_id")
    inner = kids.join(open_.withColumnRenamed("tax_id", "child"), "child", "left_semi").join(open_.withColumnRenamed("tax_id", "parent"), "parent", "left_semi")
    below = closure(inner.select("child", "parent", F.lit(1.0).alias("weight"))).select(F.col("ancestor").alias("tax_id"), F.col("tax_id").alias("via"), "distance")
    below = cut(below.join(anchors.select("tax_id"), "tax_id", "left_semi"))
    earlier = below.join(anchors, "tax_id").join(anchors.select(F.col("tax_id").alias("via"), F.col("ord").alias("before")), "via").where("before < ord").select("tax_id", "via", "distance")
    earlier = cut(earlier)
    # of the earlier anchors those count that have no other earlier one above them; what lies below one is seen through it alone
    hidden = earlier.select("tax_id", F.col("via").alias("mid")).join(below.select(F.col("tax_id").alias("mid"), "via"), "mid").select("tax_id", "via").distinct()
    first = cut(earlier.join(hidden, ["tax_id", "via"], "left_anti"))
    seen = below.join(hidden, ["tax_id", "via"], "left_anti").join(first, ["tax_id", "via"], "left_anti").unionByName(anchors.select("tax_id", F.col("tax_id").alias("via"), F.lit(0).alias("distance")))
    direct = kids.join(told.where("own IS NOT NULL").select(F.col("tax_id").alias("child"), F.col("own").alias("value")), "child").join(places.withColumnRenamed("tax_id", "child"), "child")
    plain = seen.join(direct.select(F.col("parent").alias("via"), "child", "value", "place"), "via")
    plain = plain.groupBy("tax_id").agg(F.min(F.struct((F.col("distance") + 1).alias("depth"), "place", "child", "value")).alias("plain"))
    through = places.select(F.col("tax_id").alias("via"), F.concat("place", F.array(F.lit(2**31 - 1))).alias("place"))
    first = cut(first.join(through, "via").select("tax_id", "via", (F.col("distance") + 1).alias("depth"), "place"))

    # rounds
    state = cut(anchors.join(plain, "tax_id", "left"))
    waiting = first.groupBy("tax_id").agg(F.count(F.lit(1)).alias("waits"))
    done = cut(state.join(waiting, "tax_id", "left_anti").select("tax_id", F.col("plain.child").alias("child"), F.col("plain.value").alias("value")))
    rest = cut(state.join(waiting, "tax_id"))
    while rest.limit(1).count():
        met = first.join(rest.select("tax_id"), "tax_id", "left_semi").join(done.withColumnRenamed("tax_id", "via"), "via")
        found = F.min(F.when(F.col("child").isNotNull(), F.struct("depth", "place", "child", "value"))).alias("found")
        ready = rest.join(met.groupBy("tax_id").agg(F.count(F.lit(1)).alias("known"), found), "tax_id").where("known = waits")
        best = F.least("plain", "found")
        new = cut(ready.select("tax_id", best["child"].alias("child"), best["value"].alias("value")))
        done = cut(done.unionByName(new))
        rest = cut(rest.join(new.select("tax_id"), "tax_id", "left_anti"))

    settled = cut(anchors.join(above, "tax_id", "left").join(done, "tax_id"))
    mean = (F.coalesce("above", F.lit(0.0)) + F.coalesce("value", F.lit(1.0))) / 2
    out = told.join(settled.select("tax_id", mean.alias("mean")), "tax_id", "left").select("tax_id", "rank", F.coalesce("own", "mean").alias("rank_value"))
    taken = settled.where("child IS NOT NULL").groupBy("child").agg(F.max_by("tax_id", "ord").alias("parent"))
    moved = settled.where("parent IS NOT NULL").select(F.col("tax_id").alias("child"), "parent").unionByName(taken)
    return out, edges.select("child", "parent").join(moved.select("child"), "child", "left_anti").unionByName(moved)
