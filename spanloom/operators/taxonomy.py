"""Taxonomy: edges(child, parent), nodes(tax_id, rank), counts rolled up a forest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut

#: The depth of each rank, and the ranks that have none of their own.
RANKS = {
    "superkingdom": 0.5, "kingdom": 1.0, "subkingdom": 1.5, "phylum": 2.0, "subphylum": 2.5, "class": 3.0, "subclass": 3.5, "order": 4.0, "suborder": 4.5,
    "superfamily": 4.75, "family": 5.0, "subfamily": 5.5, "genus": 6.0, "subgenus": 6.5, "section": 6.7, "species group": 6.8, "species": 7.0, "subspecies": 7.5, "strain": 8.0,
}
ANCHOR_RANKS = ("tribe", "forma", "clade", "no rank")


def closure(edges: DataFrame) -> DataFrame:
    """child, parent, weight -> tax_id, ancestor, distance (1 and more), weight (the product along the way), for any depth.

    Each round doubles the distance that is known, so a lineage of n levels takes log2(n) rounds, each one join of what is known with itself.
    A lineage that comes back to itself is an error.
    """
    known = cut(edges.select(F.col("child").alias("tax_id"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance"), "weight"))
    reach = 1
    while True:
        far = known.where(F.col("distance") == reach).select("tax_id", F.col("ancestor").alias("via"), F.col("weight").alias("w"))
        more = known.select(F.col("tax_id").alias("via"), "ancestor", (F.col("distance") + reach).alias("distance"), "weight")
        found = cut(far.join(more, "via").select("tax_id", "ancestor", "distance", (F.col("w") * F.col("weight")).alias("weight")))
        if not found.limit(1).count():
            return known
        if found.where("tax_id = ancestor").limit(1).count():
            raise ValueError("a lineage comes back to itself")
        known, reach = known.unionByName(found), 2 * reach


def ancestors(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """tax_id, ancestor, distance for every id, itself first; self-parents are no edges."""
    far = closure(edges.where("child <> parent").select("child", "parent", F.lit(1.0).alias("weight"))).select("tax_id", "ancestor", "distance")
    ids = ids.select("tax_id")
    return ids.select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(0).alias("distance")).unionByName(far.join(ids.distinct(), "tax_id", "left_semi"))


def shares(nodes: DataFrame, edges: DataFrame, levels: list[str]) -> DataFrame:
    """tax_id, ancestor, weight: what of a taxon's count its ancestors take (see roll_up), as a product along the way."""
    place = F.create_map(*[x for i, r in enumerate(levels) for x in (F.lit(r), F.lit(i))])  # 0: the deepest
    known = nodes.select("tax_id", place[F.col("rank")].alias("level")).where("level IS NOT NULL")
    kids = edges.groupBy("parent").agg(F.count(F.lit(1)).alias("kids"))
    steps = edges.where("child <> parent").join(kids, "parent").join(known.select(F.col("tax_id").alias("child"), F.col("level").alias("low")), "child")
    steps = steps.join(known.select(F.col("tax_id").alias("parent"), F.col("level").alias("high")), "parent").where(F.col("low") < len(levels) - 1)
    steps = steps.select("child", "parent", (1.0 / F.col("kids")).alias("weight"), (F.col("high") > F.col("low")).alias("up"))
    way = closure(steps.where("up")).select("tax_id", "ancestor", "weight")
    start = known.select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(1.0).alias("weight"))
    last = start.unionByName(way).join(steps.where("NOT up").select(F.col("child").alias("ancestor"), "parent", F.col("weight").alias("w")), "ancestor")
    return way.unionByName(last.select("tax_id", F.col("parent").alias("ancestor"), (F.col("weight") * F.col("w")).alias("weight")))


def roll_up(nodes: DataFrame, edges: DataFrame, levels: list[str]) -> DataFrame:
    """Deepest rank first, every taxon adds abundance / number of the parent's children to its parent, whatever ranks lie between.

    The top rank adds to nothing. A parent of an equal or deeper rank takes its share and passes nothing on of it; one whose rank is not in levels
    takes none. So a taxon's share of an ancestor is a product along the way, and the whole is one aggregation.
    """
    way = shares(nodes, edges, levels)
    more = way.join(nodes.select("tax_id", "abundance"), "tax_id").groupBy(F.col("ancestor").alias("tax_id")).agg(F.sum(F.col("weight") * F.col("abundance")).alias("more"))
    return nodes.where(F.col("rank").isin(*levels)).join(more, "tax_id", "left").select("tax_id", "rank", (F.col("abundance") + F.coalesce("more", F.lit(0.0))).alias("abundance"))


def attach_root(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every node's parent; those without a known one, and those that are their own, hang from 'root'."""
    known = nodes.select(F.col("tax_id").alias("parent"), F.lit(True).alias("known"))
    joined = nodes.join(edges, F.col("tax_id") == F.col("child"), "left").join(known, "parent", "left")
    return joined.select("tax_id", "rank", F.when(F.col("known") & (F.col("parent") != F.col("tax_id")), F.col("parent")).otherwise(F.lit("root")).alias("parent"))


def depth_first(rooted: DataFrame) -> DataFrame:
    """tax_id, level from 1, dfs_order from 0, and leaf_order from 0 (null for inner nodes): each node before its children, siblings by name.

    A node's number is its parent's, one, and the sizes of the subtrees of earlier siblings: sizes are counts over the lineages, what a node
    adds is a running sum among its siblings, and a number is the sum of that along a lineage. No task orders all nodes.
    """
    far = cut(closure(rooted.where("parent <> 'root'").select(F.col("tax_id").alias("child"), "parent", F.lit(1.0).alias("weight"))).select("tax_id", "ancestor"))
    inner = rooted.select(F.col("parent").alias("tax_id")).distinct().withColumn("inner", F.lit(True))
    told = rooted.select("tax_id", "parent").join(inner, "tax_id", "left").withColumn("leaf", F.col("inner").isNull().cast("long")).drop("inner")
    way = far.unionByName(rooted.select("tax_id", F.col("tax_id").alias("ancestor")))
    sizes = way.join(told.select("tax_id", "leaf"), "tax_id").groupBy(F.col("ancestor").alias("tax_id")).agg(F.count(F.lit(1)).alias("size"), F.sum("leaf").alias("leaves"))
    siblings = Window.partitionBy("parent").orderBy("tax_id").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(siblings), F.lit(0))
    added = told.join(sizes, "tax_id").select(F.col("tax_id").alias("ancestor"), (before("size") + 1).alias("nodes"), before("leaves").alias("leaves"))
    sums = way.join(added, "ancestor").groupBy("tax_id").agg(F.count(F.lit(1)).cast("int").alias("level"), (F.sum("nodes") - 1).alias("dfs_order"), F.sum("leaves").alias("before"))
    return sums.join(told.select("tax_id", "leaf"), "tax_id").select("tax_id", "level", "dfs_order", F.when(F.col("leaf") == 1, F.col("before")).alias("leaf_order"))


def with_missing(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """tax_id, rank: the nodes, and as 'no rank' every end of an edge that is none of them."""
    ends = edges.select(F.col("child").alias("tax_id")).union(edges.select("parent")).distinct()
    return nodes.select("tax_id", "rank").unionByName(ends.join(nodes, "tax_id", "left_anti").select("tax_id", F.lit("no rank").alias("rank")))


def rank_values(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """tax_id, rank, rank_value: a rank's depth over the deepest one's; an anchor's is the mean of the nearest ranked ancestor's (else 0)
    and the nearest ranked descendant's (else 1; of equally near ones the least id's); any other rank has none."""
    depth = F.create_map(*[x for r, v in RANKS.items() for x in (F.lit(r), F.lit(v / max(RANKS.values())))])
    valued = nodes.select("tax_id", F.lower("rank").alias("rank")).withColumn("own", depth[F.col("rank")])
    anchors = valued.where(F.col("rank").isin(*ANCHOR_RANKS)).select("tax_id")
    ranked = valued.where("own IS NOT NULL").select(F.col("tax_id").alias("other"), "own")
    far = cut(closure(edges.where("child <> parent").select("child", "parent", F.lit(1.0).alias("weight"))))
    nearest = lambda own, other, out: (
        far.select(F.col(own).alias("tax_id"), F.col(other).alias("other"), "distance").join(anchors, "tax_id", "left_semi").join(ranked, "other")
        .groupBy("tax_id").agg(F.min_by("own", F.struct("distance", "other")).alias(out))
    )
    out = valued.join(nearest("tax_id", "ancestor", "above"), "tax_id", "left").join(nearest("ancestor", "tax_id", "below"), "tax_id", "left")
    anchor = (F.coalesce("above", F.lit(0.0)) + F.coalesce("below", F.lit(1.0))) / 2
    return out.select("tax_id", "rank", F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("rank").isin(*ANCHOR_RANKS), anchor).alias("rank_value"))


def nearest_parent(orphans: DataFrame, nodes: DataFrame) -> DataFrame:
    """tax_id, parent: the node of smaller radius with the least (difference of radius + difference of angle * radius), angles across 0 as well.

    The nodes of one figure; they go to all tasks only where the optimiser finds them small.
    """
    o, n = orphans.select("tax_id", "radius", "angle"), nodes.select(F.col("tax_id").alias("parent"), F.col("radius").alias("r"), F.col("angle").alias("a"))
    turn = F.abs(F.col("angle") - F.col("a"))
    apart = (F.col("radius") - F.col("r")) + F.least(turn, 2 * F.pi() - turn) * F.col("radius")
    return o.join(n, F.col("r") < F.col("radius")).groupBy("tax_id").agg(F.min_by("parent", F.struct(F.round(apart, 9), "parent")).alias("parent"))


def layout(rooted: DataFrame, radii: DataFrame) -> DataFrame:
    """tax_id, angle, radius, x, y of a tree (tax_id, parent) with radii (tax_id, radius): leaves stand around the circle in depth-first order,
    any other node midway between its outermost children, across angle 0 where these are more than half a turn apart.

    One aggregation a level, from the deepest up.
    """
    order = cut(depth_first(rooted).join(rooted.select("tax_id", "parent"), "tax_id"))
    leaves = order.where("leaf_order IS NOT NULL")
    n, deepest = leaves.count(), order.agg(F.max("level")).first()[0] or 0
    at = F.col("leaf_order") * 2 * F.pi() / n
    done = cut(leaves.select("tax_id", "parent", "level", at.alias("angle")))
    a = F.col("angle")
    turned = F.when(a > F.pi(), a - 2 * F.pi()).otherwise(a)
    for level in range(deepest, 1, -1):
        ends = done.where(F.col("level") == level).groupBy(F.col("parent").alias("tax_id")).agg(F.min(a).alias("lo"), F.max(a).alias("hi"), F.min(turned).alias("tlo"), F.max(turned).alias("thi"))
        across = F.col("hi") - F.col("lo") > F.pi()
        mid = F.when(across, (F.col("tlo") + F.col("thi")) / 2).otherwise((F.col("lo") + F.col("hi")) / 2)
        inner = ends.select("tax_id", F.when(mid < 0, mid + 2 * F.pi()).otherwise(mid).alias("angle")).join(order.select("tax_id", "parent", "level"), "tax_id")
        done = cut(done.unionByName(inner))
    return _placed(done.select("tax_id", "angle").join(radii.select("tax_id", "radius"), "tax_id"))


def reuse_layout(nodes: DataFrame, edges: DataFrame, master: DataFrame) -> DataFrame:
    """tax_id, angle, radius, x, y of nodes (tax_id, radius): as in ``master``; others stand 0.1 beyond their parent's angle for every step to the
    nearest placed ancestor, at their own radius or, if that is null, 0.1 a step beyond that ancestor's. A node without a placed ancestor has no row."""
    had = nodes.select("tax_id").join(master.select("tax_id", "angle", "radius"), "tax_id")
    new = nodes.select("tax_id", "radius").join(master, "tax_id", "left_anti")
    way = ancestors(edges, new).where("distance > 0")
    near = way.join(master.select(F.col("tax_id").alias("ancestor"), "angle", F.col("radius").alias("r")), "ancestor").groupBy("tax_id").agg(F.min_by(F.struct("distance", "angle", "r"), F.struct("distance", "ancestor")).alias("p"))
    step = F.col("p.distance") * 0.1
    put = new.join(near, "tax_id").select("tax_id", (F.col("p.angle") + step).alias("angle"), F.coalesce("radius", F.col("p.r") + step).alias("radius"))
    return _placed(had.unionByName(put))


def _placed(polar: DataFrame) -> DataFrame:
    return polar.select("tax_id", "angle", "radius", (F.col("radius") * F.cos("angle")).alias("x"), (F.col("radius") * F.sin("angle")).alias("y"))


def legend(ranks: DataFrame) -> DataFrame:
    """rank, place: ranks from the top, then anchors, then others, by name."""
    depth = F.create_map(*[x for r, v in RANKS.items() for x in (F.lit(r), F.lit(v))])
    kind = F.when(depth[F.col("rank")].isNotNull(), 0).when(F.col("rank").isin(*ANCHOR_RANKS), 1).otherwise(2)
    order = Window.orderBy(kind, F.coalesce(depth[F.col("rank")], F.lit(0.0)), "rank")  # a handful of ranks
    return ranks.select("rank").distinct().withColumn("place", F.row_number().over(order))


def quartile_class(df: DataFrame, value: str) -> DataFrame:
    """Class 1 to 4 by nearest-rank quartiles: sorted[int(n * q)]. The quartiles are one aggregation over all rows; no task orders them."""
    n = df.count()
    if not n:
        return df.withColumn("quartile", F.lit(4))
    at = [F.expr(f"percentile_disc({(int(n * q) + 0.5) / n!r}) WITHIN GROUP (ORDER BY {value})") for q in (0.25, 0.5, 0.75)]
    q = df.agg(*at).first()
    return df.withColumn("quartile", F.when(F.col(value) <= q[0], 1).when(F.col(value) <= q[1], 2).when(F.col(value) <= q[2], 3).otherwise(4))


def relevant(nodes: DataFrame, edges: DataFrame, counts: DataFrame) -> DataFrame:
    """Taxa with a count, and their ancestors."""
    return nodes.join(ancestors(edges, counts.where("n > 0").select("tax_id")).select(F.col("ancestor").alias("tax_id")).distinct(), "tax_id", "left_semi")


def edge_classes(edges: DataFrame, classed: DataFrame) -> DataFrame:
    """child, parent, class of the child; no class: 0."""
    return edges.join(classed.select(F.col("tax_id").alias("child"), F.col("quartile").alias("class")), "child", "left").select("child", "parent", F.coalesce("class", F.lit(0)).alias("class"))


def angle_groups(labels: DataFrame, gap: float = 0.4) -> DataFrame:
    """Labels by angle; a new group wherever the next is ``gap`` or more away, and the place within the group.

    Within a cell of half a gap there is no such step, so groups follow from the least and greatest angle of each cell: a row for
    every cell that has labels, at most 4 pi / gap of them.
    """
    cell = F.floor(F.col("angle") / (gap / 2)).cast("long")
    celled = labels.withColumn("_cell", cell)
    cells = celled.groupBy("_cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n"))
    by = Window.orderBy("_cell")  # cells, not labels
    cells = cells.withColumn("new", F.when(F.col("low") - F.lag("high").over(by) < gap, 0).otherwise(1)).withColumn("grp", F.sum("new").over(by))
    earlier = Window.partitionBy("grp").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_cell", "grp", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy("_cell").orderBy("angle", "tax_id"))
    return celled.join(cells, "_cell").withColumn("place", (F.col("earlier") + within).cast("int")).drop("_cell", "earlier")
