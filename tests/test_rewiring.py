"""Anchors settled in rounds against the loop that takes them one by one."""

import random

import pytest

from spanloom.operators import rewiring
from spanloom.operators.taxonomy import ANCHOR_RANKS, RANKS


def loop(nodes, edges):
    """The plain loop: nodes (id, rank) in order, edges {child: parent}."""
    deepest = max(RANKS.values())
    value = {n: RANKS[r] / deepest for n, r in nodes if r in RANKS}
    parent, children = dict(edges), {}
    for n, _ in nodes:
        if n in parent:
            children.setdefault(parent[n], []).append(n)
    values = dict(value)
    for n, rank in nodes:
        if rank not in ANCHOR_RANKS:
            continue
        at, above, top = n, None, n
        while at in parent and above is None:
            at = parent[at]
            top = at
            if at in value:
                above = value[at]
        queue, seen, child = list(children.get(n, [])), set(children.get(n, [])), None
        while queue:
            c = queue.pop(0)
            if c in value:
                child = c
                break
            for x in children.get(c, []):
                if x not in seen:
                    queue.append(x)
                    seen.add(x)
        if top != n:
            parent[n] = top
            children.setdefault(top, [])
            if n not in children[top]:
                children[top].append(n)
        if child is not None:
            parent[child] = n
            children.setdefault(n, [])
            if child not in children[n]:
                children[n].append(child)
        values[n] = ((above or 0) + (1 if child is None else value[child])) / 2
    return values, parent


@pytest.mark.parametrize("seed,shape", [(1, 3), (2, 1), (3, 8)])
def test_rounds_are_the_loop(spark, seed, shape):
    """Many small forests side by side: deep chains (shape 1), bushes, every kind of order."""
    rng, nodes, edges = random.Random(seed), [], {}
    for f in range(60):
        n = rng.randrange(2, 16)
        ids = [f"f{f}n{i}" for i in range(n)]
        for i in range(1, n):
            if rng.random() < 0.95:
                edges[ids[i]] = ids[max(0, i - rng.randrange(1, shape + 1))]
        nodes += [(i, rng.choice(["no rank", "clade", "no rank", "clade", "other", *rng.sample(sorted(RANKS), 2)])) for i in ids]
    if seed != 2:
        rng.shuffle(nodes)
    else:
        nodes.reverse()  # the lowest first: a round for each level
    want, parents = loop(nodes, edges)
    n = spark.createDataFrame([(i, r, k) for k, (i, r) in enumerate(nodes)], "tax_id string, rank string, ord int")
    got, after = rewiring.rewire(n, spark.createDataFrame(list(edges.items()), "child string, parent string"))
    assert {r["tax_id"]: r["rank_value"] for r in got.collect()} == {i: pytest.approx(want[i]) if i in want else None for i, _ in nodes}
    rows = [tuple(r) for r in after.collect()]
    assert len(rows) == len(parents) and dict(rows) == parents
