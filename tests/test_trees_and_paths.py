"""Labels of trees, sums along paths, greedy keys, and paths with their edges against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evigraph.operators import graph, reconcile, trees
from evigraph.operators.graph import Graph


def grown(rng, n, deep):
    """(child, parent) of a forest of three roots; deep: mostly chains."""
    links = [(0, 0), (1, None), (2, 2)]
    return links + [(i, i - 1 if deep and rng.random() < 0.9 else rng.randrange(i)) for i in range(3, n)]


@pytest.mark.parametrize(("n", "deep"), [(60, True), (300, False)])
def test_labels(spark, n, deep):
    links = grown(random.Random(n), n, deep)
    up = {c: p for c, p in links if p is not None and p != c}
    above = {c: [] for c, _ in links}
    for c in above:
        x = c
        while x in up:
            x = up[x]
            above[c].append(x)
    df = spark.createDataFrame(links + links[5:9], "child long, parent long").repartition(3)
    weight = spark.createDataFrame([(7, 2), (7, 1), (20, 5), (10**6, 1)], "node long, n int")
    got = {r.node: r for r in trees.labelled(df, weight).collect()}
    assert got.keys() == above.keys()
    for a, ra in got.items():
        assert ra.depth == len(above[a]) and ra.root == ([a] + above[a])[-1]
        assert ra.marked == sum(w for i, w in ((7, 3), (20, 5)) if a == i or a in above[i])
        below = {b for b, rb in got.items() if rb.root == ra.root and ra.enter <= rb.enter <= ra.leave}
        assert below == {b for b in above if b == a or a in above[b]}
    labels = trees.labelled(df)
    for itself in (True, False):
        assert {r.node for r in trees.under(labels, [4, 5, 999], itself).collect()} == {b for b in above for a in (4, 5) if a in above[b] or (itself and a == b)}
    facts = spark.createDataFrame([(i, i if i % 3 == 0 else None) for i in range(n)], "node long, x long")
    near = {r.node: r.x for r in trees.nearest(df, facts, ["x"]).collect()}
    assert near == {c: next((a for a in above[c] if a % 3 == 0), None) for c in above}


def test_what_is_no_forest(spark):
    with pytest.raises(trees.TreeError):
        trees.labelled(spark.createDataFrame([(1, 2), (1, 3)], "child long, parent long"))
    round_ = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 6), (None, 7)], "child long, parent long")
    assert {r.node for r in trees.labelled(round_).collect()} == {5, 6, 7}
    assert [tuple(r) for r in trees.ends(round_).collect()] == [(5, 6)]
    assert trees.labelled(round_.limit(0)).count() == 0


def plain_greedy(rows):
    first, second, kept = set(), set(), set()
    for o, a, b in sorted(rows):
        if (a is None or a not in first) and (b is None or b not in second):
            kept.add(o)
            first.add(a)
            second.add(b)
    return kept


@pytest.mark.parametrize("small", [0, 5, 10**6])
def test_two_keys_as_read_in_turn(spark, small):
    rng = random.Random(small)
    rows = [(i, rng.choice([None, *range(12)]), rng.choice([None, None, *range(20)])) for i in range(40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "seq long, a long, b long, more string").repartition(4)
    got = reconcile.two_key_first_wins(df, "seq", "a", "b", small)
    assert got.columns == df.columns and {r.seq for r in got.collect()} == plain_greedy(rows)


def test_a_long_chain_is_one_turn(spark, monkeypatch):
    """10,000 rows of which each shares a key with the next."""
    rows = [(i, i // 2, (i + 1) // 2) for i in range(10_000)]
    turns = []
    folded = trees.folded
    monkeypatch.setattr(trees, "folded", lambda *a: turns.append(1) or folded(*a))
    cuts = []
    cut = trees.cut
    monkeypatch.setattr(trees, "cut", lambda df: cuts.append(1) or cut(df))
    got = {r.seq for r in reconcile.two_key_first_wins(spark.createDataFrame(rows, "seq long, a long, b long"), "seq", "a", "b", 0).collect()}
    assert got == plain_greedy(rows) == set(range(0, 10_000, 2))
    assert len(turns) == 1 and len(cuts) <= 16  # of one turn, a step for each doubling


def plain_shortest(edges, a, b, most):
    """All shortest paths by breadth, the least of them."""
    near = defaultdict(list)
    for e, x, y, t in edges:
        near[x].append((y, e, t))
        near[y].append((x, e, t))
    level, seen = {a: ((a,), ())}, {a}
    for h in range(most + 1):
        if b in level:
            return h, level[b]
        new = {}
        for x, (nodes, rels) in level.items():
            for y, e, t in near[x]:
                if y not in seen:
                    p = (nodes + (y,), rels + ((e, t),))
                    new[y] = min(new.get(y, p), p)
        level = new
        seen |= set(new)
    return None


@pytest.mark.parametrize("seed", [1, 2])
def test_path_between(spark, seed):
    rng = random.Random(seed)
    edges = [(f"e{i}", f"n{rng.randrange(30)}", f"n{rng.randrange(30)}", rng.choice("AB")) for i in range(38)]
    edges += [("z0", "n1", "n2", "A"), ("y0", "n2", "n1", "B"), ("loop", "n1", "n1", "A")]
    df = spark.createDataFrame(edges, "edge_id string, src string, dst string, type string").repartition(3)
    for a, b in (("n1", "n2"), ("n3", "n17"), ("n5", "n28"), ("n4", "n4"), ("n1", "nowhere")):
        got = graph.path_between(df, a, b, 5).select("hops", graph.nodes_of("p").alias("n"), graph.relationships_of("p").alias("r")).collect()
        want = plain_shortest(edges, a, b, 5)
        assert [(r.hops, (tuple(r.n), tuple((x.edge_id, x.type) for x in r.r))) for r in got] == ([want] if want else [])
    if seed == 1:
        for small in (0, 3):  # fronts that are written
            assert graph.path_between(df, "n3", "n17", 5, small).collect() == graph.path_between(df, "n3", "n17", 5).collect()
    assert graph.path_between(df, "n3", "n17", 1).count() == (1 if plain_shortest(edges, "n3", "n17", 1) else 0)


def test_walks_carry_their_edges(spark):
    e = spark.createDataFrame([(1, "a", "b", "R"), (2, "b", "c", "S"), (3, "c", "a", "R"), (4, "a", "b", "R")], "edge_id long, src string, dst string, type string")
    starts = spark.createDataFrame([("a",)], "id string")
    got = Counter((r.node, r.hops, tuple(r.p.nodes), tuple((x.edge_id, x.type) for x in r.p.relationships)) for r in graph.walks(e, starts, 0, 4).collect())
    want, todo, rows = Counter(), [("a", ("a",), ())], [tuple(r) for r in e.collect()]
    while todo:
        x, nodes, used = todo.pop()
        want[x, len(used), nodes, used] += 1
        if len(used) < 4:
            todo += [(d, (*nodes, d), (*used, (i, t))) for i, s, d, t in rows if s == x and i not in [u for u, _ in used]]
    assert got == want


def test_hops_pass_no_edge_twice(spark):
    e = spark.createDataFrame([("s1", "p", 1), ("s1", "p", 1), ("s2", "p", 2)], "s string, d string, n int")
    g = Graph().add_nodes("S", spark.createDataFrame([("s1",), ("s2",)], "k string"), "k").add_nodes("P", spark.createDataFrame([("p",)], "k string"), "k").add_edges("R", e, "s", "d", "S", "P")
    there = g.hop(g.nodes["S"].filter("id = 's1'"), "R", "id", "p", trail="_used")
    pairs = Counter((r.id, r.other, r.R_n) for r in g.hop(there, "R", "p", "other", back=True, trail="_used").collect())
    assert pairs == {("s1", "s1", 1): 2, ("s1", "s2", 1): 2}  # two equal edges are two
    assert g.hop(there, "R", "p", "other", back=True).count() == 6
    left = g.hop(there, "R", "p", "other", where=F.col("n") > 5, back=True, optional=True, trail="_used").collect()
    assert len(left) == 2 and all(r.other is None and len(r._used) == 1 for r in left)


def test_closure_is_semi_naive(spark):
    rng = random.Random(8)
    links = {(rng.randrange(20), rng.randrange(20)) for _ in range(32)}
    up = defaultdict(set)
    for c, p in links:
        if c != p:
            up[c].add(p)
    want = {}
    for c in list(up):
        level, depth = {c}, 0
        while level:
            depth += 1
            level = {p for x in level for p in up[x]} - {a for (n, a) in want if n == c} - {c}
            want |= {(c, a): depth for a in level}
    df = spark.createDataFrame(list(links), "child long, parent long")
    assert {(r.node, r.ancestor): r.depth for r in graph.closure(df).collect()} == want
    assert {(r.node, r.ancestor): r.depth for r in graph.closure(df, most=2).collect()} == {k: d for k, d in want.items() if d <= 2}
