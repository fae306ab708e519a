"""Trees without their pairs: sums along paths by doubling, interval labels, nearest ancestors.

A turn joins every unfinished node with the node its pointer shows, and the pointer then shows twice as far: a tree of depth d takes about log2(d) turns, and a turn holds a row a node, not a row for each node and ancestor.
Interval labels number a tree walk; "under" is then a comparison of numbers. Links are (child, parent); a node that is its own parent, or whose parent is null, is a root. A node of several parents is an error (TreeError): such links are no forest, use closure().
Nodes on a cycle and what hangs below one reach no root: they get no label and no sums.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut

#: Parts of a node's children that are numbered apart, so that no task holds all children of a node.
CHILD_PARTS = 64


class TreeError(ValueError):
    pass


def parents(links: DataFrame) -> DataFrame:
    """(node, up): every node once with its parent, null for a root; nodes that only occur as parents are roots."""
    real = links.filter("child is not null").select(F.col("child").alias("node"), F.when(F.col("parent") != F.col("child"), F.col("parent")).alias("up"))
    tops = links.filter("parent is not null").select(F.col("parent").alias("node"), F.lit(None).cast(links.schema["parent"].dataType).alias("up"))
    got = real.unionByName(tops).groupBy("node").agg(F.min("up").alias("up"), (F.min("up") != F.max("up")).alias("several"))
    got = cut(got)
    if bad := got.filter("several").limit(3).collect():
        raise TreeError(f"nodes of several parents, such as {', '.join(str(r['node']) for r in bad)}")
    return got.select("node", "up")


def folded(nodes: DataFrame, values: dict) -> DataFrame:
    """nodes (node, up, and columns) with each column combined over the path from the node to its root; nodes that reach no root are dropped. values: column -> combine(near, far), an associative
    function of the value of a path's lower part and of its upper part. Only nodes whose pointer has not passed a root are joined again."""
    state, done, turns = nodes, None, None
    while True:
        ended, rest = state.filter("up is null"), state.filter("up is not null")
        done = ended if done is None else done.unionByName(ended)
        left = rest.count()
        if turns is None:
            turns = left.bit_length() + 1  # no path is longer than that many turns reach: what is left then goes round
        if not left or not turns:
            return done.drop("up")
        far = rest.unionByName(done).select(F.col("node").alias("_node"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in values])
        new = {"up": F.col("_up"), **{c: combine(F.col(c), F.col(f"_{c}")) for c, combine in values.items()}}
        state, turns = cut(rest.join(far, F.col("up") == F.col("_node")).select(*[new[c].alias(c) if c in new else F.col(c) for c in nodes.columns])), turns - 1


def below_sums(nodes: DataFrame, columns: Iterable[str]) -> DataFrame:
    """nodes (node, up, and columns) with each column summed over the node and all nodes below it. After a turn a node holds the sum of what lies less than 2^turn below; those exactly that far below
    hand theirs up. Sums on a cycle mean nothing."""
    columns, turns = list(columns), None
    state = nodes.withColumn("_jump", F.col("up"))
    while True:
        jumps = state.filter("_jump is not null")
        left = jumps.count()
        if turns is None:
            turns = left.bit_length() + 1
        if not left or not turns:
            return state.drop("_jump")
        given = jumps.groupBy(F.col("_jump").alias("node")).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        further = jumps.select(F.col("node").alias("_jump"), F.col("_jump").alias("_further"))
        sums = [(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) if c in columns else F.col(c) for c in nodes.columns]
        state = cut(state.join(given, "node", "left").join(further, "_jump", "left").select(*sums, F.col("_further").alias("_jump")))
        turns -= 1


def labelled(links: DataFrame, weight: DataFrame | None = None) -> DataFrame:
    """(node, up, enter, leave, depth, root[, marked]): the numbers of a walk through each tree, children in order of a hash and their key; b lies under a, or is a, if they share a root and a.enter <= b.enter <= a.leave. With
    weight (node, n), `marked` is the sum of n over the node and what lies below it."""
    tree = parents(links)
    ones = tree.withColumn("size", F.lit(1).cast("long"))
    if weight is not None:
        ones = ones.join(weight.groupBy("node").agg(F.sum("n").cast("long").alias("marked")), "node", "left").withColumn("marked", F.coalesce("marked", F.lit(0).cast("long")))
    sized = below_sums(ones, ["size", "marked"] if weight is not None else ["size"])
    # children are numbered in parts: the sums of the parts before, then those of the children before within the part
    part = sized.filter("up is not null").withColumn("_part", F.pmod(F.xxhash64("node"), F.lit(CHILD_PARTS)))
    own = part.withColumn("_within", F.sum("size").over(Window.partitionBy("up", "_part").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)))
    parts = part.groupBy("up", "_part").agg(F.sum("size").alias("_size"))
    before = parts.withColumn("_before", F.sum("_size").over(Window.partitionBy("up").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).drop("_size")  # CHILD_PARTS rows at most
    steps = own.join(before, ["up", "_part"]).select("node", (1 + F.coalesce("_within", F.lit(0)) + F.coalesce("_before", F.lit(0))).alias("step"))
    placed = sized.join(steps, "node", "left").withColumn("step", F.coalesce("step", F.lit(0).cast("long")))
    placed = cut(placed.withColumns({"enter": F.col("step"), "depth": F.when(F.col("up").isNull(), 0).otherwise(1), "root": F.col("node"), "parent": F.col("up")}).drop("step"))
    got = folded(placed, {"enter": lambda near, far: near + far, "depth": lambda near, far: near + far, "root": lambda near, far: far})
    return got.select("node", F.col("parent").alias("up"), "enter", (F.col("enter") + F.col("size") - 1).alias("leave"), "depth", "root", *(["marked"] if weight is not None else []))


def under(labels: DataFrame, roots: list, itself: bool = True) -> DataFrame:
    """The labelled nodes under any of some nodes: a range test for each of these, which should be few."""
    tops = labels.filter(F.col("node").isin(roots)).select("node", "root", "enter", "leave").collect()  # a row for each node asked
    test = F.lit(False)
    for t in tops:
        test = test | ((F.col("root") == F.lit(t["root"])) & F.col("enter").between(t["enter"] if itself else t["enter"] + 1, t["leave"]))
    return labels.filter(test)


def ends(links: DataFrame) -> DataFrame:
    """(node, root): where following the links from a node ends, for nodes that have a link and do not go round."""
    tree = cut(parents(links).withColumn("root", F.col("node")).withColumn("linked", F.col("up").isNotNull()))
    return folded(tree, {"root": lambda near, far: far}).filter("linked").select("node", "root")


def nearest(links: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """(node, and for each column the value of the nearest ancestor, not the node itself, where it is not null). facts: (node, columns)."""
    tree = parents(links)
    kinds = {c: facts.schema[c].dataType for c in columns}
    above = facts.select(F.col("node").alias("up"), *columns)
    start = tree.join(above, "up", "left").select("node", "up", *[F.col(c).cast(kinds[c]).alias(c) for c in columns])
    return folded(start, {c: (lambda near, far: F.coalesce(near, far)) for c in columns})
