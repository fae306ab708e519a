"""A property graph as DataFrames: nodes by label, edges by type, edges never merged."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def checkpoint_dir(spark) -> str:
    """The folder that spark.checkpoint.dir names. Only where it is unset and the master is local, a local one is set."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="evigraph-"))
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def cut(df: DataFrame, measures: dict[str, Column] | None = None, into: dict | None = None) -> DataFrame:
    """The rows written once to the shared folder and read back, so that later turns start from them and know their size. A column without a type becomes text. measures: aggregates that are taken of the rows
    while they are written and put `into` a mapping, so that no other pass is needed for them."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_evigraph_cuts", None):
        sc._evigraph_cuts = shared_folder(df.sparkSession, "cuts")
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"})
    path = f"{sc._evigraph_cuts}/{uuid.uuid4().hex}"
    if measures:
        seen = Observation()
        df.observe(seen, *[c.alias(k) for k, c in measures.items()]).write.parquet(path)
        into |= seen.get
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark, name: str) -> str:
    """A new folder of this session in the shared one; it is deleted when the driver ends."""
    sc, path = spark.sparkContext, f"{checkpoint_dir(spark).rstrip('/')}/evigraph-{name}-{uuid.uuid4().hex}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@dataclass
class Graph:
    """nodes: label -> frame with an id; edges: type -> frame with src, dst; ends: type -> (source label, target label); by_target: the same edges as stored for lookups by dst, where they are."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)
    above: dict[str, list[str]] = field(default_factory=dict)
    by_target: dict[str, DataFrame] = field(default_factory=dict)
    measured: dict[tuple[str, str], dict] = field(default_factory=dict, repr=False)  # ("node" or "edge", name) -> what was measured when its rows were written

    def add_nodes(self, label: str, df: DataFrame, key: str, parents: tuple[str, ...] = ()) -> Graph:
        self.nodes[label] = df.withColumnRenamed(key, "id")
        for p in parents:
            self.above.setdefault(p, []).append(label)
        return self

    def add_edges(self, kind: str, df: DataFrame, src: str, dst: str, source: str, target: str) -> Graph:
        """Each row is an edge of its own; rows without an endpoint give none."""
        rows = df.withColumnsRenamed({src: "src", dst: "dst"}).filter("src is not null and dst is not null")
        self.edges[kind], self.ends[kind] = rows, (source, target)
        return self

    def identified(self, kind: str, key: list[str] | None = None) -> DataFrame:
        """Edges with an edge_id. It comes from the edge's key columns or, without a key, from all its cells and a number among rows that are equal in all of them, so that it is the same
        at every partitioning and recomputation. It is only added where identity is asked for, as filters don't pass below it."""
        e = self.edges[kind]
        if "edge_id" in e.columns:
            return e
        if key:
            return e.withColumn("edge_id", F.concat_ws("-", F.lit(kind), *key))
        cells = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in e.columns]), 256)
        again = F.row_number().over(Window.partitionBy("_cells").orderBy(F.lit(0)))  # rows here are equal: any order gives the same
        return e.withColumn("_cells", cells).withColumn("edge_id", F.concat_ws("-", F.lit(kind), F.col("_cells"), again)).drop("_cells")

    def scan(self, label: str) -> DataFrame:
        """Nodes of a label; an abstract label is the union of those under it, each with its own label."""
        labels = self.above.get(label, [label])
        parts = [self.nodes[x].withColumn("label", F.lit(x)) for x in labels]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def slim_edges(self, kinds: list[str] | None = None, undirected: bool = False, at: tuple[str, object] | None = None) -> DataFrame:
        """type, src_label, src, dst_label, dst of all edges of some types; undirected adds each the other way round. at (label, key): only edges that start there; the key is compared in its own
        type before ids become text, so that the test reaches the scan."""
        parts = []
        for k in kinds or list(self.edges):
            for near, far, (a, b) in [("src", "dst", self.ends[k])] + ([("dst", "src", self.ends[k][::-1])] if undirected else []):
                if at and a != at[0]:
                    continue
                e = self.side(k, near).filter(F.col(near) == F.lit(at[1])) if at else self.edges[k]
                parts.append(e.select(F.lit(k).alias("type"), F.lit(a).alias("src_label"), F.col(near).cast("string").alias("src"), F.lit(b).alias("dst_label"), F.col(far).cast("string").alias("dst")))
        return reduce(DataFrame.unionByName, parts)

    def side(self, kind: str, near: str) -> DataFrame:
        """The edges of a type as they are stored for lookups by `near` (src or dst)."""
        return self.by_target.get(kind, self.edges[kind]) if near == "dst" else self.edges[kind]

    def hop(self, rows: DataFrame, kind: str, at: str, to: str, where: Column | None = None, back: bool = False, optional: bool = False, trail: str | None = None) -> DataFrame:
        """Rows joined with edges of a type from column `at`; the far end lands in column `to`, edge properties as `<kind>_<name>`.
        An optional hop keeps rows without a match; its condition belongs to the leg. trail: a column with the ids of the edges a row has passed, begun if rows lack it; no edge is passed twice (G10)."""
        near, far = ("dst", "src") if back else ("src", "dst")
        how = "left" if optional else "inner"
        e = self.side(kind, near) if trail is None else self.identified(kind).withColumn("_own", F.col("edge_id").cast("string")).drop("edge_id")
        e = e if where is None else e.filter(where)
        e = e.withColumnsRenamed({c: f"{kind}_{c}" for c in e.columns if c not in ("src", "dst", "_own")}).withColumnRenamed(far, to).withColumnRenamed(near, "_near")
        if trail is None:
            return rows.join(e, rows[at] == e["_near"], how).drop("_near")
        rows = (rows if trail in rows.columns else rows.withColumn(trail, F.array().cast("array<string>"))).withColumn("_at", F.col(at))
        e = e.drop(*[c for c in e.columns if c in rows.columns])  # a type that is passed again keeps the properties of its first edge
        got = rows.join(e, (F.col("_at") == F.col("_near")) & ~F.array_contains(trail, F.col("_own")), how)
        return got.withColumn(trail, F.when(F.col("_own").isNull(), F.col(trail)).otherwise(F.array_append(trail, F.col("_own")))).drop("_near", "_own", "_at")

    def exists(self, rows: DataFrame, kind: str, at: str, where: Column | None = None, back: bool = False, negate: bool = False) -> DataFrame:
        near = "dst" if back else "src"
        e = (self.side(kind, near) if where is None else self.side(kind, near).filter(where)).select(F.col(near).alias("_near"))
        return rows.join(e, rows[at] == e["_near"], "left_anti" if negate else "left_semi")

    def counts(self) -> DataFrame:
        """Typed counts; a type without rows gives no row."""
        parts = [d.groupBy(F.lit("node").alias("what"), F.lit(k).alias("name")).agg(F.count(F.lit(1)).alias("n")) for k, d in self.nodes.items()]
        parts += [d.groupBy(F.lit("edge").alias("what"), F.lit(k).alias("name")).agg(F.count(F.lit(1)).alias("n")) for k, d in self.edges.items()]
        return reduce(DataFrame.unionByName, parts)

    def dangling(self, kind: str) -> DataFrame:
        """Edges whose target is no node of its label."""
        _, target = self.ends[kind]
        ids = self.nodes[target].select(F.col("id").alias("dst"))
        return self.edges[kind].join(ids, "dst", "left_anti")


def closure(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, ancestor, depth) along parent links (child, parent), each pair at its least depth, until no pair is new or, if given, depth `most` is reached. A turn reaches twice as far and is
    semi-naive: only pairs of the greatest depth are prolonged, and only new pairs are written. Self-links and cycles end. To test what lies under a node of a forest, labels need no pairs (trees.labelled)."""
    paths = new = cut(edges.filter("child != parent").select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct())
    reach = 1
    while most is None or reach < most:
        a, b = new.filter(F.col("depth") == reach).alias("a"), paths.alias("b")  # a path of more than `reach` links begins with one of just as many
        longer = a.join(b, F.col("a.ancestor") == F.col("b.node")).filter("a.node != b.ancestor")
        longer = longer.select(F.col("a.node").alias("node"), F.col("b.ancestor").alias("ancestor"), (F.col("a.depth") + F.col("b.depth")).alias("depth"))
        if most is not None:
            longer = longer.filter(F.col("depth") <= most)
        new = cut(longer.groupBy("node", "ancestor").agg(F.min("depth").alias("depth")).join(paths.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        if new.isEmpty():
            break
        paths, reach = paths.unionByName(new), reach * 2
    return paths


def walks(edges: DataFrame, starts: DataFrame, least: int, most: int) -> DataFrame:
    """(start, node, hops, p): every walk of least to most hops without a repeated edge, as a path value; edges (edge_id, src, dst[, type])."""
    kind = edges.schema["src"].dataType.simpleString()
    rel = F.struct(F.col("edge_id"), (F.col("type") if "type" in edges.columns else F.lit(None).cast("string")).alias("type"))
    steps = edges.select("src", "dst", rel.alias("rel"))
    relation = f"array<{steps.schema['rel'].dataType.simpleString()}>"
    walk = starts.select(F.col("id").alias("start"), F.col("id").alias("node"), F.array(F.col("id").cast(kind)).alias("nodes"), F.array().cast(relation).alias("rels"), F.lit(0).alias("hops"))
    found = [walk.filter(F.lit(least <= 0))]
    for h in range(1, most + 1):
        walk = walk.join(steps, walk["node"] == steps["src"]).filter(~F.exists("rels", lambda r: r["edge_id"] == F.col("rel.edge_id")))
        walk = walk.select("start", F.col("dst").alias("node"), F.array_append("nodes", F.col("dst")).alias("nodes"), F.array_append("rels", F.col("rel")).alias("rels"), F.lit(h).alias("hops"))
        if h >= least:
            found.append(walk)
    return reduce(DataFrame.unionByName, found).select("start", "node", "hops", F.struct(F.col("nodes"), F.col("rels").alias("relationships")).alias("p"))


def variable_length(edges: DataFrame, starts: DataFrame, least: int, most: int) -> DataFrame:
    """(start, node, hops): every walk of least to most hops without a repeated edge; edges (edge_id, src, dst)."""
    return walks(edges, starts, least, most).select("start", "node", "hops")


def nodes_of(p: str) -> Column:
    """The nodes of a path value, in order."""
    return F.col(p)["nodes"]


def relationships_of(p: str) -> Column:
    """Its edges, each with edge_id and type."""
    return F.col(p)["relationships"]


#: A front of so many nodes at most is held by the driver and sent to every task, so that neither it nor the edges are written or shuffled.
SMALL_FRONT = 10_000


def path_between(edges: DataFrame, source, target, most: int = 4, small: int = SMALL_FRONT) -> DataFrame:
    """(hops, p) of a shortest undirected path of up to `most` hops, the least by node order, then by edges; edges (src, dst[, edge_id, type]). Two fronts, from the source and from the target, are
    moved in turn, the smaller first, until they meet. A front keeps one path a node and drops nodes already seen, so parallel edges and hubs do not multiply; only edges at the front are joined. A front of more than
    `small` nodes is written to the shared folder."""
    spark, kind = edges.sparkSession, edges.schema["src"].dataType.simpleString()
    one = lambda c: (F.col(c) if c in edges.columns else F.lit(None).cast("string")).alias(c)
    ends = [edges.select(F.col(a).alias("at"), F.col(b).alias("to"), F.struct(one("edge_id"), one("type")).alias("rel")) for a, b in (("src", "dst"), ("dst", "src"))]
    links = ends[0].unionByName(ends[1])
    relation = f"array<{ends[0].schema['rel'].dataType.simpleString()}>"
    columns, p_type = f"node {kind}, nodes array<{kind}>, rels {relation}", f"struct<nodes:array<{kind}>,relationships:{relation}>"
    local = lambda rows: spark.createDataFrame(rows, columns)
    fronts, seen, sizes, hops = [local([(source, [source], [])]), local([(target, [target], [])])], [None, None], [1, 1], [0, 0]
    if source == target:
        return fronts[0].select(F.lit(0).alias("hops"), F.struct(F.col("nodes"), F.col("rels").alias("relationships")).alias("p"))
    held: list[dict | None] = [{source: ([source], [])}, {target: ([target], [])}]  # a small front's paths by node
    while sum(hops) < most and all(sizes):
        s = 0 if sizes[0] <= sizes[1] else 1
        front = F.broadcast(fronts[s]) if held[s] is not None else fronts[s]
        step = front.join(links, F.col("node") == F.col("at")).filter("to != node")
        nodes, rels = (F.array_append("nodes", F.col("to")), F.array_append("rels", F.col("rel"))) if s == 0 else (F.array_prepend("nodes", F.col("to")), F.array_prepend("rels", F.col("rel")))
        best = step.groupBy(F.col("to").alias("node")).agg(F.min(F.struct(nodes.alias("nodes"), rels.alias("rels"))).alias("m")).select("node", "m.nodes", "m.rels")
        seen[s] = fronts[s].select("node") if seen[s] is None else seen[s].unionByName(fronts[s].select("node"))
        best = best.join(seen[s], "node", "left_anti")
        rows = best.limit(small + 1).collect() if held[s] is not None else None  # `small` rows and one at most
        if rows is not None and len(rows) <= small:
            fronts[s], held[s], sizes[s] = local(rows), {r["node"]: (r["nodes"], r["rels"]) for r in rows}, len(rows)
        else:
            fronts[s], held[s] = cut(best), None
            sizes[s] = fronts[s].count()
        hops[s] += 1
        if held[0] is not None and held[1] is not None:
            met = [(held[0][n][0] + held[1][n][0][1:], held[0][n][1] + held[1][n][1]) for n in held[0].keys() & held[1].keys()]
            found = [min(met)] if met else []
        else:
            b = fronts[1].select("node", F.col("nodes").alias("_nodes"), F.col("rels").alias("_rels"))
            both = fronts[0].join(b, "node").select(F.struct(F.concat("nodes", F.slice("_nodes", 2, most + 1)).alias("nodes"), F.concat("rels", "_rels").alias("relationships")).alias("p"))
            found = [r["p"] for r in both.agg(F.min("p").alias("p")).filter("p is not null").collect()]  # a row
        if found:
            return spark.createDataFrame([(sum(hops), found[0])], f"hops int, p {p_type}")
    return spark.createDataFrame([], f"hops int, p {p_type}")


def shortest_path(edges: DataFrame, source, target, most: int = 4) -> DataFrame:
    """(hops, path) of a shortest undirected path of up to `most` hops, the least by node order."""
    return path_between(edges, source, target, most).select("hops", nodes_of("p").alias("path"))


def labels_on(path: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """path with `labels`: the label of each node on it, in order (G29). labels: (node, label)."""
    at = path.withColumn("_p", F.monotonically_increasing_id())
    steps = at.select("_p", F.posexplode(column).alias("_i", "node")).join(labels, "node", "left")
    return at.join(steps.groupBy("_p").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("label", F.lit("?")).alias("label")))), lambda x: x["label"]).alias("labels")), "_p").drop("_p")


#: Statements that read (fixed values).
READS = ("select", "with", "values", "from", "describe", "show", "explain")


class ReadOnlyError(PermissionError):
    pass


def read_only(text: str) -> str:
    """The statement, if it is one that only reads (G36). A served graph takes no other."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", " ", text, flags=re.DOTALL).strip().rstrip(";").strip()
    if bare.partition(" ")[0].lower().lstrip("(") not in READS or ";" in re.sub(r"'(?:[^']|'')*'", "", bare) or re.search(r"\b(insert\s+(into|overwrite)|delete\s+from|update\s+\w+\s+set|merge\s+into|drop|create|alter|truncate)\b", re.sub(r"'(?:[^']|'')*'", "", bare), re.IGNORECASE):
        raise ReadOnlyError("only one statement that reads is allowed")
    return bare


def ask(spark, text: str, args: dict | None = None) -> DataFrame:
    """A read-only SQL statement over the graph's views, with named parameters (:name)."""
    return spark.sql(read_only(text), args=args or {})
