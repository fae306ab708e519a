"""A graph on disk for point lookups and hops (B2, B7, G4, G5): nodes in buckets of their id, edges twice, in buckets of their source and of their target.

A hop from nodes or from another clustered frame joins buckets that lie together, so no edge is shuffled; a lookup by an end reads one bucket, which is sorted by that end. The buckets are Spark's own: tables over the
written folders, declared anew by whoever opens them. Endpoints are compared in their own type; a label's ids and the ends that meet it should share one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .graph import Graph

#: Buckets of each table; a hop joins tables of one number.
BUCKETS = 16


def _declared(spark: SparkSession, path: str, columns: list[tuple[str, str]], key: str, buckets: int) -> DataFrame:
    name = f"evigraph_{uuid.uuid4().hex}"
    spec = ", ".join(f"`{c}` {kind}" for c, kind in columns)
    spark.sql(f"CREATE TABLE {name} ({spec}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _written(df: DataFrame, path: str, key: str, buckets: int) -> dict:
    """Write a frame in buckets of a key, a file a bucket; what is returned declares it again."""
    name = f"evigraph_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay
    return {"columns": [list(x) for x in df.dtypes], "key": key, "buckets": buckets}


def save_clustered(g: Graph, out: str, buckets: int = BUCKETS, by_target: bool = True) -> dict:
    """Write a graph's nodes and both copies of its edges, or that by source alone; what is returned opens it."""
    about = {"nodes": {}, "edges": {}, "by_target": {}, "ends": {k: list(v) for k, v in g.ends.items()}, "above": g.above}
    for label, df in g.nodes.items():
        about["nodes"][label] = _written(df, f"{out}/nodes/{label}", "id", buckets)
    for kind, df in g.edges.items():
        about["edges"][kind] = _written(df, f"{out}/edges/{kind}", "src", buckets)
        if by_target:
            about["by_target"][kind] = _written(df, f"{out}/edges_by_target/{kind}", "dst", buckets)
    return about


def open_clustered(spark: SparkSession, out: str, about: dict) -> Graph:
    """The graph that save_clustered wrote."""
    g = Graph(above=about["above"], ends={k: tuple(v) for k, v in about["ends"].items()})
    for part, folder, into in (("nodes", "nodes", g.nodes), ("edges", "edges", g.edges), ("by_target", "edges_by_target", g.by_target)):
        for name, x in about[part].items():
            into[name] = _declared(spark, f"{out}/{folder}/{name}", [tuple(c) for c in x["columns"]], x["key"], x["buckets"])
    return g
