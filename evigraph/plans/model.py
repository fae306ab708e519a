"""The driver's tables as an evidence graph: lineitem rows are parallel edges between a supplier, a part and an order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from ..operators import storage
from ..operators.graph import Graph, shared_folder


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The junction edge: one row a line, never merged."""
    return t(spark, sf_dir, "lineitem")


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    g = Graph()
    region, nation, customer, supplier, part, orders = (t(spark, sf_dir, n) for n in ("region", "nation", "customer", "supplier", "part", "orders"))
    g.add_nodes("Region", region, "r_regionkey").add_nodes("Nation", nation, "n_nationkey")
    g.add_nodes("Customer", customer, "c_custkey", ("Party",)).add_nodes("Supplier", supplier, "s_suppkey", ("Party",))
    g.add_nodes("Part", part, "p_partkey").add_nodes("Order", orders, "o_orderkey")
    g.add_edges("NATION_IN", nation, "n_nationkey", "n_regionkey", "Nation", "Region")
    g.add_edges("CUSTOMER_IN", customer, "c_custkey", "c_nationkey", "Customer", "Nation")
    g.add_edges("SUPPLIER_IN", supplier, "s_suppkey", "s_nationkey", "Supplier", "Nation")
    g.add_edges("PLACED_BY", orders, "o_orderkey", "o_custkey", "Order", "Customer")
    lines = reports(spark, sf_dir)
    g.add_edges("SUPPLIES", lines, "l_suppkey", "l_partkey", "Supplier", "Part")
    g.add_edges("CONTAINS", lines, "l_orderkey", "l_partkey", "Order", "Part")
    return g


#: What the saved graph of the point queries holds.
SAVED = ("NATION_IN", "SUPPLIER_IN", "SUPPLIES")


#: Edges to a bucket of the saved graph, so that a task sorts no more as they grow.
BUCKET_EDGES = 2_000_000


def saved_graph(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = SAVED, by_target: bool = True) -> Graph:
    """The graph as a build saves it, clustered by id and by both ends of its edges; written to the shared folder when a session first asks for it. A query that passes some types forwards asks for these alone, and takes the
    whole where that is written."""
    held = spark.sparkContext.__dict__.setdefault("_evigraph_saved", {})
    key = (sf_dir, SAVED, True)
    if key not in held:
        key = (sf_dir, kinds, by_target)
    if key not in held:
        g = graph(spark, sf_dir)
        labels = {x for kind in kinds for x in g.ends[kind]}
        small = Graph({k: df for k, df in g.nodes.items() if k in labels}, {k: g.edges[k] for k in kinds}, {k: g.ends[k] for k in kinds})
        buckets = max([storage.BUCKETS, *[math.ceil(e.count() / BUCKET_EDGES) for e in small.edges.values()]])
        out = shared_folder(spark, "graph")
        held[key] = storage.open_clustered(spark, out, storage.save_clustered(small, out, buckets, by_target))
    return held[key]
