"""Procedures inside statements (I1, I4, H2): SQL table functions over a graph's audit and its text indexes, with named arguments and defaults. They only read, so the read-only guard lets them pass, they can stand beside other
relations in a FROM clause, and Catalyst inlines them: an argument that is a constant reaches the scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit
from .graph import Graph
from .postings import K1, PARTS, B
from .search import Indexes

AUDIT = "rule string, severity string, violations long, exempted long, total long, pct double"
VIOLATIONS = "type string, source string, target string, property string, properties string"
BLOCKS = "label string, property string, n_docs long, avgdl double, part int, term string, n int, docs array<string>, tfs array<int>, dls array<int>"

SHARES = 256
ASKED = f"SELECT term, CAST(pmod(crc32(CAST(term AS BINARY)), {PARTS}) AS INT) AS part FROM (SELECT explode(array_distinct(filter(split(lower(text_search.q), '[^a-z0-9]+'), t -> t != ''))) AS term)"

FUNCTIONS = {
    "ontology_audit": """(level STRING DEFAULT 'all') RETURNS TABLE (rule STRING, severity STRING, violations BIGINT, exempted BIGINT, total BIGINT, pct DOUBLE)
        RETURN SELECT rule, severity, violations, exempted, total, pct FROM evigraph_audit WHERE ontology_audit.level = 'all' OR severity = ontology_audit.level""",
    "edge_property_violation": """(kind STRING DEFAULT 'all', missing STRING DEFAULT 'any') RETURNS TABLE (type STRING, source STRING, target STRING, property STRING, properties STRING)
        RETURN SELECT type, source, target, property, properties FROM evigraph_violations
        WHERE (edge_property_violation.kind = 'all' OR type = edge_property_violation.kind)
          AND (edge_property_violation.missing = 'any' OR array_contains(split(properties, '[|]'), edge_property_violation.missing))""",
    # the documents of a term are counted from the heads of its blocks, so its postings stay where they are read; the first k of each of SHARES hold the first k of all
    "text_search": f"""(kind STRING, prop STRING, q STRING, k INT DEFAULT 10) RETURNS TABLE (doc STRING, score DOUBLE)
        RETURN SELECT doc, score FROM (SELECT doc, score, row_number() OVER (ORDER BY score DESC, doc) AS place FROM (
          SELECT doc, score, row_number() OVER (PARTITION BY pmod(xxhash64(doc), {SHARES}) ORDER BY score DESC, doc) AS near FROM (
            SELECT p.docs AS doc, sum(ln(1 + (n_docs - df + 0.5D) / (df + 0.5D)) * p.tfs * {K1 + 1}D / (p.tfs + {K1}D * ({1 - B}D + {B}D * p.dls / avgdl))) AS score
            FROM (SELECT b.*, f.df FROM evigraph_blocks b JOIN (
                    SELECT h.term, h.part, sum(h.n) AS df FROM evigraph_blocks h JOIN ({ASKED}) a ON h.term = a.term AND h.part = a.part
                    WHERE h.label = text_search.kind AND h.property = text_search.prop GROUP BY h.term, h.part) f ON b.term = f.term AND b.part = f.part
                  JOIN ({ASKED}) c ON b.term = c.term AND b.part = c.part
                  WHERE b.label = text_search.kind AND b.property = text_search.prop)
            LATERAL VIEW explode(arrays_zip(docs, tfs, dls)) AS p GROUP BY p.docs)) WHERE near <= text_search.k) WHERE place <= text_search.k""",
}


def _union(spark: SparkSession, parts: list[DataFrame], columns: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], columns)


def register(spark: SparkSession, g: Graph, rules: list[audit.Rule], indexes: Indexes | None = None) -> list[str]:
    """Declare the procedures for this session over a graph's edges, the rules for them, and a registry's text indexes; their names. Rules without edges are left out; what is declared anew replaces what was there."""
    held = [(r.name.split(".")[0], r) for r in rules]
    held = [(kind, r) for kind, r in held if kind in g.edges]
    _union(spark, [audit.audit(g.edges[kind], r) for kind, r in held], AUDIT).createOrReplaceTempView("evigraph_audit")
    lost = []
    for kind, r in held:
        rows = audit.violations(g.edges[kind], ["src", "dst"], list(r.required))
        lost.append(rows.select(F.lit(kind).alias("type"), F.col("src").cast("string").alias("source"), F.col("dst").cast("string").alias("target"), "property", F.array_join("properties", "|").alias("properties")))
    _union(spark, lost, VIOLATIONS).createOrReplaceTempView("evigraph_violations")
    blocks = []
    for (label, prop), made in (indexes.texts if indexes else {}).items():
        head = [F.lit(label).alias("label"), F.lit(prop).alias("property"), F.lit(made.n).cast("long").alias("n_docs"), F.lit(float(made.avgdl)).alias("avgdl")]
        blocks.append(made.blocks.select(*head, "part", "term", "n", F.transform("docs", lambda x: x.cast("string")).alias("docs"), "tfs", "dls"))
    _union(spark, blocks, BLOCKS).createOrReplaceTempView("evigraph_blocks")
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return sorted(FUNCTIONS)
