"""Named analytics over the evidence graph (Q-D1 to Q-D18) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, search
from ..operators.graph import nodes_of, path_between, relationships_of
from .model import graph, reports, saved_graph, t
from .registry import query

HITS = list(range(1, 41))


@query("d1_hitlist_overlap", f"""
SELECT l_orderkey AS order_id, count(DISTINCT l_partkey) AS overlap, any_value(size) AS order_size
FROM lineitem JOIN (SELECT l_orderkey AS k, count(*) AS size FROM lineitem GROUP BY 1) s ON l_orderkey = k
WHERE l_partkey IN ({", ".join(map(str, HITS))}) GROUP BY 1 HAVING count(DISTINCT l_partkey) >= 2
ORDER BY overlap DESC, order_id LIMIT 25""")
def d1(spark, sf):
    hits = spark.createDataFrame([(x,) for x in HITS], "part_id long")
    e = reports(spark, sf)
    own = e.join(F.broadcast(hits), e["l_partkey"] == hits["part_id"]).groupBy("l_orderkey").agg(F.count_distinct("l_partkey").alias("overlap")).filter("overlap >= 2")
    size = e.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("order_size"))
    return own.join(size, "l_orderkey").select(F.col("l_orderkey").alias("order_id"), "overlap", "order_size").orderBy(F.desc("overlap"), "order_id").limit(25)


@query("d2_parallel_reports", """
WITH p AS (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL ORDER BY count(*) DESC, 1, 2 LIMIT 1)
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem JOIN p USING (l_partkey, l_suppkey)""")
def d2(spark, sf):
    e = reports(spark, sf)
    pair = e.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey", "l_suppkey").limit(1)
    return e.join(F.broadcast(pair), ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")  # one row


@query("d3_breadth", """
SELECT l_partkey AS part_id, count(DISTINCT s_nationkey) AS n_nations, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_reports
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1 HAVING count(DISTINCT s_nationkey) > 1 ORDER BY n_nations DESC, n_reports DESC, part_id LIMIT 25""")
def d3(spark, sf):
    """Counts by (part, supplier) come first, so that distinct suppliers and nations are counted over pairs; distinct orders are only asked of the 25 parts shown."""
    e = reports(spark, sf)
    pairs = e.groupBy(F.col("l_partkey").alias("part_id"), "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    nations = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    by_nation = pairs.join(nations, "l_suppkey").groupBy("part_id", "s_nationkey").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    got = by_nation.groupBy("part_id").agg(F.count(F.lit(1)).alias("n_nations"), F.sum("k").alias("n_suppliers"), F.sum("n").alias("n_reports")).filter("n_nations > 1")
    top = got.orderBy(F.desc("n_nations"), F.desc("n_reports"), "part_id").limit(25)
    held = e.join(F.broadcast(top.select("part_id")), e["l_partkey"] == F.col("part_id"))  # 25 rows
    known = held.join(nations, "l_suppkey", "left_semi")
    return top.join(known.groupBy("part_id").agg(F.count_distinct("l_orderkey").alias("n_orders")), "part_id").orderBy(F.desc("n_nations"), F.desc("n_reports"), "part_id")


TIERS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query("d4_tier_order", """
SELECT o_orderpriority AS tier, o_orderstatus AS status, count(*) AS n, count(DISTINCT o_custkey) AS n_customers,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS rank
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1, 2""")
def d4(spark, sf):
    rank = F.when(F.col("tier") == "1-URGENT", 1).when(F.col("tier") == "2-HIGH", 2).otherwise(3)
    o = t(spark, sf, "orders").filter(F.col("o_orderpriority").isin(TIERS))
    got = o.groupBy(F.col("o_orderpriority").alias("tier"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_customers"))
    return got.withColumn("rank", rank).orderBy("rank", F.desc("n"), "status")


@query("d4_listing", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
def d4b(spark, sf):
    return t(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@query("d5_listing", "SELECT l_partkey AS part_id, p_name, l_quantity, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey = 1")
def d5(spark, sf):
    g = saved_graph(spark, sf, ("SUPPLIES",), by_target=False)
    rows = g.hop(g.nodes["Supplier"].filter("id = 1").select("id"), "SUPPLIES", "id", "part_id")
    return rows.join(g.nodes["Part"].select(F.col("id").alias("part_id"), "p_name"), "part_id").select("part_id", "p_name", F.col("SUPPLIES_l_quantity").alias("l_quantity"), F.col("SUPPLIES_l_orderkey").alias("l_orderkey"))


@query("d5_reverse", """
SELECT s_suppkey AS supplier_id, s_name, count(*) AS n_reports, count(DISTINCT l_orderkey) AS n_orders FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_partkey = 1 GROUP BY 1, 2""")
def d5b(spark, sf):
    g = saved_graph(spark, sf)
    rows = g.hop(g.nodes["Part"].filter("id = 1").select("id"), "SUPPLIES", "id", "supplier_id", back=True)
    rows = rows.join(g.nodes["Supplier"].select(F.col("id").alias("supplier_id"), "s_name"), "supplier_id")
    return rows.groupBy("supplier_id", "s_name").agg(F.count(F.lit(1)).alias("n_reports"), F.count_distinct("SUPPLIES_l_orderkey").alias("n_orders"))


@query("d6_exchange_score", """
WITH p AS (SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS p FROM lineitem WHERE l_discount >= 0.05 GROUP BY 1),
     c AS (SELECT l_partkey AS k, count(DISTINCT o_custkey) AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT p_partkey AS part_id, coalesce(p, 0) AS producers, coalesce(c, 0) AS consumers,
       round(CASE WHEN coalesce(p, 0) + coalesce(c, 0) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * coalesce(p, 0) * coalesce(c, 0) / (coalesce(p, 0) + coalesce(c, 0)) END, 6) AS score
FROM part LEFT JOIN p ON p.k = p_partkey LEFT JOIN c ON c.k = p_partkey ORDER BY score DESC, part_id LIMIT 20""")
def d6(spark, sf):
    """Both optional legs are counted before they are joined, so they never multiply."""
    e = reports(spark, sf)
    p = e.filter("l_discount >= 0.05").groupBy(F.col("l_partkey").alias("part_id")).agg(F.count_distinct("l_suppkey").alias("producers"))
    o = t(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_custkey")
    c = e.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_partkey").alias("part_id")).agg(F.count_distinct("o_custkey").alias("consumers"))
    rows = t(spark, sf, "part").select(F.col("p_partkey").alias("part_id")).join(p, "part_id", "left").join(c, "part_id", "left").fillna(0, ["producers", "consumers"])
    both = F.col("producers") + F.col("consumers")
    score = F.when(both == 0, 0.0).otherwise(F.lit(2.0).cast("double") * F.col("producers") * F.col("consumers") / both)
    return rows.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), "part_id").limit(20)


@query("d6_refutations", """
SELECT l_partkey AS part_id, l_suppkey AS supplier_id, count(*) AS n FROM lineitem x WHERE l_returnflag = 'R'
AND EXISTS (SELECT 1 FROM lineitem y WHERE y.l_partkey = x.l_partkey AND y.l_suppkey = x.l_suppkey AND y.l_returnflag = 'N') GROUP BY 1, 2""")
def d6c(spark, sf):
    e = reports(spark, sf).select("l_partkey", "l_suppkey", "l_returnflag")
    flags = e.groupBy("l_partkey", "l_suppkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("n"), F.bool_or(F.col("l_returnflag") == "N").alias("held"))
    return flags.filter("held and n > 0").select(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"), "n")


@query("d7_optional_fanout", """
SELECT c_custkey AS customer_id, o_orderkey AS order_id, l_partkey AS part_id, l_linenumber AS line
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'""")
def d7(spark, sf):
    g = graph(spark, sf)
    rows = g.hop(g.nodes["Customer"].select(F.col("id").alias("customer_id")), "PLACED_BY", "customer_id", "order_id", F.col("o_orderpriority") == "1-URGENT", back=True, optional=True)
    rows = g.hop(rows, "CONTAINS", "order_id", "part_id", F.col("l_returnflag") == "R", optional=True)
    return rows.select("customer_id", "order_id", "part_id", F.col("CONTAINS_l_linenumber").alias("line"))


@query("d8_hit_vs_nonhit", """
SELECT CASE WHEN l_discount < 0.03 THEN 'HIT' WHEN l_discount >= 0.03 THEN 'NO_EFFECT' END AS relation, count(*) AS n, count(DISTINCT l_partkey) AS n_parts
FROM lineitem WHERE l_discount IS NOT NULL GROUP BY 1""")
def d8(spark, sf):
    from ..operators.classify import hit

    e = reports(spark, sf).withColumn("hit", hit(F.col("l_discount"), 0.03)).filter("hit is not null")
    return e.groupBy(F.when(F.col("hit"), "HIT").otherwise("NO_EFFECT").alias("relation")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts"))


@query("d8_multi_outcome", """
SELECT l_suppkey AS supplier_id, count(*) FILTER (WHERE l_discount < 0.03) AS n_hit, count(*) FILTER (WHERE l_discount >= 0.03) AS n_no_effect,
       count(*) FILTER (WHERE l_tax >= 0.05) AS n_taxed, count(*) FILTER (WHERE l_tax < 0.05) AS n_not_taxed FROM lineitem GROUP BY 1""")
def d8b(spark, sf):
    n = lambda c, name: F.count(F.when(F.expr(c), 1)).alias(name)
    return reports(spark, sf).groupBy(F.col("l_suppkey").alias("supplier_id")).agg(n("l_discount < 0.03", "n_hit"), n("l_discount >= 0.03", "n_no_effect"), n("l_tax >= 0.05", "n_taxed"), n("l_tax < 0.05", "n_not_taxed"))


@query("d8_targets", """
SELECT DISTINCT s_suppkey AS supplier_id, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def d8c(spark, sf):
    n = t(spark, sf, "nation").join(t(spark, sf, "region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("supplier_id"), F.col("n_name").alias("nation")).distinct()


@query("d9_conditional_share", """
SELECT p_brand AS brand, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       round(100.0::DOUBLE * count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 6) AS share FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def d9(spark, sf):
    e = reports(spark, sf).select("l_partkey", "l_returnflag").join(t(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    got = e.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"))
    return got.withColumn("share", F.round(F.lit(100.0).cast("double") * F.col("n_returned") / F.col("n"), 6))


@query("d9_variants", """
SELECT l_returnflag AS flag, l_linestatus AS status, n_name AS nation, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def d9b(spark, sf):
    s = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return reports(spark, sf).join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("n_name").alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query("d10_candidates", """
WITH r AS (SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS n_suppliers, count(*) AS n_returns FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 2),
     o AS (SELECT l_partkey AS k, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1), d AS (SELECT l_partkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem WHERE l_discount > 0.09 GROUP BY 1)
SELECT r.k AS part_id, p_name, n_suppliers, n_returns, coalesce(o.n, 0) AS n_large, coalesce(d.n, 0) AS n_discounting
FROM r JOIN part ON p_partkey = r.k LEFT JOIN o ON o.k = r.k LEFT JOIN d ON d.k = r.k ORDER BY n_suppliers DESC, n_returns DESC, part_id LIMIT 20""")
def d10(spark, sf):
    """Ranked by returns alone; the other legs are only asked of the 20 parts shown."""
    e = reports(spark, sf)
    pairs = e.filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("part_id"), "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    got = pairs.groupBy("part_id").agg(F.count(F.lit(1)).alias("n_suppliers"), F.sum("n").alias("n_returns")).filter("n_suppliers >= 2")
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), "p_name")
    top = got.join(p, "part_id").orderBy(F.desc("n_suppliers"), F.desc("n_returns"), "part_id").limit(20)
    legs = e.join(F.broadcast(top.select("part_id")), e["l_partkey"] == F.col("part_id")).groupBy("part_id").agg(  # 20 rows
        F.count_distinct(F.when(F.col("l_quantity") > 45, F.col("l_orderkey"))).alias("n_large"), F.count_distinct(F.when(F.col("l_discount") > 0.09, F.col("l_suppkey"))).alias("n_discounting")
    )
    return top.join(legs, "part_id").select("part_id", "p_name", "n_suppliers", "n_returns", "n_large", "n_discounting").orderBy(F.desc("n_suppliers"), F.desc("n_returns"), "part_id")


@query("d11_columns", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size = 7")
def d11(spark, sf):
    p = t(spark, sf, "part").filter("p_size = 7").select("p_partkey")
    return reports(spark, sf).join(p, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("d12_bm25_lookup", """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     c AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'work')) AS b FROM d),
     s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
SELECT doc_id AS doc, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6)::DOUBLE AS score
FROM c, s WHERE a > 0 OR b > 0""")
def d12(spark, sf):
    return search.bm25(t(spark, sf, "documents"), "doc_id", "text", "work license").select("doc", F.round("score", 6).alias("score"))


@query("d12_audit_trail", "SELECT lang, source, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1, 2")
def d12b(spark, sf):
    return t(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


@query("d13_three_hop", """
SELECT l_partkey AS part_id, s_suppkey AS supplier_id, n_name AS nation, r_name AS region, l_orderkey AS order_id
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_partkey <= 20""")
def d13(spark, sf):
    g = saved_graph(spark, sf)
    rows = g.hop(g.nodes["Part"].filter("id <= 20").select(F.col("id").alias("part_id")), "SUPPLIES", "part_id", "supplier_id", back=True)
    rows = g.hop(g.hop(rows, "SUPPLIER_IN", "supplier_id", "nation_id"), "NATION_IN", "nation_id", "region_id")
    n, r = g.nodes["Nation"].select(F.col("id").alias("nation_id"), F.col("n_name").alias("nation")), g.nodes["Region"].select(F.col("id").alias("region_id"), F.col("r_name").alias("region"))
    return rows.join(n, "nation_id").join(r, "region_id").select("part_id", "supplier_id", "nation", "region", F.col("SUPPLIES_l_orderkey").alias("order_id"))


@query("d14_breadth_ratio", """
WITH p AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, count(*) AS n_types, sum(n)::BIGINT AS n_events, round(count(*)::DOUBLE / sum(n)::DOUBLE, 6) AS ratio, count(*) >= 4 AS broad FROM p GROUP BY 1 ORDER BY ratio DESC, user_id LIMIT 20""")
def d14(spark, sf):
    p = t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    got = p.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_types"), F.sum("n").alias("n_events"))
    return got.select("user_id", "n_types", "n_events", F.round(F.col("n_types") / F.col("n_events"), 6).alias("ratio"), (F.col("n_types") >= 4).alias("broad")).orderBy(F.desc("ratio"), "user_id").limit(20)


def labelled(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").join(t(spark, sf, "labels"), "doc_id", "left")


CONTRACT = audit.Rule("LABELLED", ("quality", "toxic"), "warn", (("lang_code", "bigint"),))


@query("d15_audit", """
WITH d AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN lang ELSE doc_id::VARCHAR END AS lang_code FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'LABELLED.required_properties' AS rule, 'warn' AS severity, count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS violations, 0 AS exempted, count(*) AS total,
round(100.0::DOUBLE * count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) / count(*), 6) AS pct FROM d UNION ALL
SELECT 'LABELLED.type_lang_code', 'warn', count(*) FILTER (WHERE lang_code IS NOT NULL AND try_cast(lang_code AS BIGINT) IS NULL), 0, count(*), round(100.0::DOUBLE * count(*) FILTER (WHERE lang_code IS NOT NULL AND try_cast(lang_code AS BIGINT) IS NULL) / count(*), 6) FROM d""")
def d15(spark, sf):
    code = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(F.col("doc_id").cast("string"))
    return audit.audit(labelled(spark, sf).withColumn("lang_code", code), CONTRACT)


@query("d15_census", """
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) SELECT 'lang' AS property, count(*) - count(lang) AS missing, count(*) AS total FROM d
UNION ALL SELECT 'quality', count(*) - count(quality), count(*) FROM d UNION ALL SELECT 'toxic', count(*) - count(toxic), count(*) FROM d UNION ALL SELECT 'n_chars', count(*) - count(n_chars), count(*) FROM d""")
def d15b(spark, sf):
    return audit.census(labelled(spark, sf), ["lang", "quality", "toxic", "n_chars"])


@query("d15_violations", "SELECT doc_id, 'quality' AS property, 'quality|toxic' AS properties FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def d15c(spark, sf):
    return audit.violations(labelled(spark, sf), ["doc_id"], ["quality", "toxic"]).withColumn("properties", F.array_join("properties", "|"))


@query("d15_source_census", """
SELECT 'LABELLED.required_properties' AS rule, 'warn' AS severity, source, count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS violations, 0 AS exempted, count(*) AS total,
round(100.0::DOUBLE * count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) / count(*), 6) AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def d15d(spark, sf):
    return audit.audit(labelled(spark, sf), audit.Rule("LABELLED", ("quality", "toxic")), ["source"])


@query("d16_shortest_path", """
WITH RECURSIVE goal AS (SELECT 's' || min(s_suppkey) AS a FROM supplier JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c.n_regionkey = s.n_regionkey JOIN customer ON c_nationkey = c.n_nationkey WHERE c_custkey = 1),
e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w AS (SELECT 'c1' AS node, 0 AS hops, ['c1'] AS path UNION ALL SELECT b, hops + 1, list_append(path, b) FROM w JOIN u ON a = node WHERE hops < 4 AND NOT list_contains(path, b) AND (b NOT LIKE 'c%') AND (b NOT LIKE 's%' OR b = (SELECT a FROM goal)))
SELECT hops, array_to_string(min(path), '>') AS path FROM w WHERE node = (SELECT a FROM goal) GROUP BY hops ORDER BY hops LIMIT 1""")
def d16(spark, sf):
    return _path(spark, sf).select("hops", F.array_join(nodes_of("p"), ">").alias("path"))


def _path(spark, sf):
    """A shortest path from the first customer to the first supplier of its region, with its edges."""
    link = lambda df, a, p, b, q, kind: df.select(F.concat(F.lit(p), a).alias("src"), F.concat(F.lit(q), b).alias("dst"), F.concat(F.lit(p), a).alias("edge_id"), F.lit(kind).alias("type"))
    e = link(t(spark, sf, "customer"), "c_custkey", "c", "c_nationkey", "n", "CUSTOMER_IN").unionByName(link(t(spark, sf, "supplier"), "s_suppkey", "s", "s_nationkey", "n", "SUPPLIER_IN"))
    e = e.unionByName(link(t(spark, sf, "nation"), "n_nationkey", "n", "n_regionkey", "r", "NATION_IN"))
    n = t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    home = t(spark, sf, "customer").filter("c_custkey = 1").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey")
    near = t(spark, sf, "supplier").join(n.join(home, "n_regionkey", "left_semi"), F.col("s_nationkey") == F.col("n_nationkey")).agg(F.min("s_suppkey")).first()[0]
    return path_between(e, "c1", f"s{near}", 4)


@query("d16_path_value", """
WITH RECURSIVE goal AS (SELECT 's' || min(s_suppkey) AS a FROM supplier JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c.n_regionkey = s.n_regionkey JOIN customer ON c_nationkey = c.n_nationkey WHERE c_custkey = 1),
e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b, 'CUSTOMER_IN:c' || c_custkey AS e FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey, 'SUPPLIER_IN:s' || s_suppkey FROM supplier UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'NATION_IN:n' || n_nationkey FROM nation),
u AS (SELECT a, b, e FROM e UNION SELECT b, a, e FROM e),
w AS (SELECT 'c1' AS node, 0 AS hops, ['c1'] AS path, []::VARCHAR[] AS rels UNION ALL SELECT b, hops + 1, list_append(path, b), list_append(rels, e) FROM w JOIN u ON a = node WHERE hops < 4 AND NOT list_contains(path, b) AND (b NOT LIKE 'c%') AND (b NOT LIKE 's%' OR b = (SELECT a FROM goal))),
p AS (SELECT * FROM w WHERE node = (SELECT a FROM goal) ORDER BY hops, path LIMIT 1)
SELECT unnest(range(0, hops)) AS at, unnest(path[1:hops]) AS near, unnest(path[2:]) AS far, unnest(rels) AS edge FROM p""")
def d16_value(spark, sf):
    """The same path as a value, taken apart: its nodes and its relationships in order."""
    n, r = nodes_of("p"), relationships_of("p")
    steps = _path(spark, sf).select(F.posexplode(F.arrays_zip(F.slice(n, F.lit(1), F.size(n) - 1).alias("near"), F.slice(n, F.lit(2), F.size(n) - 1).alias("far"), r.alias("rel"))).alias("at", "x"))
    return steps.select(F.col("at").cast("long").alias("at"), "x.near", "x.far", F.concat_ws(":", "x.rel.type", "x.rel.edge_id").alias("edge"))


@query("d16_evidence_path", """
SELECT c_custkey AS customer_id, o_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_custkey = 1""")
def d16b(spark, sf):
    o = t(spark, sf, "orders").filter("o_custkey = 1")
    return reports(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"))


@query("d17_disagreement", """
SELECT l_partkey AS part_id, l_suppkey AS supplier_id, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS flags, count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_reports,
       count(DISTINCT l_returnflag) > 1 AS conflicting, count(DISTINCT l_orderkey) = 1 AS single FROM lineitem GROUP BY 1, 2 ORDER BY conflicting DESC, n_reports DESC, part_id, supplier_id LIMIT 50""")
def d17(spark, sf):
    """The flagship: reports of a pair stay apart, null flags are no flag. Pairs are ranked by numbers that a hash aggregate holds; flags and orders are only gathered for the 50 shown."""
    e, pair = reports(spark, sf), [F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")]
    code = F.when(F.col("l_returnflag").isNotNull(), F.xxhash64("l_returnflag"))
    ranked = e.groupBy(*pair).agg(F.count(F.lit(1)).alias("n_reports"), (F.min(code) != F.max(code)).alias("c"))
    order = [F.desc("conflicting"), F.desc("n_reports"), "part_id", "supplier_id"]
    top = ranked.select("part_id", "supplier_id", "n_reports", F.coalesce("c", F.lit(False)).alias("conflicting")).orderBy(*order).limit(50)
    held = e.select(*pair, "l_returnflag", "l_orderkey").join(F.broadcast(top.select("part_id", "supplier_id")), ["part_id", "supplier_id"])  # 50 rows
    more = held.groupBy("part_id", "supplier_id").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), "|").alias("flags"), F.count_distinct("l_orderkey").alias("n_orders"))
    return top.join(more, ["part_id", "supplier_id"]).select("part_id", "supplier_id", "flags", "n_orders", "n_reports", "conflicting", (F.col("n_orders") == 1).alias("single")).orderBy(*order)


@query("d18_competing", """
WITH a AS (SELECT l_partkey AS k, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS nations FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_returnflag = 'R' GROUP BY 1),
     b AS (SELECT l_partkey AS k, count(DISTINCT o_custkey) AS n_customers, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS tiers FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
     c AS (SELECT l_partkey AS k, count(*) AS n_heavy FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 40 GROUP BY 1)
SELECT p_partkey AS part_id, nations, n_customers, tiers, coalesce(n_heavy, 0) AS n_heavy FROM part JOIN a ON a.k = p_partkey JOIN b ON b.k = p_partkey LEFT JOIN c ON c.k = p_partkey""")
def d18(spark, sf):
    e = reports(spark, sf)
    s = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    a = e.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("l_partkey").alias("part_id")).agg(joined("n_name").alias("nations"))
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    b = e.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_partkey").alias("part_id")).agg(F.count_distinct("o_custkey").alias("n_customers"), joined("o_orderpriority").alias("tiers"), F.count(F.when((F.col("l_discount") > 0.09) & (F.col("l_quantity") > 40), 1)).alias("n_heavy"))
    return t(spark, sf, "part").select(F.col("p_partkey").alias("part_id")).join(a, "part_id").join(b, "part_id")
