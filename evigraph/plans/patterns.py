"""Graph patterns, table building, reconciliation and search over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, classify, reconcile, search, tables
from ..operators.graph import closure, nodes_of, relationships_of, variable_length, walks
from .evidence import labelled
from .model import graph, reports, saved_graph, t
from .registry import query


@query("lineage_walk", """
WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
w AS (SELECT a AS node, b AS ancestor, 1 AS depth FROM e UNION ALL SELECT node, b, depth + 1 FROM w JOIN e ON ancestor = a) SELECT node, ancestor, depth FROM w""")
def lineage(spark, sf):
    e = t(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("child"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))
    return closure(e.unionByName(t(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))))


@query("variable_length", """
SELECT s_suppkey AS start, CASE h WHEN 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS node, h::INT AS hops FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES (1), (2)) v(h)""")
def var_length(spark, sf):
    s = t(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("src"), F.concat(F.lit("n"), "s_nationkey").alias("dst"))
    n = t(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("src"), F.concat(F.lit("r"), "n_regionkey").alias("dst"))
    e = s.unionByName(n).withColumn("edge_id", F.xxhash64("src", "dst"))
    got = variable_length(e, s.select(F.col("src").alias("id")), 1, 2)
    return got.select(F.substring("start", 2, 20).cast("long").alias("start"), "node", "hops")


@query("path_values", """
SELECT s_suppkey AS start, h::INT AS hops, 's' || s_suppkey || '>n' || n_nationkey || CASE h WHEN 2 THEN '>r' || n_regionkey ELSE '' END AS nodes,
'SUPPLIER_IN:s' || s_suppkey || CASE h WHEN 2 THEN '>NATION_IN:n' || n_nationkey ELSE '' END AS relationships FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES (1), (2)) v(h)""")
def path_values(spark, sf):
    """Walks of one or two hops as values: nodes(p) and relationships(p) of each."""
    link = lambda df, a, p, b, q, kind: df.select(F.concat(F.lit(p), a).alias("src"), F.concat(F.lit(q), b).alias("dst"), F.concat(F.lit(p), a).alias("edge_id"), F.lit(kind).alias("type"))
    s = link(t(spark, sf, "supplier"), "s_suppkey", "s", "s_nationkey", "n", "SUPPLIER_IN")
    got = walks(s.unionByName(link(t(spark, sf, "nation"), "n_nationkey", "n", "n_regionkey", "r", "NATION_IN")), s.select(F.col("src").alias("id")), 1, 2)
    edges = F.array_join(F.transform(relationships_of("p"), lambda r: F.concat_ws(":", r["type"], r["edge_id"])), ">")
    return got.select(F.substring("start", 2, 20).cast("long").alias("start"), "hops", F.array_join(nodes_of("p"), ">").alias("nodes"), edges.alias("relationships"))


@query("t_typed_counts", """
SELECT 'node' AS what, 'Customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'node', 'Supplier', count(*) FROM supplier UNION ALL SELECT 'node', 'Part', count(*) FROM part UNION ALL SELECT 'node', 'Order', count(*) FROM orders
UNION ALL SELECT 'node', 'Nation', count(*) FROM nation UNION ALL SELECT 'node', 'Region', count(*) FROM region UNION ALL SELECT 'edge', 'NATION_IN', count(*) FROM nation UNION ALL SELECT 'edge', 'CUSTOMER_IN', count(*) FROM customer
UNION ALL SELECT 'edge', 'SUPPLIER_IN', count(*) FROM supplier UNION ALL SELECT 'edge', 'PLACED_BY', count(*) FROM orders UNION ALL SELECT 'edge', 'SUPPLIES', count(*) FROM lineitem UNION ALL SELECT 'edge', 'CONTAINS', count(*) FROM lineitem""")
def typed_counts(spark, sf):
    return graph(spark, sf).counts()


@query("t_prefix", "SELECT p_name, min(p_partkey) AS part_id FROM part WHERE starts_with(p_name, 'b') GROUP BY 1 ORDER BY 1 LIMIT 20")
def prefix(spark, sf):
    rows = t(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("part_id"))
    return search.prefix(rows, "p_name", "b", 20)


@query("t_neighbourhood", """
SELECT 'SUPPLIER_IN' AS type, 'Nation' AS label, s_nationkey::VARCHAR AS node, count(*) AS n FROM supplier WHERE s_suppkey = 5 GROUP BY ALL
UNION ALL SELECT 'SUPPLIES', 'Part', l_partkey::VARCHAR, count(*) FROM lineitem WHERE l_suppkey = 5 GROUP BY ALL""")
def neighbourhood(spark, sf):
    e = saved_graph(spark, sf).slim_edges(["SUPPLIER_IN", "SUPPLIES"], undirected=True, at=("Supplier", 5))
    return e.groupBy("type", F.col("dst_label").alias("label"), F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n"))


@query("t_compare", """
SELECT l_partkey AS part_id, count(*) FILTER (WHERE l_suppkey = 1) AS n_a, count(*) FILTER (WHERE l_suppkey = 2) AS n_b FROM lineitem WHERE l_suppkey IN (1, 2) GROUP BY 1""")
def compare(spark, sf):
    e = reports(spark, sf).filter(F.col("l_suppkey").isin(1, 2))
    return e.groupBy(F.col("l_partkey").alias("part_id")).agg(F.count(F.when(F.col("l_suppkey") == 1, 1)).alias("n_a"), F.count(F.when(F.col("l_suppkey") == 2, 1)).alias("n_b"))


@query("v_pattern", """
SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND (a.l_orderkey, a.l_linenumber) <> (b.l_orderkey, b.l_linenumber) WHERE a.l_suppkey = 1 GROUP BY ALL""")
def v_pattern(spark, sf):
    key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("edge_id")
    e = reports(spark, sf).select(key, "l_partkey", "l_suppkey")
    one = e.filter("l_suppkey = 1").select(F.col("edge_id").alias("other"), "l_partkey", F.col("l_suppkey").alias("a"))
    return e.join(one, "l_partkey").filter("edge_id != other").groupBy("a", F.col("l_suppkey").alias("b")).agg(F.count(F.lit(1)).alias("n"))


@query("exists_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def exists_semi(spark, sf):
    g = graph(spark, sf)
    return g.exists(g.nodes["Customer"], "PLACED_BY", "id", F.col("o_orderpriority") == "1-URGENT", back=True).select(F.col("id").alias("c_custkey"))


@query("not_exists_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def not_exists(spark, sf):
    g = graph(spark, sf)
    return g.exists(g.nodes["Customer"], "PLACED_BY", "id", F.col("o_orderpriority") == "1-URGENT", back=True, negate=True).select(F.col("id").alias("c_custkey"))


@query("alternation_union", "SELECT 'CUSTOMER_IN' AS type, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL UNION ALL SELECT 'SUPPLIER_IN', s_nationkey, count(*) FROM supplier GROUP BY ALL")
def alternation(spark, sf):
    e = graph(spark, sf).slim_edges(["CUSTOMER_IN", "SUPPLIER_IN"])
    return e.groupBy("type", F.col("dst").cast("int").alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query("abstract_label", "SELECT 'Customer' AS label, count(*) AS n, max(c_custkey) AS last FROM customer UNION ALL SELECT 'Supplier', count(*), max(s_suppkey) FROM supplier")
def abstract_label(spark, sf):
    return graph(spark, sf).scan("Party").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))


@query("scalar_chain", "SELECT a, b, round(100.0::DOUBLE * a / b, 6) AS pct FROM (SELECT count(*) AS a FROM lineitem WHERE l_returnflag = 'R'), (SELECT count(*) AS b FROM lineitem)")
def scalar_chain(spark, sf):
    got = reports(spark, sf).agg(F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("a"), F.count(F.lit(1)).alias("b"))
    return got.withColumn("pct", F.round(F.lit(100.0).cast("double") * F.col("a") / F.col("b"), 6))


@query("unwind_param", "SELECT x AS part_id, (SELECT count(*) FROM lineitem WHERE l_partkey = x) AS n FROM unnest(range(1, 11)) u(x)")
def unwind(spark, sf):
    ids = spark.range(1, 11).withColumnRenamed("id", "part_id")
    n = reports(spark, sf).filter("l_partkey between 1 and 10").groupBy(F.col("l_partkey").alias("part_id")).agg(F.count(F.lit(1)).alias("n"))
    return ids.join(n, "part_id", "left").fillna(0)


@query("string_predicates", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_type, 'S') OR ends_with(p_name, 'd') OR contains(lower(p_name), 'gr')")
def strings(spark, sf):
    return t(spark, sf, "part").filter(F.col("p_type").startswith("S") | F.col("p_name").endswith("d") | F.lower("p_name").contains("gr")).select("p_partkey", "p_name")


@query("rank_window", "SELECT l_partkey AS part_id, l_suppkey AS supplier_id, rank() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC) AS rank FROM lineitem GROUP BY 1, 2")
def rank_window(spark, sf):
    from pyspark.sql import Window

    n = reports(spark, sf).groupBy(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("part_id", "supplier_id", F.rank().over(Window.partitionBy("part_id").orderBy(F.desc("n"))).alias("rank"))


@query("collect_slice", """
SELECT c_custkey AS customer_id, count(o_orderkey) AS n, array_to_string(list_sort(list(o_orderkey))[1:3], '|') AS shown FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1""")
def collect_slice(spark, sf):
    o = t(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.slice(F.array_sort(F.collect_list("o_orderkey")), 1, 3), "|").alias("shown"))
    return t(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id")).join(o, "customer_id", "left").fillna({"n": 0})


@query("g5_cross_source_agreement", """
WITH p AS (SELECT l_partkey AS k, l_returnflag AS f, count(DISTINCT s_nationkey) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT f AS flag, n AS n_sources, count(*) AS n_parts FROM p GROUP BY 1, 2""")
def agreement(spark, sf):
    e = reports(spark, sf).join(t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return e.groupBy("l_partkey", F.col("l_returnflag").alias("flag")).agg(F.count_distinct("s_nationkey").alias("n_sources")).groupBy("flag", "n_sources").agg(F.count(F.lit(1)).alias("n_parts"))


@query("tbl_first_wins", "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def first_wins(spark, sf):
    return tables.first_wins(t(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])


@query("tbl_owner_replace", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'click' UNION ALL SELECT event_id, event_type, value * 2 FROM events WHERE event_type = 'click'")
def owner_replace(spark, sf):
    e = t(spark, sf, "events").select("event_id", "event_type", "value")
    new = e.filter("event_type = 'click'").withColumn("value", F.col("value") * 2)
    return tables.owner_replace(tables.owner_replace(e, new, "event_type", "click"), new, "event_type", "click")


@query("tbl_sum_dup", "SELECT l_partkey, sum(l_linenumber)::BIGINT AS l_linenumber, arg_min(l_returnflag, (l_orderkey, l_linenumber)) AS l_returnflag FROM lineitem GROUP BY 1")
def sum_dup(spark, sf):
    # lines of one order and number are told apart by their place in the file
    rows = t(spark, sf, "lineitem").select("l_partkey", "l_orderkey", F.col("_metadata.row_index").alias("at"), F.col("l_linenumber").alias("seq"), F.col("l_linenumber").cast("string").alias("l_linenumber"), "l_returnflag")
    return tables.sum_on_duplicate(rows, ["l_partkey"], ["l_linenumber"], ["l_orderkey", "seq", "at"]).select("l_partkey", "l_linenumber", "l_returnflag")


@query("tbl_full_dedupe", "SELECT DISTINCT event_type::VARCHAR AS event_type, user_id::VARCHAR AS user_id FROM events")
def full_dedupe(spark, sf):
    return tables.full_dedupe(t(spark, sf, "events"), ["event_type", "user_id"])


@query("tbl_type_infer", "SELECT 'p_partkey' AS col UNION ALL SELECT 'p_size'")
def type_infer(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_brand", "p_retailprice")
    return spark.createDataFrame([(c,) for c in tables.infer_integers(p, ["p_partkey", "p_name", "p_size", "p_brand"])], "col string")


@query("tbl_list_codec", "SELECT p_partkey, string_split(p_name, ' ')[1] AS head, len(string_split(p_name, ' ')) AS n FROM part")
def list_codec(spark, sf):
    coded = t(spark, sf, "part").select("p_partkey", tables.encode_list(F.split("p_name", " ")).alias("x"))
    return coded.select("p_partkey", tables.decode_list(F.col("x")).alias("l")).select("p_partkey", F.element_at("l", 1).alias("head"), F.size("l").cast("long").alias("n"))


@query("tbl_collapse", "SELECT event_type, user_id, count(*) AS duplicate_rows FROM events GROUP BY 1, 2")
def collapse(spark, sf):
    return tables.collapse(t(spark, sf, "events"), ["event_type", "user_id"])


@query("tbl_cited", "SELECT l_partkey, count(*) AS n_cited, 'lines' AS source FROM lineitem GROUP BY 1")
def cited(spark, sf):
    return tables.cited(t(spark, sf, "lineitem"), "l_partkey", "lines")


@query("tbl_arms", "SELECT o_custkey, sum(o_orderkey)::BIGINT AS total_size, array_to_string(list_sort(list(o_orderkey)), '|') AS sizes, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1")
def arms(spark, sf):
    return tables.arms(t(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderpriority"]).withColumn("sizes", F.array_join("sizes", "|"))


@query("tbl_claim_merge", """
SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS claim, CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) FILTER (WHERE o_orderpriority = '1-URGENT')
ELSE string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) END AS names FROM orders GROUP BY 1""")
def claim_merge(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", (F.col("o_orderpriority") == "1-URGENT").alias("claim"), F.col("o_orderstatus").alias("names"))
    return tables.claim_merge(o, "o_custkey", "claim", "names", []).withColumn("names", F.array_join("names", "|"))


@query("rec_unique_key", "SELECT p_name || ' ' || p_brand || ' ' || p_size AS spelled, min(p_partkey) AS p_partkey FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) = 1")
def unique_key(spark, sf):
    return reconcile.unique_keys(t(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_size").alias("spelled"), "p_partkey"), "spelled", "p_partkey")


@query("rec_ambiguous", "SELECT p_name, count(DISTINCT p_partkey) AS n, array_to_string(list_sort(list(DISTINCT p_partkey)), '|') AS candidates FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def ambiguous(spark, sf):
    names = t(spark, sf, "part").select(F.col("p_partkey").alias("tax_id"), F.col("p_name").alias("name"), F.lit("scientific name").alias("name_class"))
    got = reconcile.name_index(names).filter(F.size("ids") > 1)
    return got.select(F.col("spelling").alias("p_name"), F.size("ids").cast("long").alias("n"), F.array_join("ids", "|").alias("candidates"))


@query("rec_exact_then_stripped", """
WITH a AS (SELECT 's' || s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_name || ' (Smith 1901)' END AS asked FROM supplier)
SELECT k, s_suppkey AS tax_id, s_suppkey % 2 = 1 AS normalized FROM a JOIN supplier ON k = 's' || s_suppkey""")
def stripped(spark, sf):
    s = t(spark, sf, "supplier")
    known = s.select("s_suppkey", "s_name", reconcile.casefold(F.trim("s_name")).alias("key"))
    asked = s.select(F.concat(F.lit("s"), "s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.concat("s_name", F.lit(" (Smith 1901)"))).alias("asked"))
    asked = asked.select("k", reconcile.casefold(F.trim("asked")).alias("exact"), reconcile.casefold(reconcile.strip_authority(F.col("asked"))).alias("bare"))
    e, b = known.select(F.col("key").alias("exact"), F.col("s_suppkey").alias("e")), known.select(F.col("key").alias("bare"), F.col("s_suppkey").alias("b"))
    got = asked.join(e, "exact", "left").join(b, "bare", "left")
    return got.select("k", F.coalesce("e", "b").alias("tax_id"), F.col("e").isNull().alias("normalized"))


@query("rec_route_join", """
SELECT c_custkey AS k, CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey ELSE n_nationkey END::BIGINT AS target, CASE WHEN s_suppkey IS NOT NULL THEN 'id' WHEN n_nationkey IS NOT NULL THEN 'nation' ELSE 'minted' END AS route
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20""")
def route_join(spark, sf):
    asked = t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.array(F.struct(F.lit(0).alias("pos"), F.lit("id").alias("kind"), F.col("c_custkey").cast("string").alias("value")), F.struct(F.lit(1).alias("pos"), F.lit("nation").alias("kind"), F.col("c_nationkey").cast("string").alias("value"))).alias("v"))
    index = t(spark, sf, "supplier").select(F.lit("id").alias("kind"), F.col("s_suppkey").cast("string").alias("value"), F.col("s_suppkey").cast("long").alias("target"))
    index = index.unionByName(t(spark, sf, "nation").filter("n_nationkey < 20").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("string").alias("value"), F.col("n_nationkey").cast("long").alias("target")))
    return reconcile.route_join(asked, "k", "v", index).select("k", "target", "route")


@query("rec_promote", "SELECT 1000 + c_custkey AS tax_id, 100 + c_nationkey::BIGINT AS promoted_id FROM customer UNION ALL SELECT 100 + n_nationkey, 100 + n_nationkey FROM nation UNION ALL SELECT 1 + r_regionkey, 1 + r_regionkey FROM region")
def promote(spark, sf):
    c = t(spark, sf, "customer").select((F.col("c_custkey") + 1000).alias("tax_id"), (F.col("c_nationkey") + 100).cast("long").alias("parent_id"), F.lit("strain").alias("rank"))
    n = t(spark, sf, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("tax_id"), (F.col("n_regionkey") + 1).cast("long").alias("parent_id"), F.lit("species").alias("rank"))
    r = t(spark, sf, "region").select((F.col("r_regionkey") + 1).cast("long").alias("tax_id"), (F.col("r_regionkey") + 1).cast("long").alias("parent_id"), F.lit("genus").alias("rank"))
    return reconcile.promotions(c.unionByName(n).unionByName(r))


@query("rec_disagreement", """
SELECT coalesce(c_custkey, s_suppkey) AS k, CASE WHEN s_suppkey IS NULL THEN 'left only' WHEN c_custkey IS NULL THEN 'right only' ELSE 'differs' END AS kind
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey IS DISTINCT FROM s_nationkey""")
def disagreement(spark, sf):
    a = t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"))
    return reconcile.disagreement(a, t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v")), "k", "v")


@query("json_flatten", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_flatten(spark, sf):
    return t(spark, sf, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("unpivot_matrix", """
SELECT p_partkey AS part_id, u.name AS col, u.value AS cell FROM part, LATERAL (VALUES ('p_size', p_size::DOUBLE), ('p_retailprice', p_retailprice)) u(name, value)""")
def unpivot(spark, sf):
    from ..sources.readers import unpivot_matrix

    wide = t(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_size").cast("double").alias("p_size"), "p_retailprice", "p_name")
    return unpivot_matrix(wide, ["part_id"], r"^p_(size|retailprice)$", "col", "cell")


@query("html_scan", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(html) AS n FROM pages")
def html(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.length("html").cast("long").alias("n"))


@query("vec_cosine_topk", """
WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id AS doc,
list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i]::DOUBLE * embedding[i]::DOUBLE)) / sqrt(list_sum(list_transform(q, lambda x: x::DOUBLE * x::DOUBLE)) * list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS score FROM embeddings, q)
SELECT doc, round(score, 6) AS score FROM s ORDER BY s.score DESC, doc LIMIT 10""")
def cosine(spark, sf):
    e = t(spark, sf, "embeddings")
    q = e.filter("vec_id = 0").select("embedding").first()[0]
    return search.cosine_top_k(e, "vec_id", "embedding", list(q), 10).withColumn("score", F.round("score", 6))


@query("chargram_vectors")
def chargram(spark, sf):
    got = search.chargram_vectors(t(spark, sf, "part"), "p_partkey", "p_name")
    return got.select("doc", F.round(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v), 6).alias("norm"), F.transform("vec", lambda v: F.round(v, 6)).alias("vec"))


@query("fuse_rank", """
WITH a AS (SELECT p_partkey AS doc, 1.0::DOUBLE AS s FROM part WHERE contains(p_name, 'a')), b AS (SELECT p_partkey AS doc, 2.0::DOUBLE AS s FROM part WHERE p_size > 25)
SELECT doc, sum(s) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def fuse(spark, sf):
    p = t(spark, sf, "part").withColumnRenamed("p_partkey", "doc")
    return search.fuse([p.filter(F.col("p_name").contains("a")).select("doc", F.lit(1.0).cast("double").alias("score")), p.filter("p_size > 25").select("doc", F.lit(1.0).cast("double").alias("score"))], [1.0, 2.0])


@query("two_stage_route")
def routed(spark, sf):
    """A query no name holds a word of: all parts are ranked by their names' vectors."""
    return search.find(t(spark, sf, "part"), "p_partkey", "p_name", "smal rng", 20).select("doc", F.round("score", 6).alias("score"), "route")


@query("two_stage_hit", """
WITH d AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part WHERE p_size > 10), s AS (SELECT count(*) AS n, avg(len(w)) AS avgdl, count(*) FILTER (WHERE list_contains(w, 'ring')) AS df FROM d)
SELECT p_partkey AS doc, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * len(w) / avgdl)), 6)::DOUBLE AS score, 'lexical' AS route FROM d, s WHERE list_contains(w, 'ring') ORDER BY 2 DESC, 1 LIMIT 20""")
def routed_hit(spark, sf):
    return search.find(t(spark, sf, "part"), "p_partkey", "p_name", "ring", 20, F.col("p_size") > 10).select("doc", F.round("score", 6).alias("score"), "route")


@query("expansion_factor", "SELECT l_returnflag AS source, count(*) AS n_edges, count(DISTINCT l_orderkey) AS n_records, round(count(*)::DOUBLE / count(DISTINCT l_orderkey), 6) AS factor FROM lineitem GROUP BY 1")
def expansion(spark, sf):
    return audit.expansion(reports(spark, sf).withColumnRenamed("l_returnflag", "source"), "source", "l_orderkey")


@query("rows_equal_edges", "SELECT 'SUPPLIES' AS type, count(*) AS n_rows, count(*) AS n_edges, 0::BIGINT AS dangling FROM lineitem")
def rows_equal_edges(spark, sf):
    g = graph(spark, sf)
    n_rows = t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))
    n_edges = g.identified("SUPPLIES").agg(F.count_distinct("edge_id").alias("n_edges"))
    dangling = g.dangling("SUPPLIES").agg(F.count(F.lit(1)).alias("dangling"))
    return n_rows.crossJoin(n_edges).crossJoin(dangling).select(F.lit("SUPPLIES").alias("type"), "*")  # one row each


@query("coverage_score", """
WITH c AS (SELECT p_partkey AS l_partkey, p_partkey % 100 + 1 AS l_suppkey, 'R' AS d FROM part), h AS (SELECT l_partkey, l_suppkey, list(DISTINCT l_returnflag) AS f FROM lineitem GROUP BY 1, 2)
SELECT CASE WHEN f IS NULL THEN 'absent' WHEN len(f) > 1 THEN 'split' WHEN f[1] = d THEN 'agree' ELSE 'contradict' END AS outcome, count(*) AS n FROM c LEFT JOIN h USING (l_partkey, l_suppkey) GROUP BY 1""")
def coverage(spark, sf):
    claims = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_partkey") % 100 + 1).alias("l_suppkey"), F.lit("R").alias("l_returnflag"))
    return audit.coverage(claims, reports(spark, sf), ["l_partkey", "l_suppkey"], "l_returnflag")


@query("audit_required_edge", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def required_edge(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return audit.lacking_edge(o, "l_orderkey", reports(spark, sf).filter("l_returnflag = 'R'"), "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")


@query("audit_cardinality", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 7")
def cardinality(spark, sf):
    return audit.cardinality(reports(spark, sf), "l_orderkey", 7)


@query("audit_domain_range", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def domain_range(spark, sf):
    return audit.outside(t(spark, sf, "customer"), "c_custkey", t(spark, sf, "supplier"), "s_suppkey").select("c_custkey")


@query("classify_levels", """
SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'clean' WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' ELSE 'not_provided' END AS level, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def levels(spark, sf):
    d = labelled(spark, sf)
    rules = [((F.col("quality") == 1) & (F.col("toxic") == 0), "clean"), (F.col("toxic") == 1, "toxic"), (F.col("quality") == 0, "poor")]
    return d.groupBy(classify.level(rules, "not_provided").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("classify_scalars", r"""
SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, regexp_replace(p_brand, '^[^#]*#', '') AS brand FROM part""")
def scalars(spark, sf):
    return t(spark, sf, "part").select("p_partkey", classify.slug(F.col("p_type")).alias("slug"), F.regexp_replace("p_brand", "^[^#]*#", "").alias("brand"))
