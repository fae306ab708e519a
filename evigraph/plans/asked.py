"""The rest of the named analytics and graph forms, and their SQL (Q-D6b, Q-D8, Q-D18, Q-T, Q-G, Q-S; G29, G30, G34, G35; I1, I5, I8, I11)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import audit, procedures, search
from ..operators.graph import Graph, ask, labels_on, shared_folder, shortest_path
from .model import graph, reports, t
from .registry import query


@query("d6_degraders", "SELECT p_name AS macromolecule, count(DISTINCT l_suppkey) AS degraders FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N' GROUP BY 1")
def degraders(spark, sf):
    pairs = reports(spark, sf).filter("l_returnflag = 'N'").select("l_partkey", "l_suppkey").distinct()
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("macromolecule"))
    return pairs.join(p, "l_partkey").groupBy("macromolecule").agg(F.count_distinct("l_suppkey").alias("degraders"))


@query("d8_three_outcomes", """
SELECT p_partkey AS part_id, count(DISTINCT CASE WHEN l_discount < 0.03 THEN l_suppkey END) AS inhibited, count(DISTINCT CASE WHEN l_discount >= 0.03 THEN l_suppkey END) AS tested_no_effect,
'anything else was never tested' AS caveat FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1""")
def three_outcomes(spark, sf):
    """Measured negatives are counted beside hits; a part nobody tested has zeros."""
    e = reports(spark, sf).groupBy(F.col("l_partkey").alias("part_id"), "l_suppkey").agg(F.bool_or(F.col("l_discount") < 0.03).alias("hit"), F.bool_or(F.col("l_discount") >= 0.03).alias("miss"))
    n = e.groupBy("part_id").agg(F.count(F.when(F.col("hit"), 1)).alias("inhibited"), F.count(F.when(F.col("miss"), 1)).alias("tested_no_effect"))
    rows = t(spark, sf, "part").select(F.col("p_partkey").alias("part_id")).join(n, "part_id", "left").fillna(0)
    return rows.withColumn("caveat", F.lit("anything else was never tested"))


@query("d8_intervention_drug", """
SELECT c_custkey AS taxon, o_orderkey AS intervention, l_partkey AS drug, o_orderstatus AS direction FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' AND l_linenumber = 1""")
def intervention_drug(spark, sf):
    g = graph(spark, sf)
    rows = g.hop(g.nodes["Customer"].filter("c_mktsegment = 'BUILDING'").select(F.col("id").alias("taxon")), "PLACED_BY", "taxon", "intervention", back=True)
    rows = g.hop(rows, "CONTAINS", "intervention", "drug", F.col("l_linenumber") == 1)
    return rows.select("taxon", "intervention", "drug", F.col("PLACED_BY_o_orderstatus").alias("direction"))


@query("d8_metabolism_hits", "SELECT l_suppkey AS taxon, l_partkey AS drug, l_quantity AS consumed, 20 + l_linenumber AS threshold FROM lineitem WHERE l_quantity >= 20 + l_linenumber AND l_tax <= 0.01")
def metabolism_hits(spark, sf):
    e = reports(spark, sf).filter((F.col("l_quantity") >= F.col("l_linenumber") + 20) & (F.col("l_tax") <= 0.01))
    return e.select(F.col("l_suppkey").alias("taxon"), F.col("l_partkey").alias("drug"), F.col("l_quantity").alias("consumed"), (F.col("l_linenumber") + 20).alias("threshold"))


@query("d8_gene_layer", "SELECT l_suppkey AS taxon, l_partkey AS drug, 'G' || (l_orderkey % 1000) || '|G' || l_linenumber AS genes FROM lineitem WHERE l_orderkey % 10 < 3 AND l_returnflag = 'R'")
def gene_layer(spark, sf):
    """Edges with genes; an empty and an absent list are none."""
    genes = F.when(F.col("l_orderkey") % 10 < 3, F.array(F.concat(F.lit("G"), F.col("l_orderkey") % 1000), F.concat(F.lit("G"), "l_linenumber"))).when(F.col("l_orderkey") % 10 < 6, F.array().cast("array<string>"))
    e = reports(spark, sf).filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("taxon"), F.col("l_partkey").alias("drug"), genes.alias("genes")).filter(F.size("genes") > 0)
    return e.withColumn("genes", F.array_join("genes", "|"))


@query("d1_optional_site", """
SELECT l_orderkey AS order_id, count(DISTINCT l_partkey) AS overlap, min(c_mktsegment) AS site FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey < 5 WHERE l_partkey BETWEEN 1 AND 40 GROUP BY 1 HAVING count(DISTINCT l_partkey) >= 2""")
def optional_site(spark, sf):
    hits = spark.range(1, 41).withColumnRenamed("id", "l_partkey")
    pairs = reports(spark, sf).join(F.broadcast(hits), "l_partkey").select("l_orderkey", "l_partkey").distinct().groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count(F.lit(1)).alias("overlap")).filter("overlap >= 2")
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey")
    site = t(spark, sf, "customer").filter("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("site"))
    return pairs.join(o, "order_id").join(site, "o_custkey", "left").groupBy("order_id", "overlap").agg(F.min("site").alias("site"))


@query("d18_template", """
SELECT l_partkey AS drug, min(p_type) AS class, count(DISTINCT l_suppkey) AS n_taxa FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_discount < 0.03 AND l_suppkey IN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_partkey = 1)
GROUP BY 1 ORDER BY n_taxa DESC, drug LIMIT 25""")
def template(spark, sf):
    e = reports(spark, sf)
    changed = e.filter("l_partkey = 1").select("l_suppkey").distinct()
    pairs = e.filter("l_discount < 0.03").select("l_partkey", "l_suppkey").distinct().join(changed, "l_suppkey", "left_semi")
    top = pairs.groupBy(F.col("l_partkey").alias("drug")).agg(F.count(F.lit(1)).alias("n_taxa")).orderBy(F.desc("n_taxa"), "drug").limit(25)
    return top.join(t(spark, sf, "part").select(F.col("p_partkey").alias("drug"), F.col("p_type").alias("class")), "drug").orderBy(F.desc("n_taxa"), "drug")


@query("d18_third_route", """
SELECT s_suppkey AS taxon, 'SUPPLIES' AS claim, l_partkey AS substance, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey % 50 = 1 GROUP BY ALL
UNION ALL SELECT l_orderkey, 'CONTAINS', l_partkey, count(*) FROM lineitem WHERE l_partkey % 50 = 1 GROUP BY ALL""")
def third_route(spark, sf):
    e = graph(spark, sf).slim_edges(["SUPPLIES", "CONTAINS"]).withColumn("substance", F.col("dst").cast("bigint")).filter("substance % 50 = 1")
    return e.groupBy(F.col("src").cast("bigint").alias("taxon"), F.col("type").alias("claim"), "substance").agg(F.count(F.lit(1)).alias("n"))


@query("t_term_counts", """
SELECT 'Part' AS type, count(*) AS n FROM part WHERE list_contains(string_split(lower(p_name), ' '), 'ring') HAVING count(*) > 0
UNION ALL SELECT 'Document', count(*) FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'ring') HAVING count(*) > 0 UNION ALL SELECT 'Nation', count(*) FROM nation WHERE lower(n_name) = 'ring' HAVING count(*) > 0""")
def term_counts(spark, sf):
    """A type without a hit gives no row."""
    parts = [search.bm25(t(spark, sf, name), key, text, "ring").groupBy(F.lit(kind).alias("type")).agg(F.count(F.lit(1)).alias("n")) for kind, name, key, text in (("Part", "part", "p_partkey", "p_name"), ("Document", "documents", "doc_id", "text"), ("Nation", "nation", "n_nationkey", "n_name"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("t_text_to_id", """
WITH d AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS w FROM part), s AS (SELECT count(*) AS n, avg(len(w)) AS avgdl, count(*) FILTER (WHERE list_contains(w, 'bolt')) AS df FROM d)
SELECT p_partkey AS id, p_name AS label, round(ln(1 + (n - df + 0.5) / (df + 0.5)) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * len(w) / avgdl)), 6)::DOUBLE AS score FROM d JOIN part USING (p_partkey), s WHERE list_contains(w, 'bolt') ORDER BY 3 DESC, 1 LIMIT 5""")
def text_to_id(spark, sf):
    p = t(spark, sf, "part")
    top = search.bm25(p, "p_partkey", "p_name", "bolt").orderBy(F.desc("score"), "doc").limit(5)
    return top.join(p.select(F.col("p_partkey").alias("doc"), "p_name"), "doc").select(F.col("doc").alias("id"), F.col("p_name").alias("label"), F.round("score", 6).alias("score"))


@query("t_compare_diseases", "SELECT count(*) AS shared FROM (SELECT l_suppkey FROM lineitem WHERE l_partkey = 1 INTERSECT SELECT l_suppkey FROM lineitem WHERE l_partkey = 2)")
def compare_diseases(spark, sf):
    e = reports(spark, sf)
    a = e.filter("l_partkey = 1").select("l_suppkey").distinct()
    return a.join(e.filter("l_partkey = 2"), "l_suppkey", "left_semi").agg(F.count(F.lit(1)).alias("shared"))


@query("t_path_types", "SELECT 3 AS hops, 'Customer>Nation>Region>Nation' AS types UNION ALL SELECT 1, 'Customer>Nation' WHERE false")
def path_types(spark, sf):
    """A path with the label of each node on it: from a customer to another nation of the customer's region."""
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    e = c.select(F.concat(F.lit("c"), "c_custkey").alias("src"), F.concat(F.lit("n"), "c_nationkey").alias("dst")).unionByName(n.select(F.concat(F.lit("n"), "n_nationkey").alias("src"), F.concat(F.lit("r"), "n_regionkey").alias("dst")))
    home = c.filter("c_custkey = 1").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_regionkey").first()
    other = n.filter((F.col("n_regionkey") == home[1]) & (F.col("n_nationkey") != home[0])).agg(F.min("n_nationkey")).first()[0]
    nodes = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    kinds = F.create_map(F.lit("c"), F.lit("Customer"), F.lit("n"), F.lit("Nation"), F.lit("r"), F.lit("Region"))
    got = labels_on(shortest_path(e, "c1", f"n{other}", 4), "path", nodes.withColumn("label", kinds[F.substring("node", 1, 1)]))
    return got.select("hops", F.array_join("labels", ">").alias("types"))


@query("t_class_producers", "SELECT p_type AS class, count(DISTINCT l_suppkey) AS producers FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('PROMO', 'ECONOMY') AND l_suppkey % 5 <> 0 GROUP BY 1")
def class_producers(spark, sf):
    p = t(spark, sf, "part").filter(F.col("p_type").isin("PROMO", "ECONOMY")).select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("class"))
    pairs = reports(spark, sf).filter("l_suppkey % 5 != 0").join(p, "l_partkey").select("class", "l_suppkey").distinct()
    return pairs.groupBy("class").agg(F.count(F.lit(1)).alias("producers"))


@query("g1_layer_shape", "WITH p AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT count(*) AS pairs, sum(n)::BIGINT AS edges, count(DISTINCT l_suppkey) AS taxa, count(DISTINCT l_partkey) AS diseases FROM p")
def layer_shape(spark, sf):
    p = reports(spark, sf).groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return p.agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("edges"), F.count_distinct("l_suppkey").alias("taxa"), F.count_distinct("l_partkey").alias("diseases"))


@query("g3_screen_headline", "SELECT (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_discount < 0.01) AS hit, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS screened")
def screen_headline(spark, sf):
    hit = reports(spark, sf).groupBy("l_partkey").agg(F.bool_or(F.col("l_discount") < 0.01).alias("hit"))
    return hit.agg(F.count(F.when(F.col("hit"), 1)).alias("hit"), F.count(F.lit(1)).alias("screened"))


@query("g4_loader_fidelity", "SELECT (SELECT count(*) FROM orders) AS rows_in, (SELECT count(DISTINCT o_orderkey) FROM orders) AS signatures, (SELECT count(DISTINCT o_custkey) FROM orders) AS studies")
def loader_fidelity(spark, sf):
    g = graph(spark, sf)
    n = t(spark, sf, "orders").agg(F.count(F.lit(1)).alias("rows_in"))
    e = g.edges["PLACED_BY"].agg(F.count_distinct("src").alias("signatures"), F.count_distinct("dst").alias("studies"))
    return n.crossJoin(e)  # one row each


@query("g5_source_agreement", """
WITH d AS (SELECT l_partkey AS p, l_suppkey AS s, l_linestatus AS src, count(DISTINCT l_returnflag) AS n, min(l_returnflag) AS first FROM lineitem GROUP BY 1, 2, 3),
x AS (SELECT p, s, count(*) AS n_src, count(*) FILTER (WHERE n = 1) AS unanimous, count(DISTINCT first) AS firsts FROM d GROUP BY 1, 2 HAVING count(*) > 1)
SELECT count(*) AS multi, count(*) FILTER (WHERE unanimous = n_src AND firsts = 1) AS agree, count(*) FILTER (WHERE unanimous = n_src AND firsts > 1) AS disagree, count(*) FILTER (WHERE unanimous < n_src) AS within FROM x""")
def source_agreement(spark, sf):
    code = F.xxhash64("l_returnflag")
    d = reports(spark, sf).groupBy("l_partkey", "l_suppkey", "l_linestatus").agg(F.min(code).alias("a"), F.max(code).alias("b"))
    x = d.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("u"), (F.min("a") == F.max("a")).alias("one")).filter("n > 1")
    whole = F.col("u") == F.col("n")
    return x.agg(F.count(F.lit(1)).alias("multi"), F.count(F.when(whole & F.col("one"), 1)).alias("agree"), F.count(F.when(whole & ~F.col("one"), 1)).alias("disagree"), F.count(F.when(~whole, 1)).alias("within"))


@query("g6_coverage", """
WITH c AS (SELECT CASE WHEN p_partkey % 10 <> 0 THEN p_partkey END AS a, p_partkey % 100 AS b, CASE WHEN p_size % 3 > 0 THEN 'R' END AS d FROM part), h AS (SELECT l_partkey AS a, l_suppkey AS b, list(DISTINCT l_returnflag) AS f FROM lineitem GROUP BY 1, 2)
SELECT (SELECT count(*) FROM c) AS n_references, (SELECT count(*) FROM c WHERE a IS NOT NULL) AS n_resolvable, count(*) AS n_covered, count(*) FILTER (WHERE d IS NOT NULL AND f = ['R']) AS agree,
count(*) FILTER (WHERE d IS NOT NULL AND len(f) > 1 AND list_contains(f, 'R')) AS split, count(*) FILTER (WHERE d IS NOT NULL AND NOT list_contains(f, 'R')) AS contradict FROM c JOIN h USING (a, b)""")
def coverage(spark, sf):
    c = t(spark, sf, "part").select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("a"), (F.col("p_partkey") % 100).alias("b"), F.when(F.col("p_size") % 3 > 0, "R").alias("d"))
    layer = reports(spark, sf).select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("d"), F.col("l_linestatus").alias("level"))
    got = audit.score(c, layer, ["a", "b"], "d", "level")
    o = got["outcomes"].agg(*[F.coalesce(F.sum(F.when(F.col("outcome") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("agree", "split", "contradict")])
    return got["counts"].crossJoin(o)  # one row each


@query("g6_coverage_levels", """
SELECT l_linestatus AS level, count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey AND l_suppkey = p_partkey % 100 WHERE p_partkey % 10 <> 0 GROUP BY 1""")
def coverage_levels(spark, sf):
    c = t(spark, sf, "part").select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey")).alias("a"), (F.col("p_partkey") % 100).alias("b"), F.lit("R").alias("d"))
    layer = reports(spark, sf).select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("d"), F.col("l_linestatus").alias("level"))
    return audit.score(c, layer, ["a", "b"], "d", "level")["levels"]


@query("g7_breadth_overlap", "WITH x AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10) SELECT count(*) FILTER (WHERE l_partkey % 2 = 0) AS overlap FROM x")
def breadth_overlap(spark, sf):
    top = reports(spark, sf).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey").limit(10)
    named = t(spark, sf, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("l_partkey"))
    return top.join(named, "l_partkey", "left_semi").agg(F.count(F.lit(1)).alias("overlap"))


@query("s1_class_determinants", """
SELECT l_returnflag AS mechanism, count(DISTINCT l_partkey) AS determinants, count(DISTINCT l_suppkey) AS taxa, array_to_string(list_sort(list(DISTINCT l_suppkey))[1:8], '|') AS examples FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO' GROUP BY 1""")
def class_determinants(spark, sf):
    p = t(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    e = reports(spark, sf).join(p, "l_partkey", "left_semi").select(F.col("l_returnflag").alias("mechanism"), "l_partkey", "l_suppkey")
    a = e.select("mechanism", "l_partkey").distinct().groupBy("mechanism").agg(F.count(F.lit(1)).alias("determinants"))
    b = e.select("mechanism", "l_suppkey").distinct().groupBy("mechanism").agg(F.count(F.lit(1)).alias("taxa"), F.array_join(F.slice(F.array_sort(F.collect_set("l_suppkey")), 1, 8), "|").alias("examples"))
    return a.join(b, "mechanism")


@query("s2_licence_level", "SELECT CASE WHEN p_type = 'PROMO' THEN 'CC-BY-4.0' ELSE 'CARD-noncommercial' END AS licence, l_linestatus AS level, count(*) AS edges FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def licence_level(spark, sf):
    from ..operators.rules import licence_of

    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), licence_of(F.col("p_type") == "PROMO").alias("licence"))
    return reports(spark, sf).join(p, "l_partkey").groupBy("licence", F.col("l_linestatus").alias("level")).agg(F.count(F.lit(1)).alias("edges"))


@query("s3_tiers", "SELECT o_orderpriority AS level, o_orderstatus AS knowledge, count(*) AS edges FROM orders GROUP BY 1, 2")
def tiers(spark, sf):
    return graph(spark, sf).edges["PLACED_BY"].groupBy(F.col("o_orderpriority").alias("level"), F.col("o_orderstatus").alias("knowledge")).agg(F.count(F.lit(1)).alias("edges"))


@query("s4_tombstones", "SELECT CASE WHEN lang IS NULL THEN 'unresolved' ELSE 'deleted' END AS status, source, count(*) AS names FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL GROUP BY 1, 2")
def tombstones(spark, sf):
    lost = t(spark, sf, "documents").select("doc_id", "lang", "source").join(t(spark, sf, "labels").filter("quality is not null"), "doc_id", "left_anti")
    return lost.groupBy(F.when(F.col("lang").isNull(), "unresolved").otherwise("deleted").alias("status"), "source").agg(F.count(F.lit(1)).alias("names"))


@query("s5_evidence_mix", "SELECT l_linestatus AS code, l_returnflag AS knowledge, count(*) AS edges, count(DISTINCT l_partkey) AS pathways FROM lineitem GROUP BY 1, 2")
def evidence_mix(spark, sf):
    e = reports(spark, sf).groupBy(F.col("l_linestatus").alias("code"), F.col("l_returnflag").alias("knowledge"), "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return e.groupBy("code", "knowledge").agg(F.sum("n").alias("edges"), F.count(F.lit(1)).alias("pathways"))


@query("s6_contains", "SELECT p_partkey AS id, p_name AS name, p_size AS status FROM part WHERE contains(lower(p_name), 'ring') ORDER BY name, id LIMIT 10")
def contains(spark, sf):
    """A lookup in an unindexed property, with the name as a parameter."""
    t(spark, sf, "part").createOrReplaceTempView("evigraph_part")
    return ask(spark, "SELECT p_partkey AS id, p_name AS name, p_size AS status FROM evigraph_part WHERE contains(lower(p_name), lower(:name)) ORDER BY name, id LIMIT 10", {"name": "RING"})


#: Customers to a deal of cross_property.
DEALT = 200_000


@query("cross_property", "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE s_acctbal > c_acctbal * 20")
def cross_property(spark, sf):
    """Properties of two nodes of one match are compared after the equi-join (G34). The result grows with the product of both tables, so a nation's customers are dealt over more tasks as they grow, each with all its suppliers;
    a customer that no supplier of its nation exceeds goes first."""
    c, s = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), t(spark, sf, "supplier")
    deals = max(1, math.ceil(c.count() / DEALT))
    most = s.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.max("s_acctbal").alias("most"))
    c = c.join(most, "c_nationkey").filter("most > c_acctbal * 20").withColumn("deal", F.pmod(F.xxhash64("c_custkey"), F.lit(deals)))
    s = s.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    same = (F.col("s_nationkey") == F.col("c_nationkey")) & (s["deal"] == c["deal"])
    return s.hint("merge").join(c, same).filter("s_acctbal > c_acctbal * 20").select("s_suppkey", "c_custkey")


@query("path_labels", "SELECT c_custkey AS customer_id, 'Customer>Nation>Region' AS labels, c_nationkey || '>' || n_regionkey AS ids FROM customer JOIN nation ON c_nationkey = n_nationkey")
def path_labels(spark, sf):
    """A bound path as a value: its nodes with their labels."""
    g = graph(spark, sf)
    rows = g.hop(g.hop(g.nodes["Customer"].select(F.col("id").alias("customer_id")), "CUSTOMER_IN", "customer_id", "nation"), "NATION_IN", "nation", "region")
    node = lambda label, c: F.struct(F.lit(label).alias("label"), F.col(c).cast("string").alias("id"))
    p = rows.withColumn("p", F.array(node("Customer", "customer_id"), node("Nation", "nation"), node("Region", "region")))
    return p.select("customer_id", F.array_join(F.transform("p", lambda x: x["label"]), ">").alias("labels"), F.array_join(F.transform(F.slice("p", 2, 2), lambda x: x["id"]), ">").alias("ids"))


@query("edge_identity", "SELECT 'SUPPLIES' AS type, count(*) AS n_edges, count(*) AS n_ids, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS n_distinct FROM lineitem")
def edge_identity(spark, sf):
    """Ids come from the rows: as many as there are edges, equal rows included."""
    g = graph(spark, sf)
    cells = [c for c in g.edges["SUPPLIES"].columns]
    n = g.identified("SUPPLIES").agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct("edge_id").alias("n_ids"))
    d = g.edges["SUPPLIES"].select(*cells).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
    return n.crossJoin(d).select(F.lit("SUPPLIES").alias("type"), "*")  # one row each


@query("audit_exempt", """
SELECT 'LABELLED.required_properties' AS rule, 'error' AS severity, count(*) FILTER (WHERE (quality IS NULL OR lang IS NULL) AND source <> 'src0') AS violations, count(*) FILTER (WHERE (quality IS NULL OR lang IS NULL) AND source = 'src0') AS exempted,
count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (WHERE (quality IS NULL OR lang IS NULL) AND source <> 'src0') / count(*), 6) AS pct FROM documents LEFT JOIN labels USING (doc_id)""")
def exempt(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "source").join(t(spark, sf, "labels"), "doc_id", "left")
    return audit.audit(d, audit.Rule("LABELLED", ("quality", "lang"), "error"), exempt=F.col("source") == "src0")


@query("audit_too_few", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1 HAVING count(o_orderkey) < 5")
def too_few(spark, sf):
    return audit.too_few(t(spark, sf, "customer"), "c_custkey", t(spark, sf, "orders"), "o_custkey", 5)


@query("audit_forest", """
SELECT DISTINCT 'p' || l_partkey AS node, 'several parents' AS problem FROM lineitem WHERE l_partkey <= 50 GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1 UNION ALL SELECT 'x', 'cycle' UNION ALL SELECT 'y', 'cycle'""")
def forest(spark, sf):
    e = reports(spark, sf).filter("l_partkey <= 50").select(F.concat(F.lit("p"), "l_partkey").alias("c"), F.concat(F.lit("s"), "l_suppkey").alias("p"))
    return audit.forest(e.unionByName(spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "z")], "c string, p string")), "c", "p")


@query("audit_expansions", """
SELECT 'SUPPLIES' AS relation, l_returnflag AS source, count(*) AS n_edges, count(DISTINCT l_orderkey) AS n_records, 'records' AS unit, round(count(*)::DOUBLE / count(DISTINCT l_orderkey), 6) AS factor FROM lineitem GROUP BY 2
UNION ALL SELECT 'ZERO', NULL, 0, NULL, NULL, NULL UNION ALL SELECT 'NO_TABLE', NULL, NULL, NULL, 'no input', NULL
UNION ALL SELECT 'PLACED_BY', o_orderstatus, count(*), (SELECT count(*) FROM orders), 'rows', round(count(*)::DOUBLE / (SELECT count(*) FROM orders), 6) FROM orders GROUP BY 2""")
def expansions(spark, sf):
    """A declared relation without edges is a row of zero edges; one without a table says so; one without record ids is held against its rows."""
    e = reports(spark, sf).select(F.col("l_returnflag").alias("source"), F.col("l_orderkey").alias("record"))
    o = t(spark, sf, "orders").select(F.col("o_orderstatus").alias("source"), F.lit(None).cast("bigint").alias("record"))
    return audit.expansions({"SUPPLIES": e, "ZERO": e.filter("source = 'none'"), "NO_TABLE": None, "PLACED_BY": o}, "source", "record", {"PLACED_BY": o.count()})


@query("audit_violation_unwind", "SELECT x AS property, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END], lambda y: y IS NOT NULL)) AS x FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1")
def violation_unwind(spark, sf):
    d = t(spark, sf, "documents").select("doc_id").join(t(spark, sf, "labels"), "doc_id", "left")
    return audit.violations(d, ["doc_id"], ["quality", "toxic"]).select(F.explode("properties").alias("property")).groupBy("property").agg(F.count(F.lit(1)).alias("n"))


def _registry(spark, sf) -> search.Indexes:
    """The registry of this session's indexes over a data directory, in the shared folder."""
    held = spark.sparkContext.__dict__.setdefault("_evigraph_indexes", {})
    if sf not in held:
        held[sf] = search.Indexes(spark, shared_folder(spark, "indexes"))
    return held[sf]


def _documents(spark, sf) -> search.Indexes:
    """The registry with the postings of the documents, built when first asked for."""
    held = _registry(spark, sf)
    if ("Document", "text") not in held.texts:
        held.build_text("Document", "text", t(spark, sf, "documents"), "doc_id")
    return held


@query("text_index_lookup", """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     c AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'work')) AS b FROM d),
     s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
SELECT doc_id AS doc, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6)::DOUBLE AS score
FROM c, s WHERE a > 0 OR b > 0""")
def index_lookup(spark, sf):
    """The same lookup from postings that were written once: only the files of the query's terms are read."""
    return _documents(spark, sf).search_text("Document", "text", "work license").select("doc", F.round("score", 6).alias("score"))


@query("text_topk_blocks", """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     c AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'license')) AS b FROM d),
     s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
SELECT doc_id AS doc, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)), 6)::DOUBLE AS score
FROM c, s WHERE a > 0 OR b > 0 ORDER BY ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)) DESC, doc LIMIT 20""")
def topk_blocks(spark, sf):
    """The first 20 of a rare and a very common word, as the full ranking has them: blocks whose bound lies under the twentieth score are not scored."""
    return _documents(spark, sf).search_text("Document", "text", "the license", 20).select("doc", F.round("score", 6).alias("score"))


@query("index_registry", "SELECT 'text' AS kind, 'Document' AS label, 'text' AS property, count(text) AS indexed FROM documents UNION ALL SELECT 'text', 'Part', 'p_name', count(p_name) FROM part UNION ALL SELECT 'vector', 'Part', 'p_name', count(p_name) FROM part")
def index_registry(spark, sf):
    held = _documents(spark, sf)
    if ("Part", "p_name") not in held.vectors:
        held.build_text("Part", "p_name", t(spark, sf, "part"), "p_partkey")
        held.build_vectors("Part", "p_name", t(spark, sf, "part"), "p_partkey")
    return held.listed().filter("label != 'Embedding'")


@query("vec_approx_topk")
def approx(spark, sf):
    """Approximate neighbours of one embedding by the inverted file; a test holds their recall against the exact scan."""
    index, q = _vectors(spark, sf)
    return index.search(q, 10).withColumn("score", F.round("score", 6))


def _vectors(spark, sf):
    """The inverted file of the embeddings, built when first asked for, and the first embedding."""
    held, e = _registry(spark, sf), t(spark, sf, "embeddings")
    if ("Embedding", "embedding") not in held.vectors:
        held.add_vectors("Embedding", "embedding", e, "vec_id", "embedding")
    return held.vectors["Embedding", "embedding"], [float(x) for x in e.filter("vec_id = 0").select("embedding").first()[0]]


@query("vec_cells_topk", """
WITH q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id AS doc,
list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i]::DOUBLE * embedding[i]::DOUBLE)) / sqrt(list_sum(list_transform(q, lambda x: x::DOUBLE * x::DOUBLE)) * list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS score FROM embeddings, q)
SELECT doc, round(score, 6) AS score FROM s ORDER BY s.score DESC, doc LIMIT 25""")
def cells(spark, sf):
    """Exact neighbours by the inverted file: cells that cannot hold a nearer row are not read."""
    index, q = _vectors(spark, sf)
    return index.search(q, 25, exact=True).withColumn("score", F.round("score", 6))


def _procedures(spark, sf) -> None:
    """The session's procedures over documents as edges from source to language, and over the documents' postings."""
    held = _documents(spark, sf)
    e = t(spark, sf, "documents").select("doc_id", "source", "lang").join(t(spark, sf, "labels"), "doc_id", "left")
    g = Graph().add_edges("LABELLED", e.select("doc_id", F.coalesce("source", F.lit("")).alias("s"), F.coalesce("lang", F.lit("")).alias("l"), "quality", "toxic"), "s", "l", "Source", "Language")
    procedures.register(spark, g, [audit.Rule("LABELLED", ("quality", "toxic"))], held)


@query("proc_audit", """
SELECT 'LABELLED.required_properties' AS rule, count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) AS violations, count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) / count(*), 6) AS pct
FROM documents LEFT JOIN labels USING (doc_id)""")
def proc_audit(spark, sf):
    """The audit as a relation of a statement, by severity."""
    _procedures(spark, sf)
    return ask(spark, "SELECT rule, violations, total, pct FROM ontology_audit(level => :level)", {"level": "warn"})


@query("proc_violations", """
SELECT coalesce(source, '') AS source, count(*) AS n, max(coalesce(lang, '')) AS last FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL GROUP BY 1""")
def proc_violations(spark, sf):
    """Edges that lack a property, grouped in the same statement."""
    _procedures(spark, sf)
    return ask(spark, "SELECT source, count(*) AS n, max(target) AS last FROM edge_property_violation(kind => 'LABELLED', missing => 'toxic') GROUP BY source")


@query("proc_text_search", """
WITH d AS (SELECT doc_id, source, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     c AS (SELECT doc_id, source, len(w) AS dl, len(list_filter(w, lambda x: x = 'license')) AS a, len(list_filter(w, lambda x: x = 'of')) AS b FROM d),
     s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c),
     r AS (SELECT doc_id, source, ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / avgdl)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS score FROM c, s WHERE a > 0 OR b > 0)
SELECT doc_id, source, round(score, 6) AS score FROM r ORDER BY r.score DESC, doc_id::VARCHAR LIMIT 15""")
def proc_text_search(spark, sf):
    """A ranked lookup joined with the documents it finds."""
    _procedures(spark, sf)
    t(spark, sf, "documents").createOrReplaceTempView("evigraph_documents")
    return ask(spark, "SELECT d.doc_id, d.source, round(f.score, 6) AS score FROM text_search(kind => 'Document', prop => 'text', q => :q, k => 15) f JOIN evigraph_documents d ON d.doc_id = CAST(f.doc AS BIGINT)", {"q": "Of, license!"})
