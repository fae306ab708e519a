"""Rules of the sources over columns of the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, classify, reconcile, rules
from .model import reports, t
from .registry import query

DESIGN = """CASE o_orderpriority WHEN '1-URGENT' THEN 'randomized controlled trial' WHEN '2-HIGH' THEN 'cross-sectional observational, not case-control,case-control'
WHEN '3-MEDIUM' THEN 'laboratory experiment' WHEN '5-LOW' THEN 'prospective cohort,meta-analysis' END"""
ASSAY = "CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN '16S' WHEN 1 THEN 'WMS' WHEN 2 THEN 'PCR' ELSE '' END"
HOST = "CASE o_orderstatus WHEN 'O' THEN 'Homo sapiens' WHEN 'P' THEN 'Mus musculus' ELSE '' END"


@query("rule_evidence_level", f"""
WITH s AS (SELECT o_orderkey, {DESIGN} AS d, {ASSAY} AS a, {HOST} AS h FROM orders)
SELECT o_orderkey, CASE WHEN d LIKE 'laboratory%' THEN CASE WHEN h = 'Mus musculus' THEN 'in-vivo-model' ELSE 'in-vitro' END WHEN d IS NOT NULL AND h = 'Mus musculus' THEN 'in-vivo-model'
WHEN d LIKE 'randomized%' THEN 'interventional-rct' WHEN d LIKE '%meta-analysis' THEN 'meta-analysis' WHEN d IS NULL THEN 'unknown'
WHEN a = '16S' THEN 'observational-16S' WHEN a = 'WMS' THEN 'observational-shotgun' WHEN a = 'PCR' THEN 'observational-targeted' ELSE 'observational-unspecified' END AS level,
CASE WHEN d LIKE 'cross%' THEN 2 WHEN d LIKE '%,meta-analysis' THEN 2 WHEN d IS NULL THEN 0 ELSE 1 END AS n_designs FROM s""")
def evidence_level(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.expr(DESIGN).alias("d"), F.expr(ASSAY).alias("a"), F.expr(HOST).alias("h"))
    return o.select("o_orderkey", rules.evidence_level(F.col("d"), F.col("a"), F.col("h")).alias("level"), F.size(rules.study_designs(F.col("d"))).alias("n_designs"))


@query("rule_workbook_level", """
WITH s AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'mouse' ELSE 'human' END AS book, CASE o_orderpriority WHEN '1-URGENT' THEN 'Gut microbiota for adjuvant therapy' ELSE 'other' END AS kind,
CAST(o_orderkey % 4 AS INT) AS a FROM orders)
SELECT o_orderkey, CASE a WHEN 0 THEN '16S' WHEN 1 THEN 'WMS' WHEN 2 THEN 'PCR' ELSE '' END AS assay, CASE WHEN book = 'mouse' THEN 'in-vivo-model' WHEN kind <> 'other' THEN 'interventional-rct'
WHEN a = 0 THEN 'observational-16S' WHEN a = 1 THEN 'observational-shotgun' WHEN a = 2 THEN 'observational-targeted' ELSE 'observational-unspecified' END AS level FROM s""")
def workbook_level(spark, sf):
    tech = F.element_at(F.array(*[F.lit(x) for x in ("16S rRNA sequences,qPCR", "Shotgun and 16S", "Denaturing gradient gel electrophoresis", "culture")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    book = F.when(F.col("o_orderstatus") == "P", "mouse").otherwise("human")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Gut microbiota for adjuvant therapy").otherwise("other")
    return t(spark, sf, "orders").select("o_orderkey", rules.assay_of(tech).alias("assay"), rules.workbook_level(book, kind, tech).alias("level"))


@query("rule_growth_screen", """
SELECT CASE WHEN l_discount < 0.01 THEN 'INHIBITS_GROWTH_OF' ELSE 'DOES_NOT_INHIBIT_GROWTH_OF' END AS relation, CASE WHEN l_discount < 0.01 THEN 'inhibited' ELSE 'no-effect' END AS effect,
count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1, 2""")
def growth_screen(spark, sf):
    p = F.when(F.col("l_linenumber") != 7, F.col("l_discount"))  # the seventh line was not measured
    e = reports(spark, sf).withColumn("relation", rules.screen_relation(p.isNotNull(), classify.hit(p, 0.01), "INHIBITS_GROWTH_OF", "DOES_NOT_INHIBIT_GROWTH_OF")).filter("relation is not null")
    return e.groupBy("relation", rules.effect(F.col("relation")).alias("effect")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts"))


@query("rule_metabolism_screen", """
SELECT CASE WHEN l_quantity >= 20 + l_linenumber AND l_tax <= 0.05 THEN 'METABOLISES' ELSE 'DOES_NOT_METABOLISE' END AS relation, count(*) AS n FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY 1""")
def metabolism_screen(spark, sf):
    label = F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit("Control pH "), F.col("l_suppkey"))).otherwise(F.concat(F.lit("Strain "), F.col("l_suppkey")))
    e = reports(spark, sf).filter(~rules.is_control(label))
    hit = classify.consumed(F.col("l_quantity"), (F.col("l_linenumber") + 20).cast("double"), F.col("l_tax"))
    return e.groupBy(rules.screen_relation(hit.isNotNull(), hit, "METABOLISES", "DOES_NOT_METABOLISE").alias("relation")).agg(F.count(F.lit(1)).alias("n"))


@query("rule_activities", """
WITH s AS (SELECT event_id, event_type AS k FROM events)
SELECT event_id, CASE k WHEN 'view' THEN 'CONSUMES' WHEN 'purchase' THEN 'PRODUCES' WHEN 'click' THEN r WHEN 'signup' THEN 'DEGRADES' END AS relation, k = 'signup' AS negated
FROM s, (VALUES ('CONSUMES'), ('PRODUCES')) v(r) WHERE k <> 'error' AND (k = 'click' OR r = 'CONSUMES')""")
def activities(spark, sf):
    cell = rules.lookup(F.col("event_type"), {"view": "Consumption (import)", "purchase": "Production (export)", "click": "Consumption (import), Production (export)", "signup": "Macromolecule degradation (-)", "error": "other"})
    return t(spark, sf, "events").select("event_id", F.explode(rules.activities(cell)).alias("a")).select("event_id", "a.relation", "a.negated")


@query("rule_scoped_references", """
SELECT event_id, CASE event_type WHEN 'click' THEN '417(G)' WHEN 'view' THEN '415,418' ELSE '9(G),7(G)' END AS refs, event_type <> 'view' AS genus_only FROM events""")
def scoped(spark, sf):
    cell = rules.lookup(F.col("event_type"), {"click": "import:415, 418;export:417(G)", "view": "import:1; export: 415, 418"}, "9(G), 7(G)")
    got = t(spark, sf, "events").select("event_id", rules.exchange_references(cell, F.lit("PRODUCES")).alias("r"))
    return got.select("event_id", F.array_join("r.refs", ",").alias("refs"), "r.genus_only")


@query("rule_interactions", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'DOES_NOT_METABOLISE_SUBSTANCE' ELSE 'METABOLISES_SUBSTANCE' END AS metabolism,
CASE o_orderstatus WHEN 'O' THEN 'ABUNDANCE_CHANGED_BY_SUBSTANCE' WHEN 'P' THEN 'ABUNDANCE_UNCHANGED_BY_SUBSTANCE' END AS abundance, CASE o_orderstatus WHEN 'O' THEN 'decreased' ELSE '' END AS direction,
CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'in-vivo-model' WHEN 1 THEN 'unknown' WHEN 2 THEN 'in-vitro' ELSE 'unknown' END AS level FROM orders""")
def interactions(spark, sf):
    effect = F.when(F.col("o_orderpriority") == "1-URGENT", "Microbe does not metabolize drug").otherwise("n.a.")
    change = rules.lookup(F.col("o_orderstatus"), {"O": "Decrease", "P": "No significant change"}, "delay microbiota maturation")
    k = (F.col("o_orderkey") % 4).cast("int")
    system, species = rules.lookup(k, {0: "In vivo (Rat); In vitro (Human)", 1: "In vivo", 2: "In vitro", 3: "n.a."}), rules.lookup(k, {0: "Rat; Human", 1: "Human/n.a.", 2: "Human faeces", 3: "n.a."})
    return t(spark, sf, "orders").select("o_orderkey", rules.metabolism_relation(effect).alias("metabolism"), rules.abundance_relation(change).alias("abundance"), rules.change_direction(change).alias("direction"), rules.system_level(system, species).alias("level"))


@query("rule_publications", """
SELECT p_partkey, CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'PMID:' || p_size || '|PMID:7000|doi:10.1/' || p_partkey WHEN 1 THEN 'doi:10.1/x' WHEN 2 THEN 'PMID:' || (p_partkey + 1) ELSE '' END AS curies,
CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN p_size WHEN 2 THEN p_partkey + 1 END::BIGINT AS pmid FROM part""")
def publications(spark, sf):
    k = (F.col("p_partkey") % 4).cast("int")
    several = F.concat(F.lit("; PMID: "), F.col("p_size"), F.lit("; PMID: 7000; PMID: 7000; DOI: 10.1/"), F.col("p_partkey"), F.lit(";"))
    cell = F.when(k == 0, several).when(k == 1, "doi: 10.1/x").when(k == 2, (F.col("p_partkey") + 1).cast("string")).otherwise("12")
    got = t(spark, sf, "part").select("p_partkey", rules.publications(F.when(k == 3, "DOI").otherwise("PMID"), cell).alias("p"))
    return got.select("p_partkey", F.array_join("p.curies", "|").alias("curies"), "p.pmid")


@query("rule_determinants", """
SELECT p_partkey, CASE WHEN p_size > 3 THEN 'in-vitro' ELSE 'computational-predicted' END AS level, CASE WHEN p_size % 5 > 0 THEN 'knowledge_assertion' ELSE 'not_provided' END AS knowledge,
CASE WHEN p_type = 'PROMO' THEN 'CC-BY-4.0' ELSE 'CARD-noncommercial' END AS licence,
CASE WHEN p_size = 9 THEN 'not-an-organism' WHEN p_size % 3 = 0 THEN 'above-species' ELSE 'species-or-below' END AS specificity FROM part""")
def determinants(spark, sf):
    lineage = F.when(F.col("p_size") == 9, F.array(F.lit(1), F.lit(28384))).otherwise(F.array(F.lit(1), F.lit(2))).cast("array<bigint>")
    rank = F.when(F.col("p_size") % 3 == 0, "Genus ").otherwise("species")
    return t(spark, sf, "part").select(
        "p_partkey", rules.determinant_level(F.col("p_size") > 3).alias("level"), rules.determinant_knowledge(F.col("p_size") % 5).alias("knowledge"),
        rules.licence_of(F.col("p_type") == "PROMO").alias("licence"), rules.specificity(rank, lineage).alias("specificity"),
    )


@query("rule_mechanisms", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'interventional-rct' WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'in-vitro' ELSE 'unknown' END AS level,
CASE o_orderstatus WHEN 'O' THEN 4 WHEN 'P' THEN 2 END::INT AS phase, CASE WHEN o_orderpriority = '2-HIGH' THEN 'PMID:' || o_orderkey WHEN o_orderpriority = '3-MEDIUM' THEN 'DOI:10.1/a' END AS publication FROM orders""")
def mechanisms(spark, sf):
    names = {"1-URGENT": ["PubMed", "DailyMed"], "2-HIGH": ["PubMed"], "3-MEDIUM": ["DOI", "PMC"], "4-NOT SPECIFIED": ["PubMed", "Wikipedia"]}
    kinds = F.array().cast("array<string>")
    for k, v in names.items():
        kinds = F.when(F.col("o_orderpriority") == k, F.array(*[F.lit(x) for x in v])).otherwise(kinds)
    phase = rules.lookup(F.col("o_orderstatus"), {"O": "4.0", "P": "2"}, "")
    ref = F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_orderkey").cast("string")).when(F.col("o_orderpriority") == "1-URGENT", "https://example.org/1").otherwise("10.1/a")
    kind = rules.lookup(F.col("o_orderpriority"), {"1-URGENT": "PubMed", "2-HIGH": "PubMed", "3-MEDIUM": "DOI"}, "Wikipedia")
    return t(spark, sf, "orders").select("o_orderkey", rules.mechanism_level(phase, kinds).alias("level"), rules.phase(phase).alias("phase"), rules.publication(kind, ref).alias("publication"))


@query("rule_codes", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'unknown' WHEN 'click' THEN 'computational-predicted' ELSE 'unknown' END AS level,
CASE event_type WHEN 'view' THEN 'knowledge_assertion' WHEN 'click' THEN 'logical_entailment' ELSE 'not_provided' END AS knowledge, CASE event_type WHEN 'view' THEN 'ECO:0000304' WHEN 'click' THEN 'ECO:0000501' ELSE '' END AS eco,
CASE WHEN event_type IN ('signup', 'purchase') THEN 'in-vitro' ELSE 'computational-predicted' END AS status_level FROM events""")
def codes(spark, sf):
    code = rules.lookup(F.col("event_type"), {"view": " tas", "click": "IEA"}, "XXX")
    status = rules.lookup(F.col("event_type"), {"signup": "Detected", "purchase": "quantified "}, "expected")
    return t(spark, sf, "events").select("event_id", rules.code_evidence(code).alias("c"), rules.status_level(status).alias("status_level")).select("event_id", "c.level", "c.knowledge", "c.eco", "status_level")


@query("rule_registry", """
SELECT source, CASE source WHEN 'src0' THEN 'observation' WHEN 'src1' THEN 'prediction' ELSE 'not_provided' END AS knowledge_level,
CASE source WHEN 'src0' THEN 'manual_agent' WHEN 'src1' THEN 'computational_model' ELSE 'not_provided' END AS agent_type, CASE source WHEN 'src0' THEN 'CC0-1.0' WHEN 'src1' THEN 'MIT' END AS licence, count(*) AS n FROM documents GROUP BY ALL""")
def registry(spark, sf):
    known = rules.Registry().add("src0", "observation", "manual_agent", "CC0-1.0").add("src1", "prediction", "computational_model", "MIT")
    got = t(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return got.select("source", *known.columns(F.col("source")), "n")


@query("rule_directions", "SELECT event_id, CASE event_type WHEN 'view' THEN 'increased' WHEN 'click' THEN 'decreased' END AS direction FROM events")
def directions(spark, sf):
    word = rules.lookup(F.col("event_type"), {"view": " Increase", "click": "DECREASED"}, "Present")
    return t(spark, sf, "events").select("event_id", rules.direction(word).alias("direction"))


@query("rule_records_met", """
SELECT p_partkey, concat_ws('|', CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_type = 'PROMO' THEN 'promo' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END) AS rules FROM part
WHERE p_size > 25 OR p_type = 'PROMO' OR p_retailprice > 1500""")
def records_met(spark, sf):
    met = classify.rules_met({"large": F.col("p_size") > 25, "promo": F.col("p_type") == "PROMO", "dear": F.col("p_retailprice") > 1500})
    return t(spark, sf, "part").withColumn("rules", met).filter(F.size("rules") > 0).select("p_partkey", F.array_join("rules", "|").alias("rules"))


@query("rule_reproduced", """
WITH g AS (SELECT l_returnflag AS flag, count(*) FILTER (WHERE l_discount < 0.03) AS got FROM lineitem GROUP BY 1),
w AS (SELECT l_returnflag AS flag, count(*) FILTER (WHERE l_discount < CASE l_returnflag WHEN 'R' THEN 0.04 ELSE 0.03 END) AS told FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1 UNION ALL SELECT 'X', 1)
SELECT flag, got, told FROM g FULL JOIN w USING (flag) WHERE got IS DISTINCT FROM told""")
def reproduced(spark, sf):
    """The rule's own counts against a sheet that tells another number for one key, lacks one and has one too many: all three are named."""
    from ..sources.readers import unreproduced

    e, flag = reports(spark, sf), F.col("l_returnflag").alias("flag")
    got = e.groupBy(flag).agg(F.count(F.when(classify.hit(F.col("l_discount"), 0.03), 1)).alias("n_hit"))
    sheet = e.filter("l_returnflag != 'A'").groupBy(flag).agg(F.count(F.when(F.col("l_discount") < F.when(F.col("l_returnflag") == "R", 0.04).otherwise(0.03), 1)).alias("n_hit"))
    return unreproduced(got, sheet.unionByName(spark.createDataFrame([("X", 1)], "flag string, n_hit long")), "flag", "n_hit")


@query("fn_normalisers", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS brand, CASE WHEN p_size % 3 = 0 THEN p_size END::BIGINT AS digits, '10.1000/abc' || p_partkey AS doi,
CASE WHEN p_size % 2 = 0 THEN p_size END::BIGINT AS whole, '1|2|' || p_partkey AS ids, 'HMDB' || lpad(p_partkey::VARCHAR, 7, '0') AS hmdb, p_partkey AS cid, 'Brand' || p_size AS after FROM part WHERE p_partkey > 2""")
def normalisers(spark, sf):
    p = t(spark, sf, "part").filter("p_partkey > 2")
    size, key = F.col("p_size").cast("double"), F.col("p_partkey").cast("string")
    return p.select(
        "p_partkey",
        classify.null_words(F.when(F.col("p_size") % 4 == 0, " NA ").otherwise(F.col("p_brand")), "NA", "NULL", "n.a.").alias("brand"),
        classify.digits(F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), F.col("p_size"))).otherwise(F.concat(F.lit("-"), F.col("p_size")))).alias("digits"),
        classify.doi(F.concat(F.lit("https://doi.org/10.1000/ABC"), F.col("p_partkey"))).alias("doi"),
        classify.whole_index(F.when(F.col("p_size") % 2 == 0, size + 1e-9).otherwise(size + 0.4)).alias("whole"),
        F.array_join(rules.merged_ids(F.lit("1; 2|"), F.concat(F.lit("2, "), F.col("p_partkey"))), "|").alias("ids"),
        rules.hmdb_accession(F.concat(F.lit("HMDB"), F.lpad(key, F.greatest(F.lit(5), F.least(F.lit(7), F.length(key))), F.lit("0")))).alias("hmdb"),  # old accessions have five digits, padding would cut longer keys
        rules.pubchem_cid(F.concat(F.lit("CID1"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))).alias("cid"),
        classify.after_prefix(F.concat(F.lit("x:Brand"), F.col("p_size"))).alias("after"),
    )


@query("fn_labels", r"""
SELECT p_partkey, lower(regexp_replace(p_name || p_brand, '[^A-Za-z0-9]+', '', 'g')) AS key, 'NT' || p_partkey AS nt, p_partkey AS patric, p_name AS plain, p_type = 'PROMO' AS is_class, 'MASI:' || p_partkey AS masi,
'ss' || lower(p_type) AS folded, least(3, p_size) AS shown, p_size AS n FROM part""")
def labels(spark, sf):
    many = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: i.cast("string"))
    capped = classify.capped(many, 3)
    return t(spark, sf, "part").select(
        "p_partkey", rules.join_key(F.concat("p_name", F.lit(" - "), "p_brand")).alias("key"), rules.nt_code(F.concat("p_name", F.lit(" (NT"), "p_partkey", F.lit(")"))).alias("nt"),
        rules.patric_taxon(F.concat(F.lit("fig|"), "p_partkey", F.lit(".12.peg.149"))).alias("patric"), rules.without_parenthetical(F.concat("p_name", F.lit("(IBS) "))).alias("plain"),
        rules.is_class(F.concat(F.lit("Compound; "), F.when(F.col("p_type") == "PROMO", "Drug Class").otherwise("x"))).alias("is_class"), rules.prefixed("MASI", F.concat(F.col("p_partkey"), F.lit(" "))).alias("masi"),
        reconcile.casefold(F.concat(F.lit("ß"), "p_type")).alias("folded"), F.size(capped["shown"]).alias("shown"), capped["n"].alias("n"),
    )


@query("fn_not_nan", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def not_nan(spark, sf):
    return t(spark, sf, "events").select("event_id", classify.not_nan(F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))).alias("value"))


@query("fn_origins", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Biological|Food' ELSE 'Food' END AS origins, p_size % 2 = 0 AS microbial, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS n_terms,
CASE WHEN p_size % 2 = 0 THEN p_type END AS deepest FROM part""")
def origins(spark, sf):
    path = lambda *x: F.array(*[F.lit(v) if isinstance(v, str) else v for v in x])
    food = [path("Disposition"), path("Disposition", "Source"), path("Disposition", "Source", "Food"), path("Disposition", "Source", "Food")]
    more = [path("Disposition", "Source", "Biological"), path("Disposition", "Source", "Biological", "Microbe"), path("Disposition", "Source", "Biological", "Microbe", "Genus"), path("Disposition", "Source", "Biological", "Microbe", "Genus", F.col("p_type"))]
    p = t(spark, sf, "part").withColumn("paths", F.when(F.col("p_size") % 2 == 0, F.array(*food, *more)).otherwise(F.array(*food)))
    prefix = ["Disposition", "Source", "Biological", "Microbe"]
    terms = rules.terms_below(F.col("paths"), prefix)
    return p.select(
        "p_partkey", F.array_join(rules.origin_names(F.col("paths"), ["Disposition", "Source"]), "|").alias("origins"), rules.has_origin(F.col("paths"), prefix).alias("microbial"),
        F.size(terms).alias("n_terms"), F.element_at(F.try_element_at(terms, F.lit(1)), -1).alias("deepest"),
    )


@query("fn_records", """
SELECT p_partkey, p_brand || '|' || p_type AS drug_classes, CASE WHEN p_size % 2 = 0 THEN p_size ELSE -1 END::BIGINT AS sort_key, 'A' || p_size || '|B' AS accessions, 'http://x/' || p_partkey || '|F9' AS urls FROM part""")
def records(spark, sf):
    entry = lambda k, v: F.struct(F.lit(k).alias("class"), v.alias("name"))
    entries = F.array(entry("Drug Class", F.col("p_brand")), entry("Mechanism", F.col("p_name")), entry("Drug Class", F.col("p_type")))
    part = lambda x: F.struct(x.alias("accession"))
    comps = F.array(part(F.concat(F.lit("A"), F.col("p_size"))), part(F.lit(" B")), part(F.lit("")), part(F.concat(F.lit("A"), F.col("p_size"))))
    ref = lambda k, i, u: F.struct(F.lit(k).alias("ref_type"), i.alias("ref_id"), u.alias("ref_url"))
    refs = F.array(ref("DailyMed", F.lit("x"), F.concat(F.lit("http://x/"), F.col("p_partkey"))), ref("PubMed", F.lit("1"), F.lit("http://y")), ref("FDA", F.lit("F9"), F.lit(" ")))
    return t(spark, sf, "part").select(
        "p_partkey", F.array_join(rules.categories(entries, "Drug Class"), "|").alias("drug_classes"), rules.numeric_key(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("x")).alias("sort_key"),
        F.array_join(rules.accessions(comps), "|").alias("accessions"), F.array_join(rules.regulatory_urls(refs), "|").alias("urls"),
    )


@query("rec_name_variants", """
SELECT p_partkey, r AS route, CASE r WHEN 'exact' THEN 'd-' || lower(p_type) || 'ate' WHEN 'conjugate' THEN 'd-' || lower(p_type) || 'ic acid' WHEN 'stereo' THEN lower(p_type) || 'ate' WHEN 'stereo-conjugate' THEN lower(p_type) || 'ic acid'
ELSE lower(p_brand) END AS spelling, pos::INT AS pos FROM part, (VALUES ('exact', 0), ('conjugate', 1), ('stereo', 2), ('stereo-conjugate', 3), ('synonym', 4)) v(r, pos)""")
def name_variants(spark, sf):
    cell = F.concat(F.lit("D-"), "p_type", F.lit("ate ("), "p_brand", F.lit(", "), F.lower("p_type"), F.lit("ate)"))
    got = t(spark, sf, "part").select("p_partkey", F.explode(rules.compound_variants(cell)).alias("v"))
    return got.select("p_partkey", "v.route", F.col("v.value").alias("spelling"), "v.pos")


@query("rec_drug_routes", """
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'name' WHEN c_custkey % 3 = 1 THEN 'atc' WHEN s_suppkey IS NOT NULL THEN 'salt-name' ELSE 'minted' END AS route,
CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 WHEN c_custkey % 3 = 1 THEN c_custkey % 50 + 50 ELSE s_suppkey END::BIGINT AS drug FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def drug_routes(spark, sf):
    """A catalogue's drugs against an index of names and unique codes: name, then code, then name without the salt."""
    three = F.col("c_custkey") % 3
    name = F.when(three == 0, F.concat(F.lit("Drug "), F.col("c_custkey") % 50)).when(three == 2, F.concat(F.lit("Drug "), F.col("c_custkey"), F.lit(" sodium salt"))).otherwise("no such name")
    code = F.when(three == 1, F.concat(F.lit("QJ01GB90 A10BA"), F.lpad((F.col("c_custkey") % 50 + 50).cast("string"), 2, "0"), F.lit(" L01BB"))).otherwise("-")
    # few splits hold very many customers: the narrow rows are dealt anew before their variants are made
    asked = t(spark, sf, "customer").select("c_custkey").repartition("c_custkey").select(F.col("c_custkey").alias("k"), rules.catalogue_variants(name, code).alias("v"))
    s = t(spark, sf, "supplier")
    code = F.lpad(F.col("s_suppkey").cast("string"), F.greatest(F.lit(2), F.length(F.col("s_suppkey").cast("string"))), F.lit("0"))  # never cut, so that a code is one supplier's
    index = s.select(F.lit("name").alias("kind"), F.lower(F.concat(F.lit("Drug "), F.col("s_suppkey"))).alias("value"), F.col("s_suppkey").alias("target"))
    index = index.unionByName(s.select(F.lit("atc").alias("kind"), F.concat(F.lit("A10BA"), code).alias("value"), F.col("s_suppkey").alias("target")))
    return reconcile.route_join(asked, "k", "v", index).select("k", "route", F.col("target").alias("drug"))


@query("rec_variant_lists", """
SELECT p_partkey, 'molename|parent-name' || CASE WHEN p_size % 2 = 0 THEN '|salt-name' ELSE '' END AS screened, 'substance-name' || CASE WHEN p_size % 2 = 0 THEN '|salt-name' ELSE '' END AS substance FROM part""")
def variant_lists(spark, sf):
    name = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" dihydrochloride"))).otherwise(F.col("p_name"))
    said = lambda v: F.array_join(F.transform(v, lambda x: x["route"]), "|")
    return t(spark, sf, "part").select("p_partkey", said(rules.screened_variants(name, F.col("p_type"))).alias("screened"), said(rules.substance_variants(name)).alias("substance"))


@query("rec_overrides", "SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'THIRD' ELSE n_name END AS name FROM nation")
def overridden(spark, sf):
    return t(spark, sf, "nation").select("n_nationkey", rules.overrides(F.col("n_name"), {"nation_3": "THIRD"}).alias("name"))


@query("rec_placeholders", "SELECT p_partkey, p_size % 4 <> 0 AS placeholder, CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN 'uncultured ' || p_name WHEN 2 THEN p_name || ' sp.' ELSE '[' || p_name || ']' END AS name FROM part")
def placeholders(spark, sf):
    k = F.col("p_size") % 4
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat(F.lit("uncultured "), "p_name")).when(k == 2, F.concat("p_name", F.lit(" sp."))).otherwise(F.concat(F.lit("["), "p_name", F.lit("]")))
    return t(spark, sf, "part").select("p_partkey", reconcile.is_placeholder(name).alias("placeholder"), name.alias("name"))


@query("rec_curie_route", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Disease' WHEN 1 THEN 'Phenotype' WHEN 2 THEN 'Exposure' END AS kind FROM part")
def curie_route(spark, sf):
    curie = F.element_at(F.array(*[F.lit(x) for x in ("MONDO:0005265", "hp_0000001", "chebi:15740", "no curie")]), F.col("p_size") % 4 + 1)
    return t(spark, sf, "part").select("p_partkey", reconcile.curie_route(curie, {"MONDO": "Disease", "EFO": "Disease", "DOID": "Disease", "HP": "Phenotype", "CHEBI": "Exposure"}).alias("kind"))


@query("pair_zip", """
SELECT p_partkey, label, id, CASE p_size % 3 WHEN 0 THEN 'zip' WHEN 1 THEN 'name run' ELSE 'whole cell' END AS method FROM part, LATERAL (SELECT CASE WHEN p_size % 3 = 0 THEN CASE i WHEN 1 THEN p_type ELSE p_brand END
WHEN p_size % 3 = 1 THEN p_type || ', ' || p_brand ELSE p_type || ',' || p_brand END AS label, CASE WHEN p_size % 3 = 0 THEN CASE i WHEN 1 THEN 'T:' || p_type ELSE 'B:' || p_brand END WHEN p_size % 3 = 1 THEN 'TB:' || p_type || p_brand
ELSE 'X:' || p_partkey END AS id FROM (VALUES (1), (2)) v(i) WHERE i = 1 OR p_size % 3 = 0) x""")
def pair_zip(spark, sf):
    k = F.col("p_size") % 3
    ids = F.when(k == 0, F.concat(F.lit("T:"), "p_type", F.lit(",B:"), "p_brand")).when(k == 1, F.concat(F.lit("TB:"), "p_type", "p_brand")).otherwise(F.concat(F.lit("X:"), "p_partkey"))
    p = t(spark, sf, "part")
    names = p.select(F.concat(F.lit("TB:"), "p_type", "p_brand").alias("id"), F.concat("p_type", F.lit(", "), F.upper("p_brand")).alias("name")).distinct()
    return reconcile.pair_conditions(p.select("p_partkey", F.concat("p_type", F.lit(","), "p_brand").alias("labels"), ids.alias("ids")), "p_partkey", "labels", "ids", names)


@query("claims_met", """
SELECT c_custkey AS claim, c_custkey % 25 AS told, CASE WHEN count(o_orderkey) > 0 THEN count(o_orderkey) END AS measured, coalesce(count(o_orderkey) > 0 AND count(o_orderkey) = c_custkey % 25, false) AS holds
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def claims_met(spark, sf):
    """A number told of each customer against its orders (I12): some hold, some do not, and of some nothing can be measured."""
    told = t(spark, sf, "customer").select(F.col("c_custkey").alias("claim"), (F.col("c_custkey") % 25).alias("told"))
    n = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("claim")).agg(F.count(F.lit(1)).alias("n"))
    return audit.claims_held(told, n, "claim", "told", "n")
