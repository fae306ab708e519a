"""The thirteen sources as connectors: raw files to shared tables, every mention reconciled, refusals in ledgers. Each reads what its raw layout holds and writes string cells, typed at load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, policies, reconcile, rules, trees
from ..operators.build import Frames, Source
from ..operators.graph import cut
from . import readers

#: Node type by vocabulary of a condition's id (fixed values).
CONDITIONS = {"MONDO": "Disease", "EFO": "Disease", "DOID": "Disease", "ORPHANET": "Disease", "HP": "Phenotype", "CHEBI": "Exposure", "ENVO": "Exposure", "EXO": "Exposure", "GSSO": "Exposure"}
#: Where a metabolite's origin is filed (fixed values).
MICROBE, SOURCE = ["Disposition", "Source", "Biological", "Microbe"], ["Disposition", "Source"]
#: Roots of microbial taxa: Bacteria, Archaea, Fungi, Viruses (fixed values).
ROOTS = [2, 2157, 4751, 10239]

REGISTRY = (
    rules.Registry().add("bugsigdb", "statistical_association", "manual_agent", "CC-BY-4.0").add("card", "knowledge_assertion", "manual_agent", rules.DATA_LICENCE)
    .add("gutmdisorder", "statistical_association", "manual_agent", "unstated").add("hmdb", "knowledge_assertion", "manual_agent", "CC-BY-NC-4.0").add("chembl", "knowledge_assertion", "manual_agent", "CC-BY-SA-3.0")
    .add("maier2018", "observation", "data_analysis_pipeline", "publisher").add("zimmermann2019", "observation", "data_analysis_pipeline", "publisher").add("masi", "knowledge_assertion", "manual_agent", "unstated")
    .add("mimedb", "knowledge_assertion", "manual_agent", "CC-BY-NC-4.0").add("njc19", "knowledge_assertion", "manual_agent", "CC-BY-4.0").add("reactome", "knowledge_assertion", "manual_agent", "CC0-1.0")
    .add("kegg", "knowledge_assertion", "manual_agent", "KEGG-academic").add("taxonomy", "knowledge_assertion", "manual_agent", "public-domain")
)


def marked(df: DataFrame, source: str, record: Column) -> DataFrame:
    """The evidence columns every edge carries."""
    return df.withColumn("primary_source", F.lit(source)).withColumn("source_record_id", record.cast("string")).select("*", *REGISTRY.columns(F.lit(source)))


def present(spark: SparkSession, raw: str, *files: str) -> list[str]:
    """The paths, if Spark can see all of them; else the source is skipped."""
    jvm, conf, paths = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f"{raw}/{f}")
        if not path.getFileSystem(conf).exists(path):
            raise readers.MissingInput(f"no {f}")
        paths.append(f"{raw}/{f}")
    return paths


def taxa(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """The taxdump of a raw folder, written once a session."""
    held = spark.sparkContext.__dict__.setdefault("_evigraph_taxa", {})
    if raw not in held:
        present(spark, raw, "ncbi_taxonomy/nodes.dmp", "ncbi_taxonomy/names.dmp")
        held[raw] = {k: cut(v) for k, v in readers.taxdump(spark, f"{raw}/ncbi_taxonomy").items()}
    return held[raw]


def resolved(spark: SparkSession, raw: str, mentions: DataFrame, ceiling: str | None = "species") -> DataFrame:
    """mentions (name, given_id) with what the taxdump makes of them, written; its indexes are prepared once a session and ceiling."""
    held, dump = spark.sparkContext.__dict__.setdefault("_evigraph_prepared", {}), taxa(spark, raw)
    if (raw, ceiling) not in held:
        held[raw, ceiling] = reconcile.prepare(dump["names"], dump["nodes"], dump["merged"], dump["deleted"], ceiling)
    return cut(reconcile.resolve_with(cut(mentions), held[raw, ceiling]))


def split(got: DataFrame) -> tuple[DataFrame, DataFrame]:
    return got.filter("tax_id is not null"), got.filter("tax_id is null")


def ledger(frames: Frames, df: DataFrame, source: str, subject: Column, reason: Column) -> None:
    """Refused rows with their reason, in one table of all sources."""
    frames.put("ledger", df.select(F.lit(source).alias("source"), subject.cast("string").alias("subject"), reason.alias("reason")), owner=("source", source) if frames.rows("ledger") is None else None)


def cite(frames: Frames, df: DataFrame, source: str) -> None:
    frames.put("cited_taxa", df.groupBy(F.col("tax_id").cast("string").alias("tax_id")).agg(F.count(F.lit(1)).cast("string").alias("n_cited")).withColumn("source", F.lit(source)), owner=("source", source))


def bugsigdb(spark: SparkSession, raw: str, frames: Frames) -> None:
    dump, mondo = present(spark, raw, "bugsigdb/full_dump_main.csv", "mondo/mondo.obo")
    rows = readers.banner_csv(spark, dump)
    cell = lambda c: classify.null_words(F.col(f"`{c}`"), "NA", "N/A", "nan", "None")
    rows = rows.select(
        cell("BSDB ID").alias("signature_id"), cell("Study").alias("study"), classify.digits(cell("PMID")).cast("string").alias("pmid"), classify.doi(cell("DOI")).alias("doi"), cell("Title").alias("title"), cell("Condition").alias("condition"), cell("EFO ID").alias("efo"),
        cell("Body site").alias("site"), cell("UBERON ID").alias("uberon"), cell("Host species").alias("host"), cell("Study design").alias("study_design"), cell("Sequencing type").alias("sequencing_type"),
        cell("Statistical test").alias("statistical_test"), cell("Group 0 sample size").alias("group_0_size"), cell("Group 1 sample size").alias("group_1_size"), cell("Abundance in Group 1").alias("direction"),
        cell("MetaPhlAn taxon names").alias("taxa"), cell("NCBI Taxonomy IDs").alias("tax_ids"),
    ).filter("signature_id is not null")
    terms = readers.disease_terms(readers.obo(spark, mondo))
    rows = cut(rows)
    terms = cut(terms)
    rows = rows.withColumn("evidence_level", rules.evidence_level(F.col("study_design"), F.col("sequencing_type"), F.col("host"))).withColumn("study_id", F.concat(F.lit("bsdb:"), F.regexp_extract("signature_id", r"(\d+)", 1)))
    rows = cut(rows)
    frames.put("study", rows.select("study_id", "pmid", "study_design").distinct(), ["study_id"])
    frames.put("paper", rows.filter("pmid is not null").select("pmid", "title", "doi").distinct(), ["pmid"])
    frames.put("signature", rows.select("signature_id", "study_id", "evidence_level"), ["signature_id"])
    pairs = cut(reconcile.pair_conditions(rows.filter("efo is not null and condition is not null"), "signature_id", "condition", "efo", terms.filter("name is not null").select("id", "name")))
    hubs = policies.hub(pairs.filter("id is not null"), "id", terms)
    kinds = pairs.join(hubs, "id", "left").withColumn("condition_id", F.coalesce("hub_id", F.upper("id"))).withColumn("kind", reconcile.curie_route(F.col("condition_id"), CONDITIONS))
    kinds = cut(kinds)
    ledger(frames, kinds.filter("kind is null"), "bugsigdb", F.coalesce("id", "label"), F.lit("no node type for this condition"))
    for kind in ("Disease", "Phenotype", "Exposure"):
        frames.put(kind.lower(), kinds.filter(F.col("kind") == kind).select("condition_id", F.coalesce("hub_name", "label").alias("label")).distinct(), ["condition_id"])
    site = F.coalesce("uberon", F.concat(F.lit("site:"), classify.slug(F.col("site"))))
    frames.put("bodysite", rows.filter("site is not null").select(site.alias("bodysite_id"), F.col("site").alias("label")).distinct(), ["bodysite_id"])
    frames.put("signature_bodysite", rows.filter("site is not null").select("signature_id", site.alias("bodysite_id")).distinct())
    frames.put("signature_condition", kinds.filter("kind is not null").select("signature_id", "condition_id", F.col("kind").alias("condition_type"), "method").distinct())
    taxa = policies.reported_taxa(rows, "signature_id", "taxa", "tax_ids").withColumnRenamed("tax_id", "given_id")
    good, lost = split(resolved(spark, raw, taxa))
    about = good.join(rows, "signature_id")
    keep = ["signature_id", F.col("tax_id").cast("string").alias("tax_id"), F.col("name").alias("reported_name"), "reported_rank", F.col("status").alias("resolution_status")]
    frames.put("taxon_signature", about.select(*keep, F.lit("bugsigdb").alias("primary_source")), owner=("primary_source", "bugsigdb"))
    gone = lost.select("signature_id", F.concat(F.lit("unresolved:bugsigdb:"), F.coalesce(F.col("given_id").cast("string"), "name")).alias("unresolved_id"), F.coalesce("name", F.col("given_id").cast("string")).alias("label"), "status")
    frames.put("unresolved_taxa", policies.hit_counts(gone.select("unresolved_id", "label", "status").distinct(), "unresolved_id", gone, "unresolved_id", "n_signatures").withColumn("n_signatures", F.col("n_signatures").cast("string")), ["unresolved_id"])
    frames.put("unresolved_taxon_signature", gone.select("unresolved_id", "signature_id").distinct())
    ledger(frames, lost, "bugsigdb", F.coalesce("name", F.col("given_id").cast("string")), F.col("status"))
    seen = about.join(kinds.filter("kind = 'Disease'").select("signature_id", "condition_id"), "signature_id")
    edges = marked(seen, "bugsigdb", F.col("signature_id")).select(
        F.col("tax_id").cast("string").alias("tax_id"), "condition_id", rules.direction(F.col("direction")).alias("direction"), "study_design", "evidence_level", "sequencing_type", "statistical_test", "group_0_size", "group_1_size",
        "pmid", "knowledge_level", "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence"), F.lit("associated with").alias("source_relation"), "study_id",
    )
    frames.put("taxon_condition", edges, owner=("primary_source", "bugsigdb"))
    cite(frames, good, "bugsigdb")


def card(spark: SparkSession, raw: str, frames: Frames) -> None:
    models, index, pmid, obo = present(spark, raw, "card/card-data/card.json", "card/card-data/aro_index.tsv", "card/card-data/PMID.tsv", "card/card-ontology/aro.obo")
    shape = """ARO_accession string, ARO_name string, model_type string, ARO_category map<string, struct<category_aro_accession string, category_aro_name string, category_aro_class_name string>>,
    model_sequences struct<sequence map<string, struct<NCBI_taxonomy struct<NCBI_taxonomy_id string, NCBI_taxonomy_name string>>>>"""
    shape = " ".join(shape.replace("struct<", "struct<").split())
    rows = readers.json_by_id(spark, models, shape).select("id", "value.*")
    aro = lambda c: F.concat(F.lit("ARO:"), F.regexp_replace(c, "^ARO:", ""))
    cites = readers.tsv(spark, pmid).select(aro(F.col("`ARO Accession`")).alias("aro_id"), rules.merged_ids(F.col("PMID")).alias("p")).groupBy("aro_id").agg(F.array_distinct(F.flatten(F.collect_list("p"))).alias("p"))
    terms = readers.obo(spark, obo).select(F.col("id").alias("aro_id"), rules.is_a(F.col("tags")).alias("parents"), rules.definition_pmids(F.col("tags")).alias("def_pmids"), F.transform(F.coalesce(F.try_element_at("tags", F.lit("relationship")), F.array().cast("array<string>")), lambda r: F.regexp_extract(r, r"(ARO:\d+)", 1)).alias("related"))
    known = readers.tsv(spark, index).select(F.trim("`Model ID`").alias("id"), F.lit(True).alias("curated")).distinct()
    genes = rows.withColumn("aro_id", aro(F.col("ARO_accession"))).join(cites, "aro_id", "left").join(terms, "aro_id", "left").join(known, "id", "left")
    genes = genes.withColumn("entries", F.transform(F.map_values("ARO_category"), lambda c: F.struct(c["category_aro_class_name"].alias("class"), c["category_aro_name"].alias("name"), aro(c["category_aro_accession"]).alias("id"))))
    pubs = F.array_distinct(F.concat(F.coalesce("p", F.array().cast("array<string>")), F.coalesce("def_pmids", F.array().cast("array<string>"))))
    genes = genes.withColumn("pubs", pubs).withColumn("sequences", F.map_values(F.col("model_sequences.sequence"))).withColumn("evidence_level", rules.determinant_level(F.coalesce(F.size("sequences"), F.lit(0)) > 0))
    genes = cut(genes.withColumn("knowledge", rules.determinant_knowledge(F.size("pubs"))))
    frames.put("resistance_gene", genes.select("aro_id", F.col("ARO_name").alias("name"), "model_type", F.coalesce("curated", F.lit(False)).cast("string").alias("curated"), F.to_json("pubs").alias("publications"), F.size("pubs").cast("string").alias("n_publications"), F.lit("card").alias("source")), ["aro_id"], ("source", "card"))
    for kind, table, key in (("Drug Class", "drug_class", "drug_class_id"), ("Resistance Mechanism", "resistance_mechanism", "mechanism_id")):
        own = genes.select("aro_id", "evidence_level", "knowledge", F.coalesce("related", F.array().cast("array<string>")).alias("related"), F.explode(F.filter("entries", (lambda k: lambda e: e["class"] == k)(kind))).alias("e"))
        frames.put(table, own.select(F.col("e.id").alias(key), F.col("e.name").alias("label"), F.lit("card").alias("source")).distinct(), [key], ("source", "card"))
        edge = marked(own, "card", F.col("aro_id")).select("aro_id", F.col("e.id").alias(key), "evidence_level", F.col("knowledge").alias("knowledge_level"), "agent_type", "primary_source", "source_record_id", rules.licence_of(F.array_contains("related", F.col("e.id"))).alias("source_licence"))
        frames.put("resistance_gene_drug_class" if kind == "Drug Class" else "resistance_gene_mechanism", edge, owner=("primary_source", "card"))
    taxa = genes.select("aro_id", "evidence_level", "knowledge", F.explode_outer("sequences").alias("s")).filter("s is not null").select("aro_id", "evidence_level", "knowledge", F.col("s.NCBI_taxonomy.NCBI_taxonomy_name").alias("name"), F.col("s.NCBI_taxonomy.NCBI_taxonomy_id").try_cast("bigint").alias("given_id"))
    good, lost = split(resolved(spark, raw, taxa))
    edge = marked(good, "card", F.col("aro_id")).select(F.col("tax_id").cast("string").alias("tax_id"), "aro_id", "evidence_level", F.col("knowledge").alias("knowledge_level"), "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence"), rules.specificity(F.col("original_rank"), F.array().cast("array<bigint>")).alias("taxon_specificity"))
    frames.put("taxon_resistance_gene", edge, owner=("primary_source", "card"))
    ledger(frames, lost, "card", F.coalesce("name", "aro_id"), F.col("status"))
    cite(frames, good, "card")


def gutmdisorder(spark: SparkSession, raw: str, frames: Frames) -> None:
    human, mouse, mondo = present(spark, raw, "gutmdisorder/human.xlsx", "gutmdisorder/mouse.xlsx", "mondo/mondo.obo")
    terms = cut(readers.disease_terms(readers.obo(spark, mondo)))
    parts = []
    for book, path in (("human", human), ("mouse", mouse)):
        lit = readers.workbook(spark, path, "Literature", "Index").select(F.col("Index").alias("lit_index"), F.col("PMID").alias("pmid"), F.col("`Research Type`").alias("research_type"))
        sample = readers.workbook(spark, path, "Sample", "Index").select(F.col("Index").alias("sample_index"), F.col("`Sequencing Technology`").alias("technology"), F.col("`Sample Size`").alias("size"))
        assoc = readers.workbook(spark, path, "Association", "Index").withColumn("book", F.lit(book))
        whole = lambda c: classify.whole_index(F.col(c).try_cast("double"))
        arms = sample.withColumn("at", whole("sample_index")).filter("at is not null").groupBy("at").agg(F.sum(F.col("size").try_cast("bigint")).cast("string").alias("study_sample_size"), F.array_join(F.array_sort(F.collect_set("technology")), ",").alias("technology"))
        bad = assoc.filter(whole("Index").isNull())
        ledger(frames, bad, "gutmdisorder", F.col("Index"), F.lit("an index that is no whole number"))
        rows = assoc.withColumn("at", whole("Index")).filter("at is not null").join(lit.withColumn("at", whole("lit_index")).drop("lit_index"), "at", "left").join(arms, "at", "left")
        parts.append(rows.withColumn("study_id", F.concat(F.lit(f"STUDY:gutmdisorder-{book}-"), "at")))
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True)
    rows = rows.withColumn("name", F.trim("`Gut Microbiota`")).withColumn("given_id", classify.digits(F.col("`Gut Microbiata NCBI ID`").cast("string"))).withColumn("evidence_level", rules.workbook_level(F.col("book"), F.col("research_type"), F.col("technology")))
    good, lost = split(resolved(spark, raw, rows))
    ledger(frames, lost, "gutmdisorder", F.col("name"), F.col("status"))
    good = good.withColumn("direction", rules.direction(F.col("Alteration")))
    frames.put("study", rows.select("study_id", classify.digits(F.col("pmid")).cast("string").alias("pmid"), "study_sample_size").distinct(), ["study_id"])
    found = policies.by_name(good, "Disorder Name", terms, rules.disease_name).select(F.col("Disorder Name").alias("_d"), "hub_id")
    held = good.join(found, F.col("Disorder Name") == F.col("_d"), "left").withColumn("condition_id", F.coalesce("hub_id", F.upper(F.trim("DOID"))))
    disease = held.filter("condition_id is not null")
    frames.put("disease", disease.select("condition_id", F.col("Disorder Name").alias("label")).distinct(), ["condition_id"])
    base = ["tax_id", "condition_id", "direction", "evidence_level", "study_id", "technology", "pmid"]
    once = disease.groupBy(*[F.col(c).cast("string").alias(c) for c in base]).agg(F.count(F.lit(1)).cast("string").alias("duplicate_rows"))
    frames.put("taxon_condition", marked(once, "gutmdisorder", F.col("study_id")).withColumn("sequencing_type", rules.assay_of(F.col("technology"))).withColumnRenamed("licence", "source_licence"), owner=("primary_source", "gutmdisorder"))
    acts = good.filter(F.coalesce(F.trim("Intervention"), F.lit("")) != "").withColumn("intervention_id", F.concat(F.lit("INTERVENTION:"), classify.slug(F.col("Intervention"))))
    frames.put("intervention", acts.select("intervention_id", F.trim("Intervention").alias("label")).distinct(), ["intervention_id"])
    frames.put("taxon_intervention", marked(acts, "gutmdisorder", F.col("study_id")).select(F.col("tax_id").cast("string").alias("tax_id"), "intervention_id", "direction", "evidence_level", "study_id", "primary_source", "source_record_id"), owner=("primary_source", "gutmdisorder"))
    cite(frames, good, "gutmdisorder")


def hmdb(spark: SparkSession, raw: str, frames: Frames) -> None:
    (path,) = present(spark, raw, "hmdb/hmdb_metabolites.xml")
    shape = """accession string, secondary_accessions struct<accession:array<string>>, name string, status string, chebi_id string, kegg_id string, inchikey string, chemical_formula string,
    ontology string, biological_properties struct<biospecimen_locations:struct<biospecimen:array<string>>>"""
    rows = readers.xml_records(spark, path, "metabolite", " ".join(shape.split()))
    rows = rows.withColumn("paths", F.filter(readers.tree_paths(F.col("ontology")), lambda p: p[0] == SOURCE[0])).withColumn("specimens", F.coalesce("biological_properties.biospecimen_locations.biospecimen", F.array().cast("array<string>")))
    rows = rows.withColumn("rules", classify.rules_met({"microbial-origin": rules.has_origin(F.col("paths"), MICROBE), "feces": F.array_contains("specimens", "Feces")})).filter(F.size("rules") > 0)
    key = F.when(F.trim("chebi_id") != "", F.concat(F.lit("CHEBI:"), F.trim("chebi_id"))).otherwise(F.concat(F.lit("HMDB:"), "accession"))
    rows = rows.withColumn("metabolite_id", F.coalesce(key, F.concat(F.lit("HMDB:"), "accession"))).withColumn("evidence_level", rules.status_level(F.col("status")))
    frames.put(
        "metabolite",
        rows.select("metabolite_id", "name", F.col("accession").alias("hmdb_id"), "kegg_id", "inchikey", "status", F.to_json("secondary_accessions.accession").alias("secondary_accessions"), F.to_json("rules").alias("selection_rule"), F.to_json(rules.origin_names(F.col("paths"), SOURCE)).alias("origin"), F.lit("hmdb").alias("source")),
        ["metabolite_id"], ("source", "hmdb"),
    )
    rows = cut(rows.drop("ontology", "biological_properties"))
    claims = rows.select("metabolite_id", "evidence_level", "accession", F.explode(rules.terms_below(F.col("paths"), MICROBE)).alias("path")).withColumn("name", F.element_at("path", -1)).withColumn("given_id", F.lit(None).cast("bigint"))
    got = resolved(spark, raw, claims, None)
    dump = taxa(spark, raw)
    labels = trees.labelled(dump["nodes"].select(F.col("tax_id").alias("child"), F.col("parent_id").alias("parent")))
    asked = got.filter("status = 'ambiguous'").select(F.col("name").alias("key"), F.explode("candidates").alias("tax_id")).distinct()
    one = reconcile.one_under(asked, labels, ROOTS).select(F.col("key").alias("name"), F.col("tax_id").alias("only"))
    got = got.join(one, "name", "left").withColumn("tax_id", F.coalesce("tax_id", "only")).drop("original_rank").join(dump["nodes"].select("tax_id", F.col("rank").alias("original_rank")), "tax_id", "left")
    good, lost = split(got)
    good, broad = policies.under_ceiling(good, "original_rank", "family")
    ledger(frames, lost, "hmdb", F.col("name"), F.col("status"))
    ledger(frames, broad, "hmdb", F.col("name"), F.col("reason"))
    deepest = policies.deeper_claim_wins(reconcile.deepest_paths(good, "metabolite_id", "path").withColumn("exact", F.col("matched_name") == F.col("name")), "metabolite_id", "tax_id", "path", "exact")
    frames.put("taxon_metabolite", marked(deepest, "hmdb", F.col("accession")).select(F.col("tax_id").cast("string").alias("tax_id"), "metabolite_id", "evidence_level", "knowledge_level", "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence")), owner=("primary_source", "hmdb"))
    cite(frames, deepest, "hmdb")


def chembl(spark: SparkSession, raw: str, frames: Frames) -> None:
    mech, mole, targ = present(spark, raw, "chembl/mechanism.jsonl", "chembl/molecule_max_phase4.jsonl", "chembl/target.jsonl")
    ref = "array<struct<ref_type:string,ref_id:string,ref_url:string>>"
    m = readers.json_lines(spark, mech, f"mec_id string, molecule_chembl_id string, parent_molecule_chembl_id string, target_chembl_id string, action_type string, mechanism_of_action string, max_phase string, mechanism_refs {ref}")
    d = readers.json_lines(spark, mole, "molecule_chembl_id string, pref_name string, max_phase string, atc_classifications array<string>, molecule_structures struct<canonical_smiles:string>")
    g = readers.json_lines(spark, targ, "target_chembl_id string, pref_name string, target_type string, organism string, tax_id string, target_components array<struct<accession:string>>")
    pairs = m.select(F.col("molecule_chembl_id").alias("molecule_id"), F.col("parent_molecule_chembl_id").alias("parent_id")).filter("molecule_id is not null")
    props = d.select(F.col("molecule_chembl_id").alias("molecule_id"), F.struct("pref_name", "max_phase", F.to_json("atc_classifications").alias("atc_codes"), F.col("molecule_structures.canonical_smiles").alias("smiles")).alias("props"))
    drugs = cut(policies.collapse_to_parents(props, pairs))
    curie = lambda c: F.concat(F.lit("CHEMBL:"), c)
    frames.put("drug", drugs.select(curie("drug_id").alias("drug_id"), "props.pref_name", "props.atc_codes", "props.smiles", (rules.phase(F.col("props.max_phase")) == rules.APPROVED).cast("string").alias("approved"), F.lit("chembl").alias("source")), ["drug_id"], ("source", "chembl"))
    frames.put("protein_target", g.select(curie("target_chembl_id").alias("target_id"), "pref_name", "organism", F.to_json(rules.accessions(F.col("target_components"))).alias("uniprot")), ["target_id"])
    parent = drugs.select("drug_id", F.explode("members").alias("molecule_chembl_id"))
    kinds = F.transform(F.coalesce("mechanism_refs", F.array().cast(ref)), lambda r: r["ref_type"])
    e = m.join(parent, "molecule_chembl_id").withColumn("evidence_level", rules.mechanism_level(F.col("max_phase"), kinds))
    pubs = F.array_compact(F.transform(F.coalesce("mechanism_refs", F.array().cast(ref)), lambda r: rules.publication(r["ref_type"], r["ref_id"])))
    e = marked(e.filter("target_chembl_id is not null"), "chembl", F.col("mec_id"))
    frames.put("drug_target", e.select(curie("drug_id").alias("drug_id"), curie("target_chembl_id").alias("target_id"), "action_type", "evidence_level", F.to_json(pubs).alias("publications"), F.to_json(rules.regulatory_urls(F.coalesce("mechanism_refs", F.array().cast(ref)))).alias("regulatory_urls"), "knowledge_level", "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence")), owner=("primary_source", "chembl"))
    good, lost = split(resolved(spark, raw, g.select("target_chembl_id", F.col("organism").alias("name"), F.col("tax_id").try_cast("bigint").alias("given_id")).filter("given_id is not null")))
    frames.put("protein_target_taxon", good.select(curie("target_chembl_id").alias("target_id"), F.col("tax_id").cast("string").alias("tax_id"), F.lit("chembl").alias("primary_source")), owner=("primary_source", "chembl"))
    ledger(frames, lost, "chembl", F.col("name"), F.col("status"))
    if (acts := frames.rows("intervention")) is not None:
        links, missed = policies.link_by_label(acts, "intervention_id", "label", d.join(parent, "molecule_chembl_id").filter("pref_name is not null").select(F.col("pref_name").alias("name"), curie("drug_id").alias("target")).distinct())
        frames.put("intervention_drug", links.select("intervention_id", F.col("target").alias("drug_id"), F.lit("pref_name").alias("match_method"), F.lit("chembl").alias("primary_source")), owner=("primary_source", "chembl"))
        ledger(frames, missed, "chembl", F.col("label"), F.col("reason"))
    cite(frames, good, "chembl")


def drug_index(frames: Frames, own: str) -> DataFrame | None:
    """(kind, value, target) of the drug table: names, and codes that one drug has; a source's own rows are left out."""
    held = frames.rows("drug")
    if held is None:
        return None
    held = held.filter(~F.col("source").eqNullSafe(F.lit(own)))
    names = held.filter("pref_name is not null").groupBy(reconcile.casefold(F.trim("pref_name")).alias("value")).agg(F.min("drug_id").alias("target"))
    codes = held if "atc_codes" in held.columns else held.withColumn("atc_codes", F.lit(None).cast("string"))
    codes = reconcile.unique_keys(codes.select(F.explode(rules.atc_codes(F.col("atc_codes"))).alias("value"), F.col("drug_id").alias("target")), "value", "target")
    return names.select(F.lit("name").alias("kind"), "value", "target").unionByName(codes.select(F.lit("atc").alias("kind"), "value", "target"))


def joined_drugs(frames: Frames, source: str, asked: DataFrame, key: str, minted: Column) -> DataFrame:
    """(key, drug_id, drug_join): the first variant that names a drug, else the source's own key; minted drugs join the table, disagreements the ledger."""
    index = drug_index(frames, source)
    if index is None:
        got = asked.select(key, F.lit(None).cast("string").alias("target"), F.lit("minted").alias("route"))
    else:
        got = reconcile.route_join(asked, key, "v", index)
        ledger(frames, got.filter("size(also) > 0"), source, F.col(key), F.concat(F.lit("other routes reach "), F.array_join("also", "|")))
    got = cut(got.join(asked.select(key, "name"), key).withColumn("drug_id", F.coalesce("target", minted)))
    frames.put("drug", got.filter("route = 'minted'").select("drug_id", F.col("name").alias("pref_name"), F.lit(source).alias("source")).distinct(), ["drug_id"], ("source", source))
    return got.select(key, "drug_id", F.col("route").alias("drug_join"))


def maier2018(spark: SparkSession, raw: str, frames: Frames) -> None:
    base = "drug_screens/maier2018/NIHMS76168-supplement-Supplementary_table_{}.xlsx"
    one, two, three, _ = present(spark, raw, *[base.format(i) for i in (1, 2, 3, 4)])
    screen = readers.workbook(spark, three, None, "prestwick_ID")
    number = lambda c: classify.null_words(F.col(c), "NA").try_cast("double")
    cells = readers.unpivot_matrix(screen, ["prestwick_ID", "chemical_name", "drug_class", "n_hit"], r"\(NT\d+\)\s*$", "header", "cell").withColumn("nt_code", rules.nt_code(F.col("header"))).withColumn("p", number("cell"))
    cells = cut(cells).withColumn("relation", rules.screen_relation(F.col("p").isNotNull(), classify.hit(F.col("p"), 0.01), "INHIBITS_GROWTH_OF", "DOES_NOT_INHIBIT_GROWTH_OF"))
    counted = cells.groupBy("prestwick_ID").agg(F.count(F.when(F.col("relation") == "INHIBITS_GROWTH_OF", 1)).cast("long").alias("n"))
    readers.reproduces(counted, screen.select("prestwick_ID", F.col("n_hit").try_cast("double").cast("long").alias("n")).filter("prestwick_ID is not null"), "prestwick_ID", "n")
    drugs = readers.workbook(spark, one, None, "prestwick_ID").select(F.col("prestwick_ID").alias("k"), F.col("`ATC codes`").alias("atc"))
    asked = screen.filter("prestwick_ID is not null").select(F.col("prestwick_ID").alias("k"), F.col("chemical_name").alias("name")).join(drugs, "k", "left")
    got = joined_drugs(frames, "maier2018", asked.select("k", "name", rules.catalogue_variants(F.col("name"), F.col("atc")).alias("v")), "k", F.concat(F.lit("PRESTWICK:"), "k"))
    species = readers.workbook(spark, two, None, "NT_code").select(F.col("NT_code").alias("nt_code"), rules.overrides(F.col("species"), {"bacteroides fragilis nontoxigenic": "Bacteroides fragilis", "bacteroides fragilis enterotoxigenic (et)": "Bacteroides fragilis"}).alias("name"), F.lit(None).cast("bigint").alias("given_id"))
    good, lost = split(resolved(spark, raw, species))
    ledger(frames, lost, "maier2018", F.col("name"), F.col("status"))
    ledger(frames, cells.filter("relation is null"), "maier2018", F.concat_ws(" ", "prestwick_ID", "nt_code"), F.lit("not measured"))
    edges = marked(cells.filter("relation is not null").join(got, F.col("prestwick_ID") == F.col("k")).join(good.select("nt_code", F.col("tax_id").cast("string").alias("tax_id")), "nt_code"), "maier2018", F.concat_ws(":", "prestwick_ID", "nt_code"))
    for kind, table in (("INHIBITS_GROWTH_OF", "drug_taxon_inhibited"), ("DOES_NOT_INHIBIT_GROWTH_OF", "drug_taxon_no_effect")):
        frames.put(table, edges.filter(F.col("relation") == kind).select("drug_id", "tax_id", "nt_code", F.col("p").cast("string").alias("adjusted_p_value"), "drug_class", "drug_join", rules.effect(F.col("relation")).alias("effect"), F.lit("in-vitro").alias("evidence_level"), "primary_source", "source_record_id"), owner=("primary_source", "maier2018"))
    cite(frames, good, "maier2018")


#: What stands under a strain's name in the screen, in order (fixed values).
BLOCK = ("consumed", "sd", "p", "fdr", "n")


def zimmermann2019(spark: SparkSession, raw: str, frames: Frames) -> None:
    (path,) = present(spark, raw, "drug_screens/zimmermann2019/41586_2019_1291_MOESM1_ESM.xlsx")
    grid = readers.workbook(spark, path, "Supplementary Table 3")
    top = grid.filter(F.element_at("cells", 1) == "DrugName").orderBy("row").limit(1).collect()
    if not top:
        raise readers.MalformedInput("no DrugName row")
    starts = [(i, v.strip()) for i, v in enumerate(top[0]["cells"]) if v and v.strip()][1:]
    starts = [(i, v) for i, v in starts if i >= 2]
    at = lambda i: F.get("cells", F.lit(i)).try_cast("double")
    blocks = F.array(*[F.struct(F.lit(v).alias("label"), at(i).alias("consumed"), at(i + 3).alias("fdr")) for i, v in starts])
    cells = grid.filter((F.col("row") > top[0]["row"] + 1) & (F.coalesce(F.trim(F.element_at("cells", 1)), F.lit("")) != "")).select(F.trim(F.element_at("cells", 1)).alias("drug"), at(1).alias("threshold"), F.explode(blocks).alias("b")).select("drug", "threshold", "b.*")
    cells = cut(cells.filter(~rules.is_control(F.col("label"))))
    hit = classify.consumed(F.col("consumed"), F.col("threshold"), F.col("fdr"))
    cells = cells.withColumn("relation", rules.screen_relation(hit.isNotNull(), hit, "METABOLISES", "DOES_NOT_METABOLISE"))
    drugs = readers.workbook(spark, path, "Supplementary Table 2", "MOLENAME").select(F.col("MOLENAME").alias("name"), F.col("name").alias("parent"))
    asked = cells.select(F.col("drug").alias("k")).distinct().join(drugs.withColumn("_j", rules.join_key(F.col("name"))), rules.join_key(F.col("k")) == F.col("_j"), "left").select("k", F.coalesce("name", "k").alias("name"), "parent")
    got = joined_drugs(frames, "zimmermann2019", asked.select("k", "name", rules.screened_variants(F.col("name"), F.col("parent")).alias("v")), "k", F.concat(F.lit("ZIMMERMANN2019:"), classify.slug(F.col("k"))))
    strains = readers.workbook(spark, path, "Supplementary Table 1", "Species").select(F.col("Species").alias("entry"), F.col("Reference").alias("collection"), F.concat_ws(" ", "Species", "Reference").alias("name"))
    columns = policies.match_columns(cells.select("label").distinct(), "label", strains, "collection", "name")
    good, lost = split(resolved(spark, raw, columns.select("label", F.coalesce("entry", "label").alias("name"), F.lit(None).cast("bigint").alias("given_id"))))
    ledger(frames, lost, "zimmermann2019", F.col("label"), F.col("status"))
    edges = marked(cells.filter("relation is not null").join(got, F.col("drug") == F.col("k")).join(good.select("label", F.col("tax_id").cast("string").alias("tax_id")), "label"), "zimmermann2019", F.concat_ws(":", "drug", "label"))
    for kind, table in (("METABOLISES", "taxon_drug_metabolised"), ("DOES_NOT_METABOLISE", "taxon_drug_not_metabolised")):
        frames.put(table, edges.filter(F.col("relation") == kind).select("tax_id", "drug_id", F.col("label").alias("strain"), F.col("consumed").cast("string").alias("percent_consumed"), F.col("threshold").cast("string").alias("drug_threshold_percent"), F.col("fdr").cast("string").alias("fdr_p_value"), "drug_join", F.lit("in-vitro").alias("evidence_level"), "primary_source", "source_record_id"), owner=("primary_source", "zimmermann2019"))
    cite(frames, good, "zimmermann2019")


def masi(spark: SparkSession, raw: str, frames: Frames) -> None:
    base = "masi/MASI_v1.0_download_{}.xlsx"
    inter, assoc, microbes, substances, mondo = present(spark, raw, *[base.format(x) for x in ("microbeSubstanceInteractionRecords_ver20200928", "microbeDiseaseAssociationRecords", "microbesInfo", "substanceInfo")], "mondo/mondo.obo")
    subs = readers.workbook(spark, substances, None, "Substance_id").filter("Substance_id is not null")
    subs = subs.withColumn("substance_id", rules.prefixed("MASI", F.col("Substance_id")))
    asked = subs.filter(~rules.is_class(F.col("Substance_subcategory"))).select(F.col("substance_id").alias("k"), F.col("Substance_name").alias("name"), rules.substance_variants(F.col("Substance_name")).alias("v"))
    index = drug_index(frames, "masi")
    same = asked.select("k", F.lit(None).cast("string").alias("target")) if index is None else reconcile.route_join(asked, "k", "v", index).select("k", "target")
    frames.put("substance", subs.join(same, F.col("substance_id") == F.col("k"), "left").select("substance_id", F.col("Substance_name").alias("name"), F.col("target").alias("drug_id"), F.lit("masi").alias("source")), ["substance_id"], ("source", "masi"))
    info = readers.workbook(spark, microbes, None, "microbe_id").select(F.col("microbe_id").alias("Microbe-ID"), F.col("microbe_tax_id"), F.col("genus_id"))
    rows = readers.workbook(spark, inter, None, "Interation_Record_ID").join(info, "Microbe-ID", "left")
    rows = rows.withColumn("r", policies.routed_taxon(F.col("`Microbe-Tax-ID`"), F.col("microbe_tax_id"), F.col("genus_id"))).withColumn("name", F.col("`Microbe-Name`")).withColumn("given_id", F.col("r.tax_id"))
    ledger(frames, rows.filter("r.note is not null"), "masi", F.col("`Interation_Record_ID`"), F.col("r.note"))
    good, lost = split(resolved(spark, raw, rows, None))
    ledger(frames, lost, "masi", F.col("name"), F.col("status"))
    changes = F.col("Interaction_Category").startswith("Substances alter")
    good = good.withColumn("relation", F.when(changes, rules.abundance_relation(F.col("Microbe_Change"))).otherwise(rules.metabolism_relation(F.col("Metabolism_Effect_on_Drug")))).withColumn("substance_id", rules.prefixed("MASI", F.col("`Substance-chemicalD`") if "Substance-chemicalD" in good.columns else F.col("Substance_id")))
    ledger(frames, good.filter("relation is null"), "masi", F.col("`Interation_Record_ID`"), F.lit("a change without a direction"))
    edges = marked(good.filter("relation is not null"), "masi", F.col("`Interation_Record_ID`")).withColumn("evidence_level", rules.system_level(F.col("Experiment_System"), F.col("Experiment_Model_Species"))).withColumn("p", rules.publications(F.col("Reference_ID_Type"), F.col("Reference_ID")))
    out = edges.select("relation", F.col("tax_id").cast("string").alias("tax_id"), "substance_id", rules.change_direction(F.col("Microbe_Change")).alias("direction"), "evidence_level", F.to_json("p.curies").alias("publications"), F.col("p.pmid").cast("string").alias("pmid"), F.col("r.route").alias("taxon_id_route"), "knowledge_level", "agent_type", "primary_source", "source_record_id")
    screens = {n: frames.rows(x) for n, x in (("maier2018", "drug_taxon_inhibited"), ("zimmermann2019", "taxon_drug_metabolised")) if frames.rows(x) is not None}
    out = cut(out)
    if screens:
        out = policies.also_measured(out.join(frames.rows("substance").select("substance_id", "drug_id"), "substance_id", "left"), ["tax_id", "drug_id"], screens).drop("drug_id").withColumn("also_measured", F.to_json("also_measured"))
    for kind, table in (("METABOLISES_SUBSTANCE", "metabolised"), ("DOES_NOT_METABOLISE_SUBSTANCE", "not_metabolised"), ("ABUNDANCE_CHANGED_BY_SUBSTANCE", "changed"), ("ABUNDANCE_UNCHANGED_BY_SUBSTANCE", "unchanged")):
        frames.put(f"taxon_substance_{table}", out.filter(F.col("relation") == kind).drop("relation"), owner=("primary_source", "masi"))
    terms = cut(readers.disease_terms(readers.obo(spark, mondo)))
    links = readers.workbook(spark, assoc, None, "Association-record-ID").withColumn("name", F.col("`Microbe-name`")).withColumn("given_id", classify.digits(F.col("`Microbe-Tax-ID`")))
    well, ill = split(resolved(spark, raw, links, None))
    ledger(frames, ill, "masi", F.col("name"), F.col("status"))
    hubs = policies.by_name(well, "Disease-name", terms, rules.disease_name).select(F.col("Disease-name").alias("_d"), "hub_id")
    well = well.join(hubs, F.col("Disease-name") == F.col("_d"), "left").withColumn("condition_id", F.coalesce("hub_id", rules.prefixed("MASI", F.col("`MASI-Disease-ID`"))))
    frames.put("disease", well.select("condition_id", F.col("Disease-name").alias("label")).distinct(), ["condition_id"])
    frames.put("taxon_condition", marked(well, "masi", F.col("`Association-record-ID`")).select(F.col("tax_id").cast("string").alias("tax_id"), "condition_id", rules.direction(F.col("`Change-of-microbe`")).alias("direction"), F.lit("observational-unspecified").alias("evidence_level"), "knowledge_level", "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence")), owner=("primary_source", "masi"))
    cite(frames, good.select("tax_id").unionByName(well.select("tax_id")), "masi")


def mimedb(spark: SparkSession, raw: str, frames: Frames) -> None:
    path, organisms = present(spark, raw, "mimedb/v2/mimedb_metabolites_v2.csv", "mimedb/v2/mimedb_microbes_v2.csv")
    rows = readers.banner_csv(spark, path, null_value="NULL")
    readers.release(rows, {"v2": ["mime_id", "name", "hmdb_id", "moldb_inchikey"]})
    rows = rows.select(F.col("mime_id").alias("mime"), F.trim("name").alias("name"), rules.hmdb_accession(F.col("hmdb_id")).alias("accession"), F.trim("moldb_inchikey").alias("inchikey"), F.col("moldb_formula").alias("formula")).filter("mime is not null")
    mine = reconcile.unique_keys(rows, "accession", "mime").withColumnRenamed("mime", "only")  # an accession that several records claim is one of none
    rows = rows.join(mine, "accession", "left").withColumn("accession", F.when(F.col("only").isNotNull(), F.col("accession"))).drop("only")
    held = frames.rows("metabolite")
    if held is None:
        held = spark.createDataFrame([], "metabolite_id string, hmdb_id string, secondary_accessions string, inchikey string, name string, source string")
    spare = F.coalesce(F.from_json("secondary_accessions", "array<string>"), F.array().cast("array<string>"))
    held = held.select(F.col("metabolite_id").alias("id"), F.transform(F.concat(F.array("hmdb_id"), spare), lambda a: rules.hmdb_accession(a)).alias("accessions"), "inchikey", "name", "source")
    rows, held = cut(rows), cut(held)
    new, old = policies.already_held(rows.withColumn("inchikey", F.nullif("inchikey", F.lit(""))), "mime", held, "source", "mimedb")
    frames.put("metabolite", new.select(F.concat(F.lit("MIMEDB:"), "mime").alias("metabolite_id"), "name", F.col("accession").alias("hmdb_id"), "inchikey", F.lit("mimedb").alias("source")), ["metabolite_id"], ("source", "mimedb"))
    ledger(frames, old, "mimedb", F.col("mime"), F.concat(F.lit("held by "), "route"))
    who = readers.banner_csv(spark, organisms, null_value="NULL").select(F.trim("name").alias("name"), classify.digits(F.col("ncbi_tax_id")).alias("given_id"))
    frames.put("mimedb_organisms", policies.status_histogram(resolved(spark, raw, who)).select("status", F.col("n").cast("string").alias("n")))


def njc19(spark: SparkSession, raw: str, frames: Frames) -> None:
    (path,) = present(spark, raw, "njc19/41597_2020_516_MOESM1_ESM.xlsx")
    rows = readers.workbook(spark, path, "Online-only Table 5", "Species", skip="Species")
    compound = next(c for c in rows.columns if "ompound" in c or "Metabolite" in c)
    refs = next(c for c in rows.columns if c.startswith("Ref"))
    rows = rows.select(F.trim("Species").alias("name"), F.col(f"`{compound}`").alias("compound"), F.col("`Metabolic activity`").alias("activity"), F.col(f"`{refs}`").alias("refs"), F.lit(None).cast("bigint").alias("given_id"))
    rows = rows.filter(~F.lower("name").isin("human colonocyte", "human goblet cell", "human hepatocyte", "mouse goblet cell", "mouse hepatocyte", "mouse intestinal cell"))
    asked = rows.select("compound").distinct().select(F.col("compound").alias("k"), rules.compound_variants(F.col("compound")).alias("v"))
    held = frames.rows("metabolite")
    index = spark.createDataFrame([], "kind string, value string, target string") if held is None else held.filter("source != 'njc19' and name is not null").groupBy(reconcile.casefold(F.trim("name")).alias("value")).agg(F.min("metabolite_id").alias("target")).select(F.lit("name").alias("kind"), "value", "target")
    got = reconcile.route_join(cut(asked), "k", "v", index).withColumn("metabolite_id", F.coalesce("target", F.concat(F.lit("NJC19:"), classify.slug(F.col("k")))))
    got = cut(got)
    frames.put("metabolite", got.filter("target is null").select("metabolite_id", F.col("k").alias("name"), F.lit("njc19").alias("source")), ["metabolite_id"], ("source", "njc19"))
    good, lost = split(resolved(spark, raw, rows))
    ledger(frames, lost, "njc19", F.col("name"), F.col("status"))
    ledger(frames, good.filter(F.size(rules.activities(F.col("activity"))) == 0), "njc19", F.col("activity"), F.lit("an activity outside the vocabulary"))
    claims = good.select("tax_id", "compound", "refs", F.explode(rules.activities(F.col("activity"))).alias("a")).join(got.select(F.col("k").alias("compound"), "metabolite_id", F.col("route").alias("metabolite_join")), "compound")
    claims = claims.withColumn("x", rules.exchange_references(F.col("refs"), F.col("a.relation")))
    edges = marked(claims, "njc19", F.concat_ws(":", "tax_id", "compound")).select(
        F.when(F.col("a.negated"), "NO_EXCHANGE_WITH").otherwise(F.col("a.relation")).alias("relation"), F.col("tax_id").cast("string").alias("tax_id"), "metabolite_id", "metabolite_join", F.col("a.relation").alias("source_relation"),
        F.to_json("x.refs").alias("reference_ids"), F.col("x.genus_only").cast("string").alias("genus_level_evidence"), F.lit("in-vitro").alias("evidence_level"), "knowledge_level", "agent_type", "primary_source", "source_record_id", F.col("licence").alias("source_licence"),
    )
    for kind, table in (("PRODUCES", "taxon_metabolite"), ("CONSUMES", "taxon_metabolite_consumed"), ("DEGRADES", "taxon_metabolite_degraded"), ("NO_EXCHANGE_WITH", "taxon_metabolite_absent")):
        frames.put(table, edges.filter(F.col("relation") == kind).drop("relation"), owner=("primary_source", "njc19"))
    cite(frames, good, "njc19")


def _pathways(spark: SparkSession, frames: Frames, source: str, prefix: str, declared: DataFrame, mapping: DataFrame, index: DataFrame) -> None:
    """declared (id, label), mapping (id, compound, label, evidence columns), index (compound, metabolite_id)."""
    every = policies.mint_missing(declared, mapping, "id", "label")
    curie = lambda c: F.concat(F.lit(f"{prefix}:"), c)
    frames.put("pathway", every.select(curie("id").alias("pathway_id"), F.col("label").alias("name"), F.col("minted").cast("string").alias("minted"), F.lit(source).alias("pathway_source")), ["pathway_id"], ("pathway_source", source))
    links, misses = policies.join_by_id(mapping, "compound", index, "metabolite_id", "metabolite_id")
    frames.put("metabolite_pathway", links.select("metabolite_id", curie("id").alias("pathway_id"), "evidence_code", "evidence_level", "knowledge_level", "agent_type", F.lit(source).alias("primary_source"), F.col("compound").alias("source_record_id")).distinct(), owner=("primary_source", source))
    frames.put("unresolved_pathway_links", misses.select(F.col("compound").alias("source_id"), F.col("n_rows").cast("string").alias("rows"), F.lit(source).alias("primary_source")), owner=("primary_source", source))


def _metabolites(spark: SparkSession, frames: Frames, column: Column) -> DataFrame:
    held = frames.rows("metabolite")
    return spark.createDataFrame([], "compound string, metabolite_id string") if held is None else held.select(column.alias("compound"), "metabolite_id").filter("compound is not null and compound != ''")


def reactome(spark: SparkSession, raw: str, frames: Frames) -> None:
    names, tree, chebi = present(spark, raw, "reactome/ReactomePathways.txt", "reactome/ReactomePathwaysRelation.txt", "reactome/ChEBI2Reactome.txt")
    declared = readers.tsv(spark, names, ["id", "label", "species"]).filter("id != ''").dropDuplicates(["id"])
    rows = readers.tsv(spark, chebi, ["chebi", "id", "url", "label", "evidence_code", "species"]).filter("chebi != ''")
    rows = rows.withColumn("compound", F.concat(F.lit("CHEBI:"), "chebi")).withColumn("e", rules.code_evidence(F.col("evidence_code"))).select("*", F.col("e.level").alias("evidence_level"), F.col("e.knowledge").alias("knowledge_level"), F.col("e.agent").alias("agent_type"))
    _pathways(spark, frames, "reactome", "REACT", declared.select("id", "label"), rows, _metabolites(spark, frames, F.when(F.col("metabolite_id").startswith("CHEBI:"), F.col("metabolite_id"))))
    links = readers.tsv(spark, tree, ["parent", "child"])
    lost = policies.undeclared_ends(links, ("parent", "child"), declared, "id")
    ledger(frames, lost, "reactome", F.col("id"), F.lit("a hierarchy endpoint that no list declares"))
    good = reduce(lambda df, c: df.join(lost.select(F.col("id").alias(c)), c, "left_anti"), ("parent", "child"), links)
    frames.put("pathway_pathway", good.select(F.concat(F.lit("REACT:"), "child").alias("pathway_id"), F.concat(F.lit("REACT:"), "parent").alias("parent_pathway_id"), F.lit("reactome").alias("primary_source")).distinct(), owner=("primary_source", "reactome"))


def kegg(spark: SparkSession, raw: str, frames: Frames) -> None:
    names, link, compounds = present(spark, raw, "kegg/list_pathway.tsv", "kegg/link_compound_pathway.tsv", "kegg/list_compound.tsv")
    declared = readers.tsv(spark, names, ["id", "label"]).dropDuplicates(["id"])
    rows = readers.tsv(spark, link, ["p", "c"]).select(classify.after_prefix(F.col("p")).alias("id"), F.upper(classify.after_prefix(F.col("c"))).alias("compound"))
    rows = rows.join(readers.id_bridge(readers.tsv(spark, compounds, ["c"]).select(F.upper("c").alias("c")), "c").withColumnRenamed("id", "compound"), "compound", "left_semi")
    ledger(frames, rows.join(declared, "id", "left_anti"), "kegg", F.col("id"), F.lit("a link to a map that no list declares"))
    rows = rows.join(declared, "id").withColumns({"evidence_code": F.lit("curated"), "evidence_level": F.lit("unknown"), "knowledge_level": F.lit("knowledge_assertion"), "agent_type": F.lit("manual_agent")})
    _pathways(spark, frames, "kegg", "KEGG", declared, rows, _metabolites(spark, frames, F.upper(F.trim("kegg_id")) if frames.rows("metabolite") is not None and "kegg_id" in frames.rows("metabolite").columns else F.lit(None).cast("string")))


def taxonomy(spark: SparkSession, raw: str, frames: Frames) -> None:
    dump = taxa(spark, raw)
    nodes, cited = dump["nodes"], frames.rows("cited_taxa")
    ids = policies.cited_ids(cited, spark.createDataFrame([], "tax_id long, note string"), "tax_id") if cited is not None else spark.createDataFrame([], "tax_id long")
    scope = getattr(frames, "scope", "cited")
    if scope != "all":
        nodes = nodes.join(reconcile.scope(nodes, ids, ROOTS if scope == "microbial" else []), "tax_id", "left_semi")
    nodes = cut(nodes)
    rows = policies.taxon_rows(nodes, dump["names"].join(nodes.select("tax_id"), "tax_id", "left_semi"))
    rows = rows.withColumn("placeholder", reconcile.is_placeholder(F.col("name")))
    text = [F.col(c).cast("string").alias(c) for c in ("tax_id", "name", "rank", "parent_id", "n_synonyms", "synonyms_text", "placeholder")]
    frames.put("taxon", rows.select(*text, F.when(F.size("synonyms") > 0, F.to_json("synonyms")).alias("synonyms")), ["tax_id"])
    frames.put("taxon_parent", rows.filter("parent_id is not null").select(F.col("tax_id").cast("string").alias("tax_id"), F.col("parent_id").cast("string").alias("parent_id")))


_MAIER = tuple(f"drug_screens/maier2018/NIHMS76168-supplement-Supplementary_table_{i}.xlsx" for i in (1, 2, 3, 4))
_MASI = tuple(f"masi/MASI_v1.0_download_{x}.xlsx" for x in ("microbeSubstanceInteractionRecords_ver20200928", "microbeDiseaseAssociationRecords", "microbesInfo", "substanceInfo"))
SOURCES = [
    Source("bugsigdb", ("bugsigdb/full_dump_main.csv", "mondo/mondo.obo"), (), bugsigdb, ("signature",), "CC-BY-4.0"),
    Source("card", ("card/card-data/card.json", "card/card-data/aro_index.tsv", "card/card-data/PMID.tsv", "card/card-ontology/aro.obo"), (), card, ("resistance_gene",), rules.DATA_LICENCE),
    Source("gutmdisorder", ("gutmdisorder/human.xlsx", "gutmdisorder/mouse.xlsx", "mondo/mondo.obo"), (), gutmdisorder, ("taxon_intervention",)),
    Source("hmdb", ("hmdb/hmdb_metabolites.xml",), (), hmdb, ("metabolite",), "CC-BY-NC-4.0"),
    Source("chembl", ("chembl/mechanism.jsonl", "chembl/molecule_max_phase4.jsonl", "chembl/target.jsonl"), ("gutmdisorder",), chembl, ("drug",), "CC-BY-SA-3.0"),
    Source("maier2018", _MAIER, ("chembl",), maier2018, ("drug_taxon_inhibited",)),
    Source("zimmermann2019", ("drug_screens/zimmermann2019/41586_2019_1291_MOESM1_ESM.xlsx",), ("chembl", "maier2018"), zimmermann2019, ("taxon_drug_metabolised",)),
    Source("masi", (*_MASI, "mondo/mondo.obo"), ("chembl", "maier2018", "zimmermann2019"), masi, ("substance",)),
    Source("mimedb", ("mimedb/v2/mimedb_metabolites_v2.csv", "mimedb/v2/mimedb_microbes_v2.csv"), ("hmdb",), mimedb, ("metabolite",), "CC-BY-NC-4.0"),
    Source("njc19", ("njc19/41597_2020_516_MOESM1_ESM.xlsx",), ("hmdb", "mimedb"), njc19, ("taxon_metabolite",), "CC-BY-4.0"),
    Source("reactome", ("reactome/ReactomePathways.txt", "reactome/ReactomePathwaysRelation.txt", "reactome/ChEBI2Reactome.txt"), ("hmdb", "mimedb", "njc19"), reactome, ("pathway",), "CC0-1.0"),
    Source("kegg", ("kegg/list_pathway.tsv", "kegg/link_compound_pathway.tsv", "kegg/list_compound.tsv"), ("hmdb", "reactome"), kegg, ("pathway",), "KEGG-academic", True),
    Source("taxonomy", tuple(f"ncbi_taxonomy/{x}.dmp" for x in ("nodes", "names", "merged", "delnodes")), ("bugsigdb", "card", "gutmdisorder", "hmdb", "chembl", "maier2018", "zimmermann2019", "masi", "njc19"), taxonomy, ("taxon",), "public-domain"),
]


def _node(table: str, key: str, labels: tuple[str, ...] = (), **types: str) -> dict:
    return {"table": table, "key": key, "labels": list(labels), "properties": types}


def _edge(table: str, source: str, src: str, target: str, dst: str, **types: str) -> dict:
    return {"table": table, "source": source, "src": src, "target": target, "dst": dst, "properties": types}


#: The types of the graph and the tables they load from. An id that must stay text is declared so.
DOCUMENT = {
    "nodes": {
        "Taxon": _node("taxon", "tax_id", synonyms="list", placeholder="bool", name="string"), "UnresolvedTaxon": _node("unresolved_taxa", "unresolved_id"), "Study": _node("study", "study_id"), "Paper": _node("paper", "pmid"),
        "Disease": _node("disease", "condition_id", ("Condition",)), "Phenotype": _node("phenotype", "condition_id", ("Condition",)), "Exposure": _node("exposure", "condition_id", ("Condition",)),
        "Signature": _node("signature", "signature_id"), "BodySite": _node("bodysite", "bodysite_id"), "Intervention": _node("intervention", "intervention_id"), "Metabolite": _node("metabolite", "metabolite_id", selection_rule="list", origin="list"),
        "Pathway": _node("pathway", "pathway_id", minted="bool"), "Drug": _node("drug", "drug_id", atc_codes="list", approved="bool"), "ProteinTarget": _node("protein_target", "target_id", uniprot="list"),
        "ResistanceGene": _node("resistance_gene", "aro_id", publications="list"), "DrugClass": _node("drug_class", "drug_class_id"), "ResistanceMechanism": _node("resistance_mechanism", "mechanism_id"), "Substance": _node("substance", "substance_id"),
    },
    "edges": {
        "HAS_PARENT": _edge("taxon_parent", "Taxon", "tax_id", "Taxon", "parent_id"), "ASSOCIATED_WITH": _edge("taxon_condition", "Taxon", "tax_id", "Disease", "condition_id"),
        "REPORTED_BY": _edge("taxon_signature", "Taxon", "tax_id", "Signature", "signature_id"), "UNRESOLVED_REPORTED_BY": _edge("unresolved_taxon_signature", "UnresolvedTaxon", "unresolved_id", "Signature", "signature_id"),
        "AT_BODY_SITE": _edge("signature_bodysite", "Signature", "signature_id", "BodySite", "bodysite_id"), "ABUNDANCE_CHANGED_BY": _edge("taxon_intervention", "Taxon", "tax_id", "Intervention", "intervention_id"),
        "CONFERS_RESISTANCE_TO": _edge("resistance_gene_drug_class", "ResistanceGene", "aro_id", "DrugClass", "drug_class_id"), "VIA_MECHANISM": _edge("resistance_gene_mechanism", "ResistanceGene", "aro_id", "ResistanceMechanism", "mechanism_id"),
        "CARRIES_RESISTANCE_GENE": _edge("taxon_resistance_gene", "Taxon", "tax_id", "ResistanceGene", "aro_id"), "HAS_MECHANISM": _edge("drug_target", "Drug", "drug_id", "ProteinTarget", "target_id", publications="list"),
        "OF_ORGANISM": _edge("protein_target_taxon", "ProteinTarget", "target_id", "Taxon", "tax_id"), "IS_DRUG": _edge("intervention_drug", "Intervention", "intervention_id", "Drug", "drug_id"),
        "PRODUCES": _edge("taxon_metabolite", "Taxon", "tax_id", "Metabolite", "metabolite_id"), "CONSUMES": _edge("taxon_metabolite_consumed", "Taxon", "tax_id", "Metabolite", "metabolite_id"),
        "DEGRADES": _edge("taxon_metabolite_degraded", "Taxon", "tax_id", "Metabolite", "metabolite_id"), "NO_EXCHANGE_WITH": _edge("taxon_metabolite_absent", "Taxon", "tax_id", "Metabolite", "metabolite_id"),
        "IN_PATHWAY": _edge("metabolite_pathway", "Metabolite", "metabolite_id", "Pathway", "pathway_id"), "PART_OF_PATHWAY": _edge("pathway_pathway", "Pathway", "pathway_id", "Pathway", "parent_pathway_id"),
        "INHIBITS_GROWTH_OF": _edge("drug_taxon_inhibited", "Drug", "drug_id", "Taxon", "tax_id", adjusted_p_value="float"), "DOES_NOT_INHIBIT_GROWTH_OF": _edge("drug_taxon_no_effect", "Drug", "drug_id", "Taxon", "tax_id", adjusted_p_value="float"),
        "METABOLISES": _edge("taxon_drug_metabolised", "Taxon", "tax_id", "Drug", "drug_id", percent_consumed="float"), "DOES_NOT_METABOLISE": _edge("taxon_drug_not_metabolised", "Taxon", "tax_id", "Drug", "drug_id", percent_consumed="float"),
        "METABOLISES_SUBSTANCE": _edge("taxon_substance_metabolised", "Taxon", "tax_id", "Substance", "substance_id"), "DOES_NOT_METABOLISE_SUBSTANCE": _edge("taxon_substance_not_metabolised", "Taxon", "tax_id", "Substance", "substance_id"),
        "ABUNDANCE_CHANGED_BY_SUBSTANCE": _edge("taxon_substance_changed", "Taxon", "tax_id", "Substance", "substance_id"), "ABUNDANCE_UNCHANGED_BY_SUBSTANCE": _edge("taxon_substance_unchanged", "Taxon", "tax_id", "Substance", "substance_id"),
        "SAME_COMPOUND_AS": _edge("substance", "Substance", "substance_id", "Drug", "drug_id"), "PART_OF_STUDY": _edge("signature", "Signature", "signature_id", "Study", "study_id"), "PUBLISHED_AS": _edge("study", "Study", "study_id", "Paper", "pmid"),
    },
}
