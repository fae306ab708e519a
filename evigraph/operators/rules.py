"""What a source's cells say: evidence levels, relations, directions, routes and names as column rules."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reconcile import casefold

#: Study design -> level (fixed values). One of them holds a comma, which also parts several designs.
DESIGNS = {
    "randomized controlled trial": "interventional-rct",
    "laboratory experiment": "in-vitro",
    "meta-analysis": "meta-analysis",
    "case-control": "observational",
    "cross-sectional observational, not case-control": "observational",
    "prospective cohort": "observational",
    "time series / longitudinal observational": "observational",
}
#: Assay -> level of an observational design (fixed values).
BY_ASSAY = {"WMS": "observational-shotgun", "16S": "observational-16S", "ITS / ITS2": "observational-amplicon", "18S": "observational-amplicon", "PCR": "observational-targeted"}
#: Host cells that name no animal model (fixed values).
NO_MODEL = ("", "NA", "Not specified", "Homo sapiens")
#: Research types that intervene, and marks of an assay in free text, strongest first (fixed values).
INTERVENES = ("Interventions change the composition of gut microbiota", "Gut microbiota for adjuvant therapy")
ASSAY_MARKS = (("shotgun", "WMS"), ("16s", "16S"), ("qpcr", "PCR"), ("pcr", "PCR"), ("denaturing gradient gel electrophoresis", "PCR"))
#: Ranks above a species, and roots under which nothing is an organism (fixed values).
ABOVE_SPECIES = ("genus", "family", "order", "class", "phylum", "kingdom", "domain", "superkingdom", "species group", "no rank", "clade")
NO_ORGANISM_ROOTS = (28384, 12908)
#: Licences of a fact that the open ontology states too, and of one that only the data state (fixed values).
OPEN_LICENCE, DATA_LICENCE = "CC-BY-4.0", "CARD-noncommercial"
#: Kinds of references of a mechanism, the phase of an approved drug, and CURIE prefixes (fixed values).
REGULATORY, LITERATURE, APPROVED = ("DailyMed", "FDA", "EMA", "PMDA", "HMA", "BNF"), ("PubMed", "PMC", "DOI"), 4
PUBLICATIONS = {"PubMed": "PMID", "DOI": "DOI"}
#: Metabolite statuses that were observed (fixed values).
OBSERVED = ("detected", "quantified")
#: Evidence code -> (level, knowledge level, agent type, ECO term) (fixed values).
CODES = {"TAS": ("unknown", "knowledge_assertion", "manual_agent", "ECO:0000304"), "IEA": ("computational-predicted", "logical_entailment", "automated_agent", "ECO:0000501")}
#: Activity -> relation, the mark of a refutation, and reference scopes (fixed values).
ACTIVITIES = {"Consumption (import)": "CONSUMES", "Production (export)": "PRODUCES", "Macromolecule degradation": "DEGRADES"}
REFUTED = "(-)"
SCOPES = {"import": "CONSUMES", "export": "PRODUCES", "degradation": "DEGRADES"}
#: Cells of the interaction table (fixed values).
ABSENT, NOT_METABOLISED, UNCHANGED = "n.a.", "Microbe does not metabolize drug", "No significant change"
CHANGES = {"Increase": "increased", "Decrease": "decreased"}
CLASS_PARTS = ("drug class", "drug category")
#: Spelled-out directions of the reference sets (fixed values).
DIRECTIONS = {"increase": "increased", "increased": "increased", "decrease": "decreased", "decreased": "decreased"}
#: Relation -> effect word (fixed values).
EFFECTS = {"INHIBITS_GROWTH_OF": "inhibited", "DOES_NOT_INHIBIT_GROWTH_OF": "no-effect", "METABOLISES": "metabolised", "DOES_NOT_METABOLISE": "not-metabolised"}
#: What a claim is and who makes it: the portable vocabularies (fixed values).
KNOWLEDGE_LEVELS = ("knowledge_assertion", "logical_entailment", "prediction", "statistical_association", "text_co_occurrence", "observation", "not_provided")
AGENT_TYPES = ("manual_agent", "automated_agent", "data_analysis_pipeline", "computational_model", "text_mining_agent", "image_processing_agent", "manual_validation_of_automated_agent", "not_provided")
#: Suffixes of a salt or hydrate (fixed values).
SALTS = """hydrochlorides? dihydrochloride hydrobromide hydroiodide sodium potassium calcium magnesium lithium ammonium maleate mesilate mesylate besylate tosylate napsylate
sulfate sulphate bisulfate succinate tartrate bitartrate citrate acetate phosphate diphosphate nitrate fumarate oxalate lactate malate gluconate pamoate embonate stearate palmitate mucate
chloride bromide iodide salt dihydrate trihydrate monohydrate hemihydrate hydrate""".split()
#: Prefixes of a configuration (fixed values).
STEREO = r"(?i)^(?:l|d|dl|r|s|\[[rs]\]|\[[rs],[rs]\])-"


def lookup(key: Column, values: dict, default: str | None = None) -> Column:
    """A small closed map, by equality."""
    return reduce(lambda out, kv: F.when(key == kv[0], F.lit(kv[1])).otherwise(out), reversed(list(values.items())), F.lit(default))


def overrides(name: Column, values: dict[str, str]) -> Column:
    """Names that a closed list corrects, by their folded spelling; others stay."""
    return F.coalesce(lookup(casefold(F.trim(name)), values), name)


def study_designs(cell: Column) -> Column:
    """The designs of a cell in order; a design that holds the separator is one."""
    any_design = "|".join(re.escape(x) for x in sorted(DESIGNS, key=len, reverse=True))
    return F.regexp_extract_all(F.coalesce(cell, F.lit("")), F.lit(f"({any_design})"), F.lit(1))


def evidence_level(design: Column, assay: Column | None = None, host: Column | None = None) -> Column:
    """Level of a study by its designs, what it measured with and its host; nothing known: `unknown`."""
    designs = study_designs(design)
    assay = F.trim(F.coalesce(assay if assay is not None else F.lit(""), F.lit("")))
    model = ~F.trim(F.coalesce(host if host is not None else F.lit(""), F.lit(""))).isin(*NO_MODEL)
    lab = F.array_contains(designs, "laboratory experiment")
    watched = F.arrays_overlap(designs, F.array(*[F.lit(k) for k, v in DESIGNS.items() if v == "observational"]))
    return (
        F.when(lab & model, "in-vivo-model").when(lab, "in-vitro").when(model & (F.size(designs) > 0), "in-vivo-model")
        .when(F.array_contains(designs, "randomized controlled trial"), "interventional-rct").when(F.array_contains(designs, "meta-analysis"), "meta-analysis")
        .when(watched, lookup(assay, BY_ASSAY, "observational-unspecified")).otherwise("unknown")
    )


def assay_of(technology: Column) -> Column:
    """A free-text assay as WMS, 16S, PCR or empty: the strongest one named."""
    low = casefold(F.trim(F.coalesce(technology, F.lit(""))))
    return reduce(lambda out, m: F.when(low.contains(m[0]), m[1]).otherwise(out), reversed(ASSAY_MARKS), F.lit(""))


def workbook_level(workbook: Column, research_type: Column, technology: Column) -> Column:
    """Level of a study filed by host: the mouse book is a model, a human intervention is one, the rest is as strong as its assay."""
    levels = {"WMS": "observational-shotgun", "16S": "observational-16S", "PCR": "observational-targeted"}
    return F.when(workbook == "mouse", "in-vivo-model").when(F.trim(research_type).isin(*INTERVENES), "interventional-rct").otherwise(lookup(assay_of(technology), levels, "observational-unspecified"))


def determinant_level(has_sequence: Column) -> Column:
    return F.when(has_sequence, "in-vitro").otherwise("computational-predicted")


def determinant_knowledge(n_publications: Column) -> Column:
    return F.when(n_publications > 0, "knowledge_assertion").otherwise("not_provided")


def licence_of(in_ontology: Column) -> Column:
    return F.when(in_ontology, OPEN_LICENCE).otherwise(DATA_LICENCE)


def specificity(rank: Column, lineage: Column) -> Column:
    """How much of an organism a taxon names; what stands under a root of no organisms is none, whatever its rank."""
    none = F.arrays_overlap(lineage, F.array(*[F.lit(x).cast("long") for x in NO_ORGANISM_ROOTS]))
    return F.when(F.coalesce(none, F.lit(False)), "not-an-organism").when(F.lower(F.trim(rank)).isin(*ABOVE_SPECIES), "above-species").otherwise("species-or-below")


def phase(value: Column) -> Column:
    """A phase spelled 4, '4' or '4.0'; null if it is no number."""
    return F.rint(F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast("double")).cast("int")


def publication(kind: Column, ref: Column) -> Column:
    """A reference as a CURIE; a PMID must be digits."""
    ref, prefix = F.trim(ref), lookup(kind, PUBLICATIONS)
    return F.when((ref != "") & ((prefix != "PMID") | ref.rlike(r"^\d+$")), F.concat(prefix, F.lit(":"), ref))


def mechanism_level(max_phase: Column, kinds: Column) -> Column:
    """An approved drug with a regulator's reference; literature alone; else unknown."""
    some = lambda names: F.array(*[F.lit(x) for x in names])
    approved = (phase(max_phase) == APPROVED) & F.arrays_overlap(kinds, some(REGULATORY))
    papers = (F.size(kinds) > 0) & (F.size(F.array_except(kinds, some(LITERATURE))) == 0)
    return F.when(approved, "interventional-rct").when(papers, "in-vitro").otherwise("unknown")


def status_level(status: Column) -> Column:
    return F.when(casefold(F.trim(status)).isin(*OBSERVED), "in-vitro").otherwise("computational-predicted")


def code_evidence(code: Column) -> Column:
    """struct(level, knowledge, agent, eco) of an evidence code; another code provides nothing."""
    code, names = F.upper(F.trim(code)), ("level", "knowledge", "agent", "eco")
    none = ("unknown", "not_provided", "not_provided", "")
    return F.struct(*[lookup(code, {k: v[i] for k, v in CODES.items()}, none[i]).alias(n) for i, n in enumerate(names)])


class Registry:
    """Sources with what their claims are, who makes them and under which licence; an unknown source provides nothing."""

    def __init__(self):
        self.rows: dict[str, tuple[str, str, str]] = {}

    def add(self, source: str, knowledge: str, agent: str, licence: str) -> Registry:
        if knowledge not in KNOWLEDGE_LEVELS or agent not in AGENT_TYPES:
            raise ValueError(f"{source}: {knowledge!r} or {agent!r} is not in the vocabulary")
        self.rows[source] = (knowledge, agent, licence)
        return self

    def columns(self, source: Column) -> list[Column]:
        part = lambda i, default: lookup(source, {k: v[i] for k, v in self.rows.items()}, default)
        return [part(0, "not_provided").alias("knowledge_level"), part(1, "not_provided").alias("agent_type"), part(2, None).alias("licence")]


def activities(cell: Column) -> Column:
    """array<struct<relation, negated>> of an activity cell; a cell of two activities is two claims, another vocabulary none."""
    cell = F.coalesce(F.trim(cell), F.lit(""))
    negated = F.contains(cell, F.lit(REFUTED))
    return F.array_compact(F.array(*[F.when(F.contains(cell, F.lit(k)), F.struct(F.lit(v).alias("relation"), negated.alias("negated"))) for k, v in ACTIVITIES.items()]))


def exchange_references(cell: Column, relation: Column) -> Column:
    """struct(refs, genus_only) of a relation: the references of its scope if the cell has scopes, else all; genus_only if every one is marked (G)."""
    cell = F.trim(F.coalesce(cell.cast("string"), F.lit("")))
    scoped = cell.contains(";") | cell.rlike(r"^(import|export|degradation)\s*:")
    parts = F.transform(F.split(cell, ";"), lambda p: F.struct(F.trim(F.regexp_extract(p, r"^\s*(\w+)\s*:", 1)).alias("scope"), F.regexp_extract(p, r"^\s*\w+\s*:(.*)$", 1).alias("refs")))
    own = F.filter(parts, lambda p: lookup(p["scope"], SCOPES) == relation)
    text = F.when(scoped, F.array_join(F.transform(own, lambda p: p["refs"]), ",")).otherwise(cell)
    refs = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.struct(refs.alias("refs"), ((F.size(refs) > 0) & F.forall(refs, lambda x: x.rlike(r"\(G\)\s*$"))).alias("genus_only"))


def absent(cell: Column) -> Column:
    text = F.trim(F.coalesce(cell, F.lit("")))
    return (text == "") | (casefold(text) == ABSENT)


def metabolism_relation(effect: Column) -> Column:
    """The category is the claim: only the explicit refutation negates it."""
    return F.when(F.trim(effect) == NOT_METABOLISED, "DOES_NOT_METABOLISE_SUBSTANCE").otherwise("METABOLISES_SUBSTANCE")


def abundance_relation(change: Column) -> Column:
    """Null for a finding without a direction, which is a ledger row."""
    return F.when(F.trim(change).isin(*CHANGES), "ABUNDANCE_CHANGED_BY_SUBSTANCE").when(F.trim(change) == UNCHANGED, "ABUNDANCE_UNCHANGED_BY_SUBSTANCE")


def change_direction(change: Column) -> Column:
    return lookup(F.trim(change), CHANGES, "")


def direction(word: Column) -> Column:
    """A spelled-out direction; another word is none."""
    return lookup(F.lower(F.trim(word)), DIRECTIONS)


def system_level(system: Column, species: Column) -> Column:
    """Level by experiment system and model species: in vivo binds a mixed cell, and needs a host that is not human."""
    low = casefold(F.trim(F.coalesce(system, F.lit(""))))
    hosts = F.filter(F.transform(F.split(F.coalesce(species, F.lit("")), "[;/]"), lambda x: casefold(F.trim(x))), lambda x: (x != "") & (x != ABSENT))
    animal = F.exists(hosts, lambda x: ~x.startswith("human"))
    return F.when(low.contains("in vivo"), F.when(animal, "in-vivo-model").otherwise("unknown")).when(low.contains("in vitro"), "in-vitro").otherwise("unknown")


def publications(kind: Column, cell: Column) -> Column:
    """struct(curies, pmid) of a cell of several references: its text counts, not its type; a bare number counts if the type says so."""
    text = F.trim(F.coalesce(cell, F.lit("")))
    pmids = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)PMID:?\s*(\d+)"), F.lit(1)), lambda x: x.cast("long")))
    dois = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)DOI:?\s*(\S+)"), F.lit(1)), lambda x: F.regexp_replace(x, "[;,]+$", "")))
    bare = F.when((F.size(pmids) + F.size(dois) == 0) & (F.upper(F.trim(kind)) == "PMID") & text.rlike(r"^\d+$"), text.try_cast("long"))
    pmids = F.when(bare.isNotNull(), F.array(bare)).otherwise(pmids)
    curies = F.concat(F.transform(pmids, lambda x: F.concat(F.lit("PMID:"), x.cast("string"))), F.transform(dois, lambda x: F.concat(F.lit("doi:"), x)))
    return F.struct(curies.alias("curies"), F.try_element_at(pmids, F.lit(1)).alias("pmid"))


def disease_name(name: Column) -> Column:
    """A label as a lookup key: folded, without a last abbreviation in parentheses."""
    return casefold(F.trim(F.regexp_replace(F.trim(name), r"\s*\([^)]*\)\s*$", "")))


def without_parenthetical(name: Column) -> Column:
    """Parentheticals of a reference set's disease are dropped."""
    return F.trim(F.regexp_replace(name, r"\s*\([^)]*\)\s*", " "))


def screen_relation(measured: Column, hit: Column, positive: str, negative: str) -> Column:
    """A measured hit, a measured negative, or nothing where it was not measured."""
    return F.when(measured, F.when(hit, positive).otherwise(negative))


def effect(relation: Column) -> Column:
    return lookup(relation, EFFECTS)


def join_key(label: Column) -> Column:
    """Folded letters and digits alone: what two spellings of a label agree on."""
    return F.regexp_replace(casefold(F.coalesce(label, F.lit(""))), "[^a-z0-9]+", "")


def is_control(label: Column) -> Column:
    return F.trim(label).startswith("Control")


def nt_code(header: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(header), r"\((NT\d+)\)\s*$", 1), F.lit(""))


def pubchem_cid(stitch: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(stitch), r"^CID\d(\d{8})$", 1), F.lit("")).try_cast("bigint")


def patric_taxon(feature: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(feature), r"(?i)^fig\|(\d+)\.\d+\.peg\.\d+$", 1), F.lit("")).try_cast("bigint")


def hmdb_accession(raw: Column) -> Column:
    """Five or seven digits as seven; null for anything else."""
    n = F.nullif(F.regexp_extract(F.trim(raw), r"(?i)^HMDB(\d+)$", 1), F.lit(""))
    return F.concat(F.lit("HMDB"), F.when(F.length(n) >= 7, n).otherwise(F.lpad(n, 7, "0")))


def prefixed(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.trim(key))


def is_class(subcategory: Column) -> Column:
    """Whether any part of a subcategory cell names a class of compounds."""
    parts = F.transform(F.split(F.coalesce(subcategory, F.lit("")), ";"), lambda x: casefold(F.trim(x)))
    return F.arrays_overlap(parts, F.array(*[F.lit(x) for x in CLASS_PARTS]))


def merged_ids(*cells: Column) -> Column:
    """Ids of several cells, split, without empties, distinct in order."""
    parts = [F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[|;,]"), lambda x: F.trim(x)), lambda x: x != "") for c in cells]
    return F.array_distinct(F.concat(*parts))


def strip_salt(name: Column) -> Column:
    """A drug's name without the salt or hydrate and what follows it; unchanged if it has none."""
    return F.trim(F.regexp_replace(F.trim(name), rf"(?i)\s+(?:{'|'.join(SALTS)})\b.*$", ""))


def atc_codes(cell: Column) -> Column:
    """Codes of the substance level in a cell of free text or a JSON list, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(cell, F.lit("")), r'["\[\]]', " "), r"[\s|,;]+"), lambda x: F.upper(x)), lambda x: x.rlike(r"^[A-Z]\d{2}[A-Z]{2}\d{2}$")))


def _variant(kind: str, value: Column, route: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(route).alias("route"))


def _numbered(variants: Column) -> Column:
    return F.transform(F.array_compact(variants), lambda v, i: F.struct(i.alias("pos"), v["kind"].alias("kind"), v["value"].alias("value"), v["route"].alias("route")))


def _bare(name: Column, *others: Column) -> Column:
    """The name without its salt, if that is neither empty nor one of the others."""
    bare = strip_salt(name)
    fresh = reduce(lambda a, o: a & (casefold(bare) != casefold(F.coalesce(F.trim(o), F.lit("")))), [name, *others], bare != "")
    return F.when(fresh, bare)


def catalogue_variants(name: Column, atc: Column) -> Column:
    """What a catalogue's drug is tried as, in order: its name, its codes, its name without the salt."""
    bare = _bare(name)
    codes = F.transform(atc_codes(atc), lambda c: _variant("atc", c, "atc"))
    return _numbered(F.concat(F.array(_variant("name", casefold(F.trim(name)), "name")), codes, F.array(F.when(bare.isNotNull(), _variant("name", casefold(bare), "salt-name")))))


def screened_variants(name: Column, parent: Column) -> Column:
    """A screened compound: its name, its parent's, its name without the salt."""
    other = F.when((F.trim(parent) != "") & (casefold(F.trim(parent)) != casefold(F.trim(name))), F.trim(parent))
    bare = _bare(name, parent)
    return _numbered(F.array(_variant("name", casefold(F.trim(name)), "molename"), F.when(other.isNotNull(), _variant("name", casefold(other), "parent-name")), F.when(bare.isNotNull(), _variant("name", casefold(bare), "salt-name"))))


def substance_variants(name: Column) -> Column:
    """A substance: its name, then without the salt."""
    bare = _bare(name)
    return _numbered(F.array(_variant("name", casefold(F.trim(name)), "substance-name"), F.when(bare.isNotNull(), _variant("name", casefold(bare), "salt-name"))))


def conjugate(name: Column) -> Column:
    """The other protonation state of an -ate or -ic acid, else null."""
    low = F.lower(name)
    return F.when(low.endswith("ate"), F.concat(F.regexp_replace(name, "(?i)ate$", ""), F.lit("ic acid"))).when(low.endswith("ic acid"), F.concat(F.regexp_replace(name, "(?i)ic acid$", ""), F.lit("ate")))


def compound_variants(cell: Column) -> Column:
    """array<struct<pos, kind, value, route>>: spellings of `Compound name (synonym, synonym)` in the order of trust, each once: the head as written, its conjugate, without its stereo
    prefix and that one's conjugate; then the same of each synonym (D27)."""
    cell = F.trim(cell)
    shaped = cell.rlike(r"^.*?\s*\(.*\)\s*$")
    head = F.trim(F.when(shaped, F.regexp_extract(cell, r"^(.*?)\s*\((.*)\)\s*$", 1)).otherwise(cell))
    synonyms = F.when(shaped, F.transform(F.split(F.regexp_extract(cell, r"^(.*?)\s*\((.*)\)\s*$", 2), ","), lambda x: F.trim(x))).otherwise(F.array().cast("array<string>"))

    def expand(base: Column, first: str, prefix: str) -> Column:
        bare = F.regexp_replace(base, STEREO, "")
        other = F.when(bare != base, bare)
        tried = [(base, first), (conjugate(base), f"{prefix}conjugate"), (other, f"{prefix}stereo"), (conjugate(other), f"{prefix}stereo-conjugate")]
        return F.array(*[F.struct(F.lit("name").alias("kind"), casefold(F.trim(x)).alias("value"), F.lit(route).alias("route")) for x, route in tried])

    every = F.concat(expand(head, "exact", ""), F.flatten(F.transform(synonyms, lambda s: expand(s, "synonym", "synonym-"))))
    good = F.filter(every, lambda v: v["value"].isNotNull() & (v["value"] != ""))
    once = F.aggregate(
        good,
        F.array().cast("array<struct<kind:string,value:string,route:string>>"),
        lambda acc, v: F.when(F.exists(acc, lambda a: a["value"] == v["value"]), acc).otherwise(F.array_append(acc, v)),
    )
    return _numbered(once)


def origin_names(paths: Column, root: list[str]) -> Column:
    """Direct children of the source root, sorted and distinct."""
    n = len(root)
    here = F.array(*[F.lit(x) for x in root])
    return F.array_sort(F.array_distinct(F.transform(F.filter(paths, lambda p: (F.size(p) == n + 1) & (F.slice(p, 1, n) == here)), lambda p: p[n])))


def has_origin(paths: Column, prefix: list[str]) -> Column:
    return F.exists(paths, lambda p: F.slice(p, 1, len(prefix)) == F.array(*[F.lit(x) for x in prefix]))


def terms_below(paths: Column, prefix: list[str]) -> Column:
    """Paths strictly below the prefix, the deepest first and then in order."""
    below = F.filter(paths, lambda p: (F.size(p) > len(prefix)) & (F.slice(p, 1, len(prefix)) == F.array(*[F.lit(x) for x in prefix])))
    return F.transform(F.array_sort(F.transform(below, lambda p, i: F.struct((-F.size(p)).alias("n"), i.alias("i"), p.alias("p")))), lambda x: x["p"])


def categories(entries: Column, kind: str) -> Column:
    """Names of a record's categories (array<struct<class, name>>) of a class, in file order."""
    return F.transform(F.filter(entries, lambda e: e["class"] == kind), lambda e: e["name"])


def numeric_key(text: Column) -> Column:
    """A sort key of a numeric string; -1 for others."""
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(-1).cast("bigint"))


def is_a(tags: Column) -> Column:
    """Parents of an ontology term: what stands before the comment mark."""
    return F.transform(F.coalesce(F.try_element_at(tags, F.lit("is_a")), F.array().cast("array<string>")), lambda x: F.trim(F.regexp_replace(x, "!.*$", "")))


def definition_pmids(tags: Column) -> Column:
    """PMIDs cited by a term's definition, distinct in order."""
    text = F.array_join(F.coalesce(F.try_element_at(tags, F.lit("def")), F.array().cast("array<string>")), " ")
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"PMID:\s*(\d+)"), F.lit(1)))


def accessions(components: Column) -> Column:
    """Accessions of a target's components, distinct in order."""
    return F.array_distinct(F.filter(F.transform(components, lambda c: F.trim(c["accession"])), lambda x: x.isNotNull() & (x != "")))


def regulatory_urls(refs: Column) -> Column:
    """URLs of regulators' references, or their ids (X4). refs: array<struct<ref_type, ref_id, ref_url>>."""
    own = F.filter(refs, lambda r: r["ref_type"].isin(*REGULATORY))
    return F.filter(F.transform(own, lambda r: F.coalesce(F.nullif(F.trim(r["ref_url"]), F.lit("")), F.nullif(F.trim(r["ref_id"]), F.lit("")))), lambda x: x.isNotNull())
