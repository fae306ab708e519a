"""A build over small raw files of all thirteen sources: what is loaded, what is refused and why, saved and opened again, served."""

import io
import json
import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from evigraph import api
from evigraph.operators import audit, build, schema
from evigraph.sources import preps, readers

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def column(i):
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def xlsx(path, sheets):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = "".join(f'<c r="{column(k)}{r}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>' for k, v in enumerate(row) if v is not None)
                body += f'<row r="{r}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")


def text(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)


def dump(rows):
    return "".join("\t|\t".join(map(str, r)) + "\t|\n" for r in rows)


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("data"))
    raw = f"{d}/raw"
    taxa = [(1, 1, "no rank", "root"), (2, 1, "domain", "Bacteria"), (561, 2, "genus", "Escherichia"), (562, 561, "species", "Escherichia coli"), (83333, 562, "strain", "Escherichia coli K-12"), (816, 2, "genus", "Bacteroides"), (817, 816, "species", "Bacteroides fragilis"), (33208, 1, "kingdom", "Metazoa"), (7000, 33208, "genus", "Bacteroides")]
    text(f"{raw}/ncbi_taxonomy/nodes.dmp", dump([(i, p, r) for i, p, r, _ in taxa]) + "bad\n")
    text(f"{raw}/ncbi_taxonomy/names.dmp", dump([(i, n, "", "scientific name") for i, _, _, n in taxa] + [(562, "Bacillus coli", "", "synonym"), (562, "E. coli", "", "genbank common name")]))
    text(f"{raw}/ncbi_taxonomy/merged.dmp", dump([(469599, 817)]))
    text(f"{raw}/ncbi_taxonomy/delnodes.dmp", dump([(999,)]))
    text(f"{raw}/mondo/mondo.obo", '[Term]\nid: MONDO:0005011\nname: Crohn disease\nsynonym: "regional enteritis" EXACT []\nxref: EFO:0000384 {source="MONDO:equivalentTo"}\n\n[Term]\nid: MONDO:0005101\nname: ulcerative colitis\n\n')
    head = "BSDB ID,Study,PMID,DOI,Title,Condition,EFO ID,Body site,UBERON ID,Host species,Study design,Sequencing type,Statistical test,Group 0 sample size,Group 1 sample size,Abundance in Group 1,MetaPhlAn taxon names,NCBI Taxonomy IDs"
    rows = [
        'bsdb:1/1/1,Study 1,111,https://doi.org/10.1/A,A title,Crohn disease,EFO:0000384,Feces,UBERON:0001988,Homo sapiens,case-control,16S,t-test,10,12,increased,"k__B|s__Escherichia coli,k__B|s__Bacteroides fragilis",2|83333;2|469599',
        "bsdb:2/1/1,Study 2,NA,NA,#2,Ulcerative Colitis,MONDO:0005101,Feces,NA,Mus musculus,laboratory experiment,WMS,NA,3,4,decreased,k__B|s__Nothing known,",
        "bsdb:3/1/1,Study 3,113,NA,C,Crohn disease,EFO:0000384,Feces,NA,Homo sapiens,meta-analysis,16S,NA,3,4,decreased,k__B|x,2|999",
    ]
    text(f"{raw}/bugsigdb/full_dump_main.csv", "# licence: open, see the site\n" + head + "\n" + "\n".join(rows) + "\n")
    model = lambda acc, name, tax: {"ARO_accession": acc, "ARO_name": name, "model_type": "protein homolog model", "ARO_category": {"1": {"category_aro_accession": "3000007", "category_aro_name": "beta-lactam", "category_aro_class_name": "Drug Class"}, "2": {"category_aro_accession": "0001004", "category_aro_name": "inactivation", "category_aro_class_name": "Resistance Mechanism"}}, **({"model_sequences": {"sequence": {"9": {"NCBI_taxonomy": {"NCBI_taxonomy_id": tax, "NCBI_taxonomy_name": "x"}}}}} if tax else {})}
    text(f"{raw}/card/card-data/card.json", json.dumps({"_version": "1", "10": model("3000001", "geneA", "83333"), "11": model("3000002", "geneB", None)}))
    text(f"{raw}/card/card-data/aro_index.tsv", "ARO Accession\tModel ID\nARO:3000001\t10\n")
    text(f"{raw}/card/card-data/PMID.tsv", "ARO Accession\tPMID\nARO:3000001\t1;2\n")
    text(f"{raw}/card/card-ontology/aro.obo", '[Term]\nid: ARO:3000001\nname: geneA\ndef: "x" [PMID:7]\nis_a: ARO:3000000 ! root\nrelationship: confers_resistance_to_drug_class ARO:3000007 ! beta\n\n')
    for book, tax in (("human", "562"), ("mouse", "817")):
        xlsx(f"{raw}/gutmdisorder/{book}.xlsx", {
            "Literature": [["Index", "PMID", "Research Type"], ["1", "222", "Observation"]], "Sample": [["Index", "Sequencing Technology", "Sample Size"], ["1", "16S rRNA sequences", "5"], ["1.0000000001", "qPCR", "7"]],
            "Association": [["Index", "Gut Microbiota", "Gut Microbiata NCBI ID", "Alteration", "Disorder Name", "DOID", "Intervention"], ["1", "any", tax, "increase", "Crohn disease (CD)", None, "Metformin"], ["1", "any", tax, "increase", "Crohn disease (CD)", None, "Metformin"], ["1.5", "any", tax, "increase", "x", None, None]],
        })
    node = lambda t, below="": f"<descendant><term>{t}</term>{f'<descendants>{below}</descendants>' if below else ''}</descendant>"
    tree = "<root><term>Disposition</term><descendants>" + node("Source", node("Biological", node("Microbe", node("Escherichia", node("Escherichia coli")) + node("Bacteroides")))) + "</descendants></root>"
    text(f"{raw}/hmdb/hmdb_metabolites.xml", '<?xml version="1.0"?><hmdb xmlns="http://www.hmdb.ca">' + f"<metabolite><accession>HMDB0000039</accession><secondary_accessions><accession>HMDB00039</accession></secondary_accessions><name>Butyric acid</name><status>quantified</status><chebi_id>30772</chebi_id><kegg_id>C00246</kegg_id><inchikey>K1</inchikey><ontology>{tree}</ontology></metabolite>" + "<metabolite><accession>HMDB0000001</accession><name>Other</name><status>expected</status></metabolite></hmdb>")
    text(f"{raw}/chembl/mechanism.jsonl", "\n".join(json.dumps(x) for x in [{"mec_id": 1, "molecule_chembl_id": "C2", "parent_molecule_chembl_id": "C1", "target_chembl_id": "T1", "action_type": "INHIBITOR", "max_phase": "4", "mechanism_refs": [{"ref_type": "DailyMed", "ref_id": "x", "ref_url": "http://d"}, {"ref_type": "PubMed", "ref_id": "5"}]}]))
    text(f"{raw}/chembl/molecule_max_phase4.jsonl", "\n".join(json.dumps(x) for x in [{"molecule_chembl_id": "C1", "pref_name": "METFORMIN", "max_phase": "4.0", "atc_classifications": ["A10BA02"]}, {"molecule_chembl_id": "C2", "pref_name": "METFORMIN HYDROCHLORIDE", "max_phase": "4.0"}]))
    text(f"{raw}/chembl/target.jsonl", json.dumps({"target_chembl_id": "T1", "pref_name": "target", "organism": "Escherichia coli", "tax_id": 562, "target_components": [{"accession": "P1"}, {"accession": "P1"}]}))
    b = f"{raw}/drug_screens/maier2018/NIHMS76168-supplement-Supplementary_table_"
    xlsx(f"{b}1.xlsx", {"S1": [["prestwick_ID", "ATC codes"], ["Prestw-1", "A10BA02"], ["Prestw-2", "-"]]})
    xlsx(f"{b}2.xlsx", {"S2": [["NT_code", "species"], ["NT5001", "Escherichia coli"], ["NT5002", "Bacteroides fragilis enterotoxigenic (ET)"]]})
    xlsx(f"{b}3.xlsx", {"S3": [["prestwick_ID", "chemical_name", "drug_class", "n_hit", "Escherichia coli (NT5001)", "Bacteroides fragilis (NT5002)"], ["Prestw-1", "Metformin hydrochloride X", "human", "1", "0.001", "0.5"], ["Prestw-2", "Unknown drug", "human", "0", "NA", "0.2"]]})
    xlsx(f"{b}4.xlsx", {"S4": [["x"]]})
    xlsx(f"{raw}/drug_screens/zimmermann2019/41586_2019_1291_MOESM1_ESM.xlsx", {
        "Supplementary Table 1": [["Species", "Reference"], ["Escherichia coli", "K12"]], "Supplementary Table 2": [["title"], ["MOLENAME", "name"], ["METFORMIN HYDROCHLORIDE", "Metformin"]],
        "Supplementary Table 3": [["a title"], ["DrugName", "Threshold", "Escherichia coli K12", None, None, None, None, "Control pH 4"], ["", "", "consumed", "sd", "p", "fdr", "n"], ["METFORMIN HYDROCHLORIDE", "20", "50", "1", "0.01", "0.01", "3", "9", "1", "1", "0.01", "3"]],
    })
    m = f"{raw}/masi/MASI_v1.0_download_"
    xlsx(f"{m}microbeSubstanceInteractionRecords_ver20200928.xlsx", {"S": [["Interation_Record_ID", "Microbe-ID", "Microbe-Name", "Microbe-Tax-ID", "Substance_id", "Interaction_Category", "Microbe_Change", "Metabolism_Effect_on_Drug", "Experiment_System", "Experiment_Model_Species", "Reference_ID_Type", "Reference_ID"], ["R1", "M1", "x", "n.a.", "PMDBD1", "Substances alter microbe abundance", "Increase", "n.a.", "In vivo", "Rat", "PMID", "PMID: 9"], ["R2", "M1", "x", "562", "PMDBD1", "Microbes metabolize substances", "n.a.", "Microbe does not metabolize drug", "In vitro", "n.a.", "PMID", "8"], ["R3", "M1", "x", "562", "PMDBD1", "Substances alter microbe abundance", "delay", "n.a.", "n.a.", "n.a.", "PMID", "8"]]})
    xlsx(f"{m}microbeDiseaseAssociationRecords.xlsx", {"S": [["Association-record-ID", "Microbe-name", "Microbe-Tax-ID", "Disease-name", "MASI-Disease-ID", "Change-of-microbe"], ["A1", "x", "562", "Crohn disease(CD)", "DIS1", "Increase"], ["A2", "x", "562", "strange", "DIS2", "Decrease"]]})
    xlsx(f"{m}microbesInfo.xlsx", {"S": [["microbe_id", "microbe_tax_id", "genus_id"], ["M1", "817", "816"]]})
    xlsx(f"{m}substanceInfo.xlsx", {"S": [["Substance_id", "Substance_name", "Substance_subcategory"], ["PMDBD1", "Metformin", "Compound"], ["PMDBD2", "Statins", "Drug Class"]]})
    text(f"{raw}/mimedb/v2/mimedb_metabolites_v2.csv", "mime_id,name,hmdb_id,moldb_inchikey,moldb_formula\nMM1,Butanoate,HMDB00039,K9,C4\nMM2,butyric ACID,NULL,NULL,C4\nMM3,Novelol,NULL,K3,C5\nMM4,novelol,NULL,K4,C5\n")
    text(f"{raw}/mimedb/v2/mimedb_microbes_v2.csv", "name,ncbi_tax_id\nEscherichia coli,562\nnone,NULL\n")
    xlsx(f"{raw}/njc19/41597_2020_516_MOESM1_ESM.xlsx", {"Online-only Table 5": [["legend"], ["Species", "Compound", "Metabolic activity", "Ref. #"], ["Escherichia coli", "Butyrate", "Consumption (import), Production (export)", "import:1;export:2(G)"], ["Bacteroides fragilis", "Mucin (mucus)", "Macromolecule degradation (-)", "3"], ["human goblet cell", "Mucin", "Production (export)", "4"]]})
    text(f"{raw}/reactome/ReactomePathways.txt", "R-1\tOne\tHomo sapiens\nR-2\tTwo\tHomo sapiens\n")
    text(f"{raw}/reactome/ReactomePathwaysRelation.txt", "R-1\tR-2\nR-9\tR-2\n")
    text(f"{raw}/reactome/ChEBI2Reactome.txt", "30772\tR-1\thttp\tOne\tTAS\tHomo sapiens\n30772\tR-7\thttp\tSeven\tIEA\tHomo sapiens\n1\tR-1\thttp\tOne\tTAS\tHomo sapiens\n")
    text(f"{raw}/kegg/list_pathway.tsv", "map1\tButanoate\n")
    text(f"{raw}/kegg/link_compound_pathway.tsv", "path:map1\tcpd:C00246\npath:map9\tcpd:C00246\n")
    text(f"{raw}/kegg/list_compound.tsv", "C00246\tx\n")
    text(f"{raw}/hmdad/data_download.txt", "Disease\tMicrobe\tPosition\tEvidence\tPMID\nCrohn disease(CD)\tEscherichia coli\tgut\tIncrease\t1\nstrange\tEscherichia coli\tgut\tDecrease\t1\n")
    return d


@pytest.fixture(scope="module")
def result(spark, data):
    return api.build(spark, data, with_kegg=True)


def rows(result, name, *columns):
    return sorted(map(tuple, result.frames.rows(name).select(*columns).collect()), key=str)


def test_every_source_is_loaded(result):
    assert result.skipped == {} and sorted(result.loaded) == sorted(s.name for s in preps.SOURCES) and result.loaded[-1] == "taxonomy"
    assert rows(result, "taxon_signature", "signature_id", "tax_id", "resolution_status") == [("bsdb:1/1/1", "562", "promoted"), ("bsdb:1/1/1", "817", "merged")]
    assert rows(result, "unresolved_taxa", "unresolved_id", "status", "n_signatures") == [("unresolved:bugsigdb:999", "deleted", "1"), ("unresolved:bugsigdb:Nothing known", "unresolved", "1")]
    assert rows(result, "signature", "signature_id", "evidence_level") == [("bsdb:1/1/1", "observational-16S"), ("bsdb:2/1/1", "in-vivo-model"), ("bsdb:3/1/1", "meta-analysis")]
    assert {x[0] for x in rows(result, "disease", "condition_id")} == {"MONDO:0005011", "MONDO:0005101", "MASI:DIS2"}
    assert rows(result, "resistance_gene", "aro_id", "n_publications", "curated") == [("ARO:3000001", "3", "true"), ("ARO:3000002", "0", "false")]
    assert rows(result, "resistance_gene_drug_class", "aro_id", "evidence_level", "source_licence") == [("ARO:3000001", "in-vitro", "CC-BY-4.0"), ("ARO:3000002", "computational-predicted", "CARD-noncommercial")]
    assert rows(result, "taxon_resistance_gene", "tax_id", "taxon_specificity") == [("562", "species-or-below")]
    gut = [x for x in rows(result, "taxon_condition", "tax_id", "condition_id", "primary_source", "evidence_level", "duplicate_rows") if x[2] == "gutmdisorder"]
    assert gut == [("562", "MONDO:0005011", "gutmdisorder", "observational-16S", "2"), ("817", "MONDO:0005011", "gutmdisorder", "in-vivo-model", "2")]
    assert rows(result, "taxon_metabolite", "tax_id", "metabolite_id", "primary_source") == [("562", "CHEBI:30772", "hmdb"), ("562", "CHEBI:30772", "njc19"), ("816", "CHEBI:30772", "hmdb")]
    assert rows(result, "drug", "drug_id", "source") == [("CHEMBL:C1", "chembl"), ("PRESTWICK:Prestw-2", "maier2018")]
    assert rows(result, "intervention_drug", "intervention_id", "drug_id") == [("INTERVENTION:metformin", "CHEMBL:C1")]
    assert rows(result, "drug_taxon_inhibited", "drug_id", "tax_id", "drug_join") == [("CHEMBL:C1", "562", "atc")]
    assert rows(result, "drug_taxon_no_effect", "drug_id", "tax_id") == [("CHEMBL:C1", "817"), ("PRESTWICK:Prestw-2", "817")]
    assert rows(result, "metabolite", "metabolite_id", "source") == [("CHEBI:30772", "hmdb"), ("MIMEDB:MM3", "mimedb"), ("NJC19:mucin-mucus", "njc19")]
    assert rows(result, "taxon_metabolite_absent", "tax_id", "source_relation") == [("817", "DEGRADES")]
    assert rows(result, "taxon_substance_changed", "tax_id", "direction", "taxon_id_route", "pmid") == [("817", "increased", "dictionary", "9")]
    assert len(rows(result, "taxon_substance_not_metabolised", "tax_id")) == 1
    assert rows(result, "substance", "substance_id", "drug_id") == [("MASI:PMDBD1", "CHEMBL:C1"), ("MASI:PMDBD2", None)]
    assert rows(result, "pathway", "pathway_id", "minted") == [("KEGG:map1", "false"), ("REACT:R-1", "false"), ("REACT:R-2", "false"), ("REACT:R-7", "true")]
    assert rows(result, "metabolite_pathway", "pathway_id", "evidence_level") == [("KEGG:map1", "unknown"), ("REACT:R-1", "unknown"), ("REACT:R-7", "computational-predicted")]
    assert rows(result, "unresolved_pathway_links", "source_id", "rows") == [("CHEBI:1", "1")]
    assert rows(result, "taxon_drug_metabolised", "tax_id", "drug_id", "drug_join") == [("562", "CHEMBL:C1", "parent-name")]
    assert {x[0] for x in rows(result, "taxon", "tax_id")} == {"1", "2", "561", "562", "816", "817"}
    assert {r["source"] for r in result.frames.rows("ledger").collect()} >= {"bugsigdb", "gutmdisorder", "maier2018", "masi", "reactome", "kegg", "mimedb"}


def test_graph_report_and_files(spark, result, data):
    counts = {(r["what"], r["name"]): r["n"] for r in result.report["counts"].collect()}
    assert counts["node", "Taxon"] == 6 and counts["edge", "ASSOCIATED_WITH"] == result.frames.rows("taxon_condition").count()
    assert all(result.graph.dangling(k).count() == 0 for k in result.graph.edges)
    g, about = build.opened(spark, result.out)
    assert about["skipped"] == {} and about["rows"]["taxon"] == 6 and g.counts().count() == result.report["counts"].count()
    assert "ASSOCIATED_WITH.required_properties" in build.printed(result.report)
    assert g.scan("Condition").count() == result.frames.rows("disease").count()
    scored = api.coverage(spark, data, "hmdad", g)
    assert json.loads(build.to_json(scored))["counts"] == [{"n_references": 2, "n_resolvable": 1, "n_covered": 1}]
    assert "hmdad: 2 claims, 1 resolvable" in audit.score_text("hmdad", scored)
    hits = result.indexes.search_text("Taxon", "name", "coli", 5).collect()
    assert [r["doc"] for r in hits] == [562]


def test_agent(spark, result):
    agent = api.Agent(spark, result.graph)
    say = lambda method, **p: json.loads(agent.answer(json.dumps({"jsonrpc": "2.0", "id": 1, "method": method, "params": p})))
    assert [t["name"] for t in say("tools/list")["result"]["tools"]] == ["sql_query", "graph_overview"]
    got = say("tools/call", name="sql_query", arguments={"sql": "SELECT id FROM node_Taxon WHERE name = :n", "args": {"n": "Escherichia coli"}})
    assert json.loads(got["result"]["content"][0]["text"]) == {"rows": [{"id": 562}]}
    long = json.loads(say("tools/call", name="sql_query", arguments={"sql": "SELECT explode(sequence(1, 40)) AS x"})["result"]["content"][0]["text"])
    assert len(long["rows"]) == 15 and long["total"] == 40 and long["more"]["arguments"]["offset"] == 15
    agent = api.Agent(spark, result.graph, [audit.Rule("ASSOCIATED_WITH", ("direction",))])
    asked = json.loads(say("tools/call", name="sql_query", arguments={"sql": "SELECT rule, total FROM ontology_audit(level => 'warn')"})["result"]["content"][0]["text"])
    assert asked["rows"] == [{"rule": "ASSOCIATED_WITH.required_properties", "total": result.graph.edges["ASSOCIATED_WITH"].count()}]
    assert "only one statement" in say("tools/call", name="sql_query", arguments={"sql": "DROP VIEW node_Taxon"})["error"]["message"]
    assert say("nothing")["error"]["code"] == -32601 and agent.answer(json.dumps({"method": "x"})) is None
    over = json.loads(say("tools/call", name="graph_overview", arguments={})["result"]["content"][0]["text"])
    assert {"what": "node", "name": "Taxon", "n": 6} in over["rows"]


def test_missing_and_malformed_inputs_are_skips(spark, tmp_path, data):
    got = build.build(spark, f"{tmp_path}/raw", preps.SOURCES, preps.DOCUMENT)
    assert got.graph is None and got.loaded == [] and got.skipped["kegg"].startswith("licence") and got.skipped["hmdb"] == "no hmdb/hmdb_metabolites.xml"
    with pytest.raises(readers.MalformedInput):
        readers.reproduces(spark.range(1).select("id", F.lit(2).alias("n")), spark.range(1).select("id", F.lit(3).alias("n")), "id", "n")
    strict = [audit.Rule("ASSOCIATED_WITH", ("no_such",), "error")]
    with pytest.raises(Exception):
        build.build(spark, f"{data}/raw", [s for s in preps.SOURCES if s.name in ("masi", "taxonomy")], preps.DOCUMENT, strict)


def test_a_source_that_fails_late_is_taken_back(spark, data):
    """Rows that cannot be read surface when a table is written: the source goes with all it wrote, the others stay."""

    def late(spark, raw, frames):
        frames.put("taxon", spark.createDataFrame([("999",)], "tax_id string"), ["tax_id"])
        frames.put("extra", spark.createDataFrame([("1",)], "x string"))
        frames.put("extra", spark.range(3).select(F.raise_error(F.lit("a malformed row")).cast("string").alias("x")))

    taxonomy = next(s for s in preps.SOURCES if s.name == "taxonomy")
    got = build.build(spark, f"{data}/raw", [taxonomy, build.Source("late", (), ("taxonomy",), late)], preps.DOCUMENT)
    assert got.loaded == ["taxonomy"] and "malformed row" in got.skipped["late"]
    assert "extra" not in got.frames.names() and "999" not in {r["tax_id"] for r in got.frames.rows("taxon").collect()}


def test_status_and_command_line(data, tmp_path):
    found = api.prepare(data)
    assert found["hmdb"]["state"] == "present" and found["taxonomy"]["state"] == "present"
    text(f"{data}/raw/manifest.json", json.dumps({"hmdb/hmdb_metabolites.xml": {"bytes": 1}}))
    assert api.status(data)["hmdb"]["state"] == "stale"
    os.remove(f"{data}/raw/manifest.json")
    out = io.StringIO()
    assert api.main(["status", "--data", str(tmp_path), "--create"], stdout=out) == 0 and "hmdb: absent, 0 of 1 files" in out.getvalue()
    assert api.main(["fetch", "--data", str(tmp_path), "--only", "hmdb"], stdout=(out := io.StringIO())) == 1 and out.getvalue().strip() == "hmdb/hmdb_metabolites.xml"
    with pytest.raises(ValueError):
        api.fetch(data, ["nobody"])


def test_schema_helpers():
    assert schema.declared_order({"b": "DEPENDS_ON: list[str] = ['a']\n", "a": "import nothing_here\nDEPENDS_ON = []\n"}) == ["a", "b"]
    with pytest.raises(schema.OrderError):
        schema.declared_order({"a": "x = 1"})
    assert schema.included({"a": ["t"], "k": ["t"], "n": ["u"]}, ["t"], gated=["k"]) == ["a"]
    assert schema.relationships(preps.DOCUMENT)["IS_DRUG"] == {"tables": ["intervention_drug"], "source": "Intervention", "target": "Drug"}
    assert schema.checked({"nodes": {"A": {"properties": {"x": "odd"}}}, "edges": {"E": {"source": "A", "target": "B"}}}) == ["E: target 'B' is no declared node", "A.x: unknown type 'odd'"]


def test_term_paths_and_flags(spark):
    node = lambda t, *below: f"<descendant><term>{t}</term><level>1</level>" + (f"<descendants>{''.join(below)}</descendants>" if below else "<descendants/>") + "</descendant>"
    inner = node("d40")
    for i in range(39, 0, -1):
        inner = node(f"d{i}", inner, node(f"s{i}"))
    whole = f"<root><term>a & b < c</term><descendants>{node('b', node('c'))}{node('d')}</descendants></root><root><term>r</term><descendants>{inner}</descendants></root><root><term/></root>"
    got = spark.createDataFrame([(whole,), (None,), ("",)], "x string").select(readers.tree_paths(F.col("x")).alias("p")).collect()
    first = got[0][0]
    assert first[:4] == [["a & b < c"], ["a & b < c", "b"], ["a & b < c", "b", "c"], ["a & b < c", "d"]] and got[1][0] == got[2][0] == []
    assert first[4:][:41] == [["r", *[f"d{k}" for k in range(1, i + 1)]] for i in range(41)] and ["r", *[f"d{k}" for k in range(1, 40)], "s39"] in first and len(first) == 4 + 1 + 40 + 39
    genes = spark.createDataFrame([("g1", "1", "0", "1"), ("g2", "0", "0", "1")], "gene string, A string, B string, M string")
    got = readers.flagged_columns(genes, "gene", {"A": "Parent drug", "B": "Parent drug", "M": "mass"}, "Parent drug")
    assert {r["gene"]: r["labels"] for r in got.collect()} == {"g1": ["A"], "g2": []}
