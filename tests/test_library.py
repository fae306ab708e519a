"""Operators of the evidence graph on hand-made rows; the golden cases are made up in the shape of the real ones."""

import math
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from evigraph.operators import audit, classify, reconcile, schema, search, tables, trees
from evigraph.operators.graph import Graph, closure, shortest_path, variable_length
from evigraph.sources import readers


def column(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_strip_authority(spark):
    names = ['Genus alpha (Hall and Tool 1935) Prev 1938', '"Genus beta" Yu and Gal 2013', "Genus gamma K-12", "[Genus] delta", "Genus epsilon Orla-Jensen 1919", "Genus zeta subsp. minor Smith et al. 1901", "Genus 1999"]
    assert column(spark, reconcile.strip_authority, *names) == ["Genus alpha", "Genus beta", "Genus gamma K-12", "[Genus] delta", "Genus epsilon", "Genus zeta subsp. minor", "Genus"]


def test_placeholder_and_fold(spark):
    assert column(spark, reconcile.is_placeholder, "uncultured thing", "Genus sp.", "Genus sp. X1", "Candidatus Foo", "[Foo] bar", "Genus species", "", None) == [True] * 5 + [False] * 3
    assert column(spark, reconcile.casefold, "Biﬁdo", "STRAßE") == ["bifido", "strasse"]


@pytest.fixture(scope="module")
def taxonomy(spark):
    nodes = spark.createDataFrame(
        [(1, 1, "no rank"), (2, 1, "domain"), (9, 2, "family"), (10, 9, "genus"), (11, 10, "species"), (12, 11, "strain"), (13, 11, "no rank"), (14, 9, "no rank"), (15, 13, "clade"), (20, 1, "kingdom"), (21, 20, "genus")],
        "tax_id long, parent_id long, rank string",
    )
    names = spark.createDataFrame(
        [(11, "Genus alpha", "scientific name"), (11, "Oldus alpha (Hall 1935)", "synonym"), (10, "Twin", "scientific name"), (21, "Twin", "scientific name"), (12, "Genus alpha K", "scientific name"), (9, "Famil", "authority"), (13, "Oldus alpha", "type material")],
        "tax_id long, name string, name_class string",
    )
    merged = spark.createDataFrame([(90, 91), (91, 11), (70, 71), (71, 70)], "old_id long, new_id long")
    deleted = spark.createDataFrame([(80,)], "tax_id long")
    return names, nodes, merged, deleted


def test_resolve(spark, taxonomy):
    asked = spark.createDataFrame([("genus ALPHA", None), ("Oldus alpha", None), ("Twin", None), ("Genus alpha K", None), (None, 90), ("Twin", 11), ("x", 80), ("x", 999), ("Famil", None), (None, 14)], "name string, given_id long")
    got = {(r.name, r.given_id): r for r in reconcile.resolve(asked, *taxonomy).collect()}
    want = {
        ("genus ALPHA", None): (11, "exact"), ("Oldus alpha", None): (11, "synonym"), ("Twin", None): (None, "ambiguous"), ("Genus alpha K", None): (11, "promoted"), (None, 90): (11, "merged"),
        ("Twin", 11): (11, "exact"), ("x", 80): (None, "deleted"), ("x", 999): (None, "unresolved"), ("Famil", None): (None, "unresolved"), (None, 14): (14, "exact"),
    }
    assert {k: (r.tax_id, r.status) for k, r in got.items()} == want
    assert got["Twin", None].candidates == [10, 21] and got["Oldus alpha", None].normalized and "90 -> 11" in got[None, 90].note


def test_promotion_scope_and_roots(spark, taxonomy):
    _, nodes, *_ = taxonomy
    up = {r.tax_id: r.promoted_id for r in reconcile.promotions(nodes).collect()}
    assert up[12] == 11 and up[13] == 11 and up[15] == 11 and up[14] == 14 and up[10] == 10
    cited = spark.createDataFrame([(21,)], "tax_id long")
    assert {r.tax_id for r in reconcile.scope(nodes, cited, [10]).collect()} == {10, 11, 12, 13, 15, 9, 2, 1, 21, 20}
    lines = trees.labelled(nodes.select(F.col("tax_id").alias("child"), F.col("parent_id").alias("parent")))
    both = spark.createDataFrame([("twin", 10), ("twin", 21), ("amb", 11), ("amb", 10)], "key string, tax_id long")
    assert [tuple(r) for r in reconcile.one_under(both, lines, [2]).collect()] == [("twin", 10)]


def test_pairing(spark):
    cells = spark.createDataFrame([(1, "Flu,Cold", "A:1,A:2"), (2, "Fever, high, Cold", "A:3,A:2"), (3, "Pain, back, low", "A:4"), (4, "X,Y,Z", "A:2,A:9")], "k int, l string, i string")
    names = spark.createDataFrame([("A:3", "fever, high"), ("A:2", "Cold")], "id string, name string")
    got = sorted((r.k, r.label, r.id or "", r.method) for r in reconcile.pair_conditions(cells, "k", "l", "i", names).collect())
    assert got == [
        (1, "Cold", "A:2", "zip"), (1, "Flu", "A:1", "zip"), (2, "Cold", "A:2", "name run"), (2, "Fever, high", "A:3", "name run"), (3, "Pain, back, low", "A:4", "whole cell"),
        (4, "X", "", "unpaired"), (4, "Y", "", "unpaired"), (4, "Z", "", "unpaired"),
    ]


def test_routes_paths_and_chains(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    asked = spark.createDataFrame([(1, [(0, "name", "a"), (1, "code", "b")]), (2, [(1, "code", "b")]), (3, [])], "k int, v array<struct<pos:int,kind:string,value:string>>")
    index = spark.createDataFrame([("name", "a", "T1"), ("code", "b", "T2")], "kind string, value string, target string")
    got = {r.k: (r.target, r.route, r.also) for r in reconcile.route_join(asked, "k", "v", index).collect()}
    assert got[1] == ("T1", "name", ["T2"]) and got[2] == ("T2", "code", []) and got[3][:2] == (None, "minted")
    paths = spark.createDataFrame([(1, ["a"]), (1, ["a", "b"]), (1, ["c"]), (2, ["a"])], "g int, p array<string>")
    assert sorted((r.g, *r.p) for r in reconcile.deepest_paths(paths, "g", "p").collect()) == [(1, "a", "b"), (1, "c"), (2, "a")]
    rows = spark.createDataFrame([(1, "n", "K1"), (2, "n", "K2"), (3, "m", "K2"), (4, "m", None), (5, None, "K2")], "seq int, name string, code string")
    assert {r.seq for r in reconcile.two_key_first_wins(rows, "seq", "name", "code").collect()} == {1, 3}
    assert column(spark, lambda x: reconcile.curie_route(x, {"MONDO": "Disease", "HP": "Phenotype"}), "MONDO:1", "mondo_2", "HP:3", "EFO:4", "broken") == ["Disease", "Disease", "Phenotype", None, None]


def test_tables(spark):
    rows = spark.createDataFrame([("a", "1", 2), ("a", "3", 1), ("", "9", 0), ("b", "x", 5)], "k string, v string, seq int")
    assert sorted(map(tuple, tables.first_wins(rows, ["k"], ["seq"]).collect())) == [("a", "3", 1), ("b", "x", 5)]
    assert {(r.k, r.v) for r in tables.sum_on_duplicate(rows, ["k"], ["v"], ["seq"]).collect()} == {("a", 4), ("b", None)}
    assert tables.absorb(rows.select("k"), rows.select("v")).columns == ["k", "_src_rank", "v"]
    coded = spark.createDataFrame([(1, ["x"]), (2, []), (3, None)], "i int, l array<string>").select("i", tables.encode_list(F.col("l")).alias("t"))
    assert [r.t for r in coded.orderBy("i").collect()] == ['["x"]', None, None]
    assert column(spark, tables.decode_list, '["a","b"]', "raw", "", None) == [["a", "b"], ["raw"], None, None]
    typed = tables.typed(spark.createDataFrame([("1", "", "true", "q"), ("-2", "x", "", "")], "n string, s string, f string, l string"), {"f": "bool", "l": "list"})
    assert typed.dtypes == [("n", "bigint"), ("s", "string"), ("f", "boolean"), ("l", "array<string>")]
    assert [tuple(r) for r in typed.collect()] == [(1, None, True, ["q"]), (-2, "x", None, None)]


def test_parallel_edges_survive_any_partitioning(spark):
    for parts in (1, 3, 7):
        e = spark.createDataFrame([("A1", "B1", 100 + i) for i in range(10)], "s string, d string, pmid int").repartition(parts)
        g = Graph().add_nodes("A", spark.createDataFrame([("A1",)], "k string"), "k").add_nodes("B", spark.createDataFrame([("B1",)], "k string"), "k").add_edges("R", e, "s", "d", "A", "B")
        assert g.identified("R").select(F.count_distinct("edge_id")).first()[0] == 10
        assert sorted(r.R_pmid for r in g.hop(g.nodes["A"], "R", "id", "b").collect()) == list(range(100, 110))
        assert g.dangling("R").count() == 0 and g.slim_edges(undirected=True).count() == 20


def test_walks(spark):
    e = spark.createDataFrame([(1, "a", "b"), (2, "b", "c"), (3, "c", "a"), (4, "a", "b")], "edge_id long, src string, dst string")
    starts = spark.createDataFrame([("a",)], "id string")
    got = sorted((r.node, r.hops) for r in variable_length(e, starts, 1, 3).collect())
    assert got == [("a", 3), ("a", 3), ("b", 1), ("b", 1), ("c", 2), ("c", 2)]
    assert [tuple(r) for r in shortest_path(e, "b", "c").collect()] == [(1, ["b", "c"])]
    assert shortest_path(e, "a", "zz").count() == 0
    loops = spark.createDataFrame([("x", "x"), ("p", "q"), ("q", "p"), ("q", "r")], "child string, parent string")
    assert {(r.node, r.ancestor, r.depth) for r in closure(loops).collect()} >= {("p", "q", 1), ("p", "r", 2), ("q", "r", 1)}


def test_chargrams(spark):
    texts = ["Bacillus coli", "x", "", "a-b_c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.doc: r.vec for r in search.chargram_vectors(df, "i", "t").collect()}
    for i, text in enumerate(texts):
        norm = " " + " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()) + " "
        slots = [0] * 256
        for n in (3, 4, 5):
            for k in range(len(norm) - n + 1):
                h = zlib.crc32(norm[k : k + n].encode())
                slots[h % 256] += 1 if h & 65536 else -1
        v = [math.copysign(1 + math.log(abs(c)), c) if c else 0.0 for c in slots]
        size = math.sqrt(sum(x * x for x in v)) or 1.0
        assert all(math.isclose(a, b / size, abs_tol=1e-12) for a, b in zip(got[i], v, strict=True)), text


def test_audit_gate(spark):
    df = spark.createDataFrame([(1, "a", "5"), (2, None, "x")], "id int, p string, q string")
    report = audit.audit(df, audit.Rule("R", ("p",), "error", (("q", "bigint"),)))
    assert {(r.rule, r.violations, r.total) for r in report.collect()} == {("R.required_properties", 1, 2), ("R.type_q", 1, 2)}
    with pytest.raises(audit.AuditError):
        audit.gate(report)
    assert audit.audit(df.limit(0), audit.Rule("R", ("p",))).count() == 0


def test_measures_taken_in_the_write(spark):
    """One pass writes the rows and gives the report that audit() takes from them."""
    from evigraph.operators.graph import cut

    df = spark.createDataFrame([(1, "a", "5", None), (2, None, "x", None), (3, "c", None, None)], "id int, p string, q string, z void")
    rules = [audit.Rule("R", ("p", "q"), "warn", (("q", "bigint"),)), audit.Rule("R.more", ("z",), "error")]
    taken = {}
    got = cut(df, audit.measures(rules), taken)
    assert got.count() == taken["rows"] == 3 and dict(got.dtypes)["z"] == "string"
    want = audit.audit(df, rules[0]).unionByName(audit.audit(df, rules[1]))
    assert sorted(map(tuple, audit.measured_audit(spark, rules, {"R": taken}).collect())) == sorted(map(tuple, want.collect()))
    none = {}
    cut(df.limit(0), audit.measures(rules), none)
    assert audit.measured_audit(spark, rules, {"R": none}) is None


def test_schema():
    a = {"nodes": {"T": {"table": "t", "properties": {"x": "int"}}}, "list": [1], "_note": "a"}
    b = {"nodes": {"T": {"properties": {"y": "list"}}, "U": {"table": "u"}}, "list": [2, 1]}
    one = schema.compose({"a": a, "b": b})
    assert one["list"] == [1, 2] and "_note" not in one and schema.declared_types(one)["t"] == {"x": "int", "y": "list"}
    assert list(schema.prune(one, ["t"])["nodes"]) == ["T"] and not schema.drifted(one, schema.emit(one))
    with pytest.raises(schema.FragmentConflict, match="a.*b"):
        schema.compose({"a": a, "b": {"nodes": {"T": {"table": "v"}}}})
    assert schema.order_sources({"c": ["a"], "b": [], "a": []}) == ["a", "b", "c"]
    for bad in ({"a": ["b"], "b": ["a"]}, {"a": ["zz"]}):
        with pytest.raises(schema.OrderError):
            schema.order_sources(bad)


def test_classify(spark):
    assert column(spark, classify.slug, "A  b/C!", None) == ["a-b-c", None]
    assert column(spark, classify.doi, "https://doi.org/10.1/AB", "doi: 10.2/x", "") == ["10.1/ab", "10.2/x", None]
    assert column(spark, lambda x: classify.null_words(x, "NA"), " NA ", "", "v") == [None, None, "v"]
    assert column(spark, lambda x: classify.whole_index(x.cast("double")), "3.0000000001", "2.5", "-1") == [3, None, -1]
    assert column(spark, lambda x: classify.hit(x.try_cast("double"), 0.01), "0.001", "0.5", "NA") == [True, False, None]
    assert column(spark, classify.conjugate, "butyrate", "lactic acid", "water") == ["butyric acid", "lactate", None]
    assert column(spark, classify.atc_level5, "A10BA02 x B01AC06 A10BA02") == [["A10BA02", "B01AC06"]]
    assert column(spark, lambda x: classify.capped(classify.split_ids(x), 1)["n"], "1, 2;2") == [2]


def test_readers(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n\n2\t|\t1\t|\tdomain \t|\nbad\t|\n")
    df = readers.whole_numbers(readers.dump(spark, str(tmp_path / "nodes.dmp"), ["tax_id", "parent", "rank"]), "tax_id")
    assert [tuple(r) for r in df.orderBy("tax_id").collect()] == [(1, "1", "no rank"), (2, "1", "domain")]
    (tmp_path / "x.obo").write_text('format-version: 1\n\n[Term]\nid: M:1\nname: flu\nsynonym: "grippe" EXACT [x]\nsynonym: "cold" RELATED []\nxref: D:9 {source="M:equivalentTo"}\n\n[Term]\nid: M:2\nname: old\nis_obsolete: true\n\n[Typedef]\nid: t\n')
    got = {r.id: r for r in readers.disease_terms(readers.obo(spark, str(tmp_path / "x.obo"))).collect()}
    assert got["M:1"].name == "flu" and got["M:1"].exact_synonyms == ["grippe"] and got["M:1"].equivalents == ["D:9"] and got["M:2"].obsolete and len(got) == 2
    (tmp_path / "c.json").write_text('{"_version": "1", "5": {"n": "a"}, "6": {"n": "b"}}')
    assert sorted((r.id, r.value.n) for r in readers.json_by_id(spark, str(tmp_path / "c.json"), "n string").collect()) == [("5", "a"), ("6", "b")]
    (tmp_path / "b.csv").write_text('# licence\na,b\n1,"x, ""y"""\n2,NULL\n')
    assert [tuple(r) for r in readers.banner_csv(spark, str(tmp_path / "b.csv"), "NULL").collect()] == [("1", 'x, "y"'), ("2", None)]
    (tmp_path / "m.xml").write_text("<all><m><id>1</id></m><m><id>2</id></m></all>")
    assert readers.xml_records(spark, str(tmp_path / "m.xml"), "m").count() == 2
    (tmp_path / "t.tsv").write_text("a\tb\nc\n")
    assert [tuple(r) for r in readers.tsv(spark, str(tmp_path / "t.tsv"), ["x", "y"]).collect()] == [("a", "b")]
    with pytest.raises(readers.MissingInput):
        readers.locate(str(tmp_path), "none", "nowhere")


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>drug</t></si><si><r><t>met</t></r><r><t>formin</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>a title</t></is></c></row><row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="inlineStr"><is><t>p (NT1)</t></is></c></row><row r="4"><c r="A4" t="s"><v>1</v></c><c r="C4"><v>0.5</v></c></row></sheetData></worksheet>')
    got = readers.workbook(spark, path, "S1", "drug")
    assert got.columns == ["drug", "p (NT1)"] and [tuple(r) for r in got.collect()] == [("metformin", "0.5")]
    cells = readers.unpivot_matrix(got, ["drug"], r"\(NT\d+\)")
    assert [tuple(r) for r in cells.collect()] == [("metformin", "p (NT1)", "0.5")]
    with pytest.raises(readers.MalformedInput):
        readers.workbook(spark, path, "S1", "absent")


def test_closure_has_no_depth_bound(spark):
    from evigraph.operators.graph import closure

    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "child long, parent long")
    assert {(r.node, r.ancestor, r.depth) for r in closure(chain).collect()} == {(i, j, j - i) for i in range(70) for j in range(i + 1, 71)}
    assert closure(chain, most=5).count() == sum(min(5, 70 - i) for i in range(70))


def test_read_only_and_banner(spark, tmp_path):
    from evigraph.operators.graph import ReadOnlyError, ask, read_only

    assert ask(spark, "SELECT :x + 1 AS y -- a note", {"x": 2}).first()["y"] == 3
    for bad in ("DROP TABLE t", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "/* x */ DELETE FROM t"):
        with pytest.raises(ReadOnlyError):
            read_only(bad)
    assert read_only("SELECT 'a; drop' AS x;") == "SELECT 'a; drop' AS x"
    (tmp_path / "b.csv").write_text("# licence, see there\nid,name\n#1,a\n2,b\n")
    assert [tuple(r) for r in readers.banner_csv(spark, str(tmp_path / "b.csv")).collect()] == [("#1", "a"), ("2", "b")]
    (tmp_path / "c.csv").write_text("id,name\n#1,a\n")
    assert [tuple(r) for r in readers.banner_csv(spark, str(tmp_path / "c.csv"), limit=1).collect()] == [("#1", "a")]
