"""Inverted file and block postings against full scans: the same results where they promise them, and how much they read."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from evigraph.operators import search
from evigraph.operators.postings import BlockPostings
from evigraph.operators.vectors import NOWHERE, InvertedFile


@pytest.fixture(scope="module")
def clustered(spark):
    """Vectors about 60 directions, as names and texts give; with null, ragged, zero and non-finite ones."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    rows = [(i, [float(x) for x in base[i % 60] + rng.normal(0, 0.35, 32)]) for i in range(6000)]
    odd = [(9000, None), (9001, [1.0]), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, [float("inf")] + [0.0] * 31)]
    return rows, spark.createDataFrame(rows + odd, "id long, v array<double>").repartition(4)


def true_top(rows, q, k):
    x = np.array([v for _, v in rows])
    s = x @ q / np.linalg.norm(x, axis=1) / np.linalg.norm(q)
    order = np.lexsort((np.array([i for i, _ in rows]), -s))[:k]
    return [rows[i][0] for i in order], s[order]


def test_inverted_file(spark, clustered, tmp_path):
    rows, df = clustered
    index = InvertedFile.build(df, "id", "v", str(tmp_path / "ivf"))
    index = InvertedFile.opened(spark, str(tmp_path / "ivf"))
    assert index.size == 6005 and index.cells[NOWHERE][0] == 5 and index.width == 32
    found = total = read = 0
    for _, v in rows[::1250]:
        want, scores = true_top(rows, np.array(v), 10)
        near = {r.doc for r in index.search(v, 10).collect()}
        found, total = found + len(near & set(want)), total + 10
        read += index.rows_in(index.probes(v))
        exact = index.search(v, 10, exact=True).collect()
        assert [r.doc for r in exact] == want and np.allclose([r.score for r in exact], scores)
    assert found / total >= 0.9 and read / (5 * 6000) < 0.1  # recall over a tenth of the rows
    some = rows[17][1]
    assert index.rows_in(index.needed(some, 10)) < 6000
    plan = index.search(some, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    with pytest.raises(ValueError):
        index.search([1.0], 1)
    assert index.search([0.0] * 32, 3).count() == 0 and index.search([0.0] * 32, 3, exact=True).count() == 0


def test_inverted_file_of_little(spark, tmp_path):
    schema = "id long, v array<double>"
    one = InvertedFile.build(spark.createDataFrame([(1, [3.0, 4.0]), (2, [3.0, 4.0])], schema), "id", "v", str(tmp_path / "a"))
    assert [(r.doc, round(r.score, 9)) for r in one.search([3.0, 4.0], 5).collect()] == [(1, 1.0), (2, 1.0)]
    none = InvertedFile.build(spark.createDataFrame([], schema), "id", "v", str(tmp_path / "b"))
    assert none.size == 0 and none.search([1.0], 2).count() == 0 and none.search([1.0], 2, exact=True).count() == 0


def test_embeddings_that_lie_alike(spark, tmp_path):
    """Vectors without any grouping need most cells: recall is held, and the exact lookup stays exact."""
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in e.collect()]
    index = InvertedFile.build(e, "vec_id", "embedding", str(tmp_path / "e"))
    hit = 0
    for _, v in rows[::50]:
        want, _ = true_top(rows, np.array(v), 10)
        hit += len({r.doc for r in index.search(v, 10).collect()} & set(want))
        assert [r.doc for r in index.search(v, 10, exact=True).collect()] == want
    assert hit / (10 * len(rows[::50])) >= 0.9


def plain_bm25(rows, terms):
    words = {i: "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split() for i, t in rows if t is not None}
    n, avgdl = len(words), sum(map(len, words.values())) / len(words)
    out = Counter()
    for t in sorted(set(terms)):
        df = sum(t in w for w in words.values())
        for i, w in words.items():
            if tf := w.count(t):
                out[i] += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avgdl))
    return out


def test_block_postings(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(vocabulary[min(399, int(rng.expovariate(0.02)))] for _ in range(rng.choice([3, 10, 40, 200])))) for i in range(4000)]
    rows += [(5000, None), (5001, ""), (5002, "W0, w0! Ünw0 " + "w1 " * 50000), (5003, "w7 w7"), (5004, "w7 w7")]
    df = spark.createDataFrame(rows, "id long, name string").repartition(4)
    index = BlockPostings.build(df, "id", "name", str(tmp_path / "p"), range_docs=8)
    assert index.n == 4004
    for terms, k in ((["w0"], 10), (["w0", "w1", "w350"], 10), (["w7"], 2), (["w399", "w2"], 30), (["w5", "none"], 5000)):
        want = plain_bm25(rows, terms)
        got = {r.doc: r.score for r in index.search(terms).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in got)
        top = [(r.doc, round(r.score, 9)) for r in index.top(terms, k).collect()]
        assert top == sorted(((i, round(s, 9)) for i, s in got.items()), key=lambda x: (-x[1], x[0]))[:k]
    for terms, least in ((["w0"], 0.5), (["w0", "w1", "w350"], 0.8)):  # of several words a range's bound may come from different documents
        read, held = index.read_of(terms, 10)
        assert 0 < read < held * least, (terms, read, held)
    assert index.search(["none"]).count() == 0 and index.top([], 3).count() == 0 and index.read_of(["none"], 3) == (0, 0)
    from evigraph.operators import postings

    monkeypatch.setattr(postings, "SLICE_RANGES", 1)  # more tasks a folder
    again = BlockPostings.build(df, "id", "name", str(tmp_path / "r"), range_docs=8)
    assert again.top(["w0", "w350"], 20).collect() == index.top(["w0", "w350"], 20).collect()
    empty = BlockPostings.build(df.limit(0), "id", "name", str(tmp_path / "q"))
    assert empty.n == 0 and empty.top(["w0"], 3).count() == 0


def test_blocks_of_rare_and_frequent_terms(spark, tmp_path):
    """A block for each rare term and range made nearly as many rows as postings, which took most of the build; now its postings in a cell are one block, and lookups still go by ranges."""
    from pyspark.sql import functions as F

    from evigraph.operators import postings

    rng = random.Random(5)
    rows = [(f"k{i}", " ".join([f"r{i % 60}", "all", *(f"f{rng.randrange(9)}" for _ in range(rng.choice([1, 6, 30, 150])))])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, name string").repartition(3)
    index = BlockPostings.build(df, "id", "name", str(tmp_path / "p"), range_docs=2)
    held = {r.term: r for r in index.blocks.groupBy("term").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n"), F.count("range").alias("own"), F.sum(F.size("docs")).alias("docs")).collect()}
    assert held["r7"].n == held["r7"].docs == 50 and held["r7"].own == 0 and held["r7"].blocks <= postings.SLICES
    assert held["all"].n == held["all"].docs == 3000 and held["all"].own == held["all"].blocks > 64
    of = postings.place(F.col("p.docs"), F.col("p.dls"), index.ranges)
    assert index.blocks.filter("range IS NOT NULL").select("range", F.explode(F.arrays_zip("docs", "dls")).alias("p")).filter(F.col("range") != of).isEmpty()
    for terms, k in ((["r7"], 5), (["all", "r7"], 10), (["all", "f3", "r1", "r2"], 40), (["all"], 3000)):
        want = plain_bm25(rows, terms)
        got = {r.doc: r.score for r in index.search(terms).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in got)
        assert [(r.doc, round(r.score, 9)) for r in index.top(terms, k).collect()] == sorted(((i, round(s, 9)) for i, s in got.items()), key=lambda x: (-x[1], x[0]))[:k]
    read, all_of = index.read_of(["all", "r7"], 10)
    assert 0 < read < all_of


def test_ranges_are_the_same_in_tasks_and_statements(spark):
    from pyspark.sql import functions as F

    from evigraph.operators import postings

    long = postings.LONGEST
    dls = np.array([*range(3000), *(int(2 ** (k / 3)) + d for k in range(30, 62) for d in (-2, -1, 0, 1)), long - 2, long - 1, long, 2**31 - 1], np.int32)
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(dls)], "doc long, dl int").withColumn("near", F.pmod(F.xxhash64("doc"), F.lit(7)).cast("int"))
    got = df.select("dl", "near", postings.place(F.col("doc"), F.col("dl"), 7).alias("r")).collect()
    assert postings._places(np.array([r.dl for r in got], np.int32), np.array([r.near for r in got]), 7).tolist() == [r.r for r in got]


def test_registry(spark, tmp_path):
    held = search.Indexes(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "red ring"), (2, "Ring ring of fire"), (3, None)], "id long, name string")
    assert held.build_text("T", "name", df, "id") == {"indexed": 2, "terms": 4, "skipped": 1}
    full = {r.doc: round(r.score, 9) for r in search.bm25(df, "id", "name", "ring OF").collect()}
    assert {r.doc: round(r.score, 9) for r in held.search_text("T", "name", "RING of").collect()} == full
    assert [r.doc for r in held.search_text("T", "name", "ring of", 1).collect()] == [2]
    held.build_vectors("T", "name", df, "id")
    asked = search.chargram_vectors(spark.createDataFrame([(0, "red ringg")], "id long, name string"), "id", "name").first()["vec"]
    assert [r.doc for r in held.search_vectors("T", "name", list(asked), 1).collect()] == [1]
    said = lambda vectors: [(r.doc, round(r.score, 9), r.route) for r in search.find(df.filter("name is not null"), "id", "name", "rd rng", 2, vectors=vectors).collect()]
    assert said(held.vectors["T", "name"]) == said(None)
    assert {(r.kind, r.indexed) for r in held.listed().collect()} == {("text", 2), ("vector", 2)}
    for wrong in (lambda: held.search_text("T", "other", "x"), lambda: held.search_vectors("T", "none", [0.0], 1)):
        with pytest.raises(search.IndexMissing):
            wrong()
    with pytest.raises(ValueError):
        search.embedder("other")


def test_vectors_are_neither_joined_nor_gathered(spark):
    """A join's build side and a sample from each task both grew in the driver with the names."""
    from pyspark.sql import functions as F

    from evigraph.operators import vectors

    names = spark.range(5000).selectExpr("id", "concat('name ', id) as name")
    made = search.chargram_vectors(names, "id", "name")
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
    given = names.selectExpr("id as doc", "if(id % 10 < 8, null, array(double(id))) as vec")  # few are usable: more is read
    for sample in (7, 700, 3000):
        want = given.filter("vec is not null").orderBy(F.xxhash64("doc"), "doc").limit(sample).collect()
        assert vectors._sampled(given, 5000, sample) == [r["vec"] for r in want]
