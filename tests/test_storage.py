"""A graph on disk: hops without an exchange, lookups in one bucket, the same rows."""

import re

import pytest

from evigraph.operators import storage
from evigraph.operators.graph import Graph


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    e = spark.createDataFrame([(i % 40, (i * 7) % 90, i) for i in range(3000)] + [(5, 3, -1)] * 2 + [(None, 3, 0)], "s long, d long, n int")
    g = Graph().add_nodes("S", spark.range(40).withColumnRenamed("id", "k"), "k", ("Any",)).add_nodes("P", spark.range(90).withColumnRenamed("id", "k"), "k").add_edges("R", e, "s", "d", "S", "P")
    out = str(tmp_path_factory.mktemp("g"))
    return g, storage.open_clustered(spark, out, storage.save_clustered(g, out, 8))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_same_rows(saved):
    g, s = saved
    assert rows(s.hop(s.nodes["S"], "R", "id", "p")) == rows(g.hop(g.nodes["S"], "R", "id", "p"))
    assert rows(s.hop(s.nodes["P"].filter("id < 9"), "R", "id", "q", back=True)) == rows(g.hop(g.nodes["P"].filter("id < 9"), "R", "id", "q", back=True))
    assert rows(s.exists(s.nodes["P"], "R", "id", back=True)) == rows(g.exists(g.nodes["P"], "R", "id", back=True))
    assert rows(s.slim_edges(undirected=True, at=("P", 3))) == rows(g.slim_edges(undirected=True, at=("P", 3)))
    assert s.scan("Any").count() == 40 and s.edges["R"].count() == s.by_target["R"].count() == 3002


@pytest.mark.parametrize("back", [False, True])
def test_a_hop_shuffles_nothing(spark, saved, back):
    _, s = saved
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = s.hop(s.nodes["P" if back else "S"].filter("id > 2"), "R", "id", "far", back=back)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_lookup_reads_one_bucket(spark, saved):
    _, s = saved
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # so that the plan says which buckets are left
    try:
        for df in (s.side("R", "src").filter("src = 5"), s.side("R", "dst").filter("dst = 3"), s.nodes["S"].filter("id = 7")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"SelectedBucketsCount: 1 out of 8", plan), plan
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    at = s.side("R", "src").filter("src = 5")
    assert at._jdf.queryExecution().toRdd().getNumPartitions() == 1 < s.edges["R"]._jdf.queryExecution().toRdd().getNumPartitions()
    assert rows(at) == rows(s.edges["R"].filter("src + 0 = 5"))
