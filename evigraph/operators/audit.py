"""Audit: generated checks over nodes and edges, a row for each rule; no population of zero is audited."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import closure


@dataclass(frozen=True)
class Rule:
    name: str
    required: tuple[str, ...]
    severity: str = "warn"
    types: tuple[tuple[str, str], ...] = ()


class AuditError(Exception):
    pass


def _missing(c: str) -> Column:
    return F.col(c).isNull()


def _bad_type(c: str, kind: str) -> Column:
    return F.col(c).isNotNull() & F.col(c).cast("string").try_cast(kind).isNull()


def _checks(rule: Rule) -> list[tuple[str, Column]]:
    """(name, test of a broken row) of a rule's checks."""
    broken = reduce(lambda a, b: a | b, [_missing(c) for c in rule.required])
    return [(f"{rule.name}.required_properties", broken)] + [(f"{rule.name}.type_{c}", _bad_type(c, k)) for c, k in rule.types]


def measures(rules: list[Rule]) -> dict[str, Column]:
    """The rows, and the violations of each check, as aggregates that can be taken while rows are written (I1, I2); exempt rows and groups need audit()."""
    return {"rows": F.count(F.lit(1)), **{name: F.sum(F.when(test, 1).otherwise(0)).cast("long") for r in rules for name, test in _checks(r)}}


def measured_audit(spark, rules: list[Rule], taken: dict[str, dict]) -> DataFrame | None:
    """The report audit() gives, from what was measured (name of the relation -> measures); none without a population."""
    rows = []
    for r in rules:
        own = taken.get(r.name.split(".")[0], {})
        if own.get("rows"):
            rows += [(name, r.severity, own[name], 0, own["rows"], round(100.0 * own[name] / own["rows"], 6)) for name, _ in _checks(r)]
    return spark.createDataFrame(rows, "rule string, severity string, violations long, exempted long, total long, pct double") if rows else None


def audit(df: DataFrame, rule: Rule, by: list[str] | None = None, exempt: Column | None = None) -> DataFrame:
    """(rule, severity, violations, exempted, total, pct): a row that misses several required fields counts once, one that is exempt as exempted; groups come from the data, so none is empty."""
    free = F.coalesce(exempt, F.lit(False)) if exempt is not None else F.lit(False)
    parts = []
    for name, test in _checks(rule):
        counts = [F.sum(F.when(x, 1).otherwise(0)).cast("long").alias(n) for x, n in ((test & ~free, "violations"), (test & free, "exempted"))]
        got = df.groupBy(*(by or [])).agg(*counts, F.count(F.lit(1)).alias("total")).filter("total > 0")
        pct = F.round(F.col("violations") * F.lit(100.0) / F.col("total"), 6)
        parts.append(got.select(F.lit(name).alias("rule"), F.lit(rule.severity).alias("severity"), *(by or []), "violations", "exempted", "total", pct.alias("pct")))
    return reduce(DataFrame.unionByName, parts)


def census(df: DataFrame, properties: list[str]) -> DataFrame:
    """(property, missing, total): one row for each declared property, also where nothing is missing; one pass."""
    got = df.agg(F.count(F.lit(1)).alias("total"), *[F.sum(_missing(c).cast("int")).cast("long").alias(c) for c in properties])
    return got.unpivot(["total"], properties, "property", "missing").select("property", F.coalesce("missing", F.lit(0)).cast("long").alias("missing"), "total")


def violations(df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """key, property (the first missing), properties (all missing, in declared order)."""
    names = F.array_compact(F.array(*[F.when(_missing(c), F.lit(c)) for c in required]))
    return df.select(*key, names.alias("properties")).filter(F.size("properties") > 0).select(*key, F.element_at("properties", 1).alias("property"), "properties")


def lacking_edge(nodes: DataFrame, key: str, edges: DataFrame, src: str) -> DataFrame:
    """Nodes without an edge where one is required."""
    return nodes.join(edges.select(F.col(src).alias(key)), key, "left_anti")


def cardinality(edges: DataFrame, src: str, most: int) -> DataFrame:
    return edges.groupBy(src).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)


def too_few(nodes: DataFrame, key: str, edges: DataFrame, src: str, least: int) -> DataFrame:
    """Nodes with fewer edges than the rule asks for, with their number, 0 included."""
    n = edges.groupBy(F.col(src).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    return nodes.select(key).join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0))).filter(F.col("n") < least)


def forest(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, problem) of a hierarchy that should be a forest: nodes of several parents, and nodes on a cycle."""
    links = edges.filter(F.col(child) != F.col(parent)).select(F.col(child).alias("child"), F.col(parent).alias("parent")).distinct()
    several = links.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node", F.lit("several parents").alias("problem"))
    up = closure(links)
    back = links.join(up.select(F.col("node").alias("parent"), F.col("ancestor").alias("child")), ["child", "parent"], "left_semi").select(F.col("child").alias("node"), F.lit("cycle").alias("problem")).distinct()
    return several.unionByName(back)


def outside(edges: DataFrame, column: str, nodes: DataFrame, key: str) -> DataFrame:
    """Edges whose endpoint is no node of the declared kind."""
    return edges.join(nodes.select(F.col(key).alias(column)), column, "left_anti")


def gate(report: DataFrame) -> DataFrame:
    """The report, unless a rule of severity error is violated."""
    bad = [r["rule"] for r in report.filter("severity = 'error' and violations > 0").select("rule").distinct().collect()]  # a row a rule
    if bad:
        raise AuditError(", ".join(sorted(bad)))
    return report


def expansion(edges: DataFrame, source: str, record: str) -> DataFrame:
    """Edges, distinct source records and edges a record, by source."""
    got = edges.groupBy(source).agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct(record).alias("n_records"))
    return got.withColumn("factor", F.round(F.col("n_edges") / F.col("n_records"), 6))


def expansions(relations: dict[str, DataFrame | None], source: str, record: str, rows_in: dict[str, int]) -> DataFrame:
    """(relation, source, n_edges, n_records, unit, factor) of every declared relation (I8): one without edges gives a row of zero edges, one whose table no source wrote a row that says so; a
    source without record ids is held against its input rows."""
    parts = []
    for name, e in relations.items():
        if e is None:
            spark = next(x for x in relations.values() if x is not None).sparkSession
            parts.append(spark.createDataFrame([(name, None, None, None, "no input", None)], "relation string, source string, n_edges long, n_records long, unit string, factor double"))
            continue
        got = e.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_edges"), F.count_distinct(record).alias("n_records"))
        got = got.withColumn("unit", F.when(F.col("n_records") > 0, "records").otherwise("rows"))
        got = got.withColumn("n_records", F.when(F.col("n_records") > 0, F.col("n_records")).otherwise(F.lit(rows_in.get(name, 0))))
        one = e.sparkSession.range(1).select(F.lit(name).alias("relation"))
        got = one.join(got, F.lit(True), "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))
        parts.append(got.select("relation", "source", "n_edges", "n_records", "unit", F.when(F.col("n_records") > 0, F.round(F.col("n_edges") / F.col("n_records"), 6)).alias("factor")))
    return reduce(DataFrame.unionByName, parts)


def coverage(claims: DataFrame, layer: DataFrame, pair: list[str], direction: str) -> DataFrame:
    """(outcome, n) of external claims against a layer of edges: absent, or agree, contradict or split by the directions of the pair."""
    have = layer.groupBy(*pair).agg(F.array_sort(F.collect_set(direction)).alias("directions"))
    got = claims.join(have, pair, "left")
    outcome = (
        F.when(F.col("directions").isNull(), "absent").when(F.size("directions") > 1, "split")
        .when(F.element_at("directions", 1) == F.col(direction), "agree").otherwise("contradict")
    )
    return got.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def score(claims: DataFrame, layer: DataFrame, pair: list[str], direction: str, level: str) -> dict[str, DataFrame]:
    """Coverage of external claims by a layer (I11): `counts` (references, resolvable and covered pairs), `outcomes` of directions among comparable claims, `levels` of the covered pairs' reports.
    A claim with a null key part is not resolvable; one without a direction is covered but not comparable."""
    known = claims.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pair]))
    have = layer.groupBy(*pair).agg(F.array_sort(F.collect_set(F.nullif(F.col(direction), F.lit("")))).alias("_dirs"))
    got = known.join(have, pair, "left")
    covered = F.col("_dirs").isNotNull()
    counts = claims.agg(F.count(F.lit(1)).alias("n_references")).crossJoin(got.agg(F.count(F.lit(1)).alias("n_resolvable"), F.count(F.when(covered, 1)).alias("n_covered")))  # one row each
    outcome = F.when(F.size("_dirs") == 1, F.when(F.element_at("_dirs", 1) == F.col(direction), "agree").otherwise("contradict")).when(F.array_contains("_dirs", F.col(direction)), "split").otherwise("contradict")
    outcomes = got.filter(covered & F.col(direction).isNotNull() & (F.size("_dirs") > 0)).groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    levels = known.join(layer.select(*pair, F.coalesce(level, F.lit("(absent)")).alias("level")), pair).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    return {"counts": counts, "outcomes": outcomes, "levels": levels}


def score_text(name: str, scored: dict[str, DataFrame]) -> str:
    """The score as lines of text."""
    c = scored["counts"].first()
    pct = lambda a, b: f"{100.0 * a / b:.1f}%" if b else "n/a"
    said = lambda f, k: ", ".join(f"{r[k]} {r['n']:,}" for r in sorted(f.collect(), key=lambda r: (-r["n"], r[k]))) or "none"  # noqa: E731  a row an outcome or level
    return "\n".join([
        f"{name}: {c['n_references']:,} claims, {c['n_resolvable']:,} resolvable ({pct(c['n_resolvable'], c['n_references'])})",
        f"covered {c['n_covered']:,} ({pct(c['n_covered'], c['n_resolvable'])} of resolvable)",
        f"directions: {said(scored['outcomes'], 'outcome')}",
        f"levels: {said(scored['levels'], 'level')}",
    ])


def timing(seconds: list[float], once: bool = False) -> dict[str, float | str]:
    """What a bench reports of its samples (I14): the least; the median if the least lies under 0.7 of it; the mean of what happens once an event; p95, and a rare branch where the greatest is thirty medians or more."""
    xs = sorted(seconds)
    middle = xs[len(xs) // 2] if len(xs) % 2 else (xs[len(xs) // 2 - 1] + xs[len(xs) // 2]) / 2
    kind = "mean" if once else "median" if xs[0] < 0.7 * middle else "min"
    value = sum(xs) / len(xs) if once else middle if kind == "median" else xs[0]
    return {"value": value, "kind": kind, "p95": xs[min(len(xs) - 1, int(0.95 * len(xs)))], "rare_branch": xs[-1] >= 30 * middle}


def holds(claimed: dict[str, object], measured: dict[str, object]) -> list[str]:
    """Claims in prose that the queries' answers do not bear out."""
    return [f"{k}: claimed {v!r}, measured {measured.get(k)!r}" for k, v in claimed.items() if measured.get(k) != v]


def claims_held(claims: DataFrame, measured: DataFrame, key: str, told: str, value: str) -> DataFrame:
    """claims (key, told, ...) with the measured value and whether it bears the claim out; nothing measured holds only a claim of nothing."""
    got = claims.join(measured.select(key, F.col(value).alias("measured")), key, "left")
    return got.withColumn("holds", F.col(told).eqNullSafe(F.col("measured")))
