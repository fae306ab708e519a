"""Secret scans: an incremental ledger of content-addressed blobs.

Every version of every path is one row of text. A blob is a distinct text, named by its SHA-256. The ledger says which
(blob, rule, rule version) pairs were scanned and what was found; a run scans only the pairs the ledger lacks and joins
the findings of old and new scans back to all paths that hold the blob. Everything is built-in SQL functions.

Spans are code points, end exclusive, of leftmost non-overlapping matches. They come from the pieces between matches: the
lengths of pieces and matches, summed, are the offsets. A null text is the empty blob; an empty table gives an empty result; repeated rows each
give a row; other columns are ignored. A blob that a third of all rows hold is scanned once: its copies
meet only as partial aggregates, and the join back to paths is split where it is skewed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1
    base: bool = True
    plain: str = ""  # the pattern for engines without lookbehind: what stands before the match, then the match as group 1


#: Patterns and least lengths (fixed values). A run of hex digits or an access key is maximal, so its least length may stand in the pattern.
#: A web token begins where no character of a key stands before it, and gives nothing back, so that each run is read no more than three times.
#: No group is repeated: the engine would recurse a level a repetition, and a long text would exhaust its stack.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", 2, r"-----BEGIN (?:[A-Z ]* )?PRIVATE KEY-----", 0, 1, False),
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}", 0, 1, False, r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, False),
)

LEDGER_SCHEMA = "blob binary, rule string, version int, spans array<struct<first:int,last:int>>"


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<first,last>> of the rule's matches in text.

    Offsets are running sums of lengths. n matches are summed in runs of sqrt(n), first each run's total and then within the runs, so that
    the work grows with n^1.5 and no accumulator copies the whole list for each match. What is used twice is bound to a lambda variable once."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    marks = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("p"), whole.alias("w"), group.alias("g")),
        lambda x: F.struct(F.length(x["p"]).alias("gap"), F.coalesce(F.length(x["w"]), F.lit(0)).alias("size"), F.coalesce(F.length(x["g"]) >= rule.least, F.lit(False)).alias("hit")),
    )

    def length(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda at, x: at + x["gap"] + x["size"])

    def run_spans(part: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            first = acc["at"] + x["gap"]
            span = F.struct(first.alias("first"), (first + x["size"]).alias("last"))
            return F.struct((first + x["size"]).alias("at"), F.when(x["hit"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def bound(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def runs(m: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(m))).cast("int")
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / size).cast("int")), lambda j: F.slice(m, j * size + 1, size))
        return bound(parts, spans)

    def spans(parts: Column) -> Column:
        begins = F.aggregate(parts, F.array(F.lit(0)), lambda acc, part: F.concat(acc, F.array(F.element_at(acc, -1) + length(part))))
        return F.flatten(F.zip_with(parts, F.slice(begins, 1, F.size(parts)), run_spans))

    return F.when(F.size(whole) > 0, bound(marks, runs))


def blobs_of(paths: DataFrame) -> DataFrame:
    """(blob, text): one row for each distinct text; copies of a blob meet as partial aggregates of a partition each."""
    text = text_or_empty()
    return paths.select(blob_id(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))


def scan(blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: a row for each blob and rule version the ledger lacks, also where nothing was found."""
    seen = None
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("seen"))
        blobs = blobs.join(seen, "blob", "left")
    out = []
    for r in rules:
        due = F.lit(True) if seen is None else ~F.coalesce(F.array_contains("seen", f"{r.kind}:{r.version}"), F.lit(False))
        found = F.coalesce(spans_of(F.col("text"), r), F.array().cast("array<struct<first:int,last:int>>"))
        out.append(F.when(due, F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), found.alias("spans"))))
    return blobs.select("blob", F.explode(F.array_compact(F.array(*out))).alias("x")).select("blob", "x.rule", "x.version", "x.spans")


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, hits): for each blob with any finding under the current rule versions, its hits by start and then kind as listed."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind}:{r.version}"), F.lit(i))])
    current = ledger.withColumn("rank", rank[F.concat_ws(":", "rule", "version")]).filter(F.col("rank").isNotNull() & (F.size("spans") > 0))
    hits = F.transform("spans", lambda s: F.struct(s["first"].alias("first"), F.col("rank").alias("rank"), s["last"].alias("last"), F.col("rule").alias("kind")))
    return current.select("blob", hits.alias("hits")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))


def join_paths(paths: DataFrame, found: DataFrame) -> DataFrame:
    """Every path's id with its blob and hits (null where there are none)."""
    return paths.select("doc_id", blob_id(text_or_empty()).alias("blob")).join(found, "blob", "left")


def update_ledger(paths: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows to append to the ledger for these paths."""
    return scan(blobs_of(paths), ledger, rules)


def digest_columns(joined: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    base = [r.kind for r in rules if r.base]
    hits = F.coalesce("hits", F.array().cast(joined.schema["hits"].dataType))
    of_base = F.filter(hits, lambda h: h["kind"].isin(base))
    said = lambda a: F.array_join(F.transform(a, lambda h: F.concat_ws(":", h["kind"], h["first"], h["last"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(hits, lambda h: h["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in base]
    return joined.select("doc_id", *counts, F.sha2(said(of_base), 256).alias("base_sha256"), said(hits).alias("spans"))


def secret_scan(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per path: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    new = update_ledger(paths, ledger, rules)
    whole = new if ledger is None else ledger.select("blob", "rule", "version", "spans").unionByName(new)
    found = materialize(findings(whole, rules))  # written, so that both sides of the join below can be split where one blob is on many paths
    return digest_columns(join_paths(paths, found), rules)
