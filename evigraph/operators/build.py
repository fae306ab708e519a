"""A build: sources in order into shared frames, a composed schema, a typed graph, its audit, and its files."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, schema, storage, tables
from .graph import Graph, cut


class Frames:
    """The named tables of one build. A table grows by merging: what was there wins, and rows that a source wrote before go first."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, {}

    def put(self, name: str, df: DataFrame, key: list[str] | None = None, owner: tuple[str, str] | None = None) -> Frames:
        old, n = self.held.get(name, (None, 0))
        df = df.withColumn("_seq", F.lit(n))
        if old is not None:
            if owner:
                old = old.filter(~F.col(owner[0]).eqNullSafe(F.lit(owner[1])))
            df = old.unionByName(df, allowMissingColumns=True)
        if key:
            rest = [c for c in df.columns if c not in key and c != "_seq"]
            df = tables.first_wins(df, key, ["_seq", *rest])
        self.held[name] = (cut(df), n + 1)
        return self

    def rows(self, name: str) -> DataFrame | None:
        return self.held[name][0].drop("_seq") if name in self.held else None

    def names(self) -> list[str]:
        return sorted(self.held)


@dataclass
class Source:
    """A source: the raw files it needs, the sources whose tables it reads, and the function that writes its tables."""

    name: str
    inputs: tuple[str, ...]
    after: tuple[str, ...]
    prep: Callable[[SparkSession, str, Frames], None]
    writes: tuple[str, ...] = ()
    licence: str = ""
    gated: bool = False


@dataclass
class BuildResult:
    graph: Graph | None
    report: dict[str, DataFrame]
    loaded: list[str]
    skipped: dict[str, str]
    out: str | None = None
    taxonomy_only: bool = False
    frames: Frames | None = field(default=None, repr=False)


def load(document: dict, frames: Frames, rules: list[audit.Rule] = ()) -> Graph:
    """Nodes and edges of a document from typed frames; types whose tables are absent are left out. Endpoints that no node has become stub nodes with nothing but an id. Rows are counted and held against the rules
    for their relation in the pass that writes them."""
    kept = schema.prune(document, frames.names())
    types, g = schema.declared_types(kept), Graph()

    def rows(spec: dict) -> DataFrame:
        own = [tables.typed(frames.rows(t), types.get(t, {})) for t in spec.get("tables", [spec.get("table")]) if frames.rows(t) is not None]
        return own[0] if len(own) == 1 else tables.absorb(*own).drop("_src_rank")

    for label, spec in kept.get("nodes", {}).items():
        g.add_nodes(label, rows(spec).drop(*spec.get("skipped", [])), spec["key"], tuple(spec.get("labels", [])))
    for kind, spec in kept.get("edges", {}).items():
        if spec["source"] in g.nodes and spec["target"] in g.nodes:
            g.add_edges(kind, rows(spec), spec["src"], spec["dst"], spec["source"], spec["target"])
    ends: dict[str, list[DataFrame]] = {}
    for kind, (source, target) in g.ends.items():
        own = [r for r in rules if r.name.split(".")[0] == kind]
        g.edges[kind] = cut(g.edges[kind], audit.measures(own), g.measured.setdefault(("edge", kind), {}))
        for end, label in (("src", source), ("dst", target)):
            ends.setdefault(label, []).append(g.edges[kind].select(F.col(end).cast(g.nodes[label].schema["id"].dataType).alias("id")))
    for label, df in g.nodes.items():  # all ends of a label at once: a turn for each type would double the plan each time
        if label in ends:
            lost = reduce(DataFrame.unionByName, ends[label]).distinct().join(df.select("id"), "id", "left_anti")
            df = df.unionByName(lost, allowMissingColumns=True)
        g.nodes[label] = cut(df, audit.measures([]), g.measured.setdefault(("node", label), {}))
    return g


def build(spark: SparkSession, raw: str, sources: list[Source], document: dict, rules: list[audit.Rule] = (), out: str | None = None, opted: tuple[str, ...] = (), scope: str = "cited") -> BuildResult:
    """Run the sources in an order that their needs allow; one whose input is missing or malformed, or that fails late, is skipped with the reason, and what it wrote is taken back. A licence-gated source runs only if opted in. Without
    taxa there is no graph. An audit rule of severity error that is violated stops the build before anything is written."""
    from ..sources.readers import MissingInput

    by_name, frames, loaded, skipped = {s.name: s for s in sources}, Frames(spark), [], {}
    frames.scope = scope
    for name in schema.order_sources({s.name: [a for a in s.after if a in by_name] for s in sources}):
        s = by_name[name]
        if s.gated and name not in opted:
            skipped[name] = f"licence {s.licence}: not opted in"
            continue
        before = dict(frames.held)
        try:
            s.prep(spark, raw, frames)  # every table is written here, so a malformed row fails here
        except MissingInput as e:
            skipped[name], frames.held = str(e), before
            continue
        except (PySparkException, Py4JJavaError, ValueError, KeyError) as e:  # a source that fails late is left out whole; the others go on
            skipped[name], frames.held = f"failed: {type(e).__name__}: {str(e).strip().splitlines()[0][:300] if str(e).strip() else ''}", before
            continue
        loaded.append(name)
    if frames.rows("taxon") is None:
        return BuildResult(None, {}, loaded, skipped, None, False, frames)
    g = load(document, frames, list(rules))
    held = [r for r in schema.pruned_rules(list(rules), g.edges, g.nodes) if r.name.split(".")[0] in g.edges]
    counts = [(what, name, x["rows"]) for (what, name), x in g.measured.items() if x["rows"]]
    report = {"counts": spark.createDataFrame(counts, "what string, name string, n long")}
    checked = audit.measured_audit(spark, held, {name: x for (what, name), x in g.measured.items() if what == "edge"})
    if checked is not None:
        report["audit"] = audit.gate(checked)
    declared = {k: g.edges.get(k) for k in document.get("edges", {})}
    if any(e is not None for e in declared.values()):
        known = {k: e if e is None or {"primary_source", "source_record_id"} <= set(e.columns) else e.select(*[F.col(c) if c in e.columns else F.lit(None).cast("string").alias(c) for c in ("primary_source", "source_record_id")]) for k, e in declared.items()}
        report["expansion"] = audit.expansions(known, "primary_source", "source_record_id", {k: g.measured["edge", k]["rows"] for k, e in known.items() if e is not None})
    result = BuildResult(g, report, loaded, skipped, out, loaded == ["taxonomy"], frames)
    if out:
        save(result, out)
    return result


def save(result: BuildResult, out: str) -> None:
    """Clustered Parquet by label and relationship, and build.json beside it: the sources, what was skipped and why, and rows by table (B2)."""
    g, spark = result.graph, result.frames.spark
    about = storage.save_clustered(g, out) | {
        "loaded": result.loaded, "skipped": result.skipped, "rows": {n: result.frames.rows(n).count() for n in result.frames.names()}, "labels": sorted(g.nodes), "engine": spark.version,
    }
    spark.createDataFrame([(json.dumps(about, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/build.json")


def opened(spark: SparkSession, out: str) -> tuple[Graph, dict]:
    """A saved graph and what its build.json says."""
    about = json.loads(spark.read.text(f"{out}/build.json", wholetext=True).first()[0])
    return storage.open_clustered(spark, out, about), about


def views(g: Graph) -> list[str]:
    """The graph's tables as views that a statement may name: node_<Label>, edge_<TYPE> (B1)."""
    names = []
    for kind, part in (("node", g.nodes), ("edge", g.edges)):
        for name, df in part.items():
            df.createOrReplaceTempView(f"{kind}_{name}")
            names.append(f"{kind}_{name}")
    return names


def add_nodes(g: Graph, label: str, df: DataFrame, key: str, on_invalid: str = "error") -> int:
    """Rows appended to a label's nodes; rows whose key is null or no value of the label's type are an error, or skipped and counted."""
    kind = g.nodes[label].schema["id"].dataType.simpleString()
    rows = df.withColumn("_ok", F.col(key).cast("string").try_cast(kind))
    bad = rows.filter("_ok is null").count()
    if bad and on_invalid == "error":
        raise ValueError(f"{label}: {bad} rows without a valid {key}")
    good = rows.filter("_ok is not null").drop(key).withColumnRenamed("_ok", "id")
    g.nodes[label] = g.nodes[label].unionByName(good.join(g.nodes[label].select("id"), "id", "left_anti"), allowMissingColumns=True)
    return bad


def to_json(scored: dict[str, DataFrame]) -> str:
    """A score's small frames as one JSON document."""
    return json.dumps({k: [r.asDict() for r in df.collect()] for k, df in scored.items()}, sort_keys=True)  # a row an outcome, level or count


def printed(report: dict[str, DataFrame]) -> str:
    """A build's report as text (B5): its frames have a row a type or rule."""
    lines = []
    for name, df in report.items():
        lines.append(f"== {name}")
        lines += ["  " + "  ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in df.collect()]
    return "\n".join(lines)


def status(raw: str, sources: list[Source], manifest: dict | None = None, max_age_days: float | None = None) -> dict[str, dict]:
    """Of each source: present, stale or absent, with sizes and ages of its files (I13). A file is stale if its size is not the manifest's or it is older than asked."""
    manifest, now, out = manifest or {}, time.time(), {}
    for s in sources:
        files = {}
        for rel in s.inputs:
            path = os.path.join(raw, rel)
            if not os.path.exists(path):
                files[rel] = {"state": "absent"}
                continue
            size, age = os.path.getsize(path), max(0.0, now - os.path.getmtime(path))
            stale = manifest.get(rel, {}).get("bytes", size) != size or (max_age_days is not None and age > max_age_days * 86400)
            files[rel] = {"state": "stale" if stale else "present", "bytes": size, "age_days": age / 86400}
        states = [f["state"] for f in files.values()]
        out[s.name] = {"state": "absent" if "absent" in states else "stale" if "stale" in states else "present", "files": files, "licence": s.licence}
    return out


def status_text(found: dict[str, dict]) -> str:
    """One line a source."""
    def size(n: float) -> str:
        for unit in ("B", "KB", "MB", "GB"):
            if n < 1024 or unit == "GB":
                return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
            n /= 1024

    lines = []
    for name, s in sorted(found.items()):
        here = [f for f in s["files"].values() if f["state"] != "absent"]
        missing = [k for k, f in s["files"].items() if f["state"] == "absent"]
        lines.append(f"{name}: {s['state']}, {len(here)} of {len(s['files'])} files, {size(sum(f['bytes'] for f in here))}" + (f"; missing {', '.join(missing)}" if missing else ""))
    return "\n".join(lines)
