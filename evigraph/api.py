"""The surface: status, build, serve, coverage, as functions and as a command line (`python -m evigraph`)."""

from __future__ import annotations

import argparse
import json
import os
import sys

from .operators import audit, procedures
from .operators import build as building
from .operators.graph import ReadOnlyError, ask

#: Rows of an answer that are sent at once; more are counted and fetched on demand.
INLINE_ROWS = 15


def prepare(data: str, create: bool = False, max_age_days: float | None = None) -> dict[str, dict]:
    """Status of every source under data/raw; with `create`, its folders are made."""
    from .sources.preps import SOURCES

    raw = os.path.join(data, "raw")
    if create:
        for s in SOURCES:
            for f in s.inputs:
                os.makedirs(os.path.dirname(os.path.join(raw, f)), exist_ok=True)
    return building.status(raw, SOURCES, _manifest(raw), max_age_days)


def status(data: str) -> dict[str, dict]:
    return prepare(data)


def fetch(data: str, only: list[str] | None = None, missing: bool = False) -> list[str]:
    """Files that a fetch would have to bring: this engine opens no network connection, so it names them instead."""
    found = prepare(data)
    if only and (unknown := set(only) - set(found)):
        raise ValueError(f"unknown sources: {', '.join(sorted(unknown))}")
    return sorted(f for name, s in found.items() if not only or name in only for f, x in s["files"].items() if x["state"] == "absent" or (not missing and x["state"] == "stale"))


def build(spark, data: str, with_kegg: bool = False, with_vectors: bool = False, scope: str = "cited", out: str | None = None, do_save: bool = True) -> building.BuildResult:
    """Build the graph of the sources under data/raw and save it to `out` (data/graph by default)."""
    from .operators.search import Indexes
    from .sources.preps import DOCUMENT, SOURCES

    rules = [audit.Rule("ASSOCIATED_WITH", ("direction", "evidence_level", "primary_source", "source_record_id"), "warn"), audit.Rule("REPORTED_BY", ("reported_name", "resolution_status"), "warn")]
    out = (out or f"{data}/graph") if do_save else None
    result = building.build(spark, f"{data}/raw", SOURCES, DOCUMENT, rules, out, ("kegg",) if with_kegg else (), scope)
    if result.graph and out:
        indexes = Indexes(spark, f"{out}/indexes")
        for label, prop in (("Taxon", "name"), ("Taxon", "synonyms_text"), ("Disease", "label"), ("Paper", "title")):
            if label in result.graph.nodes and prop in result.graph.nodes[label].columns:
                indexes.build_text(label, prop, result.graph.nodes[label], "id")
        if with_vectors and "Taxon" in result.graph.nodes:
            indexes.build_vectors("Taxon", "name", result.graph.nodes["Taxon"], "id")
        result.indexes = indexes
    return result


def manifest(raw: str) -> dict:
    """Size of every file under raw, as a fetch would record it."""
    out = {}
    for folder, _, names in os.walk(raw):
        for n in names:
            path = os.path.join(folder, n)
            if n != "manifest.json":
                out[os.path.relpath(path, raw)] = {"bytes": os.path.getsize(path)}
    return out


def _manifest(raw: str) -> dict:
    try:
        with open(os.path.join(raw, "manifest.json"), encoding="utf-8") as f:
            found = json.load(f)
    except (FileNotFoundError, json.JSONDecodeError):
        return {}
    return found if isinstance(found, dict) else {}


class Agent:
    """JSON-RPC over lines: tools/list and tools/call with sql_query and graph_overview. Statements only read; a long answer is cut to INLINE_ROWS with its true number and how to go on."""

    TOOLS = (
        {"name": "sql_query", "description": "One reading SQL statement over node_<Label> and edge_<TYPE>", "inputSchema": {"type": "object", "properties": {"sql": {"type": "string"}, "args": {"type": "object"}, "offset": {"type": "integer"}}, "required": ["sql"]}},
        {"name": "graph_overview", "description": "Labels and relationship types with their counts", "inputSchema": {"type": "object", "properties": {}}},
    )

    def __init__(self, spark, graph, rules=(), indexes=None):
        self.spark, self.graph = spark, graph
        building.views(graph)
        procedures.register(spark, graph, list(rules), indexes)

    def call(self, name: str, args: dict) -> dict:
        if name == "graph_overview":
            return {"rows": sorted((r.asDict() for r in self.graph.counts().collect()), key=lambda r: (r["what"], r["name"]))}
        if name != "sql_query":
            raise ValueError(f"no tool {name!r}")
        got, offset = ask(self.spark, args["sql"], args.get("args")), int(args.get("offset", 0))
        page = [r.asDict(recursive=True) for r in got.offset(offset).limit(INLINE_ROWS + 1).collect()]
        out = {"rows": page[:INLINE_ROWS]}
        if len(page) > INLINE_ROWS:
            out |= {"total": got.count(), "more": {"tool": "sql_query", "arguments": args | {"offset": offset + INLINE_ROWS}}}
        return out

    def answer(self, line: str) -> str | None:
        """The reply to one request; none to a notification."""
        ask_id = None
        try:
            request = json.loads(line)
            ask_id, method = request.get("id"), request.get("method")
            if ask_id is None:
                return None
            if method == "initialize":
                result = {"protocolVersion": "2024-11-05", "capabilities": {"tools": {}}, "serverInfo": {"name": "evigraph", "version": "2"}}
            elif method == "tools/list":
                result = {"tools": list(self.TOOLS)}
            elif method == "tools/call":
                p = request.get("params", {})
                result = {"content": [{"type": "text", "text": json.dumps(self.call(p.get("name"), p.get("arguments", {})), default=str)}]}
            else:
                return json.dumps({"jsonrpc": "2.0", "id": ask_id, "error": {"code": -32601, "message": f"no method {method!r}"}})
            return json.dumps({"jsonrpc": "2.0", "id": ask_id, "result": result})
        except ReadOnlyError as e:
            return json.dumps({"jsonrpc": "2.0", "id": ask_id, "error": {"code": -32000, "message": str(e)}})
        except Exception as e:  # a request's fault is its reply: the server goes on
            return json.dumps({"jsonrpc": "2.0", "id": ask_id, "error": {"code": -32602, "message": f"{type(e).__name__}: {str(e)[:500]}"}})


def main(argv: list[str] | None = None, stdin=None, stdout=None) -> int:
    ap = argparse.ArgumentParser(prog="evigraph", description=__doc__)
    verbs = ap.add_subparsers(dest="verb", required=True)
    for name in ("fetch", "status", "build", "serve", "coverage"):
        v = verbs.add_parser(name)
        v.add_argument("--data", default=".")
        if name == "status":
            v.add_argument("--create", action="store_true")
            v.add_argument("--max-age-days", type=float)
        if name == "fetch":
            v.add_argument("--only", action="append")
            v.add_argument("--missing", action="store_true")
        if name == "build":
            v.add_argument("--scope", choices=("cited", "microbial", "all"), default="cited")
            v.add_argument("--with-kegg", action="store_true")
            v.add_argument("--with-vectors", action="store_true")
            v.add_argument("--no-save", action="store_true")
        if name in ("build", "serve", "coverage"):
            v.add_argument("--out")
        if name == "coverage":
            v.add_argument("--set", required=True, choices=("hmdad", "peryton"))
    opts = ap.parse_args(argv)
    stdin, stdout = stdin or sys.stdin, stdout or sys.stdout
    if opts.verb == "status":
        print(building.status_text(prepare(opts.data, opts.create, opts.max_age_days)), file=stdout)
        return 0
    if opts.verb == "fetch":
        due = fetch(opts.data, opts.only, opts.missing)
        print("\n".join(due) or "nothing is missing", file=stdout)
        return 1 if due else 0
    from .session import local_session

    spark = local_session()
    if opts.verb == "build":
        result = build(spark, opts.data, opts.with_kegg, opts.with_vectors, opts.scope, opts.out, not opts.no_save)
        for name, why in sorted(result.skipped.items()):
            print(f"skipped {name}: {why}", file=stdout)
        print(building.printed(result.report) if result.graph else "no taxonomy: nothing was built", file=stdout)
        return 0
    graph, _ = building.opened(spark, opts.out or f"{opts.data}/graph")
    if opts.verb == "coverage":
        print(building.to_json(coverage(spark, opts.data, opts.set, graph)), file=stdout)
        return 0
    agent = Agent(spark, graph)
    for line in stdin:
        if line.strip() and (reply := agent.answer(line)):
            print(reply, file=stdout, flush=True)
    return 0


def coverage(spark, data: str, name: str, graph) -> dict:
    """How much of an external reference set the graph asserts by itself; the set's names are reconciled as the sources' own are."""
    from pyspark.sql import functions as F

    from .operators import policies, rules
    from .sources import preps, readers

    raw = f"{data}/raw"
    if name == "hmdad":
        (path,) = preps.present(spark, raw, "hmdad/data_download.txt")
        rows = readers.claims(readers.tsv(spark, path), {"microbe": "Microbe", "disease": "Disease", "direction": "Evidence"}).withColumn("given_id", F.lit(None).cast("bigint"))
    else:
        (path,) = preps.present(spark, raw, "peryton/associations.json")
        df = readers.json_array(spark, path, "group_two string, relationship_name string, microbe_ncbi_tax_id string, microbe_scientific_name string, disease_mesh_heading string, disease_name string")
        df = df.withColumn("_d", F.coalesce("disease_mesh_heading", "disease_name"))
        rows = readers.claims(df, {"microbe": "microbe_scientific_name", "disease": "_d", "direction": "relationship_name", "given": "microbe_ncbi_tax_id"}, F.trim("group_two") == "Healthy Controls").withColumn("given_id", F.col("given").try_cast("bigint"))
    terms = readers.disease_terms(readers.obo(spark, preps.present(spark, raw, "mondo/mondo.obo")[0]))
    found = preps.resolved(spark, raw, rows.withColumnRenamed("microbe", "name"))
    hubs = policies.by_name(rows, "disease", terms, lambda c: rules.casefold(rules.without_parenthetical(c)))
    claims = found.join(hubs.select(F.col("disease").alias("_d"), "hub_id"), F.col("disease") == F.col("_d"), "left").select(F.col("tax_id").cast("string").alias("src"), F.col("hub_id").alias("dst"), "direction")
    layer = graph.edges["ASSOCIATED_WITH"].select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"), "direction", "evidence_level")
    return audit.score(claims, layer, ["src", "dst"], "direction", "evidence_level")
