"""Schema registry: fragments composed with conflict detection, order of sources, pruning."""

from __future__ import annotations

import ast
import json
from collections.abc import Iterable


class FragmentConflict(ValueError):
    pass


class OrderError(ValueError):
    pass


def compose(fragments: dict[str, dict]) -> dict:
    """One document of all fragments, by origin: mappings merge, lists are ordered unions, differing values conflict. Keys that start with _ are comments."""
    owner: dict[tuple, str] = {}

    def merge(into: dict, new: dict, origin: str, at: tuple) -> dict:
        for k, v in new.items():
            if k.startswith("_"):
                continue
            here = (*at, k)
            if k not in into:
                into[k] = merge({}, v, origin, here) if isinstance(v, dict) else list(v) if isinstance(v, list) else v
                owner[here] = origin
            elif isinstance(v, dict) and isinstance(into[k], dict):
                merge(into[k], v, origin, here)
            elif isinstance(v, list) and isinstance(into[k], list):
                into[k] += [x for x in v if x not in into[k]]
            elif into[k] != v:
                raise FragmentConflict(f"{'.'.join(here)}: {into[k]!r} ({owner.get(here, '?')}) and {v!r} ({origin})")
        return into

    out: dict = {}
    for origin, f in fragments.items():
        merge(out, f, origin, ())
    return out


def emit(document: dict) -> str:
    return json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def drifted(document: dict, written: str) -> bool:
    return emit(document) != written


def order_sources(after: dict[str, Iterable[str]]) -> list[str]:
    """Sources so that each follows those it reads from; ties in order of name."""
    wait = {k: set(v) for k, v in after.items()}
    unknown = {x for v in wait.values() for x in v} - wait.keys()
    if unknown:
        raise OrderError(f"unknown: {', '.join(sorted(unknown))}")
    out: list[str] = []
    while wait:
        ready = sorted(k for k, v in wait.items() if not v)
        if not ready:
            raise OrderError(f"cycle: {', '.join(sorted(wait))}")
        out.append(ready[0])
        del wait[ready[0]]
        for v in wait.values():
            v.discard(ready[0])
    return out


def declared(source: str, name: str):
    """A module-level literal of that name, read from a source's text without importing it; None if there is none."""
    for node in ast.parse(source).body:
        targets = node.targets if isinstance(node, ast.Assign) else [node.target] if isinstance(node, ast.AnnAssign) and node.value else []
        if any(isinstance(t, ast.Name) and t.id == name for t in targets):
            return ast.literal_eval(node.value)
    return None


def declared_order(sources: dict[str, str]) -> list[str]:
    """Sources (name -> text) in an order that their DEPENDS_ON allows; a source that declares none is an error (C11)."""
    after = {k: declared(text, "DEPENDS_ON") for k, text in sources.items()}
    if silent := sorted(k for k, v in after.items() if v is None):
        raise OrderError(f"no DEPENDS_ON in {', '.join(silent)}")
    return order_sources(after)


def relationships(document: dict) -> dict[str, dict]:
    """Every declared relationship with its input tables."""
    return {k: {"tables": spec.get("tables", [spec["table"]] if "table" in spec else []), "source": spec.get("source"), "target": spec.get("target")} for k, spec in document.get("edges", {}).items()}


def pruned_rules(rules: list, relations: Iterable[str], labels: Iterable[str]) -> list:
    """Rules over relations and classes that are there: no rule is held against an empty population (C13). A rule's name begins with its relation or class."""
    have = {*relations, *labels}
    return [r for r in rules if r.name.split(".")[0] in have]


def bound(document: dict, tables: dict) -> dict[str, tuple]:
    """What a document's types load from: name -> (kind, frames) of the tables that are there (C14)."""
    out = {}
    for part in ("nodes", "edges"):
        for name, spec in document.get(part, {}).items():
            own = [tables[t] for t in spec.get("tables", [spec.get("table")]) if t in tables]
            if own:
                out[name] = (part, own)
    return out


def checked(document: dict) -> list[str]:
    """Warnings about a document: edges between undeclared types, unknown property types."""
    nodes, warnings = document.get("nodes", {}), []
    known = {"string", "int", "float", "bool", "list", "any"}
    for name, spec in document.get("edges", {}).items():
        for end in ("source", "target"):
            for label in spec.get(end) if isinstance(spec.get(end), list) else [spec.get(end)]:
                if label not in nodes:
                    warnings.append(f"{name}: {end} {label!r} is no declared node")
    for part in ("nodes", "edges"):
        for name, spec in document.get(part, {}).items():
            warnings += [f"{name}.{c}: unknown type {k!r}" for c, k in spec.get("properties", {}).items() if k not in known]
    return warnings


def declared_types(document: dict) -> dict[str, dict[str, str]]:
    """table -> column -> type, of all nodes and edges."""
    out: dict[str, dict[str, str]] = {}
    for part in ("nodes", "edges"):
        for spec in document.get(part, {}).values():
            for table in spec.get("tables", [spec["table"]] if "table" in spec else []):
                out.setdefault(table, {}).update(spec.get("properties", {}))
    return out


def prune(document: dict, tables: Iterable[str]) -> dict:
    """Without node and edge types whose table is absent: no rule is then held against nothing."""
    have = set(tables)
    keep = lambda spec: any(t in have for t in spec.get("tables", [spec.get("table")]))
    return {k: {n: s for n, s in v.items() if keep(s)} if k in ("nodes", "edges") else v for k, v in document.items()}


def included(needs: dict[str, Iterable[str]], tables: Iterable[str], gated: Iterable[str] = (), opted: Iterable[str] = ()) -> list[str]:
    """Sources whose declared tables are all there; one behind a licence gate only if it was opted in."""
    have, shut = set(tables), set(gated) - set(opted)
    return [k for k, v in needs.items() if set(v) <= have and k not in shut]
