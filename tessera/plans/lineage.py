"""Table and column lineage of a DataFrame, read off its analysed plan.

Nothing runs: the plan says which scan columns each output column is computed
from.  Columns that only decide which rows there are (join keys, filters,
grouping and sort keys that are not put out) are no part of a column's lineage.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class _Node:
    kind: str
    fields: dict
    children: list[_Node] = field(default_factory=list)


def _tree(rows: list[dict]) -> _Node:
    """The plan out of its preorder list."""
    it = iter(rows)

    def one() -> _Node:
        row = next(it)
        node = _Node(row["class"].rsplit(".", 1)[-1], row)
        node.children = [one() for _ in range(row["num-children"])]
        return node

    return one()


def _expressions(value) -> list[list[dict]]:
    """The expressions (preorder lists) in a field of a node."""
    if isinstance(value, list) and value:
        if isinstance(value[0], dict) and ".expressions." in value[0].get("class", ""):
            return [value]
        if isinstance(value[0], list):
            return [e for v in value for e in _expressions(v)]
    return []


def _id(expression: list[dict]) -> str | None:
    e = expression[0].get("exprId")
    return f"{e['id']}" if e else None


def _uses(expression: list[dict]) -> set[str]:
    return {_id([e]) for e in expression if e["class"].endswith(".AttributeReference")}


def _output(node: _Node) -> list[str]:
    """Ids of the columns that a node puts out."""
    named = {"Project": "projectList", "Aggregate": "aggregateExpressions"}.get(node.kind)
    if named:
        return [_id(e) for e in _expressions(node.fields[named])]
    if not node.children:
        return [_id(e) for e in _expressions(node.fields.get("output", []))]
    below = [_output(c) for c in node.children]
    if node.kind in ("Union", "Intersect", "Except") or node.kind == "Join" and any(k in str(node.fields.get("joinType")) for k in ("Semi", "Anti")):
        return below[0]
    more = [_id(e) for f in ("windowExpressions", "generatorOutput", "output") for e in _expressions(node.fields.get(f, []))]
    return ([] if node.kind in ("Expand", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas") else [x for b in below for x in b]) + more


def _scans(df: DataFrame) -> list[str]:
    """Folder names of the plan's leaves, in preorder."""
    leaves, out = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        try:
            parts = leaf.relation().location().rootPaths().head().toString().rstrip("/").split("/")
            # a scratch folder has a number behind its name
            out.append((parts[-2] if re.fullmatch("[0-9a-f]{32}", parts[-1]) else parts[-1]).removesuffix(".parquet"))
        except Exception:  # a leaf that reads no files: rows that the driver gave
            out.append("")
    return out


def column_lineage(df: DataFrame) -> list[tuple[str, str, str]]:
    """``(output column, source table, source column)`` in order; a table is
    known by the last part of its path.  Columns made of literals only, or of
    rows that the driver gave, have no source; fields of a nested column share
    its sources."""
    plan = _tree(json.loads(df._jdf.queryExecution().analyzed().toJSON()))
    names, of = iter(_scans(df)), {}  # id -> {(table, column)} of a scan
    made: dict[str, set[str]] = {}    # id -> ids it is computed from

    def visit(node: _Node) -> None:
        if not node.children:
            table = next(names, "")
            for e in _expressions(node.fields.get("output", [])):
                if table:
                    of.setdefault(_id(e), set()).add((table, e[0]["name"]))
            return
        for c in node.children:
            visit(c)
        for f, value in node.fields.items():
            for e in _expressions(value):
                for k, part in enumerate(e):
                    if part["class"].endswith(".Alias"):
                        made.setdefault(_id(e[k:]), set()).update(_uses(_subtree(e, k)))
        if node.kind == "Generate":
            uses = {u for e in _expressions(node.fields["generator"]) for u in _uses(e)}
            for e in _expressions(node.fields["generatorOutput"]):
                made.setdefault(_id(e), set()).update(uses)
        if node.kind in ("Union", "Intersect", "Except"):
            sides = [_output(c) for c in node.children]
            for first, *others in zip(*sides, strict=True):
                made.setdefault(first, set()).update(o for o in others if o != first)

    def _subtree(e: list[dict], k: int) -> list[dict]:
        end, open_ = k, 1
        while open_:
            open_ += e[end]["num-children"] - 1
            end += 1
        return e[k:end]

    visit(plan)

    def sources(start: str) -> set[tuple[str, str]]:
        seen, todo, found = {start}, [start], set()
        while todo:
            x = todo.pop()
            found |= of.get(x, set())
            for y in made.get(x, ()):
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return found

    return sorted((name, table, column) for name, x in zip(df.columns, _output(plan), strict=True) for table, column in sources(x))


def tables_read(df: DataFrame) -> list[str]:
    """The tables that the plan scans."""
    return sorted({t for t in _scans(df) if t})
