"""The steps on graphs, for documents that come as one text a graph: each graph inside its row, without a shuffle or a table between.

Same results as `graph`, `render` and `verify`, which take relations of any size apart over graphs; here no row is ever dealt out by graph,
so what a step holds on disk does not grow with the number of graphs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dot as D
from .graph import TYPES

#: Java's white space with Unicode; Python's has four separators more.
_OTHER = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000 "
_S, _H = rf"[\t-\r{_OTHER}]", rf"[\t\x0b-\r{_OTHER}]"
_edge = re.compile(rf'"([^"]+)"{_S}*->{_S}*"([^"]+)"{_S}*\[.*label="([^"]+)".*\];')
_node = re.compile(rf'^{_H}*"([^"\n]+)"{_H}*\[[\s\S]*?(?:"\];{_H}*$|\Z)', re.M)
_values = {key: re.compile(f'{key}="([^"]*)"') for key in D.METHOD_ATTRIBUTES}

#: Rows of a batch that are held as Python objects at a time.
ROWS = 512


def _value(raw: str, key: str) -> str:
    found = _values[key].search(raw)
    return found[1] if found else ""


def is_user_method(raw: str) -> bool:
    """As functions.dot.is_user_method, of a node's text."""
    if _value(raw, "label") != "METHOD" or _value(raw, "IS_EXTERNAL").lower() == "true":
        return False
    name = _value(raw, "NAME")
    if name.startswith("<operator>") or name in ("<clinit>", "<global>") or _value(raw, "FULL_NAME").startswith("<operator>"):
        return False
    return _value(raw, "FILENAME") not in ("<includes>", "<empty>", "") and "<includes>" not in _value(raw, "AST_PARENT_FULL_NAME")


class Text:
    """A document, parsed once: see `parse`."""

    def __init__(self, text: str | None) -> None:
        self.text = (text or "").replace("\r\n", "\n").replace("\r", "\n")

    @cached_property
    def edges(self) -> list[tuple[str, str, str, str]]:
        """(src, dst, etype, line) in order."""
        return [(*found.groups(), line) for line in self.text.split("\n") if "->" in line and (found := _edge.match(line.strip()))]

    @cached_property
    def nodes(self) -> list[tuple[str, str]]:
        """(node_id, raw) in order."""
        return [(m[1], m[0]) for m in _node.finditer(self.text)]

    @cached_property
    def last(self) -> dict[str, str]:
        return dict(self.nodes)

    @cached_property
    def users(self) -> set[str]:
        return {node for node, raw in self.last.items() if is_user_method(raw)}

    @cached_property
    def reached(self) -> set[str]:
        """User-defined methods and all that control flow leads to from them."""
        after: dict[str, list[str]] = {}
        for src, dst, etype, _ in self.edges:
            if etype == "CFG":
                after.setdefault(src, []).append(dst)
        seen, ahead = set(self.users), list(self.users)
        while ahead:
            for x in after.pop(ahead.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    ahead.append(x)
        return seen

    def user_nodes(self) -> list[tuple[str, str]]:
        return sorted((node, raw) for node, raw in self.last.items() if node in self.reached)

    def user_edges(self) -> list[tuple[str, str, str, str]]:
        """Control flow before calls."""
        flow = [e for e in self.edges if e[2] == "CFG" and e[0] in self.reached and e[1] in self.reached]
        return flow + [e for e in self.edges if e[2] == "CALL" and e[0] in self.reached and e[1] in self.users]


def _document(head: str, nodes: Iterable[str], lines: Iterable[str]) -> str:
    own = lambda rows: "".join(f"\n  {x}" for x in rows)
    return f"{head}\n\n  // Node definitions{own(nodes)}\n\n  // Edge definitions{own(lines)}\n}}\n"


def subgraph_of(text: Text, types: Sequence[str] = TYPES) -> str:
    """As render.subgraph_text."""
    kinds = sorted(types)
    lines = [e for e in text.edges if e[2] in kinds]
    ends = {x for e in lines for x in e[:2]}
    nodes = [x for x in text.nodes if x[0] in ends]
    head = f"digraph subgraph_{'_'.join(kinds)} {{\n  // Direct extraction from original DOT file\n  // Edge types: {', '.join(kinds)}\n  // Nodes: {len({x[0] for x in nodes})}, Edges: {len(lines)}"
    return _document(head, (x[1] for x in nodes), (e[3].strip() for e in lines))


def user_subgraph_of(text: Text, name: str = "CFG_CALL_original") -> str:
    """As render.user_subgraph_text."""
    nodes, lines = text.user_nodes(), text.user_edges()
    head = f"digraph udf_{name} {{\n  // UDF-filtered subgraph\n  // Only user-defined functions and their bodies\n  // Nodes: {len(nodes)}, Edges: {len(lines)}"
    return _document(head, (x[1] for x in nodes), (e[3] for e in lines))


def _said(category: str, *issues: tuple[object, str]) -> tuple[str, list[str]]:
    return category, [text for failed, text in issues if failed]


def subgraph_checks(original: Text, extracted: Text, types: Sequence[str] = TYPES) -> list[tuple]:
    """(category, issues, unlike) as verify.verify_subgraph; unlike: the texts of nodes whose attributes are still to be compared."""
    wanted = [e for e in original.edges if e[2] in types]
    before, after = Counter(e[2] for e in wanted), Counter(e[2] for e in extracted.edges)
    ours, theirs = {e[:3] for e in wanted}, {e[:3] for e in extracted.edges}
    ends, made = {x for e in wanted for x in e[:2]}, extracted.last
    other = sorted(set(after) - set(types))
    counts = [(before[t] != after[t], f"{t}: count mismatch ({before[t]} vs {after[t]})") for t in types]
    unlike = [{"a": original.last[x], "b": raw} for x, raw in made.items() if original.last.get(x, raw) != raw]
    return [
        (*_said("edges", *counts, (other, f"Unwanted edge types found: {', '.join(other)}"), (n := len(ours - theirs), f"Missing {n} edges"), (n := len(theirs - ours), f"Extra {n} edges")), []),
        (*_said("nodes", (n := len(ends - made.keys()), f"Missing {n} nodes"), (n := len(made.keys() - ends), f"Extra {n} nodes")), []),
        ("attributes", [], unlike),
    ]


def user_checks(original: Text, filtered: Text) -> list[tuple]:
    """(category, issues, unlike) as verify.verify_user_subgraph."""
    users, after = original.users, filtered.last
    lost = sorted(users - filtered.users)
    others = sum(_value(raw, "label") == "METHOD" and node not in users for node, raw in after.items())
    flow = sum(e[2] == "CFG" and not (e[0] in after and e[1] in after) for e in filtered.edges)
    calls = sum(e[2] == "CALL" and not (e[0] in after and e[1] in users) for e in filtered.edges)
    absent = sorted(after.keys() - original.last.keys())
    changed = sum(x in original.last and original.last[x].strip() != raw.strip() for x, raw in after.items())
    return [
        (*_said("udf_identification", (lost, f"Missing UDF methods: {', '.join(lost)}"), (others, f"External methods present: {others}")), []),
        (*_said("cfg_reachability", (n := len(original.reached - after.keys()), f"Missing CFG-reachable nodes: {n}"), (n := len(after.keys() - original.reached), f"Extra non-CFG-reachable nodes: {n}")), []),
        (*_said("edge_filtering", (flow, f"CFG edges with missing endpoints: {flow}"), (calls, f"CALL edges violating UDF rules: {calls}")), []),
        (*_said("node_integrity", *((True, f"Node {x} not found in original") for x in absent), (changed, f"Corrupted node definitions: {changed}")), []),
    ]


def _rows(documents: DataFrame, columns: list[str], of: Callable[..., Iterable[tuple]], fields: list[pa.Field], schema: str) -> DataFrame:
    """(graph_id, …): the rows that of() makes of the texts in columns."""
    kind = documents.schema["graph_id"].dataType.simpleString()
    made = pa.schema(fields)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), ROWS):
                batch = whole.slice(start, ROWS)
                at, rows = [], []
                for i, texts in enumerate(zip(*(batch.column(c).to_pylist() for c in columns), strict=True)):
                    for row in of(*map(Text, texts)):
                        at.append(i)
                        rows.append(row)
                values = [pa.array([r[n] for r in rows], f.type) for n, f in enumerate(made)]
                yield pa.RecordBatch.from_arrays([batch.column("graph_id").take(pa.array(at, pa.int64())), *values], names=["graph_id", *made.names])

    return documents.select("graph_id", *columns).mapInArrow(go, f"graph_id {kind}, {schema}")


_text = pa.string()
_checked = [pa.field("category", _text), pa.field("issues", pa.list_(_text)), pa.field("unlike", pa.list_(pa.struct([("a", _text), ("b", _text)])))]


def _checks(documents: DataFrame, columns: list[str], of: Callable[..., list[tuple]]) -> DataFrame:
    """(graph_id, category, passed, issues)."""
    rows = _rows(documents, columns, of, _checked, "category string, issues array<string>, unlike array<struct<a:string,b:string>>")
    n = F.size(F.filter("unlike", lambda x: ~D.running_pairs(x["a"]).eqNullSafe(D.running_pairs(x["b"]))))
    rows = rows.withColumn("n", F.when(F.size("unlike") > 0, n).otherwise(0))
    said = F.when(F.col("n") > 0, F.array(F.concat(F.col("n").cast("string"), F.lit(" nodes with attribute mismatches")))).otherwise(F.col("issues"))
    return rows.select("graph_id", "category", said.alias("issues")).select("graph_id", "category", (F.size("issues") == 0).alias("passed"), "issues")


def subgraph_text(documents: DataFrame, types: Sequence[str] = TYPES) -> DataFrame:
    """(graph_id, dot): the edge-type subgraph's document."""
    return _rows(documents, ["dot"], lambda t: [(subgraph_of(t, types),)], [pa.field("dot", _text)], "dot string")


def user_subgraph_text(documents: DataFrame) -> DataFrame:
    """(graph_id, dot, filtered): a document and that of its subgraph of user-defined methods."""
    return _rows(documents, ["dot"], lambda t: [(t.text, user_subgraph_of(t))], [pa.field("dot", _text), pa.field("filtered", _text)], "dot string, filtered string")


def user_nodes(documents: DataFrame) -> DataFrame:
    """(graph_id, node_id) of the subgraph of user-defined methods."""
    return _rows(documents, ["dot"], lambda t: ((node,) for node, _ in t.user_nodes()), [pa.field("node_id", _text)], "node_id string")


def edge_places(documents: DataFrame) -> DataFrame:
    """(graph_id, etype, n, first_place): for each type how many edges there are, and the place of its first among all edges."""

    def of(text: Text) -> list[tuple]:
        kinds = [e[2] for e in text.edges]
        return [(kind, n, kinds.index(kind)) for kind, n in Counter(kinds).items()]

    return _rows(documents, ["dot"], of, [pa.field("etype", _text), pa.field("n", pa.int64()), pa.field("first_place", pa.int64())], "etype string, n long, first_place long")


def verify_user_subgraph(documents: DataFrame) -> DataFrame:
    """All checks of `filtered` against `dot`, two texts of a row."""
    return _checks(documents, ["dot", "filtered"], user_checks)


def verify_made(documents: DataFrame) -> DataFrame:
    """All checks of both kinds on the documents that are made of `dot`; what was made is parsed as text again."""

    def of(original: Text) -> list[tuple]:
        sub = Text(subgraph_of(original))
        return subgraph_checks(original, sub) + user_checks(sub, Text(user_subgraph_of(sub)))

    return _checks(documents, ["dot"], of)
