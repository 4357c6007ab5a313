"""Patterns of DOT text and what is read from single pieces of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide what a document holds, and the attributes that tell methods apart.
#: An edge line: the type is the last label of the line; anything may follow the end.
EDGE = r'(?dU)^"([^"]+)"\s*->\s*"([^"]+)"\s*\[.*label="([^"]+)".*\];'
#: An edge line with all that stands between its brackets.
EDGE_ATTRIBUTES = r'(?dU)^"([^"]+)"\s*->\s*"([^"]+)"\s*\[(.*?)\];'
#: A node block: from a line that opens one to the first line that ends in `"];`, or to the end of the document.
NODE = r'(?dmU)^[^\S\n]*"([^"\n]+)"[^\S\n]*\[[\s\S]*?(?:"\];[^\S\n]*$|\z)'
#: The id of a node block.
NODE_ID = r'(?dU)^[^\S\n]*"([^"\n]+)"'
#: The attributes of a node, up to the first `];`.
NODE_ATTRIBUTES = r'(?sU)"[^"]+"\s*\[(.*?)\];'
PAIR = r'(?U)(\w+)=(?:"([^"]*(?:\\.[^"]*)*)"|([^\s]+))'
#: A pair whose value runs on across balanced quotes: a node with several attributes mostly gives a single one.
RUNNING_PAIR = r'(?U)(\w+)="([^"]*(?:"[^"]*"[^"]*)*)"'

METHOD_ATTRIBUTES = ("label", "IS_EXTERNAL", "NAME", "FULL_NAME", "FILENAME", "AST_PARENT_FULL_NAME")


def attribute(raw: Column, key: str, strict: bool = False) -> Column:
    """A value by the leftmost `key="`, empty where there is none. Unless strict, the key may be the tail of a longer one."""
    return F.regexp_extract(raw, ("\\b" if strict else "") + f'{key}="([^"]*)"', 1)


def method_attributes(raw: Column, strict: bool = False) -> list[Column]:
    return [attribute(raw, key, strict).alias(key.lower()) for key in METHOD_ATTRIBUTES]


def is_user_method(label: Column, is_external: Column, name: Column, full_name: Column, filename: Column, ast_parent: Column) -> Column:
    """Whether a node is a method that the program itself defines."""
    operator = F.startswith(name, F.lit("<operator>")) | F.startswith(full_name, F.lit("<operator>"))
    foreign = filename.isin("<includes>", "<empty>", "") | F.contains(ast_parent, F.lit("<includes>"))
    return (label == "METHOD") & (F.lower(is_external) != "true") & ~operator & ~name.isin("<clinit>", "<global>") & ~foreign


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed a single time however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def pairs(text: Column) -> Column:
    """Attributes as array of (k, v), in order; a later value of a key replaces the earlier one, in its place."""

    def every(t: Column) -> Column:
        part = lambda n: F.regexp_extract_all(t, F.lit(PAIR), F.lit(n))
        values = F.zip_with(part(2), part(3), lambda q, b: F.when(q != "", q).otherwise(b))
        return F.zip_with(part(1), values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))

    def last(all_: Column) -> Column:
        keys = F.array_distinct(F.transform(all_, lambda x: x["k"]))
        value = lambda k: F.element_at(F.filter(all_, lambda x: x["k"] == k), -1)["v"]
        # Where no key repeats, as nearly always, the pairs are the answer.
        return F.when(F.size(keys) == F.size(all_), all_).otherwise(F.transform(keys, lambda k: F.struct(k.alias("k"), value(k).alias("v"))))

    return once(once(text, every), last)


def running_pairs(raw: Column) -> Column:
    """What the attribute check compares: pairs whose values run across balanced quotes, by key."""
    keys = F.regexp_extract_all(raw, F.lit(RUNNING_PAIR), F.lit(1))
    values = F.regexp_extract_all(raw, F.lit(RUNNING_PAIR), F.lit(2))
    return F.array_sort(F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v"))))


def marker_count(document: Column, edge_type: str) -> Column:
    """How often `[label="TYPE"` stands in a document; nodes whose first attribute it is count too."""
    return F.regexp_count(document, F.lit(rf'\[label="{edge_type}"'))


def looks_like_dot(document: Column) -> Column:
    return F.contains(F.substring(document, 1, 200), F.lit("digraph"))
