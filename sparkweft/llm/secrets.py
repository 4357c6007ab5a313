"""Secret scans over a trigram inverted index.

For each rule a Boolean trigram query is derived from its regular expression: a disjunction of
conjunctions of trigrams that every match must contain. The index posts every document under all trigrams of its text,
so it serves any rules, and later ones without another scan. The lists that a rule's query names are
intersected; the documents that remain are candidates, and only they are scanned with the rule. Rules without a
mandatory trigram scan every text.

Trigrams are taken from lower-cased text, and queries ignore case, so a candidate set only errs by
being too large. A posting names a document by a hash of its id and text; a clash of hashes can only
add a candidate.

Only DataFrame functions run here. Spans count code points, their end is exclusive.

Defined results: null text counts as empty; an empty table gives an empty result; repeated rows are scanned
each; other columns stay, whatever their names, except one named like the result column, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_prefix, own, small, written

#: Alternatives followed while a query is derived; beyond it the strings so far are turned into trigrams.
MAX_STRINGS = 256
#: Characters of a text whose trigrams are taken at a time.
BLOCK = 4096


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern whose group has at least least characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([_either("password"), _either("passwd"), _either("secret"), _either("token"), _either("api") + "_?" + _either("key")])

# The three base kinds. Runs of AKIA... and of hex digits are maximal, so their least length can stand in the pattern.
BASE = (
    Rule("assign", rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Kinds beyond the base: formats that their issuers publish.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def _strings(node: tuple) -> set[str] | None:
    """All strings a piece of a pattern can match, lower-cased; None where they are too many."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        if any(str(k) not in ("LITERAL", "RANGE") for k, _ in arg):
            return None
        chars: set[str] = set()
        for kind, x in arg:
            chars |= {chr(x).lower()} if str(kind) == "LITERAL" else {chr(c).lower() for c in range(x[0], min(x[1], x[0] + 99) + 1)}
        return chars if len(chars) <= 6 else None
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        found = [_sequence(x) for x in arg[1]]
        return None if any(x is None for x in found) else set().union(*found)
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = arg
        one = _sequence(inner)
        if one is None or high > 4:
            return None
        grown, out = {""}, ({""} if low == 0 else set())
        for n in range(1, high + 1):
            grown = {a + b for a in grown for b in one}
            if n >= low:
                out |= grown
        return out if len(out) <= MAX_STRINGS else None
    return None


def _sequence(nodes: Iterable) -> set[str] | None:
    out = {""}
    for node in nodes:
        if (more := _strings(node)) is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of trigrams of which every match contains one whole set; empty: no trigram is mandatory.

    Runs of pieces with few strings give a disjunction each; the most selective one, that with the
    fewest sets and the longest of them, is kept.
    """
    runs: list[set[str]] = []
    at = {""}

    def walk(nodes: Iterable) -> None:
        nonlocal at
        for node in nodes:
            found = _strings(node)
            if found is not None and len(at) * len(found) <= MAX_STRINGS:
                at = {a + b for a in at for b in found}
                continue
            runs.append(at)
            at = {""}
            if found is not None:
                at = found
            elif str(node[0]) == "SUBPATTERN":
                walk(node[1][3])
            elif str(node[0]) in ("MAX_REPEAT", "MIN_REPEAT") and node[1][0] >= 1:
                walk(node[1][2])
                runs.append(at)
                at = {""}

    walk(parser.parse(pattern))
    runs.append(at)
    queries = []
    for run in runs:
        if all(len(s) >= 3 for s in run):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            queries.append(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))
    return min(queries, key=lambda q: (len(q), -min(map(len, q)))) if queries else []


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What a posting names a document by."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def inverted_index(docs: DataFrame, text: Column, key: Column) -> DataFrame:
    """The index's postings (trigram, doc): every trigram of every lower-cased text, whatever rules will ask for.

    A text is cut into blocks that overlap by two characters, so no array grows with the text; a
    trigram may be posted once for each block.
    """
    blocks = F.regexp_extract_all(F.lower(text), F.lit(rf"(?s)(?=(.{{3,{BLOCK + 2}}})).{{1,{BLOCK}}}"), F.lit(1))
    rows = docs.select(key.alias("doc"), F.explode(blocks).alias("block"))
    return rows.select(F.explode(F.array_distinct(F.regexp_extract_all("block", F.lit("(?s)(?=(...))"), F.lit(1)))).alias("trigram"), "doc")


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(doc, rules): by intersecting postings, the numbers of the rules whose query a document meets."""
    asked = sorted(set().union(*(s for q in queries.values() for s in q)))
    has = index.where(F.col("trigram").isin(asked)).groupBy("doc").agg(F.collect_set("trigram").alias("has"))  # at most the asked ones
    met = []
    for n, query in queries.items():
        any_of = F.lit(False)
        for conjunction in query:
            every = F.lit(True)
            for t in sorted(conjunction):
                every = every & F.array_contains("has", t)
            any_of = any_of | every
        met.append(F.when(any_of, F.lit(n)))
    return has.select("doc", F.array_compact(F.array(*met)).alias("rules")).where(F.size("rules") > 0)


def _found(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in a text: array of (start, kind as number, end).

    Matches lie between the pieces of a split by the same pattern, so lengths of pieces and matches
    added up give positions.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    empty = F.array().cast("array<struct<start:long,kind:int,end:long>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        kept = x["match"].isNotNull() & (F.length(x["part"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    return F.aggregate(parts, start, add, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, *, text: str = "text", doc_id: str = "doc_id", output: str = "spans", index: DataFrame | None = None) -> DataFrame:
    """Docs with column output: all spans of a text in order of start, as array of (start, kind, end); kind is the rule's place.

    index: postings that inverted_index made of the same docs before, keyed by document_key; without it they are made.
    """
    if not rules:
        raise ValueError("no rules")
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    body, p = F.coalesce(F.col(text), F.lit("")), free_prefix(docs)
    empty = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    rows = docs
    if queries:
        index = written(inverted_index(docs, body, document_key(doc_id, text)), "secret-postings") if index is None else index
        found = written(candidates(index, queries), "secret-candidates").withColumnRenamed("doc", p + "doc").withColumnRenamed("rules", p + "rules")
        rows = rows.join(small(found, 32 + 4 * len(rules)), document_key(doc_id, text) == F.col(p + "doc"), "left")
    spans = []
    for n, rule in enumerate(rules):
        asked_for = F.coalesce(F.array_contains(p + "rules", n), F.lit(False)) if n in queries else body.rlike(rule.pattern)
        spans.append(F.when(asked_for, _found(body, rule, n)).otherwise(empty))
    keep = [c for c, name in zip(own(docs), docs.columns, strict=True) if name.lower() != output.lower()]
    return rows.select(*keep, F.array_sort(F.concat(*spans)).alias(output))


def spelled(spans: Column, rules: Sequence[Rule] = BASE + MORE) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redacted(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, *, text: str = "text", doc_id: str = "doc_id", mask: str = "[SECRET]") -> DataFrame:
    """Docs with the text of every span replaced by mask; overlapping spans are replaced as one. Null texts stay null."""
    spans = free_prefix(docs) + "spans"
    found = scan(docs, rules, text=text, doc_id=doc_id, output=spans)

    def cut(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        gap = F.col(text).substr((acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mask))).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.col(text).substr((acc["at"] + 1).cast("int"), F.length(text)))
    clean = F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, start, cut, rest))
    return found.withColumn(text, clean).select(*own(docs))
