"""Secret scan with a trigram index.

From each rule's regular expression follow the trigrams that any match must hold: a Boolean query, kept
as alternatives of which all trigrams are needed. The index has a posting (trigram, document) for every
trigram that some rule asks for. Postings of an alternative are intersected by counting them per
document; only documents that a rule's query leaves are verified with its expression. A rule without
mandatory trigrams (hex) scans all texts. Everything is a column expression; nothing runs in Python.

The index is over lower-cased text, so it may name a document too many, never one too few.

Defined cases: a null text is empty; a row is known by its id and text, and rows that repeat both get
the same spans; positions are code points from 0, ends exclusive; matches are leftmost and do not
overlap within a rule, also with matches that are dropped for a short value, while spans of different
rules may overlap; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import literal_array, text_of
from tradewinds.operators.materialise import materialise

_MOST_BRANCHES = 64  # a part of a pattern with more alternatives counts as anything
_MOST_LETTERS = 8  # as does a class of more letters


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `value` has at least `least` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


# Fixed: the first three and their order. A run of at least n characters of a class is a maximal run, as it is
# taken leftmost and greedily, so `{n,}` finds what `+` and a test of the length would.
BASE_RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
MORE_RULES = [
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@"),
]
RULES = BASE_RULES + MORE_RULES


# ---- trigram queries of expressions -------------------------------------------------------------

@dataclass(frozen=True)
class _Branch:
    """One way to match: text `head`, or `head`, then anything that holds the trigrams `need`, then `tail`."""

    head: str = ""
    need: frozenset[str] = frozenset()
    tail: str = ""
    closed: bool = False

    def then(self, other: _Branch) -> _Branch:
        if not self.closed:
            return _Branch(self.head + other.head, other.need, other.tail, other.closed)
        if not other.closed:
            return _Branch(self.head, self.need, self.tail + other.head, True)
        return _Branch(self.head, self.need | trigrams(self.tail + other.head) | other.need, other.tail, True)


_NOTHING, _ANYTHING = _Branch(), _Branch(closed=True)


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _chain(parts: Iterable[set[_Branch]]) -> set[_Branch]:
    whole = {_NOTHING}
    for part in parts:
        if len(whole) * len(part) > _MOST_BRANCHES:
            part = {_ANYTHING}
        whole = {left.then(right) for left in whole for right in part}
    return whole


def _letters(members) -> set[str] | None:
    """Lower-cased members of a class, None if they are many."""
    found = set()
    for op, value in members:
        name = str(op)
        if name == "LITERAL":
            found.add(chr(value).lower())
        elif name == "RANGE" and value[1] - value[0] < _MOST_LETTERS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= _MOST_LETTERS else None


def _branches(op, value) -> set[_Branch]:
    name = str(op)
    if name == "LITERAL":
        return {_Branch(chr(value).lower())}
    if name == "IN":
        letters = _letters(value)
        return {_Branch(c) for c in letters} if letters else {_ANYTHING}
    if name == "SUBPATTERN":
        return _sequence(value[-1])
    if name == "BRANCH":
        found = set().union(*map(_sequence, value[1]))
        return found if len(found) <= _MOST_BRANCHES else {_ANYTHING}
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, body = value
        one = _sequence(body)
        if (least, most) == (0, 1):
            return one | {_NOTHING}
        again = [one] * min(int(least), 3)
        return _chain(again if least == most <= 3 else [*again, {_ANYTHING}])
    if name in ("AT", "ASSERT", "ASSERT_NOT"):
        return {_NOTHING}
    return {_ANYTHING}


def _sequence(parsed) -> set[_Branch]:
    return _chain(_branches(op, value) for op, value in parsed)


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives: every match holds all lower-cased trigrams of one of them. [] if some match need not hold any."""
    ways = {b.need | trigrams(b.head) | trigrams(b.tail) for b in _sequence(re._parser.parse(pattern))}
    if frozenset() in ways:
        return []
    return sorted((way for way in ways if not any(other < way for other in ways)), key=sorted)


# ---- index and lookup ---------------------------------------------------------------------------

def _key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), text_of()).alias("key")


def postings(docs: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The index: distinct rows (trigram number, document key) of the wanted trigrams, written in that order."""
    numbered = F.transform(literal_array([t.encode().hex() for t in wanted], "string"), lambda t, i: F.struct(
        F.decode(F.unhex(t), "UTF-8").alias("trigram"), i.alias("number")
    ))
    # the text is lower-cased once, as the only element of an array
    held = F.transform(F.array(F.lower(text_of())), lambda low: F.transform(
        F.filter(numbered, lambda t: F.contains(low, t["trigram"])), lambda t: t["number"]
    ))[0]
    rows = docs.select(_key(), F.explode(held).alias("trigram")).distinct()
    return materialise(rows.repartitionByRange("trigram", "key").sortWithinPartitions("trigram", "key"))


def candidates(index: DataFrame, wanted: Sequence[str], queries: Sequence[Sequence[frozenset[str]]]) -> DataFrame:
    """(key, rules): bit r is set for documents in the intersection of some alternative of rule r."""
    number = {trigram: i for i, trigram in enumerate(wanted)}
    asked = [
        (number[trigram], rule, way, len(alternative))
        for rule, query in enumerate(queries) for way, alternative in enumerate(query) for trigram in alternative
    ]
    if not asked:
        return index.select("key", F.lit(0).alias("rules")).limit(0)
    lookup = index.sparkSession.createDataFrame(asked, "trigram int, rule int, way int, size int")
    met = index.join(F.broadcast(lookup), "trigram").groupBy("key", "rule", "way", "size").agg(F.count(F.lit(1)).alias("held"))
    whole = met.filter("held = size").select("key", F.expr("shiftleft(1, rule)").alias("rule"))
    return materialise(whole.groupBy("key").agg(F.bit_or("rule").alias("rules")))


# ---- verification -------------------------------------------------------------------------------

def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, kind number, end) of a rule's matches: what lies between them is measured as well."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("value"),
    )
    span = "struct<start:bigint,kind:int,end:bigint>"

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["before"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        kept = F.when(F.length(part["value"]) >= rule.least, F.concat(state["spans"], found)).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    return F.aggregate(parts, start, add, lambda state: state["spans"])


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and spans (start, kind, end) by start, then rule as listed."""
    if len(rules) > 31:
        raise ValueError("at most 31 rules at once")
    queries = [trigram_query(rule.pattern) for rule in rules]
    wanted = sorted(set().union(*[way for query in queries for way in query]))
    rows = docs.select("doc_id", text_of().alias("text"), _key())
    if wanted:
        rows = rows.join(candidates(postings(docs, wanted), wanted, queries), "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(0))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    found = [
        F.when(F.col("rules").bitwiseAND(1 << number) != 0, spans_of(F.col("text"), rule, number)).otherwise(none)
        if queries[number] else spans_of(F.col("text"), rule, number)
        for number, rule in enumerate(rules)
    ]
    names = literal_array([rule.kind for rule in rules], "string")
    named = F.transform(F.array_sort(F.concat(*found)), lambda s: F.struct(
        s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end")
    ))
    return rows.select("doc_id", named.alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and text of the spans of a scan."""
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
