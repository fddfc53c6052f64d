"""License scans with a positional index of rare words.

Templates are word sequences with mandatory key phrases, and the index holds for each of their words
the places where templates have it. How rare a licence word is comes from its document frequency over
the whole table. A document looks up its rarest licence words in the index. Each hit proposes where a
template would begin; a place that enough of these words agree on is verified: the key phrases must
stand there in full, and at least `least` of the template's words must match.

Base phrases are looked for in the same numbered words. Everything of a document happens in its own
row; only frequencies of the licence words, which the templates bound, are added up.

Defined cases: a null text is empty and has no words; a phrase may begin at several places, and each
counts; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import LOWER, UPPER, WordTable, text_of
from tradewinds.operators.materialise import materialise

#: Letters A-Z are words' characters here because they are lower-cased afterwards.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # each a run of words of the text


# Opening or notice lines of common public licences.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "this program is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license as published",)),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("modify and or distribute this software for any purpose",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

# Phrases of the base rules and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Index:
    """Numbered licence words; templates, key places and postings by number."""

    def __init__(self, templates: Sequence[Template], phrases: Mapping[str, str]):
        words = sorted({w for t in templates for w in t.text.split()} | {w for p in phrases for w in p.split()})
        self.table = WordTable(words)
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.phrases = {tuple(self.number[w] for w in p.split()): label for p, label in phrases.items()}
        self.templates = []
        for t in templates:
            ids = [self.number[w] for w in t.text.split()]
            fixed: set[int] = set()
            for key in t.keys:
                run = [self.number[w] for w in key.split()]
                at = next(i for i in range(len(ids)) if ids[i:i + len(run)] == run)
                fixed.update(range(at, at + len(run)))
            self.templates.append((t.label, ids, sorted(fixed)))


def numbered(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, n_words, base places and, if some template's key words all occur, the numbered words.

    `listed` has the distinct licence words of the document.
    """
    def number(word: Column) -> Column:
        # lower() is right for the ASCII words of the table; the second look takes A-Z alone
        found = index.table.number(F.lower(word))
        return F.when((found > 0) & (F.lower(word) == F.translate(word, UPPER, LOWER)), found).otherwise(0)

    rows = docs.select("doc_id", F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0)).alias("_words"))
    rows = rows.select("doc_id", F.transform("_words", number).alias("_ids"))
    rows = rows.withColumn("_listed", F.array_distinct(F.filter("_ids", lambda x: x > 0)))
    labels = sorted(set(index.phrases.values()))

    def begins(label: str) -> Column:
        """Places of the phrases with a label; looked for only if all their words occur."""
        runs = [run for run, name in index.phrases.items() if name == label]
        def starts(x: Column, i: Column) -> Column:
            fits = [
                _all([x == run[0], *[F.coalesce(F.get(F.col("_ids"), i + k) == run[k], F.lit(False)) for k in range(1, len(run))]])
                for run in runs
            ]
            return F.when(_any(fits), i)

        occur = _any([_all([F.array_contains("_listed", x) for x in set(run)]) for run in runs])
        places = F.filter(F.transform("_ids", starts), lambda x: x.isNotNull())
        return F.when(occur, places).otherwise(F.array().cast("array<int>"))

    rows = rows.select("*", *[begins(label).alias(f"_base{i}") for i, label in enumerate(labels)])
    hopeful = _any([
        _all([F.array_contains("_listed", x) for x in sorted({ids[k] for k in keys})]) for _, ids, keys in index.templates
    ]) if index.templates else F.lit(False)
    return rows.select(
        "doc_id", F.size("_ids").alias("n_words"), F.concat(*[F.col(f"_base{i}") for i in range(len(labels))]).alias("base"),
        F.filter(F.array(*[F.when(F.size(f"_base{i}") > 0, F.lit(label)) for i, label in enumerate(labels)]), lambda x: x.isNotNull()).alias("base_found"),
        F.col("_listed").alias("listed"), F.when(hopeful, F.col("_ids")).alias("ids"),
    )


def _all(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def _any(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def _share_at(ids: Sequence[int], keys: Sequence[int], least: float):
    """Function: start -> share of template words that stand there; 0 unless verified."""
    template = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).alias("x")) for k, x in enumerate(ids)])

    def stands(place: Column, word) -> Column:
        return F.coalesce(F.get(F.col("ids"), place) == word, F.lit(False))

    def share(start: Column) -> Column:
        words = F.aggregate(template, F.lit(0), lambda n, t: n + stands(start + t["k"], t["x"]).cast("int")) / len(ids)
        return F.when(_all([stands(start + k, ids[k]) for k in keys]) & (words >= least), words).otherwise(F.lit(0.0))

    return share


def scan(
    docs: DataFrame, *, templates: Sequence[Template] = TEMPLATES, phrases: Mapping[str, str] = BASE,
    rare: int = 8, least: float = 0.8,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score per document.

    `rare` is the number of a document's rarest licence words that are looked up in a template's
    postings; `least` is the share of template words that must match. The score is the greatest share
    of a verified template, 0 without one.
    """
    index = Index(templates, phrases)
    rows = materialise(numbered(docs, index))
    seen = rows.select(F.explode("listed").alias("word")).groupBy("word").count().collect()  # licence words only
    frequency = {r["word"]: r["count"] for r in seen}

    found = []
    for label, ids, keys in index.templates:
        # the template's words from rare to common; every document takes the first it has
        order = sorted(set(ids), key=lambda x: (frequency.get(x, 0), x))
        ranked = F.array(*map(F.lit, order))
        seeds = F.slice(F.filter(ranked, lambda x: F.array_contains(F.col("listed"), x)), 1, rare)
        seeds = F.when(F.col("ids").isNotNull() & _all([F.array_contains("listed", x) for x in sorted({ids[k] for k in keys})]), seeds)
        found.append((label, ids, keys, seeds))
    rows = rows.select("*", *[seeds.alias(f"_seeds{i}") for i, (*_, seeds) in enumerate(found)])

    shares = []
    for i, (label, ids, keys, _) in enumerate(found):
        postings = {x: [k for k, y in enumerate(ids) if y == x] for x in sorted(set(ids))}
        lists = F.array(*[F.array(*map(F.lit, postings[x])) for x in postings])
        turn = {x: n for n, x in enumerate(postings)}
        place = F.array(*[F.lit(turn.get(x, -1)) for x in range(len(index.number) + 1)])
        hits = F.filter(
            F.transform("ids", lambda x, at: F.struct(x.alias("x"), at.alias("at"))), lambda h: F.array_contains(F.col(f"_seeds{i}"), h["x"])
        )
        starts = F.flatten(F.transform(hits, lambda h: F.transform(F.get(lists, F.get(place, h["x"])), lambda q: h["at"] - q)))
        rows = rows.withColumn(f"_starts{i}", F.when(F.size(f"_seeds{i}") > 0, F.sort_array(starts)))

        # agreed: as many of the looked-up words as a match of `least`, by the test of _share_at, must have there
        misses = max(m for m in range(len(ids) + 1) if m == 0 or (len(ids) - m) / len(ids) >= least)
        agree = F.greatest(F.lit(1), F.size(f"_seeds{i}") - F.lit(misses))
        column = F.col(f"_starts{i}")
        agreed = F.array_distinct(F.filter(
            F.transform(column, lambda s, j: F.when(F.get(column, j + agree - 1) == s, s)), lambda s: s.isNotNull()
        ))

        shares.append((label, F.coalesce(F.array_max(F.transform(agreed, _share_at(ids, keys, least))), F.lit(0.0))))
    rows = rows.select("*", *[s.alias(f"_share{i}") for i, (_, s) in enumerate(shares)])
    matched = [F.when(F.col(f"_share{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(shares)]
    labels = F.array_union("base_found", F.filter(F.array(*matched), lambda x: x.isNotNull())) if matched else F.col("base_found")
    score = F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"_share{i}") for i in range(len(shares))])
    return rows.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base").cast("bigint").alias("first_word"), F.array_max("base").cast("bigint").alias("last_word"),
        F.array_join(F.sort_array("base_found"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(labels)), ",").alias("labels"), score.alias("score"),
    )
