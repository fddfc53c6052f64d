"""Phrase mining, secret scan and filter audit against brute force and against SQL."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.llm.helpers import SMALL, awkward, clashing, empty, frame, given, same_rows
from tradewinds.llm import filteraudit, phrases, secretscan
from tradewinds.llm.oracle import EXPECTED
from tradewinds.llm.queries import QUERIES


@pytest.fixture(scope="module")
def rows(spark):
    return awkward(spark).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (3, None, None), (10, 1, 1), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_secret_scan", "op13_filter_audit"])
def test_queries_equal_their_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), EXPECTED[name]) is None


# ---- phrases ----------------------------------------------------------------------------------

def brute_collocations(docs, longest=4, least=30, percent=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i:i + size])] += 1
    result = []
    for lang, f in counts.items():
        kept = {p: n for p, n in f.items() if n >= least}
        rows = []
        for phrase, a in kept.items():
            if len(phrase) < 2:
                continue
            longer = [n for p, n in kept.items() if len(p) > len(phrase)
                      and any(p[i:i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))]
            if any(100 * n >= percent * a for n in longer):
                continue
            cuts = [(2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def pairs(df):
    return [(r.text, r.lang) for r in df.collect()]


def as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed", range(2))
def test_collocations_of_few_words(spark, seed):
    """Few words repeat in many ways, overlaps, tabs, breaks and capitals among them."""
    draw = random.Random(seed)
    vocabulary = ["Aa", "b", "ü", "d", "aa", "B", "e", "f.", "g\tb", "aa,aa", "\n", "\x0b", "x", "y"]
    docs = frame(spark, [
        (i, "".join(draw.choice(vocabulary) + draw.choice([" ", "  ", "\t"]) for _ in range(draw.randint(0, 60))), draw.choice(["en", "en", "de", None]))
        for i in range(200)
    ])
    for least, top in ((3, 2000), (30, 5)):
        expected = brute_collocations(pairs(docs), least=least, top=top)
        assert expected and as_rows(phrases.collocations(docs, least=least, top=top)) == expected


def test_collocations_with_a_full_bit_map_and_small_blocks(spark, monkeypatch):
    """Hashes that let everything through, blocks of a few texts and sums in parts change nothing."""
    docs = given(spark).limit(60).cache()
    expected = brute_collocations(pairs(docs), least=10)
    assert as_rows(phrases.collocations(docs, least=10)) == expected
    everything = (16, np.full(1 << 10, 2**64 - 1, dtype=np.uint64))
    monkeypatch.setattr(phrases, "_bit_map", lambda groups: everything)
    assert as_rows(phrases.collocations(docs, least=10)) == expected


def test_collocations_of_awkward_rows(spark, rows):
    expected = brute_collocations(pairs(rows), least=2)
    assert as_rows(phrases.collocations(rows, least=2)) == expected
    same_rows(phrases.collocations(rows, least=2), phrases.collocations(clashing(rows), least=2))
    assert phrases.collocations(empty(spark)).count() == 0
    assert phrases.collocations(frame(spark, [(None, None, None, None)] * 2)).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**15
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)], "lang string, phrase string, size int, n long")
    assert phrases.scored(counts).first().score == 2000000 * (big - 1) // (2 * big + 1)


def test_counts_of_phrases_leave_no_shuffle_files(spark, monkeypatch):
    """The shuffles of all lengths together would fill the disks: each goes when its counts are written."""
    moved, write = [], phrases.materialise

    def written(df, **how):
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            moved.append(how)
        return write(df, **how)

    monkeypatch.setattr(phrases, "materialise", written)
    texts = [(i, f"one two three four five w{i % 7}", "en") for i in range(300)]
    counts, totals = phrases.frequent_phrases(spark.createDataFrame(texts, "doc_id long, text string, lang string"), least=200)
    assert len(moved) == 9 and all(how.get("lean") for how in moved)
    assert [tuple(r) for r in totals.collect()] == [("en", 1800)]
    assert {(r["phrase"], r["n"]) for r in counts.filter("size = 4").collect()} == {("one two three four", 300), ("two three four five", 300)}


def test_phrase_rows_and_batches_stay_small():
    words = [f"w{i}" for i in range(300_000)]
    texts = [" ".join(words[i:i + 500]).encode() for i in range(0, len(words), 500)] * 2
    given = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    rows = list(phrases._occurrences(iter([given])))
    assert max(row.nbytes for row in rows) < 6 << 20
    assert sum(row.column(1)[0].as_py() for row in rows) == 2 * len(words)
    counted = list(phrases._group_counts(1)(iter(rows)))
    assert max(batch.num_rows for batch in counted) <= 1 << 16
    assert sum(n for batch in counted for n in batch.column(1).to_pylist()) == 2 * len(words)
    found = list(phrases._phrase_counts(1)(iter(rows)))
    assert max(batch.num_rows for batch in found) <= 1 << 16
    assert sum(n for batch in found for n in batch.column(2).to_pylist()) == 2 * len(words)


# ---- secrets ----------------------------------------------------------------------------------

def brute_spans(text, rules=secretscan.RULES):
    return [
        (m.start(), number, m.end())
        for number, rule in enumerate(rules) for m in re.finditer(rule.pattern, text or "", re.ASCII) if len(m[rule.value]) >= rule.least
    ]


SECRETS = [
    'password: "abcdefgh"', "PassWd='12345678", "token=secret:abcdefghij", "secret=short token==12345678", "api_key : x/y+z=.-_9",
    "APIKEY=aaaaaaaa", "paſsword=12345678", "toKen=12345678", "AKIAABCDEFGHIJKL", "AKIAAKIA AKIA1234567890ABXYZ", "0123456789abcdef" * 2, "f" * 31, "g" + "0a" * 40,
    "Bearer  abcdefghijklmnopqrstuvwxyz", "ghp_" + "aB3" * 13, "xoxb-1234567890-abc", "-----BEGIN RSA PRIVATE KEY-----", "postgres://me:pw@host/db",
    "eyJhbGciOi.eyJzdWIiOi.SflKxwRJSM", "AIza" + "x" * 35, "token =\n12345678", "token\x20\x20:\x20\"1234567\"",
]


def test_spans_of_planted_secrets(spark):
    draw = random.Random(3)
    filler = ["word", "ÄÖ", "🙂", "\n", "tok", "pass", "key", "the secret is out", "AKI", "://", "東京", " ", "=", '"']
    texts = ["".join(draw.choice(SECRETS if draw.random() < 0.4 else filler) + draw.choice(["", " ", "é"]) for _ in range(draw.randint(0, 25))) for _ in range(300)]
    docs = frame(spark, [(i, text) for i, text in enumerate(texts)] + [(1000 + i, s) for i, s in enumerate(SECRETS)])
    kinds = [rule.kind for rule in secretscan.RULES]
    got = {r.doc_id: [(s.start, kinds.index(s.kind), s.end) for s in r.spans] for r in secretscan.scan(docs).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == sorted(brute_spans(r.text)), r.text


@pytest.mark.parametrize("pattern, query", [
    ("abcd", [{"abc", "bcd"}]), ("ab(c|d)e", [{"abc", "bce"}, {"abd", "bde"}]), ("abc.*def", [{"abc", "def"}]), ("[0-9a-f]+", []), ("(abc)?", []),
    ("(?i:ABC)x*", [{"abc"}]), ("a{3}b+", [{"aaa", "aab"}]), ("abc|abcd", [{"abc"}]), ("(ab)+c", []), ("xy[abc]z", [{"xya", "yaz"}, {"xyb", "ybz"}, {"xyc", "ycz"}]),
])
def test_trigram_queries(pattern, query):
    assert sorted(map(sorted, secretscan.trigram_query(pattern))) == sorted(map(sorted, query))


def test_index_spares_documents(spark):
    """Documents without the trigrams of a rule are not verified; those with a match always are."""
    docs = given(spark)
    queries = [secretscan.trigram_query(rule.pattern) for rule in secretscan.RULES]
    wanted = sorted(set().union(*[way for query in queries for way in query]))
    found = secretscan.candidates(secretscan.postings(docs, wanted), wanted, queries)
    masks = {r.key: r.rules for r in found.collect()}
    keyed = {r.key: r.text for r in docs.select(secretscan._key(), "text").collect()}
    assert 0 < len(masks) < len(keyed) / 2
    for key, text in keyed.items():
        low = text.lower()
        for number, query in enumerate(queries):
            asked = any(all(t in low for t in way) for way in query)
            assert bool(masks.get(key, 0) >> number & 1) == asked


def test_digest_of_spans(rows, spark):
    for docs in (rows, given(spark)):
        got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secretscan.digest(secretscan.scan(docs)).collect())
        expected = []
        for r in docs.collect():
            spans = [(s, k, f"{secretscan.RULES[k].kind}:{s}:{e}") for s, k, e in sorted(brute_spans(r.text))]
            base = ",".join(t for _, k, t in spans if k < 3)
            counts = [sum(k == n for _, k, _ in spans) for n in range(3)]
            expected.append((str(r.doc_id), *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(t for *_, t in spans)))
        assert got == sorted(expected)


def test_scan_of_awkward_tables(spark, rows):
    same_rows(secretscan.scan(rows), secretscan.scan(clashing(rows)))
    assert secretscan.scan(empty(spark)).count() == 0
    assert secretscan.scan(rows, [secretscan.Rule("hex", "[0-9a-f]{32,}")]).count() == rows.count()
    repeated = frame(spark, [(1, SECRETS[0])] * 40 + [(None, None)] * 3)
    assert {r.n for r in secretscan.scan(repeated).groupBy("spans").agg(F.count("*").alias("n")).collect()} == {40, 3}


# ---- filter audit -----------------------------------------------------------------------------

def brute_audit(docs, labels):
    first = {}
    for r in docs:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    parts = defaultdict(list)
    for r in docs:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": r.doc_id is not None and r.doc_id > first[text],
        }
        parts[r.source or ""].append((fails, r.doc_id in good, r.doc_id in toxic))
    result = []
    for part, members in parts.items():
        by_filter, lines = Counter(), []
        for order in permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                gone = [m for m in left if m[0][name]]
                left = [m for m in left if not m[0][name]]
                failing = sum(m[0][name] for m in members)
                alone = sum(m[0][name] and sum(m[0].values()) == 1 for m in members)
                by_filter[name] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(m[1] for m in gone), sum(m[2] for m in gone)))
        result += [(*line, by_filter[line[1][line[2] - 1]]) for line in lines]
    return sorted(result)


def test_audit_of_awkward_rows(spark, rows, labels):
    expected = brute_audit(rows.collect(), labels.collect())
    for docs in (rows, clashing(rows)):
        assert sorted(tuple(r) for r in filteraudit.audit(docs, labels.withColumn("text", F.lit("x"))).collect()) == expected
    assert filteraudit.audit(empty(spark), labels).count() == 0


def test_audit_with_copies_in_and_across_parts(spark, labels):
    draw = random.Random(8)
    texts = ["word " * 60, " ".join(map(str, range(80))), "A" * 30 + " #", "", None, "short # |"]
    docs = frame(spark, [(draw.choice([None, *range(40)]), draw.choice(texts), "en", draw.choice(["a", "a", "", None])) for _ in range(300)])
    assert sorted(tuple(r) for r in filteraudit.audit(docs, labels).collect()) == brute_audit(docs.collect(), labels.collect())
    without = filteraudit.audit(docs, labels.limit(0))
    assert without.agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)


def test_audit_of_other_filters(spark, labels):
    docs = frame(spark, [(1, "a b"), (2, "a"), (3, "b")])
    report = filteraudit.audit(docs, labels, {"x": F.col("text").contains("a"), "y": F.col("text").contains("b")}).collect()
    assert {(r.filter_order, r.step, r.removed, r.redundant, r.shapley) for r in report} == {
        ("xy", 1, 2, 0, 3), ("xy", 2, 1, 1, 3), ("yx", 1, 2, 0, 3), ("yx", 2, 1, 1, 3),
    }
    with pytest.raises(ValueError):
        filteraudit.audit(docs, labels, {str(i): F.lit(True) for i in range(7)})
