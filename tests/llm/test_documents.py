"""Operators on documents against brute force in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, difference
from tests.llm.helpers import SMALL, awkward, frame, given
from tradewinds.llm import fingerprints, langid, licenses, linededup, quality
from tradewinds.llm.oracle import EXPECTED
from tradewinds.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", EXPECTED)
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), EXPECTED[name]) is None


# ---- language ID ------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    docs = given(spark, "/root/testdata/sf0.01")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang]
    assert len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = {r.doc_id: r for r in langid.identify(awkward(spark)).collect()}
    assert (rows[2].lang_pred, rows[2].score) == ("und", 0.0)
    assert rows[3].lang_pred == rows[6].lang_pred == rows[12].lang_pred == "und"
    assert rows[4].lang_pred != "und" and not rows[None].held_out


def test_no_labels(spark):
    assert {r.lang_pred for r in langid.identify(frame(spark, [(1, "some text", None), (2, "more", None)])).collect()} == {"und"}


def plain_grams(text, buckets):
    """Counts of hashed n-grams, one at a time."""
    runs = re.sub(r"[\W\d_]+", " ", text).lower()
    codes = [32, 32, *map(ord, runs.strip()), 32] if runs.strip() else []
    shift, mask, counts = 32 - (buckets.bit_length() - 1), (1 << 32) - 1, Counter()
    for i in range(2, len(codes)):
        first = codes[i] * 2654435761 & mask
        second = (first ^ (codes[i - 1] * 2246822519 & mask)) * 3266489917 & mask
        third = (second ^ (codes[i - 2] * 668265263 & mask)) * 374761393 & mask
        grams = [first] if codes[i] != 32 else []
        if codes[i] != 32 or codes[i - 1] != 32:
            grams += [second, third]
        counts.update(g >> shift for g in grams)
    return counts


def test_language_against_plain_naive_bayes(spark):
    buckets = 1 << 10
    docs = given(spark).select("doc_id", "text", "lang", "source", "n_chars")
    sums, texts = defaultdict(Counter), [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in texts}
    for d, text, lang in texts:
        if lang is not None and text is not None and not held[d]:
            sums[lang].update(plain_grams(text, buckets))
    got = {r.doc_id: r for r in langid.identify(docs, buckets=buckets).collect()}
    for d, text, _ in texts:
        grams = plain_grams(text or "", buckets)
        if not grams:
            assert got[d].lang_pred == "und"
            continue
        score = {}
        for lang in sorted(sums):
            total = sum(sums[lang].values()) + 0.1 * buckets
            score[lang] = math.fsum(n * math.log((sums[lang][g] + 0.1) / total) for g, n in grams.items())
        best = max(sorted(score), key=score.get)
        assert got[d].lang_pred == best and got[d].held_out == held[d]
        assert math.isclose(got[d].score, 1 / sum(math.exp(s - score[best]) for s in score.values()), rel_tol=1e-6)


def test_many_labels(spark, monkeypatch):
    own = ["".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=12)) for k in range(300)]
    rows = [(i, f"{own[i % 300]} common", f"l{i % 300:03d}") for i in range(900)]
    guessed = langid.identify(frame(spark, rows), buckets=1 << 15).collect()
    assert len(guessed) == 900 and len({r.lang_pred for r in guessed}) > 250
    assert len(quality.assess(frame(spark, rows[:60])).collect()) == 60
    monkeypatch.setattr(langid, "_MAX_CELLS", 10 * langid._LEAST_BUCKETS)
    monkeypatch.setattr(quality, "_MAX_LANGUAGES", 10)
    more = frame(spark, rows + [(1000 + i, "some more words", "l299") for i in range(9)])
    few = langid.identify(more).collect()
    assert len(few) == 909 and len({r.lang_pred for r in few}) == 10 and "l299" in {r.lang_pred for r in few}
    assert langid.keep_identified(more).count() > 0
    words = quality.common_words(more)
    assert len(words) == 10 and "l299" in words
    assert len(quality.assess(more).collect()) == 909


def test_grams_do_not_depend_on_blocks(monkeypatch):
    text = "Ein Satz, noch ein Satz!  Ende  " * 9
    whole = langid.gram_counts(text, 1 << 12)
    monkeypatch.setattr(langid, "_BLOCK", 7)
    assert (langid.gram_counts(text, 1 << 12) == whole).all()


def test_texts_in_no_learned_language_go(spark):
    docs = given(spark, "/root/testdata/sf0.01")
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = ["".join(draw.choice(letters + "    ") for _ in range(n)) for n in (100, 300, 2000) for _ in range(20)]
    greek = ["το γρήγορο καφέ ζώο πηδά πάνω από το σκυλί και φεύγει", "это текст на языке которого никто не учил и не видел"]
    more = frame(spark, [(10**6 + i, text, None) for i, text in enumerate(junk + greek)])
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(more), "").select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**6]
    clean = {r.doc_id for r in docs.collect() if r.lang and not re.search(r"[#*$%&|<>]", r.text) and r.text.upper() != r.text and len(r.text.split()) >= 5}
    assert len(clean) > 300 and len(clean - kept) <= 0.005 * len(clean)


# ---- licenses ---------------------------------------------------------------------------------

def scan_one(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, base, labels, score = [], set(), set(), 0.0
    for phrase, label in licenses.BASE.items():
        run = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(run)] == run]
        starts += found
        base |= {label} if found else set()
    for t in licenses.TEMPLATES:
        run = t.text.split()
        for start in range(-len(run), len(words)):
            here = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(run)]
            keys = []
            for key in t.keys:
                wanted = key.split()
                at = next(i for i in range(len(run)) if run[i:i + len(wanted)] == wanted)
                keys += here[at:at + len(wanted)]
            if all(keys) and sum(here) / len(run) >= 0.8:
                labels.add(t.label)
                score = max(score, sum(here) / len(run))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def test_licenses_against_every_place(spark):
    draw = random.Random(5)
    rows = [(1, None), (2, ""), (3, "CC-BY all rights reserved. All Rights. Reserved ALL RIGHTS RESERVED"), (4, "cc\x00by ccby c c by")]
    for i in range(5, 60):
        words = []
        for _ in range(draw.randint(0, 6)):
            template = draw.choice(licenses.TEMPLATES).text.split()
            words += [w if draw.random() > 0.08 else draw.choice(["foo", "the", "É"]) for w in template[draw.randint(0, 2):]]
            words += draw.choices(["the", "of", "license", "bar", "KELVIN", "Kind"], k=draw.randint(0, 5))
        rows.append((i, draw.choice([" ", "-", "\n"]).join(words).title()))
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame(spark, rows)).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == scan_one(text), text


def test_licenses_at_the_very_share(spark):
    """A missing template word that stands elsewhere in the document is looked up, but does not agree."""
    isc = next(t.text for t in licenses.TEMPLATES if t.label == "isc").split()
    rows = [(1, "Released today. Licensed under the MIT license."), (2, "MIT license. Released under MIT license the")]
    for i, gone in enumerate([{0, 1, 2, 3}, {14, 15, 16, 17}, {0, 1, 18, 19}, {0, 1, 2, 18, 19}]):
        words = ["foo" if k in gone else w for k, w in enumerate(isc)]
        rows.append((10 + i, " ".join([isc[k] for k in sorted(gone)] + ["bar"] + words)))
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame(spark, rows)).collect()}
    assert got[1][-2:] == ("mit", 0.8)
    for doc_id, text in rows:
        assert got[doc_id] == scan_one(text), text


# ---- quality ----------------------------------------------------------------------------------

def base_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice([" ", "\n", "\t"]).join(draw.choices(["a", "b", "é🙂", "#|x"], k=draw.randint(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "one two three four five six seven eight " * 4), (103, "x\n\nx\n \n \nx")]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in quality.assess(docs).collect()}
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(text), text


def test_texts_are_gone_over_once_for_the_counts(spark):
    """Characters are counted in what the commonest class leaves of a text, and windows are joined from halves."""
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choices("ab", k=i % 20))) for i in range(200)]
    rows += [(200, "a b c d e f g h " * 2), (201, "a b c d e f g h a b c d e f g"), (202, "ABC def\u00a0\u00c9\u00e9 \u0130\U0001f642\x0b%9.\x1c")]
    measured = quality.measure(frame(spark, rows), ["a", "def"])
    got = {r.doc_id: r for r in measured.collect()}
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(text)[:5], text
        assert r.classes == [len(re.sub(rest, "", text)) for rest in quality.CLASSES.values()]
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(_text#") == 1


def js(p, q):
    out = 0.0
    for key in set(p) | set(q):
        a, b = p.get(key, 0.0), q.get(key, 0.0)
        out += sum(x * math.log2(2 * x / (a + b)) / 2 for x in (a, b) if x > 0)
    return math.sqrt(max(0.0, min(1.0, out)))


def test_distances(spark):
    docs = given(spark)
    words = quality.common_words(docs, common=40)
    listed = sorted({w for shares in words.values() for w in shares})
    measured = quality.measure(docs, listed)
    known = quality.references(measured, words)
    rows = {r.doc_id: r for r in quality.judge(measured, listed, known).collect()}
    for r in docs.limit(60).collect():
        words = [w.lower() for w in WORD.findall(r.text)]
        far, classes = [], []
        for reference, shares in zip(known.words, known.classes):
            p = Counter(w if w in reference else None for w in words)
            p = {k: v / len(words) for k, v in p.items()}
            q = reference | {None: 1 - sum(reference.values())}
            far.append(js(p, q) / js({None: 1.0}, q))
            counts = [len(re.sub(rest, "", r.text)) for rest in quality.CLASSES.values()]
            n = [*counts, len(r.text) - sum(counts)]
            classes.append(js(dict(enumerate(x / len(r.text) for x in n)), dict(enumerate(shares))))
        assert rows[r.doc_id].word_distance == pytest.approx(min(far), abs=1e-7)
        assert rows[r.doc_id].class_distance == pytest.approx(min(classes), abs=1e-7)


def test_prose_is_kept_and_noise_is_not(spark):
    docs = given(spark, "/root/testdata/sf0.01")
    rows = quality.assess(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    noise = [r for r in rows if r.n_symbols > 0.2 * r.n_words and r.n_words >= 150]
    prose = [r for r in rows if not r.base_failed and not r.n_symbols and r.text.upper() != r.text]
    assert noise and sum(r.kept for r in noise) <= 0.2 * len(noise)
    assert sum(r.kept for r in prose) >= 0.99 * len(prose)


# ---- fingerprints -----------------------------------------------------------------------------

def test_edited_texts(spark):
    docs = awkward(spark)
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()}, key=lambda r: (r[0] is not None, r[0] or 0))
    got = {r.doc_id: r for r in fingerprints.edit_report(docs).collect()}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[doc_id].n_chars == len(text)
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[8].fingerprint == got[9].fingerprint
    assert got[8].near_next == 1.0


def test_likeness_tells_edits_from_other_texts(spark):
    rows = fingerprints.edit_report(given(spark)).collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.15
    assert sum(r.near_next for r in rows) / len(rows) < 0.05


def test_cells_by_hand(spark):
    known = fingerprints.lexicon(given(spark))
    rows = given(spark).limit(20).select("doc_id", fingerprints.subset_keys(fingerprints.text_of(), known).alias("k")).select(
        "doc_id", "k", fingerprints.cells(fingerprints.F.col("k")).alias("c")
    ).collect()
    for r in rows:
        assert r.k == sorted(set(r.k))
        assert [c >> 24 for c in r.c] == sorted({k >> 56 for k in r.k})


def brute_lexicon(texts, least=2, most=0.05):
    frequency = Counter(term for text in set(texts) for term in set(re.findall(r"[^\W_]+", text.lower())))
    limit = max(least, int(most * len(set(texts))))
    return {term for term, n in frequency.items() if least <= n <= limit}


@pytest.mark.parametrize("least", [1, 2, 3])
def test_lexicon_counts_texts_once(spark, least):
    draw = random.Random(3)
    texts = [" ".join([*draw.choices([f"w{k}" for k in range(300)], k=25), *draw.choices(["the", "of", "and"], k=5), f"own{i}"]) for i in range(100)]
    texts += [texts[0]] * 60 + [texts[1]] * 3 + ["", "only copies have these words"] + ["only copies have these words"] * 4
    docs = frame(spark, list(enumerate(texts)))
    known = fingerprints.lexicon(docs, least=least)
    terms = sorted({t for text in texts for t in text.split()})
    rows = spark.createDataFrame([(t,) for t in terms], "t string").select("t", known.has(fingerprints.F.xxhash64("t")).alias("has")).collect()
    assert {r.t for r in rows if r.has} == brute_lexicon(texts, least)


def test_copies_keep_their_fingerprint(spark):
    draw = random.Random(6)
    pool = [f"word{k}" for k in range(8000)]
    texts = [" ".join(draw.choices(pool, k=200)) for _ in range(80)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(1000 + 2 * i, texts[0]) for i in range(40)]  # a third are copies
    rows += [(1001 + 2 * i, text) for i, text in enumerate(texts[40:])]  # these stand between them
    got = {r.doc_id: r for r in fingerprints.edit_report(frame(spark, rows)).collect()}
    known = fingerprints.lexicon(frame(spark, rows))
    copies = frame(spark, rows[:1]).select(F.size(F.filter(fingerprints.terms_of(F.col("text")), known.has)).alias("n"))
    assert copies.first().n > 100
    assert got[0].fingerprint == got[1000].fingerprint != ""
    copies = [got[1000 + 2 * i] for i in range(39)]
    assert sum(r.near_edited for r in copies) / len(copies) > 0.1
    assert sum(r.near_next for r in copies) / len(copies) < 0.1 and all(r.near_next < 0.5 for r in copies)


def test_texts_without_lexicon_terms(spark):
    """Different ones do not share a fingerprint, and are like their own edited text."""
    common = [f"common{k}" for k in range(800)]
    groups = {1: common[:400], 2: common[400:], 3: ["one", "two"], 4: ["!!"], 5: ["?"], 6: [""], 7: None}
    # near copies in two large groups: every term is above the band, but for those of a few other texts
    rows = [(100 + i, " ".join([*groups[1], f"a{i}"])) for i in range(60)] + [(200 + i, " ".join([*groups[2], f"b{i}"])) for i in range(60)]
    rows += [(k, words and " ".join(words)) for k, words in groups.items()]
    rows += [(300 + i, " ".join(f"rare{k}" for k in range(400)) + f" c{i}") for i in range(3)]
    found = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    assert found[6].fingerprint == found[7].fingerprint == ""
    others = [found[k].fingerprint for k in (1, 2, 3, 4, 5, 100, 200)]
    assert "" not in others and len(set(others)) == len(others)
    got = {r.doc_id: r for r in fingerprints.edit_report(frame(spark, rows)).collect()}
    assert all(got[k].near_next < 1 for k in (1, 2, 3, 4, 5)) and got[6].near_next == 1.0
    assert got[259].near_edited > 0  # half its words, and lexicon terms of the next document
    assert all(got[k].fingerprint == found[k].fingerprint for k in found)


def test_long_texts_keep_sparse_subsets(spark):
    """Half of 200,000 terms are shared."""
    rows = [(1, " ".join(f"a{k}" for k in range(200_000))), (2, " ".join(f"{'ab'[k % 2]}{k}" for k in range(200_000)))]
    known = fingerprints.Lexicon([2**32 - 1] * 2**15)
    docs = frame(spark, rows).select("doc_id", fingerprints.subset_keys(F.col("text"), known).alias("k"))
    a, b = docs.select("doc_id", fingerprints.cells(F.col("k")).alias("c")).orderBy("doc_id").collect()
    near = spark.createDataFrame([(a.c, b.c)], "a array<int>, b array<int>").select(
        fingerprints.likeness(F.col("a"), F.col("b"), F.lit(200_000)).alias("near"), F.length(fingerprints.as_text(F.col("a"))).alias("n")
    ).first()
    assert near.near > 0.1 and near.n == 8 * len(a.c)


# ---- line dedup -------------------------------------------------------------------------------

def brute_lines(rows, lines, hashes):
    """Chunks cut with the given line hashes, then removed by their text."""
    cut = {}
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        ends = [i + 1 for i in range(1, len(parts)) if hashes[(parts[i - 1], parts[i])] % lines == 0]
        ends = sorted({*ends, len(parts)})
        cut[doc_id] = [parts[a:b] for a, b in zip([0, *ends], ends)]
    seen, out = defaultdict(int), {}
    for doc_id in sorted(cut):
        for chunk in cut[doc_id]:
            seen[tuple(chunk)] += 1
    first = set()
    for doc_id in sorted(cut):
        left = []
        for chunk in cut[doc_id]:
            key = tuple(chunk)
            removable = len(chunk) >= 2 and any(WORD.search(x) for x in chunk) and seen[key] > 1
            if removable and key in first:
                continue
            first.add(key)
            left += chunk
        out[doc_id] = "\n".join(left)
    return out


def test_lines_against_brute_force(spark):
    draw = random.Random(8)
    pool = [f"line {i} " + "x" * (i % 5) for i in range(40)] + [""]
    passages = [draw.choices(pool, k=draw.randint(4, 12)) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = draw.choices([f"own {i} {k}" for k in range(50)], k=draw.randint(0, 8))
        for _ in range(draw.randint(0, 2)):
            at = draw.randint(0, len(parts))
            parts[at:at] = draw.choice(passages)
        rows.append((i, "\n".join(parts)))
    pairs = sorted({(a, b) for _, t in rows for a, b in zip(t.split("\n"), t.split("\n")[1:])})
    sides = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "pmod(xxhash64(xxhash64(a), xxhash64(b)), 3) as h")
    hashes = {(r.a, r.b): r.h for r in sides.collect()}
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert got == brute_lines(rows, 3, hashes)
    assert sum(len(t) for t in got.values()) < sum(len(t) for _, t in rows)


def test_shared_passages_go(spark):
    passage = "\n".join(f"shared line number {i} with some more words" for i in range(12))
    rows = [(i, f"first words of {i}\nsecond {i}\n{passage}\nlast words of {i}") for i in range(30)]
    got = {r.doc_id: r for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert got[0].n_removed == 0 and got[0].text == rows[0][1]
    assert all(got[i].n_removed >= 4 for i in range(1, 30))
    assert all(f"first words of {i}" in got[i].text and f"last words of {i}" in got[i].text for i in range(30))


def test_line_dedup_leaves_the_rest_alone(spark):
    docs = awkward(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in linededup.dedup_lines(docs).collect():
        assert r.text == texts[r.doc_id] or r.n_removed


def brute_windows(rows):
    """A line goes if it and a neighbour stand in this order earlier; blank lines between two such go too."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        parts = (text or "").split("\n")
        gone = set()
        for i, pair in enumerate(zip(parts, parts[1:])):
            if any(WORD.search(x) for x in pair):
                gone |= {i, i + 1} if pair in seen else set()
                seen.add(pair)
        for a, b in zip(sorted(gone), sorted(gone)[1:]):
            if not any(WORD.search(x) for x in parts[a + 1:b]):
                gone |= set(range(a, b))
        out[doc_id] = "\n".join(x for i, x in enumerate(parts) if i not in gone)
    return out


def test_windows_against_brute_force(spark):
    draw = random.Random(9)
    pool = [f"line {i} " + "x" * (i % 5) for i in range(60)] + ["", "", " "]
    passages = [draw.choices(pool, k=draw.randint(2, 12)) for _ in range(6)] + [["above", "", "", "", " ", "below"]]
    rows = []
    for i in range(60):
        parts = draw.choices([f"own {i} {k}" for k in range(50)] + ["alone", ""], k=draw.randint(0, 8))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(parts))
            parts[at:at] = draw.choice(passages)
        rows.append((i, "\n".join(parts)))
    docs = frame(spark, rows + rows[:5])  # rows that repeat id and text are one document
    got = linededup.dedup_lines(docs, whole=True).collect()
    assert len(got) == 65 and {r.doc_id: r.text for r in got} == brute_windows(rows)
    kept = {r.doc_id: r.text for r in linededup.drop_repeated_lines(docs, whole=True).collect()}
    assert kept == {k: v for k, v in brute_windows(rows).items() if WORD.search(v) or v == dict(rows)[k]}


@pytest.mark.parametrize("name", ["op8_line_dedup", "line_dedup"])
def test_planted_passages_go_whole(spark, tmp_path, name):
    passages = {n: "\n".join(f"passage of {n} lines, line {k}" for k in range(n)) for n in range(1, 13)}
    rows = [
        (100 * n + i, "\n".join([f"first words of {n} {i}", f"second {n} {i}", passage, f"last words of {n} {i}"]))
        for n, passage in passages.items() for i in range(8)
    ]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    run = {"op8_line_dedup": lambda: QUERIES[name](spark, str(tmp_path)), "line_dedup": lambda: corpus_pipeline.line_dedup(spark, docs, "")}[name]
    got = {r.doc_id: r.text for r in run().collect()}
    for doc_id, text in rows:
        n, i = divmod(doc_id, 100)
        stays = text if i == 0 or n == 1 else f"first words of {n} {i}\nsecond {n} {i}\nlast words of {n} {i}"
        assert got[doc_id] == stays


def test_windows_with_one_hash_are_told_apart(spark, monkeypatch):
    """Equal hashes count only with equal bytes."""
    real = linededup.F.xxhash64
    docs = frame(spark, [(i, f"a {i % 3}\nb {i % 3}\nown {i}") for i in range(9)])
    right = brute_windows([(r.doc_id, r.text) for r in docs.collect()])

    def poor(*columns):
        return F.pmod(real(*columns), F.lit(2)) if len(columns) == 2 else real(*columns)

    monkeypatch.setattr(linededup.F, "xxhash64", poor)
    assert {r.doc_id: r.text for r in linededup.dedup_lines(docs, whole=True).collect()} == right


def test_whole_line_dedup_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = linededup.dedup_lines(docs, whole=True).collect()
    assert sorted(map(str, ((r.doc_id, r.text, r.n_removed) for r in rows))) == sorted(str((r.doc_id, r.text, 0)) for r in docs.collect())
    nothing = frame(spark, [(None, "a\nb"), (None, "a\nb"), (None, None)])
    assert sorted(str(r.text) for r in linededup.dedup_lines(nothing, whole=True).collect()) == ["None", "a\nb", "a\nb"]
