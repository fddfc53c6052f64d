"""Mixing, sharding, near duplicates and the pipeline against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SMALL, awkward, empty, frame, given
from tradewinds.llm import mixing, neardup, sharding
from tradewinds.llm.queries import QUERIES

# ---- mixing -----------------------------------------------------------------------------------


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 2000), (None, 500), ("z", 0)], "source string, source_size long")
    targets = {r.source: r.target for r in mixing.source_targets(sizes, weights=(5, 2, 1), share=1.0, most=3).collect()}
    # a stops at 30; the others share 3480 at weights 2, 1 and 2: z is empty, the null source comes last
    assert targets["a"] == 30 and targets["z"] == 0
    assert sum(targets.values()) == pytest.approx(3510)
    assert targets["b"] == pytest.approx(2 * targets["c"]) and targets[None] == pytest.approx(min(1500, 2 * targets["c"]))


def test_mix_comes_near_and_repeats_itself(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(["w"] * draw.randint(0, 40)), "en", draw.choice(["hot"] * 5 + ["b", "c", None])) for i in range(900)]
    docs = frame(spark, rows)
    first = {r.doc_id: r for r in mixing.mix(docs).collect()}
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(7)).collect()}
    taken, target = Counter(), {}
    for r in first.values():
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size) and again[r.doc_id] == r.taken
        taken[r.source] += r.taken
        target[r.source] = r.target
    for source in target:
        assert abs(taken[source] - target[source]) <= 5  # sizes are up to 40, and three times that
    assert mixing.mix_documents(docs).count() == sum(r.times for r in first.values())


# ---- sharding ---------------------------------------------------------------------------------

def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, parts, load = (low + high) // 2, 1, 0
        for size in sizes:
            if load + size > middle:
                parts, load = parts + 1, 0
            load += size
        low, high = (low, middle) if parts <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed", range(6))
def test_cuts_of_runs_are_cuts_of_atoms(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "_STEP", 3)  # many rounds
    draw = random.Random(seed)
    atoms = {draw.randrange(1 << 62): draw.choice([1, 5, 50, 200]) * draw.randint(1, 9) for _ in range(300)}
    if seed % 2:
        atoms[draw.randrange(1 << 62)] = sum(atoms.values()) // 2  # a group of a third of all
    table = spark.createDataFrame(sorted(atoms.items()), "place long, size long")
    giants, starts = sharding.shard_cuts(table, 8)
    rest = [(p, s) for p, s in sorted(atoms.items()) if p not in giants]
    loads = Counter()
    for place, size in rest:
        loads[sum(place >= s for s in starts)] += size
    assert len(giants) == seed % 2 and len(loads) <= 8 - len(giants)
    assert max(loads.values()) == brute_capacity([s for _, s in rest], 8 - len(giants))


def test_shards(spark):
    draw = random.Random(1)
    rows = [(i, draw.choice(["copy of one text"] * 2 + [f"text {i} " * draw.randint(1, 30)])) for i in range(900)]
    got = sharding.shard(frame(spark, rows), 8, rows_a_slice=50).collect()
    slots, group = defaultdict(list), {}
    texts = dict(rows)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert group.setdefault(texts[r.doc_id], r.shard) == r.shard
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_few_rows(spark):
    assert sharding.shard(frame(spark, [(1, None)]), 8).select("size", "slot").first() == (1, 0)
    assert sharding.shard(empty(spark), 8).count() == 0


# ---- near duplicates --------------------------------------------------------------------------

def sets_of(rows, size):
    out = {}
    for doc_id, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        out[doc_id] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
    return out


def brute_components(rows, size, percent):
    sets, root = sets_of(rows, size), {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def edited(words, draw, share):
    return [draw.choice(["new", "word", "here"]) + str(draw.randint(0, 99)) if draw.random() < share else w for w in words]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_against_all_pairs(spark, size, percent):
    draw = random.Random(size)
    rows, number = [], 0
    for group in range(6):
        base = [f"w{draw.randint(0, 500)}" for _ in range(draw.randint(30, 200))]
        for _ in range(draw.choice([1, 5, 40])):
            rows.append((number, " ".join(edited(base, draw, draw.choice([0, 0.01, 0.02, 0.04])))))
            number += 1
        chain = list(base)  # links of links
        for _ in range(10):
            chain = edited(chain, draw, 0.015)
            rows.append((number, " ".join(chain).upper()))
            number += 1
    rows += [(number, None), (number + 1, ""), (number + 2, "two words"), (number + 3, "Two  words"), (number + 4, "x")]
    draw.shuffle(rows)
    got = {r.doc_id: r for r in neardup.near_duplicates(frame(spark, rows), words=size, percent=percent).collect()}
    assert {d: r.component_id for d, r in got.items()} == brute_components(rows, size, percent)
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets_of(rows, size).items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_rounds_end_with_all_pairs_of_what_is_left(spark, monkeypatch):
    """One bucket holds everything: centres join some, the rest is compared in full."""
    draw = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(base, draw, 0.02))) for i in range(60)] + [(100 + i, f"other text number {i} of its own " * 3) for i in range(10)]
    # a band hash that is the same for all, in this process and by value in the workers
    docs = frame(spark, rows)
    sketch = neardup.sketches(docs, words=3, percent=85).withColumn("bands", F.array(F.lit(1).cast("long")))
    classes = sketch.groupBy("set_id").agg(F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))
    texts = classes.join(docs.select("doc_id", "text"), "doc_id").select("set_id", "text")
    roots = neardup.linked_classes(classes, lambda ids: texts.join(ids, "set_id"), words=3, percent=85)
    named = classes.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    got = {r.set_id: r.least for r in named.join(least, "root").collect()}
    ids = {r.doc_id: r.set_id for r in sketch.collect()}
    assert {d: got[ids[d]] for d, _ in rows} == brute_components(rows, 3, 85)


def template_texts(draw, n, slots=40, choices=2, fixed=160):
    """Texts of one template whose slots hold one of a few words: most pairs share bands, few are linked."""
    frames = [f"t{i}" for i in range(fixed)]
    return [" ".join(
        w if i % (fixed // slots) else f"{w} s{draw.randrange(choices)}x{i}" for i, w in enumerate(frames)
    ) for _ in range(n)]


@pytest.mark.parametrize("choices", [2, 30])
def test_prefix_join_against_all_pairs(spark, monkeypatch, choices):
    """Everything that is left goes through the prefix join, at the first turn and after rounds with centres."""
    draw = random.Random(choices)
    base = [f"w{draw.randint(0, 300)}" for _ in range(90)]
    rows = list(enumerate(template_texts(draw, 30, slots=10, choices=choices)))
    rows += [(100 + i, " ".join(edited(base[:draw.randint(70, 90)], draw, draw.choice([0, 0.01, 0.03])))) for i in range(40)]
    rows += [(200, "one word"), (201, "ONE  word"), (202, ""), (203, None)]
    monkeypatch.setattr(neardup, "_FEW", -1)
    for rounds in (0, 1):
        monkeypatch.setattr(neardup, "_ROUNDS", rounds)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows), words=3, percent=85).collect()}
        assert got == brute_components(rows, 3, 85)


def test_texts_of_one_template_are_not_compared_in_all_pairs(spark, monkeypatch):
    """Near misses of one template: twice the texts make about twice the pairs, not four times."""
    compared, confirm = [], neardup.confirm

    def counted(pairs, texts, **how):
        compared[-1] += pairs.count()
        return confirm(pairs, texts, **how)

    monkeypatch.setattr(neardup, "confirm", counted)
    for n in (200, 400):
        rows = list(enumerate(template_texts(random.Random(n), n, slots=16, choices=n // 4)))
        compared.append(0)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows), words=3, percent=85).collect()}
        assert got == brute_components(rows, 3, 85)
    assert compared[0] < 200 * 199 / 8 and compared[1] < 3 * compared[0]


def test_join_unique_deals_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("key"), F.col("id").alias("by"))
    unique = rows.select("key").distinct().withColumn("m", F.col("key") * 2)
    got = neardup.join_unique(rows, unique, "key", "by", 30)
    assert sorted(map(tuple, got.select("key", "by", "m").collect())) == sorted((1 if i < 900 else i, i, 2 if i < 900 else 2 * i) for i in range(1000))


def _shuffles(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange")


def test_stars_take_few_shuffles(spark):
    key = neardup.materialise(spark.createDataFrame([(u, v) for u in range(2, 60) for v in range(u) if u % (v + 1) == 0], "u long, v long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, small = (neardup._star(key, 7, large=large) for large in (True, False))
        joined = neardup.join_unique(key, neardup.materialise(key.groupBy("u").agg(F.max("v").alias("m"))), "u", "v", 7)
        assert [_shuffles(df) for df in (large, small, joined)] == [3, 4, 4]
        edges = [(r.u, r.v) for r in key.collect()]
        near = defaultdict(set)
        for u, v in edges:
            near[u].add(v)
            near[v].add(u)
        assert {(r.u, r.v) for r in large.collect()} == {(v, min(u, *near[u])) for u in near for v in near[u] if v > u}
        low = {u: {v for v in near[u] if v < u} for u in near}
        wanted = {(x, min(low[u])) for u in low if low[u] for x in low[u] | {u}}
        assert sorted((r.u, r.v) for r in small.collect()) == sorted((u, v) for u, v in wanted if u != v)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_connected_components(spark):
    draw = random.Random(9)
    edges = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2200)]
    links = spark.createDataFrame([(f"{a:05}".encode(), f"{b:05}".encode()) for a, b in edges], "a binary, b binary")
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {int(bytes(r.node)): int(bytes(r.root)) for r in neardup.components(links).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_components_write_a_table_a_round(spark, monkeypatch):
    written, steps = [], []
    materialise, star = neardup.materialise, neardup._star
    monkeypatch.setattr(neardup, "materialise", lambda df: written.append(1) or materialise(df))
    monkeypatch.setattr(neardup, "_star", lambda *args, **how: steps.append(1) or star(*args, **how))
    links = materialise(spark.createDataFrame([(f"{i:05}".encode(), f"{i + 1:05}".encode()) for i in range(40)] * 2, "a binary, b binary"))
    got = {(r.node, r.root) for r in neardup.components(links).collect()}
    assert got == {(f"{i:05}".encode(), b"00000") for i in range(1, 41)}
    assert 2 * len(written) == len(steps)  # a large and a small step


def test_one_row_stays_of_each_group(spark):
    draw = random.Random(12)
    base = [[f"w{draw.randint(0, 900)}" for _ in range(120)] for _ in range(4)]
    near = lambda k, j: " ".join([*base[k][:-1], f"end{j}"])
    rows = [(None, near(0, j % 4)) for j in range(8)]  # no ids: near copies, repeated
    rows += [(None, near(1, j)) for j in range(3)]  # another group without ids
    rows += [(7, near(2, 0))] * 5 + [(None, near(2, 1))]  # repeated rows
    rows += [(8, near(3, 0)), (8, near(3, 1)), (9, near(3, 0))]  # one id, two texts
    rows += [(20, ""), (21, None), (20, "")]
    kept = neardup.keep_first(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept if r.doc_id and r.doc_id >= 20) == [(20, ""), (20, ""), (21, "")]
    firsts = [(r.doc_id, r.text.split()[0], r.text.split()[1]) for r in kept if not r.doc_id or r.doc_id < 20]
    assert sorted(firsts, key=str) == sorted([(i, base[k][0], base[k][1]) for i, k in ((None, 0), (None, 1), (7, 2), (8, 3))], key=str)


# ---- pipeline ---------------------------------------------------------------------------------

def test_stages(spark):
    docs = given(spark)
    names = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SMALL)
        kept = kept.cache()
        assert kept.columns == names and kept.count() > 0, name
        if name != "source_mix":
            assert kept.select("doc_id").subtract(before.select("doc_id")).count() == 0
            assert kept.count() == kept.select("doc_id").distinct().count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "source_mix", "best_fit_packing"]


def test_near_dedup_stage_against_all_pairs(spark):
    docs = given(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {d for d, root in brute_components(rows, 5, 80).items() if d == root}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()} == expected


def test_pipeline_packs_what_the_mix_takes(spark):
    result = QUERIES["pipeline"](spark, SMALL)
    rows = result.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert rows and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_awkward_rows(spark):
    kept = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SMALL)
    kept.collect()
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, empty(spark), SMALL).collect()


def test_mix_with_repeated_rows(spark):
    """Of rows with one id and text as many are taken as the target asks for."""
    rows = [(1, "ten words " * 5, "en", "a")] * 300 + [(2 + i, "w " * (i % 7 + 1), "en", "b") for i in range(200)]
    docs = frame(spark, rows + [(900, "x y", "en", "c")] * 3 + [(901, None, None, None)] * 2)
    taken = mixing.mix(docs, weights=(5, 2, 1)).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count(F.lit(1)).alias("n")
    ).collect()
    assert sum(r.n for r in taken) == 505
    for r in taken:
        assert abs(r.taken - r.target) <= (5 if r.source == "a" else 4 if r.source == "b" else 1), r
    mixed = mixing.mix_documents(docs, weights=(5, 2, 1))
    assert mixed.columns == docs.columns
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert {s: n for s, n in words.items() if n} == {r.source: r.taken for r in taken if r.taken}
