"""Token counts against the tokenizer's own unigram model, packing against its rules."""

from __future__ import annotations

import random
import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given as samples, settings, strategies as st
from tokenizers import Tokenizer, models

from tests.llm.helpers import awkward, given
from tradewinds.llm import packing, tokencount

BPE = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = packing.Encoder(BPE)
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def reference(vocabulary, *, byte_fallback):
    """The library's unigram tokenizer over the same pieces; the pieces for bytes match no text here."""
    least = min(score for _, score in vocabulary.pieces)
    more = [(f"<0x{i:02X}>", least) for i in range(256)] if byte_fallback else []
    return Tokenizer(models.Unigram([("<unk>", least), *more, *vocabulary.pieces], 0, byte_fallback))


@settings(max_examples=300, deadline=None)
@samples(
    st.dictionaries(st.text("abc▁", min_size=1, max_size=4), st.integers(-6, -1), min_size=1, max_size=12),
    st.text("abcdé ", max_size=30), st.booleans(),
)
def test_ties_and_unknown_characters(pieces, text, fallback):
    vocabulary = tokencount.Unigram([(p, float(s)) for p, s in sorted(pieces.items())], fallback)
    expected = reference(vocabulary, byte_fallback=fallback).encode("▁" + text.replace(" ", "▁")).ids if text else []
    assert vocabulary.count(text) == len(expected)


@pytest.mark.parametrize("scores", ["zipf", "file"])
def test_whole_vocabulary(spark, scores):
    vocabulary = tokencount.from_file(PIECES, scores=scores)
    model = reference(vocabulary, byte_fallback=True)
    rows = tokencount.token_counts(given(spark), vocabulary).collect()
    texts = {r.doc_id: r.text for r in given(spark).collect()}
    assert len(rows) == len(texts)
    for row in rows[:60]:
        assert row.n_tokens == len(model.encode("▁" + texts[row.doc_id].replace(" ", "▁")).ids)


def test_words_count_alike_alone_and_in_whole_texts():
    vocabulary = tokencount.from_file(PIECES)
    text = "The  quick   brown fox ▁ jumps,\n\nover 東京 the lazy dog " * 3
    assert vocabulary.count(text) == vocabulary.path("▁" + text.replace(" ", "▁"))


@settings(max_examples=200, deadline=None)
@samples(st.text("ab \n\t  \x1cé1.", max_size=40))
def test_ids_by_word_are_ids_of_the_text(text):
    whole = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode(text) == struct.pack(f"<{len(whole)}I", *whole)


def test_both_libraries_agree(spark):
    assert ENCODER.by_rank is not None
    for row in given(spark).limit(80).collect():
        assert ENCODER.by_rank.encode_ordinary(row.text) == ENCODER.tokenizer.encode(row.text, add_special_tokens=False).ids


def test_words_are_forgotten_by_generation(monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 3)
    small = packing.Encoder(BPE)
    for text in ["a b c d e f b a", "b a e", "x y z a b " * 3]:
        assert small.encode(text) == ENCODER.encode(text)
    assert len(small.words) <= 3 and len(small.words.older) <= 3


def test_special_token_strings():
    for text in ["a <|endoftext|> b", "<|endoftext|>", " x<|endoftext|>y  z "]:
        ids = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
        assert ENCODER.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def check_packing(docs, capacity):
    result = packing.pack_documents(docs, tokenizer=BPE, end_id=2, capacity=capacity).collect()
    by_sequence, by_doc = {}, {}
    for r in result:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return result, by_sequence, by_doc


def test_packing_the_given_documents(spark):
    docs = given(spark)
    result, by_sequence, by_doc = check_packing(docs, 1024)
    tokenizer = Tokenizer.from_file(BPE)
    for row in docs.collect():
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids + [2]
        parts = sorted(by_doc[row.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert sum(p.length for p in parts) == len(ids)
        assert all(p.length == 1024 for p in parts[1:])
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.start:p.start + p.length]))
    least = -(-sum(p.length for p in result) // 1024)
    assert len(by_sequence) <= 1.03 * least


def test_packing_awkward_rows(spark):
    result, _, _ = check_packing(awkward(spark), 64)
    assert sum(r.length == 1 and r.doc_id == 3 for r in result) == 1  # empty: the end mark alone


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, gap in enumerate(gaps) if gap >= length]
        if fitting:
            i = min(fitting, key=lambda j: gaps[j])
            gaps[i] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_sweep_is_best_fit_decreasing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 20, 64, 1024])
    lengths = [draw.randint(1, capacity if seed % 2 else max(1, capacity // 5)) for _ in range(draw.randint(0, 400))]
    counts = {length: lengths.count(length) for length in set(lengths)}
    ranges, opened = packing.sweep(counts, capacity)
    assert opened == best_fit_decreasing(lengths, capacity)
    used = {}
    for length, low, high, first, each, offset in ranges:
        for rank in range(low, high):
            place = (first + (rank - low) // each, offset + (rank - low) % each * length)
            used.setdefault(place[0], []).append((place[1], length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(len(p) for p in used.values()) == len(lengths)
