"""Every operator on awkward rows, on an empty table and beside columns of the same names."""

from __future__ import annotations

import public_tokenizers
import pytest

from tests.llm.helpers import awkward, clashing, empty, frame, same_rows
from tradewinds.llm import fingerprints, langid, licenses, linededup, mixing, neardup, packing, quality, sharding, tokencount

BPE = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = tokencount.Unigram([("▁the", -1.0), ("▁", -2.0), ("e", -3.0), ("x", -3.5), ("xx", -4.0)])
OPERATORS = {
    "counts": lambda d: tokencount.token_counts(d, VOCABULARY),
    "mix": lambda d: mixing.mix(d),
    "language": lambda d: langid.identify(d),
    "licenses": lambda d: licenses.scan(d),
    "packing": lambda d: packing.pack_documents(d, tokenizer=BPE),
    "quality": lambda d: quality.assess(d),
    "fingerprints": lambda d: fingerprints.edit_report(d),
    "lines": lambda d: linededup.dedup_lines(d),
    "shards": lambda d: sharding.shard(d),
    "near": lambda d: neardup.near_duplicates(d, words=3, percent=85),
}
FILTERS = {
    "language": langid.keep_identified, "lines": linededup.drop_repeated_lines, "near": neardup.keep_first, "mix": mixing.mix_documents,
}


@pytest.fixture(scope="module")
def rows(spark):
    return awkward(spark).cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(rows, name):
    result = OPERATORS[name](rows)
    ids = [r[0] for r in result.select("doc_id").collect()]
    if name == "packing":
        assert set(ids) == {r.doc_id for r in rows.collect()}
    else:
        assert sorted(ids, key=str) == sorted((r.doc_id for r in rows.collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](empty(spark)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_the_same_names(rows, name):
    same_rows(OPERATORS[name](rows), OPERATORS[name](clashing(rows)))


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, rows, name):
    wide = clashing(rows)
    assert FILTERS[name](wide).columns == wide.columns
    assert FILTERS[name](wide).schema.simpleString() == wide.schema.simpleString()
    assert FILTERS[name](empty(spark)).count() == 0
    FILTERS[name](wide).collect()


def test_null_columns(spark):
    nothing = frame(spark, [(None, None, None, None), (None, None, None, None)])
    for operator in OPERATORS.values():
        operator(nothing).collect()
    for operator in FILTERS.values():
        operator(nothing).collect()
