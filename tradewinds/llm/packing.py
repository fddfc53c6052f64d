"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents are tokenised by word with a memory of words, which is exact for byte-level tokenizers
that split text before every space. Pieces are range-sorted by length in Spark, longest first.
Lengths are whole numbers up to the capacity, so both sides of the match are kept as runs of equal
size: pieces of a length, and gaps of a size. In each superstep the pieces of the next length sweep
the gaps upwards from the smallest that fits, are dealt to them by rank, the gaps shrink, and the
next length follows; pieces for which no gap is left open new sequences. What the sweep decides is a
list of rank ranges, whose number depends on the capacity only; Spark applies it to the sorted pieces
in one pass. This is best-fit decreasing, exactly, and no piece or gap passes through the driver.

Defined cases: a null or empty text is its end mark alone; only documents above the capacity are cut,
the first part being the shorter one; ties go by id, piece and content; rows that repeat everything
are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from tradewinds.llm.common import ship_package
from tradewinds.operators.materialise import materialise
from tradewinds.operators.ordered import positions

_REMEMBERED = 500_000  # words in each of two generations
_UNSAFE = re.compile(r"\s ")  # a space after white space starts no word
_BORDER = re.compile(r"(?<=\S) ")


#: Fixed value: how byte-level tokenizers split a text before the merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    return letters


def _by_rank(layout: dict) -> tiktoken.Encoding | None:
    """The same merges for a faster library, if ids rise with the order of the merges; else null."""
    model, letters = layout["model"], _byte_letters()
    vocabulary = model.get("vocab") if model.get("type") == "BPE" else None
    if not vocabulary or model.get("dropout") or model.get("ignore_merges") or layout["pre_tokenizer"].get("use_regex") is False:
        return None
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    added = {token["content"] for token in layout["added_tokens"]}
    tokens = {token: i for token, i in vocabulary.items() if token not in added}
    if merged != sorted(merged) or len(merged) + 256 != len(tokens) or max(tokens[x] for x in letters) >= merged[0]:
        return None
    ranks = {bytes(letters[x] for x in token): i for token, i in tokens.items()}
    return tiktoken.Encoding("by_rank", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


class _Words(dict):
    """Ids of words after a space, in two generations: words met again move to the younger one."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            found = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        if len(word) <= 100:
            self[word] = found
        return found


class Encoder:
    """Ids of texts as little-endian bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        layout = json.loads(self.tokenizer.to_str())
        special = [token["content"] for token in layout["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        before = layout["pre_tokenizer"] or {}
        self.by_word = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not layout["normalizer"]
        self.by_rank = _by_rank(layout) if self.by_word else None
        if self.by_rank:
            self.words = _Words(self.by_rank.encode_ordinary)
        else:
            self.words = _Words(lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.firsts: dict[str, bytes] = {}

    def _first(self, word: str) -> bytes:
        found = self.firsts.get(word)
        if found is None:
            if len(self.firsts) >= _REMEMBERED // 10:
                self.firsts.clear()
            found = self.firsts[word] = self._whole(word)
        return found

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not self.by_word or (self.special and self.special.search(text)):
            return self._whole(text)
        words = _BORDER.split(text) if _UNSAFE.search(text) else text.split(" ")
        first = self._first(words[0])
        del words[0]
        return first + b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 per piece. `tokenizer` is a file every executor has."""
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    end = struct.pack("<I", end_id)

    def cut(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                which, piece, start, length, crc = [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    ids = memoryview(_encoder(tokenizer).encode(text or "") + end)
                    total, at, number = len(ids) // 4, 0, 0
                    while at < total:
                        size = (total - at) % capacity or min(capacity, total - at)
                        which.append(row), piece.append(number), start.append(at), length.append(size)
                        crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                        at, number = at + size, number + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=schema.fieldNames(),
                )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sweep(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over runs: `counts` pieces of each length.

    Returns (length, first rank, end rank, first sequence, pieces a sequence, offset) ranges and the
    number of sequences. A piece of rank r goes to sequence first + (r - first rank) // pieces.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size -> runs (first sequence, sequences)
    ranges, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        fitting = sorted(size for size, runs in gaps.items() if size >= length and runs)
        for size in [*fitting, None]:
            if not left:
                break
            if size is None:
                each = capacity // length
                runs = [(opened, -(-left // each))]
                opened, size = opened + runs[0][1], capacity
            else:
                each, runs = size // length, gaps.pop(size)
            for first, many in runs:
                if not left:
                    gaps[size].append((first, many))
                    continue
                full = min(many, left // each)
                if full:
                    ranges.append((length, rank, rank + full * each, first, each, capacity - size))
                    rank, left = rank + full * each, left - full * each
                    if size > each * length:
                        gaps[size - each * length].append((first, full))
                if full < many:
                    if 0 < left < each:  # the last sequence takes what is left
                        ranges.append((length, rank, rank + left, first + full, each, capacity - size))
                        gaps[size - left * length].append((first + full, 1))
                        rank, left, full = rank + left, 0, full + 1
                    if full < many:
                        gaps[size].append((first + full, many - full))
    return ranges, opened


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add sequence_id and offset to pieces of length 1 to `capacity`."""
    names = [c for c in pieces.columns if c != "length"]
    order = [F.col("length").desc(), *[F.col(f"`{c}`").asc_nulls_first() for c in names]]
    placed = positions(pieces, order, name="place")
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}  # at most `capacity` rows
    ranges, _ = sweep(counts, capacity)
    starts, total = {}, 0
    for length in sorted(counts, reverse=True):
        starts[length], total = total, total + counts[length]
    rows = [(length, starts[length] + low, starts[length] + high, first, each, offset) for length, low, high, first, each, offset in ranges]
    plan = pieces.sparkSession.createDataFrame(
        rows, "in_length long, low long, high long, first long, each long, at long"
    )
    inside = (F.col("length") == F.col("in_length")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))
    step = F.col("place") - F.col("low")
    return placed.join(F.broadcast(plan), inside).select(
        *pieces.columns, (F.col("first") + F.floor(step / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + (step % F.col("each")) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, *, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pieces of documents with their places; tokens are made once and written narrow."""
    return pack(materialise(pieces_of(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity)), capacity)
