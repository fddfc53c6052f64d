"""Line dedup by hashes of line windows, or by content-defined chunks of lines.

`whole` takes every window of two adjacent lines: each line is hashed, and a rolling hash covers two
line hashes. A line goes if it and a neighbour stand in this order earlier in the table, by id and
place. Every repeated run of two or more lines goes whole, wherever it stands and whatever is around
it, but for its first; of every line that goes, an earlier copy stays. Lines repeated alone stay.

Otherwise a chunk ends where the rolling hash is 0 modulo `lines`. Borders depend on nearby lines
only, so a passage is cut alike wherever it stands, but for its ends. Chunks of at least two lines that
occur more than once in the table are removed, but for the first. What this removes, `whole` does too,
except for blank lines at the borders of a chunk.

Candidates have equal hashes; they count as equal only if their bytes are. Hashes and counts travel
narrow; frequent ones are added up before the shuffle. Texts move twice by document: once for
candidates, of which only candidate windows or chunks go on to the byte comparison, and once to be
rewritten. These joins are always by shuffle, so that the plan is the same at any size.

Defined cases: null and empty texts have no chunk or window and stay as they are; those without a word
are kept, but blank lines between two removed lines go with them in `whole`; a blank line is a line, so
a line beside it is a window; what is repeated inside one document counts as repeated; rows that repeat
id and text are one document and all get its result; a null id comes last; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewinds.llm.common import text_of
from tradewinds.operators.materialise import Scope, materialise


_WORD = r"[^\x20\x09-\x0D]"


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("null"))


def chunked(rows: DataFrame, lines: int) -> DataFrame:
    """Replace column `text` by `_lines` and add `_ends`, the number of lines up to each chunk's end."""
    rows = rows.withColumn("_lines", F.split("text", "\n", -1)).drop("text")
    rows = rows.withColumn("_hashes", F.transform("_lines", lambda x: F.xxhash64(x)))
    rolling = F.transform("_hashes", lambda h, i: F.pmod(F.xxhash64(F.get(F.col("_hashes"), i - 1), h), F.lit(lines)) == 0)
    cut = F.transform(rolling, lambda ends, i: F.when(ends & (i > 0), i + 1))
    inner = F.filter(cut, lambda e: e.isNotNull())
    return rows.withColumn("_ends", F.array_union(inner, F.array(F.size("_lines")))).drop("_hashes")


def _chunks() -> Column:
    """(place, lines, text) of the chunks of several lines with a word; the place is the first line."""
    def make(end: Column, k: Column) -> Column:
        before = F.coalesce(F.get(F.col("_ends"), k - 1), F.lit(0))
        body = F.array_join(F.slice(F.col("_lines"), before + 1, end - before), "\n")
        return F.struct(before.alias("place"), (end - before).alias("lines"), body.alias("chunk"))

    return F.filter(F.transform("_ends", make), lambda c: (c["lines"] >= 2) & c["chunk"].rlike(_WORD))


def _hashed(rows: DataFrame, lines: int, whole: bool) -> DataFrame:
    """`c` of place and chunk_hash, one row per window or chunk."""
    if not whole:
        found = chunked(rows, lines).select("doc_id", "key", "text_hash", F.explode(_chunks()).alias("c"))
        return found.select("doc_id", "key", "text_hash", F.struct("c.place", F.xxhash64("c.chunk").alias("chunk_hash")).alias("c"))
    each = F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("hash"), x.rlike(_WORD).alias("word")))
    rows = rows.select("doc_id", "key", "text_hash", each.alias("_each"))
    rolling = F.zip_with("_each", F.slice("_each", 2, F.size("_each")), lambda a, b: F.when(a["word"] | b["word"], F.xxhash64(a["hash"], b["hash"])))
    found = rows.select("doc_id", "key", "text_hash", rolling.alias("_rolling"))
    found = found.select("doc_id", "key", "text_hash", F.posexplode("_rolling").alias("place", "chunk_hash")).filter("chunk_hash is not null")
    return found.select("doc_id", "key", "text_hash", F.struct("place", "chunk_hash").alias("c"))


def _bodies(texts: DataFrame, lines: int, whole: bool) -> DataFrame:
    """`c` of place, lines and chunk for the windows or chunks that start at `_places`."""
    if not whole:
        texts = chunked(texts, lines)
        wanted = F.filter(_chunks(), lambda c: F.array_contains(F.col("_places"), c["place"]))
    else:
        texts = texts.withColumn("_lines", F.split("text", "\n", -1)).drop("text")
        body = lambda p: F.concat_ws("\n", F.get(F.col("_lines"), p), F.get(F.col("_lines"), p + 1))
        wanted = F.transform("_places", lambda p: F.struct(p.alias("place"), F.lit(2).alias("lines"), body(p).alias("chunk")))
    return texts.select("doc_id", "key", "text_hash", F.explode(wanted).alias("c"))


def repeated_chunks(docs: DataFrame, *, lines: int = 3, whole: bool = False) -> DataFrame:
    """key, hash and `drop_lines`, the places of the lines to remove, one row per document that loses any. Written."""
    rows = docs.select("doc_id", _key().alias("key"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    with Scope(docs.sparkSession) as scope:
        # Rows that repeat id and text make candidates of their own places; the first of these is all of them.
        narrow = materialise(_hashed(rows, lines, whole).select("doc_id", "key", "text_hash", "c.place", "c.chunk_hash"))
        often = narrow.groupBy("chunk_hash").count().filter("count > 1").select("chunk_hash")
        candidates = materialise(narrow.join(often, "chunk_hash"))

        # byte comparison: the least and the greatest text of a hash are the same
        wanted = candidates.groupBy("key", "text_hash").agg(F.collect_set("place").alias("_places"))
        texts = rows.hint("merge").join(wanted, ["key", "text_hash"])
        body_hash = F.xxhash64("c.chunk") if not whole else F.xxhash64(*[F.xxhash64(F.get(F.split("c.chunk", "\n", -1), k)) for k in (0, 1)])
        bodies = _bodies(texts, lines, whole).select(
            "doc_id", "key", "text_hash", "c.place", "c.lines", "c.chunk", body_hash.alias("chunk_hash")
        )
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "text_hash", "place")
        groups = materialise(bodies.groupBy("chunk_hash").agg(
            (F.min("chunk") == F.max("chunk")).alias("same"), F.min(order).alias("first"), F.max("lines").alias("lines")
        ))
        later = ~((F.col("key") == F.col("first.key")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("place") == F.col("first.place")))
        drop = candidates.join(groups.filter("same"), "chunk_hash").filter(later).select("key", "text_hash", "place", "lines")
        if not groups.filter(~F.col("same")).isEmpty():  # different chunks with one hash: by their bytes
            mixed = bodies.join(groups.filter(~F.col("same")).select("chunk_hash"), "chunk_hash")
            first = mixed.groupBy("chunk_hash", "chunk").agg(F.min(order).alias("first"))
            more = mixed.join(first, ["chunk_hash", "chunk"]).filter(later).select("key", "text_hash", "place", "lines")
            drop = drop.unionByName(more)
        places = drop.groupBy(F.col("key").alias("drop_key"), F.col("text_hash").alias("drop_hash")).agg(
            F.collect_set(F.struct("place", "lines")).alias("_drop")
        )
        each = F.flatten(F.transform("_drop", lambda d: F.sequence(d["place"], d["place"] + d["lines"] - 1)))
        return scope.keep(materialise(places.select("drop_key", "drop_hash", F.array_sort(F.array_distinct(each)).alias("drop_lines"))))


def _rewritten(rows: DataFrame, whole: bool) -> DataFrame:
    """Rows with `text` and `drop_lines`: adds `kept`, `n_lines` and `n_removed`."""
    rows = rows.withColumn("_lines", F.split("text", "\n", -1))

    def filled(place: Column, k: Column) -> Column:
        """A removed line, and the lines up to the next removed one if they are blank."""
        after = F.get(F.col("drop_lines"), k + 1)
        between = F.array_join(F.slice(F.col("_lines"), place + 2, after - place - 1), "")
        return F.when((after > place + 1) & ~between.rlike(_WORD), F.sequence(place, after - 1)).otherwise(F.array(place))

    gone = F.flatten(F.transform("drop_lines", filled)) if whole else F.col("drop_lines")
    rows = rows.withColumn("_stay", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone))
    left = F.transform("_stay", lambda k: F.get(F.col("_lines"), k))
    rows = rows.withColumn("_left", F.when(F.col("drop_lines").isNotNull(), left))
    kept = F.when(F.col("_left").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n"))
    return rows.select(
        *[c for c in rows.columns if c not in ("_lines", "_stay", "_left", "text", "drop_lines")],
        kept.alias("kept"), F.size("_lines").cast("bigint").alias("n_lines"),
        F.when(F.col("_left").isNull(), 0).otherwise(F.size("_lines") - F.size("_left")).cast("bigint").alias("n_removed"),
    )


def _with_places(rows: DataFrame, removed: DataFrame) -> DataFrame:
    equal = (F.col("key") == F.col("drop_key")) & (F.col("text_hash") == F.col("drop_hash"))
    return rows.hint("merge").join(removed, equal, "left").drop("drop_key", "drop_hash")


def dedup_lines(docs: DataFrame, *, lines: int = 3, whole: bool = False) -> DataFrame:
    """doc_id, text without what is repeated, n_lines (before) and n_removed per document."""
    removed = repeated_chunks(docs, lines=lines, whole=whole)
    rows = docs.select("doc_id", F.col("text").isNotNull().alias("given"), text_of().alias("text"), _key().alias("key"), F.xxhash64(text_of()).alias("text_hash"))
    out = _rewritten(_with_places(rows, removed).drop("key", "text_hash"), whole)
    return out.select("doc_id", F.when(F.col("given"), F.col("kept")).alias("text"), "n_lines", "n_removed")


def drop_repeated_lines(docs: DataFrame, *, lines: int = 3, whole: bool = False) -> DataFrame:
    """The documents with rewritten text and n_chars; those of which nothing but white space is left go."""
    removed = repeated_chunks(docs, lines=lines, whole=whole)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of().alias("text"),
        _key().alias("key"), F.xxhash64(text_of()).alias("text_hash"),
    )
    out = _rewritten(_with_places(rows, removed).drop("key", "text_hash"), whole)
    changed = F.col("n_removed") > 0
    columns = []
    for field in docs.schema:
        value = F.col(f"row.`{field.name}`")
        if field.name == "text":
            value = F.when(changed, F.col("kept")).otherwise(value)
        elif field.name == "n_chars":
            value = F.when(changed, F.length("kept").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    # A filter would be pushed below and take the whole rewriting with it, into its own inner loops.
    stays = ~changed | F.col("kept").rlike(_WORD)
    return out.select(F.explode(F.when(stays, F.array(F.struct(*columns)))).alias("row")).select("row.*")
