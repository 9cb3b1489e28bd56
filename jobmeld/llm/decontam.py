"""Benchmark passages in documents, found through a positional inverted index. DataFrame operations only.

The index has a posting (document, place, term) for every document word that some benchmark item uses, and
one that holds the document's length. A window of an item is searched from its rarest terms: their lists,
shifted by the terms' offsets, are intersected first, and only where all of them meet are the lists of the
window's other terms looked up. Matched places of an item that follow one another on one alignment form
runs; a run at least a window long is an occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import ascii_lower, row_keys, stored

WINDOW = 13
RAREST = 3  # terms of a window whose lists are intersected first
SLOP = 5  # words by which these terms may be out of place in a proximity match
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LENGTH = " "  # no word; its posting stands behind the last word
_LENGTH_TERM = -1
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 32 << 20
_BUCKETS = 1 << 17  # rows of the document filter at most


def words(text: Column) -> Column:
    """Words of the text, A-Z in lower case; none for a null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _bounded(df: DataFrame, size: Column) -> DataFrame:
    """Marked for broadcast where it is small by count and by bytes; joined by shuffling otherwise."""
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (total or 0) <= BROADCAST_BYTES else df


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, i, word, size): the words of every item; equal rows are one item."""
    whole = benchmark.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words(F.col("text")).alias("w"))
    whole = whole.dropDuplicates(["item"])
    return whole.select("item", "item_id", F.size("w").alias("size"), F.posexplode("w").alias("i", "word"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, pos, term) for the words of `docs` that are in `terms` (word, term), and their lengths."""
    listed = docs.select(
        "doc_id", *row_keys("doc_id", "text"), F.concat(words(F.col("text")), F.array(F.lit(_LENGTH))).alias("w")
    )
    placed = listed.select("doc_id", "r1", "r2", F.posexplode("w").alias("pos", "word"))
    return placed.join(_bounded(terms, F.octet_length("word") + 32), "word").select("doc_id", "r1", "r2", "pos", "term")


def _windows(places: DataFrame, window: int) -> DataFrame:
    """(item, w, members): for each window its words as (n, i, term), rarest first; none with a word no document has.

    Each place is dealt to the windows it is in, so the work is linear in the length of the items.
    """
    size = F.least(F.col("size"), F.lit(window))
    first = F.greatest(F.col("i") - window + 1, F.lit(0))
    last = F.least(F.col("i"), F.col("size") - size)
    dealt = places.select("item", "i", "term", "n", size.alias("length"), F.explode(F.sequence(first, last)).alias("w"))
    found = dealt.groupBy("item", "w", "length").agg(F.sort_array(F.collect_list(F.struct("n", "i", "term"))).alias("members"))
    return found.filter(F.col("members")[0]["n"] > 0)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rarest: int = RAREST, slop: int = SLOP) -> DataFrame:
    """(doc_id, r1, r2, n_words, n_hit, n_items, n_near_items, item_ids, spans, near_ids), one row per row of `docs`.

    `n_hit` counts the words inside occurrences of a window of `window` item words, or of a whole shorter item.
    `item_ids` are the sorted ids, as strings, of items with an occurrence; an item without an id still hits words but
    is not listed. `spans` has each stretch of an item's words that its occurrences make up: (first, words, item_id).
    `n_near_items` counts items that have a window whose rarest terms, each moved back by its offset, fall into one
    stretch of 2 * `slop` words, stretches beginning every `slop` words; `near_ids` lists their ids. A null or empty
    text has no words; texts are read whole, of any length; rows equal in id and text get equal results; empty tables
    give no row, or no hits; columns other than doc_id and text, item_id and text, whatever their names, are not read.
    """
    item_words = stored(_items(benchmark), "items")
    terms = item_words.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
    ends = docs.sparkSession.createDataFrame([(_LENGTH, _LENGTH_TERM)], "word string, term bigint")
    terms = stored(terms.union(ends), "terms")
    index = stored(postings(docs, terms), "postings")

    often = index.filter(F.col("term") >= 0).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    places = item_words.join(terms, "word").join(often, "term", "left")
    found = _windows(places.select("item", "i", "size", "term", F.coalesce("n", F.lit(0)).alias("n")), window)
    windows = stored(found, "windows")

    few = F.slice("members", 1, rarest)
    anchors = windows.select("item", "w", F.size(few).alias("k"), F.explode(few).alias("m"))
    anchors = anchors.select("item", "w", "k", F.col("m.i").alias("i"), F.col("m.term").alias("term"))
    anchors = _bounded(anchors, F.lit(64))
    met = index.join(anchors, "term").select(
        "r1", "r2", "item", "w", "k", (F.col("pos") - F.col("i")).alias("shift"),
        F.expr("shiftleft(1L, i - w)").alias("bit"),
    )
    met = stored(met, "anchors")
    together = F.bit_count(F.bit_or("bit")) == F.first("k")

    aligned = met.groupBy("r1", "r2", "item", "w", "shift").agg(together.alias("all_met")).filter("all_met")
    members = windows.select("item", "w", F.explode("members").alias("m"))
    members = members.select("item", "w", F.col("m.i").alias("i"), F.col("m.term").alias("term"))
    needed = aligned.select("r1", "r2", "item", "w", "shift").join(_bounded(members, F.lit(64)), ["item", "w"])
    needed = needed.select("r1", "r2", "item", "shift", "i", "term").distinct()
    needed = stored(needed.withColumn("pos", F.col("shift") + F.col("i")), "needed")

    # documents without a candidate stay out of the shuffle: a filter of bounded size, exact after the join
    bucket = F.pmod(F.xxhash64("r1", "r2"), F.lit(_BUCKETS))
    wanted = needed.select(bucket.alias("bucket")).distinct()
    rest = index.withColumn("bucket", bucket).join(F.broadcast(wanted), "bucket", "left_semi")
    hits = needed.join(rest.select("r1", "r2", "pos", "term").distinct(), ["r1", "r2", "pos", "term"])

    one_line = hits.groupBy("r1", "r2", "item", "shift").agg(F.sort_array(F.collect_set("i")).alias("at"))
    spread = one_line.select("r1", "r2", "item", "shift", F.posexplode("at").alias("nth", "i"))
    runs = spread.groupBy("r1", "r2", "item", "shift", (F.col("i") - F.col("nth")).alias("run")).agg(
        F.min("i").alias("first"), F.count(F.lit(1)).alias("n")
    )
    lengths = item_words.filter("i = 0").select(
        "item", "item_id", F.least(F.col("size"), F.lit(window)).alias("length")
    )
    runs = runs.join(_bounded(lengths, F.lit(32)), "item").filter("n >= length")
    runs = stored(runs.select("r1", "r2", "item_id", (F.col("shift") + F.col("first")).alias("a"), "n"), "runs")

    covered = runs.select("r1", "r2", F.explode(F.expr("sequence(a, a + cast(n as int) - 1)")).alias("pos")).distinct()
    covered = covered.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n_hit"))
    span = F.struct(F.col("a").cast("long").alias("first"), F.col("n").cast("long").alias("words"), F.col("item_id").cast("string").alias("item_id"))
    listed = runs.groupBy("r1", "r2").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"), F.sort_array(F.collect_set(span)).alias("spans")
    )
    bins = F.explode(F.array(F.floor(F.col("shift") / (2 * slop)) * 2, F.floor((F.col("shift") + slop) / (2 * slop)) * 2 + 1))
    near = met.select("r1", "r2", "item", "w", "k", "bit", bins.alias("bin"))
    near = near.groupBy("r1", "r2", "item", "w", "bin").agg(together.alias("all_met")).filter("all_met")
    ids_of = lengths.select(detached(F.col("item")).alias("of"), F.col("item_id").cast("string").alias("near_id"))
    near = near.select("r1", "r2", "item").distinct().join(_bounded(ids_of, F.lit(32)), F.col("item") == F.col("of"))
    near = near.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n_near_items"), F.sort_array(F.collect_set("near_id")).alias("near_ids"))

    base = index.filter(F.col("term") == _LENGTH_TERM).select("doc_id", "r1", "r2", F.col("pos").cast("long").alias("n_words"))
    out = base.join(covered, ["r1", "r2"], "left").join(listed, ["r1", "r2"], "left").join(near, ["r1", "r2"], "left")
    zero = F.lit(0).cast("long")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "r1", "r2", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.coalesce("n_near_items", zero).alias("n_near_items"), ids.alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,words:bigint,item_id:string>>")).alias("spans"),
        F.coalesce("near_ids", F.array().cast("array<string>")).alias("near_ids"),
    )


def contaminated() -> Column:
    """A twentieth of the words or more are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
