"""Benchmark passages in documents, found by winnowing; built-in Spark functions only.

A window is ten consecutive words of an item; an item of fewer words is one window. Texts
of both sides are hashed in grams of six words, and of each five consecutive grams the
smallest hash (the rightmost of equal ones) is kept as a fingerprint. Ten words hold five
grams, so a window that a document shares has the same smallest gram on both sides and is
met whatever lies around it. Documents meet items by joining on the fingerprints; a hit is
compared word by word and extended to the left and right as far as a window around it can
reach. Items shorter than a window are met by the hash of all their words, at every place
of a document, for each length that occurs.

What is joined is the items' distinct surroundings of a fingerprint, not the items, so that
a passage of many items is one. Which items a document holds follows from the set of its
surroundings, once for each distinct set. The surroundings are broadcast up to a stated
number of rows; beyond it the documents' fingerprints are shuffled with the words around them.

A null or empty text has no words and no hits, and an item without words no window. Items
without an id take no part; rows of one item id are one item with the windows of all.
Each row of documents gives a row, repeated ones and those without an id as well. Tables
without rows give no rows, or documents without hits. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talktally.llm.frames import stored

# What [^\x00-\x2F\x3A-\x60\x7B-\x7F] leaves; Java matches ranges much faster than their complement.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
WINDOW = 10
GRAM = 6
MOST_BROADCAST = 200_000  # surroundings of up to 14 words each, some 50 MB

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text, with A-Z in lower case; those of a null text are none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.translate(text, _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _hashed_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _window_starts(rows: DataFrame, window: int) -> DataFrame:
    """A row for each place `i` at which that many words begin."""
    # A filter on the number of words would find the words once more for itself.
    places = F.sequence(F.lit(0), F.size("words") - window)
    return rows.withColumn("i", F.explode(F.when(F.size("words") >= window, places)))


def fingerprints(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The columns of rows, which have words, with gram (a hash) and at for each kept gram."""
    each = window - gram + 1

    def hashed(i: Column) -> Column:
        return F.xxhash64(*(F.get("hashes", i + j) for j in range(gram)))

    places = F.when(F.size("words") >= window, F.sequence(F.lit(0), F.size("words") - gram))
    grams = _hashed_words(rows).withColumn("grams", F.transform(places, hashed))
    starts = _window_starts(grams.drop("hashes"), window)
    inside = [F.get("grams", F.col("i") + j) for j in range(each - 1)]
    before, last = F.get("grams", F.col("i") - 1), F.get("grams", F.col("i") + each - 1)
    least = F.least(*inside) if each > 2 else inside[0]
    # A window keeps another gram than the one before it if its last one is the smallest,
    # or if the smallest has just gone.
    new = (F.col("i") == 0) | (last <= least) | (before < least)
    at = F.when(last <= least, F.col("i") + each - 1)
    for j in reversed(range(each - 1)):
        at = at.when(inside[j] == least, F.col("i") + j)
    return starts.where(new).select(
        *rows.columns, F.least(least, last).alias("gram"), at.alias("at")
    )


def _around(at: Column, words: int, reach: int) -> Column:
    """The words at a place and those before and after it, null beyond the text.

    Single reads stay within generated code, where a row of a long text is never copied.
    """
    return F.array(*(F.get("words", at + j) for j in range(-reach, words + reach)))


def _surroundings(items: DataFrame, window: int, gram: int) -> DataFrame:
    """item_id, gram and around, the words at and around each of the items' fingerprints."""
    around = _around(F.col("at"), gram, window - gram).alias("around")
    return fingerprints(items, window, gram).select("item_id", "gram", around).distinct()


def _short_items(items: DataFrame, window: int) -> DataFrame:
    """The same for items that are shorter than a window: all their words."""
    short = _hashed_words(items.where((F.size("words") > 0) & (F.size("words") < window)))
    hashed = F.aggregate("hashes", F.lit(0).cast("long"), lambda a, h: F.xxhash64(a, h))
    return short.select("item_id", hashed.alias("gram"), F.col("words").alias("around")).distinct()


def _span(near: Column, known: Column, at: Column, words: int, reach: int) -> tuple[Column, ...]:
    """Whether the words in the middle are the same, and the span of all equal ones around them."""

    def equal(i: int) -> Column:
        return F.get(near, F.lit(i)) == F.get(known, F.lit(i))

    left = right = F.lit(0)
    for j in range(reach):
        left = F.when(equal(j), left + 1).otherwise(0)
        right = F.when(equal(words + 2 * reach - 1 - j), right + 1).otherwise(0)
    same = reduce(Column.__and__, (equal(reach + j) for j in range(words)))
    return same, at - left, at + words + right


def _hits(documents: DataFrame, known: DataFrame, window: int, gram: int, small: bool) -> DataFrame:
    """text_key, start, stop and surroundings of each extended hit of a window's length at least."""
    reach = window - gram
    kept = fingerprints(documents, window, gram)
    near = _around(F.col("at"), gram, reach).alias("near")
    known = known.where(F.size("around") == window + reach).select("id", "gram", "around")
    if small:
        met = kept.join(F.broadcast(known), "gram").select("text_key", "at", "id", "around", near)
    else:
        met = kept.select("text_key", "gram", "at", near).join(known, "gram").drop("gram")
    # Written before it is compared, or Spark would compare the words within the join.
    met = stored(met, "hits")
    same, start, stop = _span(F.col("near"), F.col("around"), F.col("at"), gram, reach)
    spans = met.where(same).select("text_key", start.alias("start"), stop.alias("stop"), "id")
    return spans.where(F.col("stop") - F.col("start") >= window)


def _short_hits(
    documents: DataFrame, known: DataFrame, lengths: list[int], small: bool
) -> DataFrame:
    """The same for short items, at every place of a document."""

    def hashed(length: int) -> Column:
        places = (F.get("hashes", F.col("i") + j) for j in range(length))
        return reduce(lambda a, h: F.xxhash64(a, h), places, F.lit(0).cast("long"))

    starts = _window_starts(_hashed_words(documents), min(lengths))
    each = F.explode(
        F.array(*(F.struct(F.lit(n).alias("words"), hashed(n).alias("gram")) for n in lengths))
    )
    each = starts.select("text_key", F.col("words").alias("all"), "i", each.alias("found"))
    near = F.slice("all", F.col("i") + 1, F.col("found.words")).alias("near")
    known = known.select("id", "gram", "around")
    found = each.where(F.col("i") + F.col("found.words") <= F.size("all")).select(
        "*", F.col("found.gram").alias("gram")
    )
    if small:
        met = found.join(F.broadcast(known), "gram").select("text_key", "i", "id", "around", near)
    else:
        met = found.select("text_key", "i", "gram", near).join(known, "gram").drop("gram")
    met = stored(met, "short-hits")
    return met.where("near = around").select(
        "text_key", F.col("i").alias("start"), (F.col("i") + F.size("around")).alias("stop"), "id"
    )


def _covered(spans: Column) -> Column:
    """How many places the ascending spans cover together."""
    zero = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n"))

    def add(total: Column, span: Column) -> Column:
        new = span.stop - F.greatest(span.start, total.until)
        return F.struct(
            F.greatest(span.stop, total.until).alias("until"),
            (total.n + F.greatest(new, F.lit(0))).alias("n"),
        )

    return F.aggregate(spans, zero, add, lambda total: total.n)


def _items_of_sets(found: DataFrame, items: DataFrame) -> DataFrame:
    """ids, n_items and items_sha256 for each distinct set of surroundings."""
    one = found.select("ids").distinct().select("ids", F.explode("ids").alias("id"))
    held = one.join(items, "id").select("ids", F.col("item_id").cast("string").alias("item"))
    held = held.groupBy("ids").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return held.select(
        "ids",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # What a document holds follows from its text; equal texts share a key of 128 bits.
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    texts = documents.select(key.alias("text_key"), words_of(F.col(text_col)).alias("words"))
    items = benchmark.where("item_id is not null").select("item_id", words_of(F.col("text")).alias("words"))
    met = _surroundings(items, window, gram).unionByName(_short_items(items, window))
    met = stored(met, "benchmark-surroundings")
    known = met.select("gram", "around").distinct()
    known = stored(known.withColumn("id", F.monotonically_increasing_id()), "surroundings")
    # One row for each length below a window's, and one for all others.
    counts = dict(
        known.groupBy(F.size("around").alias("length")).agg(F.count("*").alias("n")).collect()
    )
    small = sum(counts.values()) <= most_broadcast
    spans = _hits(texts, known, window, gram, small)
    lengths = sorted(n for n in counts if n < window)
    if lengths:
        short = known.where(F.size("around") < window)
        spans = spans.union(_short_hits(texts, short, lengths, small))
    found = spans.groupBy("text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.sort_array(F.collect_set("id")).alias("ids"),
    )
    found = stored(
        found.select("text_key", _covered(F.col("spans")).alias("n_hit"), "ids"), "hit-texts"
    )
    item_ids = met.join(known, ["gram", "around"]).select("id", "item_id")
    sets = _items_of_sets(found, item_ids)
    found = found.join(sets, "ids").select("text_key", "n_hit", "n_items", "items_sha256")
    count = F.size(words_of(F.col(text_col))).cast("long").alias("n_words")
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), count, key.alias("text_key"))
    zero = F.lit(0).cast("long")
    n_hit = F.coalesce("n_hit", zero)
    return rows.join(found, "text_key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
