"""Benchmark decontamination: word windows of test items searched in all documents, without Python on the executors.

A window is ``size`` consecutive words of an item, or all words of a shorter item. Every
occurrence of a window covers one place that is a multiple of ``size - part + 1``, and
the ``part`` words from there stand inside the window. So a document is scanned at these
places only, against a broadcast hash set of all such parts of the items. Where a part
is found, the windows around it are hashed in whole, looked up and compared word by word.
Windows of shorter items are looked up in whole at every place.

Items with the same window are gathered before the join, so a window that many items
share is one row. What is found is kept by the text and not by the document: copies of a
text are scanned each on their own but gathered and judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.common import kept

#: Digits, letters a to z and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A to Z are lower-cased.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts and windows up to this number are broadcast, 8 bytes and one window's words each; more are joined by a shuffle.
BROADCAST_PARTS = 2_000_000
BROADCAST_WINDOWS = 200_000


def lowered(text: Column) -> Column:
    """A to Z in lower case, all else as it is; null is empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # Of ASCII alone, lower() does the same and is faster.
    return F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def _hashed(array: Column) -> Column:
    return F.xxhash64(array)


def _starts(n: Column, length: int, step: int = 1) -> Column:
    """Places from 0 on, ``step`` apart, at which ``length`` words begin."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length, F.lit(step))).otherwise(F.array().cast("array<int>"))


def windows_of(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``window`` (its hash), ``words`` and ``items``, the ids as strings, of every distinct window of ``benchmark`` (item_id, text)."""
    split = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    n = F.size("w")
    places = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).when(n > 0, F.array(F.lit(1)))
    each = split.select("item_id", F.explode(places).alias("place"), "w").select("item_id", F.slice("w", F.col("place"), size).alias("words"))
    return each.groupBy("words").agg(F.collect_set("item_id").alias("items")).select(_hashed(F.col("words")).alias("window"), "words", "items")


def _limited(df: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """Broadcast if its rows, which are counted, are few enough."""
    few = df.count() <= most
    return (F.broadcast(df) if few else df), few


def _found(docs: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """One row for each document (``id``, ``h1``, ``h2``, ``n_words``) with place -1, and one for each place at which a window may begin around.

    ``near`` are the words around such a place, the first of them at ``at``.
    """
    part = (size + 1) // 2
    step = size - part + 1
    lengths = sorted(r[0] for r in windows.select(F.size("words").alias("n")).distinct().collect())
    # Parts of whole windows, and shorter windows in whole; 0 stands for the document itself.
    inner = F.transform(F.sequence(F.lit(1), F.lit(step)), lambda i: _hashed(F.slice("words", i, part)))
    keys = F.when(F.size("words") == size, inner).otherwise(F.array(F.col("window")))
    parts = windows.select(F.explode(keys).alias("key")).union(windows.sparkSession.range(1).select(F.lit(0).cast("long").alias("key")))
    parts, few = _limited(kept(parts.distinct(), "benchmark-parts"), BROADCAST_PARTS)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Two 64-bit hashes tell texts apart.
    split = docs.select(
        F.col("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), words(F.col("text")).alias("w")
    ).withColumn("n_words", F.size("w"))

    def scan(length: int, whole: int, step: int) -> Column:
        return F.transform(
            _starts(F.col("n_words"), length, step),
            lambda p: F.struct(p.alias("place"), F.lit(whole).alias("whole"), _hashed(F.slice("w", p + 1, length)).alias("key")),
        )

    own = F.array(F.struct(F.lit(-1).alias("place"), F.lit(0).alias("whole"), F.lit(0).cast("long").alias("key")))
    scans = [scan(part, size, step) if n == size else scan(n, n, 1) for n in lengths]
    listed = split.withColumn("scan", F.concat(own, *scans))
    # Never empty; the plain explode() would test that by computing all of it beforehand.
    each = listed.select("id", "h1", "h2", "n_words", "w", F.explode_outer("scan").alias("s"))
    each = each.select("id", "h1", "h2", "n_words", "w", "s.place", "s.whole", "s.key")

    def around(df: DataFrame) -> DataFrame:
        """Only what stands around a place goes on, not all words of the document."""
        at = F.when(F.col("whole") == size, F.greatest(F.col("place") - step + 1, F.lit(0))).otherwise(F.col("place"))
        until = F.when(F.col("whole") == size, F.least(F.col("place") + size, F.col("n_words"))).otherwise(F.col("place") + F.col("whole"))
        near = F.when(F.col("place") >= 0, F.slice("w", at + 1, until - at))
        return df.select("id", "h1", "h2", F.col("n_words").cast("long"), "place", "whole", "key", at.alias("at"), near.alias("near"))

    found = around(each.join(parts, "key", "left_semi")) if few else around(each).join(parts, "key", "left_semi")
    return found.drop("key")


def _occurrences(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``lo``, ``hi`` and ``items`` of every window that stands in a text, once for all copies of the text."""
    rows = found.where("place >= 0").select("h1", "h2", "whole", "at", "near").distinct()
    places = F.sequence(F.lit(0), F.size("near") - F.col("whole"))
    each = rows.where(F.size("near") >= F.col("whole")).select("h1", "h2", "whole", "at", F.explode(places).alias("o"), "near")
    each = each.select("h1", "h2", "whole", (F.col("at") + F.col("o")).alias("lo"), F.slice("near", F.col("o") + 1, F.col("whole")).alias("words"))
    windows, _ = _limited(windows, BROADCAST_WINDOWS)
    # Equal hashes are verified word by word.
    hits = each.withColumn("window", _hashed(F.col("words"))).join(windows, ["window", "words"])
    return hits.select("h1", "h2", "lo", (F.col("lo") + F.col("whole")).alias("hi"), "items")


def _runs(hits: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``spans`` and ``n_hit`` of texts: runs of words that windows cover."""
    order = Window.partitionBy("h1", "h2").orderBy("lo", "hi")
    reached = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(reached < F.col("lo"), F.lit(True)).cast("int")
    numbered = hits.select("h1", "h2", "lo", "hi").distinct().withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    runs = numbered.groupBy("h1", "h2", "run").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo")).alias("words"))
    spans = F.array_sort(F.collect_list(F.struct("start", "words"))).alias("spans")
    return runs.groupBy("h1", "h2").agg(spans, F.sum("words").alias("n_hit"))


def _search(docs: DataFrame, benchmark: DataFrame, size: int, by: str) -> tuple[DataFrame, DataFrame]:
    """What the scan has found, and ``h1``, ``h2``, ``items``, ``spans`` and ``n_hit`` of the texts with hits."""
    windows = kept(windows_of(benchmark, size), "benchmark-windows")
    found = kept(_found(docs.select(F.col(by).alias("id"), "text"), windows, size), "benchmark-found")
    hits = kept(_occurrences(found, windows), "benchmark-hits")
    items = hits.groupBy("h1", "h2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    # Written before it is joined, so that the documents' side of a frequent text can be split.
    return found, kept(items.join(_runs(hits), ["h1", "h2"]), "benchmark-texts")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, by: str = "doc_id") -> DataFrame:
    """``by``, ``n_words``, ``n_hit``, ``items`` and ``spans`` of every row of ``docs`` (by, text).

    ``items`` are the sorted ids, as strings, of the rows of ``benchmark`` (item_id, text)
    with occurring windows; ``spans`` the maximal runs of hit words, as number of the
    first word, from 0 on, and number of words.

    Null and empty texts and those without words have no words and no hits. Items
    without words have no window; windows of items without an id hit words but
    are listed for no item; rows of one item id are one item. Repeated rows get equal
    results, null ids stay, other columns are ignored, empty tables give no hits.
    """
    found, texts = _search(docs, benchmark, size, by)
    rows = found.where("place < 0").select("id", "h1", "h2", "n_words").join(texts, ["h1", "h2"], "left")
    return rows.select(
        F.col("id").alias(by),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,words:int>>")).alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, remove: str = "spans", share: float = 0.0) -> DataFrame:
    """The rows and columns of ``docs`` without what they share with ``benchmark``.

    ``remove`` is ``spans``: texts lose all from the first to the last word of every run
    of hit words; or ``documents``: rows go whose part of hit words is above ``share``.
    Rows without hits come out as they are, null texts too.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove}")
    text = F.coalesce(F.col("_d.text").cast("string"), F.lit(""))
    found, texts = _search(docs.select(F.lit(None).cast("long").alias("id"), "text"), benchmark, size, "id")
    n_words = found.where("place < 0").select("h1", "h2", "n_words").distinct()
    hits = kept(texts.join(n_words, ["h1", "h2"]), "benchmark-counts").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "spans", "n_hit", "n_words"
    )
    same = (F.xxhash64(text) == F.col("_h.`_h1`")) & (F.xxhash64(F.lit(1), text) == F.col("_h.`_h2`"))
    joined = docs.alias("_d").join(hits.alias("_h"), same, "left")
    own = [F.col(f"_d.`{c}`") for c in docs.columns]
    if remove == "documents":
        rest = F.col("_h.n_hit").isNull() | (F.col("_h.n_hit") <= share * F.col("_h.n_words"))
        return joined.where(rest).select(*own)
    cleaned = F.when(F.col("_h.spans").isNull(), F.col("_d.text")).otherwise(without_spans(text, F.col("_h.spans"), F.col("_h.n_words").cast("int")))
    return joined.select(*[cleaned.alias(c) if c == "text" else F.col(f"_d.`{c}`") for c in docs.columns])


def without_spans(text: Column, spans: Column, n_words: Column) -> Column:
    """``text`` without all that stands from the first to the last word of the spans."""

    def end(i: Column) -> Column:
        return F.get(spans, i)["start"] + F.get(spans, i)["words"]

    before = F.transform(
        spans,
        lambda s, i: F.concat(
            F.array_repeat(F.lit(False), s["start"] - F.when(i == 0, F.lit(0)).otherwise(end(i - 1))),
            F.array_repeat(F.lit(True), s["words"]),
        ),
    )
    gone = F.concat(F.flatten(before), F.array_repeat(F.lit(False), n_words - end(F.size(spans) - 1) + 1))
    # A space, then a word, and so on, and a space at the end; they may be empty.
    spaces = F.split(text, CASED_WORD, -1)
    parts = F.zip_with(F.arrays_zip(spaces.alias("space"), gone.alias("gone")), F.regexp_extract_all(text, F.lit(CASED_WORD), F.lit(0)), lambda a, w: F.struct(a["space"].alias("space"), a["gone"].alias("gone"), w.alias("word")))
    whole = F.transform(
        parts,
        lambda x, i: F.concat(
            F.when(x["gone"] & (i > 0) & F.coalesce(F.get(gone, i - 1), F.lit(False)), F.lit("")).otherwise(x["space"]),
            F.when(x["gone"], F.lit("")).otherwise(F.coalesce(x["word"], F.lit(""))),
        ),
    )
    return F.array_join(whole, "")
