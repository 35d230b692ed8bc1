"""Benchmark decontamination by winnowing.

Texts become words; every ``K`` words get a hash, and of every ``W`` hashes in
a row the smallest is kept as a fingerprint.  Any span of ``K + W - 1`` words
shared by a document and a benchmark item therefore shares a fingerprint, so
joining the two fingerprint sets misses no shared window of ``SPAN`` words.
Around each matching fingerprint the document's windows are then compared with
the items' windows by their words, which makes the hits exact.

Items shorter than ``SPAN`` words are one window; they are anchored by the hash
of their first words (at most ``ANCHOR``) in place of a fingerprint.

Only built-in expressions are used.  A small fingerprint set (size checked) is
broadcast and documents are matched where they are read, so no text is
shuffled; a larger one is joined by shuffle on slim rows (id, place, hash),
where a very common passage is a skewed join that AQE splits.

Defined cases: a null or empty text, or one without words, has no hits; items
without words are never hit; items are told apart by ``item_id``, and an item
with a null id marks words but is not listed; repeated rows get equal results;
empty tables give empty results or no hits.  Results are one struct column.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, free_prefix
from tallyframe.operators.joins import fits_broadcast

SPAN = 13
K = 7
W = SPAN - K + 1
ANCHOR = 3
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bounds of a broadcast: fingerprints and windows of the benchmark.
MAX_BROADCAST_ROWS = 1_000_000


def lower_az(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(lower_az(text), F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def _places(last: Column) -> Column:
    """0 .. last, or nothing if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _gram(hashes: Column, place: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(hashes, place + j) for j in range(k)])


def fingerprints(rows: DataFrame, words: str = "words") -> DataFrame:
    """One row per winnowed fingerprint: the columns of ``rows`` with ``place`` and ``mark``.

    Texts of fewer than SPAN words have none.  A hash carries the last three
    bits of its place (W is below 8), so the smallest of a window also says
    where it stands.
    """
    n = F.size(words)
    hashed = rows.withColumn("hashes", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", F.transform(
        _places(F.when(n >= SPAN, n - K).otherwise(F.lit(-1))),
        lambda i: F.shiftleft(_gram(F.col("hashes"), i, K), 3).bitwiseOR(i.bitwiseAND(7).cast("bigint")),
    ))
    least = grams.withColumn("least", F.transform(
        _places(n - SPAN), lambda i: F.least(*[F.get(F.col("grams"), i + j) for j in range(W)])
    )).drop("hashes", "grams")
    # The outer form keeps the optimizer from computing the arrays twice.
    marks = least.select("*", F.posexplode_outer("least").alias("i", "mark")).filter(
        F.col("mark").isNotNull() & ((F.col("i") == 0) | (F.get(F.col("least"), F.col("i") - 1) != F.col("mark")))
    )
    place = F.col("i") + F.pmod(F.col("mark").bitwiseAND(7) - F.col("i"), F.lit(8)).cast("int")
    return marks.withColumn("place", place).withColumn("mark", F.shiftright("mark", 3)).drop("least", "i")


def anchors(rows: DataFrame, size: int, words: str = "words") -> DataFrame:
    """One row per ``size`` words in a row: the columns of ``rows`` with ``place`` and ``mark``."""
    hashed = rows.withColumn("hashes", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", F.transform(
        _places(F.size(words) - size), lambda i: _gram(F.col("hashes"), i, size)
    )).drop("hashes")
    return grams.select("*", F.posexplode_outer("grams").alias("place", "mark")).filter(
        F.col("mark").isNotNull()
    ).drop("grams")


def _window(words: str, start: str, length: str) -> Column:
    return F.array_join(F.slice(F.col(words), F.col(start) + 1, F.col(length)), " ")


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, window, length)``: every window of every item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words"))
    n = F.size("words")
    starts = items.filter(n > 0).withColumn("length", F.least(n, F.lit(SPAN))).withColumn(
        "start", F.explode(F.sequence(F.lit(0), n - F.col("length")))
    )
    return starts.select("item_id", _window("words", "start", "length").alias("window"), "length").distinct()


def _short_items(benchmark: DataFrame, text: str) -> DataFrame:
    """``(size, mark, length)`` of the items of fewer than SPAN words: their anchors."""
    items = benchmark.select(words_of(F.col(text)).alias("words")).filter(F.size("words").between(1, SPAN - 1))
    size = F.least(F.size("words"), F.lit(ANCHOR))
    hashes = F.transform(F.col("words"), lambda w: F.xxhash64(w))
    mark = F.coalesce(*[F.when(size == k, _gram(hashes, F.lit(0), k)) for k in range(1, ANCHOR + 1)])
    return items.select(size.alias("size"), mark.alias("mark"), F.size("words").alias("length")).distinct()


def _candidate_windows(marked: DataFrame, keyed: DataFrame, marks: DataFrame, small: bool, spans: Column) -> DataFrame:
    """Windows ``(id, hash, start, length, window)`` of the documents around the places whose mark is in ``marks``.

    ``marked``: mark rows with the document's words; ``spans``: array of
    (start, length) to compare around a place.
    """
    if small:
        near = marked.join(F.broadcast(marks), "mark").select("id", "hash", "words", F.explode(spans).alias("s"))
    else:
        slim = marked.withColumn("n", F.size("words")).drop("words")
        found = slim.join(marks, "mark").select("id", "hash", F.explode(spans).alias("s"))
        per_doc = found.groupBy("id", "hash").agg(F.collect_set("s").alias("spans")).select(
            F.col("id").alias("other"), F.col("hash").alias("other_hash"), "spans"
        )
        same = keyed["id"].eqNullSafe(per_doc["other"]) & keyed["hash"].eqNullSafe(per_doc["other_hash"])
        near = keyed.join(per_doc, same).select("id", "hash", "words", F.explode("spans").alias("s"))
    near = near.select("id", "hash", "words", F.col("s.start").alias("start"), F.col("s.length").alias("length"))
    return near.select("id", "hash", "start", "length", _window("words", "start", "length").alias("window"))


def find_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``(id, hash, spans, item_ids)`` of the documents with a hit; ``hash`` is the text's xxhash64.

    Identical rows share one result row.
    """
    keyed = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("hash"), words_of(F.col(text)).alias("words")
    )
    windows = item_windows(benchmark, item_id, item_text)
    items = benchmark.select(words_of(F.col(item_text)).alias("words"))
    marks = fingerprints(items).select("mark").distinct()
    # Windows outnumber fingerprints; both are proven small or neither is sent.
    small = fits_broadcast(windows, max_broadcast_rows)

    n = F.size("words") if small else F.col("n")
    first, last = F.greatest(F.col("place") - (W - 1), F.lit(0)), F.least(F.col("place"), n - SPAN)
    around = F.transform(F.sequence(first, last), lambda s: F.struct(s.alias("start"), F.lit(SPAN).alias("length")))
    found = _candidate_windows(fingerprints(keyed), keyed, marks, small, around)

    short = _short_items(benchmark, item_text)
    sizes = sorted(r["size"] for r in short.select("size").distinct().collect())  # at most ANCHOR rows
    for size in sizes:
        of_size = short.filter(F.col("size") == size).select("mark", F.col("length").alias("item_length"))
        fits = F.col("place") + F.col("item_length") <= n
        one = F.when(fits, F.array(F.struct(F.col("place").alias("start"), F.col("item_length").alias("length"))))
        found = found.unionByName(_candidate_windows(anchors(keyed, size), keyed, of_size, small, one))

    known = windows.select("window", "item_id")
    hits = found.join(F.broadcast(known) if small else known, "window")
    span = F.struct("start", (F.col("start") + F.col("length")).alias("end"))
    return hits.groupBy("id", "hash").agg(
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )


def covered_words(spans: Column) -> Column:
    """Words inside the union of sorted spans."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("upto"))

    def add(acc: Column, s: Column) -> Column:
        fresh = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))
        return F.struct((acc["words"] + fresh).alias("words"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda acc: acc["words"])


def with_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> tuple[DataFrame, str]:
    """``docs`` with a struct ``{n_words, n_hit, item_ids, spans, contaminated}``; returns the frame and the struct's name.

    Contaminated: at least one hit word, and at least a twentieth of the words hit.
    """
    name, p = free_name(docs, "benchmark_hits"), free_prefix(docs, "_hit_")
    hits = find_hits(docs, benchmark, doc_id, text, **options)
    hits = hits.select(*[F.col(c).alias(f"{p}{c}") for c in hits.columns])
    rows = docs.withColumns({
        f"{p}text": F.xxhash64(F.col(text)),
        f"{p}words": F.size(words_of(F.col(text))).cast("bigint"),
    })
    same = F.col(doc_id).eqNullSafe(F.col(f"{p}id")) & F.col(f"{p}text").eqNullSafe(F.col(f"{p}hash"))
    n_words = F.col(f"{p}words")
    n_hit = F.coalesce(covered_words(F.col(f"{p}spans")), F.lit(0)).cast("bigint")
    info = F.struct(
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(F.col(f"{p}item_ids"), F.array().cast("array<string>")).alias("item_ids"),
        F.col(f"{p}spans").alias("spans"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
    )
    return rows.join(hits, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], info.alias(name)), name


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    marked, name = with_hits(docs, benchmark, **options)
    return marked.filter(~F.col(name)["contaminated"]).drop(name)
