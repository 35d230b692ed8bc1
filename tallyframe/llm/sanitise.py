"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence.

Four kinds of protected entities are found by patterns (email, ip, card, phone).
An entity's value then has a context: the ``SPAN_WORDS`` words on either side of
each of its occurrences.  Over all documents

* P(e | t) is the share of the term t's occurrences that stand beside e,
* P(e) is the share of all words that stand beside e, and
* the disclosure is pointwise mutual information over information content,
  ``log(P(e | t) / P(e)) / -log P(e)`` = ``1 - log P(e | t) / log P(e)``:
  0 if the term says nothing about the entity, 1 if it gives it away.

Terms that reach ``GENERALISE`` for an entity are spans of kind ``term`` in every
text that holds that entity, wherever they stand in it; ``sanitised`` puts a
general word in their place, or nothing from ``REMOVE`` on.  The evidence must
come from ``MIN_TEXTS`` different texts, so a text's copies do not make its
words telling.  Texts without an entity have no spans.

All work is built-in expressions, joins, aggregates and windows.  A text that
cannot hold a match is told by one look and left alone.  Patterns are
possessive and start only where a run of their characters starts, so long runs
cost neither stack nor quadratic time; they match what the plain patterns match.
Texts are grouped by two 64-bit hashes, so copies are worked on once; a term
that very many texts share is counted before it is shuffled.

Defined cases: a null text is empty and has no spans; texts are read whole;
spans of one kind never overlap, spans of different kinds may, and all are
listed; equal starts are ordered by kind; words that touch a pattern's span are
no terms; repeated rows get equal results; empty tables give empty results.
Results are one struct column whose name is free in the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, free_prefix
from tallyframe.llm.decontaminate import lower_az
from tallyframe.operators.joins import checked_broadcast
from tallyframe.session import scratch_path

SPAN_WORDS = 8
MIN_TEXTS = 3
GENERALISE, REMOVE = 0.9, 0.97
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CHUNK = 512


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    sign: str   # text that every match holds, or empty


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    # A shorter run of digits is never a card, so it is not looked at.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+", ""),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
TERM = "term"
# Every text with a match of a pattern that counts holds one of these, found in one look.
HINT = r"@|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|[0-9](?:[\x20-]?[0-9]){11}"


def _no(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def prefix_sums(numbers: Column) -> Column:
    """Sums of an int array up to each place, in runs so that long arrays stay cheap."""
    none = _no("int")

    def running(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), none.alias("all"))
        step = lambda acc, v: F.struct((acc["sum"] + v).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + v)).alias("all"))
        return F.aggregate(values, start, step, lambda acc: acc["all"])

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _CHUNK).cast("int")),
                       lambda i: running(F.slice(numbers, i * _CHUNK + 1, _CHUNK)))
    # The sum before each run, from the last sum of every run.
    ends = lambda r: running(F.transform(r, lambda x: F.element_at(x, -1)))
    joined = F.zip_with(runs, F.concat(F.array(F.lit(0)), ends(runs)), lambda r, before: F.transform(r, lambda x: x + before))
    return F.when(F.size(numbers) == 0, none).otherwise(F.flatten(F.filter(joined, lambda r: r.isNotNull())))


def matches(rows: DataFrame, text: Column, pattern: str, out: str, when: Column | None = None) -> DataFrame:
    """``rows`` with ``out``: array of {start, end, value} of the pattern's matches, in code points, end exclusive."""
    p = free_prefix(rows, "_match_")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if when is not None:
        found = F.when(when, found)
    rows = rows.withColumn(f"{p}found", F.coalesce(found, _no("string")))
    rows = rows.withColumn(f"{p}between", F.when(F.size(f"{p}found") > 0, F.split(text, pattern, -1)))
    steps = F.zip_with(F.slice(f"{p}between", F.lit(1), F.size(f"{p}found")), f"{p}found", lambda a, b: F.length(a) + F.length(b))
    rows = rows.withColumn(f"{p}steps", steps)
    ends = F.when(F.size(f"{p}found") > 0, prefix_sums(F.col(f"{p}steps"))).otherwise(_no("int"))
    rows = rows.withColumn(f"{p}ends", ends)
    spans = F.zip_with(f"{p}ends", f"{p}found", lambda e, v: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
    return rows.withColumn(out, spans).drop(*[f"{p}{c}" for c in ("found", "between", "steps", "ends")])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _keeps(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return n.between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """The protected entity that a match names, however it is written."""
    plain = {"email": F.lower, "ip": lambda v: v}.get(kind, _digits)(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def with_base_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: {start, place, end, kind, entity} of the patterns' matches that hold, by start and kind."""
    p = free_prefix(docs, "_base_")
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs
    for kind in KINDS:
        rows = matches(rows, content, kind.pattern, p + kind.name, F.contains(content, F.lit(kind.sign)) if kind.sign else None)

    def kept(place: int, kind: str) -> Column:
        holds = F.filter(F.col(p + kind), lambda s: _keeps(kind, s["value"]))
        return F.transform(holds, lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            _entity(kind, s["value"]).alias("entity")))

    parts = [kept(place, kind.name) for place, kind in enumerate(KINDS)]
    return rows.withColumn(out, F.array_sort(F.concat(*parts))).drop(*[p + k.name for k in KINDS])


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _may_hold(text: Column) -> Column:
    return F.coalesce(text.rlike(HINT), F.lit(False))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """``(k1, k2, text, base, copies)`` of every different text that has an entity, stored."""
    spark = docs.sparkSession
    content = F.col(text).cast("string")
    rows = docs.filter(_may_hold(content)).select(*_key(content), content.alias("text"))
    path = scratch_path(spark, "sanitise-candidates")
    rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).write.parquet(path)
    path, candidates = scratch_path(spark, "sanitise-texts"), spark.read.parquet(path)
    with_base_spans(candidates, "text", "base").write.parquet(path)
    return spark.read.parquet(path).filter(F.size("base") > 0)


def _words(texts: DataFrame) -> DataFrame:
    """Rows ``(k1, k2, copies, start, end, term, entity)``, stored: the words that touch no span, and the spans (no term)."""
    lower = texts.withColumn("lower", lower_az(F.col("text")))
    found = matches(lower, F.col("lower"), TERMS, "words")
    word = F.transform("words", lambda w: F.struct(w["start"].alias("start"), F.lit(1).alias("order"), w["end"].alias("end"),
                                                   w["value"].alias("term"), F.lit(None).cast("string").alias("entity")))
    span = F.transform("base", lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("order"), s["end"].alias("end"),
                                                  F.lit(None).cast("string").alias("term"), s["entity"].alias("entity")))
    rows = found.select("k1", "k2", "copies", F.explode(F.concat(word, span)).alias("m")).select("k1", "k2", "copies", "m.*")
    in_text = Window.partitionBy("k1", "k2").orderBy("start", "order", "end", "entity")
    before = in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A word overlaps a span that starts before it, or the next row if that is a span.
    inside = F.coalesce(F.max(F.when(F.col("entity").isNotNull(), F.col("end"))).over(before) > F.col("start"), F.lit(False))
    next_start = F.lead(F.when(F.col("entity").isNotNull(), F.col("start"))).over(in_text)
    touched = inside | F.coalesce(next_start < F.col("end"), F.lit(False))
    path = scratch_path(texts.sparkSession, "sanitise-words")
    rows.withColumn("touched", touched & F.col("entity").isNull()).filter(~F.col("touched")).drop("touched").write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def _beside(words: DataFrame, span_words: int) -> DataFrame:
    """``(entity, term, n_beside, n_texts)``: the term's occurrences beside the entity, and the texts that show it there."""
    near = Window.partitionBy("k1", "k2").orderBy("start", "order", "end", "entity").rowsBetween(-span_words, span_words)
    seen = words.withColumn("entities", F.collect_set("entity").over(near)).filter(F.col("term").isNotNull() & (F.size("entities") > 0))
    per_text = seen.select("k1", "k2", "copies", "term", F.explode("entities").alias("entity")).groupBy(
        "k1", "k2", "entity", "term").agg(F.sum("copies").alias("n"))
    return per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_beside"), F.count(F.lit(1)).alias("n_texts"))


def _occurrences(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences of the given terms in all documents; the row with a null term counts all other words."""
    words = docs.select(F.explode(F.regexp_extract_all(lower_az(F.col(text).cast("string")), F.lit(TERMS), F.lit(0))).alias("word"))
    known = checked_broadcast(terms.select("term"))
    if known is terms:
        words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    else:
        words = words.withColumn("n", F.lit(1).cast("bigint"))
    return words.join(known, words["word"] == known["term"], "left").groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, words: DataFrame, text: str = "text", threshold: float = GENERALISE,
                     min_texts: int = MIN_TEXTS, span_words: int = SPAN_WORDS) -> DataFrame:
    """``(entity, term, disclosure)`` of the terms that reach the threshold, stored."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sanitise-beside")
    _beside(words, span_words).write.parquet(path)
    beside = spark.read.parquet(path)
    mass = beside.groupBy("entity").agg(F.sum("n_beside").alias("n_entity"))
    telling = beside.filter(F.col("n_texts") >= min_texts)
    path = scratch_path(spark, "sanitise-counts")
    _occurrences(docs, text, telling.select("term").distinct()).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share, prior = F.col("n_beside") / F.col("n"), F.col("n_entity") / F.lit(float(max(total, 1)))
    disclosure = F.when(prior < 1, 1 - F.log(share) / F.log(prior)).otherwise(0.0)
    found = telling.join(counts.filter(F.col("term").isNotNull()), "term").join(mass, "entity")
    path = scratch_path(spark, "sanitise-terms")
    found.select("entity", "term", disclosure.alias("disclosure")).filter(F.col("disclosure") >= threshold).write.parquet(path)
    return spark.read.parquet(path)


def _term_spans(words: DataFrame, telling: DataFrame) -> DataFrame:
    """``(k1, k2, terms)``: the spans of the telling terms in each text that holds their entity."""
    held = words.filter(F.col("entity").isNotNull()).select("k1", "k2", "entity").distinct()
    here = words.filter(F.col("term").isNotNull()).select("k1", "k2", "start", "end", "term")
    hits = here.join(telling, "term").join(held, ["k1", "k2", "entity"])
    once = hits.groupBy("k1", "k2", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    span = F.struct("start", F.lit(len(KINDS)).alias("place"), "end", F.lit(TERM).alias("kind"), "disclosure")
    return once.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def with_spans(docs: DataFrame, text: str = "text", threshold: float = GENERALISE, min_texts: int = MIN_TEXTS,
               span_words: int = SPAN_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with a struct ``{base, spans}`` of arrays of {start, place, end, kind, disclosure}; returns it and the struct's name.

    ``base`` are the patterns' spans, ``spans`` these and the terms', both by
    start and kind; the disclosure of a pattern's span is 1.
    """
    name, p = free_name(docs, "private_spans"), free_prefix(docs, "_private_")
    texts = _texts(docs, text)
    words = _words(texts)
    telling = disclosing_terms(docs, words, text, threshold, min_texts, span_words)
    shape = "array<struct<start:int,place:int,end:int,kind:string,disclosure:double>>"
    none = F.array().cast(shape)
    base = F.transform("base", lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"], F.lit(1.0))).cast(shape)
    of_text = texts.select("k1", "k2", base.alias("base")).join(_term_spans(words, telling), ["k1", "k2"], "left").select(
        F.col("k1").alias(f"{p}k1"), F.col("k2").alias(f"{p}k2"),
        F.struct("base", F.array_sort(F.concat("base", F.coalesce(F.col("terms").cast(shape), none))).alias("spans")).alias(f"{p}found"))
    content = F.col(text).cast("string")
    own = [F.col(f"`{c}`") for c in docs.columns]
    empty = F.struct(none.alias("base"), none.alias("spans"))
    clean = docs.filter(~_may_hold(content)).select(*own, empty.alias(name))
    k1, k2 = _key(content)
    rows = docs.filter(_may_hold(content)).withColumns({f"{p}t1": k1, f"{p}t2": k2})
    rows = rows.join(of_text, (F.col(f"{p}t1") == F.col(f"{p}k1")) & (F.col(f"{p}t2") == F.col(f"{p}k2")), "left")
    return clean.unionByName(rows.select(*own, F.coalesce(F.col(f"{p}found"), empty).alias(name))), name


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, text: str = "text", remove: float = REMOVE, **options) -> DataFrame:
    """``docs`` with every span taken out of ``text``.

    A pattern's span becomes its kind in brackets; a telling term becomes
    ``[number]`` or ``[term]``, or nothing where its disclosure reaches
    ``remove``.  Of overlapping spans the first stands for all of them.
    """
    found, name = with_spans(docs, text, **options)
    content = F.col(text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(acc: Column, s: Column) -> Column:
        word = F.substring(content, s["start"] + 1, s["end"] - s["start"])
        general = F.when(word.rlike("^[0-9]+$"), "[number]").otherwise("[term]")
        instead = F.when(s["kind"] != TERM, F.concat(F.lit("["), s["kind"], F.lit("]"))).when(
            s["disclosure"] >= remove, "").otherwise(general)
        joined = F.concat(acc["out"], F.substring(content, acc["at"] + 1, s["start"] - acc["at"]), instead)
        inside = s["start"] < acc["at"]
        return F.struct(F.when(inside, acc["out"]).otherwise(joined).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substring(content, acc["at"] + 1, F.length(content)))
    new = F.aggregate(F.col(name)["spans"], start, put, rest)
    return found.select(*[new.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns])
