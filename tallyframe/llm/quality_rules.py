"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text.  The ledger keeps the measurements and
one failure bit per rule; a policy is a versioned mask over those bits, so a
new policy or an ablation is a bitwise expression over the ledger and never
another pass over the texts.

Defined cases: a null or empty text has no words, all measurements are 0 and
it fails ``few_words``; repeated rows each get their own (equal) ledger row; an
empty table gives an empty ledger.  The ledger is one struct column, so other
columns of the input, whatever their names, pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, gram_hashes, mix64, separator_table, text_chunks, words_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters_az", "n_upper_az")

# name -> condition over the measurements that means failure.  A rule's bit is
# its place in this list; rules are only ever appended, so stored ledgers keep
# their meaning.
RULES: list[tuple[str, str]] = [
    ("few_words", "{n_words} < 20"),
    ("repeated_windows", "100 * {n_repeat_words} > 30 * {n_words}"),
    ("many_symbols", "{n_symbols} * 10 > {n_words}"),
    ("shouting", "{n_upper_az} * 2 > {n_letters_az}"),
    ("repeated_lines", "{n_dup_lines} * 10 > {n_lines} * 6"),
    ("odd_word_length", "{word_chars} < 2 * {n_words} OR {word_chars} > 15 * {n_words}"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


def mask_of(*names: str) -> int:
    return sum(1 << BIT[n] for n in names)


# Policies by version.  "base" holds the two rules every policy contains.
POLICIES: dict[str, int] = {
    "base": mask_of("few_words", "repeated_windows"),
    "v1": mask_of("few_words", "repeated_windows", "many_symbols", "shouting"),
    "v2": mask_of("few_words", "repeated_windows", "many_symbols", "shouting", "repeated_lines", "odd_word_length"),
}
CURRENT = "v2"


def _measure(texts: pa.Array) -> pa.Array:
    """The measurements of every text of a batch, over its whole bytes."""
    space = separator_table()
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    out = {m: np.zeros(len(texts), dtype=np.int64) for m in MEASURES}
    for chunk in text_chunks(texts):
        at = slice(chunk.first, chunk.first + len(chunk))
        b, offs = chunk.data, chunk.offsets

        def per_text(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
            return total[offs[1:]] - total[offs[:-1]]

        words = words_of(chunk, space, fold_case=False)
        out["n_words"][at] = words.counts
        # Code points: every byte that does not continue a UTF-8 sequence.
        out["word_chars"][at] = per_text(~space[b] & ((b & 0xC0) != 0x80))
        out["n_symbols"][at] = per_text(symbol[b])
        upper = (b >= 65) & (b <= 90)
        out["n_upper_az"][at] = per_text(upper)
        out["n_letters_az"][at] = per_text(upper | ((b >= 97) & (b <= 122)))
        out["n_repeat_words"][at] = _repeat_words(words, len(chunk))
        for i in range(len(chunk)):
            lines, dup = _line_counts(chunk.text_bytes(i))
            out["n_lines"][chunk.first + i] = lines
            out["n_dup_lines"][chunk.first + i] = dup
    return pa.StructArray.from_arrays([pa.array(out[m]) for m in MEASURES], names=list(MEASURES))


def _repeat_words(words, n_docs: int) -> np.ndarray:
    """Words inside a window of WINDOW words that its text holds twice or more."""
    grams, first = gram_hashes(words, WINDOW)
    if len(grams) < 2:
        return np.zeros(n_docs, np.int64)
    # One key per (text, window); equal keys are equal windows of one text.
    key = mix64(grams + words.doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice) == 0:
        return np.zeros(n_docs, np.int64)
    place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    opens = np.zeros(len(words.hash) + WINDOW, dtype=np.int64)
    opens[first[twice[place] == key] + WINDOW] = 1
    total = np.cumsum(opens)
    # Word i is covered if a repeated window starts at one of i-7 .. i.
    covered = total[WINDOW:] > total[:-WINDOW]
    return np.bincount(words.doc[covered], minlength=n_docs)


def _line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    if b"\n" not in text:
        return (1 if text.strip(b" \t\n\v\f\r") else 0), 0
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def failure_bits(measures: str) -> Column:
    """The failure bitmask from the struct column ``measures``."""
    fields = {m: f"`{measures}`.`{m}`" for m in MEASURES}
    bits = [F.when(F.expr(cond.format(**fields)), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, cond) in enumerate(RULES)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total.cast("bigint")


def with_ledger(docs: DataFrame, text: str = "text", name: str = "ledger") -> tuple[DataFrame, str]:
    """``docs`` with its ledger: a struct ``{failures, <measurements>}``.

    Returns the frame and the struct's name (``name``, made unique).  One
    Arrow-batched pass, no shuffle.
    """
    measures = free_name(docs, "measures")
    name = free_name(docs, name)
    schema = ", ".join(f"{m}: bigint" for m in MEASURES)
    measure = F.arrow_udf(_measure, f"struct<{schema}>")
    out = docs.withColumn(measures, measure(F.col(text)))
    fields = [F.col(measures)[m].alias(m) for m in MEASURES]
    out = out.withColumn(name, F.struct(failure_bits(measures).alias("failures"), *fields))
    return out.drop(measures), name


def passes(ledger: str, policy: str = CURRENT) -> Column:
    """True where the row fails no rule of the policy."""
    return F.col(ledger)["failures"].bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(ledgers: DataFrame, ledger: str = "ledger", policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: one row per rule.

    ``failed``: rows that fail it; ``only``: rows that fail it alone, which the
    policy without it would keep; ``kept_without``: rows kept then.  The texts
    are not read again: rows are first counted by failure pattern (at most
    2**rules of them), and the patterns are then compared bitwise.
    """
    mask = POLICIES[policy]
    patterns = ledgers.groupBy(F.col(ledger)["failures"].bitwiseAND(F.lit(mask)).alias("pattern")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
        for i, (name, _) in enumerate(RULES) if mask >> i & 1
    ])
    each = patterns.select("pattern", "n", F.explode(rules).alias("r")).select("pattern", "n", "r.rule", "r.bit")
    without = F.col("pattern").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("pattern").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("pattern") == F.col("bit"), F.col("n")).otherwise(0)).alias("only"),
        F.sum(F.when(without, F.col("n")).otherwise(0)).alias("kept_without"),
    )


def keep_passing(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with the columns of ``docs``."""
    marked, name = with_ledger(docs)
    return marked.filter(passes(name, policy)).drop(name)
