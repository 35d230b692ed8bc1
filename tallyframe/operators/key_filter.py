"""A Bloom filter of join keys, applied to a fact table before its shuffle.

For a dimension above the broadcast bound whose filter keeps few keys.  The
filter is a table of 64-bit words: a key's hash picks a word and four bits in
it.  It is built by a grouped ``bit_or`` (map-side partial sums of at most one
row per word) and joined as a broadcast, so fact rows without a partner leave
in their scan stage; the join that follows drops the few that slip through.

The words are at most ``max_words`` whatever the keys, which bounds the
broadcast.  Keys that need more get no filter, which changes the plan and not
the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import BROADCAST_MAX_ROWS

WORD_BITS = 64
# 16 bits a key: about one row in 200 slips through.
BITS_PER_KEY = 16
BITS_SET = 4
# The word takes the low bits of the hash, each set bit six more above them.
WORD_HASH_BITS = 32


def filter_words(n_keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """Words of a filter for ``n_keys`` keys: a power of two, so that a mask picks one."""
    need = max(1, -(-n_keys * bits_per_key // WORD_BITS))
    return 1 << (need - 1).bit_length()


def _placed(key: Column, words: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    bits = F.lit(0).cast("bigint")
    for i in range(BITS_SET):
        place = F.shiftrightunsigned(h, WORD_HASH_BITS + 6 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return h.bitwiseAND(F.lit(words - 1)), bits


def key_filter(kept: DataFrame, key: str, words: int) -> DataFrame:
    """``word, bits`` of the keys of ``kept``: at most ``words`` rows; null keys are no keys."""
    word, bits = _placed(F.col(key), words)
    return kept.where(F.col(key).isNotNull()).select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(
        F.bit_or("bits").alias("bits")
    )


def prefiltered(
    fact: DataFrame,
    fact_key: str,
    kept: DataFrame,
    kept_key: str,
    n_keys: int | None = None,
    max_words: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """``fact`` without most rows whose key ``kept`` does not hold, and none of the others missing.

    Meant before an inner or left semi join of the two; rows with a null key
    leave.  Repeated keys in ``kept`` are harmless.  ``n_keys`` is its number
    of rows if known (else they are counted).  Both keys must have one type,
    as equal values of two types hash differently.
    """
    types = fact.schema[fact_key].dataType, kept.schema[kept_key].dataType
    if types[0] != types[1]:
        raise ValueError(f"the keys have two types, {types[0].simpleString()} and {types[1].simpleString()}; cast one")
    words = filter_words(kept.count() if n_keys is None else n_keys)
    if words > max_words:
        return fact
    name = "_filter"
    while any(c.lower().startswith(name) for c in fact.columns):
        name += "_"
    lookup = key_filter(kept, kept_key, words).select(F.struct("word", "bits").alias(name))
    word, bits = _placed(F.col(fact_key), words)
    marked = fact.where(F.col(fact_key).isNotNull()).join(F.broadcast(lookup), word == F.col(f"{name}.word"))
    return marked.where(F.col(f"{name}.bits").bitwiseAND(bits) == bits).drop(name)
