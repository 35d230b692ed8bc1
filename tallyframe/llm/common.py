"""Helpers shared by the operators: free column names, bounded samples, and
word hashing over whole Arrow batches.

The numpy helpers work on the bytes of many texts at once, in runs of whole
texts of about ``CHUNK_BYTES``, so a task's memory is bounded by that figure
or by the longest single text, never by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 18

# Word pattern of several contracts: runs of anything but these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base_``, ``base__``, ... if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def free_prefix(df: DataFrame, base: str) -> str:
    """A prefix that no column of ``df`` starts with, for an operator's working columns."""
    while any(c.lower().startswith(base) for c in df.columns):
        base += "_"
    return base


def id_crc32(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text (0)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def hash_fraction(*cols: str) -> Column:
    """A number in [0, 1) fixed by the values of ``cols``."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *[F.col(c) for c in cols]), 11)
    return bits / F.lit(float(1 << 53))


# ------------------------------------------------------------------ hashing

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(separators: np.ndarray, fold_case: bool) -> np.ndarray:
    code = np.arange(256, dtype=np.uint64)
    if fold_case:
        code[65:91] += np.uint64(32)
    values = mix64(code * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x2545F4914F6CDD1D))
    values[separators] = 0
    return values


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, n of each."""
    if n <= CHUNK_BYTES * 2:
        n = CHUNK_BYTES * 2
        if n in _powers:
            return _powers[n]
    tables = []
    for base in (_MULT, _INV):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        tables.append(np.multiply.accumulate(p))
    if n == CHUNK_BYTES * 2:
        _powers[n] = (tables[0], tables[1])
    return tables[0], tables[1]


def separator_table(spaces=SPACE_BYTES) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(spaces)] = True
    return table


@dataclass
class TextChunk:
    """A run of whole texts: their bytes, and where each starts."""

    first: int          # index of the first text in the Arrow array
    data: np.ndarray    # uint8
    offsets: np.ndarray  # int64, one more than texts

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[TextChunk]:
    """The texts of an Arrow string array in runs of about ``limit`` bytes; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offs, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return
    offsets = np.frombuffer(offs, dtype=wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield TextChunk(i, raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order."""
    if len(values) == 0:
        return values
    ordered = np.sort(values)
    keep = np.empty(len(ordered), dtype=bool)
    keep[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=keep[1:])
    return ordered[keep]


@dataclass
class Words:
    """The words of a chunk in order: text index, byte span and 64-bit hash."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    counts: np.ndarray  # words of each text


def words_of(chunk: TextChunk, separators: np.ndarray, fold_case: bool) -> Words:
    b, n = chunk.data, len(chunk.data)
    n_docs = len(chunk)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(0, np.uint64), np.zeros(n_docs, np.int64))
    word = ~separators[b]
    edge = np.zeros(n + 1, dtype=bool)
    edge[chunk.offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    doc = np.searchsorted(chunk.offsets[1:], start, side="right")
    if len(start) == 0:
        h = np.zeros(0, np.uint64)
    else:
        power, inverse = _power_tables(n)
        x = _byte_values(separators, fold_case)[b]
        x *= power[:n]
        h = mix64(np.add.reduceat(x, start) * inverse[start])
    return Words(doc, start, end, h, np.bincount(doc, minlength=n_docs))


def gram_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows inside one text, and the index of each window's first word."""
    m = len(words.hash) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(words.doc[:m] == words.doc[k - 1:])
    acc = np.full(len(first), np.uint64(k), dtype=np.uint64)
    for j in range(k):
        acc = (acc + words.hash[first + j]) * np.uint64(_MULT)
        acc ^= acc >> np.uint64(29)
    return mix64(acc), first
