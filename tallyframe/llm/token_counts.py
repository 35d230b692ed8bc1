"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

For every prefix of a piece of text the program stores the exact number of
tokens.  A byte-level BPE encoding is the one way to cut a piece into tokens
such that every two neighbours stay apart when encoded together; so the last
token of a prefix is the one suffix that is compatible with the last token of
the prefix before it, and its count is that prefix's count plus one.  Counts
of whole texts, truncation to a budget and windows of at most N tokens are
then look-ups, with no second encoding.

Texts are first cut into pieces as the vocabulary's published splitting
pattern says (contractions, letters, digits, other, white space).  The cut is
made for whole Arrow batches at once from the code points' classes; the
program runs once per distinct piece that a worker meets.  A worker remembers
at most ``CACHE_PIECES`` pieces and then starts over: a bound on memory, never
on results.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings
inside a text are single tokens (the library's default); repeated rows count
alike; an empty table gives an empty result.  A very long text is counted whole
(a very long piece costs its length in prefixes).  New columns are renamed if
their names are taken; no column of the input changes.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tallyframe.llm.common import CHUNK_BYTES, free_name, mix64, text_chunks

CACHE_PIECES = 1_000_000
LIMIT = 1024

# The classes and contractions of the published splitting
# pattern  's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
SHORT_CONTRACTIONS = "stmd"
LONG_CONTRACTIONS = ("re", "ve", "ll")

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_tables: dict = {}


def _classes() -> np.ndarray:
    if "classes" not in _tables:
        first = {"L": LETTER, "N": DIGIT, "C": OTHER}
        category = [unicodedata.category(chr(c)) for c in range(sys.maxunicode + 1)]
        table = np.fromiter((first.get(k[0], OTHER) for k in category), np.uint8, len(category))
        # Code points newer than this Python are classed as the library does.
        newer = [c for c in range(0x40000) if category[c] == "Cn"]
        spans = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"a{chr(c)}!" for c in newer))
        ends = {span[1] for _, span in spans}
        for i, c in enumerate(newer):
            if 3 * i + 1 not in ends:
                table[c] = LETTER
            elif 3 * i + 2 in ends:
                table[c] = DIGIT
        table[WHITE_SPACE] = SPACE
        _tables["classes"] = table
    return _tables["classes"]


def piece_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pieces of a run of texts start, as indices into ``points``.

    ``points``: code points of all texts; ``texts``: start of each text (and
    the end of the last one).  No piece crosses the start of a text.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    first = np.zeros(n + 1, dtype=bool)   # first code point of a text, or the end
    first[texts] = True
    start = np.empty(n, dtype=bool)
    start[0] = True
    start[1:] = kind[1:] != kind[:-1]
    start |= first[:n]
    # A blank directly before anything but white space opens that piece; any
    # other last white space before it is a piece of its own.
    blank = points == 0x20
    follows = np.zeros(n, dtype=bool)     # white space, then other in the same text
    follows[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]
    at = np.flatnonzero(follows)
    start[at] = True
    joined = at[blank[at]]
    start[joined + 1] = False
    # Contractions: a lone apostrophe that opens a piece, and letters after it.
    quote = np.flatnonzero((points == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
    if len(quote):
        a = points[quote + 1]
        short = np.isin(a, [ord(c) for c in SHORT_CONTRACTIONS])
        has_two = quote + 2 < n
        b = points[np.minimum(quote + 2, n - 1)]
        has_two &= ~first[np.minimum(quote + 2, n)]
        long = np.zeros(len(quote), dtype=bool)
        for pair in LONG_CONTRACTIONS:
            long |= has_two & (a == ord(pair[0])) & (b == ord(pair[1]))
        for which, length in ((short, 2), (long & ~short, 3)):
            q = quote[which]
            start[q + 1] = False
            after = q + length
            after = after[after < n]
            start[after] |= (kind[after] == LETTER) | first[after]
    return np.flatnonzero(start)


class PrefixCounter:
    """Exact token counts of every prefix for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        self.tokens: dict[bytes, int] = {}
        for text, i in spec["model"]["vocab"].items():
            if all(c in letters for c in text):
                self.tokens[bytes(letters[c] for c in text)] = i
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[bytes(letters[c] for c in left), bytes(letters[c] for c in right)] = r
        self.special = [t["content"] for t in spec["added_tokens"]]
        # Every suffix of a token, and whether it is a token itself.
        self.suffixes = {t[i:]: False for t in self.tokens for i in range(1, len(t))} | dict.fromkeys(self.tokens, True)
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.totals: dict[bytes, int] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece by the merge rule itself: lowest rank first, leftmost first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.rank.get((parts[i], parts[i + 1])) for i in range(len(parts) - 1)]
            known = [r for r in ranks if r is not None]
            if not known:
                break
            i = ranks.index(min(known))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: bytes, right: bytes) -> bool:
        """True if the two tokens stay apart when encoded together."""
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= CACHE_PIECES:
                self.apart.clear()
            known = self.apart[key] = self.merged(left + right) == [left, right]
        return known

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of every byte prefix of one piece: the dynamic program."""
        n = len(piece)
        counts, last = [0] * (n + 1), [b""] * (n + 1)
        suffixes, apart, compatible = self.suffixes, self.apart, self.compatible
        for end in range(1, n + 1):
            for begin in range(end - 1, -1, -1):
                token = piece[begin:end]
                known = suffixes.get(token)
                if known is None:
                    break
                if known and (begin == 0 or (apart.get((last[begin], token)) or compatible(last[begin], token))):
                    counts[end], last[end] = counts[begin] + 1, token
                    break
        return counts

    def piece_total(self, piece: bytes) -> int:
        total = self.totals.get(piece)
        if total is None:
            if len(self.totals) >= CACHE_PIECES:
                self.totals.clear()
            total = self.totals[piece] = self.piece_counts(piece)[-1]
        return total

    # ------------------------------------------------------- whole batches

    def batch_totals(self, texts: pa.Array) -> np.ndarray:
        """Tokens of every text of an Arrow array."""
        out = np.zeros(len(texts), dtype=np.int64)
        for chunk in text_chunks(texts, CHUNK_BYTES):
            data = chunk.data.tobytes()
            if any(s.encode() in data for s in self.special):
                totals = [self.text_total(chunk.text_bytes(i).decode("utf-8")) for i in range(len(chunk))]
                out[chunk.first:chunk.first + len(chunk)] = totals
            else:
                out[chunk.first:chunk.first + len(chunk)] = self._plain_totals(data, chunk.data, chunk.offsets)
        return out

    def _plain_totals(self, data: bytes, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)      # byte place of every code point
        texts = np.searchsorted(lead, offsets)           # code point place of every text
        start = piece_starts(points, texts)
        if len(start) == 0:
            return np.zeros(len(offsets) - 1, dtype=np.int64)
        begin = lead[start]
        end = np.append(begin[1:], len(raw))
        keys = _span_hashes(raw, begin)
        _, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = self.piece_total
        counts = np.fromiter(
            (total(data[b:e]) for b, e in zip(begin[where].tolist(), end[where].tolist(), strict=True)),
            np.int64, len(where),
        )
        sums = np.concatenate(([0], np.cumsum(counts[inverse])))
        edge = np.searchsorted(start, texts)
        return sums[edge[1:]] - sums[edge[:-1]]

    # --------------------------------------------------------- one text

    def _segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special strings: (segment, is special)."""
        out, at = [], 0
        while True:
            found = min(((p, s) for s in self.special if (p := text.find(s, at)) >= 0), default=None)
            if found is None:
                return [*out, (text[at:], False)]
            out += [(text[at:found[0]], False), (found[1], True)]
            at = found[0] + len(found[1])

    def pieces(self, text: str) -> list[str]:
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        start = piece_starts(points, np.array([0, len(points)])).tolist()
        if not start:
            return []
        return [text[a:b] for a, b in zip(start, [*start[1:], len(text)], strict=True)]

    def text_total(self, text: str) -> int:
        return sum(1 if special else sum(self.piece_total(p.encode()) for p in self.pieces(s))
                   for s, special in self._segments(text))

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of ``text[:i]`` for every i from 0 to its length in code points."""
        text = text or ""
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = done = 0
        for segment, special in self._segments(text):
            if special:
                # Until the string is complete it is ordinary text, which may
                # join the piece before it.
                back = max((p for p in (text.rfind(" ", 0, at), text.rfind("\n", 0, at)) if p >= 0), default=0)
                for i in range(1, len(segment)):
                    out[at + i] = out[back] + self.text_total(text[back:at + i]) if back else self.text_total(text[:at + i])
                done += 1
                at += len(segment)
                out[at] = done
                continue
            for piece in self.pieces(segment):
                counts = self._inside(piece)
                out[at + 1:at + 1 + len(piece)] = done + counts[1:]
                white = len(piece) - len(piece.lstrip(_WHITE))
                if white == 1 and at and text[at - 1] in _WHITE:
                    # Cut right after this blank, the white space before it
                    # and the blank are one piece.
                    run = at
                    while run and text[run - 1] in _WHITE:
                        run -= 1
                    out[at + 1] = out[run] + self.piece_total(text[run:at + 1].encode())
                done += int(counts[-1])
                at += len(piece)
        return out

    def _inside(self, piece: str) -> np.ndarray:
        """Counts at the code point ends inside one piece."""
        raw = piece.encode()
        by_byte = self.piece_counts(raw)
        ends = np.cumsum([0, *(len(c.encode()) for c in piece)])
        counts = np.array(by_byte)[ends]
        if piece[:1] == "'" and len(piece) == 3 and piece[1:] in LONG_CONTRACTIONS:
            counts[2] = counts[1] + self.piece_total(piece[1].encode())
        return counts

    def longest_within(self, counts: np.ndarray, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens, from its prefix counts."""
        return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


_WHITE = "".join(map(chr, WHITE_SPACE))


def _byte_letters() -> dict[str, int]:
    """The printable stand-in letter of every byte in a byte-level vocabulary file.

    Fixed rule of the format: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _span_hashes(raw: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes that starts at ``begin`` (the spans tile ``raw``)."""
    from tallyframe.llm.common import _power_tables

    power, inverse = _power_tables(len(raw))
    value = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    x = value[raw]
    x *= power[:len(raw)]
    return mix64(np.add.reduceat(x, begin) * inverse[begin])


def counter(path: str) -> PrefixCounter:
    """The worker's counter for a vocabulary file, read once per process."""
    if path not in _tables:
        _tables[path] = PrefixCounter(path)
    return _tables[path]


def with_token_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> tuple[DataFrame, str]:
    """``docs`` with the exact token count of every whole text, and the new column's name; no shuffle."""
    name = free_name(docs, name)
    count = F.arrow_udf(lambda texts: pa.array(counter(path).batch_totals(texts)), "bigint")
    return docs.withColumn(name, count(F.col(text))), name


def with_prefix_counts(docs: DataFrame, path: str, text: str = "text", name: str = "prefix_counts") -> tuple[DataFrame, str]:
    """``docs`` with an array of the token counts of every prefix (one more entry than code points), and its name."""
    name = free_name(docs, name)

    def all_counts(texts: pa.Array) -> pa.Array:
        c = counter(path)
        return pa.array([c.prefix_counts(t) for t in texts.to_pylist()], pa.list_(pa.int64()))

    return docs.withColumn(name, F.arrow_udf(all_counts, "array<bigint>")(F.col(text))), name


def truncated(docs: DataFrame, path: str, budget: int, text: str = "text", name: str = "text_cut") -> tuple[DataFrame, str]:
    """``docs`` with the longest prefix of each text that has at most ``budget`` tokens, and the new column's name."""
    name = free_name(docs, name)
    marked, counts = with_prefix_counts(docs, path, text)
    # exists a prefix of length 0 with 0 tokens, so a match is always there.
    last = F.size(F.col(counts)) - F.array_position(F.reverse(F.transform(
        F.col(counts), lambda n: n <= F.lit(budget))), F.lit(True))
    return marked.withColumn(name, F.substring(F.col(text), F.lit(1), last.cast("int"))).drop(counts), name
