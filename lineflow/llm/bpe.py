"""BPE encoding and decoding (operator 9): batched numpy merge rounds.

The distinct words of a batch lie in one flat symbol array.  Pairs get their
ranks by binary search over the sorted pair keys.  A round finds the lowest
rank of each word, merges all its places of that pair from the left, and
searches only the pairs beside a merge again.  Words without a pair left leave the array; the rounds end
when it is empty.  Words are cut out of whole texts with array operations
too, so Python loops over rounds and never over words.

Rows: null and empty texts have no tokens (an empty array, decoded as "").
Texts of any length are encoded whole.  Repeated rows give repeated results.
Other columns ride along; an input column of the output's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType

from lineflow.llm.textops import (
    OTHER,
    SPACE,
    byte_symbols,
    char_classes,
    read_vocabulary,
    spans_of,
    text_slices,
    with_field,
    words_of,
)

NONE = np.int64(1) << 40  # rank of a pair that never merges
KNOWN, KNOWN_BYTES = 1 << 17, 32  # words that a worker keeps, and their greatest length
BREAK = 9  # class of separators between texts and of special strings


class MergeTables:
    """A byte-level BPE vocabulary as arrays; small, and shipped by broadcast."""

    def __init__(self, path: str):
        vocab, merges, self.special, _ = read_vocabulary(path)
        symbols = byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols], np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        two = np.arange(1 << 16)
        first = self.byte_id[two >> 8] << 32 | self.byte_id[two & 255]
        found = np.minimum(np.searchsorted(self.keys, first), len(self.keys) - 1)
        self.byte_ranks = np.where(self.keys[found] == first, self.ranks[found], NONE)  # of two bytes
        back = {s: b for b, s in enumerate(symbols)}
        pieces = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            pieces[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.known = pa.array([], pa.binary())
        self.known_ids = self.known_at = self.known_len = np.empty(0, np.int64)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_len = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len


def find_special(text: str, special: dict[str, int]) -> list[tuple[int, int]]:
    """Spans of special strings, leftmost and longest first."""
    if not special or not any(s in text for s in special):
        return []
    pattern = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
    return [m.span() for m in re.finditer(pattern, text)]


def joined(texts: list[str], special: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a separator; their classes (BREAK for
    separators and special strings); the separators' places; the starts of special strings."""
    whole = "\0".join(texts) + "\0" if texts else ""
    cps = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = char_classes()[cps]
    seps = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) - 1
    kinds[seps] = BREAK
    marks = find_special(whole, special)
    for a, b in marks:
        kinds[a:b] = BREAK
    return cps, kinds, seps, np.array([a for a, _ in marks], np.int64)


def contraction_lengths(cps: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """At each apostrophe: 1 before s t m d, 2 before re ve ll, else 0."""
    out = np.zeros(len(cps), np.int64)
    at = np.flatnonzero((cps == 39) & (kinds == OTHER))
    padded = np.concatenate([cps, np.zeros(2, np.uint32)])
    one, two = padded[at + 1], padded[at + 2]
    out[at] = np.where(np.isin(one, [115, 116, 109, 100]), 1, 0)
    pairs = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    out[at[pairs]] = 2
    return out


def word_starts(cps: np.ndarray, kinds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """True where a word of the byte-level pattern begins.

    A word is a run of letters, of numbers or of other signs with at most one
    blank before it, an apostrophe with its contraction, or white space; the
    last sign of white space before a word stands alone unless it is that blank.
    """
    n = len(cps)
    prev = np.concatenate([[BREAK], kinds[:-1]])
    after = np.concatenate([kinds[1:], [BREAK]])
    start = (kinds != prev) | (kinds == BREAK)
    for a in marks:  # one piece per special string
        end = a + 1
        while end < n and kinds[end] == BREAK and cps[end] != 0:
            end += 1
        start[a + 1:end] = False
    start[marks] = True
    word_next = (after != SPACE) & (after != BREAK)
    last_space = (kinds == SPACE) & word_next
    start |= last_space
    blank_before = np.concatenate([[False], (cps[:-1] == 32) & last_space[:-1]])
    start &= ~blank_before
    length = contraction_lengths(cps, kinds)
    alone = (length > 0) & (prev != OTHER) & ~blank_before
    at = np.flatnonzero(alone)
    start[at + 1] = False
    end = at + 1 + length[at]
    start[end[end < n]] = True
    return start


def pair_ranks(t: MergeTables, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the pairs that begin at the places ``at``, by binary search; NONE where a word ends or no merge exists."""
    after = np.minimum(at + 1, len(sym) - 1)
    key = sym[at] << 32 | sym[after]
    found = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
    return np.where((t.keys[found] == key) & (word[at] == word[after]) & (at != after), t.ranks[found], NONE)


def merge_words(t: MergeTables, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each word (bytes), flat, and how many each has."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if n and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    sym = t.byte_id[raw]
    word = np.repeat(np.arange(n), np.diff(offsets))
    rank = np.full(len(sym), NONE)
    rank[:-1] = np.where(word[:-1] == word[1:], t.byte_ranks[raw[:-1].astype(np.int32) << 8 | raw[1:]], NONE)
    done_sym, done_word = [], []
    while len(sym):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        count = np.diff(np.append(first, len(sym)))
        lowest = np.repeat(np.minimum.reduceat(rank, first), count)
        over = lowest == NONE
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
        pick = (rank == lowest) & ~over
        # equal signs in a row: every other pair, from the left
        chosen = np.flatnonzero(pick)
        run = np.concatenate([[True], np.diff(chosen) != 1]) if len(chosen) else np.empty(0, bool)
        origin = chosen[np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))] if len(chosen) else chosen
        chosen = chosen[(chosen - origin) % 2 == 0]
        sym[chosen] = t.merged[rank[chosen]]
        keep = ~over
        keep[chosen + 1] = False
        place = np.cumsum(keep) - 1
        sym, word, rank = sym[keep], word[keep], rank[keep]
        # only pairs beside a merge are new
        beside = place[chosen]
        beside = np.concatenate([beside, beside[beside > 0] - 1])
        rank[beside] = pair_ranks(t, sym, word, beside)
    if not done_sym:
        return np.empty(0, np.int64), np.zeros(n, np.int64)
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], np.bincount(word, minlength=n)


def known_words(t: MergeTables, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``merge_words``, with each word's start: words that this worker met before (up to ``KNOWN``) aren't merged again."""
    at = pc.index_in(words, value_set=t.known)
    fresh = at.is_null()
    new = words.filter(fresh)
    ids, count = merge_words(t, new)
    starts = np.cumsum(count) - count + len(t.known_ids)
    is_new = fresh.to_numpy(zero_copy_only=False)
    start, length = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    start[is_new], length[is_new] = starts, count
    old = at.drop_null().to_numpy().astype(np.int64)
    start[~is_new], length[~is_new] = t.known_at[old], t.known_len[old]
    pool = np.concatenate([t.known_ids, ids])
    room = KNOWN - len(t.known)
    if room > 0 and len(new):
        short = np.flatnonzero(pc.binary_length(new).to_numpy() <= KNOWN_BYTES)[:room]
        t.known_at = np.concatenate([t.known_at, len(t.known_ids) + np.cumsum(count[short]) - count[short]])
        t.known_len = np.concatenate([t.known_len, count[short]])
        t.known_ids = np.concatenate([t.known_ids, ids[spans_of(starts[short] - len(t.known_ids), count[short])]])
        t.known = pa.concat_arrays([t.known, new.take(pa.array(short))])
    return pool, start, length


def encode_texts(t: MergeTables, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the texts, flat, and the n+1 offsets of the texts."""
    if not texts:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    cps, kinds, seps, marks = joined(texts, t.special)
    starts = np.flatnonzero(word_starts(cps, kinds, marks))
    words = words_of(cps, starts)
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids, at, count = known_words(t, words.dictionary)
    lengths = count[codes]
    sep_words = np.searchsorted(starts, seps)
    lengths[sep_words] = 0
    special = np.searchsorted(starts, marks)
    lengths[special] = 1
    flat = ids[spans_of(at[codes], lengths)].astype(np.int32)
    ends = np.cumsum(lengths)
    if len(marks):
        whole = words.dictionary.to_pylist()
        flat[ends[special] - 1] = [t.special[whole[c].decode()] for c in codes[special]]
    return flat, np.concatenate([[0], ends[sep_words]])


def decode_bytes(t: MergeTables, ids: np.ndarray) -> np.ndarray:
    """The bytes of a run of token ids."""
    return t.piece_bytes[spans_of(t.piece_at[ids], t.piece_len[ids])]


def _tables(spark, path: str):
    return spark.sparkContext.broadcast(_read(path))


@lru_cache(maxsize=4)
def _read(path: str) -> MergeTables:
    return MergeTables(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of every whole text as ``ARRAY<INT>``; special strings in a text are their ids."""
    tables = _tables(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        for batch in batches:
            for part in text_slices(batch, text):
                flat, offsets = encode_texts(t, ["" if x is None else x for x in part.column(text).to_pylist()])
                new = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                names = [c for c in part.schema.names if c != ids]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), new], names=[*names, ids])

    return df.mapInArrow(run, with_field(df.schema, ids, ArrayType(IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids; bytes that are no UTF-8 become U+FFFD; null ids give ""."""
    tables = _tables(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        for batch in batches:
            new = []
            for tokens in batch.column(ids):
                own = tokens.values
                new.append(decode_bytes(t, own.to_numpy(zero_copy_only=False)).tobytes().decode("utf-8", "replace")
                           if own is not None and len(own) else "")
            names = [c for c in batch.schema.names if c != text]
            out = [*(batch.column(c) for c in names), pa.array(new, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=[*names, text])

    return df.mapInArrow(run, with_field(df.schema, text, StringType()))
