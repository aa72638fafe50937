"""Token counts (operator 7): the tokenizer compiled into finite-state transducers.

Two deterministic transducers count tokens without building them.

* The splitter runs over character classes.  Texts are cut into chunks of
  ``CHUNK`` characters; the map "state before -> state after" of every chunk
  is made for all states at once, the maps compose in a parallel prefix
  scan, and each chunk then runs once from its true state, its transitions
  marking where words begin.
* The counter runs over the bytes of a word.  A state holds what the next
  byte can depend on: for each place from which a vocabulary entry may still
  be running, the entry's trie node, the last token before that place and
  the count there.  A transition carries the change of the token count; a
  transition over a word's last byte closes it.  Transitions are compiled
  the first time they are met and kept by the worker (``MAX_TRANSITIONS``
  bounds the table: beyond it, it is dropped and compiled anew).

The last token after each prefix is unique: of the entries that end there,
only one stands next to the token before it without the two merging across
their border (``Merges.apart``).

Rows: null and empty texts have 0 tokens.  Texts of any length are counted
whole, repeated rows alike.  Other columns ride along; an input column of
the output's name is replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType

from lineflow.llm.bpe import contraction_lengths, find_special
from lineflow.llm.textops import (
    LETTER,
    OTHER,
    SPACE,
    byte_symbols,
    char_classes,
    read_vocabulary,
    text_slices,
    with_field,
    words_of,
)

CHUNK = 256
MAX_TRANSITIONS = 2_000_000
# classes beyond those of single characters
SHORT, LONG, BREAK = 4, 5, 6  # apostrophe before a contraction of one or two letters; border of texts
FRESH, IN_SPACE, IN_WORD, IN_SIGNS, ONE_LEFT, TWO_LEFT = range(6)


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a word begins here", by state and class."""
    after = np.zeros((6, 7), np.uint8)
    begins = np.ones((6, 7), bool)
    for state in range(6):
        after[state] = [IN_SPACE, IN_WORD, FRESH, IN_SIGNS, ONE_LEFT, TWO_LEFT, FRESH]
    begins[IN_SPACE, SPACE] = False
    begins[IN_WORD, LETTER] = False
    for sign in (OTHER, SHORT, LONG):
        after[IN_SIGNS, sign] = IN_SIGNS
        begins[IN_SIGNS, sign] = False
    after[ONE_LEFT, LETTER], begins[ONE_LEFT, LETTER] = FRESH, False
    after[TWO_LEFT, LETTER], begins[TWO_LEFT, LETTER] = ONE_LEFT, False
    return after, begins


def split_scan(kinds: np.ndarray) -> np.ndarray:
    """True where a word begins: chunk maps, their prefix composition, one run per chunk."""
    after, begins = splitter_tables()
    n = len(kinds)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, BREAK, np.uint8)
    padded[:n] = kinds
    steps = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)  # step j of every chunk
    maps = np.tile(np.arange(6, dtype=np.uint8), (chunks, 1))
    for step in steps:
        maps = after[maps, step[:, None]]
    shift = 1
    while shift < chunks:  # maps[i] becomes the map of chunks 0..i
        later, earlier = maps[shift:], maps[:-shift]
        maps = np.concatenate([maps[:shift], np.take_along_axis(later, earlier.astype(np.intp), 1)])
        shift *= 2
    state = np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)
    out = np.empty((CHUNK, chunks), bool)
    for j, step in enumerate(steps):
        out[j] = begins[state, step]
        state = after[state, step]
    return out.T.reshape(-1)[:n]


class Merges:
    """The vocabulary as tries over 512 symbols: 256 bytes, and 256 bytes that end a word."""

    def __init__(self, path: str):
        vocab, merges, self.special, end = read_vocabulary(path)
        back = {s: b for b, s in enumerate(byte_symbols())}
        pair = [(vocab[a], vocab[b]) for a, b in merges]
        made = [vocab[a + b] for a, b in merges]
        self.rank = {p: r for r, p in enumerate(pair)}
        self.parts = dict(zip(made, pair, strict=True))
        self.born = {m: r for r, m in enumerate(made)}
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for text, i in vocab.items():
            closed = bool(end) and text.endswith(end)
            symbols = [back[c] for c in (text[:-len(end)] if closed else text)]
            if closed and symbols:
                symbols[-1] += 256
            node = 0
            for s in symbols:
                if s not in self.child[node]:
                    self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][s]
            self.token[node] = i
        self.known: dict[tuple[int, int], bool] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether the two tokens stay two when their symbols are merged together.

        Undo their merges from the latest on: the pieces that touch at the
        border would have merged if their pair ranks before the merge that
        takes either into its own token (an equal rank goes to the left place).
        """
        if left < 0:
            return True
        key = (left, right)
        if key in self.known:
            return self.known[key]
        a, b, a_end, b_end = left, right, 1 << 40, 1 << 40
        while True:
            r = self.rank.get((a, b), 1 << 41)
            if r < a_end and r <= b_end:
                out = False
                break
            a_born, b_born = self.born.get(a, -1), self.born.get(b, -1)
            if b_born >= a_born and b_born >= 0:
                b_end, b = b_born, self.parts[b][0]
            elif a_born >= 0:
                a_end, a = a_born, self.parts[a][1]
            else:
                out = True
                break
        if len(self.known) > MAX_TRANSITIONS:
            self.known.clear()
        self.known[key] = out
        return out


class Counter:
    """The counting transducer, compiled transition by transition."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.reset()

    def reset(self) -> None:
        self.states = [((0, -1, 0),)]  # (trie node, last token before it, count there against the count here)
        self.number = {self.states[0]: 0}
        self.moves: dict[int, int] = {}  # state * 512 + symbol -> next state * 4096 + count change + 2048

    def compile(self, key: int) -> int:
        m, symbol = self.merges, key % 512
        running, last, change = [], -1, None
        for node, before, count in self.states[key // 512]:
            node = m.child[node].get(symbol, -1)
            if node < 0:
                continue
            token = m.token[node]
            if token >= 0 and change is None and m.apart(before, token):
                last, change = token, count + 1
            if m.child[node]:
                running.append((node, before, count))
        if change is None:
            raise ValueError("the vocabulary does not cover this word")
        state = (*((n, b, c - change) for n, b, c in running), (0, last, 0))
        to = self.number.setdefault(state, len(self.states))
        if to == len(self.states):
            self.states.append(state)
        self.moves[key] = to * 4096 + change + 2048
        return self.moves[key]

    def count(self, words: pa.Array) -> np.ndarray:
        """Tokens of each word (bytes); the words step together, byte by byte."""
        n = len(words)
        if len(self.moves) > MAX_TRANSITIONS:
            self.reset()
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(words.buffers()[2], np.uint8)
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        at, size = offsets[:-1][order], length[order]
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        get, make = self.moves.get, self.compile
        live = int(np.searchsorted(-size, 0))
        step = 0
        while live:
            symbol = raw[at[:live] + step].astype(np.int64) + np.where(size[:live] == step + 1, 256, 0)
            keys, where = np.unique(state[:live] * 512 + symbol, return_inverse=True)
            moves = np.array([get(k) or make(k) for k in keys.tolist()], np.int64)[where]
            state[:live] = moves // 4096
            total[:live] += moves % 4096 - 2048
            step += 1
            live = int(np.searchsorted(-size, -step))
        out = np.empty(n, np.int64)
        out[order] = total
        return out


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower case of every code point that has one of a single code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        if not 0xD800 <= cp < 0xE000:
            low = chr(cp).lower()
            if len(low) == 1:
                out[cp] = ord(low)
    return out


def normalize(text: str) -> str:
    """Canonical composition; the one capital whose lower case takes two code points is spelled out."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("İ", "i̇")
    return text


def count_tokens(counter: Counter, texts: list[str]) -> np.ndarray:
    """Tokens of each text; a special string in a text is one token."""
    if not texts:
        return np.empty(0, np.int64)
    special = counter.merges.special
    pieces: list[str] = []
    owner: list[int] = []
    extra = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        marks = find_special(text, special)
        extra[i] = len(marks)
        for a, b in zip([0, *(m[1] for m in marks)], [*(m[0] for m in marks), len(text)], strict=True):
            pieces.append(normalize(text[a:b]))
            owner.append(i)
    whole = "\0".join(pieces) + "\0"
    cps = lower_table()[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
    kinds = char_classes()[cps]
    seps = np.cumsum(np.array([len(p) + 1 for p in pieces], np.int64)) - 1
    kinds[seps] = BREAK
    length = contraction_lengths(cps, kinds)
    kinds[length == 1] = SHORT
    kinds[length == 2] = LONG
    starts = np.flatnonzero(split_scan(kinds))
    words = words_of(cps, starts)
    kind = kinds[starts]
    codes = words.indices.to_numpy(zero_copy_only=False)
    counts = counter.count(words.dictionary)[codes]
    counts[(kind == SPACE) | (kind == BREAK)] = 0
    ends = np.cumsum(counts)[np.searchsorted(starts, seps)]
    return extra + np.bincount(owner, weights=np.diff(ends, prepend=0), minlength=len(texts)).astype(np.int64)


_COUNTERS: dict[str, Counter] = {}


@lru_cache(maxsize=4)
def _read(path: str) -> Merges:
    return Merges(path)


def token_counts(df: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of every whole text, as the vocabulary file at ``path`` cuts it."""
    merges = df.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(path)  # one per worker; the tables are the broadcast ones
        if counter is None:
            counter = _COUNTERS[path] = Counter(merges.value)
        for batch in batches:
            for part in text_slices(batch, text):
                new = count_tokens(counter, ["" if x is None else x for x in part.column(text).to_pylist()])
                names = [c for c in part.schema.names if c != n_tokens]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(new)],
                                                 names=[*names, n_tokens])

    return df.mapInArrow(run, with_field(df.schema, n_tokens, LongType()))
