"""Phrase collocation mining (operator 13) by weighted acyclic automata.

Words are cut out of pieces of text; every place of a word starts the phrases
of one to ``DEPTH`` words that the piece still has room for.

* A first pass finds what can't be frequent: every shard counts its phrases of
  one, two and three words in buckets of a hash, the buckets' sums over all
  shards are exact upper bounds, and the bits of the heavy buckets go to all
  tasks (``heavy_buckets``; at most ``3 * 2 ** MAX_BITS / 8`` bytes, however
  much text there is: then more phrases pass, none is lost).
* A task sorts the n-grams of a shard of its rows (about ``SHARD_BYTES`` of
  text) whose parts are all in heavy buckets, and builds an acyclic automaton
  from the sorted list, level by level:
  states share their prefix, a state's weight is the number of times its
  phrase occurs (``Automaton``).  Phrases of one and two words form one family,
  longer ones another, in which the weights of a long phrase count for its
  beginnings of three words and more too.
* Automata are cut by prefix range (a hash of the language and of the first
  words, three at most) and shipped as packed arrays with their own word list.
  All of a phrase's weight meets in one range; a phrase that is frequent
  everywhere is still one state a shard, so it makes no range large.  The
  union of a range's automata sums the weights; only states of weight
  ``least`` and more leave it, which keeps every part of those phrases too.
* Candidates are composed with the counts of their parts: each cut asks for
  the weights of both parts by a join, single words (the parts that most
  candidates ask for) salted.

Counts are exact: no text is left out, and no phrase that reaches ``least`` is
dropped before its weights are summed.  The number of ranges follows the bytes of the text, so
that a range stays about as large whatever the input.

Rows: null texts count as empty and have no words; a null language is
``und``.  Texts of any length count whole, repeated rows each time.  Of cuts
with the same score the smallest counts.  An empty table has no phrases.
Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.textops import give_back, packed_words, spans_of, text_slices, utf8_bytes, word_spans
from lineflow.session import new_run_dir

DEPTH = 5
PREFIX = 3
SHARD_BYTES = 8 << 20
RANGE_BYTES = 32 << 20  # of text whose phrases one range holds, about
MIN_BITS, MAX_BITS = 16, 28  # buckets of the first pass, as powers of two
PART_BITS = 18  # buckets that one task sums at a time
BUCKETED = 3  # words of the longest phrase with buckets
SALTS = 32
TOP_SALTS = 64
UNKNOWN = "und"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 up, each in the least width that holds it, compressed."""
    parts = []
    for array in arrays:
        kind = np.dtype(np.min_scalar_type(int(array.max()) if len(array) else 0))
        parts += [np.array([len(array), kind.itemsize], "<u4").tobytes(), array.astype(kind.newbyteorder("<")).tobytes()]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_arrays(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    arrays, at = [], 0
    while at < len(raw):
        n, width = np.frombuffer(raw, "<u4", 2, at).tolist()
        arrays.append(np.frombuffer(raw, f"<u{width}", n, at + 8).astype(np.int64))
        at += 8 + n * width
    return arrays


class Automaton:
    """Phrases of up to ``DEPTH`` words as an acyclic automaton in arrays, one level of states per word.

    ``words``: the word list (binary).  Of each level's states, in sorted
    order: ``labels`` (word numbers), ``fans`` (how many states follow each)
    and ``ends`` (how often a phrase ends there).
    """

    def __init__(self, words: pa.Array, labels: list[np.ndarray], fans: list[np.ndarray], ends: list[np.ndarray]):
        self.words, self.labels, self.fans, self.ends = words, labels, fans, ends

    @classmethod
    def from_sorted(cls, words: pa.Array, grams: np.ndarray, weights: np.ndarray) -> Automaton:
        """From sorted distinct rows of word numbers (0 ends a phrase, word k is k + 1) and their weights."""
        labels, fans, ends = [], [], []
        n, depth = grams.shape if grams.size else (0, grams.shape[1])
        new = np.zeros(n, bool)  # a state's first row, at this level
        new[:1] = True
        above = np.zeros(n, np.int64)
        for d in range(depth):
            live = grams[:, d] > 0
            new = new.copy()
            new[1:] |= grams[1:, d] != grams[:-1, d]
            first = np.flatnonzero(new & live)
            state = np.cumsum(new & live) - 1  # of live rows
            if d:
                fans.append(np.bincount(above[first], minlength=len(labels[-1])))
            labels.append(grams[first, d] - 1)
            last = live & (grams[:, d + 1] == 0 if d + 1 < depth else True)
            ends.append(np.bincount(state[last], weights[last], minlength=len(first)).astype(np.int64))
            above = state
        fans.append(np.zeros(len(labels[-1]), np.int64))
        return cls(words, labels, fans, ends)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted rows and weights of the phrases that end somewhere."""
        depth = len(self.labels)
        paths: list[np.ndarray] = []
        out, weights = [], []
        for d in range(depth):
            if d:
                up = np.repeat(np.arange(len(self.labels[d - 1])), self.fans[d - 1])
                paths = [p[up] for p in paths]
            paths.append(self.labels[d] + 1)
            here = np.flatnonzero(self.ends[d])
            rows = np.zeros((len(here), depth), np.int64)
            for k, p in enumerate(paths):
                rows[:, k] = p[here]
            out.append(rows)
            weights.append(self.ends[d][here])
        return np.concatenate(out), np.concatenate(weights)

    def counts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each level, the paths of its states (word numbers, from 0) and how many phrases begin with them."""
        depth, total = len(self.labels), None
        totals = []
        for d in range(depth - 1, -1, -1):
            own = self.ends[d].copy()
            if total is not None:
                own += np.bincount(np.repeat(np.arange(len(own)), self.fans[d]), total, minlength=len(own)).astype(np.int64)
            totals.append(own)
            total = own
        out, path = [], None
        for d, own in enumerate(reversed(totals)):
            up = np.repeat(np.arange(len(self.labels[d - 1])), self.fans[d - 1]) if d else None
            path = self.labels[d][:, None] if path is None else np.concatenate([path[up], self.labels[d][:, None]], axis=1)
            out.append((path, own))
        return out

    def pack(self) -> bytes:
        """The arrays, compressed; the word list goes its own way."""
        return pack_arrays(*self.labels, *self.fans, *self.ends)

    @classmethod
    def unpack(cls, words: pa.Array, blob: bytes) -> Automaton:
        arrays = unpack_arrays(blob)
        n = len(arrays) // 3
        return cls(words, arrays[:n], arrays[n:2 * n], arrays[2 * n:])


def summed(grams: np.ndarray, weights: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, sorted, with the sums of their weights; entries are 0 to ``words``."""
    if not len(grams):
        return grams, weights
    bits = max(1, int(words).bit_length())
    per = 63 // bits  # columns that one sort key holds
    keys = []
    for a in range(0, grams.shape[1], per):
        key = np.zeros(len(grams), np.int64)
        for d in range(a, min(a + per, grams.shape[1])):
            key = key << bits | grams[:, d]
        keys.append(key)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    first = np.zeros(len(grams), bool)
    first[0] = True
    for key in keys:
        key = key[order]
        first[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(first)
    return grams[order[at]], np.add.reduceat(weights[order], at)


def union(automata: list[Automaton], depth: int) -> Automaton:
    """One automaton over a common word list, weights summed."""
    if not automata:
        return Automaton.from_sorted(pa.array([], pa.large_binary()), np.zeros((0, depth), np.int64), np.empty(0, np.int64))
    lists = pa.chunked_array([a.words for a in automata]).dictionary_encode().unify_dictionaries().combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    codes = np.concatenate([[0], lists.indices.to_numpy().astype(np.int64) + 1])
    grams, weights, at = [], [], 0
    for a in automata:
        rows, w = a.rows()
        grams.append(np.where(rows > 0, codes[rows + at * (rows > 0)], 0))
        weights.append(w)
        at += len(a.words)
    rows, sums = summed(np.concatenate(grams), np.concatenate(weights), len(lists.dictionary))
    return Automaton.from_sorted(lists.dictionary, rows, sums)


def pieces_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts in order: their bytes one after the other, lengths, pieces and texts."""
    data, offsets = utf8_bytes(column)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data)
    ends = np.isin(data, np.frombuffer(PIECE_ENDS, np.uint8))
    inside = ~(ends | np.isin(data, np.frombuffer(BLANKS, np.uint8)))
    starts, lengths = word_spans(inside, offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(ends)[starts] + text  # grows at every end of a piece or text
    return data[spans_of(starts, lengths)], lengths, piece, text


def mixed(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash of a key and one more hash."""
    key = (key ^ more) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ key >> np.uint64(29)


class Heavy:
    """The buckets whose phrases of one size may be frequent, as bits by size."""

    def __init__(self, bits: int, found: dict[int, np.ndarray]):
        self.bits, self.found = bits, found

    def has(self, size: int, key: np.ndarray) -> np.ndarray:
        at = bucket(key, self.bits)
        return (self.found[size][at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def bucket(key: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(key, np.uint64(bits)) >> np.uint64(64 - bits)).astype(np.int64)


class Shard:
    """Words of texts until there are enough for automata."""

    def __init__(self):
        self.bytes, self.lengths, self.pieces, self.langs = [], [], [], []
        self.size, self.at = 0, 0

    def add(self, texts: pa.Array, langs: list[str]) -> None:
        data, lengths, piece, text = pieces_of(texts)
        self.bytes.append(data)
        self.lengths.append(lengths)
        self.pieces.append(piece + self.at)
        self.langs.append(np.array(langs, object)[text])
        self.at += int(piece[-1]) + 2 if len(piece) else 0
        self.size += len(data)

    def close(self) -> None:
        """Give the words numbers, in the order of the texts; 0 stands for no word."""
        words = packed_words(np.concatenate(self.bytes), np.concatenate(self.lengths))
        self.codes, self.names = words.indices.to_numpy().astype(np.int64) + 1, words.dictionary
        self.piece, self.lang = np.concatenate(self.pieces), np.concatenate(self.langs)
        digests = (xxhash.xxh64_intdigest(w) for w in self.names.to_pylist())
        self.hashes = np.concatenate([np.zeros(1, np.uint64), np.fromiter(digests, np.uint64, len(self.names))])
        self.own_langs, of = np.unique(self.lang, return_inverse=True)
        seeds = np.array([xxhash.xxh64_intdigest(f"{x}/") for x in self.own_langs], np.uint64)
        self.seeds = seeds[of]
        self.bytes = self.lengths = self.pieces = self.langs = []

    def keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of phrases of 1, 2 and 3 words: which places begin one, and hash keys of all places."""
        key, n = self.seeds, len(self.codes)
        for d in range(BUCKETED):
            here = np.zeros(n, bool)
            here[:n - d] = self.piece[d:] == self.piece[:n - d]
            after = np.zeros(n, np.int64)
            after[:n - d] = self.codes[d:]
            key = mixed(key, self.hashes[after])
            yield here, key

    def rows(self, ranges: int, heavy: Heavy) -> Iterator[dict]:
        """Packed automata of the shard by language, family and prefix range."""
        n = len(self.codes)
        fits = np.ones((DEPTH, n), bool)  # whether the phrase of d + 1 words at a place may be frequent
        for d, (here, key) in enumerate(self.keys()):
            fits[d] = here & heavy.has(d + 1, key)
        fits[1] &= fits[0] & np.append(fits[0][1:], False)
        for d in range(2, DEPTH):
            fits[d] &= fits[d - 1] & np.append(fits[d - 1][1:], False)
        grams = np.zeros((n, DEPTH), np.int64)
        for d in range(DEPTH):
            grams[:n - d, d] = self.codes[d:] if d < n else 0
            grams[~fits[d], d] = 0
        for own in self.own_langs.tolist():
            mine = grams[self.lang == own]
            yield {"lang": own, "family": "total", "range": 0, "words": pa.array([], pa.binary()), "states": pack_arrays(np.array([len(mine)]))}
            yield from self._family(own, "short", mine[mine[:, 0] > 0, :2], 2, self.names, self.hashes, ranges)
            yield from self._family(own, "long", mine[mine[:, PREFIX - 1] > 0], DEPTH, self.names, self.hashes, ranges)

    def _family(self, lang: str, family: str, grams: np.ndarray, depth: int, names: pa.Array, hashes: np.ndarray, ranges: int) -> Iterator[dict]:
        if family == "short":  # a word and a pair have ranges of their own
            ones = grams.copy()
            ones[:, 1] = 0
            grams = np.concatenate([ones, grams[grams[:, 1] > 0]])
        grams, weights = summed(grams, np.ones(len(grams), np.int64), len(names))
        seed = np.uint64(xxhash.xxh64_intdigest(f"{lang}/{family}"))
        key = np.full(len(grams), seed)
        for d in range(min(PREFIX, depth)):
            key = mixed(key, hashes[grams[:, d]])
        at = (key % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for rows in np.split(order, cuts) if len(order) else ():
            used = np.unique(grams[rows])
            used = used[used > 0]
            local = np.zeros(len(names) + 1, np.int64)
            local[used] = np.arange(1, len(used) + 1)
            # numbers keep their order, so the rows stay sorted
            own = Automaton.from_sorted(names.take(pa.array(used - 1)), local[grams[rows]], weights[rows])
            yield {"lang": lang, "family": family, "range": int(at[rows[0]]), "words": own.words, "states": own.pack()}


SHARD_SCHEMA = pa.schema([("lang", pa.string()), ("family", pa.string()), ("range", pa.int64()),
                          ("words", pa.list_(pa.binary())), ("states", pa.binary())])
SHARD_DDL = "lang string, family string, range long, words array<binary>, states binary"


COUNTS = ["lang", "phrase", "size", "n"]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    words = [r["words"].cast(pa.binary()) for r in rows]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)), pa.concat_arrays(words))
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], SHARD_SCHEMA.field(c).type) for c in ("lang", "family", "range")]
                                      + [lists, pa.array([r["states"] for r in rows], pa.binary())], schema=SHARD_SCHEMA)


def _read_shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[Shard]:
    shard = Shard()
    for batch in batches:
        for part in text_slices(batch, "text"):
            shard.add(part.column("text"), part.column("lang").to_pylist())
            if shard.size >= shard_bytes:
                shard.close()
                yield shard
                give_back()
                shard = Shard()
    if shard.size:
        shard.close()
        yield shard
        give_back()


BUCKET_SCHEMA = pa.schema([("size", pa.int32()), ("part", pa.int64()), ("counts", pa.binary())])


def _bucketed(bits: int, shard_bytes: int):
    """How often each shard meets each bucket, by size of the phrases and part of the buckets."""
    width = min(bits, PART_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _read_shards(batches, shard_bytes):
            for size, (here, key) in enumerate(shard.keys(), 1):
                at, n = np.unique(bucket(key[here], bits), return_counts=True)
                part = at >> width
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(at)]]) if len(at) else np.zeros(1, np.int64)
                rows = [{"size": size, "part": int(part[a]), "counts": pack_arrays(np.diff(at[a:b], prepend=part[a] << width), n[a:b])}
                        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pylist(rows, BUCKET_SCHEMA)

    return run


def _heavy_part(bits: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << min(bits, PART_BITS), np.int64)
        for blob in table["counts"]:
            steps, n = unpack_arrays(blob.as_py())
            total[np.cumsum(steps)] += n
        return pa.table({"size": table["size"][:1], "part": table["part"][:1],
                         "heavy": pa.array([np.packbits(total >= least).tobytes()], pa.binary())})

    return run


def heavy_buckets(texts: DataFrame, least: int, size: int, shard_bytes: int) -> Heavy:
    """The buckets of phrases of 1 to 3 words that hold ``least`` occurrences, over all ``texts`` (of ``size`` bytes)."""
    bits = min(max(int(size // 64).bit_length(), MIN_BITS), MAX_BITS)
    met = texts.mapInArrow(_bucketed(bits, shard_bytes), "size int, part long, counts binary")
    found = met.groupBy("size", "part").applyInArrow(_heavy_part(bits, least), "size int, part long, heavy binary")
    out = {k: np.zeros(1 << bits >> 3, np.uint8) for k in range(1, BUCKETED + 1)}
    step = 1 << min(bits, PART_BITS) >> 3
    for row in found.collect():  # 3 * 2 ** bits / 8 bytes, 96 MB at most
        out[row["size"]][row["part"] * step:(row["part"] + 1) * step] = np.frombuffer(row["heavy"], np.uint8)
    return Heavy(bits, out)


def _shards(ranges: int, shard_bytes: int, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _read_shards(batches, shard_bytes):
            held: list[dict] = []
            for row in shard.rows(ranges, heavy.value):
                held.append(row)
                if len(held) == 64:
                    yield _batch(held)
                    held = []
            if held:
                yield _batch(held)

    return run


def _united(least: int):
    """Frequent phrases of a range with their counts; of the totals, a row without a phrase."""
    def run(table: pa.Table) -> pa.Table:
        lang, family = table["lang"][0].as_py(), table["family"][0].as_py()
        if family == "total":
            n = sum(int(unpack_arrays(s.as_py())[0][0]) for s in table["states"])
            return pa.table([[lang], pa.array([None], pa.string()), pa.array([0], pa.int32()), pa.array([n], pa.int64())], COUNTS)
        depth = 2 if family == "short" else DEPTH
        lists = table["words"].combine_chunks()
        automata = [Automaton.unpack(w.values, s.as_py()) for w, s in zip(lists, table["states"], strict=True)]
        whole = union(automata, depth)
        phrases, sizes, counts = [], [], []
        names = whole.words
        if family == "short":  # each phrase of this family ends where it counts
            levels = []
            rows, sums = whole.rows()
            for size in (1, 2):
                here = (rows[:, 1] > 0) == (size == 2)
                levels.append((rows[here, :size] - 1, sums[here]))
        else:
            levels = whole.counts()[PREFIX - 1:]
        for path, n in levels:
            often = n >= least
            if often.any():
                columns = [names.take(pa.array(c)).to_pylist() for c in path[often].T]
                phrases += [b" ".join(w).decode("utf-8", "surrogatepass") for w in zip(*columns, strict=True)]
                sizes += [path.shape[1]] * int(often.sum())
                counts += n[often].tolist()
        give_back()
        return pa.table([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32()),
                         pa.array(counts, pa.int64())], COUNTS)

    return run


def phrase_counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang", shard_bytes: int = SHARD_BYTES,
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``lang, phrase, size, n`` of phrases of 1 to ``DEPTH`` words that occur ``least`` times; the row of size 0 counts all words of its language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))
    heavy = spark.sparkContext.broadcast(heavy_buckets(texts, least, size, shard_bytes))
    shards = texts.mapInArrow(_shards(ranges, shard_bytes, heavy), SHARD_DDL)
    found = shards.groupBy("lang", "family", "range").applyInArrow(_united(least), "lang string, phrase string, size int, n long")
    folder = f"{new_run_dir(spark, 'phrases')}/counts"
    found.write.parquet(folder)
    return spark.read.parquet(folder)


def _words(phrase: str | Column) -> Column:
    return F.split(phrase, " ")


def _salt(of: Column, size: Column) -> Column:
    """Parts of one word are asked for by many candidates: these are spread over ``SALTS`` copies."""
    return F.when(size == 1, F.pmod(F.xxhash64(of), F.lit(SALTS))).otherwise(0).cast("int")


def collocations(docs: DataFrame, least: int, keep: int, text: str = "text", lang: str = "lang", **sizes: int) -> DataFrame:
    """The ``keep`` best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    counts = phrase_counts(docs, least, text, lang, **sizes)
    total = counts.where("size = 0").select("lang", F.col("n").alias("_all"))
    counts = counts.where("size > 0")
    cuts = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), _words("phrase").alias("_w"),
                                           F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    rest = F.col("size") - F.col("k")
    asked = cuts.select(
        "lang", "phrase", "size", "a", "k", F.posexplode(F.array(
            F.struct(F.slice("_w", 1, F.col("k")).alias("w"), F.col("k").alias("s")),
            F.struct(F.slice("_w", F.col("k") + 1, rest).alias("w"), rest.alias("s")))).alias("side", "part"))
    asked = asked.select("lang", "phrase", "size", "a", "k", "side", F.array_join("part.w", " ").alias("part"),
                         _salt(F.col("phrase"), F.col("part.s")).alias("_salt"))
    copies = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    weights = counts.select("lang", F.col("phrase").alias("part"), F.explode(copies).alias("_salt"), F.col("n").alias("_n"))
    both = asked.join(weights, ["lang", "part", "_salt"]).groupBy("lang", "phrase", "size", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("_n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("_n"))).alias("r"),
        F.max(F.when(F.col("side") == 0, F.col("part"))).alias("_head"), F.max(F.when(F.col("side") == 1, F.col("part"))).alias("_tail"))
    both = both.checkpoint()
    # a phrase that a longer one always contains: its count is that of the longer one without its last or first word
    inside = both.where("size > 2 and k = size - 1 and l = a").select("lang", F.col("_head").alias("phrase")).unionAll(
        both.where("size > 2 and k = 1 and r = a").select("lang", F.col("_tail").alias("phrase"))).distinct()
    wide = {c: F.col(c).cast("decimal(16,0)") for c in ("a", "l", "r", "_all")}  # products stay within 38 digits
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["_all"]), wide["l"] * wide["r"])
    scored = both.join(F.broadcast(total) if total.count() <= 10_000 else total, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", F.col("_all").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    best = best.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share first, so that no task sorts all phrases of a language
    share = Window.partitionBy("lang", "_share").orderBy(*order)
    best = best.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))).withColumn("_nth", F.row_number().over(share))
    best = best.where(F.col("_nth") <= keep).drop("_nth", "_share")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= keep).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
