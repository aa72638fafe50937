"""N-gram Jaccard join (operator 10): components of texts linked by shingle overlap, by a token-group matrix.

Texts with equal shingle sets are one *set*; links are sought between sets.

1. The bound against all other texts at once: a text can only be linked if
   enough of its shingles occur in some other text too.  Tasks sort the
   shingles of segments of texts and send each distinct one once per segment,
   packed by ranges of the hash; where a range meets, shingles of several
   segments are shared.  Texts below the bound are done; few go on.
2. Shingles have a fixed global order, rare ones first: by a count sketch of
   the remaining sets (``1 << SKETCH_BITS`` cells of two bytes, which is all
   that is broadcast), then by hash.  Any fixed order gives the same links.
   Two linked sets share one of the first ``n - ceil(t n) + 1`` shingles of
   each; only sets that share such a token, and whose sizes allow a link, go on.
3. Similar sets form groups: every set is compared with the most central set
   of each of its tokens (the one with fewest unshared tokens), sets that are
   linked to it carry its label, and sets stay with the centre that they
   share most tokens with.  A group is about ``GROUP`` sets of one centre.
4. The token-group matrix holds, for each group, the union of its members'
   tokens.  Groups of one label have nothing to add to each other.  For the
   rest, groups meet where they share a token; a set opens only groups whose
   union of shingles covers enough of it for the bound, and is then compared
   exactly with the members.  One link for each label is enough, since sets of
   a label are connected already; so a large family of near copies is linked
   in a star and never makes all its pairs.
5. Large-star/small-star contraction of the links gives the components.

Results are exact: labels only save comparisons inside what is connected
already.  Queries of a hot group are dealt to several tasks, each with the
group's members.

Rows: null and wordless texts have an empty set and are components of their
own; repeated rows and copies share theirs.  Texts of any length are read
whole.  Null ids never name a component unless all its ids are null.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.textops import give_back, list_of, packed_words, spans_of, text_slices, utf8_bytes, word_spans
from lineflow.session import make_folder, new_run_dir, remove_folder, scratch_root

SHINGLE = 3
THRESHOLD = 90  # per cent
SEGMENT_SHINGLES = 500_000  # of texts taken together by a task
RANGE_BYTES = 4 << 20  # of text for each range of hashes: about 600,000 shingles
LEAST_RANGES = 64
SKETCH_BITS = 24
SKETCH_PARTS = 256
GROUP = 64
QUERIES_PER_TASK = 256
BROADCAST_ROWS = 1_000_000  # of 16-byte keys
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], np.uint64)


def _space_table() -> np.ndarray:
    """Each byte with A-Z in lower case; white space is 0."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[[9, 10, 11, 12, 13, 32]] = 0
    return out


BYTES = _space_table()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, in order, and the word count of each text."""
    data, offsets = utf8_bytes(texts)
    low = BYTES[data]
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts, lengths = word_spans(inside, offsets)
    words = packed_words(low[inside], lengths)
    # latin-1 keeps the bytes apart and gives the hash its strings
    names = np.array([w.decode("latin-1") for w in words.dictionary.to_pylist()], dtype=object)
    hashed = pd.util.hash_array(names, categorize=False) if len(names) else np.empty(0, np.uint64)
    return hashed[words.indices.to_numpy(zero_copy_only=False)], np.diff(np.searchsorted(starts, offsets))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, flat; and the n+1 offsets of the texts."""
    words, per_text = word_hashes(texts)
    count = np.where(per_text == 0, 0, np.maximum(1, per_text - width + 1))
    size = np.repeat(np.minimum(per_text, width), count)
    start = np.repeat(np.cumsum(per_text) - per_text, count) + spans_of(np.zeros(len(count), np.int64), count)
    flat = size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        flat += np.where(size > k, _mix(padded[start + k] + np.uint64((int(_ODD[k % 5]) * (k + 1)) % (1 << 64))) * _ODD[(k + 2) % 5], np.uint64(0))
    flat = _mix(flat)
    ends = np.cumsum(count)
    for a, b in zip((ends - count).tolist(), ends.tolist(), strict=True):
        flat[a:b].sort()
    owner = np.repeat(np.arange(len(count)), count)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    return flat[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(count)))]).astype(np.int64)


def text_key(text: str = "text") -> Column:
    """Two hashes of different seeds: a literal hashed first is the seed of what follows."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("key"), F.col(text)).alias("b"))


def _cells(flat: np.ndarray, cells: int) -> np.ndarray:
    return (flat >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How often shingles fall into each cell, over the sets of all texts (65,535: that or more)."""
    cells = 1 << SKETCH_BITS
    each = cells // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat, _ = shingle_sets(part.column("text"), width)
                own, n = np.unique(_cells(flat, cells), return_counts=True)
                total[own] += n.astype(np.uint32)
        for i in range(SKETCH_PARTS):
            own = total[i * each:(i + 1) * each]
            if own.any():  # mostly zeros and ones: they pack well
                packed = zlib.compress(np.minimum(own, 65535).astype(np.uint16).tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed], pa.binary())], names=["part", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(each, np.uint64)
        for c in rows.column("counts"):
            total += np.frombuffer(zlib.decompress(c.as_py()), np.uint16)
        packed = zlib.compress(np.minimum(total, 65535).astype(np.uint16).tobytes(), 1)
        return pa.table({"part": rows.column("part")[:1], "counts": pa.array([packed], pa.binary())})

    out = np.zeros(cells, np.uint16)
    kind = "part int, counts binary"
    # SKETCH_PARTS rows that hold 2 << SKETCH_BITS bytes in all
    for r in docs.select("text").mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).toLocalIterator():
        out[r["part"] * each:(r["part"] + 1) * each] = np.frombuffer(zlib.decompress(r["counts"]), np.uint16)
    return out


def _needed(n, threshold: int):
    """The least number of common shingles that a set of ``n`` has with a linked one."""
    return (threshold * n + 99) // 100


REST_BITS = 26  # of a shingle within its range; two that agree in them count as shared, which only lets a text go on
NOBODY = 0xFFFFFFFF  # in place of a text's number: the shingle is in several texts of its segment


SEGMENTS = ("segment long, range int, number int, id {id}, key struct<a: long, b: long>, n long, sig binary, size int, "
            "a binary, b binary")


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32, bytes of equal weight together, compressed."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64)


def _signature(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _segment_rows(segment: int, bits: int, parts: list) -> Iterator[pa.RecordBatch]:
    """One row per text, one row (range -1) with their sizes and locally shared counts, one row per range of hashes."""
    flat = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    number = np.repeat(np.arange(len(n)), n)
    order = np.argsort(flat, kind="stable")
    token, text = flat[order], number[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.empty(0, np.int64)
    run = np.diff(np.append(first, len(token)))
    local = np.bincount(text[np.repeat(run > 1, run)], minlength=len(n))
    names = ["segment", "range", "number", "id", "key", "n", "sig", "size", "a", "b"]
    ends = np.cumsum(n)
    ids, keys = pa.concat_arrays([p[2] for p in parts]), pa.concat_arrays([p[3] for p in parts])

    def rows(count: int, **columns) -> pa.RecordBatch:
        kinds = {"segment": pa.int64(), "range": pa.int32(), "number": pa.int32(), "id": ids.type, "key": keys.type, "n": pa.int64(),
                 "sig": pa.binary(), "size": pa.int32(), "a": pa.binary(), "b": pa.binary()}
        columns["segment"] = [segment] * count
        return pa.RecordBatch.from_arrays([
            (columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], kinds[c])) if c in columns else pa.nulls(count, kinds[c])
            for c in names], names=names)

    sigs = [_signature(flat[e - k:e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
    yield rows(len(n), number=list(range(len(n))), id=ids, key=keys, n=pa.array(n), sig=sigs)
    yield rows(1, range=[-1], size=[len(n)], a=[_pack(n)], b=[_pack(local)])
    own, refs = token[first], np.where(run > 1, NOBODY, text[first])
    cut = np.searchsorted(own >> np.uint64(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64))
    rest = ((own << np.uint64(bits)) >> np.uint64(64 - REST_BITS)).astype(np.int64)
    for r in range(1 << bits):
        lo, hi = int(cut[r]), int(cut[r + 1])
        if hi > lo:
            yield rows(1, range=[r], size=[hi - lo], a=[_pack(np.diff(rest[lo:hi], prepend=0))], b=[_pack(refs[lo:hi])])


def _write_segments(frame: DataFrame, width: int, path: str) -> None:
    total = frame.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_RANGES, -(-total // RANGE_BYTES)).bit_length()
    limit = SEGMENT_SHINGLES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat, offsets = shingle_sets(part.column("text"), width)
                parts.append((flat, np.diff(offsets), part.column("id"), part.column("key")))
                held += len(flat) + len(part)
                if held >= limit:
                    yield from _segment_rows(segment, bits, parts)
                    segment, parts, held = segment + 1, [], 0
        if parts:
            yield from _segment_rows(segment, bits, parts)

    kinds = SEGMENTS.format(id=frame.schema["id"].dataType.simpleString())
    rows = frame.mapInArrow(run, kinds).withColumn(
        "kind", F.when(F.col("range").isNull(), "text").otherwise("shingle"))
    rows.write.partitionBy("kind").parquet(path)
    for kind in ("text", "shingle"):  # so that an empty table has them too
        make_folder(frame.sparkSession, f"{path}/kind={kind}")


def _shared_in_range(rows: pa.Table) -> pa.Table:
    """For each segment of a range, how many shingles each text shares with other segments."""
    give_back()
    segments, sizes = rows.column("segment").to_numpy(), rows.column("size").to_pylist()
    token = np.concatenate([np.cumsum(_unpack(a.as_py(), n)) for a, n in zip(rows.column("a"), sizes, strict=True)])
    order = np.argsort(token, kind="stable")
    token = token[order]
    same = token[1:] == token[:-1]
    del token
    shared = np.empty(len(order), bool)  # in the order of the rows again
    shared[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    del order, same
    row = np.repeat(np.arange(len(sizes)), sizes)[shared]
    ref = np.concatenate([_unpack(b.as_py(), n) for b, n in zip(rows.column("b"), sizes, strict=True)])[shared]
    own = ref != NOBODY
    row, ref = row[own], ref[own]
    found, count = np.unique(row << 32 | ref, return_counts=True)
    out_row, ends = found >> 32, np.searchsorted(found >> 32, np.arange(len(sizes) + 1))
    held = np.unique(out_row)
    return pa.table({
        "segment": pa.array(segments[held], pa.int64()), "range": pa.array(np.zeros(len(held)), pa.int32()),
        "size": pa.array((ends[held + 1] - ends[held]).astype(np.int32), pa.int32()),
        "a": pa.array([_pack(found[ends[i]:ends[i + 1]] & 0xFFFFFFFF) for i in held], pa.binary()),
        "b": pa.array([_pack(count[ends[i]:ends[i + 1]]) for i in held], pa.binary())})


def _candidates(segments: DataFrame, threshold: int) -> DataFrame:
    """``segment, number`` of the texts that share enough of their shingles with others to be linked at all."""
    def pick(rows: pa.Table) -> pa.Table:
        shared = n = None
        for r in sorted(rows.to_pylist(), key=lambda r: r["range"]):  # the row with the sizes is first
            a, b = _unpack(r["a"], r["size"]), _unpack(r["b"], r["size"])
            if r["range"] < 0:
                n, shared = a, b
            else:
                shared[a] += b
        found = np.flatnonzero((n > 0) & (100 * shared >= threshold * n))
        return pa.table({"segment": pa.array(np.full(len(found), rows.column("segment")[0].as_py()), pa.int64()),
                         "number": pa.array(found.astype(np.int32), pa.int32())})

    kind = "segment long, range int, size int, a binary, b binary"
    columns = ["segment", "range", "size", "a", "b"]
    met = segments.where("range >= 0").select(*columns).groupBy("range").applyInArrow(_shared_in_range, kind)
    return (met.unionAll(segments.where("range = -1").select(*columns)).groupBy("segment")
            .applyInArrow(pick, "segment long, number int"))


def _signed_sets(texts: DataFrame, shared, width: int, threshold: int) -> DataFrame:
    """``sig, short`` (its first half), ``n`` and ``tokens`` (the first shingles by the order) of each text, and ``whole``, all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat, offsets = shingle_sets(part.column("text"), width)
                count = shared.value[_cells(flat, len(shared.value))]
                order = count.astype(np.uint64) << np.uint64(32) | (flat & np.uint64(0xFFFFFFFF))
                n = np.diff(offsets)
                first = np.where(n == 0, 0, n - _needed(n, threshold) + 1)
                sigs, tokens = [], []
                for a, b, p in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first.tolist(), strict=True):
                    sigs.append(_signature(flat[a:b]))
                    tokens.append(flat[a:b][np.argsort(order[a:b], kind="stable")[:p]])
                values = np.concatenate(tokens).view(np.int64) if tokens else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sigs, pa.binary()), pa.array(np.frombuffer(b"".join(x[:8] for x in sigs), np.int64)), pa.array(n),
                     list_of(pa.array(values), first), list_of(pa.array(flat.view(np.int64)), n)],
                    names=["sig", "short", "n", "tokens", "whole"])

    return texts.select("text").mapInArrow(run, "sig binary, short long, n long, tokens array<long>, whole array<long>")


def _open(pairs: DataFrame, members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links ``u, v``: each set ``sig`` of ``pairs`` to a member of its group ``g``, one for each other label that it is linked with.

    ``pairs`` and ``members`` have ``g, sig, label``.
    """
    chunks = pairs.groupBy("g").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).alias("chunks"))
    asked = pairs.join(chunks, "g").select("g", F.pmod(F.xxhash64("sig"), F.col("chunks")).alias("chunk"), "sig", "label", F.lit(1).alias("role"))
    held = members.join(chunks, "g").select(
        "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "sig", "label", F.lit(0).alias("role"))
    rows = asked.unionAll(held).join(sets, "sig").select("g", "chunk", "role", "sig", "label", "tokens")

    def link(rows: pa.Table) -> pa.Table:
        role = rows.column("role").to_numpy()
        sigs, labels = rows.column("sig").to_pylist(), rows.column("label").to_pylist()
        lists = rows.column("tokens").combine_chunks()
        values = lists.flatten().to_numpy().view(np.uint64)
        length = np.asarray(pc.list_value_length(lists)).astype(np.int64)
        head = np.cumsum(length) - length
        inside = sorted(np.flatnonzero(role == 0).tolist(), key=lambda i: sigs[i])
        member = np.concatenate([values[head[i]:head[i] + length[i]] for i in inside]) if inside else np.empty(0, np.uint64)
        size = length[inside]
        owner = np.repeat(np.arange(len(inside)), size)
        union = np.unique(member)
        out = []
        for i in np.flatnonzero(role == 1).tolist():
            own = values[head[i]:head[i] + length[i]]
            n = len(own)
            at = np.minimum(np.searchsorted(union, own), max(0, len(union) - 1))
            if not len(union) or (union[at] == own).sum() < _needed(n, threshold):
                continue  # the bound: no member can be linked
            at = np.minimum(np.searchsorted(own, member), n - 1)
            common = np.bincount(owner[own[at] == member], minlength=len(inside))
            near = np.flatnonzero(100 * common >= threshold * (n + size - common))
            found = {labels[inside[k]]: sigs[inside[k]] for k in near.tolist()}
            out += [(sigs[i], v) for label, v in found.items() if label != labels[i]]
        return pa.table({"u": pa.array([a for a, _ in out], pa.binary()), "v": pa.array([b for _, b in out], pa.binary())})

    return rows.groupBy("g", "chunk").applyInArrow(link, "u binary, v binary")


def contract(links: DataFrame) -> DataFrame:
    """``v, root`` for every linked vertex but the roots: the least vertex of its component (large-star, small-star)."""
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        seen = now


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def grouped_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
                 threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``key`` (two hashes of the text), ``n`` (set size) and ``root`` (its component)."""
    spark = docs.sparkSession
    scratch_root(spark)
    frame = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).withColumn("key", text_key())
    folder = new_run_dir(spark, "jaccard")
    _write_segments(frame, width, f"{folder}/segments")
    found = spark.read.schema(SEGMENTS.format(id=frame.schema["id"].dataType.simpleString()))
    signed, segments = found.parquet(f"{folder}/segments/kind=text"), found.parquet(f"{folder}/segments/kind=shingle")
    near = _candidates(segments, threshold)
    wanted = signed.join(near, ["segment", "number"]).groupBy("sig").agg(F.min("key").alias("key")).select("key").checkpoint()
    remove_folder(spark, f"{folder}/segments/kind=shingle")  # the checkpoint holds what is needed of it
    texts = frame.join(_small(wanted, wanted.count()), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    texts.select("text").write.parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    sketch = spark.sparkContext.broadcast(_sketch(texts, width))
    _signed_sets(texts, sketch, width, threshold).write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")
    # tokens that at least two sets share; a set goes by the short half of its signature here,
    # so that two sets with equal halves would only be compared once more
    tokens = sets.select("short", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    held = tokens.join(shared, "token")
    # and whose sizes allow a link: on a scale of steps of the threshold they differ by one step at most, so
    # every set is in its step and the next one, and a token is told apart by step
    step = F.floor(F.log(F.col("n")) / (math.log(100 / threshold) + 1e-9)).cast("int")
    held = held.select("short", F.explode(F.array(step, step + 1)).alias("step"), "token")
    held = held.select("short", F.xxhash64("token", "step").alias("token")).distinct().checkpoint()
    common = held.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    held = held.join(common, "token")
    keys = sets.select("short", "sig", F.size("tokens").alias("p"))
    candidates = held.join(keys.select("short", "sig"), "short").select("sig", "token").checkpoint()
    keys = keys.select("sig", "p").join(candidates.select("sig").distinct(), "sig").checkpoint()
    whole = sets.select("sig", F.col("whole").alias("tokens"))

    # groups: a star around the most central set of each token
    alone = candidates.groupBy("sig").agg(F.count("*").alias("s")).join(keys, "sig").select("sig", (2 * F.col("p") - F.col("s")).alias("rest"))
    ranked = candidates.join(alone, "sig")
    pivots = ranked.groupBy("token").agg(F.min(F.struct("rest", "sig")).getField("sig").alias("g"))
    star = candidates.join(pivots, "token").where("sig <> g").groupBy("sig", "g").agg(F.count("*").alias("c")).checkpoint()
    centres = star.select("g").distinct().select("g", F.col("g").alias("sig"), F.col("g").alias("label"))
    stars = _open(star.select("g", "sig", F.col("sig").alias("label")), centres, whole, threshold).checkpoint()
    one = stars.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    sig = keys.select("sig").join(one, F.col("sig") == F.col("u"), "left").select("sig", F.coalesce("m", "sig").alias("m"))
    label = sig.join(sig.select(F.col("sig").alias("m"), F.col("m").alias("l")), "m").select("sig", F.col("l").alias("label")).checkpoint()
    # sets stay with the centre that they share most tokens with, linked to it or not
    nearest = star.groupBy("sig").agg(F.max(F.struct("c", "g")).getField("g").alias("g"))
    home = (label.join(nearest, "sig", "left").join(label.select(F.col("sig").alias("g"), F.col("label").alias("home")), "g", "left")
            .select("sig", "label", F.coalesce("home", "label").alias("home")))
    sizes = home.groupBy("home").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    grouped = home.join(sizes, "home").select("sig", "label", F.concat(
        "home", F.pmod(F.xxhash64("sig"), F.col("groups")).cast("string").cast("binary")).alias("g")).checkpoint()

    # the token-group matrix; groups meet where they share a token and have different labels
    cells = candidates.join(grouped, "sig")
    meet = cells.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    matrix = cells.join(meet, "token").groupBy("token", "g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    other = matrix.select("token", F.col("g").alias("group"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    met = matrix.join(other, "token").where("g >= group and not (lo = hi and lo2 = hi2 and lo = lo2)").select("g", "group").distinct()
    pairs = grouped.join(met, "g").select(F.col("group").alias("g"), "sig", "label")
    crossing = _open(pairs, grouped.select("g", "sig", "label"), whole, threshold)

    roots = contract(stars.unionAll(crossing))
    rows = signed.select("id", "key", "n", "sig").join(roots.withColumnRenamed("v", "sig"), "sig", "left")
    return rows.select("id", "key", "n", F.coalesce("root", "sig").alias("root"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
               threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n`` (set size) and ``component`` (the least id linked with it)."""
    rows = grouped_rows(docs, doc_id, text, width, threshold)
    least = rows.where("n > 0").groupBy("root").agg(F.min("id").alias("least"))
    linked = rows.where("n > 0").join(least, "root").select("id", "n", F.col("least").alias("component"))
    return linked.unionAll(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE,
             threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component, that of the least id; rows with an empty set all stay."""
    rows = grouped_rows(docs, doc_id, text, width, threshold).where("n > 0")
    rows = rows.groupBy("root", "id", "key").agg(F.count("*").alias("copies"))
    first = rows.groupBy("root").agg(F.min(F.struct("id", "key")).alias("first"))
    rows = rows.join(first, "root").withColumn("stays", F.struct("id", "key").eqNullSafe(F.col("first")))
    # rows that go, and those that stay but are repeated
    marked = rows.where("not stays or copies > 1").select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("stays").alias("_stays")).checkpoint()
    # the row travels as one column, so that no name of its own can clash
    own = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"), F.col(doc_id).alias("_own_id"),
                      text_key(text).alias("_own_key"))
    found = own.join(_small(marked, marked.count()),
                     F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left")
    repeated = found.where("_stays").dropDuplicates(["_id", "_key"])
    kept = found.where("_stays is null").select("_row").unionAll(repeated.select("_row"))
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))
