"""Whole-text helpers shared by the Arrow-batched operators.

Each works on one Arrow batch inside a task.  ``text_slices`` cuts a batch
so that one slice holds about ``SLICE_BYTES`` of text (a single longer text
is a slice of its own), which bounds the memory of a task whatever the rows.
"""

from __future__ import annotations

import ctypes
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

SLICE_BYTES = 1 << 20
BATCH_ROWS = 2000
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of this session hold at most ``BATCH_ROWS`` rows from here on: rows with whole texts are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def as_string(c) -> "F.Column":
    """``c`` as text: the empty string where it is null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def with_field(schema: StructType, name: str, kind: DataType) -> StructType:
    """``schema`` with ``name`` as its last field, in place of any field of that name."""
    return StructType([f for f in schema.fields if f.name != name] + [StructField(name, kind)])


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that returns free memory to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what a batch or group took: a worker serves many tasks, and keeps its memory between them otherwise."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str, size: int = 0) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` (``SLICE_BYTES``) bytes of ``column``; what a batch took is given back after it."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    if len(sizes) == 0:
        return
    part = np.cumsum(sizes) // (size or SLICE_BYTES)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))
    give_back()


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets of its rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True, which end where a text of ``offsets`` ends."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = offsets[:-1][offsets[:-1] < len(inside)]
    first[opens] = inside[opens]  # a text's first byte begins a word whatever ends the text before
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def packed_words(data: np.ndarray, lengths: np.ndarray) -> pa.DictionaryArray:
    """Words that lie one after the other in ``data``, dictionary encoded."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return words.dictionary_encode()


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Of each code point: SPACE, LETTER, NUMBER or OTHER, by Unicode category."""
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
        elif kind == "Z":
            out[cp] = SPACE
    out[[9, 10, 11, 12, 13, 0x85]] = SPACE
    return out


def utf8_widths(cps: np.ndarray) -> np.ndarray:
    """Bytes that each code point takes in UTF-8."""
    return 1 + (cps > 0x7F).astype(np.int64) + (cps > 0x7FF) + (cps > 0xFFFF)


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every span, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def list_of(values: pa.Array, lengths) -> pa.ListArray:
    """The values cut into lists of the given lengths."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


def words_of(cps: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The pieces of a text that begin at ``starts``, as UTF-8, dictionary encoded."""
    data = cps.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    at = np.concatenate([[0], np.cumsum(utf8_widths(cps))])
    offsets = np.append(at[starts], len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pieces.dictionary_encode()


# The byte-level alphabet of published byte BPE vocabularies: printable Latin-1
# bytes stand for themselves, the others for code points from 256 up.
def byte_symbols() -> list[str]:
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def read_vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int], str]:
    """Vocabulary, merges, special strings with their ids, and word-end suffix of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return model["vocab"], merges, special, model.get("end_of_word_suffix") or ""
