"""Language identification (operator 3): a byte convolutional network in numpy.

The network reads fixed-length windows of bytes: an embedding, filters of
several widths, the maximum of every filter over the window, and a softmax
layer.  It is trained on the driver on a bounded sample of labelled rows:
at most ``TrainSpec.rows_per_label`` rows of each label and
``TrainSpec.windows_per_row`` windows of each row, so its memory does not
grow with the corpus.  Prediction covers every byte of every text: filters
are linear up to the maximum, so they are folded into tables over byte
pairs, and a text's probabilities are the mean over its windows, weighted by
their bytes.

Rows: a null or empty text, or one without a letter, is ``und`` with score
0.  Rows with a null label are no training rows; without any training row
every text is ``und``.  Ties go to the label that sorts first.  Other columns
ride along; input columns of the outputs' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from lineflow.llm.textops import LETTER, char_classes, text_slices, utf8_bytes, with_field

UNKNOWN = "und"
BLOCK = 1 << 15  # positions computed at a time, so that tables and sums stay in the cache


@dataclass(frozen=True)
class TrainSpec:
    """Bounds of the training sample, and the network's shape."""

    rows_per_label: int = 400
    max_labels: int = 200
    windows_per_row: int = 4
    window: int = 256
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


class ByteNet:
    """Embedding, convolutions padded to the largest width, maximum, softmax."""

    def __init__(self, labels: list[str], spec: TrainSpec):
        rng = np.random.default_rng(spec.seed)
        self.labels, self.spec, self.wide = labels, spec, max(spec.widths)
        n = spec.filters * len(spec.widths)
        # a filter of width w has weights at its first w of `wide` places
        self.mask = np.repeat([[float(k < w) for k in range(self.wide)] for w in spec.widths], spec.filters, axis=0).T
        self.emb = rng.normal(0, 0.5, (256, spec.embedding)).astype(np.float32)
        self.conv = (rng.normal(0, 0.3, (self.wide, spec.embedding, n)) * self.mask[:, None, :]).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, (n, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def fit(self, windows: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the cross-entropy; ``windows`` is (n, window) bytes, ``labels`` their label numbers."""
        spec, rng = self.spec, np.random.default_rng(self.spec.seed + 1)
        params = [self.emb, self.conv, self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        weight = (len(labels) / np.maximum(1, np.bincount(labels, minlength=len(self.labels)))).astype(np.float32)
        for _ in range(spec.epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), spec.batch):
                x, y = windows[order[at:at + spec.batch]], labels[order[at:at + spec.batch]]
                grads = self._gradients(x, y, weight[y] / len(self.labels))
                step += 1
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= spec.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        b, places = len(x), x.shape[1] - self.wide + 1
        e = self.emb[x]
        z = sum(e[:, k:k + places] @ self.conv[k] for k in range(self.wide))
        best = z.argmax(1)
        top = np.take_along_axis(z, best[:, None], 1)[:, 0] + self.bias
        hidden = np.maximum(top, 0)
        p = softmax(hidden @ self.out + self.out_bias)
        p[np.arange(b), y] -= 1
        d = p * weight[:, None] / b
        d_hidden = (d @ self.out.T) * (top > 0)
        d_conv, d_emb = np.zeros_like(self.conv), np.zeros_like(self.emb)
        row = np.arange(b)[:, None]
        for k in range(self.wide):
            seen = x[row, best + k]  # the byte that each filter's maximum saw at place k
            d_conv[k] = np.einsum("bfe,bf->ef", self.emb[seen], d_hidden) * self.mask[k]
            np.add.at(d_emb, seen, d_hidden[:, :, None] * self.conv[k].T[None])
        return [d_emb, d_conv, d_hidden.sum(0), hidden.T @ d, d.sum(0)]

    def pair_tables(self) -> list[np.ndarray]:
        """What two neighbouring bytes add to every filter, for places 0 and 1, 2 and 3, ..."""
        single = np.einsum("be,kef->kbf", self.emb, self.conv)
        if self.wide % 2:
            single = np.concatenate([single, np.zeros_like(single[:1])])
        return [(single[k][:, None] + single[k + 1][None]).reshape(65536, -1) for k in range(0, len(single), 2)]

    def window_probabilities(self, tables: list[np.ndarray], data: np.ndarray) -> np.ndarray:
        """Probabilities of every whole window of ``data`` (a multiple of the window long)."""
        size, span = self.spec.window, self.wide + self.wide % 2
        tail = np.concatenate([data, np.zeros(span, np.uint8)]).astype(np.int32)
        pairs = (tail[:-1] << 8) | tail[1:]
        out = np.empty((len(data) // size, len(self.bias)), np.float32)
        inside = np.arange(size) > size - self.wide  # filters that would leave the window
        per = max(1, BLOCK // size)
        for w in range(0, len(out), per):
            m = min(per, len(out) - w)
            a, b = w * size, (w + m) * size
            z = np.take(tables[0], pairs[a:b], axis=0)
            for k, t in enumerate(tables[1:], 1):
                z += np.take(t, pairs[a + 2 * k:b + 2 * k], axis=0)
            z = z.reshape(m, size, -1)
            z[:, inside] = -np.inf
            out[w:w + m] = z.max(1)
        return softmax(np.maximum(out + self.bias, 0) @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole texts cut into windows, the last of a text padded with its own first bytes, repeated.

    Returns the bytes (windows one after the other), each window's text, and the bytes it really has.
    """
    length = np.diff(offsets)
    count = -(-length // size)
    text = np.repeat(np.arange(len(length)), count)
    first = np.cumsum(count) - count
    nth = np.arange(len(text)) - first[text]
    at = offsets[:-1][text] + nth * size
    real = np.minimum(size, length[text] - nth * size)
    index = at[:, None] + np.arange(size)[None]
    short = np.flatnonzero(real < size)
    if len(short):
        begin = offsets[:-1][text[short]]
        inside = index[short] - begin[:, None]
        index[short] = begin[:, None] + inside % length[text[short]][:, None]
    return data[index.reshape(-1)], text, real


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script; only texts without an ASCII letter are looked through."""
    plain = pc.match_substring_regex(pc.fill_null(texts, ""), "[A-Za-z]")
    out = np.array(plain.to_numpy(zero_copy_only=False), bool)
    kinds = char_classes()
    for i in np.flatnonzero(~out):
        text = texts[int(i)].as_py() or ""
        if text:
            out[i] = bool((kinds[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)] == LETTER).any())
    return out


def predict_texts(net: ByteNet | None, tables: list[np.ndarray], texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The label and score of each whole text."""
    n = len(texts)
    if net is None or n == 0:
        return [UNKNOWN] * n, np.zeros(n)
    data, offsets = utf8_bytes(texts)
    flat, text, real = windows_of(data, offsets, net.spec.window)
    p = net.window_probabilities(tables, flat) * real[:, None]
    total = np.stack([np.bincount(text, weights=p[:, k], minlength=n) for k in range(len(net.labels))], 1)
    mean = total / np.maximum(1, np.diff(offsets))[:, None]
    known = has_letter(texts)
    best = mean.argmax(1)
    names = [net.labels[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
    return names, np.where(known, np.clip(mean.max(1), 0, 1), 0.0)


def lettered(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                yield part.filter(pa.array(has_letter(part.column(text))))

    return df.mapInArrow(run, df.schema)


def train(rows: DataFrame, text: str = "text", label: str = "lang", spec: TrainSpec = TrainSpec()) -> ByteNet | None:
    """A network for the labels of ``rows``; None when no row has a label and text.

    The sample is about ``rows_per_label`` distinct texts, twice as many at most, of
    each of the ``max_labels`` most frequent labels, as the hash of the text picks
    them; copies of a text count for one.
    """
    rows = rows.select(F.col(label).cast("string").alias("y"), F.col(text).cast("string").alias("x"))
    rows = rows.where(F.col("y").isNotNull() & (F.length("x") > 0)).withColumn("o", F.xxhash64("x"))
    counts = rows.groupBy("y").agg(F.count("*").alias("n"), F.approx_count_distinct("o").alias("d"))
    counts = counts.orderBy(F.desc("n"), "y").limit(spec.max_labels).collect()
    if not counts:
        return None
    # a share of each label's hash range that holds about the wanted texts; the rank by hash is a hard bound on top
    share = F.lit(-1.0)
    for r in counts:
        share = F.when(F.col("y") == r["y"], F.lit(min(1.0, spec.rows_per_label / max(1, r["d"])))).otherwise(share)
    size = spec.window
    spot = [F.pmod(F.xxhash64("o", F.lit(k)), F.greatest(F.octet_length("x") - size + 1, F.lit(1))).cast("int") + 1
            for k in range(spec.windows_per_row)]
    raw = F.col("x").cast("binary")
    cut = F.array(*[F.when(F.octet_length("x") <= size, raw).otherwise(F.substring(raw, s, F.lit(size))) for s in spot])
    picked = F.pmod(F.xxhash64("o", F.lit("sample")), F.lit(1 << 40)) < share * (1 << 40)
    taken = rows.where(picked).select("y", "o", F.array_distinct(cut).alias("w")).dropDuplicates(["y", "o"])
    rank = F.row_number().over(Window.partitionBy("y").orderBy("o"))
    taken = taken.withColumn("rank", rank).where(F.col("rank") <= 2 * spec.rows_per_label).select("y", "w").collect()
    labels = sorted(r["y"] for r in counts)
    number = {y: i for i, y in enumerate(labels)}
    pieces = [(bytes(w), number[r["y"]]) for r in taken for w in r["w"]]
    if not pieces:
        return None
    pieces.sort()  # the sample's order must not depend on the partitions
    x = np.stack([np.resize(np.frombuffer(w, np.uint8), size) for w, _ in pieces])
    net = ByteNet(labels, spec)
    net.fit(x, np.array([y for _, y in pieces]))
    return net


def predict(df: DataFrame, net: ByteNet | None, text: str = "text", lang: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``df`` with the predicted label of every whole text and its score from 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        tables = own.pair_tables() if own is not None else []
        for batch in batches:
            for part in text_slices(batch, text):
                names, scores = predict_texts(own, tables, part.column(text))
                kept = [c for c in part.schema.names if c not in (lang, score)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*kept, lang, score])

    return df.mapInArrow(run, with_field(with_field(df.schema, lang, StringType()), score, DoubleType()))
