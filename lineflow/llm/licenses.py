"""License scans (operator 2): TF-IDF cosine to templates, then inheritance by directory.

Whole files, their headers, and the paragraphs and lines below are compared
with licence templates (``license_texts``) as sparse TF-IDF vectors.  Terms
are lower-case words without the commonest English ones; document
frequencies are counted over all texts.  A vector's norm includes its terms
outside the templates, each with the weight of a term of frequency 0.

The units of a text: the whole of it (``file``); its first non-empty line
and its first block, which is the leading comment or else the first
paragraph (``header``); every paragraph and line (``notice``).  A unit counts
if it holds one of ``SIGNALS``, words without which no licence is granted;
that rule and a bound of the cosine (``_may_match``) are met inside the scan,
so few units leave it.  Equal units are compared once.

A unit's licence is its nearest template's, if the cosine reaches
``threshold`` (of a whole file ``WHOLE_THRESHOLD`` too) and they share two
terms, or all that the template has.  A
file's own licence is that of its whole, else of its header, else of the
nearest unit below.  A licence file covers its directory
and those below it: one named like a licence file (``LICENSE_NAME``) with a
licence of its own, one that is a licence as a whole, and with ``opening``
every file whose header is a licence's.  Files without a licence of their
own inherit that of the nearest directory upwards, found by joins of ancestor
paths.  All steps are DataFrame expressions; the templates and their terms
are a few hundred values.

Rows: a null or empty text has no own licence; a null path counts as the top
directory.  Of templates of equal cosine the licence that sorts first counts,
of licence files in one directory that of the best cosine, then the licence
that sorts first.  Repeated rows get the same answer.  Other columns ride
along; input columns of the outputs' names are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.license_texts import TEMPLATES
from lineflow.session import scratch_root

THRESHOLD = 0.7
WHOLE_THRESHOLD = 0.9  # of whole files: a short source file under a header is no licence file
BROADCAST_ROWS = 500_000  # of two hashes, a licence and a number
SALTS = 16
WORD = "[^a-z0-9.+-]+"
# borders of words in a line in lower case: signs, and points at a word's end
TOKEN_BORDER = WORD + "|[.]+(?=[^a-z0-9.+-]|$)"
BLANKS = " \t\r"
EMPTY_LINE = "\n[ \t\r]*\n"
STOP = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that",
        "the", "this", "to", "under", "was", "were", "with", "you", "your", "spdx-license-identifier")
SIGNALS = ("licen", "redistribut", "permission", "public domain", "waived all copyright")
CLOSED_COMMENTS = (("/*", "*/"), ("<!--", "-->"), ('"""', '"""'))
COMMENT_LINE = "(?:#|//|--|;|%)"
LICENSE_NAME = "(?i)^(un)?(licen[cs]e|copying)(s)?([._-].*)?$"
FILE, HEADER, NOTICE = 0, 1, 2
BASIS = {FILE: "file", HEADER: "header", NOTICE: "notice"}

Templates = list[tuple[str, str]]


def tokens(text: Column) -> Column:
    """The words of a text in lower case; empty ones and stop words still among them."""
    return F.split(text, TOKEN_BORDER)


def terms(text: Column) -> Column:
    return F.filter(tokens(text), lambda w: w.rlike("[a-z0-9]") & ~w.isin(*STOP))


@dataclass(frozen=True)
class Weights:
    """What the corpus says about the templates' terms: a few hundred values."""

    idf: dict[str, float]
    top: float  # the weight of a term of frequency 0
    units: list[tuple[str, dict[str, float]]]  # of each template, its licence and its terms' share of its unit vector


def template_terms(templates: Templates) -> list[tuple[str, dict[str, int]]]:
    """The licence of each template, and how often it has each term."""
    out = []
    for name, text in templates:
        found = (re.sub("[.]+$", "", w) for w in re.split(WORD, text.lower()))
        out.append((name, dict(Counter(w for w in found if re.search("[a-z0-9]", w) and w not in STOP))))
    return out


def corpus_weights(docs: DataFrame, text: str = "text", templates: Templates | None = None) -> Weights:
    """Inverse frequencies of the templates' terms over all texts."""
    counts = template_terms(templates or TEMPLATES)
    vocabulary = sorted({t for _, c in counts for t in c})
    here = F.array_distinct(F.filter(tokens(F.lower(text)), lambda w: w.isin(*vocabulary)))
    # "" stands for the text itself; one row for each term and task is all that moves
    seen = docs.where(F.col(text).isNotNull()).select(F.explode(F.concat(F.array(F.lit("")), here)).alias("term"))
    df = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.count("*").alias("n")).collect()}  # one row a term
    n = df.get("", 0)
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}
    units = []
    for name, c in counts:
        size = math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items())) or 1.0
        units.append((name, {t: k * idf[t] / size for t, k in c.items()}))
    return Weights(idf, math.log(n + 1) + 1, units)


def _signal(text: Column) -> Column:
    some = F.lit(False)
    for word in SIGNALS:
        some = some | F.contains(text, F.lit(word))
    return some


def first_block(body: Column) -> Column:
    """The leading comment of a text without blanks around it, else its first paragraph."""
    out = F.when(body.rlike("^" + COMMENT_LINE),
                 F.regexp_extract(body, f"(?s)^(.*?)(?:\n(?![ \t]*{COMMENT_LINE})|\\z)", 1))
    for opens, closes in CLOSED_COMMENTS:
        inner = F.substring_index(F.substr(body, F.lit(len(opens) + 1)), closes, 1)
        out = out.when(body.startswith(opens), inner)
    return out.otherwise(F.get(F.split(body, EMPTY_LINE, 2), F.lit(0)))


def _may_match(found: Column, weights: Weights, threshold: float) -> Column:
    """Whether a unit of these terms can reach the threshold with any template.

    Its product with a template is at most the number of its terms in templates
    times the largest of their weights; its norm is least where no term repeats.
    """
    inside = F.size(F.filter(found, lambda w: w.isin(*sorted(weights.idf)))).cast("double")
    largest = max((weights.idf[t] * u for _, unit in weights.units for t, u in unit.items()), default=0.0)
    least = min(weights.idf.values(), default=1.0)
    norm = F.sqrt((F.size(found) - inside) * weights.top**2 + inside * least**2)
    return (inside > 0) & (inside * largest >= norm * (threshold - 1e-6))


def units_of(docs: DataFrame, keys: list[Column], weights: Weights, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keys``, ``_kind`` and ``_terms`` of the units that hold a signal and can reach the threshold."""
    def unit(kind: int, body: Column) -> Column:
        return F.struct(F.lit(kind).alias("k"), body.alias("x"))

    body = F.col("_body")
    texts = docs.select(*keys, F.btrim(F.lower(text), F.lit(BLANKS + "\n")).alias("_body")).where(_signal(body))
    below = F.filter(F.concat(F.split(body, EMPTY_LINE), F.split(body, "\n")), _signal)
    every = F.concat(F.array(unit(FILE, body), unit(HEADER, F.substring_index(body, "\n", 1)), unit(HEADER, first_block(body))),
                     F.transform(below, lambda x: unit(NOTICE, x)))
    names = [c for c in texts.columns if c != "_body"]
    rows = texts.select(*names, F.explode(every).alias("_u")).where(_signal(F.col("_u.x")))
    rows = rows.select(*names, F.col("_u.k").alias("_kind"), terms(F.col("_u.x")).alias("_terms"))
    return rows.where(_may_match(F.col("_terms"), weights, threshold))


def scores(units: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """``_u1, _u2, _license, _score`` of the units (``_u1, _u2, _terms``) that reach the threshold; equal ones once."""
    spark = units.sparkSession
    idf = F.broadcast(spark.createDataFrame(sorted(weights.idf.items()), "_term string, _idf double"))
    parts = F.broadcast(spark.createDataFrame(
        [(i, name, len(unit), t, u) for i, (name, unit) in enumerate(weights.units) for t, u in sorted(unit.items())],
        "_t int, _license string, _size int, _term string, _u double"))
    key = ["_u1", "_u2"]
    tf = units.dropDuplicates(key).select(*key, F.explode("_terms").alias("_term")).groupBy(*key, "_term").agg(F.count("*").alias("_tf"))
    own = tf.join(idf, "_term", "left").select(*key, "_term", (F.col("_tf") * F.coalesce("_idf", F.lit(weights.top))).alias("_w"))
    norm = own.groupBy(*key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    dots = own.join(parts, "_term").groupBy(*key, "_t", "_license", "_size").agg(
        F.sum(F.col("_w") * F.col("_u")).alias("_dot"), F.count("*").alias("_shared"))
    dots = dots.where(F.col("_shared") >= F.least(F.lit(2), F.col("_size"))).join(norm, key)
    score = dots.select(*key, "_license", F.round(F.col("_dot") / F.col("_norm"), 6).alias("_score")).where(F.col("_score") >= threshold)
    best = score.groupBy(*key).agg(F.min(F.struct((-F.col("_score")).alias("s"), F.col("_license").alias("l"))).alias("_best"))
    return best.select(*key, F.col("_best.l").alias("_license"), (-F.col("_best.s")).alias("_score"))


def parent(path: Column) -> Column:
    return F.coalesce(F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1), F.lit(""))


def ancestors(folder: Column) -> Column:
    """The folder itself and those above it, the top folder "" last."""
    parts = F.split(folder, "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(up, F.array(F.lit(""))))


def _two_hashes(text: Column, *names: str) -> list[Column]:
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit("two"), text).alias(names[1])]


def own_licenses(files: DataFrame, text: str = "text", templates: Templates | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``_t1, _t2, _own``: of the distinct texts with a licence, the own one (kind, -score, licence)."""
    weights = corpus_weights(files, text, templates)
    units = units_of(files, _two_hashes(F.col(text), "_t1", "_t2"), weights, text, threshold)
    joined = F.array_join("_terms", " ")
    units = units.select("_t1", "_t2", "_kind", *_two_hashes(joined, "_u1", "_u2"), "_terms").checkpoint()
    known = scores(units.select("_u1", "_u2", "_terms"), weights, threshold).checkpoint()
    links = units.select("_t1", "_t2", "_kind", "_u1", "_u2").distinct()
    if known.count() <= BROADCAST_ROWS:  # distinct units found, mostly a few
        found = links.join(F.broadcast(known), ["_u1", "_u2"])
    else:  # many texts may share a unit: its rows go to several tasks
        salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = links.withColumn("_salt", F.pmod("_t1", F.lit(SALTS)).cast("int")).join(salted, ["_u1", "_u2", "_salt"])
    found = found.where((F.col("_kind") != FILE) | (F.col("_score") >= WHOLE_THRESHOLD))
    rank = F.struct(F.col("_kind").alias("k"), (-F.col("_score")).alias("s"), F.col("_license").alias("l"))
    return found.groupBy("_t1", "_t2").agg(F.min(rank).alias("_own"))


def scan(files: DataFrame, text: str = "text", path: str = "path", templates: Templates | None = None,
         threshold: float = THRESHOLD, opening: bool = False) -> DataFrame:
    """``files`` without ``text``, with ``license``, ``score`` (of an own one) and ``basis``.

    ``basis`` is ``file``, ``header`` or ``notice`` for an own licence, by the unit
    it was found in, ``folder:<path>`` for an inherited one, or ``none``.
    """
    scratch_root(files.sparkSession)
    found = own_licenses(files, text, templates, threshold).checkpoint()
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    outs = ("license", "score", "basis")
    names = [c for c in files.columns if c not in (text, *outs)]
    where = F.col(path).cast("string")
    # the row travels as one column, so that no name of its own can clash, and without the text
    rows = files.select(F.struct(*(f"`{c}`" for c in names)).alias("_row"), parent(where).alias("_dir"),
                        F.coalesce(F.substring_index(where, "/", -1).rlike(LICENSE_NAME), F.lit(False)).alias("_named"),
                        *_two_hashes(F.col(text), "_t1", "_t2"))
    rows = rows.join(found, ["_t1", "_t2"], "left").drop("_t1", "_t2").checkpoint()
    gives = F.col("_named") | (F.col("_own.k") <= (HEADER if opening else FILE))
    covers = rows.where(F.col("_own").isNotNull() & gives).groupBy("_dir").agg(F.min(F.struct("_own.s", "_own.l")).alias("_head")).select(
        F.col("_dir").alias("_up"), F.col("_head.l").alias("_given"))
    folders = rows.select("_dir").distinct().select("_dir", F.explode(ancestors(F.col("_dir"))).alias("_up"))
    nearest = (folders.join(covers, "_up").groupBy("_dir")
               .agg(F.max(F.struct(F.length("_up").alias("n"), F.col("_up").alias("u"), F.col("_given").alias("g"))).alias("_from")))
    rows = rows.join(nearest, "_dir", "left")
    basis = F.when(F.col("_from").isNotNull(), F.concat(F.lit("folder:"), F.col("_from.u"))).otherwise("none")
    for kind, name in BASIS.items():
        basis = F.when(F.col("_own.k") == kind, name).otherwise(basis)
    return rows.select(*(F.col("_row")[c].alias(c) for c in names), F.coalesce("_own.l", "_from.g").alias("license"),
                       (-F.col("_own.s")).alias("score"), basis.alias("basis"))
