"""Queries over the operators of this package: one ``opN_<name>`` per operator, and their SQL.

Each reads its whole tables, calls its operator with production parameters
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineflow.llm import bpe, collocation, decontam, jaccard, langid, licenses, linededup, merkle, packing, sharding, simhash, transducer, urlfilter
from lineflow.llm.textops import as_string, bounded_batches, table
from lineflow.session import new_run_dir, scratch_root

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


RULES = [urlfilter.Rule(*r) for r in (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"))]
# The block list: pages that were once fetched with a junk title, and all pages of hosts with one of these labels.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
JUNK_TITLE = "<title>[^<]*[%*#]{3}"


SETS_BROADCAST = 500_000  # sets of phrases, of some 150 bytes


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    index = decontam.build_index(table(spark, sf_dir, "documents"), f"{new_run_dir(spark, 'postings')}/index")
    scratch_root(spark)
    phrases = decontam.phrases_of(table(spark, sf_dir, "benchmark"))
    folder = f"{new_run_dir(spark, 'found')}/rows"
    decontam.search(index, phrases).withColumn("_set", decontam.set_of(F.col("held"))).write.parquet(folder)
    found = spark.read.parquet(folder)
    # a set of phrases has one list of items, however many documents hold it
    listed = decontam.items_of(found, phrases).select("_set", F.size("items").cast("long").alias("n_items"),
                                                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).checkpoint()
    few = F.broadcast(listed) if listed.count() <= SETS_BROADCAST else listed
    n_hit = F.aggregate(F.zip_with("hit_from", "hit_to", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    found = found.select("doc_id", "n_words", n_hit.alias("n_hit"), (F.size("hit_from") > 0).alias("contaminated"), "_set")
    # documents without a set meet no join
    clean = found.where("_set is null").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)})
    return clean.unionByName(found.where("_set is not null").join(few, "_set")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are the documents; a path is source, thousand, hundred and number of the document.

    No document is named like a licence file, so the header of any covers its folder.
    """
    docs = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    path = F.concat_ws("/", "source", F.concat(F.lit("k"), F.floor(n / 1000)), F.concat(F.lit("h"), F.floor(n / 100)),
                       F.concat(n, F.lit(".txt")))
    files = docs.select("doc_id", path.alias("path"), "text")
    return licenses.scan(files, opening=True).select("doc_id", "path", "license", F.round("score", 4).alias("score"), "basis")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(as_string(F.col("doc_id")).cast("binary")) % 5 == 0
    net = langid.train(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), net)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is blocked when any page of its canonical URL is listed, whatever its own host and content say."""
    pages = table(spark, sf_dir, "pages")
    labels = F.array(*(F.lit(x) for x in LISTED_LABELS))
    listed = pages.where(F.arrays_overlap(F.split(urlfilter.host_of(F.col("url")), "[.]"), labels) | F.col("html").rlike(JUNK_TITLE))
    return urlfilter.judge(pages.select("page_id", "url"), listed.select("url"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", F.col("text").alias("clean_text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(as_string(F.col("text")).cast("binary")).alias("text_crc32"))
    out = sharding.assign(rows, ["doc_id", "size", "text_crc32"], 24, hash_key="doc_id")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = transducer.token_counts(docs, WORD_BPE)
    return out.select("doc_id", F.octet_length(as_string(F.col("text"))).cast("long").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > 2048).alias("over_limit"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For ids divisible by 50, of the documents within the Hamming radius: ``near_docs``, how many others there
    are, and ``near_least``, the least id among them and itself; else null."""
    scratch_root(spark)
    rows = simhash.with_next(table(spark, sf_dir, "documents"), "doc_id", "text")
    new = simhash.edited(F.col("text"), F.col("_next"))
    rows = rows.select("_bucket", "_place", "_halo", "doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2(new, 256).alias("edited_sha256"),
                       F.explode(F.when(F.col("_halo"), F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")))).otherwise(
                           F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")),
                                   F.struct(F.lit(1).alias("k"), new.alias("t"))))).alias("_v"))
    rows = rows.select("_bucket", "_place", "_halo", "doc_id", "n_chars", "edited_sha256", "_v.k", "_v.t")
    # bucket and place name a row from here to the checkpoint
    keys = ["_bucket", "_place", "_halo", "doc_id", "n_chars", "edited_sha256", "k"]
    prints = simhash.fingerprints(rows, keys, "t")
    keys.remove("k")
    own = prints.groupBy(*keys).agg(F.max(F.when(F.col("k") == 0, F.col("fingerprint"))).alias("fingerprint"),
                                    F.max(F.when(F.col("k") == 1, F.col("fingerprint"))).alias("_edited")).checkpoint()
    after = Window.partitionBy("_bucket").orderBy("_place")
    placed = own.where("_bucket >= 0").withColumn("_next", F.lead("fingerprint").over(after)).where("not _halo")
    # rows without an id have no next text: the empty one's fingerprint stands for it, and no window gathers them
    empty = simhash.fingerprints(spark.createDataFrame([(0, "")], "i int, text string"), ["i"], "text").first()["fingerprint"]
    own = placed.unionByName(own.where("_bucket < 0").withColumn("_next", F.lit(empty)))
    copies = own.groupBy("fingerprint").agg(F.count("*").alias("_n"), F.min("doc_id").alias("_least")).checkpoint()
    asked = own.where("doc_id % 50 = 0").select("fingerprint").distinct()
    near = (simhash.within(asked, copies).join(copies, "fingerprint").groupBy("query")
            .agg((F.sum("_n") - 1).alias("_near"), F.min("_least").alias("_first")))
    out = own.join(near, (F.col("fingerprint") == F.col("query")) & (F.col("doc_id") % 50 == 0), "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"),
        simhash.as_hex(F.col("_edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fingerprint"), F.col("_edited")).alias("near_edited"),
        F.coalesce(simhash.likeness(F.col("fingerprint"), F.col("_next")), F.lit(0.0)).alias("near_next"),
        F.col("_near").alias("near_docs"), F.col("_first").alias("near_least"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, BYTE_BPE).select("doc_id", "ids"), BYTE_BPE)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    out = jaccard.components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof is folded again from its leaf, tampered with where the id's checksum is even."""
    docs = table(spark, sf_dir, "documents")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.leaf_of(*before, F.col("text"))
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(tampers, merkle.leaf_of(*before, F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf)
    made = merkle.build(docs, "source", "doc_id", leaf, {"doc_id": F.col("doc_id"), "now": tampered})
    out = merkle.prove(made)
    folded = merkle.fold(F.col("_row.now"), F.col("_proof"))
    hexed = {n: F.lower(F.hex(f"_{n}")).alias(n) for n in ("leaf", "subroot", "root")}
    out = out.select(F.col("_row.doc_id").alias("doc_id"), *hexed.values(), merkle.proof_digest(F.col("_proof")).alias("proof_sha256"),
                     folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


END_ID, SEQUENCE_TOKENS = 2, 1024


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack(packing.cut(docs, BYTE_BPE, END_ID, SEQUENCE_TOKENS), SEQUENCE_TOKENS)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    scratch_root(spark)
    return collocation.collocations(table(spark, sf_dir, "documents").select("lang", "text"), 100, 2000)


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_license_scan, op3_language, op4_url_filter, op5_line_dedup, op6_sharding, op7_token_counts, op8_fingerprints,
    op9_bpe, op10_jaccard_join, op11_merkle_manifest, op12_best_fit_packing, op13_collocations)}
ORACLES: dict[str, str] = {}

ORACLES["op1_decontamination"] = r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bench AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bench WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrases),
spots AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM raw, sizes WHERE len(w) >= n),
hits AS (
  SELECT s.r, s.i, s.n, p.item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM spots) s
  JOIN phrases p ON s.p = p.p AND s.n = p.n),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM raw LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

ORACLES["op10_jaccard_join"] = r"""
WITH RECURSIVE raw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, hash(array_to_string(w[i:i + 2], ' '), len(w) < 3) AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM raw WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM common JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach(x, y) AS (SELECT r, r FROM raw UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT raw.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM raw JOIN reach ON reach.x = raw.r JOIN raw o ON o.r = reach.y LEFT JOIN n ON n.r = raw.r
GROUP BY raw.r, raw.doc_id, n.n
"""

_U, _L = urlfilter.UPPER, urlfilter.LOWER
ORACLES["op4_url_filter"] = f"""
WITH cut AS (
  SELECT page_id, url, html,
         CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_U}', '{_L}') ELSE '' END AS host,
         CASE WHEN instr(url, '://') > 0 THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*[?]([^#]*)', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))) AS params FROM pages),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '')
              || regexp_replace(path, '/(index[.]html?)?$', '')
              || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon,
         CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM cut),
listed AS (
  SELECT DISTINCT canon AS c FROM named
  WHERE (list_has_any(string_split(host, '.'), {list(LISTED_LABELS)}) OR regexp_matches(html, '{JUNK_TITLE}')) AND canon IS NOT NULL)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR c IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM named LEFT JOIN listed ON canon = c
"""

ORACLES["op5_line_dedup"] = f"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce('=' || source, '') AS own FROM documents),
firsts AS (SELECT *, min(own) OVER (PARTITION BY text) AS site FROM raw),
lines AS (
  SELECT r, site, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM firsts),
keyed AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS k FROM lines),
spread AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= {linededup.MIN_SITES}),
marked AS (SELECT r, text, pos, line, k IN (SELECT k FROM spread) AS gone FROM keyed),
docs AS (
  SELECT r, count(*) AS n, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS g,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM marked GROUP BY r)
SELECT doc_id, CAST(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE n END AS BIGINT) AS n_lines,
       CAST(coalesce(g, 0) AS BIGINT) AS n_removed, CASE WHEN g > 0 THEN kept ELSE text END AS clean_text
FROM raw LEFT JOIN docs USING (r)
"""


def _license_sql() -> str:
    """The scan in SQL, from the same templates and thresholds; headers by lists of lines."""
    stop = ", ".join(f"'{w}'" for w in licenses.STOP)

    def words(c: str) -> str:
        return (f"list_filter(list_transform(string_split_regex(lower({c}), '{licenses.WORD}'), lambda x: regexp_replace(x, '[.]+$', '')), "
                f"lambda x: regexp_matches(x, '[a-z0-9]') AND x NOT IN ({stop}))")

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    notices = ", ".join(f"({i}, {quoted(k)}, {quoted(v)})" for i, (k, v) in enumerate(licenses.TEMPLATES))
    signal = " OR ".join(f"contains(x, '{w}')" for w in licenses.SIGNALS)
    empty = licenses.EMPTY_LINE.replace("\n", "\\n").replace("\t", "\\t").replace("\r", "\\r")
    closed = " ".join(f"WHEN starts_with(body, '{a}') THEN string_split(substr(body, {len(a) + 1}), '{b}')[1]" for a, b in licenses.CLOSED_COMMENTS)
    blanks = "chr(32) || chr(9) || chr(13)"
    return f"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, text,
         concat_ws('/', source, 'k' || CAST(floor(doc_id / 1000) AS BIGINT), 'h' || CAST(floor(doc_id / 100) AS BIGINT), doc_id || '.txt') AS path
  FROM documents),
dirs AS (SELECT r, doc_id, path, regexp_extract(path, '(?s)^(.*)/[^/]*$', 1) AS dir FROM raw),
texts AS (
  SELECT r, body, string_split(body, chr(10)) AS ls, string_split_regex(body, '{empty}') AS ps
  FROM (SELECT r, trim(lower(text), {blanks} || chr(10)) AS body FROM raw)),
plain AS (
  SELECT *, coalesce(list_position(list_transform(ls, lambda l: regexp_matches(l, '^[ \\t]*{licenses.COMMENT_LINE}')), false) - 1, len(ls)) AS run FROM texts),
blocks AS (
  SELECT *, CASE {closed} WHEN regexp_matches(body, '^{licenses.COMMENT_LINE}') THEN array_to_string(ls[1:run], chr(10)) ELSE ps[1] END AS block FROM plain),
spots AS (
  SELECT DISTINCT r, kind, x FROM (
    SELECT r, 0 AS kind, body AS x FROM blocks UNION ALL SELECT r, 1, ls[1] FROM blocks UNION ALL SELECT r, 1, block FROM blocks
    UNION ALL SELECT r, 2, unnest(ps) FROM blocks UNION ALL SELECT r, 2, unnest(ls) FROM blocks) WHERE {signal}),
total AS (SELECT count(text) AS n FROM raw),
tmpl AS (
  SELECT t, license, term, count(*) AS tf FROM (SELECT t, license, unnest({words('notice')}) AS term FROM (VALUES {notices}) v(t, license, notice)) GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tmpl),
df AS (SELECT term, count(*) AS c FROM (SELECT DISTINCT r, unnest({words('text')}) AS term FROM raw) SEMI JOIN vocab USING (term) GROUP BY term),
idf AS (SELECT v.term, ln((total.n + 1) / (coalesce(c, 0) + 1)) + 1 AS i FROM vocab v LEFT JOIN df USING (term), total),
tw AS (SELECT t, license, term, tf * i AS w FROM tmpl JOIN idf USING (term)),
tn AS (SELECT t, sqrt(sum(w * w)) AS s, count(*) AS size FROM tw GROUP BY t),
lw AS (
  SELECT x, term, tf * coalesce(i, ln(total.n + 1) + 1) AS w
  FROM (SELECT x, term, count(*) AS tf FROM (SELECT x, unnest({words('x')}) AS term FROM (SELECT DISTINCT x FROM spots)) GROUP BY ALL)
  LEFT JOIN idf USING (term), total),
ln_ AS (SELECT x, sqrt(sum(w * w)) AS s FROM lw GROUP BY x),
score AS (
  SELECT x, license, round(sum(lw.w * tw.w) / any_value(tn.s) / any_value(ln_.s), 6) AS sc
  FROM lw JOIN tw USING (term) JOIN tn USING (t) JOIN ln_ USING (x) GROUP BY x, t, license HAVING count(*) >= least(2, any_value(size))),
best AS (SELECT x, license, sc FROM score WHERE sc >= {licenses.THRESHOLD} QUALIFY row_number() OVER (PARTITION BY x ORDER BY sc DESC, license) = 1),
own AS (
  SELECT r, kind, license, sc FROM spots JOIN best USING (x) WHERE kind > 0 OR sc >= {licenses.WHOLE_THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY kind, sc DESC, license) = 1),
heads AS (
  SELECT dir, license AS given FROM own JOIN dirs USING (r) WHERE kind <= 1 QUALIFY row_number() OVER (PARTITION BY dir ORDER BY sc DESC, license) = 1),
given AS (
  SELECT d.r, h.dir AS up, h.given FROM dirs d JOIN heads h ON d.dir = h.dir OR h.dir = '' OR starts_with(d.dir, h.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.r ORDER BY length(h.dir) DESC) = 1)
SELECT doc_id, path, coalesce(own.license, given.given) AS license, round(sc, 4) AS score,
       CASE kind WHEN 0 THEN 'file' WHEN 1 THEN 'header' WHEN 2 THEN 'notice'
            ELSE CASE WHEN given.given IS NOT NULL THEN 'folder:' || up ELSE 'none' END END AS basis
FROM dirs LEFT JOIN own USING (r) LEFT JOIN given USING (r)
"""


ORACLES["op2_license_scan"] = _license_sql()

# crc32 of the decimal id, bit by bit: a byte is one step, followed by eight shifts (-1)
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


def _field_sql(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS now FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS p FROM leaves),
nodes AS (
  SELECT tree, 0 AS lv, p, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lv + 1, p // 3, sha256(string_agg(d, '' ORDER BY p)), any_value((n + 2) // 3) FROM nodes WHERE n > 1 GROUP BY tree, lv, p // 3),
tops AS (
  SELECT 0 AS lv, tree AS p, d, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT lv + 1, p // 3, sha256(string_agg(d, '' ORDER BY p)), any_value((n + 2) // 3) FROM tops WHERE n > 1 GROUP BY lv, p // 3),
steps AS (
  SELECT a.tree, a.lv, a.p, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
         coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS g
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lv = b.lv AND a.p // 3 = b.p // 3 WHERE a.n > 1 GROUP BY a.tree, a.lv, a.p),
top_steps AS (
  SELECT a.lv, a.p, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
         coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS g
  FROM tops a JOIN tops b ON a.lv = b.lv AND a.p // 3 = b.p // 3 WHERE a.n > 1 GROUP BY a.lv, a.p),
walk AS (
  SELECT r, tree, 0 AS lv, p, '' AS proof, now AS d FROM placed
  UNION ALL
  SELECT r, tree, w.lv + 1, w.p // 3, proof || l || g, sha256(l || w.d || g) FROM walk w JOIN steps USING (tree, lv, p)),
top_walk AS (
  SELECT r, 0 AS lv, tree AS p, proof, d FROM walk QUALIFY row_number() OVER (PARTITION BY r ORDER BY lv DESC) = 1
  UNION ALL
  SELECT r, w.lv + 1, w.p // 3, proof || l || g, sha256(l || w.d || g) FROM top_walk w JOIN top_steps USING (lv, p)),
done AS (SELECT r, proof, d FROM top_walk QUALIFY row_number() OVER (PARTITION BY r ORDER BY lv DESC) = 1),
root AS (SELECT d AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, s.d AS subroot, root, sha256(proof) AS proof_sha256, done.d AS folded_root, done.d = root AS verified
FROM placed JOIN done USING (r) JOIN nodes s ON s.tree = placed.tree AND s.n = 1, root
"""

ORACLES["op13_collocations"] = r"""
WITH raw AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM raw),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM spots, range(1, 6) g(s) WHERE i + s - 1 <= len(w)),
f AS (SELECT lang, phrase, any_value(s) AS s, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
parts AS (
  SELECT lang, phrase, s, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail FROM f, range(1, 5) c(k) WHERE k < s),
scored AS (
  SELECT p.*, h.a AS l, t.a AS r, n, CAST((1000::HUGEINT * p.a * n) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
  FROM parts p JOIN f h ON h.lang = p.lang AND h.phrase = p.head JOIN f t ON t.lang = p.lang AND t.phrase = p.tail
  JOIN total ON total.lang = p.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f g WHERE g.lang = b.lang AND g.s > b.s AND 100 * g.a >= 100 * b.a AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
