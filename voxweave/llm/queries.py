"""The dealt operators over the given tables, with SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, divergence, jaccard, language, licenses, lines, lm_scoring, pieces, quality, resampling, substrings, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]
_SPACE = r"[\x20\x09-\x0D]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or its template, and which one."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    named = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    held_out = F.coalesce(language.fold(F.col("doc_id")) == 2, F.lit(False))
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` by shingle sets."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without multi-line chunks that occur earlier."""
    return lines.drop_repeated_chunks(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text of ``documents``, each decoded again and compared."""
    return pieces.tokenize(_table(spark, sf_dir, "documents"), pieces.load())


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat a window of 20 words, removed from every text of ``documents``."""
    return substrings.repeated_windows(_table(spark, sf_dir, "documents")).drop("span_starts", "span_ends")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every whole text of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the URL of every page."""
    return urls.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every whole text of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of every whole text of ``documents`` that are about a licence."""
    docs = _table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms each source has in excess."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the texts of ``benchmark``."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    gain = resampling.gains(resampling.bucket_counts(docs), resampling.bucket_counts(_table(spark, sf_dir, "benchmark")))
    scored = resampling.weigh(docs, gain).drop("text")
    return resampling.draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy log probability of every whole text of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.fit(docs))


SQL6 = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS start, words FROM w WHERE len(words) >= 20),
k AS (SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS win FROM s),
r AS (SELECT doc_id, start, row_number() OVER (PARTITION BY win ORDER BY doc_id, start) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM r WHERE nth > 1),
p AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS body, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SQL3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
  UNION ALL SELECT doc_id, array_to_string(words, ' ') AS g FROM w WHERE len(words) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM w JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id
"""

SQL4 = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i, len(lines) AS n FROM l),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 15))::BIGINT % 2147483647 AS v FROM u),
b AS (SELECT *, (coalesce(lag(v) OVER (PARTITION BY doc_id ORDER BY i), 0) * 1000003 + v) % 2147483647 % 4 = 0 OR i = n AS ends FROM h),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
p AS (SELECT doc_id, i AS first, i + 1 AS last, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS body FROM u),
k AS (SELECT doc_id, min(i) AS first, max(i) AS last, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, chunk HAVING count(*) > 2
      UNION ALL SELECT * FROM p WHERE body IS NOT NULL),
f AS (SELECT *, rank() OVER (PARTITION BY body ORDER BY doc_id, first) AS nth FROM k WHERE regexp_matches(body, '[^\\x20\\x09-\\x0D]')),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM f WHERE nth > 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(len(l.lines), 0)::BIGINT AS n_lines,
       (coalesce(len(l.lines), 0) - coalesce(k.n, 0))::BIGINT AS n_removed
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

SQL11 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
keep AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM keep GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN keep USING (lang, term) GROUP BY ALL),
ng AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL),
nl AS (SELECT lang, sum(n) AS total FROM n GROUP BY ALL),
p AS (SELECT g.lang, g.source, keep.term, coalesce(n.n, 0) AS n,
        (1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 5)) // (coalesce(ng.total, 0) + 5 * v.v)::HUGEINT)::BIGINT AS p
      FROM g JOIN keep USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term) LEFT JOIN ng USING (lang, source)),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(nl.total) + 5 * any_value(v.v))::HUGEINT)::BIGINT AS q
      FROM n JOIN nl USING (lang) JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""

_BYTES = "list_transform(range(length(hex(w)) // 2), lambda i: ('0x' || substr(hex(w), (2 * i + 1)::INT, 2))::BIGINT)"
_STEP = "if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1)"
SQL12 = rf"""
WITH RECURSIVE tab(i, x, k) AS (
  SELECT i, i, 0 FROM range(256) t(i) UNION ALL SELECT i, {_STEP}, k + 1 FROM tab WHERE k < 8),
crc AS (SELECT list(x ORDER BY i) AS tab FROM tab WHERE k = 8),
w AS (SELECT rid, unnest(words) AS w FROM (
  SELECT rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents))),
t AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
b AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM (SELECT w FROM w UNION SELECT w FROM t), crc),
s AS (SELECT bucket, count(*) AS s FROM w JOIN b USING (w) GROUP BY bucket),
u AS (SELECT bucket, count(*) AS t FROM t JOIN b USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + 10000)::DOUBLE)
        / ((s + 1)::DOUBLE * ((SELECT count(*) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN u USING (bucket)),
f AS (SELECT rid, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM w JOIN b USING (w) JOIN g USING (bucket) GROUP BY rid),
d AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
      FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN f USING (rid)),
r AS (SELECT *, n_features >= 20 AS fits, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS nth, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM d)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND nth <= 10 * n // 100 THEN nth END AS rank FROM r
"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_decontamination, op2_language_id, op3_jaccard_join, op4_line_dedup, op5_sentencepiece, op6_substring_dedup, op7_toxicity, op8_url_filters, op9_quality_rules, op10_license_scan, op11_source_divergence, op12_importance_resampling, op13_lm_scoring)}
ORACLES: dict[str, str] = {"op3_jaccard_join": SQL3, "op4_line_dedup": SQL4, "op6_substring_dedup": SQL6, "op11_source_divergence": SQL11, "op12_importance_resampling": SQL12}
