"""URL filters: fixed host and path rules, and association rules mined from labelled URLs by Spark's FP-growth.

A URL is the set of its tokens: scheme, host, every parent domain, first label, path segments (a number counts as one
kind of segment), file ending and query names. FP-growth runs over the token sets of labelled pages, with the label as
one more item; a rule ``tokens -> block`` is kept from ``CONFIDENCE`` and ``SUPPORT_ROWS`` labelled rows on, and dropped if
a kept rule with fewer of its tokens exists. Rules are matched by an inverted index: each is filed under its rarest
token, and only the distinct URLs with that token are compared with it. A page that no fixed rule fits is blocked by a
matching mined rule, else allowed.

Rows: a null URL, or one without ``://``, has empty host and path and no tokens; it is allowed. Copies of a row get the
same verdict. With no labels there are no mined rules. Labels are those of the row of ``labels`` with the page's id; a
page is bad if its quality is 0. Columns other than page_id and url are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxweave.session import cut_lineage

from .native import small

# (verdict, host, start of path): fixed rules of the query.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
CONFIDENCE = 0.8
SUPPORT_ROWS = 20
BLOCK = "label=block"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), upper, lower), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def fixed_rule(host_column: Column, path_column: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_column == domain) | host_column.endswith("." + domain)) & path_column.startswith(start)
        name = F.when(fits, F.lit(domain + start)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    h, p = host(url), path(url)
    labels = F.split(h, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    )
    parts = F.filter(F.split(p, "/"), lambda x: x != "")
    segments = F.transform(parts, lambda x: F.concat(F.lit("path="), F.when(x.rlike(r"^[0-9]+$"), F.lit("<number>")).otherwise(F.regexp_replace(x, r"[0-9]+", "<number>"))))
    ending = F.regexp_extract(p, r"\.([A-Za-z0-9]{1,5})$", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query="), F.split(x, "=")[0]))
    fixed = F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1)), F.concat(F.lit("first="), labels[0]), F.concat(F.lit("ending="), ending))
    held = F.filter(fixed, lambda x: ~x.endswith("="))
    return F.when(h == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(held, parents, segments, names)))


def mine(pages: DataFrame, labels: DataFrame, confidence: float = CONFIDENCE, support_rows: int = SUPPORT_ROWS) -> DataFrame:
    """(id, tokens, confidence, support) of the rules for blocking."""
    marked = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").alias("_good"))
    rows = pages.select("page_id", tokens(F.col("url")).alias("_tokens")).where(F.size("_tokens") > 0).join(marked, "page_id")
    items = F.when(F.col("_good") == 0, F.array_append("_tokens", F.lit(BLOCK))).otherwise(F.col("_tokens"))
    baskets = cut_lineage(rows.select(items.alias("items")))
    n = baskets.count()
    spark = pages.sparkSession
    if n == 0:
        return spark.createDataFrame([], "id long, tokens array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support_rows / n), minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BLOCK))
    rules = rules.select(F.xxhash64(F.array_sort("antecedent")).alias("id"), F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = cut_lineage(rules)
    smaller = rules.select(F.col("tokens").alias("_less"), F.explode("tokens").alias("_t"))
    # a rule is redundant if all tokens of another are among its own: they meet on a shared token
    meets = rules.withColumn("_t", F.explode("tokens")).join(smaller, "_t").where(
        (F.size("_less") < F.size("tokens")) & (F.size(F.array_except("_less", "tokens")) == 0)
    )
    return cut_lineage(rules.join(meets.select("id").distinct(), "id", "left_anti"))


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs of ``pages`` that a rule matches, by inverted index on each rule's rarest token."""
    urls = pages.where(F.col("url").isNotNull()).select("url").distinct().select("url", tokens(F.col("url")).alias("_tokens"))
    wanted = rules.select("id", "tokens", F.explode("tokens").alias("_key"))
    counts = urls.select(F.explode("_tokens").alias("_key")).join(small(wanted.select("_key").distinct()), "_key", "left_semi").groupBy("_key").count()
    filed = wanted.join(counts, "_key", "left").groupBy("id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "_key")).alias("rare"), F.first("tokens").alias("tokens")
    ).select(F.col("rare._key").alias("_key"), "tokens")
    hits = urls.select("url", "_tokens", F.explode("_tokens").alias("_key")).join(small(filed), "_key")
    return hits.where(F.size(F.array_except("tokens", "_tokens")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    mined = mine(pages, labels)
    rows = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "url", "host", "path", name.alias("rule"), verdict.alias("_fixed"))
    if not mined.take(1):
        return rows.select("page_id", "host", "path", "rule", F.coalesce("_fixed", F.lit("allow")).alias("verdict"))
    hit = matched(pages, mined).select("url", F.lit("block").alias("_mined"))
    return rows.join(hit, "url", "left").select("page_id", "host", "path", "rule", F.coalesce("_fixed", "_mined", F.lit("allow")).alias("verdict"))
