"""Line dedup with content-defined chunks, on DataFrame functions only.

Each line has a hash; a polynomial over the hashes of a line and the one before decides whether a chunk ends after the
line, so boundaries move with the lines when text is put in or taken out above. Chunks are cut at two scales. At the
coarse one a line in ``DIVISOR`` ends a chunk. At the fine one every line does, and since a chunk has two lines at least,
each line is joined to its neighbours on both sides: the chunks are all pairs of adjacent lines. So a passage of two or
more whole lines is found wherever it stands, and spans of both scales are united. A chunk that is not blank, and whose
bytes occur earlier (a smaller doc_id, or the same document further up), is removed. Chunks first meet
by a 64-bit hash in narrow rows; only chunks whose hash repeats fetch their text, and grouping by that text compares the
bytes. Counts and first places are combined before rows are shuffled, so a chunk in a third of all documents is no
hotter than others; joins by hash are left to adaptive skew handling. Lists of spans go to the texts as a broadcast while
they are within ``SPAN_BYTES``; beyond that texts and spans meet by row.

Rows: a null text stays null, with no lines; an empty one is one empty line. A null doc_id comes before all others. Rows
are told apart by id and a hash of the text: of rows that share an id each loses only its own lines, and a chunk at the
same line numbers of the same id is not earlier, so copies of a row stay alike. Extra columns stay; result columns
replace input columns of their name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import settle, shielded

DIVISOR = 4
SPAN_BYTES = 32 << 20
PRIME = (1 << 31) - 1
BASE = 1_000_003
NULL_ID = -(1 << 63)


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _lines(text):
    return F.split(text, "\n", -1)


def _join(lines):
    return F.array_join(lines, "\n", "")


def _text():
    return F.xxhash64("text")


def chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(_id, _text, first, last, key) of every chunk of two or more lines, of both scales; line numbers start at 1."""
    hashes = F.transform("_lines", lambda x: F.conv(F.substring(F.md5(x), 1, 15), 16, 10).cast("long") % PRIME)
    lines = docs.where(F.col("text").isNotNull()).select(_id().alias("_id"), _text().alias("_text"), _lines(F.col("text")).alias("_lines"))
    hashed = lines.where(F.size("_lines") > 1).select("*", hashes.alias("_hashes"))

    def ends(h, i):
        before = F.when(i > 0, F.element_at("_hashes", i)).otherwise(F.lit(0))
        return (before * BASE + h) % PRIME % divisor == 0

    marks = F.transform("_hashes", lambda h, i: F.when(ends(h, i) | (i == F.size("_hashes") - 1), i + 1))
    cut = hashed.select("_id", "_text", "_lines", F.filter(marks, lambda x: x.isNotNull()).alias("_ends"))
    spans = F.transform(
        "_ends", lambda e, k: F.struct(F.when(k > 0, F.element_at("_ends", k) + 1).otherwise(F.lit(1)).alias("first"), e.alias("last"))
    )
    coarse = F.filter(spans, lambda s: s["last"] > s["first"] + 1)  # those of two lines are pairs already
    pairs = F.transform(F.sequence(F.lit(1), F.size("_lines") - 1), lambda i: F.struct(i.alias("first"), (i + 1).alias("last")))

    def keyed(s):
        body = _join(F.slice("_lines", s["first"], s["last"] - s["first"] + 1))
        return F.struct(s["first"].alias("first"), s["last"].alias("last"), F.xxhash64(body).alias("key"), body.rlike(r"[^\x20\x09-\x0D]").alias("full"))

    found = F.filter(F.transform(F.concat(pairs, coarse), keyed), lambda c: c["full"])
    return cut.select("_id", "_text", F.explode(found).alias("c")).select("_id", "_text", "c.first", "c.last", "c.key")


def _with_spans(rows: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """``rows`` with the ``_spans`` of their (_id, _text); short lists of spans are broadcast."""
    size = spans.agg(F.sum(24 + 16 * F.size("_spans"))).first()[0] or 0
    return rows.join(F.broadcast(spans) if size <= SPAN_BYTES else spans, ["_id", "_text"], how)


def repeated(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """(_id, _text, _spans): for each row with repeated chunks, the line spans to remove."""
    found, _ = settle(chunks(docs, divisor))
    keys = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    spans = F.collect_set(F.struct("first", "last", "key")).alias("_spans")  # copies of a row have the same spans
    members, _ = settle(found.join(keys, "key").groupBy("_id", "_text").agg(spans))
    texts = docs.where(F.col("text").isNotNull()).select(_id().alias("_id"), _text().alias("_text"), "text")
    bodies = _with_spans(texts, members, "inner").select("_id", _lines(F.col("text")).alias("_lines"), F.explode("_spans").alias("s"))
    bodies = bodies.select("_id", "s.*", _join(F.slice("_lines", F.col("s.first"), F.col("s.last") - F.col("s.first") + 1)).alias("body"))
    firsts = bodies.groupBy("body").agg(F.min(F.struct("_id", "first", "last", "key")).alias("at")).select("at.*")
    places = members.select("_id", "_text", F.explode("_spans").alias("s")).select("_id", "_text", "s.*")
    gone = places.join(firsts, ["_id", "first", "last", "key"], "left_anti")
    return settle(gone.groupBy("_id", "_text").agg(F.collect_list(F.struct("first", "last")).alias("_spans")))[0]


def drop_repeated_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and ``n_lines`` and ``n_removed`` added."""
    outer = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs, names = shielded(docs.select(*outer), "doc_id", "text")
    kept = [c for c in names if c != "text"]
    docs = docs.select(*kept, F.col("text").cast("string").alias("text"))
    rows = _with_spans(docs.withColumn("_id", _id()).withColumn("_text", _text()), repeated(docs, divisor), "left")
    rows = rows.withColumn("_lines", _lines(F.col("text")))
    gone = F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s["first"], s["last"]))))
    rows = rows.withColumn("_gone", gone)
    left = F.transform(F.array_except(F.sequence(F.lit(1), F.size("_lines")), "_gone"), lambda i: F.get("_lines", i - 1))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(_join(left))
    rows = rows.select(
        *kept,
        text.alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    return rows.select(*names, "n_lines", "n_removed").toDF(*outer, "n_lines", "n_removed")
