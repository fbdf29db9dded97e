"""Source divergence audit: how far the sources of a language lie apart in their use of frequent terms.

Terms are runs of ASCII letters and of characters beyond ASCII, A-Z lower-cased. Identical texts of one language are
collapsed, with how often each source has them: first inside each slice of a task, then by a hash of language and text.
Each text that is left is tokenized once, and its counts and document counts are added with these weights. Weights add
up, so a text that half of all rows repeat may be collapsed in several groups (one for ``FAN_IN`` partitions) without any
change of the sums. Terms in at least ``LEAST_DOCS`` documents of a language are kept.

Shares of kept terms are integers, ``1 + floor(10**9 * (n + 5) / (N + 5 * V))``, computed in decimals. The distance of two
sources is the sum of absolute differences over all kept terms. Pairs are evaluated sparsely, in blocks of terms: a
source has one share for all terms it lacks, so a pair needs that share against the sorted shares of the other source
(prefix sums) and a correction for terms that both have.

Rows: null text, language or source counts as ''. A source without terms still has its pairs. A language without kept
terms has distance 0. Repeated rows count as often as they stand there. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .native import settle
from .sizing import groups_for, text_bytes

LEAST_DOCS = 30
TOP_TERMS = 50
SLICE = 4 << 20
GROUP_BYTES = 16 << 20
FAN_IN = 4096
BLOCK_ENTRIES = 200_000
STRIPE = 512
_term = K.class_table([*range(65, 91), *range(97, 123), *range(128, 256)])
_FIELDS = {"lang": pa.string(), "text": pa.string(), "source": pa.string(), "n": pa.int64()}


def _collapse(table: pa.Table) -> pa.Table:
    """One row for each (lang, text, source), with its multiplicity, equal texts together."""
    texts = table.group_by(["lang", "text", "source"], use_threads=False).aggregate([("n", "sum")])
    return texts.rename_columns({"n_sum": "n"}).select(list(_FIELDS)).combine_chunks()


def _route(groups: int):
    """Collapsed rows of a slice as compressed streams, by a hash of language and text."""

    def run(batches):
        for whole in batches:
            for batch in K.slices(whole, "text", SLICE):
                table = pa.Table.from_batches([batch]).append_column("n", pa.array(np.ones(batch.num_rows, np.int64)))
                table = _collapse(table)
                keys = K.span_hash(*_spans(table.column("text"))) * np.uint64(31) + K.span_hash(*_spans(table.column("lang")))
                to = (K.mix(keys) % np.uint64(groups)).astype(np.int32)
                by = np.argsort(to, kind="stable")
                bounds = K.group_bounds(to[by])
                part = int(batch.column(batch.schema.get_field_index("part"))[0].as_py())
                blobs = [K.to_stream(table.take(pa.array(by[a:b])).combine_chunks().to_batches()[0]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[by][bounds[:-1]]), pa.array(np.full(len(blobs), part // FAN_IN, np.int32)), pa.array(blobs, pa.binary())],
                    names=["home", "salt", "texts"],
                )

    return run


def _spans(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, at = K.utf8(column)
    return data, at[:-1], at[1:]


def _codes(column) -> tuple[np.ndarray, pa.Array]:
    held = column.combine_chunks().dictionary_encode() if isinstance(column, pa.ChunkedArray) else column.dictionary_encode()
    return held.indices.to_numpy().astype(np.int64), held.dictionary


def _weighted(table: pa.Table) -> pa.Table:
    """(lang, source, term, n, docs) of collapsed rows with equal texts side by side; each distinct text is tokenized once."""
    lang, langs = _codes(table.column("lang"))
    source, sources = _codes(table.column("source"))
    text, texts = _codes(table.column("text"))
    data, at = K.utf8(texts)
    data = K.lower_ascii(data)
    start, end, first = K.runs(data, at, _term)
    _, place, term = np.unique(K.span_hash(data, start, end), return_index=True, return_inverse=True)
    own = np.repeat(np.arange(len(at) - 1), np.diff(first))
    width = max(1, len(place))
    pair, n = np.unique(own * width + term, return_counts=True)  # terms of each text
    of_text = np.searchsorted(pair // width, np.arange(len(at)))
    size = np.diff(of_text)[text]  # entries of each collapsed row
    head = np.cumsum(size) - size
    entry = np.repeat(of_text[text] - head, size) + np.arange(size.sum())
    row = np.repeat(np.arange(len(text)), size)
    weight = table.column("n").to_numpy()[row]
    group = (lang * len(sources) + source)[row]
    key, back = np.unique(group * width + pair[entry] % width, return_inverse=True)
    total, docs = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    np.add.at(total, back, n[entry] * weight)
    np.add.at(docs, back, weight)
    body = data.tobytes()
    terms = pa.array([body[start[i] : end[i]] for i in place.tolist()], pa.binary()).cast(pa.string())
    group, term = np.divmod(key, width)
    return pa.table({
        "lang": langs.take(pa.array(group // max(1, len(sources)))), "source": sources.take(pa.array(group % max(1, len(sources)))),
        "term": terms.take(pa.array(term)), "n": pa.array(total), "docs": pa.array(docs),
    })


def _counted(streams: pa.Table) -> pa.Table:
    """Weighted counts of one group of texts, worked out a few megabytes of text at a time."""
    rows = _collapse(K.from_streams(streams.column("texts"), _FIELDS)).sort_by([("lang", "ascending"), ("text", "ascending")])
    batches = [part for batch in rows.to_batches() for part in K.slices(batch, "text", SLICE)]
    tables = [_weighted(pa.Table.from_batches([batch])) for batch in batches]
    keys = ["lang", "source", "term"]
    total = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return total.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n) of the kept terms that a source has."""
    docs = _named(docs, "text").withColumn("part", F.spark_partition_id())
    groups = groups_for(text_bytes(docs), GROUP_BYTES)
    routed = docs.mapInArrow(_route(groups), "home int, salt int, texts binary")
    found = routed.groupBy("home", "salt").applyInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # Groups are sums already, so one shuffle by term serves the counts of sources and the documents of a language.
    found = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return found.withColumn("_docs", everywhere).where(F.col("_docs") >= least_docs).select("lang", "source", "term", "n")


def _named(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", *more)])


def _share(n: Column, total: Column, terms: Column) -> Column:
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + 5).cast("decimal(19,0)")
    return F.call_function("div", top, (total + 5 * terms).cast("decimal(19,0)")) + 1


def _block(groups: pa.Table, entries: pa.Table) -> pa.Table:
    """Distances over one block of terms, from the sources of one stripe to all others."""
    names, absent = groups.column("source"), groups.column("absent").to_numpy()
    mine = np.flatnonzero(groups.column("mine").to_numpy(zero_copy_only=False))
    term, terms = _codes(entries.column("term"))
    source = pc.index_in(entries.column("source"), names.combine_chunks()).to_numpy().astype(np.int64)
    p, count = entries.column("p").to_numpy(), len(terms)
    by = np.lexsort((p, source))
    first = np.searchsorted(source[by], np.arange(len(names) + 1))
    apart = np.abs(absent[:, None] - absent[None, mine])
    alone = np.zeros((len(names), len(mine)), np.int64)  # terms of a source against the other's share of absent terms
    for g in range(len(names)):
        alone[g] = _to_points(p[by[first[g] : first[g + 1]]], absent[mine]) - (first[g + 1] - first[g]) * apart[g]
    out = count * apart + alone
    of_term = np.argsort(term, kind="stable")
    term_first = np.searchsorted(term[of_term], np.arange(count + 1))
    for k, g in enumerate(mine):
        own = by[first[g] : first[g + 1]]
        out[:, k] += _to_points(p[own], absent) - len(own) * apart[:, k]
        size = np.diff(term_first)[term[own]]
        head = np.cumsum(size) - size
        other = of_term[np.repeat(term_first[term[own]] - head, size) + np.arange(size.sum())]
        here, h = np.repeat(p[own], size), source[other]
        both = np.abs(here - p[other]) - np.abs(here - absent[h]) - np.abs(p[other] - absent[g]) + apart[h, k]
        np.add.at(out[:, k], h, both)
    g, h = np.meshgrid(mine, np.arange(len(names)))
    keep = g.ravel() != h.ravel()
    langs = groups.column("lang").take(pa.array(np.zeros(keep.sum(), np.int64)))
    return pa.table({"lang": langs, "source": names.take(pa.array(g.ravel()[keep])), "item": names.take(pa.array(h.ravel()[keep])), "value": pa.array(out.ravel()[keep])})


def _to_points(values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sum of absolute differences of ascending values to each point."""
    sums = np.concatenate([[0], np.cumsum(values)])
    k = np.searchsorted(values, points)
    return points * k - sums[k] + (sums[-1] - sums[k]) - points * (len(values) - k)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms a source has most in excess."""
    kept, _ = settle(term_counts(docs, least_docs))
    terms, _ = settle(kept.groupBy("lang", "term").agg(F.sum("n").alias("n")))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("entries"))
    groups = _named(docs).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups, _ = settle(groups.fillna(0, ["total", "entries", "terms", "lang_total"]))

    size = groups.groupBy("lang").agg(F.sum("entries").alias("_entries"), F.count(F.lit(1)).alias("_groups"))
    size = size.select("lang", F.ceil(F.col("_entries") / block_entries).alias("_blocks"), F.ceil(F.col("_groups") / STRIPE).alias("_stripes"))
    entries = kept.join(groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    entries = entries.withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    blocks = (
        entries.join(size, "lang")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("_blocks")))
        .withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_stripes") - 1)))
        .select("lang", "block", "stripe", "source", "term", "p")
    )
    around = (
        groups.where("terms > 0").join(size, "lang")
        .withColumn("absent", _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
        .withColumn("_own", F.pmod(F.xxhash64("source"), F.col("_stripes")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_stripes") - 1)))
        .select("lang", "block", "stripe", "source", "absent", (F.col("_own") == F.col("stripe")).alias("mine"))
    )
    keys = ["lang", "block", "stripe"]
    apart = around.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(_block, "lang string, source string, item string, value long")
    apart = apart.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = pairs.join(apart, ["lang", "source", "item"], "left").fillna(0, ["value"]).withColumn("part", F.lit("pair"))

    q = terms.join(langs, "lang").select("lang", "term", _share(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q"))
    over = entries.join(q, ["lang", "term"]).where(F.col("p") > F.col("q"))
    over = over.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    ranked = over.withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).select(*columns).unionByName(ranked.select(*columns))
