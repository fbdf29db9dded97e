"""Positions, caps, batches, limits, shuffles and samples over explicitly ordered rows.

A plain ``row_number()`` over one source sends that source to one task. Here rows are numbered in two steps
instead: every source is cut into ranges ("spans") of its order column, spans are counted, the short list of
counts is summed into offsets, and only then are rows numbered, each span on its own. A source holding a third
of the table is spread over as many tasks as it has spans.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import _col
from ..session import measured

SPAN = 1 << 20
LAST_SPAN = (1 << 63) - 1  # of rows without an order key


def whole(c: Column | str, by: int) -> Column:
    """Integer division, exact for every long (a plain ``/`` goes through doubles)."""
    return F.call_function("div", _col(c), F.lit(by))


def span_of(order: Column | str, width: int = SPAN) -> Column:
    """Range number of an integer order column."""
    return whole(order, width)


def span_offsets(df: DataFrame, part: list[str], below: int | None = None) -> DataFrame:
    """Rows in and before each span: one small row per (part, span) of ``df``, which has a ``_span`` column.

    The counts are worked out here, once. While they are few they are broadcast, so joining them prunes and marks
    rows where they are scanned; more of them are joined by shuffle on the window's own partitioning.
    """
    counts = df.groupBy(*part, "_span").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*part).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return measured(offsets if below is None else offsets.where(F.col("_before") < below))


def even_spans(df: DataFrame, part: list[str], order: str, rows: int = SPAN // 4, levels: int = 3) -> DataFrame:
    """``df`` with ``_span``: cells of about ``rows`` rows of each part whatever its order values look like.

    The values of a part are cut into equal ranges, and a range that still holds too many rows is cut again, up to
    ``levels`` times. Each level is one narrow pass that counts cells on the map side; only the list of cells that are
    too full goes on to the next. Rows without an order value follow all others and are dealt by a hash of the row. Cells
    compare as (cell, cell inside it, ...), in the order of the values.
    """
    value, cells = F.col(order).cast("double"), [f"_cell{k}" for k in range(levels)]
    hashed = F.xxhash64(*df.columns)
    inside = [F.col(c) for c in part]
    for k, cell in enumerate(cells):
        sizes = df.groupBy(*inside, *cells[:k]).agg(
            F.count(value).alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.count_if(value.isNull()).alias("_none")
        )
        sizes = sizes.where((F.col("_n") > rows) | (F.col("_none") > rows)) if k else sizes
        listed = measured(sizes.select(
            *[F.col(c).alias(f"_at_{i}") for i, c in enumerate([*part, *cells[:k]])], "_low", "_high",
            F.ceil(F.col("_n") / rows).alias("_cells"), F.ceil(F.col("_none") / rows).alias("_null_cells"),
        ))
        same = F.lit(True)
        for i, c in enumerate([*part, *cells[:k]]):
            same = same & F.col(c).eqNullSafe(F.col(f"_at_{i}"))
        width = F.greatest(F.col("_high") - F.col("_low"), F.lit(1e-300))
        number = F.least(F.floor((value - F.col("_low")) / width * F.col("_cells")), F.col("_cells") - 1)
        dealt = F.col("_cells") + F.pmod(hashed, F.greatest(F.col("_null_cells"), F.lit(1)))
        df = df.join(listed, same, "left").withColumn(cell, F.coalesce(F.when(value.isNull(), dealt if k == 0 else None).otherwise(number), F.lit(0)).cast("long"))
        df = df.drop("_low", "_high", "_cells", "_null_cells", *[f"_at_{i}" for i in range(len(part) + k)])
        if k + 1 < levels and not sizes.where(F.col("_n") > 4 * rows).take(1):
            cells = cells[: k + 1]
            break
    return df.withColumn("_span", F.struct(*cells)).drop(*cells)


def dense_position(
    df: DataFrame, part: list[str], order: list[str], span: Column | None = None, name: str = "position",
    below: int | None = None, counted: DataFrame | None = None, offsets: DataFrame | None = None, even: int | None = None,
) -> DataFrame:
    """0-based position of every row inside ``part`` by ``order``.

    ``even`` takes spans of about so many rows from ``even_spans``, for order values that are sparse, hashed or missing.

    ``span`` must grow with the first order column (default: ranges of that integer column). Rows whose first order
    column is null come last; a null ``part`` is a part of its own. With ``below`` only positions under it are kept, and spans that start past it are dropped
    before any row is shuffled; up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) each task sends no more than
    ``below`` rows of a span. ``counted`` may name a cheaper frame with the same rows for the counting pass,
    ``offsets`` counts that are already there.
    """
    if even:
        keyed = even_spans(df, part, order[0], even)
    else:
        span = F.coalesce(span_of(order[0]) if span is None else span, F.lit(LAST_SPAN))
        keyed = df.withColumn("_span", span)
    if offsets is None:
        offsets = span_offsets(keyed if counted is None or even else counted.withColumn("_span", span), part, below)
    inside = Window.partitionBy(*part, "_span").orderBy(*[F.asc_nulls_last(c) for c in order])
    marks = offsets.select("_before", F.col("_span").alias("_at_span"), *[F.col(c).alias(f"_at_{k}") for k, c in enumerate(part)])
    same = F.col("_span") == F.col("_at_span")
    for k, c in enumerate(part):
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{k}"))
    placed = keyed.join(marks, same).drop("_at_span", *[f"_at_{k}" for k in range(len(part))])
    placed = placed.withColumn("_nth", F.row_number().over(inside))
    if below is not None:
        # Said of the rank itself, so that a task drops what lies behind the first ``below`` rows of a span before it sends them.
        placed = placed.where(F.col("_nth") <= below)
    numbered = placed.withColumn(name, F.col("_before") + F.col("_nth") - 1).drop("_span", "_before", "_nth")
    return numbered if below is None else numbered.where(F.col(name) < below)


def source_rank(column: str, order: list[str]) -> Column:
    """Rank of a source in the configured order; null for a source that is not configured."""
    return F.array_position(F.array(*[F.lit(s) for s in order]), F.col(column)).cast("int") - 1


def assign_global_index(df: DataFrame, sources: list[str], raw_index: str = "raw_index", source: str = "source",
                        span: int = SPAN) -> DataFrame:
    """Running index over the sources in their configured order, counting the rows of ``df`` only.

    Earlier sources' totals reach a later source as one row per (earlier, later) source pair of the configured
    list, so no window runs over the whole table.
    """
    known = df.withColumn("_rank", source_rank(source, sources)).where(F.col("_rank") >= 0)
    spans = span_of(raw_index, span)
    offsets = span_offsets(known.withColumn("_span", spans), ["_rank"])
    ahead = (
        offsets.select("_rows", F.explode(F.sequence(F.col("_rank"), F.lit(len(sources) - 1))).alias("_later"), "_rank")
        .groupBy(F.col("_later").alias("_rank_"))
        .agg(F.sum(F.when(F.col("_later") > F.col("_rank"), F.col("_rows")).otherwise(0)).alias("_ahead"))
        .withColumnRenamed("_rank_", "_rank")
    )
    placed = dense_position(known, ["_rank"], [raw_index], spans, "_inside", offsets=offsets)
    return (
        placed.join(F.broadcast(ahead), "_rank")  # one row per configured source
        .withColumn("global_index", F.col("_ahead") + F.col("_inside"))
        .drop("_rank", "_ahead", "_inside")
    )


def cap_per_source(df: DataFrame, cap: int | None, source: str = "source", raw_index: str = "raw_index",
                   span: int = SPAN, even: int | None = None) -> DataFrame:
    """First ``cap`` surviving rows of every source; filters run before, so only survivors count."""
    if cap is None:
        return df
    return dense_position(df, [source], [raw_index], span_of(raw_index, span), "_at", below=cap, even=even).drop("_at")


def fixed_batches(df: DataFrame, size: int = K.ENCODE_BATCH, source: str = "source", raw_index: str = "raw_index",
                  span: int = SPAN, even: int | None = None) -> DataFrame:
    """Batch number and slot inside a source; a batch never spans two sources and the last may be short."""
    placed = dense_position(df, [source], [raw_index], span_of(raw_index, span), "_at", even=even)
    return placed.withColumn("batch", whole("_at", size)).withColumn(
        "slot", F.col("_at") % size
    ).drop("_at")


def take_limit(df: DataFrame, limit: int, order: list[str], span: Column | None = None, even: int | None = None) -> DataFrame:
    """First ``min(limit, rows)`` rows by ``order``; only spans that can reach the limit are sorted."""
    return dense_position(df.withColumn("_all", F.lit(0)), ["_all"], order, span, "_at", below=limit, even=even).drop("_all", "_at")


def shuffle_key(row_id: Column | str, epoch: Column | int, seed: int = 0) -> Column:
    """Repeatable random sort key: a digest of (row, epoch, seed)."""
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    return F.md5(F.concat_ws(":", _col(row_id).cast("string"), epoch.cast("string"), F.lit(str(seed))))


def epoch_shuffle(df: DataFrame, row_id: str, epoch: int, seed: int = 0, digits: int = 4) -> DataFrame:
    """All rows in a new order per epoch: ``shuffled_at`` is the position in that order.

    Spans are the leading ``digits`` hex digits of the key, so they are even whatever the data looks like.
    """
    keyed = df.withColumn("_key", shuffle_key(row_id, epoch, seed)).withColumn("_all", F.lit(0))
    lead = F.conv(F.substring("_key", 1, digits), 16, 10).cast("int")
    return dense_position(keyed, ["_all"], ["_key", row_id], lead, "shuffled_at").drop("_key", "_all")


def sample_vectors(df: DataFrame, k: int, row_id: str = "vec_id", seed: int = 0) -> DataFrame:
    """``k`` sampled rows with their ``draw`` number.

    Without replacement while there are enough rows (a top-k on a hash); otherwise ``k`` draws with replacement.
    ``k`` is a codebook size, so the sampled rows are few.
    """
    ranked = df.withColumn("_key", shuffle_key(row_id, 0, seed)).orderBy("_key", row_id).limit(k)
    ranked = ranked.withColumn("draw", F.row_number().over(Window.orderBy("_key", row_id)) - 1).drop("_key")
    have = ranked.count()
    if have >= k or have == 0:
        return ranked
    # Fewer rows than draws: ``ranked`` is the whole table and has under k rows.
    draws = df.sparkSession.range(k).select(
        F.col("id").cast("int").alias("_draw"),
        (F.conv(F.substring(shuffle_key("id", 1, seed), 1, 8), 16, 10).cast("long") % have).cast("int").alias("draw"),
    )
    return draws.join(ranked, "draw").drop("draw").withColumnRenamed("_draw", "draw")


# ---------------------------------------------------------------- batches bounded by length ratio


def _jumps(lengths: np.ndarray, ratio: float, size: int) -> np.ndarray:
    """For a batch starting at each row, how many rows it takes (lookahead rows included in ``lengths``)."""
    rows = len(lengths)
    taken = np.full(rows, size, np.int64)
    open_ = np.ones(rows, bool)
    top = lengths.astype(np.float64).copy()
    for k in range(1, min(size, rows)):
        nxt = np.full(rows, np.nan)
        nxt[: rows - k] = lengths[k:]
        cut = open_ & (nxt > ratio * top)
        taken[cut] = k
        open_ &= ~cut
        top = np.fmax(top, nxt)
    return taken


def length_ratio_batches(
    df: DataFrame, ratio: float = K.LENGTH_RATIO, size: int = K.ENCODE_BATCH, source: str = "source",
    raw_index: str = "raw_index", length: str = "length", span: int = SPAN, chunk: int = 1 << 18,
) -> DataFrame:
    """Batches that also end before a row more than ``ratio`` times longer than the longest row so far.

    Where a batch ends depends only on where it starts, and at most ``size`` rows ahead. So each chunk of a
    source works out, for each of the ``size`` rows a batch could enter it at, where the batch chain leaves it.
    These small tables are walked chunk by chunk, and each chunk then numbers its rows from its true entry.
    The result equals one pass over the whole source, but no task sees more than a chunk.
    """
    chunk = max(chunk, size)  # a batch reaches into the next chunk only
    slim = df.select(source, raw_index, F.col(length).cast("double").alias("_len"))
    placed = dense_position(slim, [source], [raw_index], span_of(raw_index, span), "_at")
    chunked = placed.withColumn("_chunk", whole("_at", chunk))
    # The first size-1 rows of a chunk are also lookahead for the chunk before.
    edge = (F.col("_at") % chunk < size - 1) & (F.col("_chunk") > 0)
    spread = chunked.withColumn(
        "_chunk", F.explode(F.when(edge, F.array(F.col("_chunk") - 1, F.col("_chunk"))).otherwise(F.array("_chunk")))
    )

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        first = int(pdf["_chunk"].iloc[0]) * chunk
        own = int((pdf["_at"] < first + chunk).sum())
        taken = _jumps(pdf["_len"].to_numpy(), ratio, size)
        exits, started = [], []
        for at in range(size):
            n = 0
            while at < own:
                at += int(taken[at])
                n += 1
            exits.append(max(at - own, 0))
            started.append(n)
        return pd.DataFrame(
            {source: [pdf[source].iloc[0]], "_chunk": [pdf["_chunk"].iloc[0]], "exits": [exits], "started": [started]}
        )

    kind = df.schema[source].dataType.simpleString()
    tables = spread.groupBy(source, "_chunk").applyInPandas(
        leave, f"{source} {kind}, _chunk long, exits array<int>, started array<int>"
    )

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        entry, base, entries, bases = 0, 0, [], []
        for exits, started in zip(pdf["exits"], pdf["started"]):
            entries.append(entry)
            bases.append(base)
            base += int(started[entry])
            entry = int(exits[entry])
        return pd.DataFrame({source: pdf[source], "_chunk": pdf["_chunk"], "_entry": entries, "_base": bases})

    entries = tables.groupBy(source).applyInPandas(walk, f"{source} {kind}, _chunk long, _entry int, _base long")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        first = int(pdf["_chunk"].iloc[0]) * chunk
        own = int((pdf["_at"] < first + chunk).sum())
        taken = _jumps(pdf["_len"].to_numpy(), ratio, size)
        starts = np.zeros(own, np.int64)
        at = int(pdf["_entry"].iloc[0])
        while at < own:
            starts[at] = 1
            at += int(taken[at])
        batch = int(pdf["_base"].iloc[0]) + starts.cumsum() - 1
        return pd.DataFrame({source: pdf[source][:own], raw_index: pdf[raw_index][:own], "batch": batch})

    order_kind = df.schema[raw_index].dataType.simpleString()
    batches = spread.join(entries, [source, "_chunk"]).groupBy(source, "_chunk").applyInPandas(
        number, f"{source} {kind}, {raw_index} {order_kind}, batch long"
    )
    return df.join(batches, [source, raw_index])
