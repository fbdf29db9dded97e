"""Restarting a corpus build: cursors, stored state, anchors in the written tail, what is still to do."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import _col, match_key
from ..session import measured
from .ordering import LAST_SPAN, SPAN, dense_position, source_rank, span_of

STATE_JSON = (
    "mode string, next_index long, rows_written long, next_part long, updated_at string, "
    "cursor struct<name:string,split:string,raw_index:long>, "
    "dataset_cursor struct<name:string,split:string,raw_index:long>"
)


def last_cursor(df: DataFrame, split: str = "split") -> DataFrame:
    """Per source and split: the raw index to read next."""
    return df.groupBy("source", split).agg((F.max("raw_index") + 1).alias("next_raw_index"))


def resume_from_cursor(
    df: DataFrame, sources: list[str], name: str | None, raw_index: int = 0, split: str | None = None,
    split_column: str | None = None, splits: dict[str, str] | None = None,
) -> DataFrame:
    """Sources after the cursor in full, the cursor's own source from its raw index, none before.

    A cursor for an unknown source (or another split of it) is ignored. Literals only, so the predicate reaches
    the scan.
    """
    known = name in sources and (splits is None or splits.get(name) == split)
    rank = source_rank("source", sources)
    if not known:
        return df.where(rank >= 0)
    at = sources.index(name)
    return df.where(
        F.col("source").isin(*sources[at + 1 :]) | ((F.col("source") == name) & (F.col("raw_index") >= raw_index))
    )


def anti_join_done(df: DataFrame, done: DataFrame, on: list[str], hashed: bool = False) -> DataFrame:
    """Rows whose key is not in the output yet. ``on`` is (source, split, raw_index) or the match key.

    A null key equals a null key. ``done`` is reduced to distinct keys on the map side, so a text that was written very often is one row of a
    join partition; the join then uses the same partitioning. ``hashed`` compares SHA-256 digests of a long text
    key, so the finished side moves 32 bytes per row instead of whole texts.
    """
    if not hashed:
        keys = done.select(*[F.col(c).alias(f"_done_{k}") for k, c in enumerate(on)]).distinct()
        same = [df[c].eqNullSafe(keys[f"_done_{k}"]) for k, c in enumerate(on)]
        return df.join(keys, reduce(and_, same), "left_anti")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in on]
    # Never null, so the join adds no not-null filter that would work the key out once more.
    digest = F.coalesce(F.unhex(F.sha2(F.concat_ws("\x1f", *parts), 256)), F.lit(b""))
    keys = done.select(digest.alias("_key")).distinct()
    return df.withColumn("_key", digest).join(keys, "_key", "left_anti").drop("_key")


def _newest_files(parts: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Only as many of the last files as hold ``n`` rows; the path predicate prunes files, not rows.

    Files are counted by a scan without columns; ``n`` paths at most come to the driver.
    """
    counts = parts.groupBy("file_path", *order).agg(F.count(F.lit(1)).alias("_n"))
    newest = [F.desc(c) for c in order]
    behind = Window.orderBy(*newest).rowsBetween(Window.unboundedPreceding, -1)
    last = counts.orderBy(*newest).limit(n).withColumn("_behind", F.coalesce(F.sum("_n").over(behind), F.lit(0)))
    return parts.where(F.col("file_path").isin([r[0] for r in last.where(F.col("_behind") < n).select("file_path").collect()]))


def tail_rows(parts: DataFrame, n: int, wanted: list[str], file: str = "file_name", row: str = "row_index",
              newest_files: bool = False) -> DataFrame:
    """Last ``n`` rows over files in the order of part numbers, then names, with the wanted columns that exist, oldest first.

    With ``newest_files`` (for a frame read straight from parts) older files are not opened at all. A folder that is not
    read yet is served by ``sources.parts.tail_of_parts``, which opens the last row groups only.
    """
    columns = [c for c in wanted if c in parts.columns and c not in (file, row)]
    order = [c for c in ("part", file) if c in parts.columns and c not in columns]
    if newest_files and n > 0 and "file_path" in parts.columns:
        parts = _newest_files(parts, n, order)
    last = parts.select(*columns, *order, row).orderBy(*[F.desc(c) for c in (*order, row)]).limit(max(n, 0))
    return last.orderBy(*order, row).select(*columns, file, row)


def tail_anchors(tail: DataFrame, length: int = K.ANCHOR_KEYS, file: str = "file_name", row: str = "row_index") -> DataFrame:
    """Last ``max(1, min(length, n))`` match keys of the newest source in the tail, numbered oldest first.

    The tail has a few hundred rows, so ordering it in one task is cheap.
    """
    text = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("text", "transcript") if c in tail.columns])
    language = F.col("language") if "language" in tail.columns else F.lit(None)
    keyed = tail.where(F.col("source") != "").select(
        "source", file, row, text.alias("_text"), match_key(text, "speaker", language).alias("key")
    )
    newest = keyed.where(F.col("_text").isNotNull()).agg(F.max_by("source", F.struct(file, row)).alias("source"))
    ours = keyed.join(F.broadcast(newest), "source").where(F.col("key").isNotNull())
    recent = Window.partitionBy("source").orderBy(F.desc(file), F.desc(row))
    kept = ours.withColumn("_back", F.row_number().over(recent)).where(F.col("_back") <= max(1, length))
    whole = Window.partitionBy("source")
    return kept.select(
        "source", "key", (F.max("_back").over(whole) - F.col("_back")).alias("step"),
        F.max("_back").over(whole).alias("steps"),
    )


def anchor_sequence_search(anchors: DataFrame, rows: DataFrame, has_key: Column | None = None, span: int = SPAN) -> DataFrame:
    """Raw index after the last place where the anchor keys occur one after another.

    ``rows`` is (source, raw_index, key) with a null key for rows the source adapter drops; ``has_key`` may give
    a cheaper test for that. A row that equals anchor ``step`` at position ``p`` votes for a match that began at
    ``p - step``; a start with a vote from every step is a match. One narrow pass counts rows by span and says which
    spans hold an anchor key: every row of a match lies in one of these. Only they are numbered, from the counts of all,
    so other spans are neither shuffled nor, where raw indices prune them, read again. One row per anchored source comes
    back, with a null index when nothing matched.
    """
    present = F.col("key").isNotNull() if has_key is None else has_key
    # The anchors are a handful of rows by construction: found once, then broadcast.
    anchors = measured(anchors)
    steps = anchors.groupBy("source", "key").agg(F.collect_list("step").alias("_at_step"))
    sources = F.broadcast(anchors.select("source").distinct())
    named = rows.where(present).join(sources, "source", "left_semi")
    tagged = named.join(F.broadcast(steps), ["source", "key"], "left").select("source", "raw_index", "_at_step")
    at_span = F.coalesce(span_of("raw_index", span), F.lit(LAST_SPAN))
    counts = tagged.groupBy("source", at_span.alias("_span")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.col("_at_step").isNotNull()).alias("_hit")
    )
    before = Window.partitionBy("source").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = measured(counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).where("_hit").drop("_hit"))
    low, high = spans.agg(F.min("_span"), F.max("_span")).first()
    if low is not None and high < LAST_SPAN:
        tagged = tagged.where(F.col("raw_index").between(low * span - span + 1, high * span + span - 1))
    placed = dense_position(tagged, ["source"], ["raw_index"], span_of("raw_index", span), "_at", offsets=spans)
    votes = placed.select("source", "raw_index", "_at", F.explode("_at_step").alias("_step"))
    total = anchors.select("source", "steps").distinct()
    matches = (
        votes.groupBy("source", (F.col("_at") - F.col("_step")).alias("_start"))
        .agg(F.count(F.lit(1)).alias("_votes"), F.max("raw_index").alias("_last"))
        .join(F.broadcast(total), "source")
        .where(F.col("_votes") == F.col("steps"))
    )
    found = matches.groupBy("source").agg((F.max("_last") + 1).alias("resume_raw_index"))
    return total.select("source").join(found, "source", "left")


def reconcile_state(
    outputs: DataFrame, valid: DataFrame | None = None, mode: Column | str = "mode", state: Column | str = "state_json",
    rows: Column | str = "rows_on_disk",
) -> DataFrame:
    """Start index and usable cursor of each output from its stored state and the rows found on disk.

    Rows on disk win over the state. A directory keeps the larger of both indices when they disagree; a single
    file falls back to its row count. ``valid`` lists the configured (name, split) pairs.
    """
    rows = F.coalesce(_col(rows), F.lit(0))
    parsed = F.from_json(_col(state), STATE_JSON)
    df = outputs.withColumns({"_s": parsed, "_rows": rows, "_dir": _col(mode) == "dataset"})
    cursor = F.coalesce(F.col("_s")["cursor"], F.col("_s")["dataset_cursor"])
    usable = (F.coalesce(cursor["name"], F.lit("")) != "") & cursor["split"].isNotNull()
    has_state = F.col("_s").isNotNull() & _col(state).isNotNull()
    written = F.coalesce(F.col("_s")["rows_written"], F.col("_rows"))
    following = F.coalesce(F.col("_s")["next_index"], F.col("_rows"))
    agree = written == F.col("_rows")
    live = has_state & (F.col("_rows") > 0)
    index = F.when(live & (F.col("_dir") | agree), F.greatest(following, F.col("_rows"))).otherwise(F.col("_rows"))
    keep = has_state & usable & F.when(live, agree).otherwise(~F.col("_dir"))
    out = df.withColumns(
        {
            "resume_from": index,
            "cursor_name": F.when(keep, cursor["name"]),
            "cursor_split": F.when(keep, cursor["split"]),
            "cursor_raw_index": F.when(keep, F.coalesce(cursor["raw_index"], F.lit(0))),
        }
    ).drop("_s", "_rows", "_dir")
    if valid is None:
        return out
    pairs = valid.select(F.col("name").alias("cursor_name"), F.col("split").alias("cursor_split")).distinct()
    out = out.join(pairs.withColumn("_valid", F.lit(True)), ["cursor_name", "cursor_split"], "left")
    known = F.col("_valid").isNotNull()
    return out.withColumns(
        {c: F.when(known, F.col(c)) for c in ("cursor_name", "cursor_split", "cursor_raw_index")}
    ).drop("_valid")


def fetch_plan(rows: DataFrame, inventory: DataFrame, retries: int = 3, backoff: float = 1.0) -> DataFrame:
    """Files still to fetch: target name and the delay before every retry.

    ``inventory`` is (name, size); only a non-empty file counts as fetched. ``rows`` has index, url.
    """
    from ..functions.text import fetch_name

    attempts = max(1, retries)
    waits = [max(0.0, backoff) * 2 ** (i - 1) for i in range(1, attempts)]
    have = inventory.where(F.col("size") > 0).select("name").distinct()
    named = rows.where(F.coalesce(F.col("url") != "", F.lit(False))).withColumn("name", fetch_name("url", "index"))
    delays = F.array(*[F.lit(w) for w in waits]).cast("array<double>")
    return named.join(have, "name", "left_anti").withColumns({"attempts": F.lit(attempts), "delays": delays})
