"""Readers, writers and incremental jobs: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import ordering as O
from ..operators import reports as R
from ..operators import resume as E
from ..operators import synthesis as Y
from ..session import spread, work_path
from ..sources import parts as P
from ..sources import readers as D
from ..sources import writers as W
from ..streaming import incremental as T
from . import inputs as I
from .clip_queries import ENCODED, parity_encoder
from .registry import query

RAW_SCHEMA = "raw_index long, source string, transcription string, speaker string, language string, n_chars long"


def _ranges(rows, files, order="raw_index"):
    """Rows in order, a range for each file to write: ``files`` of them, or as many as the scan has parts if the rows are many."""
    files = max(files, min(rows.rdd.getNumPartitions(), rows.count() // 1000))
    return rows.repartitionByRange(files, order).sortWithinPartitions(order)


def _parts(spark, sf, name, files=4, rows=None, order="raw_index"):
    """A folder of ordered parts of the raw rows."""
    folder = work_path(spark, name)
    rows = I.raw_rows(spark, sf) if rows is None else rows
    W.sink_parquet(_ranges(rows, files, order), folder)
    return folder


@query(
    "scan_parquet_parts",
    f"WITH {I.RAW} SELECT raw_index, source, row_number() OVER (ORDER BY raw_index) - 1 AS global_row, true AS in_part FROM raw",
)
def scan_parquet_parts(spark, sf):
    """Two folders with the same part names, the second written in two appends; positions come from footers."""
    folder = work_path(spark, "parts")
    rows = I.raw_rows(spark, sf)
    middle = rows.count() // 2
    first, second = rows.where(F.col("raw_index") < middle), rows.where(F.col("raw_index") >= middle)
    early, late = second.where(F.col("raw_index") < middle + middle // 2), second.where(F.col("raw_index") >= middle + middle // 2)
    for where, some in (("a", first), ("b", early), ("b", late)):
        W.sink_parquet(_ranges(some, 3), f"{folder}/{where}", append=True)
    parts = D.scan_parquet_parts(spark, folder, recursive=True)
    placed = D.with_global_row(parts, listed=P.footers(spark, folder, recursive=True))
    return placed.select("raw_index", "source", "global_row", (F.col("part") >= 0).alias("in_part"))


@query("tail_rows", f"WITH {I.RAW} SELECT raw_index, source, speaker FROM raw ORDER BY raw_index DESC LIMIT 200")
def tail_rows(spark, sf):
    """The last rows after an append lie in its parts; only their row groups are read."""
    rows = I.raw_rows(spark, sf)
    cut = rows.count() - 100
    folder = _parts(spark, sf, "tail", rows=rows.where(F.col("raw_index") < cut))
    W.sink_parquet(_ranges(rows.where(F.col("raw_index") >= cut), 1), folder, append=True)
    wanted = ["raw_index", "source", "speaker", "transcript"]
    return P.tail_of_parts(spark, folder, K.TAIL_ROWS, wanted).drop("file_name", "row_index")


@query(
    "scan_jsonl_manifest",
    "SELECT doc_id || '.wav' AS audio, text, 'ref.wav' AS ref_audio, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'Auto' END AS language FROM documents",
)
def scan_jsonl_manifest(spark, sf):
    folder = work_path(spark, "manifest")
    d = F.col("doc_id")
    rows = I.table(spark, sf, "documents").select(
        F.concat(d.cast("string"), F.lit(".wav")).alias("audio"), "text", F.lit("ref.wav").alias("ref_audio"),
        F.when(d % 2 == 0, F.col("lang")).alias("language"),
    )
    W.sink_jsonl(rows, folder)
    return D.scan_jsonl_manifest(spark, folder)


@query("sink_jsonl", f"SELECT doc_id, text, CASE WHEN doc_id % 3 > 0 THEN {I.sql_rows(I.sql_codes())} END AS audio_codes FROM documents")
def sink_jsonl(spark, sf):
    folder = work_path(spark, "jsonl")
    rows = I.code_rows(spark, sf, extra=("text",)).select("doc_id", "text", F.when(F.col("doc_id") % 3 > 0, F.col("codes")).alias("audio_codes"))
    W.sink_jsonl(rows, folder)
    back = spark.read.schema(rows.schema).option("mode", "FAILFAST").json(folder)
    return back.withColumn("audio_codes", I.show_rows("audio_codes"))


@query("sink_parquet", f"WITH {I.CLEANED} SELECT raw_index, source, text, speaker, language, n_chars FROM kept")
def sink_parquet(spark, sf):
    folder = work_path(spark, "sink")
    rows = I.clean_rows(spark, sf)
    W.sink_parquet(rows.where(F.col("source") == "src_0"), folder)
    # Later sources are appended under the schema lock of what is there.
    W.sink_parquet(rows.where(F.col("source") != "src_0"), folder, append=True, rows_per_file=10_000_000)
    return spark.read.schema(rows.schema).parquet(folder)


@query(
    "schema_lock",
    f"WITH {I.CLEANED} SELECT raw_index, source, text, speaker, language, n_chars, 'n_chars' AS refused FROM kept",
)
def schema_lock(spark, sf):
    rows = I.clean_rows(spark, sf)
    locked = rows.schema
    try:
        W.schema_lock(rows.withColumn("n_chars", F.col("n_chars").cast("string")), locked)
        refused = ""
    except W.SchemaMismatch as error:
        refused = ",".join(n for n in locked.fieldNames() if f"'{n}'" in str(error))
    turned = rows.select(*reversed(rows.columns))
    return W.schema_lock(turned, locked).withColumn("refused", F.lit(refused))


SHARD_SQL = """WITH RECURSIVE p AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS pos,
 60 + octet_length(encode(l_returnflag)) + octet_length(encode(l_linestatus)) + l_linenumber AS bytes FROM lineitem),
 b AS (SELECT pos // 512 AS blk, CAST(sum(bytes) AS BIGINT) AS bytes FROM p GROUP BY 1),
 f AS (SELECT 0 AS blk, CAST(0 AS BIGINT) AS shard, (SELECT bytes FROM b WHERE blk = 0) AS filled
 UNION ALL SELECT b.blk, CASE WHEN f.filled >= 300000 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.filled >= 300000 THEN b.bytes ELSE f.filled + b.bytes END
 FROM f JOIN b ON b.blk = f.blk + 1)
 SELECT printf('train-%05d-of-%05d.parquet', f.shard, (SELECT max(shard) + 1 FROM f)) AS file_name, count(*) AS n_rows, CAST(sum(bytes) AS BIGINT) AS bytes,
 min(pos) AS first_position, max(pos) AS last_position FROM p JOIN f ON f.blk = p.pos // 512 GROUP BY f.shard"""


@query("shard_by_size", SHARD_SQL)
def shard_by_size(spark, sf):
    rows = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    size = (F.lit(60) + F.octet_length("l_returnflag") + F.octet_length("l_linestatus") + F.col("l_linenumber")).cast("long")
    keys = ["l_orderkey", "l_linenumber"]
    folder = work_path(spark, "shards")
    numbered = O.dense_position(rows.withColumn("_all", F.lit(0)), ["_all"], keys, O.span_of("l_orderkey", 1 << 14), "pos").drop("_all")
    W.shard_by_size(numbered, folder, "train", keys, O.span_of("l_orderkey", 1 << 14), 300000, 512, size)
    written = spark.read.parquet(folder).select("*", F.col("_metadata.file_name").alias("file_name"))
    return written.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("bytes"), F.min("pos").alias("first_position"), F.max("pos").alias("last_position")
    )


@query(
    "merge_shards",
    f"WITH {I.RAW} SELECT raw_index, source, transcription, row_number() OVER (ORDER BY raw_index) - 1 AS global_row, (SELECT count(*) FROM raw) AS total FROM raw",
)
def merge_shards(spark, sf):
    shards, folder = _parts(spark, sf, "shards", 6), work_path(spark, "merged")
    total = W.merge_shards(shards, folder, rows_per_file=400)
    merged = D.with_global_row(D.scan_parquet_parts(spark, folder))
    return merged.select("raw_index", "source", "transcription", "global_row", F.lit(total).cast("long").alias("total"))


@query(
    "rows_per_file",
    "SELECT doc_id % 5 AS bucket, count(*) AS n_rows FROM documents GROUP BY 1 UNION ALL SELECT 5, 0",
)
def rows_per_file(spark, sf):
    folder = work_path(spark, "counted")
    rows = I.table(spark, sf, "documents").select("doc_id", "lang", (F.col("doc_id") % 5).alias("bucket"))
    rows.repartition(5, "bucket").write.partitionBy("bucket").parquet(folder)
    parts = spark.read.parquet(folder).withColumnRenamed("bucket", "file_name")
    expected = spark.range(6).select(F.col("id").cast("int").alias("file_name"))
    return R.rows_per_file(parts, expected).select(F.col("file_name").cast("long").alias("bucket"), "n_rows")


@query(
    "profile_dataset",
    """WITH p AS (SELECT doc_id // 400 AS part, doc_id, text, lang, row_number() OVER (PARTITION BY doc_id // 400 ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY doc_id // 400) AS n_rows FROM documents)
 SELECT part, n_rows, 'doc_id' AS column_name, 'bigint' AS column_type, CAST(doc_id AS VARCHAR) AS first_value FROM p WHERE rn = 1
 UNION ALL SELECT part, n_rows, 'text', 'string', CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END FROM p WHERE rn = 1
 UNION ALL SELECT part, n_rows, 'lang', 'string', lang FROM p WHERE rn = 1""",
)
def profile_dataset(spark, sf):
    rows = I.table(spark, sf, "documents").select("doc_id", "text", "lang", F.floor(F.col("doc_id") / 400).alias("part"))
    out = R.profile_dataset(rows, ["doc_id", "text", "lang"], "part", "doc_id")
    return out


@query(
    "scan_binary_audio",
    """SELECT item_id, CASE WHEN item_id % 6 <> 0 THEN octet_length(encode(replace(text, chr(10), ' '))) END AS n_bytes,
 CASE WHEN item_id % 6 <> 0 THEN md5(replace(text, chr(10), ' ')) END AS digest FROM benchmark""",
)
def scan_binary_audio(spark, sf):
    # Every item goes into a file of its own, except every sixth one, whose file is missing.
    folder = work_path(spark, "clips")
    items = I.table(spark, sf, "benchmark").select("item_id", F.translate("text", "\n", " ").alias("value"))
    some = items.where(F.col("item_id") % 6 != 0).select(F.col("item_id").alias("id"), "value")
    some.repartition(8, "id").write.option("lineSep", "\u0001").partitionBy("id").text(folder)
    files = D.scan_binary_audio(spark, folder, "*.txt").select(
        F.regexp_extract("path", r"/id=(\d+)/", 1).alias("path"), "content"
    )
    rows = items.select("item_id", F.col("item_id").cast("string").alias("key"))
    out = D.join_audio_bytes(rows, files, "key")
    body = F.substring("bytes", 1, F.octet_length("bytes") - 1)
    return out.select("item_id", F.octet_length(body).cast("long").alias("n_bytes"), F.md5(body).alias("digest"))


# ---------------------------------------------------------------- incremental jobs


def _clean(rows):
    from ..functions import text as X

    return rows.where(X.has_dialog_text("transcription")).select(
        "raw_index", "source", X.clean_dialog_text("transcription").alias("text"), X.normalize_language("language").alias("language")
    )


def _in_two_runs(spark, sf, name, run, rows=None, order="raw_index"):
    """Feed a stream half of the rows, let it stop, add the other half, and start it again.

    Rows are written as they are scanned, so files grow in number and not in size; a run takes up to 1000 in one batch.
    """
    folder, checkpoint = work_path(spark, name + "-in"), work_path(spark, name + "-state")
    rows = I.raw_rows(spark, sf) if rows is None else rows
    half = rows.agg(F.floor(F.max(order) / 2)).first()[0] or 0
    for batch in (rows.where(F.col(order) <= half), rows.where(F.col(order) > half)):
        spread(batch).write.mode("append").parquet(folder)
        run(folder, rows.schema, checkpoint).awaitTermination()


@query("stream_prepare", f"WITH {I.CLEANED} SELECT raw_index, source, text, language FROM kept")
def stream_prepare(spark, sf):
    out = work_path(spark, "prepared")

    def run(folder, schema, checkpoint):
        return T.stream_prepare(T.new_rows(spark, folder, schema), _clean, out, checkpoint)

    _in_two_runs(spark, sf, "prepare", run)
    return spark.read.schema("raw_index long, source string, text string, language string").parquet(out)


@query("stream_exactly_once", f"WITH {I.CLEANED} SELECT source, count(*) AS n_rows, max(raw_index) + 1 AS next_raw_index FROM kept GROUP BY source")
def stream_exactly_once(spark, sf):
    out, progress = work_path(spark, "once"), work_path(spark, "once-progress")

    def run(folder, schema, checkpoint):
        return T.stream_exactly_once(T.new_rows(spark, folder, schema), _clean, out, checkpoint, progress)

    _in_two_runs(spark, sf, "once", run)
    done = spark.read.parquet(progress)
    return done.groupBy("source").agg(F.sum("n_rows").alias("n_rows"), F.max("next_raw_index").alias("next_raw_index"))


@query("stream_attach_codes", f"WITH {ENCODED} SELECT clip_id, {I.sql_rows('codes')} AS codes FROM e")
def stream_attach_codes(spark, sf):
    out = work_path(spark, "coded")

    def encode(rows):
        return Y.attach_codes(rows.select("clip_id", "samples"), parity_encoder)

    def run(folder, schema, checkpoint):
        return T.stream_attach_codes(T.new_rows(spark, folder, schema), encode, out, checkpoint)

    _in_two_runs(spark, sf, "attach", run, I.clips(spark, sf).select("clip_id", "samples"), "clip_id")
    rows = spark.read.schema("clip_id long, samples array<float>, audio_codes array<array<int>>").parquet(out)
    return rows.select("clip_id", I.show_rows("audio_codes").alias("codes"))


@query("stream_progress", f"WITH {I.RAW} SELECT source, count(*) AS n_rows FROM raw GROUP BY source")
def stream_progress(spark, sf):
    out = work_path(spark, "progress")

    def run(folder, schema, checkpoint):
        return T.stream_progress(T.new_rows(spark, folder, schema), out, checkpoint)

    _in_two_runs(spark, sf, "progress", run)
    return T.latest_report(spark, out)
