"""Writers: directories of parts, JSON lines, size-bounded shards, ordered merges, schema locks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators.ordering import dense_position, whole
from ..session import measured
from . import parts, readers


class SchemaMismatch(ValueError):
    """A batch does not fit the schema of the table it should be appended to."""


def _shape(kind: T.DataType) -> object:
    """A type without nullability, which files do not keep."""
    if isinstance(kind, T.StructType):
        return tuple((f.name, _shape(f.dataType)) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return ("array", _shape(kind.elementType))
    if isinstance(kind, T.MapType):
        return ("map", _shape(kind.keyType), _shape(kind.valueType))
    return kind.simpleString()


def schema_lock(df: DataFrame, locked: T.StructType) -> DataFrame:
    """``df`` in the column order of the locked schema, or an error that names what does not fit."""
    have, want = dict(_shape(df.schema)), dict(_shape(locked))
    if have != want:
        differing = sorted(n for n in have.keys() | want.keys() if have.get(n) != want.get(n))
        raise SchemaMismatch(f"Schema mismatch in columns {differing}")
    return df.select(*locked.fieldNames())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds visible files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return False
    return any(not f.getPath().getName().startswith(("_", ".")) for f in system.listStatus(where))


def sink_parquet(df: DataFrame, path: str, overwrite: bool = False, append: bool = False, rows_per_file: int | None = None,
                 note: dict | None = None) -> None:
    """Write numbered parts; all of a write becomes visible at once, or none of it.

    A non-empty target is refused unless overwriting (old files go when the new ones are whole) or appending, which
    checks the schema of what is there and goes on after the last number, so the order of names is the order of writes.
    ``note`` is kept with the commit.
    """
    spark = df.sparkSession
    parts.recover(spark, path)
    there = exists(spark, path)
    if append and there:
        df = schema_lock(df, spark.read.parquet(path).schema)
    elif there and not overwrite:
        raise FileExistsError(f"{path} is not empty")
    parts.write_parts(df, path, there and not append, rows_per_file, note)


def sink_jsonl(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per line, non-ASCII text as it is, nulls written out."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", "false").json(path)


def row_bytes(df: DataFrame) -> Column:
    """Estimated size of a row: text and binary by length, fixed-width values by width, arrays by element."""
    def size(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
        if isinstance(kind, T.StructType):
            return sum((size(column[f.name], f.dataType) for f in kind.fields), F.lit(0).cast("long"))
        if isinstance(kind, T.ArrayType):
            inner = kind.elementType
            if isinstance(inner, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
                return F.coalesce(
                    F.aggregate(column, F.lit(0).cast("long"), lambda s, x: s + size(x, inner)), F.lit(0).cast("long")
                )
            return F.coalesce(F.size(column), F.lit(0)).cast("long") * 8
        return F.lit(8).cast("long")

    return sum((size(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))


def _placed(df: DataFrame, order: list[str], span: Column | None, block_rows: int, size: Column | None) -> DataFrame:
    """``df`` with ``_bytes``, ``position`` and ``_block``."""
    weighed = df.withColumn("_bytes", row_bytes(df) if size is None else size).withColumn("_all", F.lit(0))
    placed = dense_position(weighed, ["_all"], order, span, "position").drop("_all")
    return placed.withColumn("_block", whole("position", block_rows))


def _shard_list(placed: DataFrame, limit_bytes: float) -> DataFrame:
    """(_block, shard): blocks in order, a shard closes once its blocks reach the limit."""

    def close(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        shard, filled, shards = 0, 0, []
        for n in pdf["_bytes"]:
            shards.append(shard)
            filled += int(n)
            if filled >= limit_bytes:
                shard, filled = shard + 1, 0
        return pd.DataFrame({"_block": pdf["_block"], "shard": shards})

    blocks = placed.groupBy("_block").agg(F.sum("_bytes").alias("_bytes"))
    return blocks.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(close, "_block long, shard int")


def shard_plan(df: DataFrame, order: list[str], span: Column | None = None, limit_bytes: int = K.SHARD_BYTES,
               block_rows: int = K.SHARD_BLOCK_ROWS, size: Column | None = None) -> DataFrame:
    """``df`` with its ``shard`` number and ``position``.

    Rows are grouped into blocks; a shard closes once its blocks reach the limit. Only the list of blocks (one
    row per ``block_rows`` rows) is walked in order.
    """
    placed = _placed(df, order, span, block_rows, size)
    return placed.join(_shard_list(placed, limit_bytes), "_block").drop("_block")


def shard_name(split: str, shard: Column, total: Column) -> Column:
    return F.format_string(f"{split}-%05d-of-%05d.parquet", shard, total)


def shard_by_size(df: DataFrame, folder: str, split: str, order: list[str], span: Column | None = None,
                  limit_bytes: int = K.SHARD_BYTES, block_rows: int = K.SHARD_BLOCK_ROWS, size: Column | None = None,
                  stored: bool = False) -> list[str]:
    """Write ``{split}-{i:05d}-of-{n:05d}.parquet`` files in row order; no rows still give one empty shard.

    Rows are numbered and written once to a hidden folder; blocks, shards and the final files come from there, so the
    caller's plan runs once. With ``stored`` the limit is of bytes on disk: estimates are scaled by how the hidden
    folder's files came out, as their footers say.

    A folder that already has shards of the split is refused. Every shard is one file whatever the session says about
    rows in a file; a shard in several files, a rename that fails or a wrong number of rows is an error.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.globStatus(path(f"{folder}/{split}-*-of-*.parquet")):
        raise FileExistsError(f"{folder} has shards of {split}")
    staged, numbered = f"{folder}/_staged_{split}", f"{folder}/_numbered_{split}"
    placed = _placed(df, order, span, block_rows, size)
    placed.write.mode("overwrite").parquet(numbered)
    placed = spark.read.schema(placed.schema).parquet(numbered)
    expected, estimate = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    if stored and estimate:
        written = parts.footers(spark, numbered, None).agg(F.sum("bytes")).first()[0] or 0
        limit_bytes = limit_bytes * estimate / max(1, written) if written else limit_bytes
    shards = measured(_shard_list(placed, limit_bytes))
    total = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    rows = placed.join(shards, "_block").repartitionById(total, F.col("shard")).sortWithinPartitions("shard", "position")
    rows = rows.select(*df.columns, "shard")
    rows.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("shard").parquet(staged)
    names = [f"{split}-{i:05d}-of-{total:05d}.parquet" for i in range(total)]
    for i, name in enumerate(names):
        made = system.globStatus(path(f"{staged}/shard={i}/part-*"))
        if not made:  # only an empty table has a shard without files
            df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{staged}/shard={i}")
            made = system.globStatus(path(f"{staged}/shard={i}/part-*"))
        if len(made) != 1:
            raise ValueError(f"shard {i} has {len(made)} files")
        if not system.rename(made[0].getPath(), path(f"{folder}/{name}")):
            raise OSError(f"cannot move shard {i} to {folder}/{name}")
    system.delete(path(staged), True)
    system.delete(path(numbered), True)
    written = spark.read.parquet(*[f"{folder}/{name}" for name in names]).count()
    if written != expected:
        raise ValueError(f"wrote {written} of {expected} rows")
    return [f"{folder}/{name}" for name in names]


def merge_shards(source: DataFrame | str, folder: str, rows_per_file: int = 10_000_000, bytes_per_file: int = 1 << 30) -> int:
    """Concatenate parts in (file, row) order into the numbered parts of an empty folder and return the row count.

    ``source`` is a folder of numbered parts, whose row groups are copied run by run without a shuffle of rows, or a frame
    of ``scan_parquet_parts`` that may have been filtered. That one becomes as many range-partitioned files as its bytes
    (estimated by ``row_bytes``) or rows ask for, so no task holds more than about one file.
    """
    if isinstance(source, str):
        spark = SparkSession.getActiveSession()
        if parts.openable(source):
            return parts.concat_parts(spark, source, folder, rows_per_file, bytes_per_file)
        source = readers.scan_parquet_parts(spark, source)
    spark = source.sparkSession
    if exists(spark, folder):
        raise FileExistsError(f"{folder} is not empty")
    expected, size = source.agg(F.count(F.lit(1)), F.sum(row_bytes(source))).first()
    files = max(1, -(-expected // rows_per_file), -(-(size or 0) // bytes_per_file))
    keys = [c for c in ("part", "file_name", "row_index") if c in source.columns]
    rows = source.repartitionByRange(files, *keys)
    columns = [c for c in source.columns if c not in (*keys, "file_path")]
    parts.write_parts(rows.sortWithinPartitions(*keys).select(*columns), folder)
    written = spark.read.parquet(folder).count()
    if written != expected:
        raise ValueError(f"merged {written} of {expected} rows")
    return written
