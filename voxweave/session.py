"""Session helpers: shared work folder, lineage cuts, size checks."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most bytes a side may hold before the library stops shipping it to every task.
BROADCAST_BYTES = 256 << 20
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 4 << 20
CODEC = "spark.sql.parquet.compression.codec"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own under the temporary directory;
    on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-")
    return _local_folders[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, so a lost executor never replays the whole history."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession) + "/checkpoints")
    return df.checkpoint()


def fits_rows(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than ``rows + 1`` of them."""
    return df.limit(rows + 1).count() <= rows


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out evenly if it comes in fewer parts than the session has cores (one small file, say); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session end at ``ARROW_BYTES``, unless it has a limit of its own.

    Spark's own limit is 10,000 rows, whatever their size, and each running task holds a batch in the JVM and in Python.
    """
    if spark.conf.get(ARROW_LIMIT, None) is None:
        spark.conf.set(ARROW_LIMIT, str(ARROW_BYTES))


def compact_files(spark: SparkSession) -> None:
    """From now on this session compresses Parquet with zstd, unless it has a codec of its own.

    Padded text is long runs of one value. Spark's own codec, snappy, makes them about twenty times smaller, whatever their length.
    """
    if spark.conf.get(CODEC, None) is None:
        spark.conf.set(CODEC, "zstd")


def measured(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Run a summary once. Up to ``rows`` rows come back as a broadcast table; a longer one stays as it is."""
    got = df.limit(rows + 1).collect()
    if len(got) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(got, df.schema))


def _matches(keys: list[str], values: list[tuple]) -> Column:
    """Whether the key columns are one of ``values``, as literals that reach a scan."""
    if len(keys) == 1:
        return F.col(keys[0]).isin(*[v[0] for v in values])
    return reduce(or_, [reduce(and_, [F.col(k) == F.lit(x) for k, x in zip(keys, v)]) for v in values])


def heavy_keys(left: DataFrame, keys: list[str], share: int) -> list[tuple]:
    """Keys that hold more than one in ``share`` of the rows with a key; there are fewer than ``share`` of them.

    Keys are counted on the map side, so a key in half of all rows costs a row a task.
    """
    counts = left.select(*keys).dropna().groupBy(*keys).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [tuple(r[k] for k in keys) for r in counts.where(F.col("count") * share > total).collect()]


def join_heavy(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left", width: Column | None = None, salts: int = 64,
    limit_bytes: int = BROADCAST_BYTES, salt_by: str | None = None, share: int | None = None,
) -> DataFrame:
    """Equi-join of a side that few keys may dominate with one that is unique on ``on``.

    Rows with a null key match nothing and bypass the join. Keys with more than one in ``share`` of the rows (a quarter of
    a shuffle partition) are found first; their few rows of ``right`` are broadcast, or beyond ``limit_bytes`` repeated
    ``salts`` times, so no such key is ever one task's. All other rows are joined by hash.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spark = left.sparkSession
    share = share or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, keys, share)
    held = reduce(and_, [F.col(k).isNotNull() for k in keys])
    if not heavy:
        parts = [left.where(held).join(right, keys, how)]
    else:
        hot = _matches(keys, heavy)
        few, most = right.where(hot), left.where(held & hot)
        size = few.agg(F.sum((F.lit(256) if width is None else width).cast("long"))).first()[0] or 0
        if size <= limit_bytes:
            joined = most.join(F.broadcast(few), keys, how)
        else:
            spread_by = F.pmod(F.xxhash64(*([salt_by] if salt_by else left.columns)), F.lit(salts)).cast("int")
            repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            joined = most.withColumn("_salt", spread_by).join(repeated, [*keys, "_salt"], how).drop("_salt")
        parts = [joined, left.where(held & ~hot).join(right, keys, how)]
    if how == "left":
        own = [f for f in right.schema.fields if f.name not in keys]
        none = left.where(~held).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in own])
        parts.append(none)
    return reduce(DataFrame.unionByName, parts)


def join_small_or_salted(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left", bytes_column: str | None = None,
    salts: int = 64, limit_bytes: int = BROADCAST_BYTES, salt_by: str | None = None, row_bytes: int = 256, size: int | None = None,
) -> DataFrame:
    """Equi-join for a key that one value may dominate.

    ``right`` is unique on ``on``. Its size is measured first (unless the caller knows it); a small side is broadcast. A
    larger one is joined by ``join_heavy``, which takes frequent keys out and deals with them by themselves. Both ways
    give the same rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    width = F.coalesce(F.length(bytes_column), F.lit(0)) + 64 if bytes_column else F.lit(row_bytes)
    if size is None:
        size = right.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0
    if size <= limit_bytes:
        return left.join(F.broadcast(right), keys, how)
    return join_heavy(left, right, keys, how, width, salts, limit_bytes, salt_by)
