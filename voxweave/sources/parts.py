"""Folders of numbered parts: commits that show all of a write or nothing, row groups from footers, tails, concatenation.

A write goes to a hidden folder first. Its files then get the numbers after the last part, in the order of the tasks
that wrote them, so the order of part numbers is the order of writes. What is to be moved is put in a journal in one
step, and that is the commit: a write that dies before it leaves nothing visible, and one that dies after it is carried
to its end by the next reader or writer (``recover``). Each finished commit stays as a small file with its parts, their
row counts and a note of the caller. One writer at a time is expected.

Positions come from Parquet footers, read where tasks run, so neither a row's position nor a folder's tail needs a scan.
Stores that only Spark's own readers can open are counted by a scan without columns instead.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Fixed value: names of numbered parts; the engine's own suffix after the number is accepted too.
PART_NAME = r"^part-(\d+)(?:-[^/]*)?\.parquet$"
COMMITS = "_commits"
JOURNAL = "pending"
CLEARED = "pending-cleared"
ORDER = ["folder", "part", "file_name"]
_WRITTEN = re.compile(r"^part-(\d+)-.*?(?:-?c(\d+))?\.[a-z0-9.]*parquet$")
_FINISHED = r"\d{8,}\.json"
BATCH_ROWS = 10_000


class _Store:
    """The file system of one folder, as Spark sees it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self._path = folder.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self.system = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, inside: str = "") -> list[str]:
        if not self.system.exists(self.at(inside)):
            return []
        return sorted(f.getPath().getName() for f in self.system.listStatus(self.at(inside)))

    def move(self, source: str, target: str) -> None:
        """Nothing happens if an earlier attempt has moved it."""
        if self.system.exists(self.at(target)) and not self.system.exists(self.at(source)):
            return
        if not self.system.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot move {source} to {target} in {self.folder}")

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)

    def put(self, name: str, body: dict) -> None:
        """A file that is there whole or not at all."""
        hidden = f"{COMMITS}/.{uuid.uuid4().hex}"
        out = self.system.create(self.at(hidden), False)
        try:
            out.write(bytearray(json.dumps(body).encode()))
        finally:
            out.close()
        self.move(hidden, name)

    def get(self, name: str) -> dict | None:
        if not self.system.exists(self.at(name)):
            return None
        stream = self.system.open(self.at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


def _visible(names: Iterable[str]) -> list[str]:
    return [n for n in names if not n.startswith(("_", "."))]


def recover(spark: SparkSession, folder: str) -> None:
    """Carry a commit that was broken off to its end; without one, nothing happens."""
    store = _Store(spark, folder)
    journal = store.get(f"{COMMITS}/{JOURNAL}")
    if journal is None:
        return
    if journal["old"] and not store.system.exists(store.at(f"{COMMITS}/{CLEARED}")):
        for name in journal["old"]:
            store.delete(name)
        store.put(f"{COMMITS}/{CLEARED}", {})
    for source, name, _ in journal["moves"]:
        store.move(f"{journal['staged']}/{source}", name)
    store.delete(f"{COMMITS}/{CLEARED}")
    store.move(f"{COMMITS}/{JOURNAL}", f"{COMMITS}/{journal['number']:08d}.json")
    store.delete(journal["staged"])


def commits(spark: SparkSession, folder: str) -> list[dict]:
    """Finished commits, oldest first: ``parts`` as (name, rows) pairs and the caller's ``note``."""
    store = _Store(spark, folder)
    finished = [n for n in store.names(COMMITS) if re.fullmatch(_FINISHED, n)]
    found = [store.get(f"{COMMITS}/{n}") for n in sorted(finished, key=lambda n: int(n[:-5]))]
    return [{"parts": [(name, rows) for _, name, rows in c["moves"]], "note": c["note"]} for c in found]


def _part_number(name: str) -> int:
    found = re.match(PART_NAME, name)
    return int(found[1]) if found else -1


def stage(df: DataFrame, folder: str, rows_per_file: int | None = None) -> str:
    """Write ``df`` to a hidden folder inside ``folder`` and return its name."""
    staged = f"_staged-{uuid.uuid4().hex}"
    writer = df.write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(f"{folder.rstrip('/')}/{staged}")
    return staged


def commit(spark: SparkSession, folder: str, staged: str, schema: T.StructType, replace: bool = False, note: dict | None = None) -> list[str]:
    """Number the files of a staged write after the last part and show them all; with ``replace`` all else goes.

    Files without rows are left out, unless the folder would stay without a file. Returns the new names.
    """
    recover(spark, folder)
    store = _Store(spark, folder)
    written = [n for n in _visible(store.names(staged)) if _WRITTEN.match(n)]
    written.sort(key=lambda n: tuple(int(x or 0) for x in _WRITTEN.match(n).groups()))
    counted = spark.read.schema(schema).parquet(f"{store.folder}/{staged}") if written else None
    rows = dict(counted.groupBy(F.col("_metadata")["file_name"].alias("n")).count().collect()) if written else {}
    old = _visible(store.names())
    kept = [n for n in written if rows.get(n)] or ([] if old and not replace else written[:1])
    first = 0 if replace else 1 + max(map(_part_number, old), default=-1)
    moves = [(n, f"part-{first + k:05d}.parquet", rows.get(n, 0)) for k, n in enumerate(kept)]
    finished = [n for n in store.names(COMMITS) if re.fullmatch(_FINISHED, n)]
    number = 1 + int(max(finished, key=lambda n: int(n[:-5]))[:-5]) if finished else 0
    gone = [*old, *[f"{COMMITS}/{n}" for n in finished]] if replace else []
    store.put(f"{COMMITS}/{JOURNAL}", {"staged": staged, "old": gone, "moves": moves, "number": number, "note": note or {}})
    recover(spark, folder)
    for name in store.names():  # of writes that died before their commit
        if name.startswith("_staged-"):
            store.delete(name)
    return [name for _, name, _ in moves]


def write_parts(df: DataFrame, folder: str, replace: bool = False, rows_per_file: int | None = None, note: dict | None = None) -> list[str]:
    """Append ``df`` as numbered parts in the order of its partitions; all of them become visible or none."""
    recover(df.sparkSession, folder)
    return commit(df.sparkSession, folder, stage(df, folder, rows_per_file), df.schema, replace, note)


def openable(folder: str) -> bool:
    """Whether tasks can open files of this folder by themselves."""
    try:
        _system(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if re.match(r"^(file:)?/", path):
        return pyarrow.fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pyarrow.fs.FileSystem.from_uri(path)


def _files(spark: SparkSession, folder: str, pattern: str | None, recursive: bool) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", str(recursive).lower())
    meta = F.col("_metadata")
    files = files.load(folder).select("path", meta["file_path"].alias("file_path"), meta["file_name"].alias("file_name"))
    return _numbered(files, pattern)


def _numbered(files: DataFrame, pattern: str | None) -> DataFrame:
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    part = F.regexp_extract("file_name", pattern or PART_NAME, 1).try_cast("long")
    if pattern is not None:
        files = files.where(F.col("file_name").rlike(pattern))
    return files.withColumns({"folder": folder, "part": part})


def footers(spark: SparkSession, folder: str, pattern: str | None = PART_NAME, recursive: bool = False) -> DataFrame:
    """Row groups of all files: file columns, ``row_group``, ``n_rows``, ``first_row`` inside the file, and stored ``bytes``.

    Where tasks cannot open files, a file is one group with number -1 and 0 bytes.
    """
    columns = ["path", "file_path", "file_name", "folder", "part"]
    if not openable(folder):
        rows = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", str(recursive).lower()).parquet(folder)
        meta = F.col("_metadata")
        counted = rows.groupBy(meta["file_path"].alias("file_path"), meta["file_name"].alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
        zero = F.lit(0).cast("long")
        return _numbered(counted, pattern).select(
            F.col("file_path").alias("path"), *columns[1:], F.lit(-1).alias("row_group"), "n_rows", zero.alias("first_row"), zero.alias("bytes")
        )
    files = _files(spark, folder, pattern, recursive).select(*columns)
    more = T.StructType(list(files.schema.fields)).add("row_group", T.IntegerType()).add("n_rows", "long").add("first_row", "long").add("bytes", "long")
    return files.mapInArrow(_read_footers, more)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, group, count, first, size = [], [], [], [], []
        for k, path in enumerate(batch.column(0).to_pylist()):
            system, plain = _system(path)
            with system.open_input_file(plain) as file:
                meta = pq.ParquetFile(file).metadata
                before = 0
                for g in range(meta.num_row_groups):
                    own = meta.row_group(g)
                    at.append(k)
                    group.append(g)
                    count.append(own.num_rows)
                    first.append(before)
                    size.append(sum(own.column(c).total_compressed_size for c in range(own.num_columns)))
                    before += own.num_rows
        more = [pa.array(group, pa.int32()), pa.array(count, pa.int64()), pa.array(first, pa.int64()), pa.array(size, pa.int64())]
        names = [*batch.schema.names, "row_group", "n_rows", "first_row", "bytes"]
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, *more], names=names)


def offsets(listed: DataFrame) -> DataFrame:
    """``listed`` row groups with ``before``: the rows ahead of them in (folder, part, file) order. Only the list is ordered."""
    ahead = Window.orderBy(*ORDER, "row_group").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("before", F.coalesce(F.sum("n_rows").over(ahead), F.lit(0)))


def last_row_groups(listed: DataFrame, n: int) -> DataFrame:
    """The last row groups that together hold ``n`` rows: a short list, since every group has a row at least."""
    newest = [F.desc(c) for c in (*ORDER, "row_group")]
    last = listed.where("n_rows > 0").orderBy(*newest).limit(max(n, 0))
    behind = Window.orderBy(*newest).rowsBetween(Window.unboundedPreceding, -1)
    return last.withColumn("behind", F.coalesce(F.sum("n_rows").over(behind), F.lit(0))).where(F.col("behind") < n)


def read_row_groups(groups: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the listed row groups, in the order of the list, with ``file_name`` and ``row_index``; other groups stay closed."""
    full = T.StructType(list(schema.fields)).add("file_name", "string").add("row_index", "long")
    groups = groups.select("path", "file_name", "row_group", "first_row")
    return groups.mapInArrow(_reader(schema), full)


def _reader(schema: T.StructType):
    target = to_arrow_schema(schema)

    def run(batches):
        opened, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if opened != row["path"]:
                    system, plain = _system(row["path"])
                    opened, file = row["path"], pq.ParquetFile(system.open_input_file(plain))
                held = [n for n in target.names if n in file.schema_arrow.names]
                place = row["first_row"]
                for part in file.iter_batches(BATCH_ROWS, row_groups=[row["row_group"]], columns=held):
                    own = pa.Table.from_batches([part])
                    columns = [
                        own.column(f.name).cast(f.type) if f.name in held else pa.nulls(part.num_rows, f.type) for f in target
                    ]
                    names = pa.array([row["file_name"]] * part.num_rows, pa.string())
                    index = pa.array(range(place, place + part.num_rows), pa.int64())
                    place += part.num_rows
                    whole = pa.table([*columns, names, index], names=[*target.names, "file_name", "row_index"])
                    yield from whole.combine_chunks().to_batches()

    return run


def tail_of_parts(spark: SparkSession, folder: str, n: int, wanted: list[str], schema: T.StructType | None = None,
                  pattern: str | None = PART_NAME, recursive: bool = False) -> DataFrame:
    """Last ``n`` rows of a folder, oldest first, with the wanted columns that exist, ``file_name`` and ``row_index``.

    Footers say which row groups hold them; no other is read.
    """
    recover(spark, folder)
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", str(recursive).lower())
    schema = schema or reader.parquet(folder).schema
    schema = T.StructType([f for f in schema.fields if f.name in wanted])
    last = last_row_groups(footers(spark, folder, pattern, recursive), n)
    if openable(folder):
        rows = read_row_groups(last.coalesce(1).sortWithinPartitions(*ORDER, "row_group"), schema)
        rows = rows.withColumn("_place", F.monotonically_increasing_id())
    else:
        names = [r[0] for r in last.select("file_path").distinct().collect()]  # n files at most
        rows = reader.schema(schema).parquet(folder)
        meta = F.col("_metadata")
        rows = rows.where(meta["file_path"].isin(names)).select(
            *schema.names, meta["file_name"].alias("file_name"), meta["row_index"].alias("row_index"), meta["file_path"].alias("file_path")
        )
        rows = _numbered(rows, None).withColumn("_place", F.struct(*ORDER, "row_index")).drop("file_path", "folder", "part")
    return rows.orderBy(F.desc("_place")).limit(max(n, 0)).orderBy("_place").drop("_place")


def concat_parts(spark: SparkSession, folder: str, target: str, rows_per_file: int, bytes_per_file: int,
                 pattern: str | None = PART_NAME, recursive: bool = False) -> int:
    """Concatenate the parts of a folder in order into the parts of an empty target; returns the row count.

    A task reads a run of whole row groups and writes one file of about the wanted size, so rows are never shuffled: only
    the list of row groups is. The target must not hold a file.
    """
    recover(spark, folder)
    if _visible(_Store(spark, target).names()):
        raise FileExistsError(f"{target} is not empty")
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", str(recursive).lower())
    schema = reader.parquet(folder).schema
    ahead = Window.orderBy(*ORDER, "row_group").rowsBetween(Window.unboundedPreceding, -1)
    listed = offsets(footers(spark, folder, pattern, recursive).where("n_rows > 0"))
    listed = listed.withColumn("weight", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)))
    size = F.greatest(F.floor(F.col("before") / rows_per_file), F.floor(F.col("weight") / bytes_per_file))
    listed = listed.withColumn("out", F.dense_rank().over(Window.orderBy(size)) - 1)
    expected, files = listed.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.max("out")).first()
    dealt = listed.repartitionById((files or 0) + 1, F.col("out")).sortWithinPartitions(*ORDER, "row_group")
    rows = read_row_groups(dealt, schema).drop("file_name", "row_index")
    write_parts(rows, target)
    written = sum(n for c in commits(spark, target) for _, n in c["parts"])
    if written != expected:
        raise ValueError(f"merged {written} of {expected} rows")
    return written
