"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voxweave.session import work_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step (Kiveris and others, 2014): neighbours of a node move to the smallest one among them and the node.

    The large step moves neighbours above the node, the small step the node and those below it.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _contract(batches):
    """Edges of a task as a forest of stars: every node and the smallest one that the task's edges join it to."""
    root: dict[int, int] = {}

    def find(node: int) -> int:
        while (up := root.setdefault(node, node)) != node:
            root[node] = root[up]
            node = root[node]
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = [n for n in root if find(n) != n]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], names=["a", "b"])


def _mark(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges in the shared folder, and a number that tells edge sets apart."""
    seen, path = Observation(), work_path(edges.sparkSession, "edges")
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("total")).write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["total"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that can be reached.

    Each round first joins what the edges of a single task connect, then makes one star step over all of them; it ends
    when the star step changes nothing.
    """
    while True:
        edges, before = _mark(edges.mapInArrow(_contract, "a long, b long").distinct())
        edges, after = _mark(_star(_star(edges, True), False))
        if before == after:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
