"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import shelfline
from shelfline.session import scratch_dir


def find_code(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    Workers of a local session start in the working directory of the driver,
    which need not hold the library. On a cluster whose nodes have it elsewhere
    (``--py-files``, an installed package) the entry does no harm.
    """
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.abspath(shelfline.__path__[0]))
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder (``spark.checkpoint.dir``)."""
    find_code(spark)
    return f"{scratch_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor re-reads files instead of
    repeating the work, and gives the optimizer the true size of the result.
    """
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], base: str) -> str:
    """``base`` or ``base_1``, ... so that helper columns clash with no input column."""
    low = {c.lower() for c in taken}
    name, k = base, 0
    while name.lower() in low:
        k += 1
        name = f"{base}_{k}"
    return name


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def tidy(run):
    """Wraps a batch function: when its task ends, the worker gives the memory it used back to its executor."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return wrapped


def byte_slices(batches, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds at most about ``max_bytes`` in each.

    A single longer value forms a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = value_offsets(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def value_offsets(arr: pa.Array) -> np.ndarray:
    """n + 1 byte offsets of a string or binary array (nulls are empty)."""
    big = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    kind = np.int64 if big else np.int32
    if len(arr) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(arr.buffers()[1], kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)


def value_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a string or binary array as one byte array and n + 1 offsets from 0."""
    off = value_offsets(arr)
    data = arr.buffers()[2] if len(arr) else None
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


_BASE = 0x9E3779B97F4A7C15 | 1      # odd, so that it has an inverse modulo 2**64


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit words."""
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges of ``data``; equal ranges have equal hashes wherever they stand."""
    n = len(data)
    up = np.full(n + 1, _BASE, np.uint64)
    up[0] = 1
    up = np.cumprod(up, dtype=np.uint64)                          # powers of the base
    down = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    down = np.cumprod(down, dtype=np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


EDGES_A_TASK = 500_000


def star_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected graph ``edges(a, b)`` of longs.

    Alternating large-star and small-star steps: each round links every node
    to the least node it can see, so the rounds grow with the logarithm of the
    longest chain. Each round is grouped aggregation and one join on the node,
    written to the shared folder; nothing but a row count and a checksum
    reaches the driver. Returns ``(node, root)`` for every node of an edge
    (roots included). Self-loops and repeated edges do no harm; an empty input
    gives no rows.
    """
    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 f"{label}-edges")
    mark = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    for _ in range(max_rounds):
        if not mark[0]:
            break
        parts = 8 + mark[0] // EDGES_A_TASK          # few links need few tasks, however wide the shuffles are
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (both.join(least.coalesce(parts), both.a == least.n).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct().coalesce(parts))
        # small star: every neighbour below a node, and the node itself, point to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m").coalesce(parts)
        small = large.join(low, large.a == low.n).coalesce(parts)
        nxt = (small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
               .where("a <> b").distinct())
        cur = stored(nxt.coalesce(parts), f"{label}-round")
        seen = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
