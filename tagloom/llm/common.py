"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are the runs of anything but space, tab, newline, vertical tab, form feed and carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Odd multipliers of the multiply-and-add hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def crc_fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one only where it is unset and Spark runs in one process."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def bucket_count(docs: DataFrame, text: str = "text", chars_per_bucket: int = 16_000_000) -> int:
    """Buckets of about equal size for a packed exchange; follows the input so that one bucket fits a task."""
    total = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // chars_per_bucket + 1)


#: Workers live on from stage to stage. With the system's allocator, what Arrow and numpy have freed can be given back.
pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    """Return freed memory to the machine, so that an idle worker does not keep its peak."""
    with contextlib.suppress(OSError, AttributeError):  # other C libraries lack the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, and `size` bytes or one row: what Python makes of a piece bounds a worker's memory."""
    for b in batches:
        weight = _row_bytes(b)
        at = 0
        while at < b.num_rows:
            step = max(1, min(rows, int(np.searchsorted(weight, weight[at] + size, side="right")) - 1 - at))
            yield b.slice(at, step)
            at += step
        del b
        give_back()


def _row_bytes(b: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts and binaries before each row, from the offsets of the columns."""
    out = np.zeros(b.num_rows + 1, np.int64)
    for c in b.columns:
        wide = pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type)
        if (wide or pa.types.is_string(c.type) or pa.types.is_binary(c.type)) and b.num_rows:
            kind = np.int64 if wide else np.int32
            ends = np.frombuffer(c.buffers()[1], kind, b.num_rows + 1, c.offset * np.dtype(kind).itemsize)
            out += ends - ends[0]
    return out


def table_fn(f: Callable, **settings: object) -> Callable:
    """f with its settings bound, as the plain annotated function that applyInArrow asks for."""

    def apply(table: pa.Table) -> pa.Table:
        out = f(table, **settings)
        give_back()
        return out

    return apply


def packed_exchange(df: DataFrame, mapper: Callable, reducer: Callable, schema: str) -> DataFrame:
    """mapper turns Arrow batches into (bucket, payload) rows, reducer each bucket's payloads into rows of the schema.

    A payload holds the entries of many rows as numpy arrays, which costs a fraction of the bytes and
    time of a Spark row for each entry.
    """
    blocks = df.mapInArrow(mapper, "bucket int, payload binary")
    return blocks.groupBy("bucket").applyInArrow(reducer, schema)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob; unpack() needs their types again."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.uint32)
    return head.tobytes() + b"".join(a.tobytes() for a in arrays)


def unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    sizes, at, out = np.frombuffer(blob, np.uint32, n, 4), 4 * (n + 1), []
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.frombuffer(blob, kind, int(size), at))
        at += int(size) * np.dtype(kind).itemsize
    return out


def block_rows(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in pairs], pa.int32()), pa.array([p for _, p in pairs], pa.binary())], ["bucket", "payload"])


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(columns[0]), dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


#: Edges of a task of connected_components.
EDGES = 50_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (u, v), longs; a component's name is one of its nodes.

    Each round hooks every node to its smallest neighbour and contracts the edges. Nodes are hash values,
    so a round leaves a fixed share of the nodes on average, and stars are done in one round.
    Only aggregates and equi-joins run; no component is gathered anywhere.
    """
    maps = []
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = checkpointed(edges.where("u != v").select("u", "v"))
    while n := edges.count():
        parts = min(most, n // EDGES + 1)  # edges get fewer from round to round, and so do the tasks
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = checkpointed(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("to")).coalesce(parts))
        maps.append(hook)
        one, two = hook.select(F.col("node").alias("u"), F.col("to").alias("pu")), hook.select(F.col("node").alias("v"), F.col("to").alias("pv"))
        edges = checkpointed(edges.join(one, "u").join(two, "v").where("pu != pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct().coalesce(parts))
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = maps[0].select("node", F.col("to").alias("component"))
    for hook in maps[1:]:
        step = hook.select(F.col("node").alias("component"), "to")
        out = out.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return out
