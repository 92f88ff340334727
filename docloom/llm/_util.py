"""Shared pieces: the scratch folder, word hashing and connected components."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import delete, shared_folder


class Scratch:
    """Tables written to the shared folder to cut lineage.

    Unlike an executor-local checkpoint they survive the loss of an executor.
    ``drop`` removes a table once nothing lazy can still read it; the rest go
    when the driver process exits.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/docloom-{label}-{uuid.uuid4().hex}"
        self._count = 0
        atexit.register(self._clean)

    def path(self, name: str = "t") -> str:
        self._count += 1
        return f"{self.root}/{self._count:04d}-{name}"

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        return self.named(df, name)[0]

    def named(self, df: DataFrame, name: str = "t") -> tuple[DataFrame, str]:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        delete(self.spark, path)

    @contextmanager
    def held(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` as blocks on the executors' disks until the end of the ``with``; lost ones are computed again.

        For wide tables that are read again soon, where a file (and on local file
        systems a process or more) per task is not worth it.  Lineage is not cut:
        nothing lazy may outlive the ``with`` but through a table.
        """
        df = df.persist(StorageLevel.DISK_ONLY)
        try:
            df.count()  # two scans in one query would otherwise both compute it
            yield df
        finally:
            df.unpersist()

    def _clean(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # the session is gone at exit; there is nothing left to tell
            pass


#: ASCII letters and digits stay (lower case), all other ASCII becomes a space, and bytes of other characters stay.
_WORD_TABLE = bytes(
    (b if (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else b + 32 if 65 <= b <= 90 else 32) for b in range(256)
)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd multiplier and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)
        self.inverse = np.uint64(pow(int(_P), -1, 1 << 64))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _P)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.inverse)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-case words (runs of letters and digits) of a text, in order."""
    return prefix_hashes(text, ())[0]


def prefix_hashes(text: str, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of the words, then for each length (in bytes) of the words cut to it.

    A word no longer than the length hashes as the whole word does.
    """
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_WORD_TABLE)
    b = np.frombuffer(raw, np.uint8)
    none = [np.empty(0, np.uint64)] * (1 + len(lengths))
    if not len(b):
        return none
    inside = np.empty(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    np.not_equal(b, 32, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return none
    up, down = _powers.get(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    out = []
    for most in (None, *lengths):
        upto = ends if most is None else np.minimum(ends, starts + most)
        out.append(mix((total[upto] - total[starts]) * down[starts] + (upto - starts).astype(np.uint64)))
    return out


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of an Arrow column; null becomes the empty text."""
    return ["" if v is None else v for v in column.to_pylist()]


#: Rows that a Python worker turns into objects at a time.
PART = 256


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = PART) -> Iterator[pa.RecordBatch]:
    """All rows of the batches, a few at a time, so that a worker holds objects of a few texts only.

    Workers are kept between tasks; what Arrow has pooled for a task goes back at its end.
    """
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """Smallest reachable id per node: ``(id, component)`` for ids that occur in ``edges(u, v)``.

    Alternating large-star and small-star contraction.  Each step is a grouped
    minimum (partially aggregated before the shuffle) and an equi-join, so a
    node with very many links is never collected into one task, and the driver
    sees only two numbers per round.
    """
    edges = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, path = scratch.named(edges, "edges")
    before = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        # every neighbour larger than u, linked to the least of u's surroundings
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        # the smaller neighbours of u, and u itself, linked to the least of them
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        after, after_path = scratch.named(small.filter("u <> v").distinct(), "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(path)
        current, path = after, after_path
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    pairs = current.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return pairs.unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
