"""Sums over rows kept as arrays: many passes over the same rows, a short job each."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

Block = TypeVar("Block")
Sums = dict[int, np.ndarray]

# From so many partitions on, their sums are added on executors first.
DIRECT = 32


def spread(df: DataFrame, rows: int | None = None, rows_per_task: int = 50_000, least: int = 1_000) -> DataFrame:
    """``df`` in as many partitions as there are cores at least; a small file is read by one task.

    With the number of ``rows``, in partitions of ``rows_per_task``, but in
    more, of ``least`` rows and up, if cores would else be idle.
    """
    cores, now = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if rows is None:
        return df if now >= cores else df.repartition(cores)
    wanted = max(1, -(-rows // rows_per_task), min(cores, -(-rows // least)))
    return df.coalesce(wanted) if now >= wanted else df.repartition(wanted)


@contextmanager
def stored(df: DataFrame, of: Callable[[pa.RecordBatch], Block]) -> Iterator[RDD[Block]]:
    """What ``of`` makes of each Arrow batch, kept for several passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(of(batch), pickle.HIGHEST_PROTOCOL)], pa.binary())], ["block"])

    kept = df.mapInArrow(run, "block binary").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _merged(a: Sums, b: Sums) -> Sums:
    return a | {k: a[k] + v if k in a else v for k, v in b.items()}


def summed(blocks: RDD[Block], add: Callable[[Block], Sums]) -> Sums:
    """The sums over all blocks of what ``add`` gives for one: vectors by number. Runs a job."""

    def run(part: Iterator[Block]) -> Iterator[Sums]:
        total: Sums = {}
        for block in part:
            total = _merged(total, add(block))
        yield total

    parts = blocks.mapPartitions(run)
    if parts.getNumPartitions() > DIRECT:
        return parts.treeReduce(_merged)
    out: Sums = {}
    for sums in parts.collect():
        out = _merged(out, sums)
    return out
