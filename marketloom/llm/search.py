"""Exact top-k inner products with norm order, rotated partial sums and residual bounds."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm import words
from marketloom.llm.tokens import local_path
from marketloom.session import materialise, scratch_path

SEEDS = 2_048  # longest vectors that give every query a first bound
QUERIES = 1_024  # in a block
TASK_BYTES = 32_000_000  # of vectors that a task holds
_STEP = 2_048  # candidates scored at a time
_SLICE = 256  # queries scored at a time
_FEW = 2_048  # pairs that are multiplied one by one rather than as matrices
_EXACT = 2.0**53


def _whole(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return np.asarray(batch.column("v").flatten(), dtype=np.float64).reshape(-1, dim)


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise inner products of whole numbers, as 64-bit integers (held to their range)."""
    if not len(q):
        return np.empty(0, np.int64)
    if _fits(q, v):
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(a, b)) for a, b in zip(q.tolist(), v.tolist())]
    return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in whole], np.int64)


def _fits(q: np.ndarray, v: np.ndarray) -> bool:
    """Whether all sums of products stay whole in doubles."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] < _EXACT


class Best:
    """The k best (score, smaller id first) of each query so far, and the score to reach."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.astype(np.float64)
        self.query, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.queries = queries

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, query))  # ~ turns the order round without overflow
        query, score, ids = query[order], score[order], ids[order]
        begin = np.searchsorted(query, np.arange(self.queries + 1))
        rank = np.arange(len(query)) - begin[query]
        top = rank < self.k
        last = rank == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        self.query, self.score, self.id = query[top], score[top], ids[top]


class Vectors(NamedTuple):
    """Candidates by descending length, with their rotation and the length of its part after the first axes."""

    ids: np.ndarray
    v: np.ndarray
    length: np.ndarray
    turned: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, v: np.ndarray, basis: np.ndarray, head: int) -> Vectors:
        length = np.sqrt(np.einsum("ij,ij->i", v, v))
        order = np.argsort(-length, kind="stable")
        turned = v[order] @ basis
        return cls(ids[order], v[order], length[order], turned[:, :head].copy(), np.sqrt(np.einsum("ij,ij->i", turned[:, head:], turned[:, head:])))


def scan(best: Best, q: np.ndarray, q_id: np.ndarray, candidates: Vectors, basis: np.ndarray) -> None:
    """Put all candidates that may reach a query's floor into ``best``.

    Vectors are taken by descending length. A step ends early for queries whose
    length times the step's longest vector stays below the floor; the others
    get the rotated sum over the first axes plus the Cauchy-Schwarz bound of
    the rest, and only what may reach the floor is scored exactly. Where most
    pairs of a slice may, they are scored as a product of matrices, of which
    each query's k best and their ties go on.
    """
    head = candidates.turned.shape[1]
    turned_q, q_length = q @ basis, np.sqrt(np.einsum("ij,ij->i", q, q))
    rest_q = np.sqrt(np.einsum("ij,ij->i", turned_q[:, head:], turned_q[:, head:]))
    turned_q = turned_q[:, :head]
    for at in range(0, len(candidates.ids), _STEP):
        longest = candidates.length[at]
        slack = 1.0 + 1e-9 * q_length * longest  # of rounding
        live = np.flatnonzero(q_length * longest + slack >= best.floor)
        if not len(live):
            return
        block, ids = candidates.v[at : at + _STEP], candidates.ids[at : at + _STEP]
        turned, rest = candidates.turned[at : at + _STEP], candidates.rest[at : at + _STEP]
        for k in range(0, len(live), _SLICE):
            own = live[k : k + _SLICE]
            bound = turned_q[own] @ turned.T + np.outer(rest_q[own], rest) + slack[own, None]
            good = (bound >= best.floor[own, None]) & (q_id[own, None] != ids[None, :])
            del bound
            n = np.count_nonzero(good)
            if n > _FEW and _fits(q[own], block):
                score = q[own] @ block.T
                if len(ids) > best.k:
                    high = np.partition(np.where(good, score, -np.inf), -best.k, axis=1)[:, -best.k]
                    good &= score >= high[:, None]
                i, j = np.nonzero(good)
                best.add(own[i], score[i, j].astype(np.int64), ids[j])
            elif n:
                i, j = np.nonzero(good)
                for p in range(0, len(i), _FEW):
                    a, b = i[p : p + _FEW], j[p : p + _FEW]
                    best.add(own[a], exact_products(q[own[a]], block[b]), ids[b])


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component, of the vectors that are wholly finite."""
    x = F.transform(F.col(vector), lambda e: e.cast("double"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    sound = df.select(F.col(key).cast("long").alias("id"), x.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    # Doubles from 2**52 on are whole already, and floor() would not hold them.
    down = lambda e: F.when(F.abs(e) < 2.0**52, F.floor(e).cast("double")).otherwise(e)
    scaled = sound.filter(~bad & (F.size("v") > 0)).select("id", F.transform("v", lambda e: down(e * float(scale))).alias("v"))
    return scaled.filter(~bad)  # what leaves the range of doubles is not finite either


def _basis(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes of the vectors by descending share of their squared length (their SVD), from summed outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            v = _whole(batch, dim)
            total += v.T @ v
        lists = pa.ListArray.from_arrays(pa.array(np.arange(dim + 1, dtype=np.int32) * dim), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), lists], ["axis", "part"])

    parts = vectors.select("v").mapInArrow(words.freed(run), "axis int, part array<double>")
    total = np.zeros((dim, dim))
    for axis, line in parts.groupBy("axis").agg(vector_to_array(Summarizer.sum(array_to_vector("part")))).collect():
        total[axis] = line
    if not np.isfinite(total).all():
        return np.eye(dim)
    values, axes = np.linalg.eigh(total)
    return axes[:, np.argsort(-values, kind="stable")]


class Block(NamedTuple):
    """A file of queries: vectors, ids, spots and floors one after another; ``need`` is the least length that can matter to any."""

    path: str
    rows: int
    need: float

    def read(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        raw, n = np.fromfile(self.path, np.float64), self.rows
        whole = raw[n * dim : n * (dim + 2)].view(np.int64)
        return raw[: n * dim].reshape(n, dim), whole[:n], whole[n:], raw[n * (dim + 2) :]


def _stored(queries: DataFrame, dim: int, k: int, folder: str, basis: np.ndarray, seeds: Vectors) -> list[Block]:
    """The queries in files of ``QUERIES`` rows, with their k-th best score among the seeds as floor; a row a file comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                part = batch.slice(at, QUERIES)
                q, ids, spots = _whole(part, dim), np.asarray(part.column("id")), np.asarray(part.column("spot"))
                best = Best(len(q), k, np.full(len(q), -np.inf))
                scan(best, q, ids, seeds, basis)
                length = np.sqrt(np.einsum("ij,ij->i", q, q))
                # Floors of 0 and below need no length.
                need = np.where(best.floor > 0, (best.floor - 1.0) / (np.maximum(length, 1e-300) * (1 + 1e-9)), 0.0)
                path = f"{folder}/{uuid.uuid4().hex}"
                with open(path, "wb") as f:
                    for x in (q, ids, spots, best.floor):
                        f.write(np.ascontiguousarray(x).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(q)]), pa.array([float(need.min())])], ["path", "rows", "need"])

    return [Block(*r) for r in queries.select("id", "spot", "v").mapInArrow(words.freed(run), "path string, rows long, need double").collect()]


def top_inner_products(
    df: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each asked row with all others.

    Components become floor(scale * x); the score is their exact integer
    product, held to 64 bits. Equal scores go to the smaller id. Vectors that
    are null, empty or hold null or non-finite components, and null ids, take
    no part; vectors are compared with those of the same number of components,
    which is one plan branch for each such number. Rows with the query's own
    id are no candidates; a repeated query row is answered for each time it
    occurs, a repeated candidate counts each time. Columns but ``key`` and
    ``vector`` are not read.

    Vectors are dealt by length into ranges of ``TASK_BYTES``, so a task holds
    vectors of like length and goes through the files of queries, of which it
    leaves out those that no vector of this length can matter to. Queries lie
    in files of the shared folder, which has to be mounted on all executors;
    their number changes neither scans nor plan. Runs jobs that write vectors
    and queries and return axes, seeds and a row for each file.
    """
    spark = df.sparkSession
    vectors = materialise(whole_vectors(df, key, vector, scale), "vectors")
    queries = whole_vectors(df.filter(asked), key, vector, scale)
    queries = materialise(queries.withColumn("spot", F.xxhash64("id", F.monotonically_increasing_id())), "queries")
    schema = "query_id long, spot long, vec_id long, score long"
    out = spark.createDataFrame([], schema)
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    for dim, n in sizes.join(queries.select(F.size("v").alias("dim")).distinct(), "dim").collect():
        same = vectors.filter(F.size("v") == dim)
        basis, head = _basis(same, dim), max(1, dim // 4)
        norm = F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)
        first = same.orderBy(norm.desc(), "id").limit(SEEDS).collect()
        seeds = Vectors.of(np.array([r.id for r in first]), np.array([r.v for r in first]), basis, head)
        folder = local_path(scratch_path(spark, "query-blocks"))
        os.makedirs(folder)
        blocks = spark.sparkContext.broadcast(_stored(queries.filter(F.size("v") == dim), dim, k, folder, basis, seeds))

        def run(batches: Iterator[pa.RecordBatch], blocks=blocks, basis=basis, dim=dim, head=head) -> Iterator[pa.RecordBatch]:
            held = [(np.asarray(b.column("id")), _whole(b, dim)) for b in batches if b.num_rows]
            if not held:
                return
            own = Vectors.of(*(np.concatenate(x) for x in zip(*held)), basis, head)
            del held
            for block in blocks.value:
                if block.need > own.length[0]:
                    continue
                q, q_id, spot, floor = block.read(dim)
                best = Best(len(q), k, floor)
                scan(best, q, q_id, own, basis)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_id[best.query]), pa.array(spot[best.query]), pa.array(best.id), pa.array(best.score)],
                    ["query_id", "spot", "vec_id", "score"],
                )

        parts = max(spark.sparkContext.defaultParallelism, -(-n * dim * 8 // TASK_BYTES))
        ranged = same.select("id", "v").repartitionByRange(parts, norm.desc(), F.xxhash64("id", F.monotonically_increasing_id()))
        out = out.unionByName(ranged.mapInArrow(words.freed(run), schema))
    order = Window.partitionBy("query_id", "spot").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
