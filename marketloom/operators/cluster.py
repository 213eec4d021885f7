"""K-Means segments, nearest centres and single Lloyd steps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from marketloom.functions import vocabulary as V
from marketloom.operators import blocks
from marketloom.operators.features import zscore_apply, zscore_fit


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def assign_nearest(df: DataFrame, vector: str, centres: DataFrame, digits: int | None = None) -> DataFrame:
    """``df`` with the nearest ``segment`` and its squared ``distance``.

    ``centres`` has columns ``segment`` and ``centre``; its rows travel as one
    array with the tasks, so it must be the few centres of a clustering. A tie
    goes to the lowest segment; ``digits`` rounds distances before comparing.
    """
    listed = centres.agg(F.sort_array(F.collect_list(F.struct("segment", "centre"))).alias("centres")).scalar()

    def measured(c: Column) -> Column:
        d = squared_distance(F.col("_point"), c["centre"])
        return F.struct((F.round(d, digits) if digits is not None else d).alias("distance"), c["segment"].alias("segment"))

    point = F.transform(vector, lambda x: x.cast("double"))
    nearest = F.array_min(F.transform("_centres", measured))
    placed = df.withColumns({"_centres": listed, "_point": point}).withColumn("_nearest", nearest)
    return placed.select(*df.columns, F.col("_nearest.segment").alias("segment"), F.col("_nearest.distance").alias("distance"))


def lloyd_step(df: DataFrame, vector: str, centres: DataFrame, digits: int | None = None) -> DataFrame:
    """Next centres: the mean of the points of each segment, with their number.

    A segment nobody is nearest to keeps its centre. Points are averaged as
    vectors before the shuffle; each task sends one row per segment.
    """
    placed = assign_nearest(df, vector, centres, digits)
    point = array_to_vector(F.transform(vector, lambda x: x.cast("double")))
    means = placed.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(point)).alias("mean")
    )
    moved = centres.join(means, "segment", "left")
    return moved.select(
        "segment", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mean", "centre").alias("centre")
    )


def hash_uniform(*parts: Column | str | int) -> Column:
    """A number between 0 and 1 from the first 52 bits of the MD5 of the parts joined by ``|``."""
    text = F.concat_ws("|", *[x.cast("string") if isinstance(x, Column) else F.lit(str(x)) for x in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52


Centres = dict[int, list[list[float]]]


def _nearest(centres: Column, digits: int) -> Column:
    """(distance, segment) of the centre nearest to ``_z``; the lowest segment of equal ones."""
    return F.array_min(
        F.transform(centres, lambda c, i: F.struct(F.round(squared_distance(F.col("_z"), c), digits).alias("distance"), i.alias("segment")))
    )


def _places(batch: pa.RecordBatch) -> np.ndarray:
    """The ``_z`` of a batch, rows x columns."""
    return np.asarray(batch.column("_z").flatten(), np.float64).reshape(batch.num_rows, -1)


def _rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Half up, as SQL rounds numbers that are not negative; those too large to have such digits stay."""
    scale = 10.0**digits
    return np.where(x < 2.0**52 / scale, np.floor(x * scale + 0.5) / scale, x)


def _far(z: np.ndarray, centres: list[list[float]], digits: int) -> np.ndarray:
    """Rounded squared distances, rows x centres."""
    out = np.zeros((len(z), len(centres)))
    for i, c in enumerate(centres):
        for j, x in enumerate(c):
            out[:, i] += (z[:, j] - x) ** 2
    return _rounded(out, digits)


def _seeded(points: DataFrame, k: int, seeds: Sequence[int], digits: int) -> Centres:
    """First centres of every seed, each point drawn in proportion to its squared distance from those before.

    A draw is a race: every point has an exponential time, from a hash of
    seed, step and id, over its weight, and the first one wins. A task keeps
    one point a seed. Points on a centre win only if all are.
    """
    centres: Centres = {}
    for step in range(k):
        times = [-F.log(hash_uniform(s, step, F.col("_id"))) for s in seeds]
        if step:
            timed = points.withColumn("_times", F.array(*times))

            def far(batches: Iterator[pa.RecordBatch], centres=centres) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    flat = np.column_stack([_far(_places(batch), centres[s], digits).min(axis=1) for s in seeds]).ravel()
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(seeds)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_z", "_times")), lists], ["_id", "_z", "_times", "_far"])

            raced = timed.mapInArrow(far, "_id string, _z array<double>, _times array<double>, _far array<double>")
            race = lambda i: _race(F.col("_times")[i], F.col("_far")[i])
        else:
            raced = points
            race = lambda i: F.struct(F.lit(False).alias("on"), times[i].alias("time"), F.col("_id"))
        won = raced.agg(*[F.min_by("_z", race(i)) for i in range(len(seeds))]).first()
        if won[0] is None:
            break  # no rows
        centres = {s: [*centres.get(s, []), won[i]] for i, s in enumerate(seeds)}
    return centres


def _race(time: Column, distance: Column) -> Column:
    return F.struct((distance == 0).alias("on"), F.when(distance > 0, time / distance).otherwise(time).alias("time"), F.col("_id"))


def _moved(points: RDD[np.ndarray], centres: Centres, digits: int) -> Centres:
    """One Lloyd step for all seeds in one pass; a centre nobody is nearest to stays."""

    def add(z: np.ndarray) -> blocks.Sums:
        out = {}
        for seed, cs in centres.items():
            segment = _far(z, cs, digits).argmin(axis=1)
            out[seed] = np.array([np.bincount(segment, w, len(cs)) for w in (None, *z.T)])
        return out

    after = {s: list(cs) for s, cs in centres.items()}
    for seed, (n, *sums) in blocks.summed(points, add).items():
        for i in np.flatnonzero(n):
            after[seed][i] = [round(float(x[i] / n[i]), digits) for x in sums]
    return after


def _cheapest(points: RDD[np.ndarray], centres: Centres, digits: int) -> int:
    """The seed of least cost, the first one of equal ones."""
    cost = blocks.summed(points, lambda z: {s: _far(z, cs, digits).min(axis=1).sum() for s, cs in centres.items()})
    return min(cost, key=lambda s: (round(float(cost[s]), 6), s))


def kmeans_segments(
    df: DataFrame,
    columns: Sequence[str],
    k: int = V.SEGMENTS,
    seeds: Sequence[int] = tuple(range(V.SEED, V.SEED + V.SEGMENT_RESTARTS)),
    iterations: int = V.SEGMENT_ITERATIONS,
    key: str | None = None,
    digits: int = 9,
) -> DataFrame:
    """``df`` with ``segment`` by K-Means on standardised columns.

    Every seed starts from centres drawn in proportion to squared distances
    and goes through Lloyd steps until none changes, or ``iterations`` of
    them; all seeds share the passes. The clustering of least cost wins, the
    first one of equal ones. Draws depend on ``key`` (default: a hash of the
    whole row) and seed alone, and coordinates, distances and centres are
    rounded to ``digits``, so that the result does not depend on the order of
    sums. A missing value counts as its column's mean. The driver holds the
    centres. Runs a job a step.
    """
    # Standardise copies, so that the result keeps the raw columns.
    copies = [f"_z_{c}" for c in columns]
    wide = df.withColumns({z: F.col(c) for z, c in zip(copies, columns)})
    scaled = zscore_apply(wide, zscore_fit(wide, copies), copies)
    z = F.array(*[F.coalesce(F.round(F.nanvl(F.col(c), F.lit(0.0)), digits), F.lit(0.0)) for c in copies])
    ident = F.col(key) if key else F.xxhash64(*df.columns)
    ready = scaled.withColumns({"_id": ident.cast("string"), "_z": z})
    points = blocks.spread(ready.select("_id", "_z")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = _seeded(points, k, seeds, digits)
        if not centres:
            return df.withColumn("segment", F.lit(None).cast("int"))
        moving = centres
        with blocks.stored(points, _places) as kept:
            for _ in range(iterations):
                after = _moved(kept, moving, digits)
                moving = {s: cs for s, cs in after.items() if cs != moving[s]}
                centres = centres | after
                if not moving:
                    break
            best = _cheapest(kept, centres, digits)
    finally:
        points.unpersist()
    chosen = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres[best]])
    return ready.withColumn("segment", _nearest(chosen, digits)["segment"]).select(*df.columns, "segment")
