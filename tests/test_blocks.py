"""Sums over stored blocks, and passes that use all cores."""

import numpy as np

from marketloom.operators import blocks, cluster


def test_small_files_use_all_cores(spark):
    df = spark.range(9000).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert blocks.spread(df).rdd.getNumPartitions() == cores
    assert blocks.spread(df, 9000).rdd.getNumPartitions() == min(cores, 9)
    assert blocks.spread(df, 10).rdd.getNumPartitions() == 1
    assert blocks.spread(df.repartition(50), 2_000_000).rdd.getNumPartitions() == 40


def test_sums_of_many_partitions(spark):
    df = spark.range(1000)
    for parts in (1, 7, 40):  # the last one is added on executors
        with blocks.stored(df.repartition(parts), lambda b: np.asarray(b.column("id"))) as kept:
            got = blocks.summed(kept, lambda x: {0: np.array([len(x), x.sum()]), 1 + int(x[0] > 0): np.ones(2)})
        assert got[0].tolist() == [1000, 499500]


def test_kmeans_pass_for_all_seeds(spark):
    """One pass moves the centres of every seed; a centre nobody is nearest to stays, ties go to the first one."""
    points = [[0.0, 0.0], [1.0, 0.0], [9.0, 9.0], [9.0, 10.0]]
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(points)], "_id string, _z array<double>")
    centres = {1: [[0.0, 0.0], [9.0, 9.0]], 2: [[0.0, 0.0], [0.0, 0.0]], 3: [[4.5, 4.5], [99.0, 99.0]]}
    with blocks.stored(df.repartition(3), cluster._places) as kept:
        assert cluster._moved(kept, centres, 9) == {1: [[0.5, 0.0], [9.0, 9.5]], 2: [[4.75, 4.75], [0.0, 0.0]], 3: [[4.75, 4.75], [99.0, 99.0]]}
        assert cluster._cheapest(kept, {5: centres[2], 4: centres[1], 6: centres[1]}, 9) == 4
