"""Top inner products with many queries, equal vectors and ties, against all products."""

import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import search


def test_more_queries_than_a_block_and_equal_vectors(spark):
    rng = np.random.default_rng(8)
    v = np.round(rng.standard_normal((2600, 8)) * rng.gamma(1.0, 2.0, (2600, 1)), 3)
    v[1500:2300] = v[1500]  # no bound tells these apart
    v[2300:2400] = 0.0
    ids = rng.permutation(5000)[:2600]
    df = spark.createDataFrame([(int(i), x.tolist(), 1) for i, x in zip(ids, v)], "vec_id long, embedding array<double>, score int").repartition(6)
    whole = np.floor(1024 * v).astype(np.int64)
    score = whole @ whole.T
    want = set()
    for q in np.flatnonzero(ids % 2 == 0):
        others = [c for c in range(len(ids)) if c != q]
        best = sorted(others, key=lambda c: (-score[q, c], ids[c]))[:10]
        want |= {(int(ids[q]), r, int(ids[c]), int(score[q, c])) for r, c in enumerate(best, 1)}
    got = [tuple(r) for r in search.top_inner_products(df, F.col("vec_id") % 2 == 0).collect()]
    assert len(got) == len(want) and set(got) == want


def test_a_scan_of_equal_vectors_holds_few_pairs():
    """Every pair reaches the floor; what is held at a time is a slice of them."""
    import tracemalloc

    v = np.full((4096, 64), 7.0)
    basis = np.eye(64)
    own = search.Vectors.of(np.arange(4096), v, basis, 16)
    best = search.Best(512, 10, np.full(512, -np.inf))
    tracemalloc.start()
    search.scan(best, v[:512], np.arange(512), own, basis)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    assert best.id.reshape(512, 10)[300].tolist() == list(range(10)) and best.id.reshape(512, 10)[3].tolist() == [0, 1, 2, *range(4, 11)]
