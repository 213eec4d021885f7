"""The quality classifier: statistics, kernel, normal equations, calibration, and held-out accuracy."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.llm import quality, queries, words

SF = "/root/testdata/sf0.01"


def measured(texts, limit=words.CHUNK_BYTES):
    return np.concatenate([quality.measure(c) for c in words.chunks(pa.array(texts, pa.string()), limit)])


def plain(text):
    raw = (text or "").encode()
    ws = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+", raw)]
    bare = [x.rstrip(b"\n") if x.endswith(b"\n") else x for x in lines]
    n = max(len(raw), 1)
    p = [raw.count(bytes([b])) / n for b in set(raw)]
    pairs = list(zip(ws, ws[1:]))
    sizes = [len(w) for w in ws]
    mean = sum(sizes) / max(len(ws), 1)
    spread = math.sqrt(max(0, sum(s * s for s in sizes) / max(len(ws), 1) - mean**2))
    return {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(ws)), "share_upper": len(re.findall(rb"[A-Z]", raw)) / n,
        "share_symbol": sum(raw.count(bytes([b])) for b in b"#$%&*+/=@\\^_`|~") / n, "share_other": sum(b >= 0x80 for b in raw) / n,
        "word_mean": mean / (1 + mean), "word_deviation": spread / (1 + spread), "log_word_longest": math.log1p(max(sizes, default=0)),
        "lone_letters": sum(s == 1 for s in sizes) / max(len(ws), 1),
        "distinct_words": len(set(ws)) / max(len(ws), 1), "repeated_pairs": 1 - len(set(pairs)) / len(pairs) if pairs else 0,
        "log_line_mean": math.log1p(len(raw) / max(len(lines), 1)), "repeated_lines": 1 - len(set(bare)) / len(lines) if lines else 0,
        "entropy": -sum(x * math.log(x) for x in p),
    }


TEXTS = [None, "", " ", "\n", "a", "a\n", "\n\n", "x y x y x y", "Ünï cödé $$$ ###", "one\ntwo\none\ntwo\n", "one\ntwo\none", "!" * 400, "a b\tc\rd e\x0bf\x0cg", "WORD " * 50, "z" * 9000]


def test_statistics_are_those_of_the_text_alone():
    got = measured(TEXTS)
    assert np.isfinite(got).all() and got.shape == (len(TEXTS), len(quality.STATISTICS))
    for row, text in zip(got, TEXTS):
        named = dict(zip(quality.STATISTICS, row))
        for k, v in plain(text).items():
            assert named[k] == pytest.approx(v, abs=1e-9), (k, text)
    assert (got[0] == 0).all() and (got[1] == 0).all()
    assert np.allclose(measured(TEXTS, 1), got) and np.allclose(measured(TEXTS[::-1])[::-1], got)


@given(st.lists(st.tuples(st.integers(1, 5), st.floats(0, 1)), min_size=1, max_size=12))
def test_isotonic_is_the_best_monotone_fit(rows):
    n = np.array([k for k, _ in rows], float)
    positive = np.array([round(k * p) for k, p in rows], float)
    knots, shares = quality.isotonic(np.arange(len(rows), dtype=float), n, positive)
    assert (np.diff(knots) > 0).all() and (np.diff(shares) > 0).all()
    # The monotone regression at i is the largest over starts of the smallest over ends of the mean.
    mean = lambda a, b: positive[a:b].sum() / n[a:b].sum()
    best = [max(min(mean(a, b) for b in range(i + 1, len(n) + 1)) for a in range(i + 1)) for i in range(len(n))]
    assert np.allclose(sorted(set(np.round(best, 9))), np.unique(np.round(shares, 9)))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    size = len(quality.STATISTICS)
    many = 20_000
    space = quality.Features(np.zeros(size), np.ones(size), rng.standard_normal((size, many)) / 3.0, rng.uniform(0, 2 * np.pi, many))
    x = rng.standard_normal((8, size))
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 18.0)
    f = space.of(x)[:, :-1]
    assert np.abs(f @ f.T - kernel).max() < 0.04


def test_weights_solve_the_normal_equations_in_any_partitioning(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.standard_normal(len(quality.STATISTICS)).tolist(), int(rng.random() < 0.5), i % 4) for i in range(300)]
    df = spark.createDataFrame(rows, "stats array<double>, label int, fold int")
    model = quality.fit(df.repartition(7), features=20, ridge=1e-2)
    x = model.features.of(np.array([r[0] for r in rows]))
    y = np.array([r[1] for r in rows], float)
    penalty = np.diag([1e-2 * 300] * 20 + [1e-9 * 300])
    assert np.allclose(model.weights, np.linalg.solve(x.T @ x + penalty, x.T @ y))
    assert np.allclose(quality.fit(df.coalesce(1), features=20, ridge=1e-2).weights, model.weights)


def test_odd_rows_labels_and_columns(spark):
    texts = TEXTS * 3
    docs = spark.createDataFrame([(i if i % 9 else None, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, score int")
    labels = spark.createDataFrame([(i, i % 2 if i % 5 else None) for i in range(60)] + [(1, 0), (None, 1), (2, 7)], "doc_id long, quality int")
    got = quality.classify(docs, labels, features=8).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    empty = {r.score for r in quality.classify(docs.filter("text is null or text = ''"), labels, features=8).collect()}
    assert len(empty) == 1
    assert {r.score for r in quality.classify(docs, labels.limit(0), features=8).collect()} == {0.5}
    assert {r.score for r in quality.classify(docs, labels.filter("quality = 1"), features=8).collect()} == {1.0}
    assert not quality.classify(docs.limit(0), labels, features=8).collect()


def test_held_out_accuracy_and_no_look_at_held_out_labels(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op12_quality(spark, SF)
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert got.count() == 1000 and len(held) > 50
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(str(tmp_path / "labels.parquet"))
    (tmp_path / "documents.parquet").symlink_to(f"{SF}/documents.parquet")
    again = {r.doc_id: r.score for r in queries.op12_quality(spark, str(tmp_path)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)
