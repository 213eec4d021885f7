"""Draws from segments that are longer than a lattice that is kept."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import pieces, queries

MODEL = queries.tokenizer_file("piece_bpe_32k.model")


def boundary_chances(table, text):
    """Chance of a piece boundary at each byte, by plain forward and backward sums."""
    ids = {s: table.log_p[i] for i, s in enumerate(table.surface) if np.isfinite(table.log_p[i])}
    n, longest = len(text), max(map(len, ids))
    ways = [(a, b, ids[text[a:b]]) for a in range(n) for b in range(a + 1, min(n, a + longest) + 1) if text[a:b] in ids]
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    for a, b, w in sorted(ways, key=lambda x: x[1]):
        forward[b] = np.logaddexp(forward[b], forward[a] + w)
    for a, b, w in sorted(ways, reverse=True):
        backward[a] = np.logaddexp(backward[a], backward[b] + w)
    return np.exp(forward + backward - forward[n])


@pytest.mark.parametrize("block", [65_536, 1_000])
def test_boundaries_in_a_long_segment(block, monkeypatch):
    monkeypatch.setattr(pieces, "_BLOCK", block)
    table = pieces.Pieces(MODEL, 3.0)
    text = " " + "understanding" * 85
    exact = boundary_chances(table, text.encode())
    n = 3_000
    seeds = pieces.words.mix(np.arange(n).astype(np.uint64))
    seen = Counter()
    for ids in pieces.Sampler(table)._long(np.frombuffer(text.encode(), np.uint8), seeds.tolist()):
        _, ends = table.joined(ids)
        assert ends[-1] == len(text)
        seen.update(ends.tolist())
    got = np.array([seen[i] / n for i in range(len(text) + 1)])
    assert np.all(np.abs(got - exact) < 5.5 * np.sqrt(exact * (1 - exact) / n) + 2e-3)


def test_pieces_cross_byte_1024(spark):
    table = pieces.Pieces(MODEL, 3.0)
    text = "understanding" * 85
    exact = boundary_chances(table, (" " + text).encode())
    assert exact[1_024] < 0.9
    n = 1_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    rows = pieces.encode(df, MODEL, temperature=3.0, lossless="lossless").select("pieces", "lossless").collect()
    assert all(r.lossless for r in rows)
    share = np.mean([1_024 in set(table.joined(np.array(r.pieces))[1].tolist()) for r in rows])
    assert abs(share - exact[1_024]) < 5 * (exact[1_024] * (1 - exact[1_024]) / n) ** 0.5


def test_long_and_short_segments_of_a_row(spark):
    texts = ["漢字の文章" * 300, "a " + "x" * 70_000 + " b\n" + "é🙂" * 900 + "\nend", "y" * 1_023, "y" * 1_024, "short", ""]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    first = {r.doc_id: (r.pieces, r.decoded, r.lossless) for r in pieces.decode(pieces.encode(df, MODEL, lossless="lossless"), MODEL).collect()}
    assert [first[i][1] for i in range(12)] == texts * 2 and all(x[2] for x in first.values())
    again = {r.doc_id: r.pieces for r in pieces.encode(df.repartition(5), MODEL).collect()}
    assert again == {i: x[0] for i, x in first.items()}
