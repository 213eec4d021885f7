import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.llm import queries
from marketloom.llm.repeats import repeated_spans

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, spans int, print int"


def brute(rows, length=35):
    """(doc_id, n_words, n_removed, kept) of every row."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[a : a + length]) for _, w in split for a in range(len(w) - length + 1))
    out = []
    for i, w in split:
        bad = [False] * len(w)
        for a in range(len(w) - length + 1):
            if seen[tuple(w[a : a + length])] > 1:
                bad[a : a + length] = [True] * length
        out.append((i, len(w), sum(bad), b" ".join(x for x, b in zip(w, bad) if not b).decode()))
    return sorted(out, key=repr)


def found(df, **kw):
    gone = F.aggregate("spans", F.lit(0), lambda n, x: n + x["end"] - x["start"])
    return sorted((tuple(r) for r in repeated_spans(df, **kw).select("doc_id", "n_words", gone, "kept").collect()), key=repr)


def test_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in brute(rows)}
    assert {tuple(r) for r in queries.QUERIES["op8_repeats"](spark, SF).collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_passages_with_edits_at_both_ends(spark, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 3)))
    passages = [[word() for _ in range(r.randint(20, 120))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            a = r.randint(0, 30)
            w += p[a : len(p) - r.randint(0, 30)] + [word() for _ in range(r.randint(0, 12))]
        rows.append((i, r.choice([" ", "\n", "\t\x0b "]).join(w), None, 1, 2))
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute([x[:2] for x in rows])


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None, None, 0, 0), (2, "", "x", 0, 0), (3, " \n ", "x", 0, 0), (None, long, "x", 0, 0), (4, "a " * 100, "x", 0, 0),
        (5, long, "x", 0, 0), (5, long, "x", 0, 0), (5, "other " + long, "y", 0, 0), (6, "b " * 35, None, 0, 0), (None, "c d", "x", 0, 0),
        (7, " ".join(f"v{i}" for i in range(34)), "x", 0, 0), (8, " ".join(f"v{i}" for i in range(34)), "x", 0, 0),
    ]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute([x[:2] for x in rows])
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_very_long_text(spark):
    text = " ".join(str(i * 7919 % 100_003) for i in range(700_000))
    rows = [(1, text, None, 0, 0), (2, text[1_000_000:1_002_000], None, 0, 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute([x[:2] for x in rows])
