"""Periodic runs against the definition, and the registered query against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import periods, queries

SF = "/root/testdata/sf0.001"


def plain_runs(ws, least=12):
    """Every (start, end, smallest period) by trying all lags."""
    found = {}
    n = len(ws)
    for lag in range(1, n):
        i = lag
        while i < n:
            if ws[i] != ws[i - lag]:
                i += 1
                continue
            j = i
            while j < n and ws[j] == ws[j - lag]:
                j += 1
            if j - i + lag >= max(least, 2 * lag):
                found.setdefault((i - lag, j), lag)  # lags ascend
            i = j + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    ws = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(ws)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = sorted((s, e - s, q) for s, e, q in plain_runs(ws))
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in runs), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return {
        "doc_id": doc_id,
        "n_runs": len(runs),
        "start": best and best[1],
        "length": best and -best[0],
        "period": best and best[2],
        "exponent_milli": best and 1000 * -best[0] // best[2],
        "runs_sha256": sha("".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(ws) if i not in gone)),
    }


def run_rows(rows, least=12):
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    values = np.array([v for r in rows for v in r], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)
    found = periods.find_runs(values, first, least)
    row = np.searchsorted(first, found.start, "right") - 1
    out = [[] for _ in rows]
    for r, s, e, q in zip(row, found.start - first[row], found.end - first[row], found.period):
        out[r].append((int(s), int(e), int(q)))
    return [sorted(x) for x in out]


def test_runs_are_those_of_the_definition():
    rng = random.Random(11)
    rows = []
    for _ in range(1500):
        letters, ws = rng.randint(1, 4), []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
            ws += (unit * rng.randint(1, 30))[: rng.randint(0, 120)]
        rows.append(ws)
    rows += [[], [1], [1] * 11, [1] * 12, [1] * 500, [1, 2] * 200 + [3] + [1, 2] * 200, list(range(300)) * 3]
    for least in (12, 5, 13):
        assert run_rows(rows, least) == [sorted(plain_runs(r, least)) for r in rows]


def test_runs_in_small_blocks(monkeypatch):
    monkeypatch.setattr(periods, "_PAIRS", 7)
    rng = random.Random(3)
    rows = [[rng.randrange(2) for _ in range(60)] * 3 + [rng.randrange(3) for _ in range(50)] for _ in range(40)]
    assert run_rows(rows) == [sorted(plain_runs(r)) for r in rows]


def test_a_very_long_run_costs_no_pairs():
    """A million equal words, and a long list of nearly equal stretches."""
    ones = [1] * 1_000_000
    broken = ([0] * 199 + [1, 0, 0, 2]) * 700
    assert run_rows([ones])[0] == [(0, 1_000_000, 1)]
    assert (0, len(broken), 203) in run_rows([broken])[0]


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", "a"), (None, "x " * 40, "a"), (4, "ü é " * 30 + "z", "a"), (4, "ü é " * 30 + "z", "a"),
        (5, " ".join(["lorem ipsum dolor"] * 3 + ["x"] * 13), None), (20, "b a " * 9, "q"), (9, "w" * 5000 + " k" * 50, "q"),
    ]
    rows += [(i, " ".join(random.Random(i).choice("abc") for _ in range(80)), "") for i in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumns({"key": F.lit(1), "given": F.lit(2), "collapsed": F.lit(3)})
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    got = queries.run_digests(periods.periodic_runs(df.repartition(3), repeat=F.when(h % 10 == 0, F.floor(h / 10)))).collect()
    order = lambda r: repr(sorted((k, str(v)) for k, v in r.items()))
    assert sorted((r.asDict() for r in got), key=order) == sorted((plain_row(d, t) for d, t, _ in rows), key=order)
    assert not periods.periodic_runs(df.limit(0)).collect()


def test_query_is_the_definition(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    small = {d for d, t in texts.items() if len(t or "") < 6000}  # the plain version is slow
    got = {r.doc_id: r.asDict() for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert got.keys() == texts.keys() and any(r["n_runs"] for r in got.values())
    for d in small:
        assert got[d] == plain_row(d, texts[d])
