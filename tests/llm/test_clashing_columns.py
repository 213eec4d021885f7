"""Columns called like those that operators use inside, or like their results."""

import corpus_pipeline as P
from marketloom.llm import lines, near

SF = "/root/testdata/sf0.001"
NAMES = ["doc_id", "text", "__lines", "__KEY", "__print", "__rows", "__same", "__kept", "__covered", "c0", "n_lines", "n.removed"]


def clashing(spark):
    shared = "one\ntwo\nthree"
    rows = [(1, f"{shared}\nfour a b c d"), (2, f"{shared}\nfive e f g h"), (3, None), (4, ""), (5, "alone in here at last"), (6, "Alone in here at last"), (6, "Alone in here at last")]
    data = [(i, t, *[f"{n}-{i}" for n in NAMES[2:]]) for i, t in rows]
    return spark.createDataFrame(data, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in NAMES)).repartition(3)


def test_lines_keep_clashing_columns(spark):
    out = lines.without_repeated_lines(clashing(spark))
    assert out.columns == [n for n in NAMES if n != "n_lines"] + ["n_lines", "n_removed"]
    got = {r[0]: r for r in out.collect()}
    assert got[2].text == "five e f g h" and (got[2].n_lines, got[2].n_removed) == (4, 3) and got[1].n_removed == 0
    assert all(got[i][n] == f"{n}-{i}" for i in range(1, 7) for n in NAMES[2:] if n != "n_lines")
    named = lines.without_repeated_lines(clashing(spark), n_lines="total", n_removed="gone")
    assert named.columns == [*NAMES, "total", "gone"] and {r.n_lines for r in named.collect()} == {f"n_lines-{i}" for i in range(1, 7)}


def test_near_duplicates_keep_clashing_columns(spark):
    df = clashing(spark)
    out = near.keep_one(df)
    assert out.schema == df.schema
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in df.collect() if r.doc_id != 6} and out.count() == 5


def test_key_may_have_an_inside_name(spark):
    df = clashing(spark).select("doc_id", "text").toDF("__print", "__lines")
    out = lines.without_repeated_lines(df, "__print", "__lines")
    assert {r[0]: r[1] for r in out.collect()}[2] == "five e f g h"
    assert sorted(r[0] for r in near.keep_one(df, "__print", "__lines").collect()) == [1, 2, 3, 4, 5]


def test_stages_keep_clashing_columns(spark):
    df = clashing(spark)
    for name in ("lines", "near_duplicates", "benchmark"):
        out = dict(P.STAGES)[name](spark, df, SF)
        assert out.columns == NAMES and {r["n_lines"] for r in out.collect()} <= {f"n_lines-{i}" for i in range(1, 7)}
