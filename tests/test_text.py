import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.functions import columns as C
from marketloom.functions import vocabulary as V
from marketloom.operators import features as FE
from marketloom.operators import text as T
from tests import fixtures as X


@pytest.fixture(scope="module")
def trials(spark):
    from marketloom import schemas

    return spark.createDataFrame(X.trial_rows(), schemas.FACT_TRIALS).repartition(4)


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t"))).first()[0]


def test_molecules(spark):
    label = lambda c: C.classify(c, V.MOLECULE_RULES, V.MOLECULE_DEFAULT)
    titles = ["SURPASS-1: Tirzepatide Study", "A Study of Semaglutide in Adults", "Randomized Trial of Experimental Drug"]
    assert [one(spark, label, t) for t in titles] == ["tirzepatide", "semaglutide", "other-glp1"]
    assert one(spark, label, "semaglutide versus TIRZEPATIDE") == "tirzepatide"
    assert one(spark, label, None) == "other-glp1"


@pytest.mark.parametrize(
    "text, hyphen, plain",
    [
        (None, [], []),
        ("", [], []),
        ("?!. -- 12", [], []),
        ("Double-blind step- UP", ["double-blind", "step-"], ["doubleblind", "step"]),
        ("one\ttwo\nthree four", ["one", "two", "three", "four"], ["onetwothree", "four"]),
        ("Ça été über-cool", ["ber-cool"], ["bercool"]),
    ],
)
def test_tokenisers(spark, text, hyphen, plain):
    assert one(spark, C.hyphen_tokens, text) == hyphen
    assert one(spark, C.plain_tokens, text) == plain


def test_max_digit(spark):
    assert [one(spark, C.max_digit, t) for t in ("Phase 2/3", "PHASE12", "none", None)] == [3, 2, 0, 0]


def test_keywords(spark, trials):
    found = T.top_keywords(trials, "indication", "molecule").collect()
    overall = {r.keyword: r["count"] for r in found if r.scope == "ALL"}
    assert {k: overall[k] for k in ("obesity", "diabetes", "surmount-", "surpass-")} == {"obesity": 6, "diabetes": 3, "surmount-": 3, "surpass-": 2}
    assert len(overall) == 13 and sum(overall.values()) == 23
    assert {r.scope for r in found} == {"ALL", "tirzepatide", "orforglipron", "semaglutide"}


def test_keyword_ties_and_missing_scope(spark):
    df = spark.createDataFrame([("bbb aaa ccc", None), ("aaa bbb ddd", "")], "t string, s string")
    got = [tuple(r) for r in T.top_keywords(df, "t", "s", k_all=3, k_scope=1).collect()]
    assert sorted(got) == [("ALL", "aaa", 2), ("ALL", "bbb", 2), ("ALL", "ccc", 1), ("other", "aaa", 2)]


def test_tfidf(spark, trials):
    vocab = T.tfidf_fit(trials, "title", max_features=10)
    got = [(r.term, r.df, round(r.idf, 6)) for r in vocab.orderBy("position").collect()]
    assert got == [
        ("obesity", 6, 0.356675), ("semaglutide", 5, 0.510826), ("tirzepatide", 5, 0.510826),
        ("diabetes", 4, 0.693147), ("type", 4, 0.693147), ("orforglipron", 2, 1.203973),
    ]
    scores = T.tfidf_transform(trials, ["nct_id"], "title", vocab).filter("nct_id = 'NCT03548987'")
    assert {r.term: round(r.tfidf, 6) for r in scores.collect()} == {"tirzepatide": 0.127706, "diabetes": 0.173287, "type": 0.173287}
    wide = T.tfidf_columns(trials.select("nct_id", "title"), "title", vocab, 8).filter("nct_id = 'NCT03548987'").first()
    assert [round(wide[f"tfidf_{i}"], 6) for i in range(8)] == [0, 0, 0.127706, 0.173287, 0.173287, 0, 0, 0]


def test_tfidf_counts_documents_without_terms(spark):
    df = spark.createDataFrame([("alpha alpha beta",), ("alpha",), ("",), (None,)], "t string")
    vocab = T.tfidf_fit(df, "t", min_df=2)
    assert [(r.term, r.df, round(r.idf, 6)) for r in vocab.collect()] == [("alpha", 2, round(math.log(4 / 3), 6))]
    assert sorted(round(r.tfidf, 6) for r in T.tfidf_transform(df, ["t"], "t", vocab).collect()) == [
        round(2 / 3 * math.log(4 / 3), 6), round(math.log(4 / 3), 6)
    ]


def test_complexity(spark, trials):
    rows = {r.nct_id: r for r in T.text_complexity(trials, "title", "design", "endpoint").collect()}
    assert [round(rows["NCT03548987"][c], 6) for c in T.COMPLEXITY_COLUMNS] == [81, 60, 58, 199, 1, 1, 199.0, 0.497512]
    assert [round(rows["NCT04283175"][c], 6) for c in T.COMPLEXITY_COLUMNS] == [71, 60, 50, 181, 1, 1, 181.0, 0.546448]


def test_empty_texts_give_zeros(spark):
    df = spark.createDataFrame([(None, "", None)], "a string, b string, c string")
    row = T.language_flags(T.text_complexity(df, "a", "b", "c"), "a").first()
    assert all(row[c] == 0 for c in (*T.COMPLEXITY_COLUMNS, *T.LANGUAGE_COLUMNS))


def test_language_flags(spark):
    text = "URGENT: severe, refractory, uncontrolled and comorbid; stable. All welcome worldwide"
    row = T.language_flags(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert [row[c] for c in T.LANGUAGE_COLUMNS] == [1, 1, 5, 1]


def test_trial_features(spark, trials):
    got = {r.nct_id: r for r in FE.trial_features(trials).collect()}
    assert len(got) == 10 and sum(r.label for r in got.values()) == 8
    first = got["NCT03548987"]
    assert (first.phase_depth, first.has_phase3, first.has_diabetes, first.has_obesity) == (3, 1, 1, 0)
    assert (round(first.log_enrollment, 6), round(first.log_duration_days, 6)) == (6.171701, 5.888878)
    assert round(got["NCT04039503"].log_duration_days, 6) == 6.150603
    assert (first.sponsor_lilly, first.sponsor_novo, first.design_double_blind, first.design_placebo_controlled) == (1, 0, 1, 1)
    assert got["NCT04283175"].endpoint_cv == 1 and got["NCT04283175"].has_cardio == 1
    assert not set(FE.trial_feature_names()) & set(V.LEAKING_NAMES)


def test_trial_features_fill_and_drop(spark, trials):
    odd = trials.limit(4).withColumn("start_year", F.lit(0)).withColumn("status", F.lit("Completed"))
    odd = odd.withColumn("phase", F.lit("PHASE3")).withColumn("nct_id", F.concat(F.lit("X"), "nct_id"))
    blank = trials.limit(1).withColumn("status", F.lit(" ")).withColumn("nct_id", F.lit("B"))
    mixed = trials.unionByName(odd).unionByName(blank)
    rows = FE.trial_features(mixed, with_text=False).filter("nct_id LIKE 'X%' OR nct_id = 'B'").collect()
    assert {r.start_year for r in rows} == {2020} and len(rows) == 4
    assert {r.has_phase3 for r in rows} == {0}
    assert {r.has_phase3 for r in FE.trial_features(mixed, with_text=False, normalize=True).filter("nct_id LIKE 'X%'").collect()} == {1}


def test_zscore(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (3.0, 4.0, 5.0), (5.0, 6.0, 5.0)], "a double, b double, c double")
    got = FE.zscore_apply(df, FE.zscore_fit(df, df.columns), df.columns).collect()
    for c in ("a", "b"):
        values = [r[c] for r in got]
        assert sum(values) == pytest.approx(0, abs=1e-9) and sum(v * v for v in values) / 3 == pytest.approx(1, abs=1e-9)
    assert [r.c for r in got] == [0.0, 0.0, 0.0]
    empty = df.limit(0)
    assert FE.zscore_apply(empty, FE.zscore_fit(empty, df.columns), df.columns).collect() == []


def test_term_counts_by_one_sort_equal_plain_counting(spark):
    """Terms that are prefixes of others, repeated words, empty and null texts, an empty table."""
    rng = random.Random(3)
    words = ["abc", "abcd", "abc0", "ab0", "abcabc", "000", "zzz", "the", "x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(80)] + [(80, ""), (81, None), (82, "abc"), (82, "abc")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(5)
    kept = [(i, [w for w in (t or "").split(" ") if len(w) > 2 and w != "the"]) for i, t in rows]
    found = Counter(w for _, ws in kept for w in set(ws))
    order = sorted(found, key=lambda w: (-found[w], w))
    for width in (1, 4, 50):
        vocab = T.tfidf_fit(df, "t", width, 2)
        assert [(r.term, r.df) for r in vocab.orderBy("position").collect()] == [(w, found[w]) for w in order[:width]]
        idf = {w: math.log(len(rows) / (1 + found[w])) for w in order[:width]}
        wanted = Counter((i, w, round(ws.count(w) / len(ws) * idf[w], 9)) for i, ws in kept for w in set(ws) & set(idf))
        got = T.tfidf_transform(df, ["id"], "t", vocab).collect()
        assert Counter((r.id, r.term, round(r.tfidf, 9)) for r in got) == wanted
        wide = T.tfidf_columns(df, "t", vocab, width).collect()
        assert len(wide) == len(rows) and sum(sum(v != 0 for v in r[2:]) for r in wide) == sum(k[2] != 0 for k in wanted.elements())
    none = df.filter("id < 0")
    assert T.tfidf_fit(none, "t").count() == 0 and T.tfidf_fit(spark.createDataFrame([(None,)], "t string"), "t").count() == 0
    assert T.tfidf_columns(df, "t", T.tfidf_fit(none, "t"), 2).agg({"tfidf_0": "max"}).first()[0] == 0.0
