import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom import schemas
from marketloom.functions.columns import int_or_default
from marketloom.session import materialise, shared_dir
from marketloom.sources import delimited, landed
from tests import fixtures as X


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_malformed_trials_are_all_quarantined(spark, tmp_path):
    path = write(tmp_path / "t.csv", X.trials_csv(quoted=False))
    good, bad = delimited.read_csv(spark, path, schemas.FACT_TRIALS)
    assert (good.count(), bad.count()) == (0, 10)
    assert bad.select("raw_line").first()[0].startswith("NCT")


def test_repaired_trials_read_whole(spark, tmp_path):
    good, bad = delimited.read_csv(spark, write(tmp_path / "t.csv", X.trials_csv()), schemas.FACT_TRIALS)
    assert bad.isEmpty()
    assert sorted(tuple(r) for r in good.collect()) == sorted(X.trial_rows())


def test_quarantine_does_not_depend_on_the_columns_read(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'k,name,size\n1,a,10\n2,b,c,10\n3,d\n4,"e,f",n/a\n5,"g,h",3\n6,i,\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("size", T.IntegerType())])
    good, bad = delimited.read_csv(spark, path, schema)
    assert sorted(r.k for r in good.select("k").collect()) == [1, 5, 6]
    assert sorted(r.raw_line for r in bad.select("raw_line").collect()) == ["2,b,c,10", "3,d", '4,"e,f",n/a']
    assert good.count() == 3 and bad.count() == 3


def test_typed_cast(spark):
    df = spark.createDataFrame([("7",), ("",), (" ",), (None,), (" 8 ",)], "v string")
    assert [r[0] for r in df.select(int_or_default(F.col("v"), strict=True)).collect()] == [7, 0, 0, 0, 8]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("x",)], "v string").select(int_or_default(F.col("v"), strict=True)).collect()


def test_result_round_trip_keeps_quotes_and_gaps(spark, tmp_path):
    rows = [(1, 'say "x", twice', 0.1), (2, "", None), (3, None, 1e-9), (4, "back\\slash", 123456789.125)]
    df = spark.createDataFrame(rows, "k int, t string, v double")
    delimited.write_result(df, str(tmp_path / "r"))
    # A text file has one kind of nothing: empty text comes back as missing.
    want = [(k, t or None, v) for k, t, v in rows]
    assert sorted(tuple(r) for r in delimited.scan_csv(spark, str(tmp_path / "r"), df.schema).collect()) == want


def test_missing_file_is_empty(spark, tmp_path):
    assert delimited.read_or_empty(spark, str(tmp_path / "none.csv"), schemas.RAW_MARKET).collect() == []
    found = delimited.read_or_empty(spark, write(tmp_path / "m.csv", X.MARKET), schemas.RAW_MARKET)
    assert found.count() == 8
    with pytest.raises(Exception, match="CSV"):
        delimited.read_or_empty(spark, write(tmp_path / "x.csv", "a,b\n1,2\n"), schemas.RAW_MARKET).collect()


def test_empty_result_writes_nothing(spark, tmp_path):
    df = spark.range(3)
    assert delimited.write_result(df, str(tmp_path / "a"))
    assert not delimited.write_result(df.filter("id < 0"), str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()


def test_flatten_study_with_everything(spark, tmp_path):
    write(tmp_path / "p1.json", json.dumps({"studies": [X.study()], "nextPageToken": "x"}, indent=1))
    bare = {"protocolSection": {"identificationModule": {"nctId": "NCT2"}}}
    late = X.study("NCT3", "A Study of Semaglutide in Adults", (), None, None)
    write(tmp_path / "p2.json", json.dumps({"studies": [bare, {}, late]}))
    write(tmp_path / "p3.json", json.dumps({"studies": []}))
    rows = {r.nct_id: r for r in landed.flatten_trials(landed.read_pages(spark, str(tmp_path), schemas.TRIAL_PAGE)).collect()}
    assert tuple(rows["NCT1"]) == (
        "NCT1", "Eli Lilly", "tirzepatide", "PHASE2,PHASE3", "Obesity | Type 2 Diabetes", "COMPLETED", 2021, 120,
        "SURPASS-1: Tirzepatide Study", "Randomized, Parallel", "weight", "adults, global", 0,
    )
    assert tuple(rows["NCT2"]) == ("NCT2", "", "other-glp1", "", "", "", 0, 0, "", "", "", "", 0)
    assert tuple(rows[""])[1:4] == ("", "other-glp1", "")
    assert (rows["NCT3"].molecule, rows["NCT3"].start_year, rows["NCT3"].enrollment) == ("semaglutide", 0, 0)


def test_event_rollup_counts_mentions(spark, tmp_path):
    folder = tmp_path / "year=2024" / "substance=TIRZEPATIDE"
    folder.mkdir(parents=True)
    react = lambda *names: {"reaction": [{"reactionmeddrapt": n} for n in names]}
    reports = [
        {"serious": "1", "patient": react("Nausea", "VOMITING", "Abdominal pain upper")},
        {"serious": "2", "patient": react("Nausea")},
        {"serious": None, "patient": react("Headache")},
        {"serious": 0, "patient": react("Injection site pain")},
        {"patient": {}},
    ]
    write(folder / "p.json", json.dumps({"results": reports}))
    schema = T.StructType([*schemas.EVENT_PAGE.fields, *schemas.EVENT_PARTITIONS.fields])
    pages = landed.read_pages(spark, str(tmp_path), schema)
    counts = {r.event_type: (r.year, r.molecule, r.report_count, r.serious_count) for r in landed.rollup_event_pages(pages).collect()}
    assert counts == {
        "Nausea & Vomiting": (2024, "Tirzepatide", 3, 3),
        "Gastrointestinal": (2024, "Tirzepatide", 1, 1),
        "Other": (2024, "Tirzepatide", 1, 0),
        "Injection Site": (2024, "Tirzepatide", 1, 0),
    }
    strict = {r.event_type: r.serious_count for r in landed.rollup_event_pages(pages, ["1"]).collect()}
    assert strict["Nausea & Vomiting"] == 2


@pytest.mark.parametrize(
    "page, source",
    [(json.dumps({"studies": [X.study()]}), "primary"), (json.dumps({"studies": []}), "fallback"), ('{"studies": [', "fallback"), (None, "fallback")],
)
def test_fallback_is_all_or_nothing(spark, tmp_path, page, source):
    pages = tmp_path / "pages"
    if page is not None:
        pages.mkdir()
        write(pages / "a.json", json.dumps({"studies": [X.study("NCT9")]}) if page == '{"studies": [' else page)
        write(pages / "b.json", page)
    df = landed.ingest_trials(spark, str(pages), write(tmp_path / "t.csv", X.trials_csv()))
    assert {r[0] for r in df.select("_source").collect()} == {source}
    assert df.count() == (10 if source == "fallback" else 2)


def test_fallback_says_why_and_other_errors_are_raised(spark, tmp_path):
    sample = write(tmp_path / "t.csv", X.trials_csv())
    missing = landed.ingest_trials(spark, str(tmp_path / "none"), sample)
    assert {r[0] for r in missing.select("_reason").collect()} == {"PATH_NOT_FOUND"}

    def broken(session, path):
        return session.range(3).select(F.raise_error(F.lit("disk full")).cast("long").alias("id"))

    with pytest.raises(Exception, match="disk full"):
        landed.read_with_fallback(spark, "x", "y", broken, lambda s, p: s.range(1))


def test_columns_are_read_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("brand", T.StringType())])
    path = write(tmp_path / "a.csv", "brand,note,year\nx,n,2020\ny,n,20z0\n")
    good, bad = delimited.read_csv(spark, path, schema)
    assert [tuple(r) for r in good.collect()] == [(2020, "x")]
    assert [r.raw_line for r in bad.collect()] == ["y,n,20z0"]
    with pytest.raises(ValueError, match="year"):
        delimited.read_csv(spark, write(tmp_path / "b.csv", "brand\nx\n"), schema)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialise(spark.range(5), "t")
    assert shared_dir(spark) in df.inputFiles()[0] and df.count() == 5
