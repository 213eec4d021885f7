"""Each stage against brute force on its own input."""

import corpus_pipeline as P
from tests.llm.test_near import brute, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(P.STAGES)

    known = {r.doc_id for r in stages["language"](spark, docs, SF).collect()}
    assert known == {i for i, r in rows.items() if any(c.isalpha() for c in r.text)}

    kept, seen = {}, set()
    windows = {i: [tuple(x[k : k + 3]) for k in range(len(x) - 2)] for i, x in ((i, r.text.split("\n")) for i, r in sorted(rows.items()))}
    for i, own in windows.items():
        lines, gone = rows[i].text.split("\n"), set()
        for k, w in enumerate(own):
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        if len(gone) < len(lines):
            kept[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    out = stages["lines"](spark, docs, SF)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (t, len(t)) for i, t in kept.items()}

    one = stages["near_duplicates"](spark, docs, SF)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == [x[0] for x in sorted(brute([(i, r.text) for i, r in rows.items()])) if x[3]]

    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages["benchmark"](spark, docs, SF).collect()}
    assert clean == {i for i, r in rows.items() if not any(100 * len(q & shingles(r.text)) >= 75 * len(q) for q in items)}

    last = stages["pieces"](spark, docs, SF).collect()
    assert len(last) == len(rows) and all(r.lossless and r.pieces for r in last)


def test_run_and_repeated_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r.doc_id for r in P.run(spark, SF).collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) < docs.count()
    long = " ".join(f"word{i}" for i in range(80))
    odd = [(1, None), (None, long), (2, long), (2, long), (3, ""), (3, ""), (None, "other words here"), (None, "yet another one")]
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text) for r in P.distinct_documents(spark, d, SF).collect()]
    assert sorted(left, key=repr) == sorted([(1, None), (2, long), (3, ""), (None, "other words here"), (None, "yet another one")], key=repr)
    for _, stage in P.STAGES:
        stage(spark, d, SF).collect()
        stage(spark, d.filter("doc_id = 99"), SF).collect()
