"""Operators that work row by row, and those with a SQL oracle."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from marketloom.llm import contained, language, lines, pieces, queries, search, secrets, sharding
from tests import oracle
from tests.llm.test_near import shingles

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
MODEL = queries.tokenizer_file("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, key string, n int, found string, rank int, spans string, size int, shard string"
ODD = [(1, None), (2, ""), (3, " \n\n "), (None, "a b"), (5, "The thing\nin\nthe\nthing"), (5, "The thing\nin\nthe\nthing"), (6, "x" * 30_000), (7, "ñé ▁ 🙂\n\n  \t")]


def odd(spark, rows=None):
    return spark.createDataFrame([(*r, "k", 1, "f", 2, "s", 3, "t") for r in (ODD if rows is None else rows)], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_oracle(spark, name):
    problem, _ = oracle.compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert not problem


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op1_language"](spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert not any(r.rejected for r in found) and all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark):
    rows = [("the cat and the dog are in the house of the king", "en"), ("der hund und die katze sind im haus", "de"), (None, "en"), ("", "de"), ("no label", None)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.model.langs == ["de", "en"]
    got = {(r.doc_id, r.lang_pred, r.score, r.rejected) for r in language.identify(odd(spark), model).collect() if r.doc_id in (1, 2, 3)}
    assert got == {(i, "und", 0.0, True) for i in (1, 2, 3)}
    probe = [(10, "the house of the dog"), (11, "die katze und der hund"), (12, "漢字の文章はここにある" * 20)]
    got = {r.doc_id: r for r in language.identify(odd(spark, probe), model).collect()}
    assert got[10].lang_pred == "en" and got[11].lang_pred == "de" and got[12].rejected
    assert language.identify(odd(spark, []), model).count() == 0
    none = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in language.identify(odd(spark), none).collect()} == {"und"}


def test_model_is_a_distribution():
    code = np.array([[ord(c) for c in g] for g in ("abca", "bcab", "cabc", "abcb", "   a", "  ab")], np.uint32)
    model = language.Model(["x"], [code], [np.array([3, 2, 2, 1, 1, 1])])
    letters = [ord(c) for c in "abc "]
    for context in ("abc", "bca", "zzz", "   "):
        p = sum(np.exp(model.log_p(np.array([[*map(ord, context), c]], np.uint32))[0, 0]) for c in letters)
        assert 0.75 < p <= 1.0 + 1e-9


def plain_spans(text):
    word = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", *m.span()) for m in re.finditer(word, text or "", re.A) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_secrets_have_all_base_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in queries.QUERIES["op2_secrets"](spark, SF).collect()}
    total = 0
    for i, text in docs.collect():
        want = plain_spans(text)
        total += len(want)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        count = Counter(k for k, _, _ in want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (count["assign"], count["access"], count["hex"])
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[i].spans.split(","))
    assert total > 10


def test_lexed_secrets(spark):
    cases = {
        'base = "Zx9-Qw7_Lm3!"\ndb_pwd = base + "tail#9"\n': ['tail#9'],
        'K = "Zx9-Qw7_Lm3!"\nclient_credentials: K\n': ['Zx9-Qw7_Lm3!'],
        "signing_key: 'aB3$kLm9Qz'": ["aB3$kLm9Qz"],
        "passphrase = changeme_example": [],
        "keyboard = 'aB3$kLm9Qz'": [],
        "token = short\nif token == other_value_1: pass": [],
        "Das Wort: es ist lang und die Schluessel=neu": [],
    }
    for text, want in cases.items():
        got = [text[a:b] for kind, a, b, _, _ in secrets.find(text, 0.5) if kind == "lexed"]
        assert got == want, text
    got = {r.doc_id: r.found for r in secrets.scan_secrets(odd(spark)).collect()}
    assert got[1] == [] and got[2] == []
    assert secrets.find("secret=token:abcdefg", 0.5)[:1] != [("assign", 7, 20, "token", 1.0)]
    assert secrets.scan_secrets(odd(spark, [])).count() == 0


def test_shards(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.shard_documents(rows, [1, 2, 0, 1], [1, 2, 0, 1, 1]).collect()
    share = Counter(r.shard for r in out)
    assert set(share) == {0, 1, 3} and abs(share[1] / 20_000 - 0.5) < 0.02
    assert all(r.grown_shard in (r.shard, 4) for r in out) and any(r.grown_shard == 4 for r in out)
    for s in share:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(share[s]))
    got = sharding.shard_documents(odd(spark), [1.0] * 3).collect()
    assert len(got) == len(ODD) and {r.size for r in got if r.doc_id in (1, 2)} == {1}
    assert sorted(r.slot for r in got if r.shard == got[0].shard)[0] == 0 and sharding.shard_documents(odd(spark, []), [1.0]).count() == 0


def test_lines_of_odd_rows(spark):
    same = "a\nb\nc\nd"
    rows = [*ODD, (10, same), (11, "x\n" + same), (12, "a\na\na\na\na"), (None, same), (13, "a\nb"), (14, "\n\n\n\n")]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.without_repeated_lines(odd(spark, rows)).collect()]
    assert len(got) == len(rows)
    by = {i: x for i, *x in got if i not in (None, 5)}
    assert by[1] == [None, 0, 0] and by[2] == ["", 1, 0] and by[13] == ["a\nb", 2, 0]
    assert (None, same, 4, 0) in got  # a null key is first
    assert by[10] == ["", 4, 4] and by[11] == ["x", 5, 4] and by[12] == ["a", 5, 4] and by[14] == ["", 5, 4]
    assert [x[1:] for x in got if x[0] == 5] == [["The thing\nin\nthe\nthing", 4, 0]] * 2 or [tuple(x[1:]) for x in got if x[0] == 5] == [("The thing\nin\nthe\nthing", 4, 0)] * 2
    assert lines.without_repeated_lines(odd(spark, [])).count() == 0


def test_contained_items_are_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    sets = {r.item_id: shingles(r.text) for r in items.collect()}
    want = set()
    for i, text in docs.select("doc_id", "text").collect():
        own = shingles(text)
        want |= {(i, k, len(q), len(q & own)) for k, q in sets.items() if 100 * len(q & own) >= 75 * len(q)}
    assert len(want) > 10 and {tuple(r) for r in queries.QUERIES["op7_benchmark_items"](spark, SF).collect()} == want


def test_contained_odd_items(spark):
    long = " ".join(f"w{i}" for i in range(400))
    part = " ".join(f"w{i}" for i in range(100)) + " " + " ".join(f"v{i}" for i in range(24))
    docs = odd(spark, [*ODD, (20, "say " + long + " end"), (20, part), (21, "One TWO three"), (22, "two one")])
    items = spark.createDataFrame([(1, long), (2, part), (3, "one two"), (4, None), (5, " "), (6, "the thing in the thing"), (3, "one two")], "item_id int, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in contained.contained_items(docs, items).collect())
    assert got == [(5, 6, 1, 1), (5, 6, 1, 1), (20, 1, 396, 396), (20, 2, 120, 96), (20, 2, 120, 120), (21, 3, 1, 1)]
    assert contained.contained_items(docs, items.filter("item_id = 4")).count() == 0
    assert contained.without_contained(docs, items).count() == docs.count() - 5
    assert contained.contained_items(odd(spark, []), items).count() == 0


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [0.5, -1.0]), (1, [nan, 1.0]), (2, [inf, 0.0]), (3, None), (4, [None, 1.0]), (5, [3.0, 0.0]), (5, [3.0, 0.0]), (6, []), (None, [9.0, 9.0]), (200, [1.0]), (7, [2.0]), (8, [1e30, 1e30])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = [tuple(r) for r in search.top_inner_products(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    top = 2**63 - 1
    assert got == [
        (0, 1, 8, top), (0, 2, 5, 3 * 2**20), (0, 3, 5, 3 * 2**20), (0, 4, 100, -3 * 2**19),
        (100, 1, 5, 3 * 2**19), (100, 2, 5, 3 * 2**19), (100, 3, 0, -3 * 2**19), (100, 4, 8, -(2**63)),
        (200, 1, 7, 2**21),
    ]
    assert search.top_inner_products(df.filter("vec_id = 99"), F.col("vec_id") % 100 == 0).count() == 0


def test_search_is_brute_force(spark):
    r = np.random.default_rng(5)
    v = r.normal(size=(3000, 24)) * r.lognormal(0, 1, (3000, 1)) * np.geomspace(3, 0.05, 24)
    v[50:60] = v[0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for q, rank, i, s in search.top_inner_products(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(q, []).append((rank, i, s))
    w = np.floor(v * 1024).astype(np.int64)
    for q in range(0, 3000, 50):
        s = w @ w[q]
        want = sorted((-int(x), i) for i, x in enumerate(s) if i != q)[:10]
        assert sorted(got[q]) == [(k + 1, i, -x) for k, (x, i) in enumerate(want)]


def test_pieces_decode_everywhere(spark):
    df = odd(spark)
    out = pieces.decode(pieces.encode(df, MODEL, seed=3), MODEL).collect()
    assert sorted(map(repr, ((r.doc_id, r.decoded) for r in out))) == sorted(map(repr, ODD))
    assert [r.pieces for r in out if r.doc_id == 1] == [None]
    plain = SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r for r in pieces.encode(docs, MODEL, seed=3).collect()}
    assert all(plain.decode(r.pieces) == r.text for r in one.values())
    again = {r.doc_id: r.pieces for r in pieces.encode(docs.repartition(7), MODEL, seed=3).collect()}
    other = {r.doc_id: r.pieces for r in pieces.encode(docs, MODEL, seed=4).collect()}
    assert again == {i: r.pieces for i, r in one.items()} and again != other
    assert all(r.lossless for r in queries.QUERIES["op10_pieces"](spark, SMALL).collect())
    assert pieces.encode(odd(spark, []), MODEL).count() == 0


def test_pieces_are_drawn_by_weight(spark):
    """Frequencies of all segmentations of a word against their exact probabilities."""
    table = pieces.Pieces(MODEL, 3.0)
    ids = {s: i for i, s in enumerate(table.surface) if np.isfinite(table.log_p[i])}
    word = b" the"

    def ways(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                for tail, p in ways(rest[k:]):
                    yield (ids[rest[:k]], *tail), p + table.log_p[ids[rest[:k]]]

    exact = {w: np.exp(p) for w, p in ways(word)}
    whole = sum(exact.values())
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("the").alias("text"))
    seen = Counter(tuple(r.pieces) for r in pieces.encode(df, MODEL, temperature=3.0).select("pieces").collect())
    assert set(seen) <= set(exact)
    for w, p in exact.items():
        assert abs(seen[w] / n - p / whole) < 5 * (p / whole / n) ** 0.5 + 1e-3
