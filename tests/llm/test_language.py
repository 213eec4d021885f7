"""Stored language models against those of all counts in memory."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from marketloom.llm import language, words


def plain_model(rows):
    """The model of all 4-grams of (text, lang) rows, counted here."""
    found = {}
    for text, lang in rows:
        padded = "   " + re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in text)).lstrip()
        found.setdefault(lang, Counter()).update(padded[i : i + 4] for i in range(len(padded) - 3))
    langs = sorted(found)
    codes = [np.frombuffer("".join(found[x]).encode("utf-32-le"), np.uint32).reshape(-1, 4) for x in langs]
    return language.Model(langs, codes, [np.array(list(found[x].values())) for x in langs])


def entropies(model, texts):
    (chunk,) = words.chunks(pa.array(texts))
    return model.entropies(chunk)[0]


def counts(spark, rows):
    return language.gram_counts(spark.createDataFrame(rows, "text string, lang string").repartition(3), "text", "lang")


def test_stored_model_is_the_model_in_memory(spark):
    rows = [("The cat and the dog are in the house, the king's.", "en"), ("Der Hund und die Katze sind im Haus", "de"), ("a", "fr"), ("日本語 の 文章", "ja")] * 2
    rows += [(f"{w} of the {w}s", "en") for w in ("bird", "tree", "stone", "river")]
    probe = ["the house of the dog", "die katze", "x", "日本の語", "zzz qqq", ""]
    want = plain_model(rows)
    for part_grams in (10, 1_000_000):
        got = language.stored_model(counts(spark, rows), part_grams)
        assert got.langs == want.langs == ["de", "en", "fr", "ja"]
        np.testing.assert_allclose(entropies(got, probe), entropies(want, probe), rtol=1e-12)


def test_every_gram_is_kept(spark):
    """More different grams than the former million, nearly all of them once."""
    letters = np.random.default_rng(7).integers(0x4E00, 0x9FA5, 1_100_000).astype("<u4")
    rows = [(letters[i : i + 10_000].tobytes().decode("utf-32-le"), "zz") for i in range(0, len(letters), 10_000)]
    got, want = language.fit(spark.createDataFrame(rows, "text string, lang string")).model, plain_model(rows)
    assert len(want.grams[-1].keys) > 1_090_000
    assert got.grams[-1].look(want.grams[-1].keys)[1].all()
    probe = [r[0][:50] for r in rows[:3]] + [rows[0][0][5:9][::-1]]
    np.testing.assert_allclose(entropies(got, probe), entropies(want, probe), rtol=1e-12)


def test_rejection_is_calibrated_per_language_on_distinct_texts(spark):
    """Each text counts once, all rows count, and a few texts set no spread."""
    r = np.random.default_rng(3)
    vocabulary = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(40)]
    many = [(" ".join(r.choice(vocabulary, r.integers(3, 40))), "aa") for _ in range(400)]
    rare = "кот и пёс живут в доме у реки " * 4
    rows = many + [(many[0][0], "aa")] * 5_000 + [(rare, "bb")] * 50
    found = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    texts = sorted({t for t, x in rows if x == "aa"})
    (chunk,) = words.chunks(pa.array(texts))
    h, n = found.model.entropies(chunk)
    mean = np.average(h[:, 0], weights=n)
    assert np.isclose(found.mean[0], mean) and np.isclose(found.spread[0], np.sqrt(np.mean((h[:, 0] - mean) ** 2 * n)))
    assert found.few.tolist() == [False, True]
    (probe,) = words.chunks(pa.array(["пёс у дома", "кот и пёс живут в доме у реки и там им всегда хорошо", "漢字の文章はここにある" * 20]))
    names, _, _, rejected = found.predict(probe)
    assert names[:2] == ["bb", "bb"] and rejected.tolist() == [False, False, True]
