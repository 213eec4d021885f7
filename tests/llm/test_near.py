import random
import re

from pyspark.sql import functions as F

from marketloom.llm import queries
from marketloom.llm.near import components, near_duplicates

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, n int, class int, component string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(k, low.get(root(i), k))
    out = []
    for i, (k, _) in enumerate(rows):
        c = low.get(root(i)) if sets[i] else k
        out.append((k, len(sets[i]), c, k == c))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op5_near_duplicates"](spark, SF)) == brute(rows)


def test_families_with_edits(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeÉ") for _ in range(4))
    rows, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.randint(8, 300))]
        for _ in range(r.randint(1, 14)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, len(base) // 40])):
                w[r.randrange(len(w))] = word()
            rows.append((i * 7 % 1009, r.choice([" ", "\n", "\t "]).join(w), None, 1, 2, "x"))
            i += 1
    got = found(near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute([x[:2] for x in rows])
    assert len({x[2] for x in got}) < len(got)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    texts = [(1, None), (2, ""), (3, " \n"), (9, long), (9, long), (4, long.upper()), (None, long), (None, "only me"), (5, "a b"), (6, "A\tB"), (7, "a b c"), (8, long + " z")]
    rows = [(*t, None, 0, 0, None) for t in texts]
    assert found(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(texts)
    assert found(near_duplicates(spark.createDataFrame([], SCHEMA))) == []


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(links).collect()} == {(i, 0) for i in range(n)}


def test_components_of_links_added_later(spark):
    r = random.Random(1)
    links = [(a, b) for a, b in ((r.randrange(80), r.randrange(80)) for _ in range(75)) if a != b]
    parent = {x: x for link in links for x in link}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    frame = lambda x: spark.createDataFrame(x, "a int, b int")
    found = [tuple(x) for x in components(frame(links[50:]), labels=components(frame(links[:50]))).collect()]
    assert sorted(found) == sorted((x, root(x)) for x in parent)
    assert components(frame([])).isEmpty()
