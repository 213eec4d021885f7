"""Merkle manifests against a plain recursive version."""

import hashlib
import random

from pyspark.sql import functions as F

from marketloom.llm import merkle

FIELDS = ["doc_id", "source", "text"]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """Root, and per leaf its siblings by level: (number before, all)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, j in enumerate(at):
            f = j // fanout * fanout
            run = nodes[f : f + fanout]
            paths[i].append((j - f, run[: j - f] + run[j - f + 1 :]))
            at[i] = j // fanout
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout, seen):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = climb([leaf_of(r) for r in by[s]], fanout)
    root, tops = climb([trees[s][0] for s in names], fanout)
    for s, top in zip(names, tops):
        subroot, paths = trees[s]
        for r, path in zip(by[s], paths):
            cur, proof = leaf_of(seen(r)), ""
            for before, others in path + top:
                proof += "".join(others)
                cur = sha("".join(others[:before]) + cur + "".join(others[before:]))
            out.append((r[0], leaf_of(r), subroot, root, sha(proof), cur, cur == root))
    return sorted(out, key=repr)


def seen(r):
    return (r[0], r[1], r[2].lower() if r[0] is not None and r[0] % 3 == 0 and r[2] is not None else r[2])


def got(df, **more):
    low = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    shown = merkle.leaf_hash([F.col("doc_id"), F.col("source"), low])
    found = merkle.manifest(df, FIELDS, presented=shown, **more)
    return found, sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def test_all_shapes_of_trees(spark):
    """Hot, lone and null groups; blocks of two, four and eight leaves; partial last subtrees in several rounds."""
    rng = random.Random(4)
    rows = []
    for s, n in (("hot", 150), (None, 33), ("é", 16), ("z", 17), ("a", 1), ("B", 2), ("b", 9), ("", 33)):
        rows += [(i * 7 % 1000, s, rng.choice(["Abc", "ü", "", None, "X" * 5000])) for i in range(n)]
    rows += [(None, "hot", "q"), (None, "hot", "q"), (3, "hot", "Same"), (3, "hot", "Same")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"g": F.lit(1), "leaf": F.lit(2), "rank": F.lit("x"), "block": F.lit(0)})
    for fanout, levels, parts in ((2, 1, 5), (2, 3, 1), (4, 1, 7), (16, 3, 3)):
        assert got(df.repartition(parts), fanout=fanout, levels=levels)[1] == plain(rows, fanout, seen)


def test_many_groups_and_paths(spark):
    rows = [(i, f"s{i % 90}", f"T{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found, flat = got(df, fanout=4, levels=1, paths=True)
    assert flat == plain(rows, 4, seen)
    assert found.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert {r.rank for r in found.collect()} == {0, 1, 2, 3}


def test_a_lone_row_and_no_rows(spark):
    df = spark.createDataFrame([(1, "s", "T")], "doc_id long, source string, text string")
    (row,) = merkle.manifest(df, FIELDS).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf_of((1, "s", "T")) and row.verified and row.proof_sha256 == sha("")
    assert not merkle.manifest(df.limit(0), FIELDS).collect()
