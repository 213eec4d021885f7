"""Near duplicates: min-max hashing, banding, confirmed links and their components."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import texts, words
from marketloom.session import materialise


class Banding(NamedTuple):
    """``bands`` keys of ``rows`` values each, half of them minima and half maxima.

    Needs ``bands * rows <= screened``.
    A permutation gives its minimum to a band of minima and its maximum to a
    band of maxima, so half as many hash evaluations as values do. A
    pair of similarity s is missed with probability (1 - s**rows)**bands: 8e-5
    at 0.75 and 3e-9 at 0.85 with the defaults.
    """

    bands: int = 48
    rows: int = 6
    screened: int = 576  # values, of further permutations too, of which a sketch keeps two bits

    @property
    def sketch_longs(self) -> int:
        return -(-self.screened // 32)

    def least_agreeing(self, percent: int, deviations: float = 4.5) -> int:
        """Agreeing two-bit values of a pair at the threshold, less so many standard deviations."""
        n, p = self.screened, 0.25 + 0.75 * percent / 100
        return int(n * p - deviations * (n * p * (1 - p)) ** 0.5)


_rng = np.random.Generator(np.random.PCG64(7))
_FACTOR = (_rng.integers(0, 2**31, 4096, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFT = _rng.integers(0, 2**32, 4096, dtype=np.uint32)
_COLUMNS = 2048  # shingles evaluated at a time
CLASS = "decimal(38,0)"
_EVEN_BITS = 0x5555555555555555


def min_max(values: np.ndarray, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of a non-empty set under each permutation."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    factor, shift = _FACTOR[:permutations, None], _SHIFT[:permutations, None]
    low, high = np.full(permutations, 2**32 - 1, np.uint32), np.zeros(permutations, np.uint32)
    for at in range(0, len(short), _COLUMNS):
        hashed = (short[None, at : at + _COLUMNS] ^ shift) * factor
        np.minimum(low, hashed.min(axis=1), out=low)
        np.maximum(high, hashed.max(axis=1), out=high)
    return low, high


def band_keys(values: np.ndarray, banding: Banding) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each band, different between bands, and two bits of every value."""
    low, high = min_max(values, banding.screened // 2)
    both = np.concatenate([low, high])
    half = banding.bands * banding.rows // 2
    parts = np.concatenate([low[:half], high[:half]]).reshape(banding.bands, banding.rows).astype(np.uint64)
    keys = np.arange(1, banding.bands + 1, dtype=np.uint64)
    for j in range(banding.rows):
        keys = words.mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    bits = np.zeros(banding.sketch_longs * 32, np.uint64)
    bits[: len(both)] = (both >> np.uint32(9)) & np.uint32(3)
    return keys, (bits.reshape(-1, 32) << (2 * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def class_ids(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A 120-bit digest of each row's set, as a decimal; equal sets are one class."""
    sums = np.zeros((2, len(values) + 1), np.uint64)
    np.cumsum(words.mix(values), out=sums[0, 1:])
    np.cumsum(words.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
    size = np.diff(first).astype(np.uint64)
    out = np.empty((len(first) - 1, 2), np.uint64)
    out[:, 0] = words.mix(sums[0, first[1:]] - sums[0, first[:-1]] + size)
    out[:, 1] = words.mix(sums[1, first[1:]] - sums[1, first[:-1]]) >> np.uint64(8)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(out), [None, pa.py_buffer(out.tobytes())])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, of sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(raw: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted shingle sets of texts, letters A-Z lowered."""
    out = []
    for chunk in words.chunks(pa.array(raw, pa.large_binary()).view(pa.large_string())):
        chunk = words.lowered(chunk)
        found = words.split(chunk)
        values, first = words.shingle_sets(words.span_hashes(chunk.data, found.start, found.end), found.first, size)
        out += [values[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]
    return out


def _sketches(source: DataFrame, kind: str, banding: Banding, size: int) -> DataFrame:
    """Set size, class and band keys of each document; empty sets have no class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                prints = words.span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:])
                chunk = words.lowered(chunk)
                found = words.split(chunk)
                values, first = words.shingle_sets(words.span_hashes(chunk.data, found.start, found.end), found.first, size)
                n = np.diff(first)
                full = np.flatnonzero(n)
                keys = [band_keys(values[first[i] : first[i + 1]], banding) for i in full.tolist()]
                lists = []
                for i, per_row in enumerate((banding.bands, banding.sketch_longs)):
                    flat = np.concatenate([k[i] for k in keys]) if keys else np.empty(0, np.uint64)
                    ends = np.concatenate([[0], np.cumsum(np.where(n > 0, per_row, 0))]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), texts.signed(flat)))
                classes = class_ids(values, first)
                if len(full) < len(n):
                    classes = pa.array([c.as_py() if m else None for c, m in zip(classes, n)], classes.type)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(chunk.first, chunk.last - chunk.first),
                        texts.signed(prints),
                        pa.array(n.astype(np.int32)),
                        classes,
                        *lists,
                    ],
                    ["key", "print", "n", "class", "bands", "sketch"],
                )

    return source.mapInArrow(words.freed(run), f"key {kind}, print long, n int, class {CLASS}, bands array<long>, sketch array<long>")


def confirm(pairs: DataFrame, held: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar; ``held`` has one text of each class."""
    one, two = (held.select(F.col("class").alias(c), F.col("packed").alias(f"text_{c}")) for c in "ab")
    both = pairs.select("a", "b").join(one, "a").join(two, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [_sets([loosen.decompress(x.as_py()) for x in part.column(f"text_{c}")], size) for c in "ab"]
                good = pa.array([similar(x, y, percent) for x, y in zip(*sets)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(good), part.column("b").filter(good)], ["a", "b"])

    return both.mapInArrow(words.freed(run), f"a {CLASS}, b {CLASS}")


def _renamed(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between what ``labels`` (node, component) call their ends."""
    for end in ("low", "high"):
        names = labels.select(F.col("node").alias(end), F.col("component").alias("name"))
        edges = edges.join(names, end, "left").withColumn(end, F.coalesce("name", end)).drop("name")
    return edges


def _tops(edges: DataFrame) -> DataFrame:
    """(node, component): where each node that has a smaller neighbour ends by going on to the smallest one."""
    up = materialise(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("component")), "labels")
    while True:
        further = up.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = up.join(further, "component", "left").select("node", F.coalesce("further", "component").alias("component"), "further")
        jumped = materialise(jumped, "labels")
        up = jumped.drop("further")
        if jumped.filter("further is not null").isEmpty():
            return up


def components(links: DataFrame, low: str = "a", high: str = "b", labels: DataFrame | None = None) -> DataFrame:
    """(node, component) of an undirected graph; a component is named by its smallest node.

    ``labels``: an earlier result of this function, to which ``links`` are
    added. Each round moves every node to the end of its path of smallest
    neighbours, in jumps of doubling length, and keeps only the distinct edges
    between different ends, so that at most half of the nodes stay. Rounds are
    written to the shared folder.
    """
    edges = links.select(F.col(low).alias("low"), F.col(high).alias("high"))
    if labels is not None:
        labels = labels.filter("node <> component")
        edges = _renamed(edges, labels)
    while True:
        edges = edges.filter("low <> high").select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
        edges = materialise(edges.distinct(), "links")
        if labels is not None and edges.isEmpty():
            break
        tops = _tops(edges)
        if labels is None:
            labels = tops
        else:
            onward = tops.select(F.col("node").alias("component"), F.col("component").alias("top"))
            moved = labels.join(onward, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
            labels = materialise(moved.unionByName(tops), "labels")
        edges = _renamed(edges, tops)
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())


def _unshared(held: DataFrame, size: int) -> DataFrame:
    """(class, alone): how many shingles of each class no other class here has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in texts.unpacked(batch):
                sets = _sets(raw, size)
                row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([part.column("class").take(pa.array(row)), texts.signed(np.concatenate(sets))], ["class", "shingle"])

    shingles = held.mapInArrow(words.freed(run), f"class {CLASS}, shingle long")
    once = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.min("class").alias("class")).filter("k = 1")
    return once.groupBy("class").agg(F.count(F.lit(1)).alias("alone"))


def _agreeing(a: str, b: str, banding: Banding) -> Column:
    """At how many of their values two sketches agree in the two bits kept."""
    def differing(p: Column, q: Column) -> Column:
        differ = p.bitwiseXOR(q)
        return F.bit_count(differ.bitwiseOR(F.shiftright(differ, 1)).bitwiseAND(F.lit(_EVEN_BITS)))

    # Written out for every long, the condition would be too long to be compiled.
    total = F.aggregate(F.zip_with(f"{a}.sketch", f"{b}.sketch", differing), F.lit(0), lambda n, x: n + x)
    return F.lit(banding.screened) - total


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, size: int = 5, banding: Banding = Banding()
) -> DataFrame:
    """Set size and component of every document under confirmed similarity links.

    Words are runs of characters other than ``\\x20\\x09-\\x0D`` with A-Z
    lowered; a set holds the distinct ``size``-word shingles, or the whole
    sequence of a shorter text. Two documents are linked if 100 * |a and b| >=
    ``percent`` * |a or b|; texts without words are linked with nothing.
    Candidates are pairs that share a band key (``Banding``); every link is
    confirmed on full sets.

    Documents of equal sets are one class from the start. Classes that share a
    key are first compared with the key's smallest and largest class only;
    links found join components. Pairs of a key that are then still in
    different components are compared too, unless their sizes without the
    shingles that nothing else here has rule a link out, or their sketches do
    (``Banding.least_agreeing``); no group of near copies is expanded.

    Returns ``key``, ``n_shingles``, ``component_id`` (the smallest key
    reachable; null keys count only where there is no other) and ``kept`` (key
    = component_id; of rows that agree in key all are). One row per input row.
    Runs jobs that write to the shared folder.
    """
    out = _placed(df, key, text, percent, size, banding)
    return out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id", "kept")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, size: int = 5, banding: Banding = Banding()) -> DataFrame:
    """The rows of ``df``, with all columns, of which ``near_duplicates`` keeps one a component.

    Of rows that agree in key and text one stays, any of them. Columns may have
    any names.
    """
    names, (df, (key, text)) = df.columns, texts.numbered(df, key, text)
    kept = _placed(df, key, text, percent, size, banding).filter("kept")
    kept = kept.groupBy(F.col("key").alias("__key"), F.col("print").alias("__same")).agg(F.count(F.lit(1)).alias("__rows"))
    docs = texts.printed(df, text, "__print")
    docs = docs.join(kept, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__print") == F.col("__same")))
    if kept.filter("__rows > 1").isEmpty():
        return docs.select(*df.columns).toDF(*names)
    again = docs.filter("__rows > 1").dropDuplicates([key, "__print"])
    return docs.filter("__rows = 1").unionByName(again).select(*df.columns).toDF(*names)


def _placed(df: DataFrame, key: str, text: str, percent: int, size: int, banding: Banding) -> DataFrame:
    """(key, print, n, component_id, kept) of every row, written to the shared folder."""
    source, kind = texts.keyed(df, key, text)
    sketches = materialise(_sketches(source, kind, banding, size), "near-sketches")
    classes = sketches.filter("n > 0").select("class", "n", "key", "print", "bands", "sketch").dropDuplicates(["class"])
    members = classes.select("class", "n", F.explode("bands").alias("band"))
    ends = members.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    shared = materialise(members.join(ends, "band"), "near-members")

    stars = shared.select("class", "n", F.explode(F.array("low", "high")).alias("hub")).filter("class <> hub")
    stars = stars.select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    # One text of each class that shares a key is enough for all comparisons.
    wanted = shared.select("class").distinct().join(classes.select("class", "key", "print"), "class").alias("w")
    packed = texts.packed(source, kind).alias("p")
    same = F.col("w.key").eqNullSafe(F.col("p.key")) & (F.col("w.print") == F.col("p.print"))
    held = materialise(packed.join(wanted, same).select("class", "packed").dropDuplicates(["class"]), "near-texts")
    tried = materialise(stars, "near-pairs")
    links = materialise(confirm(tried, held, percent, size), "near-links")
    labels = components(links)

    placed = shared.join(labels.select(F.col("node").alias("class"), "component"), "class", "left").select(
        "band", "class", "n", F.coalesce("component", "class").alias("component")
    )
    open_bands = placed.groupBy("band").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select("band")
    rest = materialise(placed.join(open_bands, "band", "left_semi"), "near-rest")
    alone = _unshared(held.join(rest.select("class").distinct(), "class", "left_semi"), size)
    common = F.col("n") - F.coalesce("alone", F.lit(0))
    rest = rest.join(alone, "class", "left").withColumn("common", common).filter(100 * common >= percent * F.col("n"))
    rest = rest.join(classes.select("class", "sketch", "bands"), "class")
    rest = materialise(rest.select("band", "class", "component", "n", "common", "sketch", "bands"), "near-rest")
    x, y = rest.alias("x"), rest.alias("y")
    most = F.least("x.common", "y.common")  # bounds what the two have in common
    crossing = (
        x.join(
            y,
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.class") < F.col("y.class"))
            & (F.col("x.component") != F.col("y.component"))
            & (100 * most >= percent * (F.col("x.n") + F.col("y.n") - most))
            & (_agreeing("x", "y", banding) >= banding.least_agreeing(percent))
            # Of the keys that a pair shares, one gives it.
            & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.band")),
        )
        .select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
        .join(tried, ["a", "b"], "left_anti")
    )
    more = materialise(confirm(crossing, held, percent, size), "near-links")
    if not more.isEmpty():
        labels = components(more, labels=labels)

    named = sketches.join(labels.select(F.col("node").alias("class"), "component"), "class", "left").select(
        "key", "print", "n", F.coalesce("component", "class").alias("component")
    )
    lowest = named.filter("component is not null").groupBy("component").agg(F.min("key").alias("lowest"))
    out = named.join(lowest, "component", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("key")))
    return out.select("key", "print", "n", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
