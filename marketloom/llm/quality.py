"""Document quality: random Fourier features of text statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import words

# Classes of bytes whose shares are statistics.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "comma", "bracket", "symbol", "control", "other")
_CLASS = np.full(256, CLASSES.index("other"), np.int64)  # bytes of characters beyond ASCII
_CLASS[:0x20] = CLASSES.index("control")
_CLASS[0x7F] = CLASSES.index("control")
for _name, _bytes in (
    ("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("space", b" \t"), ("line", b"\n\r"),
    ("stop", b".!?"), ("comma", b",;:'\"-"), ("bracket", b"()[]{}<>"), ("symbol", b"#$%&*+/=@\\^_`|~"),
):
    _CLASS[list(_bytes)] = CLASSES.index(_name)
_MARKED = np.isin(_CLASS, [CLASSES.index(x) for x in ("stop", "symbol", "bracket")])

STATISTICS = (
    "log_bytes", "log_words", *(f"share_{x}" for x in CLASSES), "word_mean", "word_deviation", "log_word_longest", "lone_letters",
    "ends_marked", "distinct_words", "repeated_pairs", "log_line_mean", "repeated_lines", "entropy",
)


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, whose first values are at ``first``."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of different values in each row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    return np.bincount(row[order][new], minlength=len(first) - 1).astype(np.float64)


def measure(chunk: words.Chunk) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; all are finite, and 0 where there is nothing to measure."""
    data, offsets = chunk.data, chunk.offsets
    rows, size = len(offsets) - 1, np.diff(offsets).astype(np.float64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(row * 256 + data, minlength=256 * rows).reshape(rows, 256).astype(np.float64)
    share = counts / np.maximum(size, 1)[:, None]
    classes = np.stack([share[:, _CLASS == i].sum(axis=1) for i in range(len(CLASSES))], axis=1)
    entropy = -(share * np.log(np.where(share > 0, share, 1.0))).sum(axis=1)
    found = words.split(chunk)
    length, n = (found.end - found.start).astype(np.float64), np.diff(found.first).astype(np.float64)
    some = np.maximum(n, 1)
    mean = _per_row(length, found.first) / some
    spread = np.sqrt(np.maximum(_per_row(length**2, found.first) / some - mean**2, 0))
    longest = np.zeros(rows)
    full = np.flatnonzero(n)
    if len(full):
        longest[full] = np.maximum.reduceat(length, found.first[:-1][full])
    marked = _MARKED[data[found.end - 1]] if len(length) else np.empty(0)
    hashes = words.span_hashes(data, found.start, found.end)
    pairs = words.gram_hashes(hashes, 2)
    inside = np.flatnonzero(np.diff(np.repeat(np.arange(rows), np.diff(found.first))) == 0)
    pair_first = np.searchsorted(inside, found.first)
    n_pairs = np.diff(pair_first)
    # Lines are the spans between line breaks; the end of a text is one.
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1][size > 0], breaks[~np.isin(breaks + 1, offsets)] + 1]))
    line_row = np.searchsorted(offsets, begin, "right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), offsets[line_row + 1]) if len(begin) else begin
    lines = words.span_hashes(data, begin, stop - (data[stop - 1] == 0x0A)) if len(begin) else np.empty(0, np.uint64)
    line_first = np.searchsorted(line_row, np.arange(rows + 1))
    n_lines = np.diff(line_first)
    return np.column_stack([
        np.log1p(size), np.log1p(n), classes, mean / (1 + mean), spread / (1 + spread), np.log1p(longest), _per_row(length == 1, found.first) / some,
        _per_row(marked, found.first) / some, _distinct(hashes, found.first) / some,
        np.where(n_pairs > 0, 1 - _distinct(pairs[inside], pair_first) / np.maximum(n_pairs, 1), 0.0),
        np.log1p(size / np.maximum(n_lines, 1)), np.where(n_lines > 0, 1 - _distinct(lines, line_first) / np.maximum(n_lines, 1), 0.0), entropy,
    ])


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, stats): ``STATISTICS`` of every whole text; null texts count as empty, all of whose are 0. No shuffle."""
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                found = measure(chunk)
                at = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(chunk.first, chunk.last - chunk.first), pa.ListArray.from_arrays(at, pa.array(found.ravel()))], ["key", "stats"]
                )

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(words.freed(run), f"key {kind}, stats array<double>").withColumnRenamed("key", key)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


class Features(NamedTuple):
    """Random Fourier features: cosines of random directions through standardised statistics, and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def of(self, stats: np.ndarray) -> np.ndarray:
        """Features whose inner products approximate exp(-|x - y|**2 / (2 width**2)); statistics beyond 8 deviations count as 8."""
        x = np.clip((stats - self.mean) / self.scale, -8.0, 8.0)
        out = np.ones((len(x), len(self.phases) + 1))
        np.cos(x @ self.directions + self.phases, out=out[:, :-1])
        out[:, :-1] *= np.sqrt(2.0 / len(self.phases))
        return out


class Model(NamedTuple):
    """Ridge weights over features, and the calibration: raw scores ``knots`` with the share of positive rows at each."""

    features: Features
    weights: np.ndarray
    knots: np.ndarray
    shares: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features.of(stats) @ self.weights, self.knots, self.shares)


def isotonic(score: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: mean score and share of positives of each block, for ascending scores with ``n`` rows."""
    blocks: list[list[float]] = []
    for s, k, p in zip(score.tolist(), n.tolist(), positive.tolist()):
        blocks.append([s * k, k, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    total = np.array(blocks)
    return total[:, 0] / total[:, 1], total[:, 2] / total[:, 1]


def fit(
    labelled: DataFrame, features: int = 256, width: float = 3.0, ridge: float = 1e-4, folds: int = 4, bins: int = 2_000, seed: int = 12
) -> Model:
    """The model of all rows of ``labelled``: (stats, label 0 or 1, fold from 0 to ``folds`` - 1).

    Every task adds up its rows' outer products per fold, and Spark adds the
    tasks'; the driver solves the normal equations of ``features`` + 1
    unknowns, of all folds and of all but one each. The calibration is fitted
    on scores of rows by the model that left their fold out, counted in
    ``bins`` steps between -0.5 and 1.5. What the driver gets depends on these
    parameters only. Without labelled rows every score is 0.5; with one class
    it is that class. Runs three passes over ``labelled``, which should be
    stored.
    """
    size = len(STATISTICS)
    wide = labelled.select(F.lit(0).alias("all"), array_to_vector("stats").alias("v"))
    moments = wide.groupBy("all").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("mean"), vector_to_array(Summarizer.std(F.col("v"))).alias("std")).first()
    rng = np.random.Generator(np.random.PCG64(seed))
    directions, phases = rng.standard_normal((size, features)) / width, rng.uniform(0, 2 * np.pi, features)
    if moments is None:  # no rows, no group
        return Model(Features(np.zeros(size), np.ones(size), directions, phases), np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    scale = np.array(moments.std)
    space = Features(np.array(moments.mean), np.where(scale > 1e-9, scale, 1.0), directions, phases)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            fold, label = np.asarray(batch.column("fold")), np.asarray(batch.column("label"), np.float64)
            for f in np.unique(fold).tolist():
                own = np.flatnonzero(fold == f)
                x = space.of(_matrix(batch.column("stats").take(pa.array(own))))
                part = x.T @ np.column_stack([x, label[own]])
                total[f] = total[f] + part if f in total else part
        for f, part in total.items():
            at = pa.array(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * len(part), pa.int32()), pa.array(np.arange(len(part), dtype=np.int32)), pa.ListArray.from_arrays(at, pa.array(part.ravel()))], ["fold", "line", "part"]
            )

    source = labelled.select("stats", F.col("label").cast("double").alias("label"), F.col("fold").cast("int").alias("fold"))
    lines = source.mapInArrow(words.freed(sums), "fold int, line int, part array<double>")
    added = lines.groupBy("fold", "line").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part"))
    normal = np.zeros((folds, features + 1, features + 2))
    for r in added.toLocalIterator():
        normal[r.fold, r.line] = r.part
    whole = normal.sum(axis=0)

    def solve(equations: np.ndarray) -> np.ndarray:
        n = max(equations[-1, -2], 1.0)  # the constant's square adds up to the rows
        penalty = np.full(features + 1, ridge * n)
        penalty[-1] = 1e-9 * n  # the constant is free
        return np.linalg.solve(equations[:, :-1] + np.diag(penalty), equations[:, -1])

    weights = solve(whole)
    left_out = np.stack([solve(whole - normal[f]) for f in range(folds)])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = np.asarray(batch.column("fold"))
            raw = np.einsum("ij,ij->i", space.of(_matrix(batch.column("stats"))), left_out[fold])
            step = np.round((np.clip(raw, -0.5, 1.5) + 0.5) * bins / 2).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("label")], ["step", "label"])

    counted = source.mapInArrow(words.freed(judged), "step int, label double").groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"))
    rows = sorted(tuple(r) for r in counted.collect())
    step, n, positive = (np.array(x, np.float64) for x in zip(*rows))
    return Model(space, weights, *isotonic(step * 2 / bins - 0.5, n, positive))


def score(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of ``statistics``: the calibrated share of positives, 0 to 1."""
    source = stats.select(F.col(key).alias("key"), "stats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.scores(_matrix(batch.column("stats"))))], ["key", "score"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(words.freed(run), f"key {kind}, score double").withColumnRenamed("key", key)


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3, folds: int = 4, **settings: float
) -> DataFrame:
    """(key, score, predicted) of every row of ``docs``, learned from ``labels`` (key, label).

    Only texts are looked at. Labels other than 0 and 1, and of unknown or
    null keys, are left out; a key with several labels counts with each. A
    row's fold comes from a hash of its key, so equal keys share one. Rows
    are scored one by one: repeated rows and null keys stay, null and empty
    texts get the score of an empty text, equal texts equal scores. Other
    columns are not read, whatever their names. Writes the statistics to the
    shared folder and runs the jobs of ``fit``, with its ``settings``.
    """
    from marketloom.session import materialise

    stats = materialise(statistics(docs, key, text).withColumnRenamed(key, "key"), "quality-statistics")
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter("label in (0, 1)")
    fold = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(folds)).alias("fold")
    labelled = materialise(stats.join(known, "key").select("stats", "label", fold), "quality-labelled")
    found = score(stats, fit(labelled, folds=folds, **settings), "key")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("key", key)
