"""Short benchmark items inside documents: size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import texts, words

ITEMS_PER_PASS = 2_000
SKETCH = 64


class Index:
    """Sketches of a bounded number of items, and their full shingle sets.

    Items are partitioned by the power of two of their set size. An item's
    sketch is its ``SKETCH`` smallest shingle hashes; smaller sets are their
    own sketch. The share of the sketch found in a document estimates the
    containment. A partition's items become candidates from a number of found
    sketch hashes that lies 4.5 standard deviations below the threshold (for
    sets that are their own sketch, from the threshold itself), and only
    documents with enough shingles for its smallest item are looked at.
    """

    def __init__(self, items: list[bytes], percent: int, size: int) -> None:
        self.percent, self.size = percent, size
        self.sets: list[np.ndarray] = []
        self.width = np.zeros(len(items), np.int64)  # words of a shingle: fewer in an item that is shorter
        for i, text in enumerate(items):
            chunk = next(words.chunks(pa.array([text], pa.large_binary()).view(pa.large_string())))
            chunk = words.lowered(chunk)
            found = words.split(chunk)
            values, _ = words.shingle_sets(words.span_hashes(chunk.data, found.start, found.end), found.first, size)
            self.sets.append(values)
            self.width[i] = min(size, len(found.start))
        n = np.array([len(x) for x in self.sets], np.int64)
        p = percent / 100
        sampled = np.floor(SKETCH * p - 4.5 * (SKETCH * p * (1 - p)) ** 0.5)
        self.needed = np.where(n <= SKETCH, -(-n * percent // 100), np.maximum(1, sampled)).astype(np.int64)
        self.partitions = []
        size_class = np.floor(np.log2(np.maximum(n, 1))).astype(int)
        for c, w in sorted({(int(c), int(w)) for c, w, k in zip(size_class, self.width, n) if k}):
            own = np.flatnonzero((size_class == c) & (self.width == w) & (n > 0))
            hashes = np.concatenate([self.sets[i][:SKETCH] for i in own])  # sets are sorted
            item = np.repeat(own, [min(SKETCH, len(self.sets[i])) for i in own])
            order = np.argsort(hashes, kind="stable")
            keys, begin = np.unique(hashes[order], return_index=True)
            self.partitions.append((w, -(-int(n[own].min()) * percent // 100), keys, np.append(begin, len(order)), item[order], self._bits(keys)))

    @staticmethod
    def _bits(keys: np.ndarray) -> np.ndarray:
        """Which upper 20 bits occur; most hashes of a text end here."""
        bits = np.zeros(1 << 20, bool)
        bits[(keys >> np.uint64(44)).astype(np.int64)] = True
        return bits

    def search(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of all items contained in the rows of a chunk."""
        grams: dict[int, np.ndarray] = {}
        out = []
        for w, least, keys, begin, item, bits in self.partitions:
            if w not in grams:
                at = np.arange(max(0, len(hashes) - w + 1))
                grams[w] = words.gram_hashes(hashes, w) if w == self.size else words.long_hashes(hashes, at, at + w)
            g = grams[w]
            hit = np.flatnonzero(bits[(g >> np.uint64(44)).astype(np.int64)])
            if not len(hit):
                continue
            spot = np.minimum(np.searchsorted(keys, g[hit]), len(keys) - 1)
            same = keys[spot] == g[hit]
            hit, spot = hit[same], spot[same]
            row = np.searchsorted(first, hit, "right") - 1
            inside = (hit + w <= first[row + 1]) & (first[row + 1] - first[row] - w + 1 >= least)
            found = np.unique(np.stack([row[inside], spot[inside]]), axis=1)
            if not found.shape[1]:
                continue
            reach = begin[found[1] + 1] - begin[found[1]]
            rows = np.repeat(found[0], reach)
            items = item[np.repeat(begin[found[1]] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())]
            pairs, count = np.unique(np.stack([rows, items]), axis=1, return_counts=True)
            for r, i in pairs[:, count >= self.needed[pairs[1]]].T.tolist():
                own = g[first[r] : first[r + 1] - w + 1]
                shared = int(np.isin(self.sets[i], own).sum())
                if 100 * shared >= self.percent * len(self.sets[i]):
                    out.append((r, i, shared))
        return out


def _passes(items: DataFrame, key: str, text: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Keys and texts of the items, a bounded number at a time."""
    named = items.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter("text is not null").distinct()
    count = -(-named.count() // (ITEMS_PER_PASS // 2))
    for i in range(count):
        rows = named.filter(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == i).toArrow()
        yield rows.column("key").combine_chunks(), [t.encode() for t in rows.column("text").to_pylist()]


def _searched(batch: pa.RecordBatch, column: str, index: Index) -> Iterator[tuple[int, int, int]]:
    for chunk in words.chunks(batch.column(column)):
        chunk = words.lowered(chunk)
        found = words.split(chunk)
        hashes = words.span_hashes(chunk.data, found.start, found.end)
        for row, item, shared in index.search(hashes, found.first):
            yield row + chunk.first, item, shared


def contained_items(
    df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    percent: int = 75, size: int = 5,
) -> DataFrame:
    """(key, item_key, n_shingles, n_shared): items with at least ``percent`` of their shingles in a text.

    Shingles are the distinct ``size``-word runs with A-Z lowered; an item of
    fewer words is one shingle, its whole sequence, and is contained where
    that occurs. Candidates (``Index``) are confirmed on the full sets. Items
    without words are in no text, texts without words contain nothing; items
    that agree in key and text count once, repeated documents are rows of
    their own. Items are taken in passes of about ``ITEMS_PER_PASS / 2``, each
    over all documents without a shuffle.
    """
    source, kind = texts.keyed(df, key, text)
    item_kind = items.schema[item_key].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, n_shingles long, n_shared long"
    out = None
    for names, raw in _passes(items, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], names=names, raw=raw) -> Iterator[pa.RecordBatch]:
            index = Index(raw, percent, size)
            for batch in batches:
                hits = list(_searched(batch, "text", index))
                if hits:
                    row, item, shared = zip(*hits)
                    columns = [
                        batch.column("key").take(pa.array(row)),
                        names.take(pa.array(item)),
                        pa.array([len(index.sets[i]) for i in item], pa.int64()),
                        pa.array(shared, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "item", "n_shingles", "n_shared"])

        found = source.mapInArrow(words.freed(run), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = df.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"key": key, "item": item_key})


def without_contained(
    df: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = 75, size: int = 5
) -> DataFrame:
    """The rows of ``df``, with all columns, whose text contains none of the items (as above)."""
    names, (df, (text,)) = df.columns, texts.numbered(df, text)
    for _, raw in _passes(items, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], raw=raw) -> Iterator[pa.RecordBatch]:
            index = Index(raw, percent, size)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, _, _ in _searched(batch, text, index)]] = False
                yield batch.filter(pa.array(keep))

        df = df.mapInArrow(words.freed(run), df.schema)
    return df.toDF(*names)
