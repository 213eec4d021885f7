"""Repeated passages: minimiser blocks of all documents, and window hashes where blocks differ.

This takes the place of relative Lempel-Ziv parsing: no document is parsed
from left to right against reference blocks, and there are no factors. Which
windows repeat does not depend on a parse, and a parse would need an index of
all blocks in every task. Blocks equal to another are repeated whole; of the
other blocks of a repeated anchor all windows are hashed and counted.

The anchor of a window of ``length`` words is the smallest hash among its runs
of ``ANCHOR`` words, the leftmost if equal. It depends on the window's words
alone, so equal windows lie in blocks of the same anchor, at the same distance
from it. A block holds the consecutive windows of one anchor, and all windows
of a document lie in exactly one block each. Hence windows are only compared
below one anchor, and the result is that of comparing all windows with all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import texts, words
from marketloom.session import materialise

ANCHOR = 8


class Blocks(NamedTuple):
    """Per block: its row, first window (word of the chunk), windows, distance of the anchor, hashes."""

    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    lead: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest (leftmost) of each run of ``width`` values is."""
    at = np.arange(len(values))
    size, best = 1, at
    while size * 2 <= width:
        a, b = best[:-size], best[size:]
        best = np.where(values[b] < values[a], b, a)
        size *= 2
    if size < width:
        a, b = best[: len(best) - (width - size)], best[width - size :]
        best = np.where(values[b] < values[a], b, a)
    return best


def cut(hashes: np.ndarray, first: np.ndarray, length: int) -> Blocks:
    """The blocks of a chunk's rows; rows of fewer than ``length`` words have none."""
    count = np.diff(first)
    n_windows = np.maximum(0, count - length + 1)
    if not n_windows.sum():
        none = np.empty(0, np.int64)
        return Blocks(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    grams = words.gram_hashes(hashes, ANCHOR)
    least = _least(grams, length - ANCHOR + 1)
    row = np.repeat(np.arange(len(count)), n_windows)
    start = np.arange(len(row)) - (np.cumsum(n_windows) - n_windows)[row] + first[:-1][row]
    anchor = least[start]
    new = np.ones(len(row), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(row)))
    at, place = start[begin], anchor[begin]
    lead = place - at
    content = words.long_hashes(hashes, at, at + size + length - 1)
    content = words.mix(content ^ lead.astype(np.uint64))
    return Blocks(row[begin], at, size, lead, grams[place], content)


def _blocks(source: DataFrame, length: int, kind: str) -> DataFrame:
    """One row per block; ``start`` counts words of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, found, hashes, prints in texts.documents(batch):
                b = cut(hashes, found.first, length)
                if not len(b.row):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(b.row + chunk.first)),
                        texts.signed(prints[b.row]),
                        pa.array((b.start - found.first[b.row]).astype(np.int32)),
                        pa.array(b.windows.astype(np.int16)),
                        pa.array(b.lead.astype(np.int16)),
                        texts.signed(b.anchor),
                        texts.signed(b.content),
                    ],
                    ["key", "print", "start", "windows", "lead", "anchor", "content"],
                )

    return source.mapInArrow(words.freed(run), f"key {kind}, print long, start int, windows smallint, lead smallint, anchor long, content long")


def _edge_windows(asked: DataFrame, length: int) -> DataFrame:
    """Hash of every window of the asked blocks of packed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = ((p, c) for p, raw in texts.unpacked(batch) for c in words.chunks(pa.array(raw, pa.large_binary()).view(pa.large_string())))
            for piece, chunk in pieces:
                found = words.split(chunk)
                hashes = words.span_hashes(chunk.data, found.start, found.end)
                own = piece.column("asked").slice(chunk.first, chunk.last - chunk.first)
                flat, per_row = own.flatten(), np.asarray(own.value_lengths().fill_null(0))
                part = lambda name: np.asarray(flat.field(name)).astype(np.int64)
                size = part("windows")
                block = np.repeat(np.arange(len(size)), size)
                step = np.arange(len(block)) - (np.cumsum(size) - size)[block]
                row = np.repeat(np.arange(len(per_row)), per_row)
                at = (part("start") + found.first[row])[block] + step
                # A block's first window lies ``lead`` words before its anchor.
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("anchor").take(pa.array(block)),
                        flat.field("content").take(pa.array(block)),
                        flat.field("copies").take(pa.array(block)),
                        pa.array(step.astype(np.int16)),
                        pa.array((part("lead")[block] - step).astype(np.int16)),
                        texts.signed(words.long_hashes(hashes, at, at + length)),
                    ],
                    ["anchor", "content", "copies", "step", "offset", "window"],
                )

    return asked.mapInArrow(words.freed(run), "anchor long, content long, copies long, step smallint, offset smallint, window long")


def _repeated_blocks(blocks: DataFrame, packed: DataFrame, length: int) -> DataFrame:
    """(anchor, content, runs) of each distinct block with repeated windows.

    ``blocks`` are those whose anchor occurs more than once. ``runs`` holds the
    numbers of a block's repeated windows; null stands for all.
    """
    kinds = blocks.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "print", "start", "windows", "lead")).alias("at")
    )
    whole = kinds.filter("copies > 1").select("anchor", "content", F.lit(None).cast("array<smallint>").alias("runs"))
    # Distinct blocks of one anchor may agree in part; one place of each is looked at.
    several = blocks.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    edges = kinds.join(several.filter("low <> high").select("anchor"), "anchor", "left_semi")
    asked = edges.groupBy(F.col("at.key").alias("key"), F.col("at.print").alias("print")).agg(
        F.collect_list(F.struct("anchor", "content", "copies", "at.start", "at.windows", "at.lead")).alias("asked")
    )
    a, d = asked.alias("a"), packed.alias("d")
    held = a.join(d, F.col("a.key").eqNullSafe(F.col("d.key")) & (F.col("a.print") == F.col("d.print"))).select("packed", "asked")
    # Rows that agree in key and text give their windows twice, but their blocks have copies anyway.
    windows = materialise(_edge_windows(held, length), "repeats-windows")
    often = windows.groupBy("anchor", "offset", "window").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n")
    partly = (
        windows.filter("copies = 1")
        .join(often, ["anchor", "offset", "window"], "left_semi")
        .groupBy("anchor", "content")
        .agg(F.collect_list("step").alias("runs"))
    )
    return whole.unionByName(partly)


def covered(starts: list[int], size: int, n: int) -> np.ndarray:
    """Which of ``n`` words are in runs of ``size`` words from the given starts."""
    change = np.zeros(n + 1, np.int64)
    at = np.array(starts, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.cumsum(change[:n]) > 0


def _kept(joined: DataFrame, length: int, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part, own_texts in texts.unpacked(batch):
                counts, spans, kept = [], [], []
                for text, hits in zip(own_texts, part.column("hits")):
                    own = text.split()  # of bytes: at the same characters as elsewhere here
                    counts.append(len(own))
                    found = hits.as_py()
                    edges = []
                    if found:
                        starts = [h["start"] + s for h in found for s in (range(h["windows"]) if h["runs"] is None else h["runs"])]
                        bad = covered(starts, length, len(own))
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], bad, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
                        own = list(compress(own, (~bad).tolist()))
                    spans.append([{"start": s, "end": e} for s, e in edges])
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.string())],
                    ["key", "n_words", "spans", "kept"],
                )

    return joined.mapInArrow(words.freed(run), f"key {kind}, n_words long, spans array<struct<start:int,end:int>>, kept string")


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35) -> DataFrame:
    """Word spans of every text that are repeated anywhere, and the words kept.

    A word goes if a window of ``length`` words that holds it starts at another
    place too, in the same or another text; the first copy goes as well.
    Returns ``key``, ``n_words``, ``spans`` (maximal, in words, end exclusive)
    and ``kept`` (the other words joined by one space), one row per input row.
    Null texts have no words. Rows that agree in key and text get the same
    result; keys may be null. Other columns are not read. Runs jobs that write
    the blocks of repeated anchors to the shared folder.
    """
    if length < ANCHOR:
        raise ValueError(f"length must be at least {ANCHOR}")
    source, kind = texts.keyed(df, key, text)
    blocks, packed = _blocks(source, length, kind), texts.packed(source, kind)
    anchors = blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    likely = materialise(blocks.join(anchors, "anchor", "left_semi"), "repeats-blocks")
    repeated = _repeated_blocks(likely, packed, length)
    hits = (
        likely.join(repeated, ["anchor", "content"])
        .groupBy("key", "print")
        .agg(F.collect_list(F.struct("start", "windows", "runs")).alias("hits"))
    )
    d, h = packed.alias("d"), hits.alias("h")
    joined = d.join(h, F.col("d.key").eqNullSafe(F.col("h.key")) & (F.col("d.print") == F.col("h.print")), "left")
    return _kept(joined.select("d.key", "packed", "hits"), length, kind).withColumnRenamed("key", key)
