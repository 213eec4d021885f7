"""Periodic runs of words: sparse diagonals of repeated windows, and texts with the repeats collapsed."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import words

_PAIRS = 1_000_000  # pairs of a word and an earlier occurrence that are held at a time


class Runs(NamedTuple):
    """Runs by first word, then period; ``end`` is exclusive."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def _repeated(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose key occurs again, and a number of the key; by number, then position (``at`` ascends)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(new) - 1
    again = np.bincount(group)[group] > 1 if len(group) else np.empty(0, bool)
    return at[order][again], group[again]


def _diagonals(at: np.ndarray, group: np.ndarray, window: int, first_lag: int, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Ended diagonals of sufficient length as (start, end, lag), for lags from ``first_lag`` to below ``2 * window``.

    A pair of an occurrence of a window and an earlier one of the same
    ``group`` lies on the diagonal of their lag. Positions are gone through in
    order; each of its earlier occurrences extends the match of the active
    diagonal of that lag, and diagonals without a pair at the next position
    end. Occurrences at most half a window apart belong to one run of that
    smaller period; its multiples make no other run, so that only the nearest
    occurrence counts there.
    """
    n = len(at)
    index = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    apart = new.copy()
    apart[1:] |= np.diff(at) > window // 2
    chain = np.maximum.accumulate(np.where(apart, index, 0))
    span = int(at.max()) + 1
    base = group * span
    place = base + at
    low = np.searchsorted(place, base + np.maximum(at - 2 * window + 1, 0))
    high = chain
    if first_lag > 1:
        high = np.minimum(high, np.searchsorted(place, base + at - first_lag, "right"))
    near = (~apart) if first_lag == 1 else np.zeros(n, bool)  # the nearest occurrence, within the chain
    count = np.maximum(high - low, 0) + near
    by_place = np.argsort(at)
    done = np.cumsum(count[by_place])
    lag, begin, last = (np.empty(0, np.int64) for _ in range(3))  # active diagonals: first and last position
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + _PAIRS, "right")))
        own = by_place[lo:hi]
        many = np.maximum(high[own] - low[own], 0)
        each = np.repeat(own, many)
        earlier = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
        close = own[near[own]]
        here = np.concatenate([at[each], at[close]])
        there = np.concatenate([at[earlier], at[close - 1]])
        lag = np.concatenate([lag, here - there])
        begin, last = np.concatenate([begin, here]), np.concatenate([last, here])
        order = np.argsort(lag * (span + 1) + begin, kind="stable")
        lag, begin, last = lag[order], begin[order], last[order]
        fresh = np.ones(len(lag), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (begin[1:] != last[:-1] + 1)
        heads = np.flatnonzero(fresh)
        tails = np.append(heads, len(lag))[1:] - 1
        lag, begin, last = lag[heads], begin[heads], last[tails]
        ended = (last < at[own[-1]]) | (hi == n)
        length = lag + last - begin + window
        out = ended & (length >= np.maximum(least, 2 * lag))
        if out.any():
            yield (begin - lag)[out], (last + window)[out], lag[out]
        lag, begin, last = lag[~ended], begin[~ended], last[~ended]
        lo = hi


def find_runs(values: np.ndarray, first: np.ndarray, least: int = 12) -> Runs:
    """All runs of word hashes within rows, which begin at ``first`` (one more at the end).

    A run of period q matches over at least max(least - q, q) words at lag q,
    so a pair of words can only matter if whole windows match: those of half
    of ``least`` words for the smallest lags, and of w words for lags from w to
    2w, with w doubling while windows repeat within a row. Windows of w words
    are named by the names of their halves. A multiple of a run's period gives
    the same bounds; the smallest lag of equal bounds is its period.
    """
    n = len(values)
    size = np.diff(first)
    row = np.repeat(np.arange(len(size)), size)
    stop = np.repeat(first[1:], size)
    longest = int(size.max(initial=0))
    window, found = (least + 1) // 2, []
    if longest >= least:
        grams = words.gram_hashes(values, window)
        at = np.flatnonzero(np.arange(len(grams)) + window <= stop[: len(grams)])
        at, group = _repeated(words.mix(grams[at] + words.mix(row[at].astype(np.uint64))), at)
        lag = 1
        while len(at):
            found += _diagonals(at, group, window, lag, least)
            if 4 * window > longest:
                break
            name = np.full(n, -1, np.int64)
            name[at] = group
            at = np.sort(at)
            at = at[at + 2 * window <= stop[at]]
            at = at[name[at + window] >= 0]
            at, group = _repeated(name[at] * (int(group.max()) + 1) + name[at + window], at)
            window, lag = 2 * window, 2 * window
    start, end, period = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return Runs(start[order], end[order], period[order])


def _planted(first: np.ndarray, given: pa.Array) -> np.ndarray:
    """Which word of its row stands at each place, with the repeats that ``given`` asks for."""
    source = np.arange(first[-1])
    for r, g in enumerate(given.to_pylist()):
        n = int(first[r + 1] - first[r])
        if g is not None and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[first[r] + a : first[r + 1]] = first[r] + a + np.arange(n - a) % p
    return source


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> pa.Array:
    """A text of each row: its words, joined by one space."""
    size = end - start + 1  # with a space after it
    total = np.concatenate([[0], np.cumsum(size)])
    out = np.append(data, np.uint8(0x20))[np.minimum(np.repeat(start - total[:-1], size) + np.arange(total[-1]), len(data))]
    out[total[1:] - 1] = 0x20
    full = np.diff(first) > 0
    keep = np.ones(len(out), bool)
    keep[total[first[1:][full]] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(np.diff(total[first]) - full)])
    text = pa.LargeStringArray.from_buffers(len(full), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[keep].tobytes()))
    return text.cast(pa.string())


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12, repeat: Column | None = None
) -> DataFrame:
    """One row per input row: ``key``, ``n_words``, ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least ``least``
    and 2q words, that no neighbouring word extends; runs are by first word
    (from 0), then period. ``collapsed`` joins by one space the words that no
    run contains after its first q. ``repeat``, where not null, makes the
    words of a row from g % n on repeat with period 1 + (n - g % n) div
    (3 + g % 8) first. Null, empty and blank texts have no words, no runs and
    an empty ``collapsed``. Rows are independent of each other, repeated rows
    and null keys stay; other columns are not read, whatever their names. No
    shuffle; words are compared by 64-bit hashes. A task holds one text, or
    2 MB of texts, with some 60 times its size.
    """
    given = (F.lit(None) if repeat is None else repeat).cast("long")
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), given.alias("given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                found = words.split(chunk)
                first, rows = found.first, chunk.last - chunk.first
                place = _planted(first, batch.column("given").slice(chunk.first, rows))
                start, end = found.start[place], found.end[place]
                hashes = words.span_hashes(chunk.data, found.start, found.end)[place]
                runs = find_runs(hashes, first, least)
                gone = np.zeros(len(place) + 1, np.int64)
                np.add.at(gone, runs.start + runs.period, 1)
                np.add.at(gone, runs.end, -1)
                kept = np.cumsum(gone[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(kept)])[first]
                row = np.searchsorted(first, runs.start, "right") - 1
                listed = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(runs.start - first[row]), pa.array(runs.end - runs.start), pa.array(runs.period)], ["start", "length", "period"]),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(chunk.first, rows), pa.array(np.diff(first).astype(np.int64)), listed, _joined(chunk.data, start[kept], end[kept], left)],
                    ["key", "n_words", "runs", "collapsed"],
                )

    kind = source.schema["key"].dataType.simpleString()
    found = source.mapInArrow(words.freed(run), f"key {kind}, n_words long, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("key", key)
