"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import words
from marketloom.session import materialise, scratch_path

ORDER = 4
PART_GRAMS = 1 << 17  # grams of a file of the stored model, more if there would be over 2**_MOST_BITS files
_MOST_BITS = 10
_BLOCK = 250_000  # letters whose probabilities are looked up together
CALIBRATION_TEXTS = 100  # different texts of a language from which on their spread sets its rejection
UNKNOWN = "und"
_SPACE = 32
_STEP = np.uint64(0x9FB21C651E98DF25)


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point to its lower-case letter, anything but letters to a space."""
    out = np.full(0x110000, _SPACE, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


class Letters(NamedTuple):
    """Letters and single spaces of a chunk's rows, each row after ORDER - 1 spaces, and where rows begin."""

    code: np.ndarray
    first: np.ndarray


def letters(chunk: words.Chunk) -> Letters:
    data, offsets = chunk.data, chunk.offsets
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    at = leads[offsets]
    code = _folded()[points]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pad = ORDER - 1
    keep = code != _SPACE
    keep[1:] |= (code[:-1] != _SPACE) & (row[1:] == row[:-1])  # one space of a run, none at the start
    code, row = code[keep], row[keep]
    count = np.bincount(row, minlength=len(at) - 1)
    first = np.concatenate([[0], np.cumsum(count + pad)])
    out = np.full(first[-1], _SPACE, np.uint32)
    out[np.arange(len(code)) + pad * (row + 1)] = code
    return Letters(out, first)


def gram_keys(code: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each position from ``order - 1`` on, or of the rows of a matrix."""
    columns = code.T if code.ndim == 2 else [code[j : len(code) - order + 1 + j] for j in range(order)]
    total = np.full(len(columns[0]), order, np.uint64)
    for c in columns:
        total = total * _STEP + c
    return words.mix(total)


def _positions(first: np.ndarray) -> np.ndarray:
    """Which grams end at a letter or inner space of a row (not in the spaces before it)."""
    pad = ORDER - 1
    n = np.diff(first) - pad
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) - (np.cumsum(n) - n)[row] + first[:-1][row]


def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over whole texts of all rows, counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def merged(parts: list) -> tuple:
            key, code, n = (np.concatenate(x) for x in zip(*parts))
            key, at, back = np.unique(key, return_index=True, return_inverse=True)
            return key, code[at], np.bincount(back, n).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                _, code, n = merged(parts)
                grams = code.astype("<u4").tobytes().decode("utf-32-le")
                grams = [grams[i : i + ORDER] for i in range(0, len(grams), ORDER)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            names = batch.column("lang").to_pandas()
            for chunk in words.chunks(batch.column("text")):
                code, first = letters(chunk)
                where = _positions(first)
                key = gram_keys(code, ORDER)[where] if len(where) else np.empty(0, np.uint64)
                row = np.searchsorted(first, where, "right") - 1
                own = names.iloc[chunk.first : chunk.last].to_numpy()
                for name in set(own):
                    mine = (own == name)[row]
                    found, at, n = np.unique(key[mine], return_index=True, return_counts=True)
                    start = where[mine][at]
                    held.setdefault(name, []).append((found, code[start[:, None] + np.arange(ORDER)], n))
                    size += len(found)
            if size > 1_000_000:
                for name in held:
                    held[name] = [merged(held[name])]
                size = sum(len(x[0][0]) for x in held.values())
                if size > 500_000:
                    yield from out()
                    size = 0
        yield from out()

    source = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    return source.mapInArrow(words.freed(run), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Table(NamedTuple):
    """Sorted hashes, and a value of each language beside each."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of each hash, and whether it is there."""
        at, hit = self.find(keys)
        return self.values[at] if len(self.keys) else np.zeros((len(keys), self.values.shape[1])), hit


@lru_cache(maxsize=4 << _MOST_BITS)
def _mapped(path: str, kind: str, width: int) -> np.ndarray:
    found = np.asarray(np.memmap(path, kind, "r"))
    return found.reshape(-1, width) if width else found


class Parts(NamedTuple):
    """A table like ``Table`` in memory-mapped files; the first ``bits`` bits of a hash tell its file."""

    stem: str
    field: str
    bits: int
    width: int
    sizes: tuple[int, ...]

    def path(self, part: int, field: str) -> str:
        return f"{self.stem}-{part:04d}.{field}"

    def keys(self, part: int) -> np.ndarray:
        return _mapped(self.path(part, "keys"), "<u8", 0)

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of each hash (zeros if it is not there), and whether it is there."""
        out, hit = np.zeros((len(keys), self.width)), np.zeros(len(keys), bool)
        order = np.argsort(keys)
        keys = keys[order]
        bounds = np.searchsorted(_part_of(keys, self.bits), np.arange(len(self.sizes) + 1))
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            if not self.sizes[part]:
                continue
            own, mine, place = self.keys(part), keys[bounds[part] : bounds[part + 1]], order[bounds[part] : bounds[part + 1]]
            at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
            good = own[at] == mine
            place = place[good]
            out[place] = _mapped(self.path(part, self.field), "<f8", self.width)[at[good]]
            hit[place] = True
        return out, hit


def _part_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


class Model:
    """Kneser-Ney models of all languages over one alphabet.

    The highest order uses counts, lower orders the number of different
    letters seen before a gram; each order is discounted by n1 / (n1 + 2 n2)
    and interpolated with the next lower, the lowest with the uniform
    distribution. ``grams[k]`` holds log probabilities of order k + 1,
    interpolated in full, of every gram seen in any language; ``weights[k]``
    the log weight that a context of k letters leaves to the lower order.
    The constructor takes counts in memory; ``stored_model`` makes the same
    from counts of any size.
    """

    def __init__(self, langs: list[str], codes: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.langs = langs
        self.grams: list[Table] = []
        self.weights: list[Table] = []
        n_langs = len(langs)
        if not langs:
            return
        seen = [{} for _ in langs]
        for i, (code, count) in enumerate(zip(codes, counts)):
            seen[i][ORDER] = (code, count.astype(np.float64))
            for k in range(ORDER - 1, 0, -1):
                shorter = seen[i][k + 1][0][:, 1:]
                _, at, back = np.unique(gram_keys(shorter, k), return_index=True, return_inverse=True)
                seen[i][k] = (shorter[at], np.bincount(back).astype(np.float64))
        for k in range(1, ORDER + 1):
            code = np.concatenate([s[k][0] for s in seen])
            keys, at = np.unique(gram_keys(code, k), return_index=True)
            code = code[at]
            if k == 1:
                contexts, context_of = np.zeros(1, np.uint64), np.zeros(len(keys), np.int64)
                self.floor = -np.log(len(keys) + 1.0)
                lower = np.full((len(keys), n_langs), np.exp(self.floor))
            else:
                contexts, context_of = np.unique(gram_keys(code[:, :-1], k - 1), return_inverse=True)
                spot, _ = self.grams[-1].find(gram_keys(code[:, 1:], k - 1))
                lower = np.exp(self.grams[-1].values[spot])
            p, weight = np.empty((len(keys), n_langs)), np.ones((len(contexts), n_langs))
            for i, s in enumerate(seen):
                own = np.zeros(len(keys))
                own[np.searchsorted(keys, gram_keys(s[k][0], k))] = s[k][1]
                ones, twos = (own == 1).sum(), (own == 2).sum()
                discount = min(0.95, max(0.05, ones / max(1.0, ones + 2.0 * twos)))
                total = np.bincount(context_of, own, len(contexts))
                kinds = np.bincount(context_of, own > 0, len(contexts))
                known = total > 0
                weight[known, i] = discount * kinds[known] / total[known]
                share = np.maximum(own - discount, 0) / np.maximum(total, 1)[context_of]
                p[:, i] = share + weight[context_of, i] * lower[:, i]
            self.grams.append(Table(keys, np.log(p)))
            self.weights.append(Table(contexts, np.log(weight)))

    @classmethod
    def stored(cls, langs: list[str], floor: float, first: np.ndarray, grams: Parts, weights: Parts) -> Model:
        """A model in files; ``first`` has the log weights of the empty context. One table holds the grams of all orders."""
        model = cls([], [], [])
        model.langs, model.floor = langs, floor
        model.grams = [grams] * ORDER
        model.weights = [Table(np.zeros(1, np.uint64), first[None]), *[weights] * (ORDER - 1)]
        return model

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Natural log probability of the last letter of each row of codes, per language."""
        order = code.shape[1]
        out, hit = self.grams[order - 1].look(gram_keys(code, order))
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest = code[miss]
            if order == 1:
                out[miss] = self.weights[0].values[0] + self.floor
            else:
                weight, known = self.weights[order - 1].look(gram_keys(rest[:, :-1], order - 1))
                out[miss] = np.where(known[:, None], weight, 0.0) + self.log_p(rest[:, 1:])
        return out

    def entropies(self, chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per letter of each row under each language, and its number of letters and inner spaces."""
        code, first = letters(chunk)
        where = _positions(first)
        n = np.diff(first) - (ORDER - 1)
        total = np.zeros((len(n), len(self.langs)))
        if not len(where) or not self.langs:
            return total, n
        keys, done = gram_keys(code, ORDER)[where], np.concatenate([[0], np.cumsum(n)])
        row = 0
        while row < len(n):  # whole rows, so that a sum does not depend on the rows before
            last = max(row + 1, int(np.searchsorted(done, done[row] + _BLOCK, "right")) - 1)
            a, b = done[row], done[last]
            if a < b:
                value, hit = self.grams[-1].look(keys[a:b])
                miss = np.flatnonzero(~hit)
                if len(miss):
                    value[miss] = self.log_p(code[where[a:b][miss][:, None] + np.arange(ORDER)])
                full = row + np.flatnonzero(n[row:last])
                total[full] = np.add.reduceat(value, done[full] - a)
            row = last
        return -total / np.maximum(n, 1)[:, None], n

    def strange(self, chunk: words.Chunk, lang: np.ndarray) -> np.ndarray:
        """Share of each row's letters that the row's language, by number, was never seen with."""
        code, first = letters(chunk)
        where = _positions(first)
        row = np.searchsorted(first, where, "right") - 1
        own = code[where] != _SPACE
        row, letter = row[own], code[where][own]
        kinds, back = np.unique(letter, return_inverse=True)
        value, hit = self.grams[0].look(gram_keys(kinds[:, None], 1))
        unseen = ~hit[:, None] | (value <= self.weights[0].values[0] + self.floor + 1e-9)
        n = np.bincount(row, minlength=len(lang))
        return np.bincount(row, unseen[back, lang[row]], len(lang)) / np.maximum(n, 1)


def stored_model(counts: DataFrame, part_grams: int = PART_GRAMS) -> Model:
    """The model of all (lang, gram, n) in ``counts``, computed in tasks and kept in files of the shared folder.

    The folder has to be mounted on all executors, since the files are
    memory-mapped. The driver only sees a row for each language and order.
    Runs jobs.
    """
    from marketloom.llm.tokens import local_path

    spark = counts.sparkSession
    counts = materialise(counts, "language-counts")
    # Suffixes of the grams; then how many different grams end in each.
    shorter = counts.select("lang", F.explode(F.array(F.expr("substring(gram, 2)"), F.expr("substring(gram, 3)"))).alias("gram")).distinct()
    ends = counts.select("lang", "gram").unionByName(shorter).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    every = materialise(counts.unionByName(ends).withColumn("order", F.length("gram")), "language-orders")
    seen = every.groupBy("order", "lang").agg(
        F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"), F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")
    ).collect()
    langs = sorted({r.lang for r in seen})
    if not langs:
        return Model([], [], [])
    index, n_langs = {x: i for i, x in enumerate(langs)}, len(langs)
    discount, first, total_first = np.zeros((ORDER, n_langs)), np.zeros(n_langs), np.zeros(n_langs)
    for r in seen:
        i, d = index[r.lang], min(0.95, max(0.05, r.ones / max(1.0, r.ones + 2.0 * r.twos)))
        discount[r.order - 1, i] = d
        if r.order == 1:
            first[i], total_first[i] = d * r.kinds / r.total, r.total
    floor = -np.log(every.filter("order = 1").select("gram").distinct().count() + 1.0)
    parts = -(-sum(r.kinds for r in seen) // part_grams)
    bits = min(_MOST_BITS, max(0, (parts - 1).bit_length()))
    folder = local_path(scratch_path(spark, "language-model"))
    os.makedirs(folder)

    def level(k: int, grams: list[str], lang: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Shares of grams of one order, and weights of their contexts; grams are in order."""
        code = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, k)
        differ = code[1:] != code[:-1]
        new, fresh = np.ones(len(code), bool), np.ones(len(code), bool)
        new[1:], fresh[1:] = differ.any(axis=1), differ[:, :-1].any(axis=1)
        gram, context = np.cumsum(new) - 1, np.cumsum(fresh) - 1
        own = np.zeros((gram[-1] + 1, n_langs))
        own[gram, lang] = n
        if k == 1:
            total, of = total_first[None], np.zeros(len(own), np.int64)
        else:
            total, kinds = np.zeros((context[-1] + 1, n_langs)), np.zeros((context[-1] + 1, n_langs))
            np.add.at(total, (context, lang), n)
            np.add.at(kinds, (context, lang), 1.0)
            weight = np.where(total > 0, discount[k - 1] * kinds / np.maximum(total, 1), 1.0)
            of = context[new]
            yield rows(1, gram_keys(code[fresh][:, :-1], k - 1), np.zeros((context[-1] + 1, ORDER), np.uint32), np.log(weight))
        padded = np.zeros((len(own), ORDER), np.uint32)
        padded[:, ORDER - k :] = code[new]
        yield rows(0, gram_keys(code[new], k), padded, np.maximum(own - discount[k - 1], 0) / np.maximum(total, 1)[of])

    def rows(kind: int, keys: np.ndarray, code: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        flat = lambda x, size: pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(keys), [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary())
        signed = (keys ^ np.uint64(1 << 63)).view(np.int64)  # in the order of the hashes
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int32)), pa.array(_part_of(keys, bits).astype(np.int32)), pa.array(signed), flat(code.astype("<u4"), 4 * ORDER), flat(value.astype("<f8"), 8 * n_langs)],
            ["kind", "part", "key", "code", "value"],
        )

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None

        def done(df: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            for k, own in df.groupby("order"):
                yield from level(int(k), own.gram.tolist(), own.lang.map(index).to_numpy(), own.n.to_numpy(np.float64))

        for batch in batches:
            df = batch.to_pandas()
            if not len(df):
                continue
            df = df if held is None else pd.concat([held, df], ignore_index=True)
            last = (df.order == df.order.iloc[-1]) & (df.context == df.context.iloc[-1])  # may go on in the next batch
            held = df[last]
            yield from done(df[~last])
        if held is not None:
            yield from done(held)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        now, files, size = None, {}, 0

        def close() -> Iterator[pa.RecordBatch]:
            for path, f in files.items():
                f.close()
                os.replace(f"{path}.{attempt}", path)
            if now is not None:
                yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([size], pa.int64())], ["kind", "part", "rows"])

        for batch in batches:
            kind, part = np.asarray(batch.column("kind")).astype(np.int64), np.asarray(batch.column("part")).astype(np.int64)
            edges = np.flatnonzero(np.diff(kind) | np.diff(part)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(kind)]):
                if a == b:
                    continue
                if now != (kind[a], part[a]):
                    yield from close()
                    now, size = (kind[a], part[a]), 0
                    files = {p: open(f"{p}.{attempt}", "wb") for p in (f"{folder}/{('grams', 'weights')[kind[a]]}-{part[a]:04d}.{x}" for x in ("keys", "codes", "value"))}
                keys, codes, value = files.values()
                own = batch.slice(a, b - a)
                keys.write((np.asarray(own.column("key")).view(np.uint64) ^ np.uint64(1 << 63)).astype("<u8").tobytes())
                codes.write(b"".join(own.column("code").to_pylist()))
                value.write(b"".join(own.column("value").to_pylist()))
                size += b - a
        yield from close()

    context = F.expr("if(order = 1, gram, substring(gram, 1, order - 1))")
    # Rows of one gram or context are together, a context has a row for each letter and language at most.
    ordered = every.withColumn("context", context).repartition("order", "context").sortWithinPartitions("order", "context", "gram")
    made = ordered.mapInArrow(words.freed(shares), "kind int, part int, key long, code binary, value binary")
    files = made.repartition(2 << bits, "kind", "part").sortWithinPartitions("kind", "part", "key").mapInArrow(words.freed(write), "kind int, part int, rows long").collect()
    sizes = [[0] * (1 << bits) for _ in range(2)]
    for r in files:
        sizes[r.kind][r.part] = r.rows
    raw = Parts(f"{folder}/grams", "value", bits, n_langs, tuple(sizes[0]))
    weights = Parts(f"{folder}/weights", "value", bits, n_langs, tuple(sizes[1]))

    def interpolated(code: np.ndarray) -> np.ndarray:
        k = code.shape[1]
        share, _ = raw.look(gram_keys(code, k))
        if k == 1:
            return share + first * np.exp(floor)
        weight, known = weights.look(gram_keys(code[:, :-1], k - 1))
        return share + np.where(known[:, None], np.exp(weight), 1.0) * interpolated(code[:, 1:])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("id").to_pylist():
                if raw.sizes[part]:
                    codes = _mapped(raw.path(part, "codes"), "<u4", ORDER)
                    name = f"{raw.path(part, 'log')}.{TaskContext.get().taskAttemptId()}"
                    with open(name, "wb") as f:
                        for at in range(0, len(codes), 50_000):
                            code = codes[at : at + 50_000]
                            order, p = (code > 0).sum(axis=1), np.empty((len(code), n_langs))
                            for k in set(order.tolist()):
                                p[order == k] = interpolated(code[order == k][:, ORDER - k :])
                            f.write(np.log(p).astype("<f8").tobytes())
                    os.replace(name, raw.path(part, "log"))
            yield batch

    spark.range(0, 1 << bits, 1, 1 << bits).mapInArrow(words.freed(whole), "id long").collect()
    return Model.stored(langs, floor, np.log(first), raw._replace(field="log"), weights)


class Identifier(NamedTuple):
    """A model and, per language, the mean, spread per root letter and margin that rejection uses, and which have too few texts for that."""

    model: Model
    mean: np.ndarray
    spread: np.ndarray
    few: np.ndarray
    deviations: float
    margin: float

    def predict(self, chunk: words.Chunk) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each row."""
        h, n = self.model.entropies(chunk)
        rows = np.arange(len(n))
        if not self.model.langs:
            return [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n)), n == 0
        best = h.argmin(axis=1)  # the first of equal ones; languages are sorted
        low = h[rows, best]
        odds = np.exp(-(h - low[:, None]) * np.sqrt(np.maximum(n, 1))[:, None])
        score = np.where(n > 0, 1.0 / odds.sum(axis=1), 0.0)
        bound = self.mean[best] + self.deviations * self.spread[best] / np.sqrt(np.maximum(n, 1)) + self.margin
        bad = low > bound
        if self.few[best].any():
            bad = np.where(self.few[best], self.model.strange(chunk, best) > 0.5, bad)
        names = [self.model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())]
        return names, score, np.where(n > 0, low, 0.0), (n == 0) | bad


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang", deviations: float = 8.0, margin: float = 0.7
) -> Identifier:
    """Models of every language in ``labelled`` (null texts and languages are left out).

    Grams are counted over all rows, and the models hold every gram, in files
    of the shared folder (``stored_model``). Rejection is calibrated per
    language on all its labelled rows, each distinct text once: a text is
    rejected if its best cross-entropy exceeds that language's mean by
    ``deviations`` spreads over the root of its letters and ``margin`` nats.
    A language of fewer than ``CALIBRATION_TEXTS`` different texts has no
    spread to go by; only texts most of whose letters were never seen in it
    are rejected there. Runs jobs.
    """
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    model = stored_model(gram_counts(rows, "text", "lang"))
    langs = model.langs
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for chunk in words.chunks(batch.column("text")):
                h, n = model.entropies(chunk)
                own = np.array([index.get(x, -1) for x in names[chunk.first : chunk.last]])
                good = np.flatnonzero((n > 0) & (own >= 0))
                one, two = (words.span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:], again=x)[good].view(np.int64) for x in (False, True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[good].astype(np.int32)), pa.array(one), pa.array(two), pa.array(h[good, own[good]]), pa.array(n[good].astype(np.int64))],
                    ["lang", "one", "two", "h", "n"],
                )

    mean, spread, texts = np.zeros(len(langs)), np.zeros(len(langs)), np.zeros(len(langs), np.int64)
    if langs:
        scored = rows.filter("text is not null and lang is not null").mapInArrow(words.freed(run), "lang int, one long, two long, h double, n long")
        distinct = scored.groupBy("lang", "one", "two").agg(F.min("h").alias("h"), F.min("n").alias("n"))
        sums = distinct.groupBy("lang").agg(
            F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("h")).alias("nh"), F.sum(F.col("n") * F.col("h") * F.col("h")).alias("nhh")
        )
        for r in sums.collect():
            mean[r.lang], texts[r.lang] = r.nh / r.n, r.texts
            spread[r.lang] = np.sqrt(max(0.0, r.nhh - r.nh * r.nh / r.n) / r.texts)
    return Identifier(model, mean, spread, texts < CALIBRATION_TEXTS, deviations, margin)


def identify(df: DataFrame, identifier: Identifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, cross_entropy, rejected) of every row.

    ``lang_pred`` is the language of the lowest cross-entropy per letter, the
    first in name order if equal; ``und``, with score 0 and rejected, for null
    texts and texts without letters. ``score`` is the softmax of the negative
    cross-entropies times the root of the number of letters. Only the text is
    looked at; rows are independent of each other. Without any learned
    language all texts are ``und``, and those without letters are rejected.
    """
    from marketloom.llm import texts

    source, kind = texts.keyed(df, key, text)
    sent = df.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                names, score, low, rejected = sent.value.predict(chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(chunk.first, chunk.last - chunk.first), pa.array(names), pa.array(score), pa.array(low), pa.array(rejected)],
                    ["key", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    found = source.mapInArrow(words.freed(run), f"key {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")
    return found.withColumnRenamed("key", key)


def without_rejected(df: DataFrame, identifier: Identifier, text: str = "text") -> DataFrame:
    """The rows of ``df``, with all columns, that ``identify`` does not reject."""
    from marketloom.llm import texts

    names, (df, (text,)) = df.columns, texts.numbered(df, text)
    sent = df.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = [sent.value.predict(chunk)[3] for chunk in words.chunks(batch.column(text))]
            yield batch.filter(pa.array(~np.concatenate(rejected))) if rejected else batch

    return df.mapInArrow(words.freed(run), df.schema).toDF(*names)


def held_out(key: Column) -> Column:
    """Rows whose crc32 of the key as text leaves 2 modulo 4; they are not learned from."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
