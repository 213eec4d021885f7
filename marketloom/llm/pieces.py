"""Sampled SentencePiece segmentations: forward filtering, backward sampling; lossless decoding."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketloom.llm import words

_KEPT_SEGMENTS = 100_000  # distinct segments a worker keeps the lattices of; beyond, those met in one chunk only go
_CHUNK_BYTES = 250_000
_LONGEST = 1_024  # bytes of a segment whose lattice is kept; longer ones are gone through in blocks
_BLOCK = 65_536  # bytes of such a block
_BYTE_LOG_P = -20.0  # of each byte of a character without a piece
_GOLDEN = 0x9E3779B97F4A7C15


class Pieces:
    """The pieces of a model file as bytes, a space for the word mark, with log probabilities.

    A piece of rank r (by its score in the file) has a log probability of
    -ln(r + 2) up to a constant; ``temperature`` divides it. Control and
    unknown pieces are not used, nor are pieces that hold a line break or a
    space after another character, so that texts can be cut there.
    """

    def __init__(self, path: str, temperature: float) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.byte_id = np.zeros(256, np.int32)
        surfaces: dict[int, bytes] = {}
        n = model.get_piece_size()
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                surfaces[i] = bytes([int(piece[3:5], 16)])
            elif not model.is_control(i) and not model.is_unknown(i):
                surfaces[i] = piece.replace("▁", " ").encode()
        self.surface = [surfaces.get(i, b"") for i in range(n)]
        usable = [i for i in range(n) if surfaces.get(i) and not model.is_byte(i) and not _crosses(surfaces[i])]
        usable.sort(key=lambda i: -model.get_score(i))
        log_p = -np.log(np.arange(len(usable)) + 2.0)
        log_p -= np.log(np.exp(log_p).sum())
        self.log_p = np.full(n, -np.inf)
        self.log_p[usable] = log_p / temperature
        self.byte_log_p = _BYTE_LOG_P / temperature
        self.surface_size = np.array([len(x) for x in self.surface], np.int64)
        self.surface_first = np.cumsum(self.surface_size) - self.surface_size
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        # Every prefix of a usable piece, by length: hash and piece (-1 for a mere prefix).
        prefixes: list[dict[bytes, int]] = []
        for i in usable:
            s = self.surface[i]
            while len(prefixes) < len(s):
                prefixes.append({})
            for k in range(1, len(s)):
                prefixes[k - 1].setdefault(s[:k], -1)
            prefixes[len(s) - 1][s] = i
        self.tables = []
        for table in prefixes:
            raw = np.frombuffer(b"".join(table), np.uint8)
            size = len(next(iter(table)))
            at = np.arange(0, len(raw), size)
            keys = words.span_hashes(raw, at, at + size)
            order = np.argsort(keys)
            self.tables.append((keys[order], np.fromiter(table.values(), np.int32, len(table))[order]))


    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces in a row, and where each piece's begin (one more at the end)."""
        size = self.surface_size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.surface_bytes[np.repeat(self.surface_first[ids] - total[:-1], size) + np.arange(total[-1])], total


def _crosses(surface: bytes) -> bool:
    return b"\n" in surface or b" " in surface.lstrip(b" ") or surface[:2] == b"  " and surface.strip(b" ") != b""


class Sampler:
    """Lattices of distinct segments, and draws from them.

    A segment's lattice has a node at every byte; an arc is a piece, or all
    bytes of a character that is no piece. Forward filtering sums the weights
    of all ways to each node; each arc then has its probability given the
    node it ends at, from which backward sampling draws. Of a segment of over
    ``_LONGEST`` bytes only the sums are held, and its arcs are made again in
    blocks on the way back; the draw is from the lattice of all of it.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        # Segments by their first hash; places are bytes of all kept segments, each of which is a node after it.
        self.one, self.two = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.first, self.last = np.empty(0, np.int64), np.empty(0, np.int64)
        self.met = np.empty(0, np.int32)  # chunks
        self.bytes = np.empty(0, np.uint8)
        self.node_arc = np.zeros(1, np.int32)  # first arc of each node, one more at the end
        self.arc_size = np.empty(0, np.int32)  # bytes
        self.arc_sum = np.empty(0, np.float64)  # cumulative probability within the node
        self.arc_id = np.empty(0, np.int32)  # -n for a character of n bytes

    def _keep(self, which: np.ndarray) -> None:
        """Forget all segments but these."""
        size = self.last[which] - self.first[which] + 1
        end = np.cumsum(size)
        nodes = np.repeat(self.first[which] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
        count = np.diff(self.node_arc)[nodes]
        done = np.cumsum(count)
        arcs = np.repeat(self.node_arc[nodes] - (done - count), count) + np.arange(done[-1] if len(done) else 0)
        self.one, self.two, self.met = self.one[which], self.two[which], self.met[which]
        self.first, self.last = end - size, end - 1
        self.bytes = self.bytes[nodes]
        self.node_arc = np.concatenate([[0], done]).astype(np.int32)
        self.arc_size, self.arc_sum, self.arc_id = self.arc_size[arcs], self.arc_sum[arcs], self.arc_id[arcs]

    def _find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of each segment, -1 if it is not kept."""
        if not len(self.one):
            return np.full(len(one), -1)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)

    def _arcs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(from, to, piece, log weight) of all arcs; positions are bytes of ``data``."""
        n = len(data)
        sums, down = words.prefix_sums(data, words.symbols()), words.down(np.arange(n))
        limit = np.repeat(end, end - start)
        begins = (data & 0xC0) != 0x80
        live = np.flatnonzero(begins)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        char_end = np.append(live[1:], n)
        has_own = np.zeros(n, bool)
        next_char = np.zeros(n, np.int64)
        next_char[live] = char_end
        for size, (keys, ids) in enumerate(self.pieces.tables, 1):
            live = live[live + size <= limit[live]]
            if not len(live):
                break
            h = words.mix((sums[live + size] - sums[live]) * down[live])
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            live, at = live[hit], at[hit]
            whole = ids[at] >= 0
            a, i = live[whole], ids[at[whole]]
            found.append((a, a + size, i))
            has_own[a[next_char[a] == a + size]] = True
        lone = np.flatnonzero(begins & ~has_own)
        found.append((lone, next_char[lone], -(next_char[lone] - lone).astype(np.int32)))
        a, b, i = (np.concatenate(x) for x in zip(*found))
        return a, b, i, np.where(i >= 0, self.pieces.log_p[np.maximum(i, 0)], -i * self.pieces.byte_log_p)

    def _add(self, one: np.ndarray, two: np.ndarray, data: np.ndarray, size: np.ndarray) -> None:
        """Keep the segments of ``size`` bytes each that ``data`` holds one after another, none of which is kept yet."""
        end = np.cumsum(size)
        start = end - size
        a, b, piece, weight = self._arcs(data, start, end)
        segment_start = np.repeat(start, size)
        # Arcs by the distance of their end from the segment's start, then by node.
        depth = b - segment_start[b - 1]
        order = np.argsort((depth * (len(data) + 1) + b) * (_LONGEST + 8) + (b - a))
        a, b, piece, weight, depth = a[order], b[order], piece[order], weight[order], depth[order]
        alpha = np.full(len(data) + 1, -np.inf)  # of the node after byte j - 1, at j; starts are handled apart
        chance = np.empty(len(a))
        steps = np.searchsorted(depth, np.arange(1, depth[-1] + 2)) if len(depth) else [0]
        for lo, hi in zip(steps, steps[1:]):
            if lo == hi:
                continue
            x, y = a[lo:hi], b[lo:hi]
            value = np.where(x == segment_start[y - 1], 0.0, alpha[x]) + weight[lo:hi]
            new = np.ones(len(y), bool)
            new[1:] = y[1:] != y[:-1]
            group = np.flatnonzero(new)
            total = np.logaddexp.reduceat(value, group)
            alpha[y[group]] = total
            chance[lo:hi] = np.exp(value - np.repeat(total, np.diff(np.append(group, len(y)))))
        chance[np.isnan(chance)] = 0.0
        rare = ((1.0 - chance) * 2**20).astype(np.int64)
        order = np.argsort(((b << 21) + rare) * (_LONGEST + 8) + (b - a))  # likely arcs first
        a, b, piece, chance = a[order], b[order], piece[order], chance[order]
        per_node = np.bincount(b, minlength=len(data) + 1)[1:]
        first = np.cumsum(per_node) - per_node
        sums = np.cumsum(chance)
        sums -= np.repeat(np.where(first > 0, sums[np.maximum(first - 1, 0)], 0.0), per_node)
        before = len(self.bytes)
        self.node_arc = np.concatenate([self.node_arc[:-1], first + len(self.arc_id), [len(self.arc_id) + len(a)]]).astype(np.int32)
        self.arc_size = np.concatenate([self.arc_size, (b - a).astype(np.int32)])
        self.arc_sum = np.concatenate([self.arc_sum, sums])
        self.arc_id = np.concatenate([self.arc_id, piece.astype(np.int32)])
        self.bytes = np.concatenate([self.bytes, data])
        one, two = np.concatenate([self.one, one]), np.concatenate([self.two, two])
        order = np.argsort(one)
        self.one, self.two = one[order], two[order]
        self.first = np.concatenate([self.first, start + before])[order]
        self.last = np.concatenate([self.last, end - 1 + before])[order]
        self.met = np.concatenate([self.met, np.zeros(len(size), np.int32)])[order]

    def _draw(self, known: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each occurrence, by number of its segment, the arcs drawn from the start to the end, and their nodes."""
        place, arcs, nodes = [], [], []
        who = np.arange(len(known))
        node, first = self.last[known], self.first[known]
        step = 0
        while len(who):
            u = (words.mix(seed[who] + np.uint64(step * _GOLDEN % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            arc, stop = self.node_arc[node], self.node_arc[node + 1] - 1
            todo = np.flatnonzero((self.arc_sum[arc] <= u) & (arc < stop))
            while len(todo):
                arc[todo] += 1
                todo = todo[(self.arc_sum[arc[todo]] <= u[todo]) & (arc[todo] < stop[todo])]
            place.append(who)
            arcs.append(arc)
            nodes.append(node)
            node = node - self.arc_size[arc]
            on = node >= first
            who, node, first = who[on], node[on], first[on]
            step += 1
        # By occurrence, the last arc drawn first: each one's arcs go before those of the occurrences after it.
        count = np.zeros(len(known) + 1, np.int64)
        for who in place:
            count[who + 1] += 1
        end = np.cumsum(count)[1:]
        whose, out, at = np.empty(end[-1], np.int64), np.empty(end[-1], np.int64), np.empty(end[-1], np.int64)
        for k, (who, arc, node) in enumerate(zip(place, arcs, nodes), 1):
            spot = end[who] - count[who + 1] + (count[who + 1] - k)
            whose[spot], out[spot], at[spot] = who, arc, node
        return whose, out, at

    def _blocks(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Where blocks of a segment begin and end, between characters."""
        cuts = [0]
        while cuts[-1] < len(data):
            cut = min(cuts[-1] + _BLOCK, len(data))
            while cut < len(data) and (data[cut] & 0xC0) == 0x80:
                cut += 1
            cuts.append(cut)
        return list(zip(cuts, cuts[1:]))

    def _ending(self, data: np.ndarray, lo: int, hi: int) -> tuple[list, list, list, list]:
        """Arcs that end after ``lo`` and up to ``hi``, by end: from, to, piece, log weight."""
        low = max(0, lo - len(self.pieces.tables))  # no piece is longer
        while low and (data[low] & 0xC0) == 0x80:
            low -= 1
        part = data[low:hi]
        a, b, piece, weight = self._arcs(part, np.array([0]), np.array([len(part)]))
        own = np.flatnonzero(b > lo - low)
        own = own[np.lexsort((-weight[own], b[own]))]
        return (a[own] + low).tolist(), (b[own] + low).tolist(), piece[own].tolist(), weight[own].tolist()

    def _long(self, data: np.ndarray, seeds: list[int]) -> list[np.ndarray]:
        """Piece ids of a long segment, drawn once for each seed."""
        blocks = self._blocks(data)
        alpha = np.full(len(data) + 1, -np.inf)  # of the node after byte j - 1, at j
        alpha[0] = 0.0
        for lo, hi in blocks:
            low = max(0, lo - len(self.pieces.tables) - 4)
            sums = alpha[low : hi + 1].tolist()
            came, to, _, weight = self._ending(data, lo, hi)
            at = 0
            while at < len(to):
                y, first = to[at], at
                ways = []
                while at < len(to) and to[at] == y:
                    ways.append(sums[came[at] - low] + weight[at])
                    at += 1
                best = max(ways)
                sums[y - low] = best if at == first + 1 or best == -math.inf else best + math.log(sum(math.exp(x - best) for x in ways))
            alpha[lo + 1 : hi + 1] = sums[lo + 1 - low :]
        node = [len(data)] * len(seeds)
        step = [0] * len(seeds)
        drawn: list[list[int]] = [[] for _ in seeds]
        for lo, hi in reversed(blocks):
            low = max(0, lo - len(self.pieces.tables) - 4)
            sums = alpha[low : hi + 1].tolist()
            came, to, piece, weight = self._ending(data, lo, hi)
            begin = np.searchsorted(to, np.arange(lo + 1, hi + 2)).tolist()
            for i, seed in enumerate(seeds):
                y, n, out = node[i], step[i], drawn[i]
                values: list[float] = []
                used = 0
                while y > lo:
                    if used == len(values):
                        counter = np.arange(n, n + 256).astype(np.uint64) * np.uint64(_GOLDEN)
                        values = ((words.mix(np.uint64(seed) + counter) >> np.uint64(11)).astype(np.float64) * 2.0**-53).tolist()
                        used, n = 0, n + 256
                    u, total = values[used], sums[y - low]
                    used += 1
                    k, stop = begin[y - lo - 1], begin[y - lo] - 1
                    u -= math.exp(sums[came[k] - low] + weight[k] - total)
                    while u >= 0 and k < stop:
                        k += 1
                        u -= math.exp(sums[came[k] - low] + weight[k] - total)
                    if piece[k] >= 0:
                        out.append(piece[k])
                    else:
                        out.extend(self.pieces.byte_id[data[came[k] : y]][::-1].tolist())
                    y = came[k]
                node[i], step[i] = y, n
        return [np.array(x[::-1], np.int64) for x in drawn]

    def sample(self, chunk: words.Chunk, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all rows of the chunk, and where each row's begin (one more at the end)."""
        offsets = chunk.offsets
        rows = len(offsets) - 1
        # A space before each text, as the model file asks for.
        data = np.full(len(chunk.data) + rows, 0x20, np.uint8)
        row_of_byte = np.repeat(np.arange(rows), np.diff(offsets))
        data[np.arange(len(chunk.data)) + row_of_byte + 1] = chunk.data
        offsets = offsets + np.arange(rows + 1)
        if len(self.one) > _KEPT_SEGMENTS:
            kept = np.flatnonzero(self.met > 1)
            if len(kept) > _KEPT_SEGMENTS // 2:
                kept = np.sort(np.argsort(-self.met, kind="stable")[: _KEPT_SEGMENTS // 2])
            self._keep(kept)
        cut = np.zeros(len(data), bool)
        cut[:-1] = (data[:-1] == 0x20) & (data[1:] != 0x20)
        line = data == 0x0A
        cut |= line
        cut[1:] |= line[:-1]
        cut[offsets[:-1]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        one, two = words.span_hashes(data, start, end), words.span_hashes(data, start, end, again=True)
        code, _ = pd.factorize(one)
        first = np.empty(code.max() + 1, np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        if not np.array_equal(two, two[first][code]):  # two segments of one hash: take both hashes for one
            code, first = _both(one, two)
        one, two = one[first], two[first]
        long = end - start > _LONGEST
        short = np.flatnonzero(~long[first])
        new = short[self._find(one[short], two[short]) < 0]
        if len(new):
            at = first[new]
            size = end[at] - start[at]
            done = np.cumsum(size)
            self._add(one[new], two[new], data[np.repeat(start[at] - (done - size), size) + np.arange(done[-1])], size)
        known = self._find(one, two)
        self.met[known[known >= 0]] += 1
        long = known[code] < 0  # or, if ever, two segments of one hash
        row = np.searchsorted(offsets, start, "right") - 1
        nth = np.arange(len(start)) - np.searchsorted(start, offsets)[row]
        seed = words.mix(seeds[row] + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        short = np.flatnonzero(~long)
        out, owner = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(short):
            place, arcs, nodes = self._draw(known[code[short]], seed[short])
            piece = self.arc_id[arcs]
            count = np.where(piece < 0, -piece, 1)
            total = np.concatenate([[0], np.cumsum(count)])
            out, owner = np.repeat(piece, count), np.repeat(short[place], count)
            lone = np.flatnonzero(out < 0)
            if len(lone):
                arc = np.repeat(np.arange(len(arcs)), count)[lone]
                out[lone] = self.pieces.byte_id[self.bytes[nodes[arc] + 1 - count[arc] + lone - total[arc]]]
        if len(short) < len(start):
            outs, owners = [out], [owner]
            which = np.flatnonzero(long)
            for c in np.unique(code[which]).tolist():
                same = which[code[which] == c]
                for i, ids in zip(same.tolist(), self._long(data[start[same[0]] : end[same[0]]], seed[same].tolist())):
                    outs.append(ids)
                    owners.append(np.full(len(ids), i))
            owner = np.concatenate(owners)
            order = np.argsort(owner, kind="stable")
            out, owner = np.concatenate(outs)[order], owner[order]
        return out, np.searchsorted(owner, np.searchsorted(start, offsets))


def _both(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, code = np.unique(np.column_stack([one, two]), axis=0, return_index=True, return_inverse=True)
    return code.ravel(), first


@lru_cache(maxsize=1)
def _sampler(model: str, temperature: float) -> Sampler:
    """One for all tasks of a worker; what it keeps does not change what is drawn."""
    return Sampler(Pieces(model, temperature))


def row_seeds(keys: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit seed of each row from its key's text; null is a key like others."""
    named = keys.cast(pa.string()).fill_null("null")
    out = np.empty(len(keys), np.uint64)
    for chunk in words.chunks(named):
        out[chunk.first : chunk.last] = words.span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:])
    return words.mix(out + np.uint64(seed))


def encode(
    df: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0, temperature: float = 1.0, lossless: str | None = None
) -> DataFrame:
    """The rows of ``df``, with all columns, and ``pieces``, a sampled segmentation of the text.

    The draw depends on key, text, ``seed`` and ``temperature`` alone, so it
    is the same on every run and in any partitioning; rows of equal key and
    text get equal pieces. A low temperature tends to the likeliest
    segmentation. A null text has null pieces. ``lossless`` names a further
    column that tells whether the pieces decode to the text (of a null text:
    true). ``df`` must not have columns of these names. No shuffle.
    """
    added = [T.StructField("pieces", T.ArrayType(T.IntegerType()))]
    added += [T.StructField(lossless, T.BooleanType())] if lossless else []
    if clash := {f.name for f in added} & set(df.columns):
        raise ValueError(f"the input has columns {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(model, temperature)
        table = sampler.pieces
        for batch in batches:
            seeds = row_seeds(batch.column(key), seed)
            for chunk in words.chunks(batch.column(text), _CHUNK_BYTES):
                ids, begin = sampler.sample(chunk, seeds[chunk.first : chunk.last])
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=part.column(text).is_null())
                columns = [*part.columns, lists]
                if lossless:
                    columns.append(pa.array(_decodes(table, ids, begin, chunk)))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *(f.name for f in added)])

    return df.mapInArrow(words.freed(run), T.StructType([*df.schema.fields, *added]))


def _decodes(table: Pieces, ids: np.ndarray, begin: np.ndarray, chunk: words.Chunk) -> np.ndarray:
    """Whether each row's pieces are its text with a space before it."""
    raw, total = table.joined(ids)
    at = total[begin]
    good = np.diff(at) == np.diff(chunk.offsets) + 1
    for i in np.flatnonzero(good).tolist():
        a, o = at[i], chunk.offsets[i]
        n = chunk.offsets[i + 1] - o
        good[i] = raw[a] == 0x20 and np.array_equal(raw[a + 1 : a + 1 + n], chunk.data[o : o + n])
    return good


def decode(df: DataFrame, model: str, pieces: str = "pieces", to: str = "decoded") -> DataFrame:
    """The rows of ``df``, with all columns, and the text of their pieces; null pieces give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _sampler(model, 1.0).pieces
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(pieces)
                raw, total = table.joined(np.asarray(column.flatten()))
                per_row = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
                ends = total[np.concatenate([[0], np.cumsum(per_row)])].tolist()
                null = column.is_null().to_pylist()
                out = [None if x else raw[a + 1 : b].tobytes().decode() for a, b, x in zip(ends, ends[1:], null)]  # without the space before
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, to])

    return df.mapInArrow(words.freed(run), T.StructType([*df.schema.fields, T.StructField(to, T.StringType())]))
