"""Token ids of documents in flat memory-mapped files."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import texts, words
from marketloom.session import scratch_path

_KEPT_SEGMENTS = 600_000  # distinct segments a Python worker keeps the ids of
_NO_KEY = -(2**63)  # stands for a null key in the files

# Bytes after a space that are surely no white space: visible ASCII, and leads of U+00C0-07FF and U+4000 up.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE0] = True
_SOLID[0xE4:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)  # visible ASCII but letters and digits
_MARK[0x21:0x7F] = True
_MARK[0x30:0x3A] = False
_MARK &= ~_LETTER


def local_path(uri: str) -> str:
    """The path of a mounted folder; files in it can be memory-mapped by every executor."""
    if "://" in uri and not uri.startswith("file://"):
        raise ValueError(f"token files need a folder that is mounted everywhere, not {uri}")
    path = uri.removeprefix("file:")
    return "/" + path.lstrip("/") if path != uri else uri


class Encoder:
    """Byte-level BPE over segments, each distinct segment encoded once.

    The pre-tokeniser always starts a new piece at a space before a solid
    character, at a mark or line break after an ASCII letter, and at a letter
    after a lone line break, so texts may be cut there without a change of the
    ids. Of the segments kept, those met in one chunk only go when there are
    too many. With ``added``, strings of added tokens in a text get their ids,
    as in a plain call; texts that hold one are encoded whole.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.plain = Tokenizer.from_file(path) if added else None
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self._keep(np.empty(0, np.int64))

    def _keep(self, which: np.ndarray) -> None:
        if not len(which):
            self.place: dict[int, int] = {}
            self.ids = np.empty(0, np.uint32)
            self.size, self.begin, self.name, self.check, self.met = (np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int32))
            return
        size = self.size[which]
        total = np.cumsum(size)
        at = np.repeat(self.begin[which] - (total - size), size) + np.arange(total[-1])
        self.ids, self.size, self.begin = self.ids[at], size, total - size
        self.name, self.check, self.met = self.name[which], self.check[which], np.ones(len(which), np.int32)
        self.place = dict(zip(self.name.tolist(), range(len(which))))

    def _encoded(self, segments: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]

    def _add(self, names: np.ndarray, checks: np.ndarray, segments: list[str]) -> None:
        made = self._encoded(segments)
        size = np.array([len(x) for x in made], np.int64)
        self.place.update(zip(names.tolist(), range(len(self.size), len(self.size) + len(made))))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.ids = np.concatenate([self.ids, *made])
        self.size, self.name, self.check = np.concatenate([self.size, size]), np.concatenate([self.name, names]), np.concatenate([self.check, checks])
        self.met = np.concatenate([self.met, np.zeros(len(made), np.int32)])

    def _segments(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data), bool)
        before, here = data[:-1], data[1:]
        solid, line = _SOLID[here], before == 0x0A
        cut[:-1] = (before == 0x20) & solid
        letter = _LETTER[before]
        cut[1:] |= letter & (_MARK[here] | (here == 0x0A))
        cut[2:] |= line[1:] & solid[1:] & (_LETTER[data[:-2]] | _MARK[data[:-2]])
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def encode(self, chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of the chunk, and where each row's begin (one more at the end)."""
        ids, begin = self._by_segment(chunk)
        raw = chunk.data.tobytes() if self.added else b""
        if not any(x in raw for x in self.added):
            return ids, begin
        o = chunk.offsets.tolist()
        parts = [ids[a:b] for a, b in zip(begin, begin[1:])]
        for i, text in enumerate(raw[a:b] for a, b in zip(o, o[1:])):
            if any(x in text for x in self.added):
                parts[i] = np.array(self.plain.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _by_segment(self, chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of the chunk, and where each row's begin (one more at the end)."""
        data, offsets = chunk.data, chunk.offsets
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(self.size) > _KEPT_SEGMENTS:
            again = np.flatnonzero(self.met > 1)
            self._keep(again if len(again) < _KEPT_SEGMENTS // 2 else np.empty(0, np.int64))
        start = self._segments(data, offsets)
        end = np.append(start[1:], len(data))
        one, two = words.span_hashes(data, start, end), words.span_hashes(data, start, end, again=True)
        code, name = pd.factorize(one)
        first = np.empty(len(name), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        raw = data.tobytes()
        known = np.array([self.place.get(k, -1) for k in name.tolist()], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.size), len(self.size) + len(new))
            self._add(name[new], two[first[new]], [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
        self.met[known] += 1
        known = known[code]
        if not np.array_equal(self.check[known], two):  # two segments of one hash: no use of what is kept
            made = self._encoded([raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist())])
            total = np.concatenate([[0], np.cumsum([len(x) for x in made])])
            return np.concatenate(made), total[np.searchsorted(start, offsets)]
        size = self.size[known]
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.begin[known] - total[:-1], size) + np.arange(total[-1])
        return self.ids[at], total[np.searchsorted(start, offsets)]


@lru_cache(maxsize=1)
def _encoder(path: str, added: bool) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, added)


class Part(NamedTuple):
    part: int
    rows: int
    tokens: int


def write_token_files(
    df: DataFrame, tokenizer: str, end_id: int, folder: str, key: str = "doc_id", text: str = "text", width: int = 2, added: bool = False
) -> list[dict]:
    """Write the ids of every text in ascending key order; returns the manifest.

    Each part holds ``part-N.ids`` (unsigned little-endian integers of
    ``width`` bytes, 2 for up to 65,536 ids), ``part-N.offsets`` (64-bit: where each document begins in
    the part, and the end) and ``part-N.keys`` (64-bit keys; the smallest
    value stands for null, which comes first). Parts are ranges of keys in
    order; ``manifest.json`` has the ids and rows before each part, the prefix
    sums of the parts' counts. ``end_id`` ends every document; a null text is
    empty. Rows that agree in the key may lie in several parts. Files are
    written under another name and renamed, so a task that runs again leaves
    the same files. ``added`` gives strings of added tokens their ids, as the
    tokenizer's plain call does; else they are ordinary text. Ids that do not
    fit ``width`` are an error.
    """
    source, _ = texts.keyed(df, key, text)
    source = source.select(F.col("key").cast("long").alias("key"), "text")
    target = local_path(folder)
    os.makedirs(target, exist_ok=True)
    # Texts travel as they are: the sampling of key ranges reads them too, and would pack them once more.
    spread = source.withColumn("spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        stem = os.path.join(target, f"part-{part:06d}")
        kinds = ("ids", "offsets", "keys")
        files = {k: open(f"{stem}.{k}.{attempt}", "wb") for k in kinds}
        encoder, tokens, rows = _encoder(tokenizer, added), 0, 0
        if max(end_id, max(encoder.tokenizer.get_vocab(with_added_tokens=True).values())) >= 256**width:
            raise ValueError(f"ids of {tokenizer} do not fit {width} bytes")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                for chunk in words.chunks(piece.column("text")):
                    ids, begin = encoder.encode(chunk)
                    count = len(begin) - 1
                    out = np.full(len(ids) + count, end_id, f"<u{width}")
                    moved = begin + np.arange(count + 1)
                    own = np.ones(len(out), bool)
                    own[moved[1:] - 1] = False
                    out[own] = ids
                    files["ids"].write(out.tobytes())
                    files["offsets"].write((moved[:-1] + tokens).astype("<i8").tobytes())
                    tokens, rows = tokens + len(out), rows + count
                files["keys"].write(np.array(piece.column("key").fill_null(_NO_KEY), "<i8").tobytes())
        files["offsets"].write(np.array([tokens], "<i8").tobytes())
        for k in kinds:
            files[k].close()
            os.replace(f"{stem}.{k}.{attempt}", f"{stem}.{k}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "rows": pa.array([rows], pa.int64()), "tokens": pa.array([tokens], pa.int64())})

    counts = ranged.mapInArrow(words.freed(run), "part int, rows long, tokens long").collect()  # one row a part
    manifest, rows, tokens = [], 0, 0
    for x in sorted(counts):
        manifest.append({"part": x.part, "rows": x.rows, "tokens": x.tokens, "rows_before": rows, "tokens_before": tokens})
        rows, tokens = rows + x.rows, tokens + x.tokens
    with open(os.path.join(target, "manifest.json"), "w") as f:
        json.dump({"width": width, "end_id": end_id, "parts": manifest}, f)
    return manifest


def read_token_files(spark: SparkSession, folder: str, parts: int) -> DataFrame:
    """(key, start, tokens) of every document, from the memory-mapped files."""
    target = local_path(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(os.path.join(target, "manifest.json")) as f:
            manifest = json.load(f)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                part = manifest["parts"][i]
                if not part["rows"]:
                    continue
                stem = os.path.join(target, f"part-{part['part']:06d}")
                ids = np.memmap(f"{stem}.ids", f"<u{manifest['width']}", "r")
                offsets = np.memmap(f"{stem}.offsets", "<i8", "r")
                keys = np.memmap(f"{stem}.keys", "<i8", "r")
                a = 0
                while a < part["rows"]:  # as many documents as make up a batch
                    b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + 2_000_000, "right")) - 1)
                    own = np.asarray(offsets[a : b + 1])
                    flat = np.asarray(ids[own[0] : own[-1]]).astype(np.int64)
                    names = np.asarray(keys[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, mask=names == _NO_KEY),
                            pa.array(own[:-1] + part["tokens_before"]),
                            pa.ListArray.from_arrays(pa.array((own - own[0]).astype(np.int32)), pa.array(flat)),
                        ],
                        ["key", "start", "tokens"],
                    )
                    a = b

    return spark.range(0, parts, 1, max(1, parts)).mapInArrow(words.freed(run), "key long, start long, tokens array<long>")


def crc_of_tokens(df: DataFrame) -> DataFrame:
    """(key, start, n_tokens, ids_crc32): the ids digested as little-endian unsigned 32-bit integers."""
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("tokens")
            flat, ends = np.asarray(column.flatten()).astype("<u4"), np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths()))])
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                ["key", "start", "n_tokens", "ids_crc32"],
            )

    return df.mapInArrow(words.freed(run), "key long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
