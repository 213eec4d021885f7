"""Documents inside tasks: chunks with word hashes, fingerprints, and compressed texts for shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm import words


def keyed(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """Columns ``key`` and ``text`` alone, and the key's type."""
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return source, source.schema["key"].dataType.simpleString()


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called c0, c1 and so on, and the new names of ``names``.

    No name of a caller can then clash with one that an operator uses inside.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    places = [df.columns.index(n) if n in df.columns else [c.lower() for c in df.columns].index(n.lower()) for n in names]
    return plain, [f"c{i}" for i in places]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each after as many underscores as it takes to be none of ``df``'s."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def documents(batch: pa.RecordBatch) -> Iterator[tuple[words.Chunk, words.Words, np.ndarray, np.ndarray]]:
    """Chunks with words, word hashes and a fingerprint of each text."""
    for chunk in words.chunks(batch.column("text")):
        found = words.split(chunk)
        hashes = words.span_hashes(chunk.data, found.start, found.end)
        prints = words.span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:])
        yield chunk, found, hashes, prints


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64))


def packed(source: DataFrame, kind: str) -> DataFrame:
    """Each text compressed, with its fingerprint; what is shuffled instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                prints = words.span_hashes(chunk.data, chunk.offsets[:-1], chunk.offsets[1:])
                o, raw = chunk.offsets.tolist(), chunk.data.tobytes()
                packed = [squeeze.compress(raw[i:j]) for i, j in zip(o, o[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(chunk.first, chunk.last - chunk.first), signed(prints), pa.array(packed, pa.binary())],
                    ["key", "print", "packed"],
                )

    return source.mapInArrow(words.freed(run), f"key {kind}, print long, packed binary")


def printed(df: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with a fingerprint of the text, the one that ``packed`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [words.span_hashes(c.data, c.offsets[:-1], c.offsets[1:]) for c in words.chunks(batch.column(text))]
            own = signed(np.concatenate(prints)) if prints else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, name])

    return df.mapInArrow(words.freed(run), T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def unpacked(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch a few rows at a time, with the texts."""
    loosen = zstandard.ZstdDecompressor()
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield part, [loosen.decompress(x.as_py()) for x in part.column("packed")]


