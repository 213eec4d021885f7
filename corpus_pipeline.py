"""The corpus pipeline: language, repeated lines, near duplicates, benchmark items, pieces.

Each stage works on all documents that the one before kept. All stages but the
last return the columns of ``documents``, further ones among them, whatever
their names. Null texts have no letters, lines or words; very long texts are
taken whole; an empty table stays empty. Rows that agree in id and text count as
one text for lines, and one of them stays among near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import contained, language, lines, near, pieces, texts
from marketloom.llm.queries import table, tokenizer_file
from marketloom.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that no learned language fits, those without letters among them.

    Models are learned from the labelled documents that are not held out; with
    none of those nothing can be judged, and all documents without letters go.
    """
    identifier = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.without_rejected(docs, identifier)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of three consecutive lines; documents left without a line go.

    The first copy in order of id stays; ``n_chars``, if there, is that of the text left.
    """
    total, gone = texts.unused(docs, "n_lines", "n_removed")
    found = lines.without_repeated_lines(docs, n_lines=total, n_removed=gone).filter((F.col(gone) == 0) | (F.col(gone) < F.col(total)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.drop(total, gone)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return near.keep_one(docs)


def no_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that contain a benchmark item."""
    return contained.without_contained(docs, table(spark, sf_dir, "benchmark"))


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a sampled segmentation, and whether it decodes to the text."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), seed=1, lossless="lossless")


STAGES = [
    ("language", known_language),
    ("lines", fresh_lines),
    ("near_duplicates", distinct_documents),
    ("benchmark", no_benchmark_items),
    ("pieces", sampled_pieces),
]

# Models, sketches and sampling have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
