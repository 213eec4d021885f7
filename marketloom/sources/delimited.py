"""CSV in and out."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
POSITION = "_position"


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST", position: str | None = None
) -> DataFrame:
    """CSV with a header row, quoted fields and a fixed schema; bad rows raise.

    An empty field is NULL, quoted or not. ``position`` names a further column
    with each row's place in the input (``with_position``).
    """
    rows = (
        spark.read.schema(schema)
        .options(header=True, mode=mode, encoding="UTF-8", escape='"', enforceSchema=False)
        .csv(path)
    )
    return with_position(rows, position) if position else rows


def with_position(scan: DataFrame, name: str = POSITION) -> DataFrame:
    """A plain scan of files with each row's place: its file, its block in the file, and its order in the task.

    Positions compare as a reader that goes through the files by name would
    meet the rows: a task reads a block from front to back, and ids rise
    within a task. They are values like others, so they survive shuffles.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return scan.withColumn(name, place)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)`` rows of a CSV file or folder.

    With a header, columns are taken by name: their order is free, others may
    lie between them, and a missing one raises ``ValueError``. All files of a
    folder must have the same header, else the scan fails. A row with too many or too few fields, or with a value that does not fit
    its type, goes to the second table as text with its file; nothing is
    dropped. The fields are read as text and cast here: Spark's own parser only
    notices a bad value in columns the query reads, so the split would depend
    on what is selected later.
    """
    names = schema.fieldNames()
    layout = dict(header=header, encoding="UTF-8", escape='"')
    # Reads the first line only; a source without any line has no columns and no rows.
    present = (spark.read.options(**layout).csv(path).columns if header else []) or names
    missing = [n for n in names if n not in present]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in [*present, CORRUPT]])
    options = dict(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False, enforceSchema=not header)
    lines = spark.read.schema(as_text).options(**layout, **options).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    # Spark refuses a CSV scan that needs the corrupt column alone, so this
    # always-false term keeps one data column in the scan.
    bad = F.col(CORRUPT).isNotNull() | (F.length(F.coalesce(F.col(names[0]), F.lit(""))) < 0)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | (F.col(f.name).isNotNull() & typed[f.name].isNull())
    good = lines.filter(~bad).select(*[typed[n].alias(n) for n in names])
    raw = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*present)))
    return good, lines.filter(bad).select(raw.alias("raw_line"), F.col("_metadata.file_path").alias("file"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``scan_csv``, or no rows if there is nothing at ``path``."""
    try:
        return scan_csv(spark, path, schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_result(df: DataFrame, path: str, format: str = "csv") -> int:
    """Write a result table with a header row and return its number of rows; an empty one leaves ``path`` as it is.

    The rows are counted while they are written, so the plan runs once and
    nothing is kept. They go to a folder beside ``path`` first, which then
    takes its place. Runs a job.
    """
    counted = Observation()
    partial = f"{path}.{uuid.uuid4().hex}"
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    made, wanted = (jvm.org.apache.hadoop.fs.Path(p) for p in (partial, path))
    files, folder = wanted.getFileSystem(conf), wanted.getParent()
    had_folder = files.exists(folder)
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
    if format == "csv":
        writer.options(header=True, escape='"').csv(partial)
    else:
        writer.format(format).save(partial)
    rows = counted.get["rows"]
    if not rows:
        files.delete(made, True)
        if not had_folder and not files.listStatus(folder):
            files.delete(folder, False)
        return 0
    files.delete(wanted, True)
    if not files.rename(made, wanted):
        raise OSError(f"cannot rename {partial} to {path}")
    return rows
