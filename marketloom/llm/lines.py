"""Repeated runs of lines, by overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm import texts


def _windows(df: DataFrame, key: str, width: int) -> DataFrame:
    """Position and 128-bit hash of every window of ``width`` lines of each text."""

    def hashed(i: Column) -> Column:
        own = [F.col("__lines")[i + j] for j in range(width)]
        return F.struct(i.alias("__at"), F.xxhash64(*own).alias("__h1"), F.xxhash64(F.lit(width), *reversed(own)).alias("__h2"))

    long_enough = df.filter(F.size("__lines") >= width)
    windows = F.transform(F.sequence(F.lit(0), F.size("__lines") - width), hashed)
    return long_enough.select(F.col(key).alias("__key"), "__print", F.inline(windows))


def without_repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, n_lines: str = "n_lines", n_removed: str = "n_removed"
) -> DataFrame:
    """The rows with ``n_lines``, ``n_removed`` and the text without later copies of line windows.

    Lines are what ``\\n`` separates, compared as they are. Every ``width``
    consecutive lines of a text are a window; of equal windows in all texts
    the first in order of key and position stays, and the lines of all later
    ones go: covered positions are merged, and the lines left are joined
    again. Windows are judged on the texts as they are given, so a line in
    both a first and a later window goes. Texts of fewer lines stay whole; a
    null text has no lines and stays null; a text with all lines covered
    becomes empty. A null key comes before all others. Rows that agree in key
    and text count as one text. All columns of ``df`` are kept, whatever their
    names, the text replaced; those called like the two counts give way to them.
    """
    names, (plain, (key, text)) = df.columns, texts.numbered(df, key, text)
    docs = plain.withColumn("__print", F.xxhash64(text)).withColumn("__lines", F.split(F.col(text), "\n", -1))
    windows = _windows(docs.select(key, "__print", "__lines"), key, width)
    place = F.struct("__key", "__print", "__at")
    firsts = windows.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"), F.min(place).alias("__first")).filter("__n > 1").drop("__n")
    later = windows.join(firsts, ["__h1", "__h2"]).filter(~place.eqNullSafe(F.col("__first")))
    covered = later.groupBy("__key", "__print").agg(F.flatten(F.collect_list(F.sequence("__at", F.col("__at") + (width - 1)))).alias("__covered"))
    covered = covered.withColumnRenamed("__print", "__same")
    joined = docs.join(covered, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__print") == F.col("__same")), "left")
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    kept = F.when(F.col("__covered").isNull(), every).otherwise(F.array_except(every, "__covered"))
    joined = joined.withColumn("__kept", F.when(F.col(text).isNotNull(), kept))
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size("__lines"))
    left = F.array_join(F.transform("__kept", lambda i: F.col("__lines")[i]), "\n")
    columns = [
        F.when(F.col("__covered").isNull(), F.col(text)).otherwise(left).alias(n) if c == text else F.col(c).alias(n)
        for c, n in zip(plain.columns, names)
        if n.lower() not in (n_lines.lower(), n_removed.lower())
    ]
    gone = F.when(F.col("__covered").isNull(), 0).otherwise(F.size("__lines") - F.size("__kept"))
    return joined.select(*columns, count.cast("long").alias(n_lines), gone.cast("long").alias(n_removed))
