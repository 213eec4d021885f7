"""Rule-based features, median fill and standardisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.functions.columns import contains_any, flag, max_digit, text_or_empty
from marketloom.operators import text as text_ops

FlagRule = tuple[str, Sequence[str], Sequence[str]]


def rule_flag(columns: Sequence[str], keywords: Sequence[str]) -> Column:
    """1 where one of the columns, joined by blanks, holds a keyword."""
    joined = F.concat_ws(" ", *[F.lower(text_or_empty(F.col(c))) for c in columns])
    return flag(contains_any(joined, keywords))


def rule_features(df: DataFrame, flags: Sequence[FlagRule], numeric: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with one 0/1 column per rule (name, columns, keywords) and the numeric ones."""
    columns = {name: rule_flag(cols, words) for name, cols, words in flags}
    return df.withColumns({**columns, **(numeric or {})})


def duration_days(
    indication: Column,
    phase: Column,
    months: Sequence[tuple[str, float]] = V.DURATION_MONTHS,
    default: float = V.DURATION_DEFAULT_MONTHS,
    factors: Sequence[tuple[float, Sequence[str]]] = V.DURATION_FACTORS,
) -> Column:
    """Expected days: months of the first digit found in the phase, times factors."""
    chain = None
    for digit, value in months:
        hit = text_or_empty(phase).contains(digit)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    days = chain.otherwise(F.lit(default))
    lowered = F.lower(text_or_empty(indication))
    for factor, words in factors:
        days = days * F.when(contains_any(lowered, words), F.lit(factor)).otherwise(F.lit(1.0))
    return days * F.lit(V.DAYS_PER_MONTH)


def median_value(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """One row with the median of the whole numbers between ``low`` and ``high``.

    Values are counted first, so the exact median sees at most
    ``high - low`` weighted values.
    """
    value = F.col(column).cast("int")
    counts = df.filter((value > low) & (value < high)).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.floor(F.percentile(F.col("v"), F.lit(0.5), F.col("n"))).cast("int").alias("median"))


def fill_median(
    df: DataFrame,
    column: str,
    low: int = V.YEAR_LOW,
    high: int = V.YEAR_HIGH,
    default: int = V.YEAR_DEFAULT,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Replace missing values and those outside (low, high) by the median.

    ``fit_on`` takes the median from other rows, such as the training split;
    ``default`` is used if no value is valid.
    """
    median = median_value(df if fit_on is None else fit_on, column, low, high).scalar()
    value = F.col(column).cast("int")
    valid = (value > low) & (value < high)
    return df.withColumn(column, F.when(valid, value).otherwise(F.coalesce(median, F.lit(default))))


def with_label(trials: DataFrame) -> DataFrame:
    """Trials that have a status, with ``label`` 1 for completed ones."""
    known = trials.filter(F.trim(text_or_empty(F.col("status"))) != "")
    return known.withColumn("label", flag(F.lower(F.trim("status")) == V.COMPLETED))


def trial_features(
    trials: DataFrame,
    flags: Sequence[FlagRule] = V.TRIAL_FLAGS,
    with_text: bool = True,
    max_features: int = 10,
    fit_on: DataFrame | None = None,
    normalize: bool = False,
) -> DataFrame:
    """Model inputs of trials: ids, 17 base features, text features, ``label``.

    Trials without a status are left out. ``fit_on`` limits the year median and
    the vocabulary to training rows. ``normalize`` also sees phase codes such
    as ``PHASE3``, which the plain keyword rule misses.
    """
    fitted = trials if fit_on is None else fit_on
    filled = fill_median(with_label(trials), "start_year", fit_on=fitted)
    if normalize:
        spaced = F.regexp_replace(F.lower(text_or_empty(F.col("phase"))), r"phase[\s_-]*", "phase ")
        filled = filled.withColumn("phase", spaced)
    numeric = {
        "phase_depth": max_digit(F.col("phase")),
        "log_enrollment": F.log1p(F.coalesce(F.col("enrollment").cast("double"), F.lit(0.0))),
        "log_duration_days": F.log1p(duration_days(F.col("indication"), F.col("phase"))),
    }
    featured = rule_features(filled, flags, numeric)
    names = list(V.TRIAL_FEATURES)
    if with_text:
        vocab = text_ops.tfidf_fit(fitted, "title", max_features)
        featured = text_ops.tfidf_columns(featured, "title", vocab, max_features)
        featured = text_ops.text_complexity(featured, "title", "design", "endpoint")
        featured = text_ops.language_flags(featured, "recruitment")
        names += text_ops.text_feature_names(max_features)
    return featured.select("nct_id", *names, "label")


def trial_feature_names(with_text: bool = True, max_features: int = 10) -> list[str]:
    return [*V.TRIAL_FEATURES, *(text_ops.text_feature_names(max_features) if with_text else [])]


def zscore_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean and the population deviation of each column."""
    return df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"sd_{c}") for c in columns],
    )


def zscore_apply(df: DataFrame, stats: DataFrame, columns: Sequence[str], eps: float | None = None) -> DataFrame:
    """Standardise ``columns`` in place with the row of ``zscore_fit``.

    A column without variance is divided by 1; with ``eps`` every deviation is
    raised by it instead.
    """
    fitted = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    scaled = {}
    for c in columns:
        sd = F.col(f"_stats.sd_{c}")
        width = sd + F.lit(eps) if eps is not None else F.when(sd > 0, sd).otherwise(F.lit(1.0))
        scaled[c] = (F.col(c).cast("double") - F.col(f"_stats.mean_{c}")) / width
    return df.withColumn("_stats", fitted).withColumns(scaled).drop("_stats")
