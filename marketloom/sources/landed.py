"""Nested JSON pages that another job has landed, and the fallback rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom import schemas
from marketloom.functions import vocabulary as V
from marketloom.functions.columns import classify, flag, text_or_empty
from marketloom.session import materialise

Reader = Callable[[SparkSession, str], DataFrame]


def read_pages(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """All pages of a folder, one JSON document per file; partition folders become columns.

    A page is one request's answer (about a thousand records), so one file per
    document parallelises over pages.
    """
    return spark.read.schema(schema).options(multiLine=True, mode=mode).json(path)


def read_page_lines(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Pages landed as JSON lines: splittable, for big landing folders."""
    return spark.read.schema(schema).options(mode=mode).json(path)


def flatten_json(df: DataFrame, array_col: str, paths: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of ``array_col``; ``paths`` refer to the element as ``item``."""
    items = df.select(*keep, F.explode(array_col).alias("item"))
    return items.select(*keep, *[c.alias(name) for name, c in paths.items()])


def trial_paths() -> dict[str, Column]:
    """The 13 trial columns out of one registry study, each with its default."""
    section = F.col("item.protocolSection")
    ident, design = section["identificationModule"], section["designModule"]
    status, outcomes = section["statusModule"], section["outcomesModule"]
    names = lambda arr, f: F.transform(arr, lambda e: text_or_empty(e[f]))
    title = text_or_empty(ident["briefTitle"])
    year = F.substring(status["startDateStruct"]["date"], 1, 4).try_cast("int")
    return {
        "nct_id": text_or_empty(ident["nctId"]),
        "company": text_or_empty(section["sponsorCollaboratorsModule"]["leadSponsor"]["name"]),
        "molecule": classify(title, V.MOLECULE_RULES, V.MOLECULE_DEFAULT),
        "phase": text_or_empty(F.array_join(design["phases"], ",")),
        "indication": text_or_empty(F.array_join(section["conditionsModule"]["conditions"], " | ")),
        "status": text_or_empty(status["overallStatus"]),
        "start_year": F.coalesce(year, F.lit(0)),
        "enrollment": F.coalesce(design["enrollmentInfo"]["count"], F.lit(0).cast("bigint")),
        "title": title,
        "design": text_or_empty(F.array_join(names(design["studyDesignInfo"], "name"), ", ")),
        "endpoint": text_or_empty(F.get(outcomes["primaryOutcomeMeasures"], F.lit(0))["title"]),
        "recruitment": text_or_empty(F.array_join(design["recruitmentInfo"]["conditionList"], ", ")),
        "is_simulated": F.lit(0),
    }


def flatten_trials(pages: DataFrame) -> DataFrame:
    return flatten_json(pages, "studies", trial_paths())


def is_serious(c: Column, values: Sequence[str] | None = None) -> Column:
    """Seriousness of a report: any code that is not missing, empty or zero.

    ``values`` limits it to the codes that mean serious.
    """
    text = F.trim(c.cast("string"))
    if values is not None:
        return F.coalesce(text.isin(list(values)), F.lit(False))
    return F.coalesce(~text.isin("", "0", "false"), F.lit(False))


def event_rollup(
    df: DataFrame,
    keys: Sequence[str],
    array_col: str,
    term: Callable[[Column], Column],
    serious: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = V.REACTION_RULES,
    default: str = V.REACTION_DEFAULT,
    report_id: str | None = None,
) -> DataFrame:
    """Mentions and serious mentions per ``keys`` and reaction group.

    One report counts once per reaction it lists. ``report_id`` adds the number
    of distinct reports. Reactions are exploded and counted in the same stage,
    so only the small partial counts are shuffled.
    """
    kept = [*keys, *([report_id] if report_id else [])]
    mentions = df.select(*kept, serious.alias("_serious"), F.explode(array_col).alias("_reaction")).select(
        *kept, "_serious", classify(term(F.col("_reaction")), rules, default).alias("event_type")
    )
    counts = [F.count(F.lit(1)).alias("report_count"), F.sum(flag(F.col("_serious")).cast("bigint")).alias("serious_count")]
    if report_id:
        # Two levels: first per report, then per group; a distinct aggregate would expand the rows.
        per_report = mentions.groupBy(*keys, "event_type", report_id).agg(*counts)
        counts = [
            F.sum("report_count").alias("report_count"),
            F.sum("serious_count").alias("serious_count"),
            F.count(F.lit(1)).alias("distinct_reports"),
        ]
        mentions = per_report
    return mentions.groupBy(*keys, "event_type").agg(*counts)


def rollup_event_pages(pages: DataFrame, serious_values: Sequence[str] | None = None) -> DataFrame:
    """Adverse-event fact out of landed pages with partition columns year, substance."""
    reports = pages.select("year", F.initcap("substance").alias("molecule"), F.explode("results").alias("report"))
    rolled = event_rollup(
        reports.select("year", "molecule", "report", F.col("report.patient.reaction").alias("reactions")),
        ["year", "molecule"],
        "reactions",
        lambda r: r["reactionmeddrapt"],
        is_serious(F.col("report.serious"), serious_values),
    )
    return rolled.withColumn("is_simulated", F.lit(0))


# Error conditions that say the data is absent or broken, not that the cluster failed.
DATA_FAULTS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD")


def data_fault(error: Exception) -> str | None:
    """The condition of ``DATA_FAULTS`` that an error or one of its causes has."""
    text = str(error)  # of a failed job: with the causes
    return next((c for c in DATA_FAULTS if f"[{c}" in text), None)


def read_with_fallback(
    spark: SparkSession, primary: str, fallback: str, reader: Reader, fallback_reader: Reader | None = None
) -> DataFrame:
    """The primary source, or the whole fallback if the primary is missing, empty or malformed.

    The two are never mixed; ``_source`` says which one was taken and
    ``_reason`` why it was the fallback (the error condition, or ``EMPTY``).
    Any other error, such as a full disk or a lost cluster, is raised. The
    primary is read once, in full, and written to the shared folder before it
    is trusted, so a broken page found late still leads to the fallback and
    nothing is parsed twice. Runs a job.
    """
    try:
        df = materialise(reader(spark, primary), "landed")
        reason = "EMPTY" if df.isEmpty() else None
    except (PySparkException, Py4JJavaError) as error:
        reason = data_fault(error)
        if reason is None:
            raise
    if reason is None:
        return df.withColumns({"_source": F.lit("primary"), "_reason": F.lit(None).cast("string")})
    taken = (fallback_reader or reader)(spark, fallback)
    return taken.withColumns({"_source": F.lit("fallback"), "_reason": F.lit(reason)})


def ingest_trials(spark: SparkSession, landed: str, sample_csv: str) -> DataFrame:
    """Trials from landed registry pages, else from the sample file."""
    from marketloom.sources.delimited import read_csv

    return read_with_fallback(
        spark,
        landed,
        sample_csv,
        lambda s, p: flatten_trials(read_pages(s, p, schemas.TRIAL_PAGE)),
        lambda s, p: read_csv(s, p, schemas.FACT_TRIALS)[0],
    )


def ingest_events(spark: SparkSession, landed: str, sample_csv: str) -> DataFrame:
    """Adverse-event counts from landed pages, else from the sample file."""
    from marketloom.sources.delimited import scan_csv

    page = T.StructType([*schemas.EVENT_PAGE.fields, *schemas.EVENT_PARTITIONS.fields])
    return read_with_fallback(
        spark,
        landed,
        sample_csv,
        lambda s, p: rollup_event_pages(read_pages(s, p, page)),
        lambda s, p: scan_csv(s, p, schemas.FACT_EVENTS),
    )
