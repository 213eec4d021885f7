"""Text mining: keyword counts, TF-IDF, complexity and language features.

Everything per document is a column expression. The only shuffles are the
counts of ``top_keywords`` and ``tfidf_fit``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.functions.columns import (
    blank_to_null,
    clamp,
    contains_any,
    flag,
    hyphen_tokens,
    keyword_hits,
    keyword_score,
    plain_tokens,
    text_or_empty,
)
from marketloom.operators.reshape import top_per_group


def top_keywords(
    df: DataFrame,
    text: str,
    scope: str,
    k_all: int = 15,
    k_scope: int = 8,
    stopwords: Sequence[str] = V.KEYWORD_STOPWORDS,
    missing_scope: str = "other",
) -> DataFrame:
    """Most frequent words over all rows (scope ``ALL``) and per scope.

    Words are counted once per (scope, word); the overall counts are summed
    from those, so the exploded words are shuffled once. Ties go to the
    alphabetically first word.
    """
    scoped = F.coalesce(blank_to_null(F.col(scope)), F.lit(missing_scope))
    words = df.select(scoped.alias("scope"), F.explode(hyphen_tokens(F.col(text), stopwords)).alias("keyword"))
    counts = words.groupBy("scope", "keyword").agg(F.count(F.lit(1)).alias("count"))
    order = [F.desc("count"), F.asc("keyword")]
    overall = counts.groupBy("keyword").agg(F.sum("count").alias("count")).orderBy(*order).limit(k_all)
    per_scope = top_per_group(counts, "scope", order, k_scope)
    return overall.select(F.lit("ALL").alias("scope"), "keyword", "count").unionByName(
        per_scope.select("scope", "keyword", "count")
    )


def tfidf_fit(
    df: DataFrame,
    text: str,
    max_features: int = 50,
    min_df: int = 2,
    stopwords: Sequence[str] = V.TFIDF_STOPWORDS,
) -> DataFrame:
    """Vocabulary (position, term, df, idf): the ``max_features`` most frequent terms.

    ``idf = ln(N / (1 + df))`` with N all rows, those without a term included.
    Ties go to the alphabetically first term. One scan and one shuffle: every
    row also gives a null term, whose count is N.
    """
    terms = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(plain_tokens(F.col(text), stopwords)))
    counts = df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    is_total = F.col("term").isNull()
    frequent = (
        counts.filter(is_total | (F.col("df") >= min_df))
        .orderBy(is_total.desc(), F.desc("df"), "term")
        .limit(max_features + 1)
    )
    # The windows see the limited vocabulary and the total only.
    position = F.row_number().over(Window.orderBy(is_total.desc(), F.desc("df"), "term")) - 2
    n_docs = F.first(F.when(is_total, F.col("df")), ignorenulls=True).over(Window.partitionBy(F.lit(0)))
    idf = F.log(n_docs.cast("double") / (F.lit(1.0) + F.col("df")))
    return frequent.select(position.alias("position"), "term", "df", idf.alias("idf")).filter("term is not null")


def _vocabulary(vocab: DataFrame) -> Column:
    """The vocabulary as one array with a mark per term; ``tfidf_fit`` bounds its size.

    A mark is the term, a blank and the position. Tokens are made of ``a-z0-9``
    only, so a mark sorts right behind the tokens equal to its term.
    """
    mark = F.concat("term", F.lit(" "), F.col("position").cast("string"))
    entries = F.sort_array(F.collect_list(F.struct("position", "term", "idf", mark.alias("mark"))))
    return vocab.agg(entries.alias("entries")).scalar()


def _counted(df: DataFrame, text: str, stopwords: Sequence[str], vocab: DataFrame) -> DataFrame:
    """``df`` with ``_entries``: (term, tfidf, present) of the vocabulary, in its order.

    A row's tokens are sorted together with the vocabulary's marks. Where runs
    of equal words begin, the run before a mark holds the tokens of its term,
    or else the term is absent: one sort counts all terms.
    """
    keep = df.columns
    tokens = df.select(*keep, plain_tokens(F.col(text), stopwords).alias("_tokens"), _vocabulary(vocab).alias("_vocabulary"))
    merged = tokens.select(
        *keep,
        "_vocabulary",
        F.greatest(F.size("_tokens"), F.lit(1)).alias("_n"),
        F.sort_array(F.concat("_tokens", F.col("_vocabulary")["mark"])).alias("_words"),
    )
    begins = F.transform("_words", lambda w, i: F.when(~w.eqNullSafe(F.get("_words", i - 1)), i))
    runs = merged.withColumn("_begins", F.array_compact(begins))

    def run(begin: Column, i: Column) -> Column:
        before = F.get("_begins", i - 1)
        parts = F.split(F.get("_words", begin), " ")
        length = F.when(F.get("_words", before) == parts[0], begin - before).otherwise(0)
        return F.struct(F.get(parts, F.lit(1)).cast("int").alias("position"), length.alias("length"))

    is_mark = lambda begin: F.get("_words", begin).contains(" ")
    places = F.transform("_begins", lambda begin, i: F.when(is_mark(begin), run(begin, i)))
    terms = runs.select(*keep, "_vocabulary", "_n", F.sort_array(F.array_compact(places)).alias("_terms"))

    def score(entry: Column, found: Column) -> Column:
        tf = found["length"].cast("double") / F.col("_n")
        return F.struct(entry["term"].alias("term"), (tf * entry["idf"]).alias("tfidf"), (found["length"] > 0).alias("present"))

    return terms.select(*keep, F.zip_with("_vocabulary", "_terms", score).alias("_entries"))


def tfidf_transform(
    df: DataFrame, ids: Sequence[str], text: str, vocab: DataFrame, stopwords: Sequence[str] = V.TFIDF_STOPWORDS
) -> DataFrame:
    """Long table (ids, term, tfidf) of the vocabulary terms each row contains.

    Term frequency is relative to the words kept after stop-word removal. Runs
    within each row: the bounded vocabulary travels as one literal array, and
    no word is shuffled.
    """
    entries = _counted(df.select(*ids, text), text, stopwords, vocab)
    scored = entries.select(*ids, F.explode(F.filter("_entries", lambda e: e["present"])).alias("e"))
    return scored.select(*ids, "e.term", "e.tfidf")


def tfidf_columns(
    df: DataFrame, text: str, vocab: DataFrame, width: int, stopwords: Sequence[str] = V.TFIDF_STOPWORDS, prefix: str = "tfidf_"
) -> DataFrame:
    """``df`` with ``width`` dense columns, 0 where a term or a position is absent."""
    entries = _counted(df, text, stopwords, vocab)
    dense = [F.coalesce(F.get("_entries", F.lit(i))["tfidf"], F.lit(0.0)).alias(f"{prefix}{i}") for i in range(width)]
    return entries.select(*df.columns, *dense)


COMPLEXITY_COLUMNS = (
    "title_length", "design_length", "endpoint_length", "total_text_length",
    "complexity_score", "complexity_keyword_count", "avg_sentence_length", "medical_term_density",
)


def text_complexity(
    df: DataFrame,
    title: str,
    design: str,
    endpoint: str,
    weights: Mapping[str, int] = V.COMPLEXITY_WEIGHTS,
    terms: Sequence[str] = V.MEDICAL_TERMS,
) -> DataFrame:
    """``df`` with the eight complexity features of three texts.

    The total length is that of the texts alone, the term density is per
    hundred characters of the texts joined by blanks.
    """
    parts = [text_or_empty(F.col(c)) for c in (title, design, endpoint)]
    keep = df.columns
    joined = df.withColumn("_joined", F.concat_ws(" ", *parts)).withColumn("_lower", F.lower("_joined"))
    lengths = [F.length(p) for p in parts]
    total = lengths[0] + lengths[1] + lengths[2]
    sentences = F.greatest(F.regexp_count("_joined", F.lit("[.!?;]")), F.lit(1))
    hundreds = F.greatest(F.length("_joined") / F.lit(100.0), F.lit(1.0))
    values = [
        *lengths,
        total,
        keyword_score(F.col("_lower"), weights),
        keyword_hits(F.col("_lower"), list(weights)),
        total / sentences,
        keyword_hits(F.col("_lower"), terms) / hundreds,
    ]
    return joined.select(*keep, *[v.alias(n) for n, v in zip(COMPLEXITY_COLUMNS, values)])


LANGUAGE_COLUMNS = ("urgent_language", "global_scope", "selective_criteria", "recruitment_simplicity")


def language_flags(
    df: DataFrame,
    text: str,
    urgent: Sequence[str] = V.URGENT_WORDS,
    worldwide: Sequence[str] = V.GLOBAL_WORDS,
    selective: Mapping[str, int] = V.SELECTIVE_WEIGHTS,
    simple: Sequence[str] = V.SIMPLE_WORDS,
) -> DataFrame:
    """``df`` with four recruitment-language features; all zero for empty text.

    Keywords match as substrings, inside words as well.
    """
    keep = df.columns
    lowered = df.withColumn("_lower", F.lower(text_or_empty(F.col(text))))
    body = F.col("_lower")
    values = [
        flag(contains_any(body, urgent)),
        flag(contains_any(body, worldwide)),
        clamp(keyword_score(body, selective), high=V.SELECTIVE_MAX),
        flag(contains_any(body, simple)),
    ]
    return lowered.select(*keep, *[v.alias(n) for n, v in zip(LANGUAGE_COLUMNS, values)])


def text_features(
    df: DataFrame,
    ids: Sequence[str],
    title: str,
    design: str,
    endpoint: str,
    recruitment: str,
    max_features: int = 10,
    min_df: int = 2,
    fit_on: DataFrame | None = None,
    complexity: Mapping[str, object] | None = None,
    language: Mapping[str, object] | None = None,
    stopwords: Sequence[str] = V.TFIDF_STOPWORDS,
    terms: str | None = None,
) -> DataFrame:
    """TF-IDF, complexity and language features side by side.

    TF-IDF is that of the column ``terms``, by default the title. ``fit_on`` limits the vocabulary to other rows, such as the training split.
    All features are computed in the row, so they need no join on the id.
    """
    terms = terms or title
    vocab = tfidf_fit(df if fit_on is None else fit_on, terms, max_features, min_df, stopwords)
    wide = tfidf_columns(df, terms, vocab, max_features, stopwords)
    wide = text_complexity(wide, title, design, endpoint, **(complexity or {}))
    wide = language_flags(wide, recruitment, **(language or {}))
    return wide.select(*ids, *text_feature_names(max_features))


def text_feature_names(max_features: int = 10) -> list[str]:
    return [*(f"tfidf_{i}" for i in range(max_features)), *COMPLEXITY_COLUMNS, *LANGUAGE_COLUMNS]
