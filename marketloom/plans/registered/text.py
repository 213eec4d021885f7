"""Text queries over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.columns import classify
from marketloom.operators import text as X


from .base import QuerySet, table

SET = QuerySet()


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


PART_RULES = (("round", ("ring", "rod", "gear")), ("flat", ("plate", "gizmo")), ("cold", ("cold", "blue")))
COMPLEXITY = {
    "weights": {"license": 2, "apache": 1, "the": 1, "que": 2, "free": 3, "und": 0, "which": -1},
    "terms": ("license", "rights", "tion", "and", "der", "los"),
}
LANGUAGE = {
    "urgent": ("now", "free"),
    "worldwide": ("us", "license"),
    "selective": {"was": 2, "are": 2, "this": 1, "than": 1, "from": 1},
    "simple": ("all", "any", "ohne"),
}


@SET.add(
    "keyword_classify",
    """
    SELECT p_partkey, CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'rod') OR contains(p_name, 'gear') THEN 'round'
           WHEN contains(p_name, 'plate') OR contains(p_name, 'gizmo') THEN 'flat'
           WHEN contains(p_name, 'cold') OR contains(p_name, 'blue') THEN 'cold' ELSE 'Other' END AS label
    FROM part
    """,
)
def keyword_classify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", classify(F.upper("p_name"), PART_RULES, "Other").alias("label"))


KEYWORD_STOP_SQL = """(
 'the','a','an','and','or','of','in','on','to','for','with','study','trial','phase','open','label','randomized',
 'randomised','double','blind','parallel','arm','arms','effect','effects','versus','vs','compared','comparison',
 'participants','patients','evaluate','evaluating','assessment','treatment','treated','completed','recruiting','active',
 'not','yet','unknown','terminated','withdrawn','enrolling','invitation','suspended','by','type','mellitus')"""


@SET.add(
    "keyword_topk",
    f"""
    WITH w AS (SELECT lang AS scope, unnest(regexp_extract_all(lower(text), '[a-z][a-z-]{{2,}}')) AS keyword FROM documents),
    k AS (SELECT * FROM w WHERE keyword NOT IN {KEYWORD_STOP_SQL}),
    c AS (SELECT CASE WHEN GROUPING(scope) = 1 THEN 'ALL' ELSE scope END AS scope, keyword, COUNT(*) AS n
          FROM k GROUP BY GROUPING SETS ((keyword), (scope, keyword))),
    r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY n DESC, keyword) AS pos FROM c)
    SELECT scope, keyword, CAST(n AS BIGINT) AS count FROM r WHERE pos <= CASE WHEN scope = 'ALL' THEN 15 ELSE 8 END
    """,
)
def keyword_topk(spark, sf_dir):
    return X.top_keywords(documents(spark, sf_dir), "text", "lang")


TFIDF_STOP_SQL = """[
 'a','an','and','the','of','in','to','for','with','is','are','be','was','were','study','trial','phase','versus','vs',
 'randomized','double','blind','placebo','controlled','patients','subjects','on']"""
TOKENS_SQL = f"""
SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g'), ' +'),
       lambda w: len(w) > 2 AND NOT list_contains({TFIDF_STOP_SQL}, w)) AS tokens FROM documents
"""
VOCAB_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS position, term, df,
       ln((SELECT COUNT(*) FROM documents) / (1.0 + df)) AS idf
FROM (SELECT term, CAST(COUNT(*) AS BIGINT) AS df FROM (SELECT unnest(list_distinct(tokens)) AS term FROM ({TOKENS_SQL}))
      GROUP BY term HAVING COUNT(*) >= 2 ORDER BY df DESC, term LIMIT 10)
"""


@SET.add("tfidf_vocab", f"SELECT position, term, df, ROUND(idf, 6) AS idf FROM ({VOCAB_SQL})")
def tfidf_vocab(spark, sf_dir):
    vocab = X.tfidf_fit(documents(spark, sf_dir), "text", max_features=10, min_df=2)
    return vocab.select("position", "term", "df", F.round("idf", 6).alias("idf"))


SCORES_SQL = f"""
SELECT doc_id, v.term AS term, v.position AS position, COUNT(*) * 1.0 / any_value(n) * any_value(v.idf) AS tfidf
FROM (SELECT doc_id, unnest(tokens) AS term, len(tokens) AS n FROM ({TOKENS_SQL})) t
JOIN ({VOCAB_SQL}) v ON v.term = t.term GROUP BY 1, 2, 3
"""


@SET.add("tfidf_scores", f"SELECT doc_id, term, ROUND(tfidf, 6) AS tfidf FROM ({SCORES_SQL})")
def tfidf_scores(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocab = X.tfidf_fit(docs, "text", max_features=10, min_df=2)
    return X.tfidf_transform(docs, ["doc_id"], "text", vocab).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


COMPLEXITY_SQL = """
SELECT doc_id, CAST(length(source) AS INTEGER) AS title_length, CAST(length(text) AS INTEGER) AS design_length,
       CAST(length(lang) AS INTEGER) AS endpoint_length,
       CAST(length(source) + length(text) + length(lang) AS INTEGER) AS total_text_length,
       CAST(2 * contains(l, 'license')::INT + contains(l, 'apache')::INT + contains(l, 'the')::INT
            + 2 * contains(l, 'que')::INT + 3 * contains(l, 'free')::INT - contains(l, 'which')::INT AS INTEGER)
         AS complexity_score,
       CAST(contains(l, 'license')::INT + contains(l, 'apache')::INT + contains(l, 'the')::INT + contains(l, 'que')::INT
            + contains(l, 'free')::INT + contains(l, 'und')::INT + contains(l, 'which')::INT AS INTEGER)
         AS complexity_keyword_count,
       ROUND((length(source) + length(text) + length(lang))
             / CAST(greatest(1, len(regexp_extract_all(j, '[.!?;]'))) AS DOUBLE), 6) AS avg_sentence_length,
       ROUND((contains(l, 'license')::INT + contains(l, 'rights')::INT + contains(l, 'tion')::INT + contains(l, 'and')::INT
             + contains(l, 'der')::INT + contains(l, 'los')::INT) / greatest(1.0, length(j) / 100.0::DOUBLE), 6)
         AS medical_term_density
FROM (SELECT *, source || ' ' || text || ' ' || lang AS j, lower(source || ' ' || text || ' ' || lang) AS l FROM documents)
"""
ROUNDED = ("avg_sentence_length", "medical_term_density")


@SET.add("text_complexity", COMPLEXITY_SQL)
def text_complexity(spark, sf_dir):
    docs = X.text_complexity(documents(spark, sf_dir), "source", "text", "lang", **COMPLEXITY)
    return docs.select(
        "doc_id", *[F.round(c, 6).alias(c) if c in ROUNDED else F.col(c) for c in X.COMPLEXITY_COLUMNS]
    )


LANGUAGE_SQL = """
SELECT doc_id, CAST(contains(l, 'now') OR contains(l, 'free') AS INTEGER) AS urgent_language,
       CAST(contains(l, 'us') OR contains(l, 'license') AS INTEGER) AS global_scope,
       CAST(least(5, 2 * contains(l, 'was')::INT + 2 * contains(l, 'are')::INT + contains(l, 'this')::INT
                  + contains(l, 'than')::INT + contains(l, 'from')::INT) AS INTEGER) AS selective_criteria,
       CAST(contains(l, 'all') OR contains(l, 'any') OR contains(l, 'ohne') AS INTEGER) AS recruitment_simplicity
FROM (SELECT doc_id, lower(text) AS l FROM documents)
"""


@SET.add("language_flags", LANGUAGE_SQL)
def language_flags(spark, sf_dir):
    docs = X.language_flags(documents(spark, sf_dir), "text", **LANGUAGE)
    return docs.select("doc_id", *X.LANGUAGE_COLUMNS)


DENSE_SQL = ", ".join(
    f"COALESCE(ROUND(MAX(tfidf) FILTER (WHERE position = {i}), 6), 0.0)::DOUBLE AS tfidf_{i}" for i in range(10)
)


@SET.add(
    "text_features",
    f"""
    SELECT d.doc_id AS doc_id, t.* EXCLUDE (doc_id), c.* EXCLUDE (doc_id), l.* EXCLUDE (doc_id) FROM documents d
    JOIN (SELECT d.doc_id, {DENSE_SQL} FROM documents d LEFT JOIN ({SCORES_SQL}) s ON s.doc_id = d.doc_id GROUP BY 1) t
      ON t.doc_id = d.doc_id
    JOIN ({COMPLEXITY_SQL}) c ON c.doc_id = d.doc_id JOIN ({LANGUAGE_SQL}) l ON l.doc_id = d.doc_id
    """,
)
def text_features(spark, sf_dir):
    """Terms are those of the document text, which is the recruitment text as well."""
    wide = X.text_features(
        documents(spark, sf_dir), ["doc_id"], "source", "text", "lang", "text", complexity=COMPLEXITY, language=LANGUAGE, terms="text"
    )
    real = (*ROUNDED, *(f"tfidf_{i}" for i in range(10)))
    return wide.select("doc_id", *[F.round(c, 6).alias(c) if c in real else F.col(c) for c in X.text_feature_names()])
