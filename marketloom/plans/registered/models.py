"""Splits, metrics, features, clusters and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.columns import max_digit
from marketloom.operators import cluster as C
from marketloom.operators import features as FE
from marketloom.operators import metrics as M
from marketloom.operators import models as ML
from marketloom.operators import reshape
from marketloom.operators import split as SP

from .base import QuerySet, table

SET = QuerySet()

POSITION_SQL = """
SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id), doc_id) - 1 AS pos,
       COUNT(*) OVER (PARTITION BY quality) AS n FROM labels
"""


@SET.add("stratified_folds", f"SELECT doc_id, quality, CAST(pos % 5 AS INTEGER) AS fold FROM ({POSITION_SQL})")
def stratified_folds(spark, sf_dir):
    return SP.stratified_folds(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality")


@SET.add(
    "stratified_holdout", f"SELECT doc_id, quality, CAST(pos < floor(0.8::DOUBLE * n) AS INTEGER) AS is_train FROM ({POSITION_SQL})"
)
def stratified_holdout(spark, sf_dir):
    split = SP.stratified_holdout(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality")
    return split.withColumn("is_train", F.col("is_train").cast("int"))


def scored(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang").join(labels, "doc_id")


AUC_SQL = """
SELECT lang, SUM(p) AS n_pos, SUM(q) AS n_neg,
       (SUM(r * p) - SUM(p) * (SUM(p) + 1) / 2.0) / NULLIF(CAST(SUM(p) AS DOUBLE) * SUM(q), 0) AS auc
FROM (SELECT lang, p, q, SUM(p + q) OVER (PARTITION BY lang ORDER BY s ROWS UNBOUNDED PRECEDING) - (p + q)
                         + (p + q + 1) / 2.0::DOUBLE AS r
      FROM (SELECT lang, n_chars AS s, SUM(quality) AS p, SUM(1 - quality) AS q
            FROM (SELECT lang, n_chars, quality FROM documents JOIN labels USING (doc_id)
                  UNION ALL SELECT 'ALL', n_chars, quality FROM documents JOIN labels USING (doc_id)) GROUP BY 1, 2))
GROUP BY lang
"""


@SET.add(
    "mann_whitney_auc",
    f"SELECT lang, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, ROUND(auc, 6) AS auc FROM ({AUC_SQL})",
)
def mann_whitney_auc(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return M.auc(rows, "n_chars", "quality", ["lang"], overall="ALL").withColumn("auc", F.round("auc", 6))


@SET.add(
    "accuracy_at",
    """
    SELECT lang, CAST(COUNT(*) AS BIGINT) AS n,
           ROUND(AVG(CASE WHEN (n_chars >= 500) = (quality = 1) THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
    FROM documents JOIN labels USING (doc_id) GROUP BY 1
    """,
)
def accuracy_at(spark, sf_dir):
    exact = M.accuracy_at(scored(spark, sf_dir), "n_chars", "quality", 500, ["lang"])
    return exact.withColumn("accuracy", F.round("accuracy", 6))


def single_auc_sql(value: str) -> str:
    return f"""
    SELECT (SUM(r * p) - SUM(p) * (SUM(p) + 1) / 2.0) / (CAST(SUM(p) AS DOUBLE) * SUM(q)) AS auc FROM (
      SELECT p, q, SUM(p + q) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - (p + q) + (p + q + 1) / 2.0::DOUBLE AS r
      FROM (SELECT {value} AS s, SUM(quality) AS p, SUM(1 - quality) AS q FROM documents JOIN labels USING (doc_id) GROUP BY 1))
    """


LEAK_FEATURES = {"n_chars": "n_chars", "toxic": "toxic", "is_bad": "10 - 3 * quality", "id_hash": "doc_id % 97"}


@SET.add(
    "leakage_scan",
    "SELECT feature, ROUND(auc, 6) AS auc, ROUND(greatest(auc, 1 - auc), 6) AS separation, "
    "CAST(greatest(auc, 1 - auc) > 0.99 AS INTEGER) AS leaks FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, auc FROM ({single_auc_sql(v)})" for n, v in LEAK_FEATURES.items())
    + ")",
)
def leakage_scan(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumns({n: F.expr(v) for n, v in LEAK_FEATURES.items()})
    scan = M.leakage_scan(rows, list(LEAK_FEATURES), "quality")
    return scan.select(
        "feature", F.round("auc", 6).alias("auc"), F.round("separation", 6).alias("separation"), F.col("leaks").cast("int").alias("leaks")
    )


BANNED = ("toxic", "n_chars")


@SET.add(
    "leakage_names",
    "SELECT feature, CAST(feature IN ('toxic', 'n_chars') OR greatest(auc, 1 - auc) > 0.99 AS INTEGER) AS leaks FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, auc FROM ({single_auc_sql(v)})" for n, v in LEAK_FEATURES.items())
    + ")",
)
def leakage_names(spark, sf_dir):
    """Features that leak by their name or by their separation."""
    rows = scored(spark, sf_dir).withColumns({n: F.expr(v) for n, v in LEAK_FEATURES.items()})
    scan = M.leakage_scan(rows, list(LEAK_FEATURES), "quality", banned=BANNED)
    return scan.select("feature", F.col("leaks").cast("int").alias("leaks"))


PREDICTIONS_SQL = f"""
SELECT model, fold, score, quality FROM (
  SELECT 'length' AS model, CASE WHEN pos < floor(0.8::DOUBLE * n) THEN CAST(pos % 5 + 1 AS VARCHAR) ELSE 'holdout' END AS fold,
         least(1.0::DOUBLE, n_chars / 1000.0::DOUBLE) AS score, p.quality AS quality
  FROM ({POSITION_SQL}) p JOIN documents USING (doc_id)
  UNION ALL
  SELECT 'toxicity', CASE WHEN pos < floor(0.8::DOUBLE * n) THEN CAST(pos % 5 + 1 AS VARCHAR) ELSE 'holdout' END,
         0.9::DOUBLE - 0.8::DOUBLE * toxic, p.quality FROM ({POSITION_SQL}) p JOIN labels l ON l.doc_id = p.doc_id)
"""
RESULTS_SQL = f"""
SELECT a.model AS model, a.fold AS fold, ROUND(auc, 4) AS auc, ROUND(accuracy, 4) AS accuracy FROM (
  SELECT model, fold, (SUM(r * p) - SUM(p) * (SUM(p) + 1) / 2.0) / NULLIF(CAST(SUM(p) AS DOUBLE) * SUM(q), 0) AS auc
  FROM (SELECT model, fold, p, q, SUM(p + q) OVER (PARTITION BY model, fold ORDER BY s ROWS UNBOUNDED PRECEDING)
                                  - (p + q) + (p + q + 1) / 2.0::DOUBLE AS r
        FROM (SELECT model, fold, score AS s, SUM(quality) AS p, SUM(1 - quality) AS q FROM ({PREDICTIONS_SQL}) GROUP BY 1, 2, 3))
  GROUP BY 1, 2) a
JOIN (SELECT model, fold, AVG(CASE WHEN (score >= 0.5) = (quality = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
      FROM ({PREDICTIONS_SQL}) GROUP BY 1, 2) b ON a.model = b.model AND a.fold = b.fold
"""


def predictions(spark, sf_dir):
    """Two simple scorers over folds and hold-out, as a model run would leave them."""
    labels = table(spark, sf_dir, "labels")
    placed = SP.class_positions(labels, "doc_id", "quality")
    train = F.col("position") < F.floor(F.lit(0.8) * F.col("class_size"))
    fold = F.when(train, (F.col("position") % 5 + 1).cast("string")).otherwise("holdout")
    rows = placed.withColumn("fold", fold).join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    length = F.least(F.lit(1.0), F.col("n_chars") / F.lit(1000.0))
    scores = F.array(
        F.struct(F.lit("length").alias("model"), length.alias("score")),
        F.struct(F.lit("toxicity").alias("model"), (F.lit(0.9) - F.lit(0.8) * F.col("toxic")).alias("score")),
    )
    return rows.select("fold", F.col("quality").alias("label"), F.explode(scores).alias("m")).select(
        "m.model", "fold", "m.score", "label"
    )


@SET.add("model_table", RESULTS_SQL)
def model_table(spark, sf_dir):
    return M.model_table(predictions(spark, sf_dir))


@SET.add(
    "model_summary",
    f"""
    WITH s AS (SELECT model, AVG(auc) FILTER (WHERE fold <> 'holdout') AS cv_auc, MAX(auc) FILTER (WHERE fold = 'holdout') AS holdout_auc
               FROM ({RESULTS_SQL}) GROUP BY 1)
    SELECT model, ROUND(cv_auc, 6) AS cv_auc, holdout_auc,
           CAST(model = (SELECT model FROM s ORDER BY cv_auc DESC, model LIMIT 1) AS INTEGER) AS best FROM s
    """,
)
def model_summary(spark, sf_dir):
    summary = M.model_summary(M.model_table(predictions(spark, sf_dir)), by="cv")
    return summary.select("model", F.round("cv_auc", 6).alias("cv_auc"), "holdout_auc", F.col("best").cast("int").alias("best"))


ORDER_FLAGS = (
    ("has_building", ("indication",), ("building", "household")),
    ("has_machinery", ("indication",), ("machinery",)),
    ("has_priority", ("phase", "indication"), ("urgent", "high", "auto")),
    ("sponsor_nine", ("company",), ("9",)),
)


@SET.add(
    "rule_features",
    """
    SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS phase_depth,
           CAST(c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS INTEGER) AS has_building,
           CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS has_machinery,
           CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') OR c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS has_priority,
           CAST(contains(c_name, '9') AS INTEGER) AS sponsor_nine, ROUND(ln(1 + o_totalprice), 6) AS log_enrollment,
           ROUND(ln(1 + CASE left(o_orderpriority, 1) WHEN '1' THEN 1.5 WHEN '2' THEN 4.5 WHEN '3' THEN 12.0 ELSE 3.0 END
                    * CASE WHEN c_mktsegment = 'FURNITURE' THEN 1.3 ELSE 1.0 END
                    * CASE WHEN c_mktsegment = 'BUILDING' THEN 1.2 ELSE 1.0 END * 30.0), 6) AS log_duration_days
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def rule_features(spark, sf_dir):
    """Orders as trials: priority is the phase, market segment the indication."""
    trials = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    trials = trials.select(
        "o_orderkey",
        "o_totalprice",
        F.col("o_orderpriority").alias("phase"),
        F.col("c_mktsegment").alias("indication"),
        F.col("c_name").alias("company"),
    )
    days = FE.duration_days(
        F.col("indication"), F.col("phase"), factors=((1.3, ("furniture",)), (1.2, ("building",)))
    )
    numeric = {
        "phase_depth": max_digit(F.col("phase")),
        "log_enrollment": F.round(F.log1p("o_totalprice"), 6),
        "log_duration_days": F.round(F.log1p(days), 6),
    }
    return FE.rule_features(trials, ORDER_FLAGS, numeric).select(
        "o_orderkey", *numeric, *[name for name, _, _ in ORDER_FLAGS]
    )


@SET.add(
    "median_fill",
    """
    WITH y AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN CAST(year(o_orderdate) AS INTEGER)
               ELSE CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END END AS start_year FROM orders),
    m AS (SELECT CAST(floor(median(start_year)) AS INTEGER) AS med FROM y WHERE start_year > 1900 AND start_year < 2100)
    SELECT o_orderkey, CASE WHEN start_year > 1900 AND start_year < 2100 THEN start_year ELSE med END AS start_year FROM y, m
    """,
)
def median_fill(spark, sf_dir):
    year = F.year("o_orderdate")
    gap = F.when(F.col("o_orderstatus") == "P", 0).when(
        (F.col("o_orderstatus") == "O") | (F.col("o_orderkey") % 2 != 0), year
    )
    return FE.fill_median(table(spark, sf_dir, "orders").select("o_orderkey", gap.alias("start_year")), "start_year")


@SET.add(
    "zscore",
    """
    WITH s AS (SELECT AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1, AVG(c_nationkey) AS m2, STDDEV_POP(c_nationkey) AS s2
               FROM customer)
    SELECT c_custkey, ROUND((c_acctbal - m1) / s1, 6) AS c_acctbal, ROUND((c_nationkey - m2) / s2, 6) AS c_nationkey,
           0.0::DOUBLE AS same
    FROM customer, s
    """,
)
def zscore(spark, sf_dir):
    columns = ["c_acctbal", "c_nationkey", "same"]
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(7).alias("same"))
    scaled = FE.zscore_apply(customers, FE.zscore_fit(customers, columns), columns)
    return scaled.select("c_custkey", *[F.round(c, 6).alias(c) for c in columns])


def first_centres(points, k=4):
    """The k points with the smallest ids, numbered from 0."""
    from pyspark.sql import Window

    few = points.orderBy("vec_id").limit(k)
    return few.select(
        (F.row_number().over(Window.orderBy("vec_id")) - 1).alias("segment"),
        F.transform("embedding", lambda x: x.cast("double")).alias("centre"),
    )


NEAREST_SQL = """
WITH c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS segment, embedding AS centre
           FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 4)),
d AS (SELECT vec_id, embedding, segment,
             ROUND(list_sum(list_transform(generate_series(1, 64), lambda i:
                   pow(embedding[i]::DOUBLE - centre[i]::DOUBLE, 2))), 6) AS distance FROM embeddings, c),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, segment) AS pos FROM d)
SELECT vec_id, CAST(segment AS INTEGER) AS segment, distance, embedding FROM n WHERE pos = 1
"""


@SET.add("assign_nearest", f"SELECT vec_id, segment, distance FROM ({NEAREST_SQL})")
def assign_nearest(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return C.assign_nearest(points, "embedding", first_centres(points), digits=6).select("vec_id", "segment", "distance")


@SET.add(
    "lloyd_step",
    f"""
    SELECT segment, CAST(pos AS INTEGER) AS pos, COUNT(*)::BIGINT AS n, ROUND(AVG(x), 6) AS x FROM (
      SELECT segment, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS pos FROM ({NEAREST_SQL})) GROUP BY 1, 2
    """,
)
def lloyd_step(spark, sf_dir):
    points = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    moved = C.lloyd_step(points, "embedding", first_centres(points), digits=6)
    return moved.select("segment", "n", F.posexplode("centre").alias("pos", "x")).withColumn("x", F.round("x", 6))


@SET.add(
    "segment_profile",
    """
    SELECT c_mktsegment AS segment, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(c_acctbal), 4) AS avg_c_acctbal,
           ROUND(AVG(c_nationkey), 4) AS avg_c_nationkey FROM customer GROUP BY 1
    """,
)
def segment_profile(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment")
    return reshape.segment_profile(customers, "segment", ["c_acctbal", "c_nationkey"])


def _kmeans_sql(k: int = 4, seeds: range = range(42, 52), iterations: int = 50) -> str:
    """The same draws and steps: centres by races, then Lloyd steps for all seeds, and the cheapest seed."""
    uniform = lambda step: f"((('0x' || substr(md5(seed || '|{step}|' || c_custkey), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)"
    far = "list_transform(centres, lambda c: ROUND(pow(z[1] - c[1], 2) + pow(z[2] - c[2], 2), 9))"
    ctes = [
        "s AS (SELECT AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1, AVG(c_nationkey) AS m2, STDDEV_POP(c_nationkey) AS s2 FROM customer)",
        "p AS (SELECT c_custkey, [ROUND((c_acctbal - m1) / s1, 9), ROUND((c_nationkey - m2) / s2, 9)] AS z FROM customer, s)",
        f"d0 AS (SELECT seed, [z] AS centres FROM p, (SELECT unnest(range({seeds.start}, {seeds.stop})) AS seed) "
        f"QUALIFY row_number() OVER (PARTITION BY seed ORDER BY -ln({uniform(0)}), c_custkey::VARCHAR) = 1)",
    ]
    for step in range(1, k):
        time = f"-ln({uniform(step)})"
        ctes.append(
            f"d{step} AS (SELECT seed, list_append(centres, z) AS centres FROM (SELECT *, list_min({far}) AS d FROM p, d{step - 1}) "
            f"QUALIFY row_number() OVER (PARTITION BY seed ORDER BY d = 0, CASE WHEN d > 0 THEN {time} / d ELSE {time} END, c_custkey::VARCHAR) = 1)"
        )
    mean = lambda i: (
        f"CASE WHEN COUNT(*) FILTER (WHERE segment = {i}) > 0 THEN [ROUND(AVG(z[1]) FILTER (WHERE segment = {i}), 9), "
        f"ROUND(AVG(z[2]) FILTER (WHERE segment = {i}), 9)] ELSE any_value(centres)[{i + 1}] END"
    )
    placed = f"SELECT *, list_position({far}, list_min({far})) - 1 AS segment, list_min({far}) AS d"
    ctes.append(
        f"lloyd AS (SELECT seed, 0 AS step, centres FROM d{k - 1} UNION ALL SELECT seed, step + 1, [{', '.join(map(mean, range(k)))}] "
        f"FROM ({placed} FROM lloyd, p WHERE step < {iterations}) GROUP BY seed, step)"
    )
    ctes.append(f"ended AS (SELECT * FROM lloyd WHERE step = {iterations})")
    ctes.append(f"best AS (SELECT seed FROM ({placed} FROM ended, p) GROUP BY seed ORDER BY ROUND(SUM(d), 6), seed LIMIT 1)")
    return (
        f"WITH RECURSIVE {', '.join(ctes)} SELECT c_custkey, c_acctbal, c_nationkey, CAST(segment AS INTEGER) AS segment "
        f"FROM ({placed} FROM ended JOIN best USING (seed), p) JOIN customer USING (c_custkey)"
    )


@SET.add("kmeans_segments", _kmeans_sql())
def kmeans_segments(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return C.kmeans_segments(customers, ["c_acctbal", "c_nationkey"], key="c_custkey")


MODEL_FEATURES = ["log_total", "urgent", "year", "balance", "nation"]


def customer_labels(spark, sf_dir):
    """Customers with order history; the label is a high share of closed orders."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.log1p(F.sum("o_totalprice")).alias("log_total"),
        F.avg(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)).alias("urgent"),
        F.avg(F.year("o_orderdate")).alias("year"),
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("closed"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation")
    )
    label = F.when(F.col("closed") >= 0.35, 1).otherwise(0)
    return orders.join(customers, "custkey").select("custkey", *MODEL_FEATURES, label.alias("label"))


def folded_customers(spark, sf_dir):
    """Labelled customers in folds, standardised and cached, and the number of rows."""
    folded = SP.stratified_folds(customer_labels(spark, sf_dir), "custkey", "label")
    stats = FE.zscore_fit(folded, MODEL_FEATURES)
    scaled = FE.zscore_apply(folded, stats, MODEL_FEATURES, eps=1e-9)
    inputs = ML.assemble(scaled, MODEL_FEATURES).select(F.xxhash64("custkey").alias("row"), "features", F.col("label").cast("double"), "fold")
    return ML.compact(inputs, folded.count()).persist()


@SET.add("model_cv")
def model_cv(spark, sf_dir):
    """No oracle: fitted models, every setting of the full grids."""
    inputs = folded_customers(spark, sf_dir)
    try:
        parts = [ML.grid_search(inputs, kind, grid, len(MODEL_FEATURES)) for kind, grid in ML.GRIDS.items()]
    finally:
        inputs.unpersist()
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Customers with orders, in folds as above.
_FOLDED_SQL = """
SELECT (row_number() OVER (PARTITION BY label ORDER BY md5('42|' || custkey), custkey) - 1) % 5 AS fold
FROM (SELECT o_custkey AS custkey, CASE WHEN AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) >= 0.35 THEN 1 ELSE 0 END AS label
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
"""


@SET.add(
    "logistic_optimality",
    f"""
    SELECT CAST(s AS INTEGER) AS setting, CAST(f AS INTEGER) AS fold, (SELECT COUNT(*) FROM ({_FOLDED_SQL}) WHERE fold <> f) AS n,
           0.0::DOUBLE AS worst
    FROM range({len(ML.settings(ML.GRIDS[ML.LR]))}) a(s), range(5) b(f)
    """,
)
def logistic_optimality(spark, sf_dir):
    """Per setting and fold, how far the fitted weights are from optimal, per row: by SQL over all rows, and 0 to six digits."""
    width, grid = len(MODEL_FEATURES), ML.settings(ML.GRIDS[ML.LR])
    inputs = folded_customers(spark, sf_dir)
    rows = ML.training_rows(inputs, "fold")
    folds = list(range(5))
    try:
        model = ML.train(ML.LR, rows, grid, folds, width)
    finally:
        inputs.unpersist()
    stored = [(i // 5, i % 5, w.tolist(), float(a), float(b)) for i, (w, a, b) in enumerate(zip(model.weights, model.l1, model.l2))]
    models = spark.createDataFrame(stored, "setting int, left int, w array<double>, l1 double, l2 double")
    x = F.concat("features", F.array(F.lit(1.0)))
    z = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    pairs = rows.withColumn("x", x).join(F.broadcast(models), F.col("fold") != F.col("left"))  # a row for each of the grid's models
    off = pairs.withColumn("off", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) - F.col("label"))
    sums = off.groupBy("setting", "left", "w", "l1", "l2").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[j] * F.col("off")).alias(f"g{j}") for j in range(width + 1)])

    def wrong(j: int):
        w = F.col("w")[j]
        slope = F.col(f"g{j}") + F.col("l2") * w
        at_zero = F.greatest(F.abs(slope) - F.col("l1"), F.lit(0.0))
        return F.abs(F.col(f"g{width}")) if j == width else F.when(w == 0, at_zero).otherwise(F.abs(slope + F.col("l1") * F.signum(w)))

    worst = F.greatest(*[wrong(j) for j in range(width + 1)]) / F.col("n")
    return sums.select("setting", F.col("left").alias("fold"), "n", F.round(worst, 6).alias("worst"))


@SET.add("model_holdout")
def model_holdout(spark, sf_dir):
    """No oracle: tuned on the training share, measured on the hold-out."""
    results, _ = ML.run_models(customer_labels(spark, sf_dir), "custkey", MODEL_FEATURES)
    return results


@SET.add("feature_importance")
def feature_importance(spark, sf_dir):
    """No oracle: ranked coefficients and forest importances, on the training share of the hold-out split."""
    split = SP.stratified_holdout(customer_labels(spark, sf_dir), "custkey", "label").filter("is_train")
    raw = ML.assemble(split, MODEL_FEATURES)
    scaled = FE.zscore_apply(raw.withColumnRenamed("features", "raw"), FE.zscore_fit(split, MODEL_FEATURES), MODEL_FEATURES, eps=1e-9)
    inputs = ML.assemble(scaled, MODEL_FEATURES).select(
        F.xxhash64("custkey").alias("row"), F.col("label").cast("double"), F.col("features").alias("scaled"), F.col("raw").alias("features")
    )
    inputs = ML.compact(inputs, split.count()).persist()
    try:
        return ML.top_importances(ML.feature_importance(inputs, MODEL_FEATURES))
    finally:
        inputs.unpersist()
