"""Queries for sources, sinks and star-schema construction."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom import schemas
from marketloom.functions.columns import int_or_default
from marketloom.operators import market
from marketloom.operators import warehouse as W
from marketloom.plans import catalogue
from marketloom.session import scratch_path
from marketloom.sources import delimited, landed

from .base import BRAND_SALES_FLAGGED_SQL, BRAND_SALES_SQL, QuerySet, as_money, brand_sales, money, table

SET = QuerySet()


@SET.add("csv_scan_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan_roundtrip(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    delimited.write_result(customers, path)
    return delimited.scan_csv(spark, path, customers.schema)


@SET.add(
    "typed_cast_default",
    """
    SELECT event_id, CAST(CASE WHEN user_id % 3 = 0 THEN 0 WHEN user_id % 3 = 1 THEN 0
                          ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS INTEGER) AS strict_zero,
           CAST(CASE WHEN user_id % 3 = 0 THEN -1 WHEN user_id % 3 = 1 THEN -1
                ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS INTEGER) AS lenient
    FROM events
    """,
)
def typed_cast_default(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    digits = F.get_json_object("props", "$.k")
    case = F.col("user_id") % 3
    blank = F.when(case == 0, "  ").when(case == 1, F.lit(None)).otherwise(F.concat(F.lit(" "), digits))
    mixed = F.when(case == 0, "n/a").when(case == 1, "").otherwise(digits)
    return events.select(
        "event_id",
        int_or_default(blank, strict=True).alias("strict_zero"),
        int_or_default(mixed, default=-1).alias("lenient"),
    )


@SET.add(
    "csv_quarantine",
    """
    SELECT CASE WHEN p_size % 10 < 3 THEN 'quarantined' ELSE 'good' END AS state, p_brand AS brand,
           CASE p_size % 10 WHEN 0 THEN concat_ws(',', p_partkey, p_brand, replace(p_name, ' ', ','), p_size)
                WHEN 1 THEN concat_ws(',', p_partkey, p_brand)
                WHEN 2 THEN concat_ws(',', p_partkey, p_brand, p_name, 'n/a')
                ELSE concat_ws(',', p_partkey, p_brand, p_name, p_size) END AS line
    FROM part
    """,
)
def csv_quarantine(spark, sf_dir):
    """Unquoted commas, missing fields and bad numbers, each in a tenth of the rows."""
    case = F.col("p_size") % 10
    good = [F.col("p_partkey"), F.col("p_brand"), F.col("p_name"), F.col("p_size")]
    lines = table(spark, sf_dir, "part").select(
        F.when(case == 0, F.concat_ws(",", *good[:2], F.replace("p_name", F.lit(" "), F.lit(",")), good[3]))
        .when(case == 1, F.concat_ws(",", *good[:2]))
        .when(case == 2, F.concat_ws(",", *good[:3], F.lit("n/a")))
        .otherwise(F.concat_ws(",", *good))
        .alias("value")
    )
    path = scratch_path(spark, "part-lines")
    lines.write.text(path)
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("brand", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("size", T.IntegerType()),
        ]
    )
    sound, bad = delimited.read_csv(spark, path, schema, header=False)
    return sound.select(
        F.lit("good").alias("state"), "brand", F.concat_ws(",", "key", "brand", "name", "size").alias("line")
    ).union(
        bad.select(
            F.lit("quarantined"), F.split("raw_line", ",")[1], "raw_line"
        )
    )


@SET.add(
    "json_flatten",
    """
    SELECT event_id, COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
           COALESCE(json_extract_string(props, '$.missing.name'), '') AS name FROM events
    """,
)
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = events.select(
        "event_id", F.from_json("props", "k int, missing struct<name: string>", {"mode": "PERMISSIVE"}).alias("p")
    )
    return parsed.select(
        "event_id", F.coalesce("p.k", F.lit(0)).alias("k"), F.coalesce("p.missing.name", F.lit("")).alias("name")
    )


@SET.add(
    "trial_page_flatten",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS nct_id, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE c_name END AS company,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'tirzepatide' WHEN '2-HIGH' THEN 'semaglutide' ELSE 'other-glp1' END
             AS molecule,
           CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN 'PHASE2,PHASE3' ELSE 'PHASE3' END AS phase,
           concat_ws(' | ', c_mktsegment, o_orderstatus) AS indication,
           CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' ELSE 'ACTIVE' END AS status,
           CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(year(o_orderdate) AS INTEGER) END AS start_year,
           CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS enrollment,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'A study of Tirzepatide' WHEN '2-HIGH' THEN 'Semaglutide trial'
             ELSE o_orderpriority END AS title,
           CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'Randomized, Parallel' END AS design,
           CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'first ' || o_orderkey END AS endpoint,
           CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'adults, ' || c_mktsegment END AS recruitment,
           0 AS is_simulated
    FROM orders JOIN customer ON c_custkey = o_custkey
    """,
)
def trial_page_flatten(spark, sf_dir):
    """Registry pages written as nested JSON lines, then read and flattened."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")
    )
    every = lambda n: F.col("o_orderkey") % n
    unless = lambda missing, value: F.when(~missing, value)
    nothing = F.lit(None).cast("array<string>")
    title = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "A study of Tirzepatide")
        .when(F.col("o_orderpriority") == "2-HIGH", "Semaglutide trial")
        .otherwise(F.col("o_orderpriority"))
    )
    phases = F.when(every(5) == 0, nothing).when(every(5) == 1, F.array(F.lit("PHASE2"), F.lit("PHASE3"))).otherwise(
        F.array(F.lit("PHASE3"))
    )
    odd = every(2) != 0
    section = F.struct(
        F.struct(F.col("o_orderkey").cast("string").alias("nctId"), title.alias("briefTitle")).alias("identificationModule"),
        F.struct(
            phases.alias("phases"),
            F.when(odd, F.array(F.struct(F.lit("Randomized").alias("name")), F.struct(F.lit("Parallel").alias("name"))))
            .otherwise(F.array().cast("array<struct<name: string>>"))
            .alias("studyDesignInfo"),
            unless(every(4) == 0, F.struct(F.floor("o_totalprice").alias("count"))).alias("enrollmentInfo"),
            unless(every(6) == 0, F.struct(F.array(F.lit("adults"), F.col("c_mktsegment")).alias("conditionList"))).alias(
                "recruitmentInfo"
            ),
        ).alias("designModule"),
        F.struct(F.array("c_mktsegment", "o_orderstatus").alias("conditions")).alias("conditionsModule"),
        F.struct(
            F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("ACTIVE").alias("overallStatus"),
            unless(every(3) == 0, F.struct(F.date_format("o_orderdate", "yyyy-MM").alias("date"))).alias("startDateStruct"),
        ).alias("statusModule"),
        unless(every(7) == 0, F.struct(F.struct(F.col("c_name").alias("name")).alias("leadSponsor"))).alias(
            "sponsorCollaboratorsModule"
        ),
        unless(
            ~odd,
            F.struct(
                F.array(
                    F.struct(F.concat(F.lit("first "), F.col("o_orderkey")).alias("title")),
                    F.struct(F.lit("second").alias("title")),
                ).alias("primaryOutcomeMeasures")
            ),
        ).alias("outcomesModule"),
    )
    path = scratch_path(spark, "trial-pages")
    orders.select(F.array(F.struct(section.alias("protocolSection"))).alias("studies")).write.json(path)
    return landed.flatten_trials(landed.read_page_lines(spark, path, schemas.TRIAL_PAGE))


EVENT_GROUPS = (("Conversion", ("signup", "purchase")), ("Engagement", ("view", "click")), ("High value", ("high",)))


@SET.add(
    "event_rollup",
    """
    WITH r AS (
      SELECT CAST(ts AS DATE) AS day, event_id, value > 90 AS serious,
             unnest([event_type, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50
                                      THEN 'HIGH k' ELSE 'low k' END]) AS term FROM events),
    c AS (SELECT day, event_id, serious,
                 CASE WHEN contains(term, 'signup') OR contains(term, 'purchase') THEN 'Conversion'
                      WHEN contains(term, 'view') OR contains(term, 'click') THEN 'Engagement'
                      WHEN contains(lower(term), 'high') THEN 'High value' ELSE 'Other' END AS event_type FROM r)
    SELECT CAST(day AS VARCHAR) AS day, event_type, CAST(COUNT(*) AS BIGINT) AS report_count,
           CAST(SUM(CASE WHEN serious THEN 1 ELSE 0 END) AS BIGINT) AS serious_count,
           CAST(COUNT(DISTINCT event_id) AS BIGINT) AS distinct_reports
    FROM c GROUP BY 1, 2
    """,
)
def event_rollup(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("day"),
        "event_id",
        "value",
        F.array("event_type", F.when(k >= 50, "HIGH k").otherwise("low k")).alias("reactions"),
    )
    return landed.event_rollup(
        events, ["day"], "reactions", lambda r: r, F.col("value") > 90, EVENT_GROUPS, "Other", report_id="event_id"
    )


@SET.add(
    "event_pages",
    """
    SELECT CAST(year(ts) AS INTEGER) AS year, CASE WHEN user_id % 2 = 0 THEN 'Even' ELSE 'Odd' END AS molecule,
           CASE WHEN event_type IN ('view', 'click') THEN 'Nausea & Vomiting'
                WHEN event_type = 'error' THEN 'Injection Site' ELSE 'Other' END AS event_type,
           CAST(COUNT(*) AS BIGINT) AS report_count,
           CAST(SUM(CASE WHEN user_id % 4 IN (2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS serious_count, 0 AS is_simulated
    FROM events GROUP BY 1, 2, 3
    """,
)
def event_pages(spark, sf_dir):
    """Report pages landed under year=/substance= folders, then rolled up."""
    reaction = (
        F.when(F.col("event_type").isin("view", "click"), "Mild NAUSEA")
        .when(F.col("event_type") == "error", "Injection site pain")
        .otherwise(F.col("event_type"))
    )
    code = F.col("user_id") % 4
    serious = F.when(code == 0, F.lit(None).cast("string")).when(code == 1, "0").when(code == 2, "1").otherwise("2")
    report = F.struct(
        serious.alias("serious"),
        F.struct(F.array(F.struct(reaction.alias("reactionmeddrapt"))).alias("reaction")).alias("patient"),
    )
    path = scratch_path(spark, "event-pages")
    table(spark, sf_dir, "events").select(
        F.year("ts").alias("year"),
        F.when(F.col("user_id") % 2 == 0, "EVEN").otherwise("ODD").alias("substance"),
        F.array(report).alias("results"),
    ).write.partitionBy("year", "substance").json(path)
    schema = T.StructType([*schemas.EVENT_PAGE.fields, *schemas.EVENT_PARTITIONS.fields])
    return landed.rollup_event_pages(landed.read_page_lines(spark, path, schema))


@SET.add(
    "source_fallback",
    """
    SELECT 'missing' AS wanted, 'fallback' AS _source, 'PATH_NOT_FOUND' AS _reason, CAST(COUNT(*) AS BIGINT) AS n FROM orders
    UNION ALL SELECT 'empty', 'fallback', 'EMPTY', CAST(COUNT(*) AS BIGINT) FROM orders
    UNION ALL SELECT 'sound', 'primary', NULL, CAST(COUNT(*) AS BIGINT) FROM customer
    """,
)
def source_fallback(spark, sf_dir):
    def parquet(s, p):
        return s.read.parquet(p)

    def no_rows(s, p):
        df = s.read.parquet(p)
        return df if p.endswith("orders.parquet") else df.filter("c_custkey < 0")

    orders, customers = f"{sf_dir}/orders.parquet", f"{sf_dir}/customer.parquet"
    taken = {
        "missing": landed.read_with_fallback(spark, f"{sf_dir}/orders_live.parquet", orders, parquet),
        "empty": landed.read_with_fallback(spark, customers, orders, no_rows),
        "sound": landed.read_with_fallback(spark, customers, orders, parquet),
    }
    counts = [
        df.groupBy(F.lit(wanted).alias("wanted"), "_source", "_reason").agg(F.count(F.lit(1)).alias("n"))
        for wanted, df in taken.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])


@SET.add(
    "warehouse_refresh",
    f"""
    SELECT brand_id, year, is_simulated, ROUND(CAST(revenue AS DOUBLE), 2) AS revenue
    FROM ({BRAND_SALES_FLAGGED_SQL}) WHERE is_simulated = 0
    """,
)
def warehouse_refresh(spark, sf_dir):
    """Facts rewritten by provenance; the read below opens one partition only."""
    sales = brand_sales(spark, sf_dir, flagged=True)
    stored = W.refresh({"fact_brand_sales": sales}, scratch_path(spark, "warehouse"))
    real = W.real_only(stored["fact_brand_sales"])
    return real.select("brand_id", "year", "is_simulated", as_money("revenue"))


@SET.add(
    "catalogue_status",
    """
    SELECT 1 AS position, 'sales' AS query, 'written' AS state, (SELECT COUNT(*) FROM orders) > 0 AS has_rows
    UNION ALL SELECT 2, 'broken', 'failed', (SELECT COUNT(*) FROM orders) > 0
    UNION ALL SELECT 3, 'nothing', 'empty', (SELECT COUNT(*) FROM orders) > 0
    UNION ALL SELECT 4, 'pipeline', 'written', (SELECT COUNT(*) FROM orders) > 0
    """,
)
def catalogue_status(spark, sf_dir):
    """A catalogue run in which one query fails and one has no rows."""
    tables = {"orders": table(spark, sf_dir, "orders"), "sales": brand_sales(spark, sf_dir)}
    jobs = {
        "sales": lambda t: market.share_of_period(t["sales"], "year", "revenue"),
        "broken": lambda t: t["orders"].select("no_such_column"),
        "nothing": lambda t: t["orders"].filter("o_orderkey < 0"),
        "pipeline": lambda t: market.distribution(
            t["orders"], ["o_orderpriority", "o_orderstatus"], "o_totalprice", "n", "total"
        ),
    }
    status = catalogue.run_all(spark, tables, scratch_path(spark, "results"), jobs)
    return status.select("position", "query", "state", F.lit(not tables["orders"].isEmpty()).alias("has_rows"))


@SET.add(
    "dim_time",
    """
    SELECT year, CAST(CAST(floor(year / 10) * 10 AS INTEGER) AS VARCHAR) AS decade FROM (
      SELECT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
      UNION SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem
      UNION SELECT CAST(year(ts) AS INTEGER) FROM events)
    """,
)
def dim_time(spark, sf_dir):
    dated = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    return W.time_dimension([table(spark, sf_dir, t).select(F.year(c).alias("year")) for t, c in dated])


@SET.add(
    "dim_region",
    """
    SELECT d.region_id AS region_id, d.region_name AS region_name, d.country AS country,
           CAST(COUNT(*) AS BIGINT) AS customers
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    JOIN (VALUES ('GLOBAL', 'Global', 'Multiple'), ('CN', 'China', 'China')) d(region_id, region_name, country)
      ON d.region_id = CASE WHEN r_name = 'ASIA' THEN 'CN' ELSE 'GLOBAL' END
    GROUP BY 1, 2, 3
    """,
)
def dim_region(spark, sf_dir):
    """Customers per region of the constant dimension, counted before each join."""
    per_nation = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")
    )
    region_id = F.when(F.col("r_name") == "ASIA", "CN").otherwise("GLOBAL")
    placed = per_nation.join(nations.select("n_nationkey", region_id.alias("region_id")), "n_nationkey")
    return (
        placed.join(F.broadcast(W.region_dimension(spark)), "region_id")
        .groupBy("region_id", "region_name", "country")
        .agg(F.sum("customers").alias("customers"))
    )


@SET.add(
    "dim_first_row",
    """
    SELECT p_brand AS brand_id, arg_min(p_name, p_partkey) AS brand_name, arg_min(p_type, p_partkey) AS category,
           CAST(MIN(p_partkey) AS BIGINT) AS p_partkey FROM part GROUP BY 1
    """,
)
def dim_first_row(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand_id"), F.col("p_name").alias("brand_name"), F.col("p_type").alias("category"), "p_partkey"
    )
    return W.keep_first(parts, ["brand_id"], ["p_partkey"])


SECOND_SOURCE_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e6, 2) AS market_usd_bn
FROM orders GROUP BY 1
"""
CONFORM_SQL = f"""
SELECT brand_id, 'GLOBAL' AS region_id, year, ROUND(CAST(revenue AS DOUBLE), 2) AS revenue_usd_m, 1 AS scripts_units,
       0 AS is_simulated FROM ({BRAND_SALES_SQL})
UNION ALL
SELECT 'cn_glp1_market', 'CN', year, market_usd_bn * 1000.0, 0, 1 FROM ({SECOND_SOURCE_SQL})
"""


def conformed_sales(spark, sf_dir):
    columns = schemas.FACT_SALES.fieldNames()
    own = W.conform(
        brand_sales(spark, sf_dir).withColumn("revenue_usd_m", F.round(F.col("revenue").cast("double"), 2)),
        {"region_id": "GLOBAL", "scripts_units": 1, "is_simulated": 0},
        {},
        columns,
    )
    second = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(F.round(F.sum(money("o_totalprice")).cast("double") / F.lit(1e6), 2).alias("market_usd_bn"))
    )
    return W.sales_fact(own, second)


@SET.add("conform_union", CONFORM_SQL)
def conform_union(spark, sf_dir):
    return conformed_sales(spark, sf_dir)


@SET.add(
    "market_size",
    f"""
    SELECT year, ROUND(revenue_usd_m / 1000.0, 2) AS market_usd_bn, is_simulated
    FROM ({CONFORM_SQL}) WHERE region_id = 'CN' AND is_simulated = 1
    """,
)
def market_size(spark, sf_dir):
    where = (F.col("region_id") == "CN") & (F.col("is_simulated") == 1)
    return market.market_size(conformed_sales(spark, sf_dir), "year", "revenue_usd_m", where)


@SET.add(
    "insert_or_ignore",
    """
    WITH target AS (SELECT o_custkey, MIN(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    fresh AS (SELECT o_custkey, MIN(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT o_custkey, o_orderkey, 'F' AS origin FROM target
    UNION ALL SELECT o_custkey, o_orderkey, 'later' FROM fresh WHERE o_custkey NOT IN (SELECT o_custkey FROM target)
    """,
)
def insert_or_ignore(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    closed = F.col("o_orderstatus") == "F"
    keyed = orders.withColumn("origin", F.when(closed, "F").otherwise("later"))
    target = W.keep_first(keyed.filter(closed).drop("o_orderstatus"), ["o_custkey"], ["o_orderkey"])
    return W.insert_or_ignore(target, keyed.filter(~closed).drop("o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@SET.add(
    "provenance_split",
    """
    SELECT CASE WHEN l_linestatus = 'F' THEN 'real' ELSE 'simulated' END AS provenance,
           CAST(COUNT(*) AS BIGINT) AS n, ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
    FROM lineitem GROUP BY 1
    """,
)
def provenance_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("is_simulated"), money("l_extendedprice").alias("price")
    )

    provenance = F.when(F.col("is_simulated") == 0, "real").otherwise("simulated").alias("provenance")
    return lines.groupBy(provenance).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price").cast("double"), 2).alias("total"))


FIRST_PART_SQL = "SELECT p_brand AS brand_id, arg_min('Maker ' || p_size % 5, p_partkey) AS company FROM part GROUP BY 1"


@SET.add(
    "catalogue_rows",
    f"""
    WITH s AS ({BRAND_SALES_SQL}), n AS (SELECT COUNT(*) AS n FROM s)
    SELECT 1 AS position, 'brand_share' AS query, 'written' AS state, n AS rows FROM n
    UNION ALL SELECT 2, 'brand_growth', 'written', n FROM n
    UNION ALL SELECT 3, 'brand_launches', 'written', (SELECT COUNT(*) FROM s JOIN ({FIRST_PART_SQL}) USING (brand_id) WHERE company = 'Maker 1')
    UNION ALL SELECT 4, 'brand_base_vs_latest', 'written', (SELECT COUNT(DISTINCT brand_id) FROM s WHERE year = 1996
        AND brand_id IN (SELECT brand_id FROM s WHERE year = (SELECT MAX(year) FROM s)))
    UNION ALL SELECT 5, 'safety_signals', 'written', (SELECT least(20, COUNT(*)) FROM (SELECT DISTINCT user_id % 10, event_type FROM events))
    UNION ALL SELECT 6, 'trial_pipeline', 'written', (SELECT COUNT(*) FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders))
    UNION ALL SELECT 7, 'simulated_market', 'written', (SELECT COUNT(DISTINCT year(o_orderdate)) FROM orders)
    """,
)
def catalogue_rows(spark, sf_dir):
    """The seven named analyses over a star of the driver's tables, with the rows each has written."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand_id"), F.col("p_name").alias("brand_name"),
        F.concat(F.lit("Maker "), F.col("p_size") % 5).alias("company"), F.col("p_type").alias("molecule"), F.col("p_type").alias("category"), F.lit(0).alias("is_simulated"), "p_partkey",
    )
    events = table(spark, sf_dir, "events").select(
        F.year("ts").alias("year"), (F.col("user_id") % 10).cast("string").alias("molecule"), "event_type",
        F.lit(1).alias("report_count"), F.when(F.col("value") > 90, 1).otherwise(0).alias("serious_count"), F.lit(0).alias("is_simulated"),
    )
    trials = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("company"), F.col("o_orderpriority").alias("phase"), F.lit(1).alias("enrollment"), F.lit(0).alias("is_simulated")
    )
    star = {
        "dim_brand": W.keep_first(parts, ["brand_id"], ["p_partkey"]).drop("p_partkey"),
        "fact_brand_sales": conformed_sales(spark, sf_dir),
        "fact_events": events,
        "fact_trials": trials,
    }
    adapted = {
        "brand_launches": lambda t: catalogue.brand_launches(t, "Maker 1"),
        "brand_base_vs_latest": lambda t: catalogue.brand_base_vs_latest(t, 1996),
    }
    jobs = {name: adapted.get(name, query) for name, query in catalogue.CATALOGUE.items()}
    status = catalogue.run_all(spark, star, scratch_path(spark, "results"), jobs, on_error="raise")
    return status.select("position", "query", "state", "rows")
