"""Explicit schemas of the raw inputs and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


INT, LONG, DOUBLE, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# Star schema.
DIM_TIME = _struct(("year", INT), ("decade", TEXT))
DIM_REGION = _struct(("region_id", TEXT), ("region_name", TEXT), ("country", TEXT))
DIM_BRAND = _struct(
    ("brand_id", TEXT), ("brand_name", TEXT), ("company", TEXT), ("molecule", TEXT), ("category", TEXT),
    ("is_simulated", INT),
)
FACT_SALES = _struct(
    ("brand_id", TEXT), ("region_id", TEXT), ("year", INT), ("revenue_usd_m", DOUBLE), ("scripts_units", LONG),
    ("is_simulated", INT),
)
FACT_TRIALS = _struct(
    ("nct_id", TEXT), ("company", TEXT), ("molecule", TEXT), ("phase", TEXT), ("indication", TEXT), ("status", TEXT),
    ("start_year", INT), ("enrollment", LONG), ("title", TEXT), ("design", TEXT), ("endpoint", TEXT),
    ("recruitment", TEXT), ("is_simulated", INT),
)
FACT_EVENTS = _struct(
    ("year", INT), ("molecule", TEXT), ("event_type", TEXT), ("report_count", LONG), ("serious_count", LONG),
    ("is_simulated", INT),
)

# Raw inputs.
RAW_SALES = _struct(
    ("brand_id", TEXT), ("brand_name", TEXT), ("company", TEXT), ("molecule", TEXT), ("category", TEXT),
    ("region_id", TEXT), ("year", INT), ("revenue_usd_m", DOUBLE), ("scripts_units", LONG), ("is_simulated", INT),
)
RAW_MARKET = _struct(
    ("year", INT), ("market_usd_bn", DOUBLE), ("glp1_users_mn", DOUBLE), ("penetration_pct", DOUBLE),
    ("is_simulated", INT),
)

# Landed pages of the trial registry: every path may be missing.
TRIAL_PAGE = _struct(
    ("studies", T.ArrayType(_struct(
        ("protocolSection", _struct(
            ("identificationModule", _struct(("nctId", TEXT), ("briefTitle", TEXT))),
            ("designModule", _struct(
                ("phases", T.ArrayType(TEXT)),
                ("studyDesignInfo", T.ArrayType(_struct(("name", TEXT)))),
                ("enrollmentInfo", _struct(("count", LONG))),
                ("recruitmentInfo", _struct(("conditionList", T.ArrayType(TEXT)))),
            )),
            ("conditionsModule", _struct(("conditions", T.ArrayType(TEXT)))),
            ("statusModule", _struct(("overallStatus", TEXT), ("startDateStruct", _struct(("date", TEXT))))),
            ("sponsorCollaboratorsModule", _struct(("leadSponsor", _struct(("name", TEXT))))),
            ("outcomesModule", _struct(("primaryOutcomeMeasures", T.ArrayType(_struct(("title", TEXT)))))),
        )),
    ))),
    ("nextPageToken", TEXT),
)
# Landed pages of adverse-event reports; year and substance come from the path.
EVENT_PAGE = _struct(
    ("results", T.ArrayType(_struct(
        ("serious", TEXT),
        ("patient", _struct(("reaction", T.ArrayType(_struct(("reactionmeddrapt", TEXT)))))),
    ))),
)
EVENT_PARTITIONS = _struct(("year", INT), ("substance", TEXT))
