"""Default word lists, rule tables and constants.

Fixed values: results depend on these exact entries, so they are stated as
they are. Every operator takes them as a parameter.
"""

from __future__ import annotations

# Words dropped from keyword counts.
KEYWORD_STOPWORDS = (
    "the", "a", "an", "and", "or", "of", "in", "on", "to", "for", "with",
    "study", "trial", "phase", "open", "label", "randomized", "randomised",
    "double", "blind", "parallel", "arm", "arms", "effect", "effects",
    "versus", "vs", "compared", "comparison", "participants", "patients",
    "evaluate", "evaluating", "assessment", "treatment", "treated",
    "completed", "recruiting", "active", "not", "yet", "unknown", "terminated",
    "withdrawn", "enrolling", "invitation", "suspended", "by", "type", "mellitus",
)

# Words dropped from TF-IDF.
TFIDF_STOPWORDS = (
    "a", "an", "and", "the", "of", "in", "to", "for", "with",
    "is", "are", "be", "was", "were", "study", "trial", "phase",
    "versus", "vs", "randomized", "double", "blind", "placebo",
    "controlled", "patients", "subjects", "on",
)

# Weight of each design keyword.
COMPLEXITY_WEIGHTS = {
    "stratified": 2,
    "randomized": 1,
    "crossover": 2,
    "adaptive": 3,
    "sequential": 2,
    "factorial": 3,
    "open-label": 0,
    "unblinded": 0,
    "phase out": -1,
}

# Terms counted for the term density.
MEDICAL_TERMS = (
    "cardiovascular", "hypertension", "diabetes", "obesity",
    "efficacy", "safety", "adverse", "event", "biomarker",
    "dosage", "pharmacokinetic", "pharmacodynamic",
)

# Recruitment language.
URGENT_WORDS = ("urgent", "emergency", "immediately", "asap", "critical", "now")
GLOBAL_WORDS = ("global", "international", "worldwide", "multiple countries", "us", "europe", "asia")
SELECTIVE_WEIGHTS = {
    "severe": 2, "refractory": 2, "uncontrolled": 1,
    "comorbid": 1, "stable": 1, "no prior": 1,
}
SELECTIVE_MAX = 5
SIMPLE_WORDS = ("all", "any", "regardless", "no restrictions")

# Reaction groups of adverse events, in order of priority.
REACTION_RULES = (
    ("Gastrointestinal", ("gastrointestinal", "abdominal pain", "diarrhea", "constipation")),
    ("Nausea & Vomiting", ("nausea", "vomiting")),
    ("Weight Decrease", ("weight decreased",)),
    ("Injection Site", ("injection site",)),
)
REACTION_DEFAULT = "Other"

# Molecules looked for in a title, in order of priority.
MOLECULE_RULES = tuple((m, (m,)) for m in ("tirzepatide", "semaglutide", "orforglipron", "dulaglutide"))
MOLECULE_DEFAULT = "other-glp1"

# Keyword flags of the trial features: name, columns searched, keywords.
TRIAL_FLAGS = (
    ("has_obesity", ("indication",), ("obesity", "overweight")),
    ("has_diabetes", ("indication",), ("diabetes",)),
    ("has_cardio", ("indication",), ("cardiovascular", "heart", "cv", "cardio")),
    ("sponsor_lilly", ("company",), ("eli lilly",)),
    ("sponsor_novo", ("company",), ("novo",)),
    ("has_phase3", ("phase",), ("3a", "3b", "3c", "phase 3")),
    ("has_cv_outcomes", ("indication",), (
        "cvoutcomes", "cv outcomes", "cardiovascular outcomes", "mace", "major adverse cardiac")),
    ("has_healthy_volunteers", ("indication",), ("healthy", "healthy volunteer", "healthy volunteers")),
    ("design_double_blind", ("design", "title"), ("double-blind", "double blind")),
    ("design_placebo_controlled", ("design", "title"), ("placebo-controlled", "placebo controlled")),
    ("design_global", ("design", "title"), ("global", "international")),
    ("endpoint_cv", ("endpoint",), ("cv", "cardiovascular", "mace", "heart")),
    ("recruitment_multi_center", ("recruitment",), ("multi-center", "multicenter", "multiple centers")),
)
# Order of the base feature columns.
TRIAL_FEATURES = (
    "phase_depth", "has_obesity", "has_diabetes", "has_cardio",
    "log_enrollment", "sponsor_lilly", "sponsor_novo", "start_year",
    "has_phase3", "log_duration_days", "has_cv_outcomes",
    "has_healthy_volunteers",
    "design_double_blind", "design_placebo_controlled", "design_global",
    "endpoint_cv", "recruitment_multi_center",
)
# Expected months by phase digit (first digit found, in this order), and factors.
DURATION_MONTHS = (("1", 1.5), ("2", 4.5), ("3", 12.0))
DURATION_DEFAULT_MONTHS = 3.0
DURATION_FACTORS = ((1.3, ("obesity", "overweight")), (1.2, ("combination", "combo")))
DAYS_PER_MONTH = 30.0
# Feature names derived from the label; they must never be model inputs.
LEAKING_NAMES = ("is_active_status", "estimated_completion_year")
COMPLETED = "completed"
YEAR_LOW, YEAR_HIGH, YEAR_DEFAULT = 1900, 2100, 2020

# Region dimension and the virtual brand of the second sales source.
REGIONS = (("GLOBAL", "Global", "Multiple"), ("CN", "China", "China"))
MARKET_BRAND, MARKET_REGION, MARKET_SCALE = "cn_glp1_market", "CN", 1000.0

# Standard normal quantiles at the precision in common tables.
Z_TWO_SIDED_05 = 1.959964
Z_ONE_SIDED_05 = 1.644854
Z_POWER_80 = 0.841621
# The same at four digits, used by the quick power formula.
Z_QUICK_ALPHA_05 = 1.6449
Z_QUICK_POWER_80 = 0.8416

# Forecast.
FORECAST_HORIZON = 6
BACKTEST_HOLD = 2
GROWTH_DAMPING = 0.8

# Model selection.
SEED = 42
FOLDS = 5
TRAIN_SHARE = 0.8
MIN_MODEL_ROWS = 30
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0], "elastic": [0.0, 0.5]}
RF_GRID = {"trees": [100, 200], "depth": [4, 8], "min_split": [2, 5], "min_leaf": [1, 2]}
MLP_GRID = {"hidden": [8, 16], "step": [0.05, 0.1], "epochs": [200, 300]}

# Segmentation.
SEGMENTS = 4
SEGMENT_RESTARTS = 10
SEGMENT_ITERATIONS = 50
SEGMENT_FEATURES = ("age", "bmi", "income_k", "glp1_aware", "cost_sensitive", "tech_savvy")

# Bootstrap.
BOOTSTRAP_REPLICATES = 2000
BOOTSTRAP_LEVEL = 0.95
