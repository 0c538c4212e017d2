"""Published policy numbers and wordings the operators apply.

Everything in this module is data that has to equal the published policy for
results to be right. Operators take these as defaults and accept replacements.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Base score of each extraction mechanism.
TIER_SCORES = {
    "xbrl": 0.95,
    "structured_xml": 0.92,
    "derived": 0.75,
    "html_table": 0.72,
    "text_pattern": 0.66,
    "narrative_llm": 0.55,
}

# Lowest score of each grade; anything lower is suppressed.
GRADE_CUTS = (("High", 0.85), ("Medium", 0.65), ("Low", 0.40))
SUPPRESSED = "Suppressed"
SCORE_FLOOR = 0.40

# unit -> (absolute tolerance, relative tolerance); other units read as pct.
TOLERANCES = {"pct": (0.10, 0.010), "ratio": (0.02, 0.015), "usd": (0.02, 0.002)}

AGREEMENT_CORROBORATED = 1.10
AGREEMENT_SINGLE = 0.90
AGREEMENT_CONFLICT = 0.70

# Flag multipliers. An exact name wins; otherwise the first entry, in this
# order, that the flag starts or ends with; otherwise the unknown-flag value.
FLAG_MULTIPLIERS = (
    ("out_of_sane_range", 0.30),
    ("implausibly_low_for_entity_type", 0.35),
    ("fee_table_from_", 0.60),
    ("zero_borrowings_but_material_total_liabilities", 0.55),
    ("reit_book_value_not_nav", 0.80),
    ("incomplete_distributions_", 0.80),
    ("ttm_window_incomplete", 0.85),
    ("nav_history_gap_", 0.85),
    ("fund_level_not_share_class_specific", 0.85),
    ("outside_class_return_band", 0.50),
    ("includes_unsettled_trades_and_payables", 0.90),
    ("distribution_period_derived", 0.95),
    ("_distribution_periods_derived", 0.95),
    ("llm_low_agreement", 0.65),
    ("single_extraction_pass", 0.90),
    ("superseded_rate_present_in_source", 0.85),
    ("rate_not_restated_within_window", 0.93),
    ("inferred_from_absence", 0.80),
    ("rate_from_worked_example", 0.88),
    ("implausible_incentive_fee_rate", 0.35),
    ("fee_denominator_unstated", 0.92),
)
UNKNOWN_FLAG_MULTIPLIER = 0.90

# Age in days up to which each freshness factor applies.
FRESHNESS_BANDS = ((100, 1.00), (200, 0.95), (400, 0.85))
FRESHNESS_STALE = 0.70
STALE_LIMIT_DAYS = 183

OUT_OF_RANGE_FLAG = "out_of_sane_range"
ZERO_BORROWINGS_FLAG = "zero_borrowings_but_material_total_liabilities"
DISQUALIFYING_FLAGS = (ZERO_BORROWINGS_FLAG,)
NON_MEASUREMENT_FLAGS = ("superseded_rate",)

# Typed reasons for a blank, and the reason code and label a reader sees.
REASON_CODES = {
    "not_applicable": "not_applicable",
    "no_candidate": "no_value_found",
    "insufficient_history": "not_computable",
    "window_mismatch": "not_computable",
    "class_attribution_failed": "class_unattributed",
    "stale_beyond_limit": "stale",
    "below_confidence_floor": "low_evidence",
    "basis_disqualified": "basis_not_measured",
    "wrong_share_class": "wrong_share_class",
}
REASON_LABELS = {
    "not_applicable": "not reported at this basis",
    "not_yet_filed": "institutional figure not yet filed",
    "stale": "no figure within staleness window",
    "no_value_found": "no figure located in filings",
    "not_computable": "insufficient history to compute",
    "class_unattributed": "share class not identifiable in filing",
    "low_evidence": "evidence too weak to report",
    "conflicted": "sources disagree; not resolved",
    "basis_not_measured": "reported basis does not measure this metric",
    "wrong_share_class": "fund-level only; institutional figure not available",
    "basis_unconfirmed": "basis unconfirmed",
}

# Who could close each kind of gap. CLIENT has no reason mapped to it today.
GAP_OWNERS = {
    "not_applicable": "STRUCTURAL",
    "basis_disqualified": "STRUCTURAL",
    "class_attribution_failed": "OURS",
    "stale_beyond_limit": "CADENCE",
    "insufficient_history": "OURS",
    "window_mismatch": "STRUCTURAL",
    "no_candidate": "OURS",
    "below_confidence_floor": "OURS",
    "wrong_share_class": "STRUCTURAL",
}
OWNER_BUCKETS = ("FILLED", "OURS", "CADENCE", "CLIENT", "STRUCTURAL")

# Run-over-run comparison.
GRADE_RANK = {"High": 3, "Medium": 2, "Low": 1}
RELATIVE_MOVE = 0.25

# Trailing windows: years -> days the window start may miss its target.
WINDOW_TOLERANCE_DAYS = {1: 20, 3: 45, 5: 60}
MAX_GAP_DAYS = 200
YEAR_DAYS = 365.25
MONTH_DAYS = 30.44
QUARTER_DAYS = (80, 100)
COVERAGE_SLACK_DAYS = 7
BAND_SLACK = 0.05
RESIDUAL_TOLERANCE = 1e-9

# Forms a closed-end fund, an operating filer and a REIT are recognised by.
INTERVAL_FORMS = ("N-CSR", "N-CSRS", "NPORT-P", "486BPOS")
OPERATING_FORMS = ("10-K", "10-Q")
ANNUAL_FORMS = ("10-K", "N-CSR")
REIT_SIC = ("6798",)
INVESTMENT_SIC = ("6726", "6199", "")

# Forms that could carry an amendment of contractual terms, per entity type.
AMENDABLE_FORMS = {
    "bdc": ("10-K", "10-Q", "8-K", "DEF 14A", "424B2", "497"),
    "mortgage_reit": ("10-K", "10-Q", "8-K", "DEF 14A"),
    "interval_fund": ("486BPOS", "497", "424B3", "N-CSR", "N-CSRS"),
}
# Forms whose prose states the terms in force, per entity type, best first.
NARRATIVE_FORMS = {
    "interval_fund": ("486BPOS", "424B3", "N-CSR"),
    "bdc": ("10-K", "424B2"),
    "mortgage_reit": ("10-K",),
}
TRUSTED_FEE_FORMS = ("N-2", "N-2/A", "486BPOS", "497", "424B3")
MIN_PLAUSIBLE_FEE = 0.25
MATERIAL_LIABILITY_RATIO = 0.10

# The built-in metrics: key, label, unit, direction, plausible range.
BUILTIN_METRICS = (
    ("net_return_1y_pct", "Net return, trailing 1Y (ann.)", "pct", 1, -50.0, 50.0),
    ("net_return_3y_pct", "Net return, trailing 3Y (ann.)", "pct", 1, -50.0, 50.0),
    ("net_return_5y_pct", "Net return, trailing 5Y (ann.)", "pct", 1, -50.0, 50.0),
    ("management_fee_pct", "Management fee", "pct", -1, 0.0, 5.0),
    ("incentive_fee_pct", "Incentive fee", "pct", -1, 0.0, 30.0),
    ("incentive_hurdle_pct", "Incentive hurdle", "pct", 1, 0.0, 15.0),
    ("nav_per_share_usd", "NAV per share", "usd", 0, 0.5, 500.0),
    ("leverage_regulatory_dte", "Leverage (D/E), regulatory", "ratio", 0, 0.0, 5.0),
    ("leverage_economic_dte", "Leverage (D/E), economic", "ratio", 0, 0.0, 5.0),
    ("distribution_yield_pct", "Distribution yield (ann.)", "pct", 1, 0.0, 30.0),
)
RETURN_METRICS = {1: "net_return_1y_pct", 3: "net_return_3y_pct", 5: "net_return_5y_pct"}
TERMS_METRICS = ("management_fee_pct", "incentive_fee_pct", "incentive_hurdle_pct")
CLASS_REQUIRED_METRICS = tuple(RETURN_METRICS.values())
METRIC_UNITS = ("pct", "usd", "ratio", "count", "years")

# Which construction wins, per metric, when several are defensible.
BASIS_PREFERENCE = {
    "distribution_yield_pct": (
        ("yield_basis", "current_quarter_annualized"),
        ("yield_basis", "trailing_12m"),
    ),
    "nav_per_share_usd": (
        ("measure", "nav_per_share"),
        ("measure", "book_value_per_share"),
    ),
    "management_fee_pct": (
        ("fee_basis", "stated_annual_rate"),
        ("fee_basis", "pct_of_net_assets"),
        ("fee_basis", "stated_rate"),
        ("fee_basis", "as_tagged"),
    ),
    "incentive_fee_pct": (
        ("fee_basis", "stated_rate"),
        ("fee_basis", "pct_of_net_assets"),
        ("fee_basis", "as_tagged"),
    ),
}
