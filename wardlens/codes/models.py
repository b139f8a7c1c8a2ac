"""Coefficients of the risk score, current and earlier versions (fixed values)."""

from wardlens.operators.score import ScoreModel, Term

CURRENT = ScoreModel(
    "current",
    "-10.7102",
    (
        Term("inf_prev_num", "1.058"),
        Term("icu_prev_num", "0.7964"),
        Term("patient_age_at_visit", "0.0129"),
        Term("cci_score", "0.0338"),
        Term("los_prev_mean", "0.0143"),
        Term("prev_dot_log", "0.3348", "nearest"),
        Term("diabetes_num", "0.5179"),
    ),
)

FIRST = ScoreModel(
    "undated",
    "-10.1571",
    (
        Term("inf_prev_num", "1.4302"),
        Term("icu_prev_num", "0.8062"),
        Term("prior_hosp", "0.0209"),
        Term("cci_score", "0.2153"),
        Term("los_prev_mean", "0.0146"),
        Term("prev_blactam", "0.0214"),
    ),
)

JANUARY_2024 = ScoreModel(
    "2024-01-16",
    "-9.8147",
    (
        Term("inf_prev_num", "1.4157"),
        Term("icu_prev_num", "0.8817"),
        Term("prior_hosp", "0.0245"),
        Term("cci_score", "0.0387"),
        Term("los_prev_mean", "0.0151"),
        Term("prev_blactam", "0.0197"),
        Term("diabetes_num", "0.549"),
    ),
)

FEBRUARY_2024 = ScoreModel(
    "2024-02-15",
    "-10.7102",
    (
        Term("inf_prev_num", "1.058"),
        Term("icu_prev_num", "0.7964"),
        Term("patient_age_at_visit", "0.0129"),
        Term("cci_score", "0.0338"),
        Term("los_prev_mean", "0.0143"),
        Term("prev_dot_log", "0.3348"),
        Term("diabetes_num", "0.5179"),
    ),
)

ALL = (FIRST, JANUARY_2024, FEBRUARY_2024, CURRENT)
