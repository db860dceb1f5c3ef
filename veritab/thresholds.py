"""Threshold configuration.

Fixed values: these limits, bands and labels must equal the monitored project's defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values (must match the reference defaults) ----
# data quality limits
MISSING_VALUES_THRESHOLD = 0.1
DUPLICATE_ROWS_THRESHOLD = 0.05
OUTLIERS_THRESHOLD = 0.05
QUALITY_SCORE_THRESHOLD = 0.8
QUALITY_SCORE_DEFAULT = 0.8
# drift limits
STATISTICAL_TEST_THRESHOLD = 0.05
PSI_THRESHOLD = 0.25
KL_DIVERGENCE_THRESHOLD = 0.1
WASSERSTEIN_THRESHOLD = 0.1
DATASET_DRIFT_SHARE = 0.3
DRIFTED_FEATURES_SHARE = 0.3
COLUMN_DRIFT_SCORE_ALERT = 0.5
DRIFT_CAUSE_SCORE = 0.3
# performance limits
ACCURACY_THRESHOLD = 0.85
RECALL_THRESHOLD = 0.90
PRECISION_THRESHOLD = 0.80
F1_THRESHOLD = 0.85
PREDICTION_DRIFT_THRESHOLD = 0.1
PERFORMANCE_TREND_THRESHOLD = 0.05
# percent quality bands: >= 90 good, >= 70 warning, else critical
QUALITY_BANDS = ((90.0, "good"), (70.0, "warning"))
QUALITY_BAND_ELSE = "critical"
# drift bands: < 0.1 stable, < 0.3 minor, else high
DRIFT_BANDS = ((0.1, "stable"), (0.3, "minor"))
DRIFT_BAND_ELSE = "high"
# CV drift: divisor floor and cap
CV_DIVISOR_FLOOR = 0.001
CV_DRIFT_CAP = 1.0
# single-table CV score factor: min(1, 10 * cv)
CV_SCORE_FACTOR = 10.0
# prediction confidence bands, probability >= 0.9, 0.8, 0.7, 0.6, else
CONFIDENCE_BANDS = ((0.9, "Molto Alta"), (0.8, "Alta"), (0.7, "Media"), (0.6, "Bassa"))
CONFIDENCE_BAND_ELSE = "Molto Bassa"
# prediction label text for 1 / 0
LABEL_POSITIVE = "Maligno"
LABEL_NEGATIVE = "Benigno"
# IQR fence factor
IQR_FACTOR = 1.5
# strong correlation limit
CORRELATION_LIMIT = 0.7
# ---- end of fixed values ----


@dataclass(frozen=True)
class Thresholds:
    missing_values: float = MISSING_VALUES_THRESHOLD
    duplicate_rows: float = DUPLICATE_ROWS_THRESHOLD
    outliers: float = OUTLIERS_THRESHOLD
    quality_score: float = QUALITY_SCORE_THRESHOLD
    statistical_test: float = STATISTICAL_TEST_THRESHOLD
    psi: float = PSI_THRESHOLD
    kl_divergence: float = KL_DIVERGENCE_THRESHOLD
    wasserstein: float = WASSERSTEIN_THRESHOLD
    dataset_drift_share: float = DATASET_DRIFT_SHARE
    accuracy: float = ACCURACY_THRESHOLD
    recall: float = RECALL_THRESHOLD
    precision: float = PRECISION_THRESHOLD
    f1: float = F1_THRESHOLD
    prediction_drift: float = PREDICTION_DRIFT_THRESHOLD


DEFAULT = Thresholds()
