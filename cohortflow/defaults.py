"""Codes, thresholds, ranges and names that decide results."""

# Code set that selects the cohort.
COHORT_CODES = ("44054006",)
MIN_AGE = 18

# Windows, in days.
LOOKBACK_DAYS = 180
PREDICTION_DAYS = 90
HORIZON_DAYS = (30, 90, 180)

POSITIVE_CLASSES = ("emergency", "inpatient", "urgentcare")

# Measurement codes, and the description terms used when a code list is empty.
HBA1C_CODES = ("4548-4", "17856-6")
SBP_CODES = ("8480-6",)
DBP_CODES = ("8462-4",)
HBA1C_TERM = "A1c"
SBP_TERM = "systolic"
DBP_TERM = "diastolic"

FEATURES = (
    "n_observations_180d",
    "n_encounters_180d",
    "n_active_meds_180d",
    "hba1c_last",
    "hba1c_mean",
    "hba1c_std",
    "sbp_last",
    "dbp_last",
)
ID_COLUMNS = ("patient", "as_of")
TARGET = "label_90d"
NOT_FEATURES = ("patient", "as_of", "label_90d", "prediction_proba", "prediction")

# Clinical bands: (upper bound, exclusive; name), the last one open.
HBA1C_BANDS = ((5.7, "normal"), (6.5, "prediabetic"), (None, "diabetic"))
SBP_BANDS = ((120.0, "normal"), (130.0, "elevated"), (140.0, "stage1"), (None, "high"))
DBP_BANDS = ((80.0, "normal"), (90.0, "elevated"), (None, "high"))

# Decision thresholds on the calibrated score.
THRESHOLDS = {
    "high_sensitivity": 0.25,
    "balanced": 0.35,
    "high_ppv": 0.45,
    "conservative": 0.60,
}
SWEEP_RANGE = (0.1, 0.9)
SWEEP_STEPS = 50
SWEEP_FOLDS = 5

RISK_HIGH = 0.5
RISK_MEDIUM = 0.25
ADVICE = {
    "high": "Have a clinician look at this case today.",
    "medium": "Check again soon; prevention may help.",
    "low": "No change to the usual care.",
}

# Minimum quality gate.
GATE_AUROC = 0.65
GATE_AUPRC = 0.30
GATE_BRIER = 0.30

# Drift.
SIGNIFICANCE = 0.05
PSI_BINS = 10
PSI_FLOOR = 0.0001
PSI_LIMIT = 0.1
DRIFT_RATE_LIMIT = 0.1

# Performance decline; metrics for which lower is better.
DEGRADATION_LIMIT = 0.05
LOWER_IS_BETTER = ("brier_score",)
TREND_WINDOW = 10
TREND_FLAT = 0.001

# Fairness.
PARITY_LIMIT = 0.1
GROUP_VARIANCE_LIMIT = 0.01

RETRAIN_AFTER_DAYS = 30

# Request limits: feature -> (low, high, required), inclusive.
FEATURE_RANGES = {
    "n_observations_180d": (0, 1000, True),
    "n_encounters_180d": (0, 100, True),
    "n_active_meds_180d": (0, 50, True),
    "hba1c_last": (3.0, 15.0, False),
    "hba1c_mean": (3.0, 15.0, False),
    "hba1c_std": (0.0, 5.0, False),
    "sbp_last": (60, 250, False),
    "dbp_last": (40, 150, False),
}
HBA1C_MEAN_GAP = 3.0
ID_LENGTH = (1, 100)
BATCH_SIZE = (1, 1000)

# Classifier settings.
VALIDATION_SHARE = 0.25
SEED = 42
GBT = {
    "maxIter": 500,
    "stepSize": 0.05,
    "maxDepth": 5,
    "subsamplingRate": 0.9,
    "featureSubsetStrategy": "0.9",
    "minInstancesPerNode": 50,
}
KEY_PARAMETERS = ("learning_rate", "n_estimators", "max_depth")
BACKGROUND_ROWS = 100
ADDITIVITY_TOLERANCE = 1e-3

# Fixed texts of the reports.
DEGRADATION_ALERT = "Performance degradation detected in %s: %.3f → %.3f (change: %+.3f)"
DRIFT_ALERT = "Data drift detected in %s features"
BIAS_ALERT = "Bias detected in %s attributes"
EXPLANATION_HEAD = """# Why this score
Entity %s, written %s

- score %.3f (%s)
- score without any feature %.3f

## Largest shares
"""
EXPLANATION_FEATURE = """%d. %s
   - value %s
   - share %+.3f, which %s the score
"""
EXPLANATION_TAIL = """## How to read this
Shares above zero raise the score and shares below zero lower it. They describe the model, not causes,
and do not replace a clinician's judgement."""

# Metrics that runs are compared by unless others are named: those of a metrics document.
RUN_METRICS = ("auroc_calibrated", "auprc_calibrated", "brier_calibrated")
