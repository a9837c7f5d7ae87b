"""Schemas of the source tables and of the derived stage tables, as DDL text."""

PATIENTS = """Id string, BirthDate date, DeathDate date, SSN string, Drivers string,
    Passport string, Prefix string, First string, Last string, Suffix string,
    Maiden string, Marital string, Race string, Ethnicity string, Gender string,
    Birthplace string, Address string, City string, State string, County string,
    Zip string, Lat double, Lon double, Healthcare_Expenses bigint,
    Healthcare_Coverage bigint"""

CONDITIONS = """Start date, Stop date, Patient string, Encounter string, Code string,
    Description string, System string"""

ENCOUNTERS = """Id string, Start timestamp, Stop timestamp, Patient string, Organization string,
    Provider string, Payer string, EncounterClass string, Code string, Description string,
    Base_Encounter_Cost bigint, Total_Claim_Cost bigint, Payer_Coverage bigint,
    ReasonCode string, ReasonDescription string"""

OBSERVATIONS = """Date timestamp, Patient string, Encounter string, Category string, Code string,
    Description string, Value string, Units string, Type string"""

MEDICATIONS = """Start timestamp, Stop timestamp, Patient string, Payer string, Encounter string,
    Code string, Description string, Base_Cost bigint, Payer_Coverage bigint,
    Dispenses bigint, TotalCost bigint, ReasonCode string, ReasonDescription string"""

SOURCES = {
    "patients": PATIENTS,
    "conditions": CONDITIONS,
    "encounters": ENCOUNTERS,
    "observations": OBSERVATIONS,
    "medications": MEDICATIONS,
}

COHORT = "patient string, age int, as_of timestamp"
LABELS = "patient string, as_of timestamp, label_90d int"
FEATURES = """patient string, as_of timestamp, n_observations_180d bigint,
    n_encounters_180d bigint, n_active_meds_180d bigint, hba1c_last double,
    hba1c_mean double, hba1c_std double, sbp_last double, dbp_last double"""

# Metrics document written by the evaluation stage.
METRICS_REPORT = """metrics struct<auroc_raw: double, auroc_calibrated: double, auprc_raw: double,
    auprc_calibrated: double, brier_raw: double, brier_calibrated: double>,
    confusion_matrices map<string, struct<threshold: double,
    confusion_matrix: struct<tn: bigint, fp: bigint, fn: bigint, tp: bigint>,
    metrics: struct<sensitivity: double, specificity: double, ppv: double, npv: double,
    f1: double>>>"""
