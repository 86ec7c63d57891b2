"""Table schemas, size limits and the fixed vocabulary of the churn model."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
REVENUE = T.DecimalType(12, 2)
SCORE = T.DecimalType(3, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_INT, _LONG, _STR = T.IntegerType(), T.LongType(), T.StringType()
_BOOL, _TS = T.BooleanType(), T.TimestampType()

# Column names and types every layer must expose.
RAW = _schema(
    CustomerID=_INT, Age=_INT, Gender=_STR, Tenure=_INT, MonthlyCharges=MONEY,
    ContractType=_STR, InternetService=_STR, TotalCharges=MONEY, TechSupport=_STR, Churn=_STR,
)
BRONZE = _schema(
    **{f.name.lower(): f.dataType for f in RAW},
    ingestion_timestamp=_TS, source_file=_STR, pipeline_run_id=_STR,
)
SILVER = _schema(
    customer_id_anonymized=_STR, age=_INT, gender=_STR, tenure=_INT, monthly_charges=MONEY,
    contract_type=_STR, internet_service=_STR, total_charges=MONEY, tech_support=_STR, churn=_STR,
    avg_monthly_spend=MONEY, transformation_timestamp=_TS, source_pipeline=_STR,
    data_quality_score=SCORE,
)
DIM_CUSTOMER = _schema(
    customer_sk=_LONG, customer_id_anonymized=_STR, age=_INT, gender=_STR, tenure_months=_INT,
    tenure_category=_STR, effective_date=_TS, is_current=_BOOL,
)
DIM_SERVICE = _schema(
    internet_service=_STR, tech_support=_STR, service_bundle_type=_STR, service_sk=_LONG,
)
DIM_CONTRACT = _schema(contract_type=_STR, contract_duration_months=_INT, contract_sk=_LONG)
FACT = _schema(
    fact_sk=_LONG, customer_sk=_LONG, service_sk=_LONG, contract_sk=_LONG, date_sk=_INT,
    monthly_charges=MONEY, total_charges=MONEY, avg_monthly_spend=MONEY, total_revenue=REVENUE,
    is_churned=_BOOL, churn_risk_score=SCORE, created_timestamp=_TS, updated_timestamp=_TS,
)

# Types of raw columns that appear under another name in some extracts.
RAW_VARIANT_TYPES = {"seniorcitizen": _INT, "contract": _STR}

# Silver names and the raw names each may arrive under, in order of preference.
SILVER_VARIANTS = {
    "monthly_charges": ["monthlycharges"],
    "total_charges": ["totalcharges"],
    "internet_service": ["internetservice"],
    "tech_support": ["techsupport"],
    "contract_type": ["contract", "contracttype"],
}
SILVER_FALLBACKS = {"age": ["seniorcitizen"]}
SILVER_TEXT_COLUMNS = ["gender", "contract_type", "internet_service", "tech_support", "churn"]
SILVER_SOURCE_NAME = "pyspark_silver"

# Text that a CSV scan reads as a missing value (the usual data-frame defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
UNKNOWN_TEXT = "Unknown"

# Text of scanned rows that have more fields than their header; never filled.
LONG_ROW_COLUMN = "unparsed_row"

# Labels, band edges, bundle names and scores of the gold model.
TENURE_BANDS = [(12, "0-12 months"), (24, "13-24 months"), (48, "25-48 months")]
TENURE_OPEN_BAND = "49+ months"
CONTRACT_MONTHS = {"month-to-month": 1, "one-year": 12, "two-year": 24}
CONTRACT_MONTHS_OTHER = 0
NO_SERVICE = "unknown"
YES = "yes"
BUNDLE_PREMIUM, BUNDLE_STANDARD, BUNDLE_BASIC = "Premium", "Standard", "Basic"
RISK_CHURNED, RISK_NEW, RISK_OTHER = "1.0", "0.7", "0.3"
RISK_NEW_BELOW_MONTHS = 12
DATE_SK = 1

# Declared text lengths and numeric (precision, scale) per table.
LIMITS: dict[str, dict[str, int | tuple[int, int]]] = {
    "bronze": {
        "gender": 20, "contracttype": 50, "internetservice": 50, "techsupport": 50, "churn": 10,
        "source_file": 255, "pipeline_run_id": 255,
        "monthlycharges": (10, 2), "totalcharges": (10, 2),
    },
    "silver": {
        "customer_id_anonymized": 64, "gender": 20, "contract_type": 50, "internet_service": 50,
        "tech_support": 50, "churn": 10, "source_pipeline": 255, "monthly_charges": (10, 2),
        "total_charges": (10, 2), "avg_monthly_spend": (10, 2), "data_quality_score": (3, 2),
    },
    "dim_customer": {"customer_id_anonymized": 64, "gender": 20, "tenure_category": 20},
    "dim_service": {"internet_service": 50, "tech_support": 50, "service_bundle_type": 50},
    "dim_contract": {"contract_type": 50},
    "fact_customer_churn": {
        "monthly_charges": (10, 2), "total_charges": (10, 2), "avg_monthly_spend": (10, 2),
        "total_revenue": (12, 2), "churn_risk_score": (3, 2),
    },
}

# (layer, table) -> schema. Raw and silver table names are ours; a LayerStore may map others.
TABLES: dict[tuple[str, str], T.StructType] = {
    ("bronze", "subscribers"): BRONZE,
    ("silver", "subscribers"): SILVER,
    ("gold", "dim_customer"): DIM_CUSTOMER,
    ("gold", "dim_service"): DIM_SERVICE,
    ("gold", "dim_contract"): DIM_CONTRACT,
    ("gold", "fact_customer_churn"): FACT,
}
GOLD_TABLES = [table for layer, table in TABLES if layer == "gold"]
