"""Declared table schemas and the columns derived from them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEY = "bib_id"

# Raw column names, order and types of the six monthly tables.
RAW_DDL = {
    "loan_assign": """
        bib_id STRING NOT NULL, date_key STRING, fake_id STRING, nid_hash STRING,
        loan_id STRING, loan_amount DOUBLE, date_timestamp STRING""",
    "loan_recovery": """
        bib_id STRING NOT NULL, date_key STRING, fake_id STRING, nid_hash STRING,
        loan_id STRING, loan_amount DOUBLE, hsdp_recovery DOUBLE, date_timestamp STRING""",
    "package": """
        bib_id STRING NOT NULL, date_key STRING, fake_id STRING, nid_hash STRING,
        offering_code STRING, offer_amount DOUBLE, offering_name STRING,
        activation_date STRING, deactivation_date STRING""",
    "recharge": """
        bib_id STRING NOT NULL, date_key STRING, fake_id STRING, nid_hash STRING,
        recharge_value_amt DOUBLE, recharge_dt STRING, origin_host_nm STRING,
        account_balance_before_amt DOUBLE, account_balance_after_amt DOUBLE""",
    "cdr": """
        bib_id STRING NOT NULL, date_key STRING, fake_id STRING, nid_hash STRING,
        sms_count INT, voice_count INT, call_duration DOUBLE, gprs_usage DOUBLE,
        voice_session_cos DOUBLE""",
    "user": """
        bib_id STRING NOT NULL, fake_id STRING, nid_hash STRING, contract_type_v STRING,
        gender_v STRING, registration_date_d STRING, date_of_birth_d STRING,
        ability_status STRING, account_balance DOUBLE, base_station_cd STRING,
        sitei STRING""",
}

# Text columns that become timestamps or dates when a table is loaded.
TIMESTAMP_COLUMNS = {
    "loan_assign": ["date_timestamp"],
    "loan_recovery": ["date_timestamp"],
    "package": ["activation_date", "deactivation_date"],
    "recharge": ["recharge_dt"],
    "cdr": [],
    "user": [],
}
DATE_COLUMNS = {
    "loan_assign": ["date_key"],
    "loan_recovery": ["date_key"],
    "package": ["date_key"],
    "recharge": ["date_key"],
    "cdr": ["date_key"],
    "user": ["registration_date_d", "date_of_birth_d"],
}

# Names of the derived feature columns, in output order.
AMOUNT_FEATURES = [
    "CountAssignLoanAmount",
    "MedianAssignLoanAmount",
    "CountRecoveryLoanAmount",
    "MedianRecoveryLoanAmount",
    "CountPackage",
    "MedianPackageAmount",
    "MedianPackageDuration",
    "CountRecharge",
    "MedianRechargeAmount",
]
USAGE_FEATURES = ["SumSMSCount", "SumVoiceCount", "SumCallDuration", "SumGPRSUsage"]
CATEGORICAL_FEATURES = ["contract_type_v", "gender_v", "ability_status"]
USER_FEATURES = ["age", "registration_year", *CATEGORICAL_FEATURES, "account_balance"]

TABLES = list(RAW_DDL)


def raw_schema(table: str) -> StructType:
    """Schema of a table as it arrives in CSV, with dates still as text."""
    return StructType.fromDDL(RAW_DDL[table])


def loaded_schema(table: str) -> StructType:
    """Schema of a table once its date columns are parsed."""
    ddl = {f.name: f.dataType.simpleString() for f in raw_schema(table)}
    ddl.update(dict.fromkeys(TIMESTAMP_COLUMNS[table], "timestamp"))
    ddl.update(dict.fromkeys(DATE_COLUMNS[table], "date"))
    return StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in ddl.items()))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in declared order and type; absent ones are null."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )
