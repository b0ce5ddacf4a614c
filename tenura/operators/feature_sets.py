"""What is aggregated per subscriber from each table, as data and SQL."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field

from tenura.schemas import USER_FEATURES

DAYS_PER_YEAR = 365.25
DURATION_SQL = "datediff(deactivation_date, activation_date)"


@dataclass(frozen=True)
class FeatureSet:
    """What to aggregate per key from one table: a row count, medians and sums."""

    count: str | None = None
    medians: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [*([self.count] if self.count else []), *self.medians, *self.sums]

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.medians.values(), *self.sums.values()]))


# Features of each table and the columns they come from.
FEATURE_SETS = {
    "loan_assign": FeatureSet(
        "CountAssignLoanAmount", {"MedianAssignLoanAmount": "loan_amount"}
    ),
    "loan_recovery": FeatureSet(
        "CountRecoveryLoanAmount", {"MedianRecoveryLoanAmount": "loan_amount"}
    ),
    "package": FeatureSet(
        "CountPackage",
        {"MedianPackageAmount": "offer_amount", "MedianPackageDuration": "duration"},
    ),
    "recharge": FeatureSet("CountRecharge", {"MedianRechargeAmount": "recharge_value_amt"}),
    "cdr": FeatureSet(
        sums={
            "SumSMSCount": "sms_count",
            "SumVoiceCount": "voice_count",
            "SumCallDuration": "call_duration",
            "SumGPRSUsage": "gprs_usage",
        }
    ),
}


def ranked_attributes_sql(as_of: datetime.date) -> str:
    """Attributes of a user row as a struct; the least one of a key has the fewest nulls."""
    derived = {
        "age": f"datediff(DATE '{as_of.isoformat()}', date_of_birth_d) / {DAYS_PER_YEAR}D",
        "registration_year": "year(registration_date_d)",
    }
    values = {c: derived.get(c, f"`{c}`") for c in USER_FEATURES}
    nulls = " + ".join(f"int(({v}) IS NULL)" for v in values.values())
    fields = ", ".join(f"'{c}', {v}" for c, v in values.items())
    return f"named_struct('nulls', {nulls}, {fields})"
