"""What a scoring table looks like: key, label, feature lists, corrections."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Column names of the raw extract, in file order.
RAW_INTEGER = ["ID", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
RAW_COLUMNS = [
    "ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
    "BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6",
    "PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6",
]
RAW_TARGET = "default.payment.next.month"

# Names after cleaning, and which of them are robust-scaled.
KEY = "Id"
LABEL = "Default"
UPDATED_AT = "Update_timestamp_utc"
CATEGORIES = ["Sex", "Education", "Marriage", "Age", "Pay_0", "Pay_2", "Pay_3", "Pay_4", "Pay_5", "Pay_6"]
BILLS = ["Bill_amt1", "Bill_amt2", "Bill_amt3", "Bill_amt4", "Bill_amt5", "Bill_amt6"]
PAYMENTS = ["Pay_amt1", "Pay_amt2", "Pay_amt3", "Pay_amt4", "Pay_amt5", "Pay_amt6"]
FEATURES = ["Limit_bal", *CATEGORIES, *BILLS, *PAYMENTS]
ROBUST = ["Limit_bal", *BILLS, *PAYMENTS]

# Code corrections by column-name prefix ("Pay" also covers Pay_amt1..6).
CORRECTIONS = {
    "Education": {0: 4, 5: 4, 6: 4},
    "Marriage": {0: 3},
    "Pay": {-1: 0, -2: 0},
}

# Category codes expected after cleaning.
DOMAINS = {
    "Education": [1, 2, 3, 4],
    "Marriage": [1, 2, 3],
    "Pay_6": [0, 1, 2, 3, 4, 5, 6, 7, 8],
}

# Drifted columns and factor, alert threshold in percent, monitor window, training parameters.
DRIFT_COLUMNS = ["Limit_bal", "Age", "Pay_0", "Bill_amt1"]
DRIFT_FACTOR = 1.5
ALERT_BELOW_PERCENT = 42
MONITOR_WINDOW = "30 minutes"
SEED = 42
LEARNING_RATE = 0.05
LEARNING_RATE_B = 0.1
TEST_SHARE = 0.2
SMOTE_NEIGHBOURS = 5


@dataclass(frozen=True)
class TableSpec:
    """Names and constants shared by the operators; every field can be replaced."""

    key: str = KEY
    label: str = LABEL
    updated_at: str = UPDATED_AT
    raw_target: str = RAW_TARGET
    features: tuple[str, ...] = tuple(FEATURES)
    robust: tuple[str, ...] = tuple(ROBUST)
    categories: tuple[str, ...] = tuple(CATEGORIES)
    corrections: Mapping[str, Mapping[int, int]] = field(default_factory=lambda: CORRECTIONS)
    domains: Mapping[str, list] = field(default_factory=lambda: DOMAINS)
    seed: int = SEED

    @property
    def clean(self) -> list[str]:
        """Key and features, in table order."""
        return [self.key, *self.features]

    @property
    def scaled_order(self) -> list[str]:
        """Feature order after scaling: scaled columns first, the rest as they were."""
        return [*self.robust, *(c for c in self.features if c not in self.robust)]


CREDIT = TableSpec()
