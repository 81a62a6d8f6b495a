"""Column roles and fixed rule constants.

Every operator in the package is column-generic: it takes a ``SegmentSpec``
(or plain column names) instead of hard-coding the telecom schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published behaviour for results to match
# (thresholds, word lists, action texts, category orders). Stated plainly.
# ---------------------------------------------------------------------------

ID_COL = "customerID"
TARGET_COL = "Churn"
POSITIVE_VALUE = "Yes"

NUMERICAL = ["tenure", "MonthlyCharges", "TotalCharges", "avg_monthly_spend", "service_diversity"]
RAW_NUMERICAL = ["tenure", "MonthlyCharges", "TotalCharges"]
BINARY_YES_NO = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
CATEGORICAL = [
    "gender", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "PaymentMethod",
]
SERVICES = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
CONTRACT_ORDINAL = {"Month-to-month": 0, "One year": 1, "Two year": 2}
AUTO_PAYMENT_METHODS = ["Bank transfer (automatic)", "Credit card (automatic)"]
# tenure groups: [0, 12] -> 0, (12, 48] -> 1, (48, 72] -> 2, otherwise null
TENURE_GROUP_EDGES = [0, 12, 48, 72]

# column order of the raw 21-column record
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

# allowed values of an input record (scoring validation)
DOMAINS = {
    "gender": ["Female", "Male"],
    "SeniorCitizen": [0, 1],
    "Partner": ["No", "Yes"],
    "Dependents": ["No", "Yes"],
    "PhoneService": ["No", "Yes"],
    "PaperlessBilling": ["No", "Yes"],
    "MultipleLines": ["No", "Yes", "No phone service"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    "OnlineSecurity": ["No", "Yes", "No internet service"],
    "OnlineBackup": ["No", "Yes", "No internet service"],
    "DeviceProtection": ["No", "Yes", "No internet service"],
    "TechSupport": ["No", "Yes", "No internet service"],
    "StreamingTV": ["No", "Yes", "No internet service"],
    "StreamingMovies": ["No", "Yes", "No internet service"],
    "Contract": ["Month-to-month", "One year", "Two year"],
    "PaymentMethod": ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"],
}
TENURE_RANGE = (0, 72)
MONTHLY_RANGE = (0.0, 150.0)

# churn risk levels (scoring): >= 0.40 High, >= 0.25 Medium, else Low
HIGH_CHURN = 0.40
MEDIUM_CHURN = 0.25

# segment naming words and thresholds
SPENDING_WORDS = [(80.0, "Premium"), (55.0, "Standard")]  # strict >, else "Budget"
SPENDING_DEFAULT = "Budget"
TENURE_WORDS = [(15.0, "New"), (45.0, "Established")]  # strict <, else "Loyal"
TENURE_DEFAULT = "Loyal"
SERVICE_HIGH, SERVICE_HIGH_WORD = 4.0, "Tech-Savvy"  # > 4
SERVICE_LOW, SERVICE_LOW_WORD = 2.0, "Basic"  # < 2
RISK_HIGH, RISK_HIGH_WORD = 0.40, "High-Risk"  # > 0.40
RISK_LOW, RISK_LOW_WORD = 0.15, "Stable"  # < 0.15
CONTRACT_WORDS = {"Two year": "Committed", "Month-to-month": "Flexible"}

# primary insight statements
INSIGHT_HIGH_CHURN = 0.35
INSIGHT_LOW_CHURN = 0.15
INSIGHT_NEW_TENURE = 15.0
INSIGHT_LOYAL_TENURE = 50.0
INSIGHT_HIGH_SPEND = 80.0
INSIGHT_LOW_SPEND = 40.0
INSIGHT_HEAVY_SERVICE = 4.0
INSIGHT_BASIC_SERVICE = 2.0
TXT_NEW = "New customers"
TXT_LOYAL = "Long-tenure loyal customers"
TXT_HIGH_SPEND = "High spenders"
TXT_LOW_SPEND = "Price-sensitive"
TXT_HEAVY = "Heavy service users"
TXT_BASIC = "Basic service users"
TXT_MIXED = "Mixed characteristics"

# marketing action, first matching rule wins
MKT_URGENT = "Urgent retention campaign with personalized offers"  # churn > 0.35
MKT_ONBOARD = "Onboarding program with service education"  # tenure < 15
MKT_PREMIUM = "Premium upselling and loyalty rewards"  # monthly > 80
MKT_CROSS = "Cross-selling campaign for add-on services"  # diversity < 2
MKT_DEFAULT = "Maintain engagement with targeted promotions"

# retention strategy, first matching rule wins
RET_IMMEDIATE = "Immediate intervention: dedicated retention team, contract incentives"  # churn > 0.40
RET_PROACTIVE = "Proactive outreach: satisfaction surveys, service improvements"  # churn > 0.25
RET_CONVERT = "Contract conversion incentives for stability"  # contract mode Month-to-month
RET_LOYALTY = "Loyalty rewards: referral bonuses, exclusive benefits"

# scoring defaults when a cluster has no profile / action row
DEFAULT_NAME_PREFIX = "Cluster "  # name shown as "Cluster <id>"
DEFAULT_MARKETING = "No specific marketing action defined."
DEFAULT_RETENTION = "No specific retention strategy defined."
RISK_WORDS = ("High", "Medium", "Low")

# significance bands
P_STRONG, P_SIG = 0.001, 0.05
V_WEAK, V_MODERATE, V_STRONG = 0.1, 0.3, 0.5
SILHOUETTE_STRONG, SILHOUETTE_REASONABLE = 0.5, 0.25


@dataclass(frozen=True)
class SegmentSpec:
    """Column roles of a customer table."""

    id: str = ID_COL
    target: str = TARGET_COL
    positive_value: str = POSITIVE_VALUE
    numerical: tuple = tuple(NUMERICAL)
    raw_numerical: tuple = tuple(RAW_NUMERICAL)
    binary_yes_no: tuple = tuple(BINARY_YES_NO)
    categorical: tuple = tuple(CATEGORICAL)
    services: tuple = tuple(SERVICES)
    contract: str = "Contract"
    payment: str = "PaymentMethod"
    internet: str = "InternetService"
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    partner: str = "Partner"
    dependents: str = "Dependents"
    senior: str = "SeniorCitizen"
    contract_ordinal: dict = field(default_factory=lambda: dict(CONTRACT_ORDINAL))
    auto_payment_methods: tuple = tuple(AUTO_PAYMENT_METHODS)
    tenure_edges: tuple = tuple(TENURE_GROUP_EDGES)


DEFAULT_SPEC = SegmentSpec()
