"""Fixed values of the churn tables: columns, expected values, suites, feature fields.

They must equal what existing suites, feature lists and model signatures use, so they are
stated plainly here and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.operators.expectations import Expectation
from millrace.operators.quality import Rules

KEY = "customerID"
LABEL = "Churn"
FLAG = "SeniorCitizen"
AMOUNT = "TotalCharges"

YES_NO = ["Yes", "No"]
NO_YES_SERVICE = ["No", "Yes", "No internet service"]
YES_NO_SERVICE = ["Yes", "No", "No internet service"]


RULES_A = Rules(
    ranges={"tenure": (0, 100), "MonthlyCharges": (0, 500), "TotalCharges": (0, 10000)},
    sets={"gender": ["Male", "Female"], "InternetService": ["DSL", "Fiber optic", "No"]},
    key=KEY,
    ignore=(FLAG,),
)
RULES_B = Rules(
    ranges={"tenure": (0, 100), "Churn": (0, 1)},
    sets={"gender": ["Male", "Female"], "PhoneService": ["Yes", "No"]},
    key=KEY,
    ignore=(FLAG,),
)


def _rows(low, high):
    return Expectation("expect_table_row_count_to_be_between", {"min_value": low, "max_value": high})


def _between(column, low, high):
    return Expectation("expect_column_values_to_be_between", {"column": column, "min_value": low, "max_value": high})


def _not_null(column):
    return Expectation("expect_column_values_to_not_be_null", {"column": column})


def _in_set(column, values):
    return Expectation("expect_column_values_to_be_in_set", {"column": column, "value_set": values})


SUITE_A = [
    _rows(1, 15000),
    _between("SeniorCitizen", 0, 1),
    _between("tenure", 0, 100),
    _between("MonthlyCharges", 0, 500),
    _not_null("SeniorCitizen"),
    _not_null("tenure"),
    _not_null("MonthlyCharges"),
    _not_null("TotalCharges"),
    _in_set("gender", ["Male", "Female"]),
    _in_set("Partner", YES_NO),
    _in_set("Dependents", YES_NO),
    _in_set("PhoneService", YES_NO),
    _in_set("MultipleLines", ["No phone service", "No", "Yes"]),
    _in_set("InternetService", ["DSL", "Fiber optic", "No"]),
    _in_set("OnlineSecurity", NO_YES_SERVICE),
    _in_set("OnlineBackup", NO_YES_SERVICE),
    _in_set("DeviceProtection", NO_YES_SERVICE),
    _in_set("TechSupport", NO_YES_SERVICE),
    _in_set("StreamingTV", NO_YES_SERVICE),
    _in_set("StreamingMovies", NO_YES_SERVICE),
    _in_set("Contract", ["Month-to-month", "One year", "Two year"]),
    _in_set("PaperlessBilling", YES_NO),
    _in_set(
        "PaymentMethod",
        ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"],
    ),
    _in_set("Churn", ["No", "Yes"]),
]

SUITE_B = [
    _rows(1, 15000),
    _between("SeniorCitizen", 0, 1),
    _between("tenure", 0, 100),
    _between("Churn", 0, 1),
    _not_null("SeniorCitizen"),
    _not_null("tenure"),
    _not_null("Churn"),
    _in_set("gender", ["Male", "Female"]),
    _in_set("Partner", YES_NO),
    _in_set("Dependents", YES_NO),
    _in_set("PhoneService", YES_NO),
    _in_set("MultipleLines", ["Yes", "No", "No phone service"]),
    _in_set("InternetService", ["DSL", "Fiber optic", "No"]),
    _in_set("OnlineSecurity", YES_NO_SERVICE),
    _in_set("OnlineBackup", YES_NO_SERVICE),
]

# Renamed before lower-casing, to lose the parentheses.
COLUMN_RENAMES = {"PaymentMethod_Credit_card_(automatic)": "PaymentMethod_Credit_card_automatic"}

FLAG_FEATURES = (
    "paymentmethod_mailed_check",
    "paymentmethod_electronic_check",
    "paymentmethod_credit_card_automatic",
    "paperlessbilling_yes",
    "contract_two_year",
    "contract_one_year",
    "streamingmovies_yes",
    "streamingmovies_no_internet_service",
    "streamingtv_yes",
    "streamingtv_no_internet_service",
    "techsupport_yes",
    "techsupport_no_internet_service",
    "deviceprotection_yes",
    "deviceprotection_no_internet_service",
    "onlinebackup_yes",
    "onlinebackup_no_internet_service",
    "onlinesecurity_yes",
    "onlinesecurity_no_internet_service",
    "internetservice_no",
    "internetservice_fiber_optic",
    "multiplelines_yes",
    "multiplelines_no_phone_service",
    "phoneservice_yes",
    "dependents_yes",
    "partner_yes",
    "seniorcitizen_yes",
    "gender_male",
)
COUNT_FEATURES = ("family_label", "partner_label", "dependents_label", "total_services")
AMOUNT_FEATURES = ("tenure", "monthly_total_ratio", "totalcharges", "monthlycharges")
MODEL_FEATURES = (*FLAG_FEATURES, *COUNT_FEATURES, *AMOUNT_FEATURES)

MODEL_SIGNATURE = T.StructType(
    [T.StructField(c, T.BooleanType()) for c in FLAG_FEATURES]
    + [T.StructField(c, T.DoubleType()) for c in (*COUNT_FEATURES, *AMOUNT_FEATURES)]
)
