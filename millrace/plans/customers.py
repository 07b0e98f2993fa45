"""From two raw customer sources to one feature table, and the store's definitions over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.operators.counts import fit_categories
from millrace.operators.derive import customer_features
from millrace.operators.encode import (
    MAX_CATEGORIES,
    apply_onehot,
    apply_zscore,
    fit_onehot,
    fit_zscore,
    zscore_aggregates,
    zscore_model,
)
from millrace.operators.impute import fill, fit_mean_codes, fit_medians, fit_modes, impute_chained, mean_codes_of
from millrace.operators.schema import clean_names, numeric_columns, text_columns
from millrace.operators.union import stack_by_name, standardize_source
from millrace.plans import churn_definitions as churn
from millrace.plans.feature_store import Entity, Feature, FeatureService, FeatureSource, FeatureView
from millrace.session import write_through


def merge_sources(source_a: DataFrame, source_b: DataFrame) -> DataFrame:
    """Standardise both sources and stack them; no shuffle."""
    names = (churn.LABEL, churn.FLAG, churn.AMOUNT)
    return stack_by_name(standardize_source(source_a, *names), standardize_source(source_b, *names))


def _columns(df: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Held-out columns (key, label), numbers and categories of a customer table."""
    held_out = [c for c in (churn.KEY, churn.LABEL) if c in df.columns]
    return held_out, numeric_columns(df, exclude=held_out), text_columns(df, exclude=held_out)


def impute_merged(merged: DataFrame, chained: bool = True, categories: dict | None = None) -> DataFrame:
    """Fill numbers (chained regressions, or medians) and categories (mean code).

    Key and label are left alone: a missing key must not become somebody else's.
    Columns come out as numbers, key, categories, label. ``categories`` are the fitted ones
    of the table, if known; otherwise one job finds them.
    """
    held_out, numbers, texts = _columns(merged)
    filled = impute_chained(merged, numbers) if chained else fill(merged, fit_medians(merged, numbers))
    filled = fill(filled, mean_codes_of(categories) if categories is not None else fit_mean_codes(merged, texts))
    key = [c for c in held_out if c != churn.LABEL]
    return filled.select(*numbers, *key, *texts, *[c for c in held_out if c == churn.LABEL])


def prepare(imputed: DataFrame, categories: dict | None = None) -> DataFrame:
    """Fill what is still missing, z-score the numbers, one-hot the categories, clean names.

    One aggregate finds both the columns with holes and the scaling numbers; only if there
    are holes does more of the table have to be read.
    """
    _, numbers, texts = _columns(imputed)
    row = imputed.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"holes_{c}") for c in [*numbers, *texts]],
        *zscore_aggregates(imputed, numbers),
    ).first()
    holed_numbers = [c for c in numbers if row[f"holes_{c}"]]
    holed_texts = [c for c in texts if row[f"holes_{c}"]]
    filled, scaling = imputed, zscore_model(row, numbers)
    if holed_numbers:
        filled = fill(filled, fit_medians(imputed, holed_numbers))
        scaling = fit_zscore(filled, numbers)
    if holed_texts:
        filled = fill(filled, fit_modes(imputed, holed_texts))
    if categories is None:
        flags = fit_onehot(filled, texts)
    else:
        flags = {c: [value for value, _ in categories[c]] for c in texts}
    return clean_names(apply_onehot(apply_zscore(filled, scaling), flags), churn.COLUMN_RENAMES)


def feature_table(
    source_a: DataFrame, source_b: DataFrame, chained: bool = True, max_categories: int = MAX_CATEGORIES
) -> DataFrame:
    """Both raw sources to the derived feature table.

    The merged table is read by the fits and by the result, so it is written once to the
    shared folder. Each fit reads its own columns of that copy: two passes over the numbers
    for the imputation, one over the categories, one for the scaling; the rest is one
    projection. A column with more than ``max_categories`` values is an error, as each
    becomes a column.
    """
    merged = write_through(merge_sources(source_a, source_b), "merged")
    _, _, texts = _columns(merged)
    categories = fit_categories(merged, texts, max_categories * len(texts))
    if categories is None or any(len(pairs) > max_categories for pairs in categories.values()):
        raise ValueError(f"a column has more than {max_categories} categories; exclude it or encode it by code")
    imputed = impute_merged(merged, chained, categories)
    return customer_features(prepare(imputed, categories))


CUSTOMER = Entity("customer", ("customerid",), T.StringType(), "one subscriber, by account id")


def customer_view(features: DataFrame | None = None, table: str | None = None) -> FeatureView:
    """The customer feature view over a DataFrame or a warehouse table with an audit stamp."""
    fields = [Feature(c, T.IntegerType()) for c in (*churn.FLAG_FEATURES, *churn.COUNT_FEATURES)]
    fields += [Feature(c, T.FloatType()) for c in churn.AMOUNT_FEATURES]
    fields.append(Feature("churn", T.StringType()))
    source = FeatureSource("customer_features_source", "event_timestamp", df=features, table=table)
    return FeatureView("customer_features", CUSTOMER, tuple(fields), source)


def churn_service(view: FeatureView) -> FeatureService:
    return FeatureService("churn_model_svc", (view,), "inputs of the churn classifiers")
