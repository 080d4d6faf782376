"""Feature preparation: fitted once on training rows, then applied to any table."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.schema import numeric_columns, string_columns
from ledgerloom.operators.encode import (
    class_sizes, label_encode_apply, label_encode_fit, standard_scale_apply, standard_scale_fit,
)
from ledgerloom.operators.features import CUSTOMER_FEATURES, customer_features, date_features, split_target
from ledgerloom.operators.impute import apply_impute, drop_critical_nulls, fit_impute
from ledgerloom.operators.moments import customer_moments, merge_moments, stats_of_moments
from ledgerloom.operators.outliers import apply_fences, fit_filled_fences, iqr_filter_sequential
from ledgerloom.operators.split import stratified_split
from ledgerloom.params import FeatureParams
from ledgerloom.session import checkpoint
from ledgerloom.sources.files import load_table


def _spared(params: FeatureParams) -> list[str]:
    """Columns that name a row, and the target: no fill, fence or scale is learned for them."""
    return [*params.key_columns, params.target_column]


def _clean(df: DataFrame, params: FeatureParams) -> tuple[dict, DataFrame]:
    kept = drop_critical_nulls(df, params.critical_columns)
    if params.strict_reference:
        fills = fit_impute(kept)
        return fills, iqr_filter_sequential(apply_impute(kept, fills))
    medians, fences = fit_filled_fences(kept, numeric_columns(kept, _spared(params)))
    fills = {**medians, **fit_impute(kept, [*_spared(params), *medians])}
    return fills, apply_fences(apply_impute(kept, fills), fences)


def clean_data(df: DataFrame, params: FeatureParams) -> DataFrame:
    """Training cleaning: critical rows out, gaps filled, rows outside a fence out.

    By default keys and target are spared, and the fences come from one pass. With ``strict_reference``
    every column is filled and every number filtered, one column after the other.
    """
    return _clean(df, params)[1]


@dataclass(frozen=True)
class FeatureModel:
    """Fitted state: a few numbers per column, and the class lists and the customers' moments as tables."""

    params: FeatureParams
    fills: dict
    scales: dict
    sizes: dict
    classes: DataFrame | None
    customers: DataFrame | None = None

    def transform(self, df: DataFrame, customer_stats: DataFrame | None = None) -> DataFrame:
        """Prepared columns for every row of ``df``; no row is dropped.

        Missing values get the fills of the fit, and rows their customer's aggregates of the fit, so a record is
        prepared the same alone, in a batch and in a stream. ``customer_stats`` takes the place of the latter, and
        aggregates that ``df`` carries already are kept. With ``strict_reference`` the batch is cleaned and aggregated by
        itself, and may lose rows.
        """
        filled = clean_data(df, self.params) if self.params.strict_reference else self.fill(df)
        dated = date_features(filled, self.params.date_columns)
        if set(CUSTOMER_FEATURES) <= set(df.columns):
            featured = dated
        else:
            fitted = None if self.customers is None or self.params.strict_reference else stats_of_moments(self.customers)
            featured = customer_features(dated, customer_stats if customer_stats is not None else fitted)
        if self.classes is not None:
            featured = label_encode_apply(featured, self.classes, self.sizes)
        return standard_scale_apply(featured, self.scales)

    def fill(self, df: DataFrame) -> DataFrame:
        """``df`` with the fills of the fit."""
        return apply_impute(df, {c: v for c, v in self.fills.items() if c in df.columns})

    def with_new_rows(self, df: DataFrame) -> FeatureModel:
        """The same model with the customers' moments moved on by further rows; all else stays as fitted."""
        added = customer_moments(self.fill(df))
        merged = added if self.customers is None else merge_moments(self.customers, added)
        return replace(self, customers=checkpoint(merged))

    def feature_columns(self) -> list[str]:
        """Columns that go into the model: all scaled ones."""
        return list(self.scales)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        state = {
            "params": asdict(self.params), "fills": self.fills, "scales": self.scales, "sizes": self.sizes,
            "customers": self.customers is not None,
        }
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/state"
        )
        if self.classes is not None:
            self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        if self.customers is not None:
            self.customers.write.mode("overwrite").parquet(f"{path}/customers")


def load_feature_model(spark: SparkSession, path: str) -> FeatureModel:
    state = json.loads(spark.read.text(f"{path}/state").first()["value"])
    params = {k: tuple(v) if isinstance(v, list) else v for k, v in state["params"].items()}
    return FeatureModel(
        FeatureParams(**params),
        state["fills"],
        {c: tuple(v) for c, v in state["scales"].items()},
        state["sizes"],
        spark.read.parquet(f"{path}/classes") if state["sizes"] else None,
        spark.read.parquet(f"{path}/customers") if state.get("customers") else None,
    )


def _categorical(df: DataFrame, params: FeatureParams) -> list[str]:
    if params.categorical_columns is None:
        return string_columns(df, _spared(params))
    return [c for c in params.categorical_columns if c in df.columns and c != params.target_column]


def fit_features(df: DataFrame, params: FeatureParams) -> tuple[FeatureModel, DataFrame]:
    """Fit on training rows. Returns the fitted model and the prepared training rows.

    The passes are: one search for medians and fences, modes, classes, and one aggregation for the
    scales. Between them only numbers and class lists are kept; rows come from storage again each time.
    """
    fills, cleaned = _clean(df, params)
    customers = None
    if {"customer_id", "amount"} <= set(cleaned.columns):
        customers = checkpoint(customer_moments(cleaned))
    dated = date_features(cleaned, params.date_columns)
    featured = customer_features(dated, None if customers is None else stats_of_moments(customers))
    categorical = _categorical(featured, params)
    classes, sizes = None, {}
    if categorical:
        classes = checkpoint(label_encode_fit(featured, categorical))
        sizes = class_sizes(classes)
        featured = label_encode_apply(featured, classes, sizes)
    scales = standard_scale_fit(featured, numeric_columns(featured, _spared(params)))
    model = FeatureModel(params, fills, scales, sizes, classes, customers)
    return model, standard_scale_apply(featured, scales)


def prepare_dataframe(
    df: DataFrame, params: FeatureParams, is_training: bool = False, fitted: FeatureModel | None = None
) -> tuple[DataFrame, DataFrame | None, FeatureModel]:
    """Features, target (None when the table has none) and the fitted model.

    Inference is the default and needs a fitted model.
    """
    if is_training:
        fitted, prepared = fit_features(df, params)
    elif fitted is None:
        raise ValueError("inference needs a fitted feature model")
    else:
        prepared = fitted.transform(df)
    features, target = split_target(prepared, params.target_column)
    return features, target, fitted


def prepare_data(
    spark: SparkSession,
    path: str,
    params: FeatureParams,
    is_training: bool = True,
    fitted: FeatureModel | None = None,
    schema=None,
) -> tuple[DataFrame, DataFrame | None, FeatureModel]:
    """The same from a file; training is the default."""
    return prepare_dataframe(load_table(spark, path, schema), params, is_training, fitted)


def split_data(df: DataFrame, key: str | list[str], params: FeatureParams) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, stratified by the target."""
    marked = stratified_split(df, key, params.target_column, params.test_size, params.random_state)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")
