"""The whole batch job: from a raw file to stored tables, reports, model and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from holdfast.functions.rules import TENURE_DOMAIN
from holdfast.operators import explore, sampling, segments, significance, survival, training
from holdfast.operators.attribution import Explainer
from holdfast.plans.presets import named_query
from holdfast.schema import CUSTOMER_SCHEMA, Roles
from holdfast.sources import exports, tables

SERVICE_LEVELS = ("No", "No internet service", "Yes")


def exploration(raw: DataFrame, features: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    """The numbers behind each exploratory plot, by plot name."""
    measures = [roles.tenure, roles.charge, roles.total]
    categories = [roles.contract, roles.internet, roles.payment, *roles.extras]
    numeric = [c for c in roles.extras if isinstance(raw.schema[c].dataType, T.NumericType)]
    return {
        "01_churn_distribution": segments.label_distribution(raw, roles),
        "02_churn_rate_categorical": segments.rate_by_category(raw, categories, roles),
        "03_numeric_distributions": explore.density(raw, roles.label, measures),
        "04_corr_numeric": explore.correlation_matrix(raw, [*numeric, *measures, roles.label]),
        "05_tenure_vs_monthly_scatter": segments.scatter_grid(raw, roles.tenure, roles.charge, 1, 1, roles.label),
        "06_churn_by_tenure_bucket": segments.rate_by_domain(features, "tenure_bucket", TENURE_DOMAIN, roles),
        "07_monthly_charges_box": explore.box_stats(raw, roles.label, roles.charge),
        "07_monthly_charges_violin": explore.density(raw, roles.label, [roles.charge], points=100, cut=2.0),
        "08_revenue_at_risk_by_contract": named_query("proxy_by_contract", features, roles),
        "09_support_services_heatmap": segments.rate_matrix(
            features, roles.support, roles.security, SERVICE_LEVELS, roles),
        "10_payment_method_rate_and_size": named_query("payment_rate_size", features, roles),
    }


def findings(raw: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    """Significance tests and retention curves, straight from the cleaned table."""
    tests = significance.chi2_tests(raw, significance.standard_tests(roles), roles.label)
    return {
        "significance": significance.chi2_pvalues(tests),
        "segment_share": named_query("segment_share", raw, roles),
        "retention_curves": survival.km_curve(raw, roles.contract, roles.tenure, roles.label),
        "median_retention": survival.km_median(raw, roles.contract, roles.tenure, roles.label),
    }


def run_all(
    spark: SparkSession, csv_path: str, out_dir: str, roles: Roles = Roles(),
    schema: T.StructType = CUSTOMER_SCHEMA, sample_size: int | None = None, drop: Sequence[str] = (), **params: object,
) -> training.Trained:
    """Ingest, explore, train, explain and export; everything lands under ``out_dir``.

    Rows of the file that do not fit its columns are kept apart, in ``raw_rejects``.  Drivers are ranked over all
    customers, or over a sample of ``sample_size``.
    """
    read = tables.read_customers_csv(spark, csv_path, schema)
    tables.write_table(tables.split_rejects(read)[1], f"{out_dir}/raw_rejects")
    raw = tables.write_table(tables.clean_customers(tables.split_rejects(read)[0], roles), f"{out_dir}/raw_data")
    features = tables.write_table(tables.feature_table(raw, roles), f"{out_dir}/churn_features")

    exports.export_results(exploration(raw, features, roles), f"{out_dir}/exploration")
    exports.export_results(findings(raw, roles), f"{out_dir}/findings")

    trained = training.train(raw, roles, drop, path=f"{out_dir}/model", **params)

    sample = training.model_frame(raw, roles, drop)
    if sample_size is not None:
        sample = sampling.sample_n(sample, roles.id, sample_size)
    explainer = Explainer.of(spark, trained.model)
    drivers = explainer.global_drivers(sample)
    exports.export_drivers(drivers, f"{out_dir}/top5_drivers")

    exports.export_dashboard(features, f"{out_dir}/exports", roles)
    return trained
