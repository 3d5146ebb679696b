"""Named segment queries: each is ``segment_summary`` with keys, metrics and an order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.rules import HIGH_CHARGE, MONTHLY
from holdfast.operators import segments
from holdfast.schema import Roles
from holdfast.sources.storage import ensure_checkpoint_dir


@dataclass(frozen=True)
class Preset:
    keys: tuple[str, ...]  # role names, or derived columns
    metrics: dict[str, str]
    order: tuple[str, ...] = field(default=())
    limit: int | None = None


_RATE = {"churn_rate_pct": "churn_rate_pct"}
_SIZE_RATE = {"customers": "n", **_RATE}
_AVG = {"avg_monthly_charge": "avg_charge"}
_RISK = {"monthly_revenue_at_risk": "rev_at_risk"}
_PROXY = {"monthly_revenue_at_risk": "rev_at_risk_proxy"}
_COUNTS = {"churned": "churned", **_RATE, **_AVG}

PRESETS: dict[str, Preset] = {
    "cohort_contract": Preset(
        ("contract",), {"total_customers": "n", **_COUNTS, **_PROXY}, ("-churn_rate_pct",)),
    "cohort_tenure": Preset(
        ("tenure_bucket",), {**_SIZE_RATE, **_AVG, "avg_total_charges": "avg_total"}, ("-churn_rate_pct",)),
    "cohort_tier_risk": Preset(
        ("charge_tier", "risk_flag"), {**_SIZE_RATE, **_PROXY}, ("-monthly_revenue_at_risk",)),
    "cohort_services": Preset(("support", "security"), _SIZE_RATE, ("-churn_rate_pct",)),
    "seg_contract_tenure": Preset(
        ("contract", "tenure_bucket"), {**_SIZE_RATE, **_AVG}, ("-churn_rate_pct", "-customers")),
    "seg_payment": Preset(("payment",), _SIZE_RATE, ("-churn_rate_pct",)),
    "seg_internet": Preset(("internet",), _SIZE_RATE, ("-churn_rate_pct",)),
    "export_contract": Preset(
        ("contract",), {"total_customers": "n", **_COUNTS, **_RISK}, ("-churn_rate_pct",)),
    "export_tenure": Preset(
        ("tenure_bucket",),
        {**_SIZE_RATE, "avg_spend": "avg_charge", "avg_total_charges": "avg_total"}, ("tenure_bucket",)),
    "export_services": Preset(("support", "security"), {**_SIZE_RATE, **_AVG}, ("-churn_rate_pct",)),
    "export_top_segments": Preset(
        ("contract", "tenure_bucket", "risk_flag"),
        {"customers": "n", **_COUNTS, **_RISK, "annual_revenue_at_risk": "annual_rev_at_risk"},
        ("-monthly_revenue_at_risk",), 20),
    "rate_by_contract": Preset(("contract",), _RATE),
    "rate_by_support": Preset(("support",), _RATE),
    "rate_by_security": Preset(("security",), _RATE),
    "proxy_by_contract": Preset(
        ("contract",),
        {**_SIZE_RATE, "churned": "churned", "avg_monthly": "avg_charge", **_PROXY},
        ("-monthly_revenue_at_risk",)),
    "payment_rate_size": Preset(("payment",), _SIZE_RATE, ("-churn_rate_pct",)),
}

# The five result tables a dashboard reads, by sheet name.
EXPORT_SHEETS: dict[str, str] = {
    "01_kpis": "kpis",
    "02_churn_by_contract": "export_contract",
    "03_churn_by_tenure_bucket": "export_tenure",
    "04_support_services_vs_churn": "export_services",
    "05_action_segments_top20": "export_top_segments",
}


def named_query(name: str, features: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Run a named query on a feature table (see ``functions.rules.with_segments``)."""
    if name == "kpis":
        return segments.kpis(features, roles)
    if name == "early_vs_late":
        tenure = F.col(roles.tenure)
        return segments.conditional_rates(
            features, {"churn_lt_12_pct": tenure < 12, "churn_ge_12_pct": tenure >= 12}, roles)
    if name == "segment_share":
        high = (F.col(roles.contract) == MONTHLY) & (F.col(roles.charge) > HIGH_CHARGE)
        return segments.segment_share(features, high, roles)
    preset = PRESETS[name]
    keys = [getattr(roles, k, k) for k in preset.keys]
    return segments.segment_summary(features, keys, preset.metrics, roles, preset.order, preset.limit)


def export_sheets(features: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    """The dashboard's tables, by sheet, all from one scan of the features (grouping sets).

    Between the scan and the sheets stands one stored table with a row per segment of each sheet.
    """
    presets = {sheet: PRESETS.get(name) for sheet, name in EXPORT_SHEETS.items()}
    keys = [[getattr(roles, k, k) for k in p.keys] if p else [] for p in presets.values()]
    ensure_checkpoint_dir(features.sparkSession)
    found = segments.grouped_sets(features, keys, roles).checkpoint()
    return {
        sheet: segments.kpis_of_set(found, i) if p is None
        else segments.summarised(found.where(F.col("set") == i), keys[i], p.metrics, p.order, p.limit)
        for i, (sheet, p) in enumerate(presets.items())
    }


def query_names() -> list[str]:
    return sorted([*PRESETS, "kpis", "early_vs_late", "segment_share"])
