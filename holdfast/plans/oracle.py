"""The registered queries once more, in plain SQL for a second engine to check.

Each text stands alone: it derives the account table from the base tables itself.
"""

from __future__ import annotations

_LINES = """
    SELECT l_orderkey, COUNT(*) AS cnt,
      SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r_cnt,
      SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f_cnt
    FROM lineitem GROUP BY l_orderkey"""

ACCOUNTS = f"""a0 AS (
  SELECT o.o_orderkey AS account_key,
    CAST(o.o_orderkey AS VARCHAR) AS account_id,
    CAST(LEAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '2001-08-01') // 30, 72) AS INT) AS tenure,
    CAST((CAST(ROUND(o.o_totalprice * 100) AS BIGINT) // 4000 + 1800) / CAST(100 AS DOUBLE) AS DECIMAL(18,2))
      AS monthly_charges,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Month-to-month'
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'One year' ELSE 'Two year' END AS contract,
    c.c_mktsegment AS payment_method,
    r.r_name AS internet_service,
    CASE WHEN COALESCE(l.r_cnt, 0) = 0 THEN 'Yes' WHEN l.r_cnt = 1 THEN 'No internet service' ELSE 'No' END
      AS tech_support,
    CASE WHEN COALESCE(l.f_cnt, 0) = 0 THEN 'Yes' WHEN l.f_cnt = 1 THEN 'No internet service' ELSE 'No' END
      AS online_security,
    CASE WHEN o.o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS senior,
    CASE WHEN n.n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
    CASE WHEN COALESCE(l.cnt, 0) > 4 THEN 'Yes' ELSE 'No' END AS dependents,
    CAST(('0x' || substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN ({_LINES}) l ON l.l_orderkey = o.o_orderkey
), a1 AS (
  SELECT *,
    0.05::DOUBLE
      + CASE WHEN contract = 'Month-to-month' THEN 0.35::DOUBLE WHEN contract = 'One year' THEN 0.08::DOUBLE
             ELSE 0.0::DOUBLE END
      + CASE WHEN tenure < 12 THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN monthly_charges > 65 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END
      + CASE WHEN tech_support = 'No' THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END AS p
  FROM a0
), accounts AS (
  SELECT *,
    CASE WHEN u < p THEN 1 ELSE 0 END AS churned,
    CASE WHEN u < p THEN 'Yes' ELSE 'No' END AS churn_text,
    CASE WHEN tenure = 0 THEN ' ' ELSE CAST(CAST(monthly_charges * tenure AS DECIMAL(18,2)) AS VARCHAR) END
      AS total_charges_text,
    CASE WHEN tenure = 0 THEN 0 ELSE CAST(monthly_charges * tenure AS DECIMAL(18,2)) END AS total_charges,
    p + ((account_key * 7919) % 997) / 9970.0::DOUBLE AS score
  FROM a1
), features AS (
  SELECT *,
    CASE WHEN tenure < 12 THEN '0-1yr' WHEN tenure < 24 THEN '1-2yr' WHEN tenure < 48 THEN '2-4yr'
         ELSE '4+yr' END AS tenure_bucket,
    CASE WHEN monthly_charges < 35 THEN 'Low' WHEN monthly_charges < 65 THEN 'Medium' ELSE 'High' END
      AS charge_tier,
    CASE WHEN contract = 'Month-to-month' AND monthly_charges > 65 THEN 'High Risk'
         WHEN contract = 'Month-to-month' THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_flag,
    CAST(monthly_charges * 100 AS BIGINT) AS cents,
    CAST(total_charges * 100 AS BIGINT) AS total_cents
  FROM accounts
)"""

_LABELLED = "docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic " \
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def _on(query: str, *ctes: str) -> str:
    return "WITH " + ", ".join([ACCOUNTS, *ctes]) + "\n" + query.strip()


def _half_up(num: str, den: str) -> str:
    """Non-negative quotient in whole hundredths, as a double."""
    return (f"CAST((2 * CAST({num} AS HUGEINT) + {den}) // (2 * NULLIF({den}, 0)) AS BIGINT)"
            " / CAST(100 AS DOUBLE)")


def _rate(hits: str, n: str) -> str:
    return _half_up(f"({hits}) * 10000", f"({n})")


_CHURN_RATE = f"{_rate('SUM(churned)', 'COUNT(churned)')} AS churn_rate_pct"
_N = "COUNT(*) AS {}"
_CHURNED = "CAST(SUM(churned) AS BIGINT) AS churned"
_RISK_CENTS = "CAST(SUM(CASE WHEN churned = 1 THEN cents ELSE 0 END) AS BIGINT)"
_RISK = f"{_RISK_CENTS} / CAST(100 AS DOUBLE) AS monthly_revenue_at_risk"
_YEAR = f"{_RISK_CENTS} * 12 / CAST(100 AS DOUBLE) AS annual_revenue_at_risk"
_PROXY = f"{_half_up('SUM(churned) * SUM(cents)', 'COUNT(*)')} AS monthly_revenue_at_risk"


def _avg(column: str, name: str) -> str:
    return f"{_half_up(f'SUM({column})', f'COUNT({column})')} AS {name}"


def _groups(keys: str, *metrics: str, tail: str = "") -> str:
    return _on(f"SELECT {keys}, {', '.join(metrics)} FROM features GROUP BY {keys} {tail}")


_SHEET = _avg("cents", "avg_monthly_charge")


def _segments() -> dict[str, str]:
    top = f"""SELECT contract, tenure_bucket, risk_flag, COUNT(*) AS customers, {_CHURNED}, {_CHURN_RATE},
      {_SHEET}, {_RISK}, {_YEAR}
    FROM features GROUP BY contract, tenure_bucket, risk_flag
    ORDER BY monthly_revenue_at_risk DESC, contract, tenure_bucket, risk_flag LIMIT 20"""
    kpis = f"""SELECT {_rate('SUM(churned)', 'COUNT(churned)')} AS overall_churn_rate_pct, {_RISK},
      CAST(COUNT(CASE WHEN risk_flag = 'High Risk' THEN 1 END) AS BIGINT) AS high_risk_customers_count,
      {_rate("SUM(CASE WHEN risk_flag = 'High Risk' THEN churned END)",
             "COUNT(CASE WHEN risk_flag = 'High Risk' THEN churned END)")} AS high_risk_churn_rate_pct,
      {_half_up("SUM(CASE WHEN churned = 1 THEN cents END)", "COUNT(CASE WHEN churned = 1 THEN cents END)")}
        AS avg_monthly_charges_of_churners
    FROM features"""
    high = "contract = 'Month-to-month' AND monthly_charges > 65"
    categories = ("contract", "internet_service", "payment_method", "gender", "senior", "partner", "dependents")
    rates = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n, {_CHURN_RATE} "
        f"FROM features GROUP BY {c}" for c in categories)
    heat = ", ".join(
        _rate(f"SUM(CASE WHEN online_security = '{v}' THEN churned END)",
              f"COUNT(CASE WHEN online_security = '{v}' THEN churned END)") + f' AS "{v}"'
        for v in ("No", "No internet service", "Yes"))
    other = lambda listed: _rate(
        f"COALESCE(SUM(CASE WHEN online_security NOT IN ({listed}) THEN churned END), 0)",
        f"COUNT(CASE WHEN online_security NOT IN ({listed}) THEN churned END)") + " AS other"
    only = _rate("SUM(CASE WHEN online_security = 'No' THEN churned END)",
                 "COUNT(CASE WHEN online_security = 'No' THEN churned END)") + ' AS "No"'
    n, size = _N.format("total_customers"), _N.format("customers")
    return {
        "cohort_contract": _groups("contract", n, _CHURNED, _CHURN_RATE, _SHEET, _PROXY),
        "cohort_tenure": _groups("tenure_bucket", size, _CHURN_RATE, _SHEET, _avg("total_cents", "avg_total_charges")),
        "cohort_tier_risk": _groups("charge_tier, risk_flag", size, _CHURN_RATE, _PROXY),
        "cohort_services": _groups("tech_support, online_security", size, _CHURN_RATE),
        "seg_contract_tenure": _groups("contract, tenure_bucket", size, _CHURN_RATE, _SHEET),
        "seg_payment": _groups("payment_method", size, _CHURN_RATE),
        "seg_internet": _groups("internet_service", size, _CHURN_RATE),
        "kpis": _on(kpis),
        "export_contract": _groups("contract", n, _CHURNED, _CHURN_RATE, _SHEET, _RISK),
        "export_tenure": _groups("tenure_bucket", size, _CHURN_RATE, _avg("cents", "avg_spend"),
                                 _avg("total_cents", "avg_total_charges")),
        "export_services": _groups("tech_support, online_security", size, _CHURN_RATE, _SHEET),
        "export_top_segments": _on(top),
        "early_vs_late": _on(f"""SELECT
            {_rate('SUM(CASE WHEN tenure < 12 THEN churned END)', 'COUNT(CASE WHEN tenure < 12 THEN churned END)')}
              AS churn_lt_12_pct,
            {_rate('SUM(CASE WHEN tenure >= 12 THEN churned END)', 'COUNT(CASE WHEN tenure >= 12 THEN churned END)')}
              AS churn_ge_12_pct FROM features"""),
        "rate_by_contract": _groups("contract", _CHURN_RATE),
        "rate_by_support": _groups("tech_support", _CHURN_RATE),
        "rate_by_security": _groups("online_security", _CHURN_RATE),
        "segment_share": _on(f"""SELECT
            {_rate(f'SUM(CASE WHEN {high} THEN churned END)', f'COUNT(CASE WHEN {high} THEN churned END)')}
              AS segment_churn_rate_pct,
            {_rate(f'SUM(CASE WHEN {high} AND churned = 1 THEN 1 ELSE 0 END)', 'SUM(churned)')}
              AS share_of_all_churners_pct FROM features"""),
        "churn_distribution": _on(f"""SELECT churned, COUNT(*) AS n,
            {_rate('COUNT(*)', '(SELECT COUNT(*) FROM features)')} AS pct FROM features GROUP BY churned"""),
        "rate_by_category": _on(rates),
        "rate_by_bucket_ordered": _on(f"""SELECT CAST(d.position AS INT) AS position, d.tenure_bucket,
            COUNT(f.churned) AS n, {_rate('COALESCE(SUM(f.churned), 0)', 'COUNT(f.churned)')} AS churn_rate_pct
            FROM (VALUES (1, '0-1yr'), (2, '1-2yr'), (3, '2-4yr'), (4, '4+yr')) d(position, tenure_bucket)
            LEFT JOIN features f ON f.tenure_bucket = d.tenure_bucket GROUP BY d.position, d.tenure_bucket"""),
        "proxy_by_contract": _groups("contract", size, _CHURN_RATE, _CHURNED, _avg("cents", "avg_monthly"), _PROXY),
        "service_heatmap": _on(f"""SELECT tech_support, {heat}, {other("'No', 'No internet service', 'Yes'")}
            FROM features GROUP BY tech_support"""),
        "service_heatmap_unlisted": _on(
            f"""SELECT tech_support, {only}, {other("'No'")} FROM features GROUP BY tech_support"""),
        "rate_by_bucket_unlisted": _on(f"""SELECT CASE tenure_bucket WHEN '1-2yr' THEN 1 WHEN '2-4yr' THEN 2 ELSE 3 END
            AS position, tenure_bucket, COUNT(*) AS n, {_rate('SUM(churned)', 'COUNT(churned)')} AS churn_rate_pct
            FROM features GROUP BY tenure_bucket"""),
        "payment_rate_size": _groups("payment_method", size, _CHURN_RATE),
        "class_weight": _on("""SELECT COUNT(*) FILTER (churned = 0) AS neg, COUNT(*) FILTER (churned = 1) AS pos,
            CASE WHEN COUNT(*) FILTER (churned = 1) = 0 THEN 1.0::DOUBLE ELSE
            CAST(COUNT(*) FILTER (churned = 0) AS DOUBLE) / COUNT(*) FILTER (churned = 1) END AS weight
            FROM features"""),
        "dashboard_segments": _on(f"""SELECT risk_flag, tenure_bucket, CAST(SUM(customers) AS BIGINT) AS customers,
            CAST(SUM(churned) AS BIGINT) AS churned, {_rate('SUM(churned)', 'SUM(customers)')} AS churn_rate_pct,
            CAST(SUM(risk) AS BIGINT) / CAST(100 AS DOUBLE) AS monthly_revenue_at_risk,
            CAST(SUM(risk) * 12 AS BIGINT) / CAST(100 AS DOUBLE) AS annual_revenue_at_risk
            FROM top GROUP BY risk_flag, tenure_bucket""",
            f"""top AS (SELECT contract, tenure_bucket, risk_flag, COUNT(*) AS customers, {_CHURNED},
            {_RISK_CENTS} AS risk FROM features GROUP BY contract, tenure_bucket, risk_flag
            ORDER BY risk DESC, contract, tenure_bucket, risk_flag LIMIT 20)"""),
        "scatter_grid": _on("""SELECT CAST(FLOOR(CAST(tenure AS DOUBLE) / 1.0) AS BIGINT) AS x_cell,
            CAST(FLOOR(CAST(monthly_charges AS DOUBLE) / 5.0) AS BIGINT) AS y_cell, churned, COUNT(*) AS n
            FROM features GROUP BY ALL"""),
    }


def _columns() -> dict[str, str]:
    def each(expr: str, name: str) -> str:
        return _on(f"SELECT account_id, {expr} AS {name} FROM features")

    messy = """CASE account_key % 5 WHEN 0 THEN ' ' || upper(churn_text) || ' ' WHEN 1 THEN
      CASE WHEN churn_text = 'Yes' THEN '1' ELSE '0' END WHEN 2 THEN
      CASE WHEN churn_text = 'Yes' THEN 'True' ELSE 'False' END WHEN 3 THEN NULL ELSE churn_text END"""
    raw = """account_id, gender, senior, partner, dependents, tenure, internet_service, online_security,
      tech_support, contract, payment_method, CAST(monthly_charges AS DOUBLE) AS monthly_charges"""
    stored = """account_id, tenure, CAST(monthly_charges AS DOUBLE) AS monthly_charges,
      CAST(total_charges AS DOUBLE) AS total_charges, contract, payment_method, internet_service,
      tech_support, online_security, churned"""
    segments = "tenure_bucket, charge_tier, risk_flag"
    level = """CASE WHEN score < 0 THEN NULL WHEN score <= 0.3 THEN 'Low' WHEN score <= 0.6 THEN 'Medium'
      WHEN score <= 1.0 THEN 'High' END"""
    flag = 'CASE WHEN score >= 0.35 THEN 1 ELSE 0 END AS "Predicted_Churn"'
    training = f"""SELECT {raw}, CAST(total_charges AS DOUBLE) AS total_charges, churned, {segments} FROM features"""
    return {
        **dict.fromkeys(("ingest_csv", "ingest_csv_shuffled", "ingest_csv_more"), _on(
            f"""SELECT {raw}, CAST(total_charges AS DOUBLE) AS total_charges, churned FROM features""")),
        "persist_raw": _on(f"SELECT {stored} FROM features"),
        "features": _on(f"SELECT {stored}, {segments} FROM features"),
        "named_query": _on(f"SELECT payment_method, COUNT(*) AS customers, {_CHURN_RATE} "
                           "FROM features GROUP BY payment_method"),
        "export_bundle": _on(" UNION ALL ".join([
            "SELECT '01_kpis' AS sheet, 'all' AS segment, COUNT(CASE WHEN risk_flag = 'High Risk' THEN 1 END) AS n, "
            f"{_CHURN_RATE} FROM features",
            "SELECT '02_churn_by_contract', contract, COUNT(*), "
            f"{_CHURN_RATE} FROM features GROUP BY contract",
            "SELECT '04_support_services_vs_churn', tech_support || '/' || online_security, COUNT(*), "
            f"{_CHURN_RATE} FROM features GROUP BY tech_support, online_security",
            "SELECT '05_action_segments_top20', contract || '/' || tenure_bucket || '/' || risk_flag, COUNT(*), "
            f"{_CHURN_RATE} FROM features GROUP BY contract, tenure_bucket, risk_flag",
            "SELECT '03_churn_by_tenure_bucket', tenure_bucket, COUNT(*), "
            f"{_CHURN_RATE} FROM features GROUP BY tenure_bucket"])),
        "high_risk_export": _on(f"SELECT {stored}, score, {flag}, {level} AS \"Risk_Level\" "
                                "FROM features WHERE score > 0.6 AND score <= 1.0"),
        "clean_numeric": each("COALESCE(TRY_CAST(total_charges_text AS DOUBLE), 0)", "total"),
        "clean_numeric_keep_null": each("TRY_CAST(total_charges_text AS DOUBLE)", "total"),
        "label_strict": each("CASE WHEN churn_text = 'Yes' THEN 1 ELSE 0 END", "label"),
        "label_lenient": each(
            f"CASE WHEN lower(trim({messy})) IN ('yes', '1', 'true') THEN 1 ELSE 0 END", "label"),
        "tenure_bucket": each("tenure_bucket", "tenure_bucket"),
        "charge_tier": each("charge_tier", "charge_tier"),
        "risk_flag": each("risk_flag", "risk_flag"),
        "risk_level": each(level, "risk_level"),
        "decision_flag": each("CASE WHEN score >= 0.35 THEN 1 ELSE 0 END", "flag"),
        "member_filter": _on("SELECT contract, COUNT(*) AS n FROM features "
                             "WHERE contract IN ('Month-to-month', 'Two year') GROUP BY contract"),
        "ingest_csv_typed": _on("""SELECT 'bigint' AS visits_type, 'double' AS spend_type, 'string' AS note_type,
            COUNT(*) FILTER (tenure % 5 <> 0) AS visited,
            CAST(SUM(tenure * 3) FILTER (tenure % 5 <> 0) AS BIGINT) AS visits,
            CAST(SUM(CAST(ROUND(monthly_charges * 100) AS BIGINT)) AS BIGINT) AS spent, COUNT(*) AS noted FROM features"""),
        "training_frame_nulls": _on("""SELECT CASE WHEN tenure > 1 THEN tenure_bucket ELSE 'unnamed' END AS tenure_bucket,
            CASE WHEN tenure > 1 THEN risk_flag ELSE 'unnamed' END AS risk_flag, COUNT(*) AS n
            FROM features GROUP BY ALL"""),
        "training_frame": _on(training),
        "training_frame_join": _on(training),
        "sample_n": _on("SELECT account_id, tenure, contract FROM features "
                        "ORDER BY md5(account_id || ':42'), account_id LIMIT 1000"),
        "scatter_points": _on("SELECT tenure, CAST(monthly_charges AS DOUBLE) AS monthly_charges, churned, "
                              "COUNT(*) AS n FROM features GROUP BY ALL"),
        "top_risk": _on("SELECT account_id, contract, CAST(monthly_charges AS DOUBLE) AS monthly_charges, tenure, "
                        f"{flag}, {level} AS \"Risk_Level\", score FROM features ORDER BY score DESC, account_id LIMIT 20"),
        "customer_at_rank": _on("SELECT account_id, score FROM features ORDER BY score DESC, account_id "
                                "LIMIT 1 OFFSET 7"),
    }


def _statistics() -> dict[str, str]:
    tests = {
        "contract_monthly_vs_two_year": ("contract = 'Month-to-month'", "contract = 'Two year'"),
        "tenure_under_12_vs_rest": ("tenure < 12", "tenure >= 12"),
        "support_no_vs_yes": ("tech_support = 'No'", "tech_support = 'Yes'"),
        "security_no_vs_yes": ("online_security = 'No'", "online_security = 'Yes'"),
        "high_charge_monthly_vs_rest": ("contract = 'Month-to-month' AND monthly_charges > 65",
                                        "NOT (contract = 'Month-to-month' AND monthly_charges > 65)"),
    }
    def counts(table: str, label: str, named: dict[str, tuple[str, str]]) -> str:
        return "t AS (" + " UNION ALL ".join(
            f"SELECT '{name}' AS test, COUNT(*) FILTER ({a}) AS a_n, COUNT(*) FILTER (({a}) AND {label} = 1) AS a_churned, "
            f"COUNT(*) FILTER ({b}) AS b_n, COUNT(*) FILTER (({b}) AND {label} = 1) AS b_churned FROM {table}"
            for name, (a, b) in named.items()) + ")"

    chi2 = f"""SELECT test, a_n, a_churned, b_n, b_churned,
        {_rate('a_churned', 'a_n')} AS a_rate_pct, {_rate('b_churned', 'b_n')} AS b_rate_pct,
        ROUND((a_n + b_n) * pow(GREATEST(abs(CAST(a_churned AS DOUBLE) * (b_n - b_churned)
            - CAST(b_churned AS DOUBLE) * (a_n - a_churned)) - (a_n + b_n) / 2.0::DOUBLE, 0), 2)
          / NULLIF(CAST(a_n AS DOUBLE) * b_n * (a_churned + b_churned)
            * (a_n + b_n - a_churned - b_churned), 0), 6) AS chi2 FROM t"""
    km = """times AS (SELECT contract AS stratum, CASE WHEN tenure = 0 THEN 0.5::DOUBLE ELSE CAST(tenure AS DOUBLE) END AS t,
          COUNT(*) AS n, SUM(churned) AS d FROM features GROUP BY ALL),
        risk AS (SELECT *, SUM(n) OVER (PARTITION BY stratum ORDER BY t
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM times),
        curve AS (SELECT stratum, t, CAST(at_risk AS BIGINT) AS n_at_risk, CAST(d AS BIGINT) AS d,
          PRODUCT(1 - d / CAST(at_risk AS DOUBLE)) OVER (PARTITION BY stratum ORDER BY t
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS survival FROM risk WHERE d > 0)"""
    def kde(measures: tuple[str, ...], points: int, cut: int) -> tuple[str, str]:
        stack = " UNION ALL ".join(
            f"SELECT churned AS label, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM features" for m in measures)
        cte = f"""v AS (SELECT label, measure, value, COUNT(*) AS w FROM ({stack}) GROUP BY ALL),
          m AS (SELECT label, measure, SUM(w) AS n, SUM(value * w) / SUM(w) AS mean, MIN(value) AS lo,
            MAX(value) AS hi FROM v GROUP BY ALL),
          s AS (SELECT label, measure, n, lo, hi, sqrt(SUM(w * pow(value - mean, 2)) / (n - 1))
            * pow(n, -0.2) AS h FROM v JOIN m USING (label, measure) GROUP BY label, measure, n, lo, hi),
          g AS (SELECT *, lo - {cut} * h AS start, (hi - lo + {2 * cut} * h) / {points - 1} AS step FROM s),
          p AS (SELECT g.*, i, start + i * step AS x FROM g, (SELECT unnest(range({points})) AS i))"""
        return f"""SELECT label, measure, CAST(i AS INT) AS i, ROUND(ANY_VALUE(x), 6) AS x,
          ROUND(SUM(w * exp(-0.5 * pow((x - value) / h, 2))) / (ANY_VALUE(n) * ANY_VALUE(h) * sqrt(2 * pi())), 8)
          AS density FROM p JOIN v USING (label, measure) GROUP BY label, measure, i""", cte

    columns = ("senior", "tenure", "monthly_charges", "total_charges", "churned")
    corr = " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, ROUND(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6) AS r FROM features"
        for x in columns for y in columns)
    box = """q AS (SELECT churned AS label, COUNT(*) AS n,
          quantile_cont(CAST(monthly_charges AS DOUBLE), 0.25) AS q1,
          quantile_cont(CAST(monthly_charges AS DOUBLE), 0.5) AS median,
          quantile_cont(CAST(monthly_charges AS DOUBLE), 0.75) AS q3 FROM features GROUP BY churned),
        f AS (SELECT q.*, CAST(monthly_charges AS DOUBLE) AS value,
          value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside
          FROM features JOIN q ON label = churned)"""
    doc_tests = {"english_vs_german": ("lang = 'en'", "lang = 'de'"), "short_vs_long": ("n_chars < 500", "n_chars >= 500")}
    kde3 = kde(("tenure", "monthly_charges", "total_charges"), 200, 3)
    violin = kde(("monthly_charges",), 100, 2)
    return {
        "chi2_tests": _on(chi2, counts("features", "churned", tests)),
        "km_curve": _on("""SELECT stratum, t, n_at_risk, d, ROUND(survival, 6) AS survival FROM curve
          UNION ALL SELECT stratum, 0.0::DOUBLE, CAST(SUM(n) AS BIGINT), 0, 1.0::DOUBLE FROM times GROUP BY stratum""", km),
        "km_median": _on("""SELECT s.stratum, CAST(s.n AS BIGINT) AS n,
          MIN(CASE WHEN survival <= 0.5 + 1e-12 THEN t END) AS median
          FROM (SELECT stratum, SUM(n) AS n FROM times GROUP BY stratum) s
          LEFT JOIN curve c ON c.stratum = s.stratum GROUP BY s.stratum, s.n""", km),
        "kde_binned_check": _on("""SELECT CAST(600 * COUNT(DISTINCT churned) AS BIGINT) AS n, CAST(0 AS BIGINT) AS mismatches
            FROM features"""),
        "box_sketch_check": _on("""SELECT COUNT(monthly_charges) AS n, CAST(0 AS BIGINT) AS mismatches
            FROM features WHERE churned IN (0, 1)"""),
        "kde_by_label": _on(kde3[0], kde3[1]),
        "violin_density": _on(violin[0], violin[1]),
        "corr_matrix": _on(corr),
        "box_stats": _on("""SELECT label, n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
          ROUND(MIN(value) FILTER (inside), 6) AS whisker_lo, ROUND(MAX(value) FILTER (inside), 6) AS whisker_hi,
          COUNT(*) FILTER (NOT inside) AS outliers FROM f GROUP BY label, n, q1, median, q3""", box),
        "documents_by_language": f"""WITH {_LABELLED}
          SELECT lang, COUNT(*) AS documents, CAST(SUM(quality) AS BIGINT) AS good,
          {_rate('SUM(quality)', 'COUNT(quality)')} AS good_pct FROM docs GROUP BY lang""",
        "documents_chi2": f"WITH {_LABELLED}, {counts('docs', 'toxic', doc_tests)} {chi2}",
        "documents_class_weight": f"""WITH {_LABELLED} SELECT COUNT(*) FILTER (toxic = 0) AS neg,
          COUNT(*) FILTER (toxic = 1) AS pos, CASE WHEN COUNT(*) FILTER (toxic = 1) = 0 THEN 1.0::DOUBLE ELSE
          CAST(COUNT(*) FILTER (toxic = 0) AS DOUBLE) / COUNT(*) FILTER (toxic = 1) END AS weight FROM docs""",
    }


def _metrics() -> dict[str, str]:
    ranked = """g AS (SELECT score AS s, CAST(SUM(churned) AS BIGINT) AS pos, CAST(SUM(1 - churned) AS BIGINT) AS neg
          FROM features GROUP BY score),
        c AS (SELECT *, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn, SUM(pos) OVER () AS ap, SUM(neg) OVER () AS an
          FROM g WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))"""
    curve = """SELECT s AS threshold, ROUND(CAST(cp AS DOUBLE) / (cp + cn), 8) AS precision,
      ROUND(CAST(cp AS DOUBLE) / ap, 8) AS recall FROM c"""
    matrix = """m AS (SELECT COUNT(*) FILTER (score < 0.35 AND churned = 0) AS tn,
        COUNT(*) FILTER (score >= 0.35 AND churned = 0) AS fp, COUNT(*) FILTER (score < 0.35 AND churned = 1) AS fn,
        COUNT(*) FILTER (score >= 0.35 AND churned = 1) AS tp FROM features)"""
    digest = "md5(account_id || ':42')"
    rank = f"ROW_NUMBER() OVER (PARTITION BY churned ORDER BY {digest}, account_id)"
    quota = "CAST(FLOOR(COUNT(*) OVER (PARTITION BY churned) * 0.2 + 0.5) AS BIGINT)"
    split = f"sp AS (SELECT *, CASE WHEN {rank} <= {quota} THEN 'test' ELSE 'train' END AS split FROM features)"
    classes = """r AS (SELECT '0' AS class, CAST(tn AS DOUBLE) / (tn + fn) AS p, CAST(tn AS DOUBLE) / (tn + fp) AS r,
          2.0::DOUBLE * tn / (2 * tn + fp + fn) AS f, tn + fp AS support FROM m
        UNION ALL SELECT '1', CAST(tp AS DOUBLE) / (tp + fp), CAST(tp AS DOUBLE) / (tp + fn),
          2.0::DOUBLE * tp / (2 * tp + fp + fn), tp + fn FROM m),
        rows_ AS (SELECT * FROM r
        UNION ALL SELECT 'accuracy', NULL, NULL, CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp), tn + fp + fn + tp FROM m
        UNION ALL SELECT 'macro avg', AVG(p), AVG(r), AVG(f), CAST(SUM(support) AS BIGINT) FROM r
        UNION ALL SELECT 'weighted avg', SUM(p * support) / SUM(support), SUM(r * support) / SUM(support),
          SUM(f * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM r)"""
    money = """ROUND(flagged * 65.0::DOUBLE, 2) AS revenue_at_risk, ROUND(flagged * 10.0::DOUBLE, 2) AS campaign_cost,
      ROUND(flagged * 55.0::DOUBLE, 2) AS net_saving"""
    campaign = """ranked AS (SELECT score, ROW_NUMBER() OVER (ORDER BY score DESC, account_id) AS rk FROM features),
        e AS (SELECT n.top_n, COUNT(*) AS targeted, SUM(score) AS expected FROM sizes n JOIN ranked ON rk <= n.top_n
          GROUP BY n.top_n)"""
    what_if = """SELECT e.top_n, a.acceptance, targeted, ROUND(expected, 6) AS expected_churners,
        ROUND(expected * a.acceptance, 6) AS expected_saved, ROUND(expected * a.acceptance * 780, 2) AS saved_revenue,
        ROUND(targeted * 10.0::DOUBLE, 2) AS campaign_cost,
        ROUND(expected * a.acceptance * 780 - targeted * 10.0::DOUBLE, 2) AS net_benefit,
        ROUND((expected * a.acceptance * 780 - targeted * 10.0::DOUBLE) / (targeted * 10.0::DOUBLE) * 100, 4) AS roi_pct
        FROM e, rates a"""
    one = "sizes AS (SELECT CAST(500 AS BIGINT) AS top_n), rates AS (SELECT 0.3::DOUBLE AS acceptance)"
    grid = """sizes AS (SELECT unnest(range(50, 2001, 50)) AS top_n),
        rates AS (SELECT unnest(range(5, 81, 5)) / 100.0::DOUBLE AS acceptance)"""
    return {
        "roc_auc": _on("SELECT ROUND(SUM(pos * (an - cn + neg / 2.0::DOUBLE)) / (MAX(ap) * CAST(MAX(an) AS DOUBLE)), 8) "
                       "AS roc_auc FROM c", ranked),
        "avg_precision": _on("SELECT ROUND(SUM(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / MAX(ap), 8) AS avg_precision "
                             "FROM c", ranked),
        "pr_curve": _on(f"{curve} UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE", ranked),
        "pr_at_threshold": _on(f"SELECT * FROM ({curve}) ORDER BY abs(threshold - 0.35::DOUBLE), threshold LIMIT 1", ranked),
        "confusion": _on("SELECT * FROM m", matrix),
        "class_report": _on("""SELECT class, ROUND(p, 8) AS precision, ROUND(r, 8) AS recall, ROUND(f, 8) AS f1, support
          FROM rows_""", matrix, classes),
        "recall_at": _on("SELECT ROUND(CAST(tp AS DOUBLE) / (tp + fn), 8) AS recall FROM m", matrix),
        "cost_framing": _on(f"""SELECT fn AS missed_churners,
            {_half_up('fn * 12 * c', 'n')} AS annual_revenue_lost, {_half_up('12 * c', 'n')} AS false_negative_cost,
            10.0::DOUBLE AS false_positive_cost, {_half_up('12 * c * 100', '(n * 1000)')} AS cost_ratio
          FROM (SELECT COUNT(*) FILTER (split = 'test' AND churned = 1 AND score < 0.35) AS fn,
            CAST(SUM(cents) AS HUGEINT) AS c, COUNT(*) AS n FROM sp)""", split),
        "stratified_split": _on("SELECT account_id, churned, split FROM sp", split),
        "class_weight_train": _on("""SELECT COUNT(*) FILTER (churned = 0) AS neg, COUNT(*) FILTER (churned = 1) AS pos,
            CAST(COUNT(*) FILTER (churned = 0) AS DOUBLE) / COUNT(*) FILTER (churned = 1) AS weight
            FROM sp WHERE split = 'train'""", split),
        "stratified_folds": _on(f"SELECT account_id, churned, CAST(({rank} - 1) % 5 AS INT) AS fold FROM features"),
        "retention_kpis": _on(f"SELECT flagged, {money} FROM (SELECT COUNT(*) FILTER (score >= 0.35) AS flagged "
                              "FROM features)"),
        "threshold_sweep": _on(f"""SELECT threshold, ROUND(COALESCE(CAST(caught AS DOUBLE) / NULLIF(flagged, 0), 0), 8)
            AS precision, ROUND(COALESCE(CAST(caught AS DOUBLE) / NULLIF(churned, 0), 0), 8) AS recall, flagged, {money}
          FROM (SELECT t.threshold, COUNT(*) FILTER (score >= t.threshold) AS flagged,
            COUNT(*) FILTER (score >= t.threshold AND churned = 1) AS caught, COUNT(*) FILTER (churned = 1) AS churned
            FROM features, (SELECT ROUND(unnest(range(1, 20)) * 0.05, 2)::DOUBLE AS threshold) t GROUP BY t.threshold)"""),
        "campaign_roi": _on(what_if, one, campaign),
        "campaign_grid": _on(what_if, grid, campaign),
    }


def _model() -> dict[str, str]:
    text = ("contract", "payment_method", "internet_service", "tech_support", "online_security", "gender",
            "partner", "dependents", "tenure_bucket", "charge_tier", "risk_flag")
    numeric = ("tenure", "monthly_charges", "senior", "total_charges")
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT {i} AS place, '{c}' AS source, {c} AS level FROM features" for i, c in enumerate(text))
    numbers = " UNION ALL ".join(
        f"SELECT {i}, '{c}', NULL" for i, c in enumerate(numeric, len(text)))
    all_equal = _on("SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM features")
    return {
        "feature_names": _on(f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY place, level) - 1 AS INT) AS position,
            CASE WHEN level IS NULL THEN source ELSE source || '_' || level END AS feature, source
            FROM ({levels} UNION ALL {numbers})"""),
        "onehot": _on(" UNION ALL ".join(
            f"SELECT account_id, '{c}_' || {c} AS feature FROM features" for c in text)),
        "model_roundtrip": all_equal,
        "shap_additivity": all_equal,
        **dict.fromkeys(("global_drivers_check", "customer_drivers_check", "shap_points_check", "score_check"), all_equal),
        "train_check": _on("""SELECT CAST(SUM(FLOOR(n * 0.2 + 0.5)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS mismatches
            FROM (SELECT churned, COUNT(*) AS n FROM features GROUP BY churned)"""),
        "driver_export_check": "SELECT CAST(5 AS BIGINT) AS n, CAST(0 AS BIGINT) AS mismatches",
    }


def oracle_sql() -> dict[str, str]:
    return {**_segments(), **_columns(), **_statistics(), **_metrics(), **_model()}
