"""Equipment pack on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import forecast, metrics, temporal
from tidewatch.plans import assets as A
from tidewatch.workload.bindings import AS_OF_ASSETS
from tidewatch.workload.registry import query

_MONEY = "CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100"
_SPEND = _MONEY.format(c="replacement_cost")

_GOLD = (
    "b AS (SELECT asset_number, count(*) AS n, sum(CASE WHEN wo_type = 'Repair' THEN CAST(round(cost * 100) AS BIGINT) END) AS rc, sum(downtime_hours) AS dh FROM wo "
    "WHERE wo_date > DATE '1999-01-01' AND wo_date <= DATE '2000-01-01' GROUP BY 1), "
    "g0 AS (SELECT a.*, coalesce(n, 0) AS wo_count_12mo, coalesce(CAST(rc AS DOUBLE) / 100, 0) AS repair_cost_12mo, coalesce(dh, 0) AS downtime_hours_12mo, "
    "date_diff('day', DATE '2000-01-01', end_of_support_date) / CAST(365.25 AS DOUBLE) AS years_to_eos, end_of_support_date < DATE '2000-01-01' AS is_past_eos, "
    "CAST(year(end_of_support_date) AS INTEGER) AS eos_year FROM ast a LEFT JOIN b ON b.asset_number = a.asset_number), "
    "gold AS (SELECT *, CASE WHEN is_past_eos AND (os_eol OR repair_cost_12mo >= CAST(0.1 AS DOUBLE) * replacement_cost) THEN 'Critical' WHEN is_past_eos OR (years_to_eos < 1 AND os_eol) THEN 'High' "
    "WHEN years_to_eos < 2 OR os_eol OR repair_cost_12mo >= CAST(0.1 AS DOUBLE) * replacement_cost THEN 'Medium' ELSE 'Low' END AS risk_tier FROM g0)"
)


def _gold(t):
    return A.asset_gold(t.ast, t.wo, AS_OF_ASSETS)


@query(
    "asset_planning_table",
    f"WITH {_GOLD} SELECT asset_number, device_type, facility, clinical_area, end_of_support_date, replacement_cost, wo_count_12mo, repair_cost_12mo, downtime_hours_12mo, "
    "years_to_eos, is_past_eos, eos_year, risk_tier FROM gold",
    "ast wo",
)
def _(t):
    return _gold(t).select(
        "asset_number", "device_type", "facility", "clinical_area", "end_of_support_date", "replacement_cost", "wo_count_12mo",
        "repair_cost_12mo", "downtime_hours_12mo", "years_to_eos", "is_past_eos", "eos_year", "risk_tier",
    )


@query(
    "asset_risk_tier_counts",
    f"WITH {_GOLD} SELECT risk_tier, count(*) AS n FROM gold GROUP BY 1",
    "ast wo",
)
def _(t):
    return _gold(t).groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "end_of_support_by_year",
    f"SELECT CAST(year(end_of_support_date) AS INTEGER) AS eos_year, count(*) AS asset_count, round({_SPEND}, 0) AS replacement_spend FROM ast GROUP BY 1 ORDER BY 1",
    "ast",
)
def _(t):
    return A.eos_by_year(t.ast)


@query(
    "due_by_device_type",
    f"SELECT device_type, count(*) AS due_count, round({_SPEND}, 0) AS spend FROM ast WHERE year(end_of_support_date) = 2000 GROUP BY 1 ORDER BY 2 DESC, 1",
    "ast",
)
def _(t):
    return A.due(t.ast, 2000)


@query(
    "one_type_due_by_facility",
    f"SELECT facility, count(*) AS due_count, round({_SPEND}, 0) AS spend FROM ast WHERE device_type = 'ECONOMY' AND year(end_of_support_date) = 2000 GROUP BY 1 ORDER BY 2 DESC, 1",
    "ast",
)
def _(t):
    return A.due(t.ast, 2000, by="facility", device_type="ECONOMY")


@query(
    "support_percentages",
    "SELECT round(count(*) FILTER (end_of_support_date < DATE '2000-01-01') * 100.0 / count(*), 1) AS pct_past_eos, "
    "round(count(*) FILTER (os_eol) * 100.0 / count(*), 1) AS pct_eol_os FROM ast",
    "ast",
)
def _(t):
    return A.percent_kpis(t.ast, AS_OF_ASSETS)


@query(
    "burden_by_asset_age",
    # money per asset in whole units first, then means per year of age; 1461 days are four years
    "SELECT CAST(floor((DATE '2000-01-01' - purchase_date) * 4 / 1461.0) AS INTEGER) AS age_years, count(*) AS assets, round(avg(n), 1) AS avg_wo, "
    "round(avg(r), 1) AS avg_repairs, round(avg(c), 0) AS avg_wo_cost FROM ast, LATERAL (SELECT count(*) AS n, count(*) FILTER (wo_type = 'Repair') AS r, "
    "round(CAST(sum(CAST(round(cost * 100) AS BIGINT)) AS DOUBLE) / 100, 0) AS c FROM wo WHERE wo.asset_number = ast.asset_number) own WHERE n > 0 GROUP BY ALL ORDER BY age_years",
    "ast wo",
)
def _(t):
    return A.age_burden(t.ast, t.wo, AS_OF_ASSETS)


@query(
    "work_orders_per_asset",
    "SELECT (SELECT count(*) FROM ast) AS n_assets, (SELECT count(*) FROM wo) AS n_work_orders, (SELECT count(*) FROM wo)::DOUBLE / (SELECT count(*) FROM ast) AS per_asset",
    "ast wo",
)
def _(t):
    return A.orders_per_asset(t.ast, t.wo)


@query(
    "assets_with_all_time_burden",
    "SELECT a.asset_number, a.device_type, coalesce(w.n, 0) AS wo_count FROM ast a LEFT JOIN (SELECT asset_number, count(*) AS n FROM wo GROUP BY 1) w ON w.asset_number = a.asset_number",
    "ast wo",
)
def _(t):
    counts = t.wo.groupBy("asset_number").agg(F.count(F.lit(1)).alias("wo_count"))
    return t.ast.join(counts, "asset_number", "left").select(
        "asset_number", "device_type", F.coalesce("wo_count", F.lit(0)).alias("wo_count")
    )


_KPI = (
    f"count(*) AS asset_count, {_SPEND} AS replacement_spend, 100.0::DOUBLE * CAST(sum(CASE WHEN is_past_eos THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS past_eos_pct, "
    "100.0::DOUBLE * CAST(sum(CASE WHEN os_eol THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS eol_os_pct, "
    "round(CAST(sum(date_diff('day', DATE '2000-01-01', end_of_support_date)) AS DOUBLE) / (count(*) * 365.25::DOUBLE), 6) AS avg_years_to_eos"
)


def _rounded(df):
    return df.withColumn("avg_years_to_eos", F.round("avg_years_to_eos", 6))


@query(
    "kpis_by_year_and_facility",
    f"WITH {_GOLD} SELECT eos_year, facility, {_KPI} FROM gold GROUP BY 1, 2",
    "ast wo",
)
def _(t):
    return _rounded(metrics.evaluate(_gold(t), A.kpis(), ["eos_year", "facility"]))


@query(
    "kpis_overall",
    f"WITH {_GOLD} SELECT {_KPI} FROM gold",
    "ast wo",
)
def _(t):
    return _rounded(metrics.evaluate(_gold(t), A.kpis(), []))


@query(
    "kpis_cube",
    f"WITH {_GOLD} SELECT eos_year, facility, clinical_area, CAST(grouping_id(eos_year, facility, clinical_area) AS INTEGER) AS grain, {_KPI} FROM gold "
    "GROUP BY GROUPING SETS ((eos_year, facility, clinical_area), (eos_year, facility), (eos_year, clinical_area), (facility, clinical_area), (eos_year), (facility), (clinical_area), ())",
    "ast wo",
)
def _(t):
    return _rounded(metrics.evaluate_cube(_gold(t), A.kpis(), ["eos_year", "facility", "clinical_area"]))


@query(
    "past_support_heatmap",
    f"WITH {_GOLD} SELECT clinical_area, "
    + ", ".join(
        f"sum(CASE WHEN is_past_eos THEN 1 ELSE 0 END) FILTER (facility = 'F{i}')::BIGINT AS F{i}" for i in range(8)
    )
    + " FROM gold GROUP BY 1",
    "ast wo",
)
def _(t):
    metric = metrics.count_of("past", F.col("is_past_eos"))
    return metrics.heatmap(_gold(t), "clinical_area", "facility", [f"F{i}" for i in range(8)], metric)


@query(
    "areas_most_past_support",
    f"WITH {_GOLD} SELECT clinical_area, count(*) AS past_eos_count FROM gold WHERE is_past_eos GROUP BY 1",
    "ast wo",
)
def _(t):
    return A.past_eos_by_area(_gold(t))


@query(
    "top_areas_per_facility",
    f"WITH {_GOLD}, c AS (SELECT facility, clinical_area, count(*) AS n FROM gold WHERE is_past_eos GROUP BY 1, 2) SELECT facility, clinical_area, n, "
    "CAST(row_number() OVER (PARTITION BY facility ORDER BY n DESC, clinical_area) AS INTEGER) AS rank FROM c QUALIFY row_number() OVER (PARTITION BY facility ORDER BY n DESC, clinical_area) <= 3",
    "ast wo",
)
def _(t):
    counts = _gold(t).where("is_past_eos").groupBy("facility", "clinical_area").agg(F.count(F.lit(1)).alias("n"))
    return temporal.top_per_key(counts, ["facility"], [F.col("n").desc(), F.col("clinical_area")], 3)


@query(
    "ask_type_due_in_year",
    "SELECT asset_number, device_type, facility, end_of_support_date FROM ast WHERE device_type = 'ECONOMY' AND year(end_of_support_date) = 2000",
    "ast",
)
def _(t):
    return A.asset_list(t.ast, year=2000, device_type="ECONOMY").select("asset_number", "device_type", "facility", "end_of_support_date")


@query(
    "ask_critical_at_facility",
    f"WITH {_GOLD} SELECT asset_number, facility, risk_tier FROM gold WHERE risk_tier = 'Critical' AND facility LIKE 'F3%'",
    "ast wo",
)
def _(t):
    return A.asset_list(_gold(t), risk="Critical", facility_prefix="F3").select("asset_number", "facility", "risk_tier")


@query(
    "ask_operating_system",
    "SELECT asset_number, operating_system FROM ast WHERE operating_system LIKE '%Windows 7%'",
    "ast",
)
def _(t):
    return A.asset_list(t.ast, os_contains="windows 7").select("asset_number", "operating_system")


@query(
    "networked_end_of_life_devices",
    "SELECT asset_number, operating_system, mac_address FROM ast WHERE os_eol AND mac_address IS NOT NULL",
    "ast",
)
def _(t):
    return A.eol_os_exposure(t.ast).select("asset_number", "operating_system", "mac_address")


_KNOWN = f"k AS (SELECT facility, clinical_area, CAST(year(end_of_support_date) AS INTEGER) AS y, count(*)::DOUBLE AS n, {_SPEND} AS s FROM ast GROUP BY 1, 2, 3)"


@query(
    "replacement_outlook",
    f"WITH {_KNOWN}, f AS (SELECT facility, clinical_area, max(y) AS last, count(*) AS c, arg_max(n, y) AS ln, arg_max(s, y) AS ls, "
    "regr_slope(n, y) AS bn, regr_intercept(n, y) AS an, regr_slope(s, y) AS bs, regr_intercept(s, y) AS as_ FROM k GROUP BY 1, 2), "
    "h AS (SELECT f.*, last + i AS yy FROM f, (VALUES (1), (2), (3)) AS r(i)) "
    "SELECT facility, clinical_area, y AS eos_year, n AS asset_count, s AS replacement_spend, false AS is_forecast FROM k UNION ALL "
    "SELECT facility, clinical_area, CAST(yy AS INTEGER), round(greatest(CASE WHEN c >= 2 THEN an + bn * yy ELSE ln END, 0), 4), "
    "round(greatest(CASE WHEN c >= 2 THEN as_ + bs * yy ELSE ls END, 0), 2), true FROM h",
    "ast",
)
def _(t):
    out = A.replacement_outlook(t.ast, ["facility", "clinical_area"], 3)
    return out.withColumn("asset_count", F.round("asset_count", 4)).withColumn(
        "replacement_spend", F.round("replacement_spend", 2)
    )


@query(
    "demand_trend_forecast",
    "WITH f AS (SELECT department, shift, count(*) AS n, max(period) AS last, arg_max(required_fte, period) AS ly, regr_slope(required_fte, period) AS b, regr_intercept(required_fte, period) AS a, "
    "regr_sxx(required_fte, period) AS sxx, regr_sxy(required_fte, period) AS sxy, regr_syy(required_fte, period) AS syy FROM dem GROUP BY 1, 2), "
    "g AS (SELECT *, sqrt(greatest(syy - b * sxy, 0) / (n - 2)) AS sd FROM f), h AS (SELECT g.*, last + i AS p FROM g, (VALUES (1), (2), (3)) AS r(i)) "
    "SELECT department, shift, CAST(p AS INTEGER) AS period, round(greatest(a + b * p, 0), 4) AS forecast, round(greatest(a + b * p - 1.96 * sd, 0), 4) AS lower, "
    "round(greatest(a + b * p + 1.96 * sd, 0), 4) AS upper, n AS n_points FROM h",
    "dem",
)
def _(t):
    out = forecast.linear_forecast(t.dem, ["department", "shift"], "period", "required_fte", 3)
    for c in ("forecast", "lower", "upper"):
        out = out.withColumn(c, F.round(c, 4))
    return out


@query(
    "demand_forecast_backtest",
    "WITH tr AS (SELECT department, shift, regr_slope(required_fte, period) AS b, regr_intercept(required_fte, period) AS a FROM dem WHERE period <= 1998 GROUP BY 1, 2), "
    "e AS (SELECT d.department, d.shift, abs(greatest(a + b * period, 0) - required_fte) AS err, required_fte FROM dem d JOIN tr USING (department, shift) WHERE period > 1998) "
    "SELECT department, shift, count(*) AS n_held_out, round(avg(err), 4) AS mae, round(avg(err / required_fte), 4) AS mape FROM e GROUP BY 1, 2",
    "dem",
)
def _(t):
    past = t.dem.where("period <= 1998")
    ahead = forecast.linear_forecast(past, ["department", "shift"], "period", "required_fte", 3)
    out = forecast.backtest(ahead, t.dem.where("period > 1998"), ["department", "shift"], "period", "required_fte")
    return out.withColumn("mae", F.round("mae", 4)).withColumn("mape", F.round("mape", 4))


@query(
    "demand_actual_and_forecast",
    "WITH f AS (SELECT department, shift, max(period) AS last, regr_slope(required_fte, period) AS b, regr_intercept(required_fte, period) AS a FROM dem GROUP BY 1, 2) "
    "SELECT department, shift, period, required_fte, false AS is_forecast FROM dem UNION ALL SELECT department, shift, CAST(last + i AS INTEGER), "
    "round(greatest(a + b * (last + i), 0), 4), true FROM f, (VALUES (1), (2)) AS r(i)",
    "dem",
)
def _(t):
    ahead = forecast.linear_forecast(t.dem, ["department", "shift"], "period", "required_fte", 2)
    return t.dem.withColumn("is_forecast", F.lit(False)).unionByName(
        ahead.select(
            "department", "shift", "period", F.round("forecast", 4).alias("required_fte"), F.lit(True).alias("is_forecast")
        )
    )


# --- seasonal demand: orders by month ---------------------------------------------------

_MONTHS = (
    "mo AS (SELECT c_mktsegment AS department, o_orderpriority AS shift, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS m, "
    "CAST(count(*) AS DOUBLE) AS y FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"
)


def _months(t):
    orders = t.raw("orders").select("o_custkey", F.col("o_orderpriority").alias("shift"), (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m"))
    held = orders.join(t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("department")), "o_custkey")
    return held.groupBy("department", "shift", "m").agg(F.count(F.lit(1)).cast("double").alias("y"))


def _seasonal_sql() -> str:
    """Normal equations of constant, trend and one wave of twelve months, eliminated step by step."""
    n, by = 4, "department, shift"
    basis = lambda x: ["1.0::DOUBLE", f"({x} / 12.0::DOUBLE)", f"cos({x} * (2 * pi() / 12))", f"sin({x} * (2 * pi() / 12))"]
    sums = [f"sum(b{i} * b{j}) AS m{i}{j}" for i in range(n) for j in range(n)] + [f"sum(b{i} * y) AS m{i}{n}" for i in range(n)]
    sql = (
        f"WITH {_MONTHS}, x AS (SELECT *, CAST(m - min(m) OVER (PARTITION BY {by}) AS DOUBLE) AS x FROM mo), "
        f"b AS (SELECT *, {', '.join(f'{e} AS b{i}' for i, e in enumerate(basis('x')))} FROM x), "
        f"a0 AS (SELECT {by}, count(*) AS n_points, max(m) AS last, min(m) AS fst, {', '.join(sums)} FROM b GROUP BY {by}), "
    )
    for k in range(n):
        cells = [f"{f'm{i}{j}' if i == k else f'm{i}{j} - m{i}{k} / m{k}{k} * m{k}{j}'} AS m{i}{j}" for i in range(n) for j in range(n + 1)]
        sql += f"a{k + 1} AS (SELECT {by}, n_points, last, fst, {', '.join(cells)} FROM a{k}), "
    at = " + ".join(f"m{i}{n} / m{i}{i} * {e}" for i, e in enumerate(basis("CAST(last + h - fst AS DOUBLE)")))
    return sql + (
        f"f AS (SELECT {by}, CAST(last + h AS INTEGER) AS m, round(greatest({at}, 0), 3) AS forecast, n_points, 'seasonal' AS method "
        f"FROM a{n}, (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12)) AS r(h)) SELECT * FROM f"
    )


@query("seasonal_demand_forecast", _seasonal_sql())
def _(t):
    """The year ahead of monthly demand by department and shift."""
    out = forecast.seasonal_forecast(_months(t), ["department", "shift"], "m", "y", 12, period=12)
    return out.select("department", "shift", "m", F.round("forecast", 3).alias("forecast"), "n_points", "method")


@query("seasonal_backtest")
def _(t):
    """Rolling-origin error of the seasonal and the linear forecast, half a year ahead from four origins."""
    months, keys = _months(t), ["department", "shift"]
    last = months.agg(F.max("m")).first()[0] or 0
    origins = [last - 6 * k for k in range(1, 5)]
    seasonal = forecast.rolling_origin(months, keys, "m", "y", origins, lambda d, k: forecast.seasonal_forecast(d, k, "m", "y", 6, period=12))
    linear = forecast.rolling_origin(months, keys, "m", "y", origins, lambda d, k: forecast.linear_forecast(d, k, "m", "y", 6))
    return seasonal.withColumn("method", F.lit("seasonal")).unionByName(linear.withColumn("method", F.lit("trend")))


@query(
    "kpi_sketches",
    "SELECT c_mktsegment AS segment, o_orderpriority AS priority, CAST(grouping(c_mktsegment) * 2 + grouping(o_orderpriority) AS INTEGER) AS grain, count(*) AS n_orders, "
    "true AS customers_ok, true AS median_ok FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY CUBE (c_mktsegment, o_orderpriority)",
)
def _(t):
    """Distinct customers and median price at every grain from sketches of the finest one, held against exact values: the
    count within five standard errors, the median between the 46th and the 54th percentile."""
    held = t.raw("orders").join(t.raw("customer"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority"), "o_custkey", F.col("o_totalprice").cast("double").alias("price")
    )
    dims = ["segment", "priority"]
    made = metrics.evaluate_cube(
        held, [metrics.count_of("n_orders"), metrics.distinct_of("customers", F.col("o_custkey")), metrics.quantile_of("median", F.col("price"), 0.5)], dims
    )
    exact = held.cube(*dims).agg(
        F.grouping_id().cast("int").alias("grain"), F.countDistinct("o_custkey").alias("n"), F.percentile("price", F.array(F.lit(0.46), F.lit(0.54))).alias("p")
    )
    same = [made[c].eqNullSafe(exact[c]) for c in [*dims, "grain"]]
    j = made.join(exact, same)
    near = F.abs(F.col("customers") - F.col("n")) <= F.greatest(F.lit(1.0), 5 * 0.0163 * F.col("n"))
    return j.select(
        *[made[c] for c in [*dims, "grain"]], "n_orders", near.alias("customers_ok"), F.col("median").between(F.col("p")[0], F.col("p")[1]).alias("median_ok")
    )
