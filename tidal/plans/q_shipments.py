"""Queries over the shipments view: sources, scalars, daily aggregates,
EDA tables and per-series windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import series as S
from ..sources import tables as T
from .registry import SHIPMENTS_CTE, query, with_ctes

SH = with_ctes(SHIPMENTS_CTE)

# DuckDB twin of daily_aggregate for a key list.
def _daily_sql(keys: list[str]) -> str:
    k = ", ".join(["date", *keys])
    kj = " AND ".join([f"a.{c} = m.{c}" for c in ["date", *keys]])
    region = "region" if "region" in keys else "'ALL' AS region"
    sku = "sku_category" if "sku_category" in keys else "'ALL' AS sku_category"
    return f"""{SH},
agg AS (
  SELECT {k}, sum(shipping_weight_kg) AS total_shipping_weight_kg,
         avg(request_urgency) AS mean_urgency,
         avg(avg_repair_cycle_days) AS avg_repair_cycle_days,
         round(avg(failure_rate_pct), 6) AS failure_rate_pct,
         CAST(max(is_quarter_end) AS INTEGER) AS is_quarter_end,
         count(*) AS request_count
  FROM shipments GROUP BY {k}
),
mc AS (
  SELECT {k}, shipping_method, count(*) AS c FROM shipments GROUP BY {k}, shipping_method
),
m AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY c DESC, shipping_method) AS rn FROM mc
  ) WHERE rn = 1
)
SELECT a.date, {", ".join("a." + c for c in keys) + ("," if keys else "")}
       {"" if "region" in keys else "'ALL' AS region,"} {"" if "sku_category" in keys else "'ALL' AS sku_category,"}
       total_shipping_weight_kg,
       CAST(greatest(1, least(3, CAST(round_even(mean_urgency, 0) AS INTEGER))) AS INTEGER) AS request_urgency,
       avg_repair_cycle_days, failure_rate_pct, m.shipping_method,
       CAST(isodow(a.date) - 1 AS INTEGER) AS day_of_week, CAST(month(a.date) AS INTEGER) AS month,
       is_quarter_end, request_count
FROM agg a JOIN m ON {kj}"""


def _daily(level):
    def fn(spark, sf):
        """Daily aggregate at this level: sum of weight, bucketed mean urgency,
        mean cycle and failure rate, most frequent method, calendar, row count."""
        d = A.daily_aggregate(T.shipments(spark, sf), level)
        return d.withColumn("failure_rate_pct", F.round("failure_rate_pct", 6))
    return fn


for _lvl, _key in (("region", "daily_by_region"), ("sku", "daily_by_sku"),
                   ("all", "daily_all"), ("region_sku", "daily_by_region_sku")):
    query(_key, _daily_sql(A.LEVELS[_lvl]), headline=_lvl == "region")(_daily(_lvl))


ROLLING_SQL = f"""{SH},
d AS (SELECT date, region, sum(shipping_weight_kg) AS total_shipping_weight_kg
      FROM shipments GROUP BY date, region)
SELECT date, region, total_shipping_weight_kg,
       round(CASE WHEN count(*) OVER w7 = 7 THEN avg(total_shipping_weight_kg) OVER w7 END, 6) AS rolling_mean_7,
       round(CASE WHEN count(*) OVER w30 = 30 THEN avg(total_shipping_weight_kg) OVER w30 END, 6) AS rolling_mean_30
FROM d
WINDOW w7 AS (PARTITION BY region ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY region ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""


@query("rolling_mean", ROLLING_SQL, headline=True)
def q_rolling_mean(spark, sf):
    """Minimum slice: shipments view -> daily by region -> 7/30-row trailing means."""
    d = A.daily_aggregate(T.shipments(spark, sf), "region")
    r = S.rolling_mean(d.select("date", "region", "total_shipping_weight_kg"),
                       "total_shipping_weight_kg", ["region"])
    return r.withColumn("rolling_mean_7", F.round("rolling_mean_7", 6)) \
            .withColumn("rolling_mean_30", F.round("rolling_mean_30", 6))


# --- 2.1 / 2.2 sources and scalar columns -------------------------------------

@query("read_shipments", f"{SH} SELECT * FROM shipments")
def q_read_shipments(spark, sf):
    """Record-level shipments view over the six TPC-H-like tables."""
    return T.shipments(spark, sf)


@query("select_features", f"""{SH}
SELECT date, region, sku_category, request_urgency, shipping_method,
       avg_repair_cycle_days, failure_rate_pct, day_of_week, month FROM shipments""")
def q_select_features(spark, sf):
    """Categorical and numeric feature columns of the shipments."""
    return T.shipments(spark, sf).select("date", *A.CATEGORICAL_FEATURES, *A.NUMERIC_FEATURES)


@query("rename_target", f"""{SH}
SELECT date, region, sku_category, sum(shipping_weight_kg) AS total_shipping_weight_kg,
       avg(request_urgency) AS request_urgency,
       avg(avg_repair_cycle_days) AS avg_repair_cycle_days,
       round(avg(failure_rate_pct), 6) AS failure_rate_pct,
       CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
       CAST(max(is_quarter_end) AS INTEGER) AS is_quarter_end
FROM shipments GROUP BY date, region, sku_category""")
def q_rename_target(spark, sf):
    d = A.daily_region_sku(T.shipments(spark, sf))
    return d.withColumn("failure_rate_pct", F.round("failure_rate_pct", 6))


@query("fill_level_all", f"""{SH}
SELECT date, 'ALL' AS region, 'ALL' AS sku_category,
       sum(shipping_weight_kg) AS total_shipping_weight_kg FROM shipments GROUP BY date""")
def q_fill_level_all(spark, sf):
    """Date-level aggregate with region and SKU filled as 'ALL'."""
    return A.daily_aggregate(T.shipments(spark, sf), "all").select(
        "date", "region", "sku_category", "total_shipping_weight_kg")


@query("urgency_bucket", f"""{SH}
SELECT date, region, avg(request_urgency) AS mean_urgency,
       CAST(greatest(1, least(3, CAST(round_even(avg(request_urgency), 0) AS INTEGER))) AS INTEGER)
         AS request_urgency
FROM shipments GROUP BY date, region""")
def q_urgency_bucket(spark, sf):
    """Mean urgency per (date, region) and its half-even bucket in 1..3."""
    from ..functions.columns import urgency_bucket
    return (T.shipments(spark, sf).groupBy("date", "region")
            .agg(F.avg("request_urgency").alias("mean_urgency"))
            .withColumn("request_urgency", urgency_bucket("mean_urgency")))


_DATES = f"{SH}, d AS (SELECT DISTINCT date FROM shipments)"


@query("eom_eoq_flags", f"""{_DATES}
SELECT date,
       CAST(day(date) >= day(last_day(date)) - 2 AS INTEGER) AS is_eom,
       CAST(month(date) IN (3, 6, 9, 12) AND day(date) >= day(last_day(date)) - 2 AS INTEGER)
         AS is_quarter_end
FROM d""")
def q_eom_eoq_flags(spark, sf):
    """Last-3-days-of-month and quarter-end flags per shipping date."""
    from ..functions.columns import is_eom, is_quarter_end
    d = T.shipments(spark, sf).select("date").distinct()
    return d.select("date", is_eom("date").alias("is_eom"),
                    is_quarter_end("date").alias("is_quarter_end"))


@query("month_end_regressor", f"""{_DATES}
SELECT date, CAST(day(date) >= 28 OR (month(date) IN (3, 6, 9, 12)
                  AND day(date) >= day(last_day(date)) - 2) AS DOUBLE) AS is_month_end
FROM d""")
def q_month_end_regressor(spark, sf):
    """Month-end regressor (day >= 28 or quarter end) per date."""
    from ..functions.columns import month_end_regressor
    d = T.shipments(spark, sf).select("date").distinct()
    return d.select("date", month_end_regressor("date").alias("is_month_end"))


@query("trend_position", f"""{_DATES}
SELECT date, round(datediff('day', (SELECT min(date) FROM d), date)
                   / datediff('day', (SELECT min(date) FROM d), (SELECT max(date) FROM d)), 9)
         AS trend_position
FROM d""")
def q_trend_position(spark, sf):
    """Elapsed share of the date span per date."""
    d = S.computed_once(T.shipments(spark, sf).select("date").distinct())
    lo, hi = S.date_bounds(d)
    span = max((hi - lo).days, 1)
    return d.select("date", F.round(F.datediff("date", F.lit(lo)) / F.lit(float(span)), 9)
                    .alias("trend_position"))


# --- 2.3 joins ----------------------------------------------------------------

@query("daily_with_counts", f"""{SH},
a AS (SELECT date, sum(shipping_weight_kg) AS shipping_weight_kg FROM shipments GROUP BY date),
c AS (SELECT date, count(*) AS request_count FROM shipments GROUP BY date)
SELECT a.date, shipping_weight_kg, request_count FROM a JOIN c ON a.date = c.date""")
def q_daily_with_counts(spark, sf):
    """One groupBy carries both aggregates (the join form collapses to it)."""
    return T.shipments(spark, sf).groupBy("date").agg(
        F.sum("shipping_weight_kg").alias("shipping_weight_kg"),
        F.count(F.lit(1)).alias("request_count"))


@query("densify_series", f"""{SH},
d AS (SELECT date, region, sum(shipping_weight_kg) AS y FROM shipments GROUP BY date, region),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM d), (SELECT max(date) FROM d),
                                           INTERVAL 1 DAY)) AS DATE) AS date),
r AS (SELECT DISTINCT region FROM d)
SELECT cal.date, r.region, coalesce(d.y, 0) AS y, d.y IS NULL AS filled
FROM cal CROSS JOIN r LEFT JOIN d ON d.date = cal.date AND d.region = r.region""")
def q_densify_series(spark, sf):
    """Every (date, region) of the calendar; gap days get y = 0."""
    d = S.computed_once(T.shipments(spark, sf).groupBy("date", "region").agg(
        F.sum("shipping_weight_kg").alias("y")))
    out = S.densify_series(d.withColumn("filled", F.lit(False)), ["region"], "date",
                           fill={"y": 0.0, "filled": True})
    return out.select("date", "region", "y", "filled")


# --- 2.4 aggregates -----------------------------------------------------------

@query("daily_all_levels", f"""{SH},
agg AS (
  SELECT date, region, sku_category, grouping(region, sku_category) AS gid,
         sum(shipping_weight_kg) AS total_shipping_weight_kg,
         avg(request_urgency) AS mean_urgency,
         avg(avg_repair_cycle_days) AS avg_repair_cycle_days,
         round(avg(failure_rate_pct), 6) AS failure_rate_pct,
         CAST(max(is_quarter_end) AS INTEGER) AS is_quarter_end, count(*) AS request_count
  FROM shipments
  GROUP BY GROUPING SETS ((date), (date, region), (date, sku_category), (date, region, sku_category))
),
mc AS (
  SELECT date, region, sku_category, grouping(region, sku_category) AS gid, shipping_method,
         count(*) AS c
  FROM shipments
  GROUP BY GROUPING SETS ((date, shipping_method), (date, region, shipping_method),
                          (date, sku_category, shipping_method),
                          (date, region, sku_category, shipping_method))
),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, region, sku_category, gid
                                                  ORDER BY c DESC, shipping_method) AS rn FROM mc)
      WHERE rn = 1)
SELECT CASE a.gid WHEN 3 THEN 'all' WHEN 1 THEN 'region' WHEN 2 THEN 'sku' ELSE 'region_sku' END
         AS level,
       a.date, coalesce(a.region, 'ALL') AS region, coalesce(a.sku_category, 'ALL') AS sku_category,
       total_shipping_weight_kg,
       CAST(greatest(1, least(3, CAST(round_even(mean_urgency, 0) AS INTEGER))) AS INTEGER)
         AS request_urgency,
       avg_repair_cycle_days, failure_rate_pct, m.shipping_method,
       CAST(isodow(a.date) - 1 AS INTEGER) AS day_of_week, CAST(month(a.date) AS INTEGER) AS month,
       is_quarter_end, request_count
FROM agg a JOIN m ON a.date = m.date AND a.gid = m.gid
  AND a.region IS NOT DISTINCT FROM m.region AND a.sku_category IS NOT DISTINCT FROM m.sku_category""")
def q_daily_all_levels(spark, sf):
    """All four aggregation levels in one GROUPING SETS pass."""
    d = A.daily_all_levels(T.shipments(spark, sf))
    return d.withColumn("failure_rate_pct", F.round("failure_rate_pct", 6))


@query("prophet_frame", f"""{SH}
SELECT date AS ds, sum(shipping_weight_kg) AS y,
       CAST(day(date) >= 28 OR max(is_quarter_end) = 1 AS DOUBLE) AS is_month_end,
       round(avg(failure_rate_pct), 6) AS failure_rate_pct, avg(request_urgency) AS avg_urgency
FROM shipments GROUP BY date""")
def q_prophet_frame(spark, sf):
    """Global daily frame ds, y and the three regressors."""
    p = A.prophet_frame(T.shipments(spark, sf))
    return p.withColumn("failure_rate_pct", F.round("failure_rate_pct", 6))


@query("mode_per_group", f"""{SH},
mc AS (SELECT region, shipping_method, count(*) AS c FROM shipments GROUP BY 1, 2)
SELECT region, shipping_method AS mode_method FROM (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY c DESC, shipping_method) AS rn FROM mc)
WHERE rn = 1""")
def q_mode_per_group(spark, sf):
    """Most frequent shipping method per region (smallest on ties)."""
    return T.shipments(spark, sf).groupBy("region").agg(
        F.mode("shipping_method", True).alias("mode_method"))


@query("first_per_group", f"""{SH}
SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
       CAST(max(is_quarter_end) AS INTEGER) AS is_quarter_end
FROM shipments GROUP BY date""")
def q_first_per_group(spark, sf):
    """Columns constant inside a date group come from the key, not ``first``."""
    from ..functions.columns import weekday0
    return T.shipments(spark, sf).groupBy("date").agg(
        F.max("is_quarter_end").alias("is_quarter_end")).select(
        "date", weekday0("date").alias("day_of_week"), F.month("date").alias("month"),
        "is_quarter_end")


@query("rows_per_day", f"{SH} SELECT date, count(*) AS request_count FROM shipments GROUP BY date")
def q_rows_per_day(spark, sf):
    """Shipment count per date."""
    return T.shipments(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("request_count"))


@query("value_counts_urgency", f"""{SH}
SELECT request_urgency, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS pct
FROM shipments GROUP BY request_urgency""")
def q_value_counts_urgency(spark, sf):
    from ..operators.eda import value_counts_pct
    v = value_counts_pct(T.shipments(spark, sf), "request_urgency")
    return v.withColumn("pct", F.round("pct", 9))


@query("value_counts_sku", f"""{SH}
SELECT sku_category, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS pct
FROM shipments GROUP BY sku_category""")
def q_value_counts_sku(spark, sf):
    from ..operators.eda import value_counts_pct
    return value_counts_pct(T.shipments(spark, sf), "sku_category").withColumn(
        "pct", F.round("pct", 9))


@query("share_of_total", f"""{SH}
SELECT region, sum(shipping_weight_kg) AS total,
       round(sum(shipping_weight_kg) * 100.0 / sum(sum(shipping_weight_kg)) OVER (), 9) AS pct
FROM shipments GROUP BY region""")
def q_share_of_total(spark, sf):
    """Weight per region and percent of the grand total."""
    from ..operators.eda import share_of_total
    return share_of_total(T.shipments(spark, sf), "region", "shipping_weight_kg").withColumn(
        "pct", F.round("pct", 9))


_NUM = ["shipping_weight_kg", "avg_repair_cycle_days", "request_urgency"]


@query("numeric_summary", f"""{SH}
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       CAST(median({c}) AS DOUBLE) AS median, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, count({c}) AS n FROM shipments""" for c in _NUM))
def q_numeric_summary(spark, sf):
    """Mean, sample std, exact median, min, max per measure."""
    from ..operators.eda import numeric_summary
    s = numeric_summary(T.shipments(spark, sf), _NUM)
    return s.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query("dataset_profile", f"""{SH}
SELECT count(*) AS rows, min(date) AS first, max(date) AS last,
       count(DISTINCT region) AS distinct_region, count(DISTINCT sku_category) AS distinct_sku_category
FROM shipments""")
def q_dataset_profile(spark, sf):
    """Rows, date range and distinct regions / SKUs."""
    from ..operators.eda import dataset_profile
    return dataset_profile(T.shipments(spark, sf), "date", ["region", "sku_category"])


def _region_names(spark, sf):
    return sorted(r[0] for r in T.read_table(spark, sf, "region").select("r_name").collect())


@query("pivot_region", f"""{SH}
PIVOT (SELECT date, region, shipping_weight_kg FROM shipments) ON region
  IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') USING sum(shipping_weight_kg)
GROUP BY date""")
def q_pivot_region(spark, sf):
    """Date rows x region columns; the column list is the region dimension
    (5 rows), read without scanning the fact table."""
    from ..operators.eda import pivot_by
    return pivot_by(T.shipments(spark, sf), "date", "region", "shipping_weight_kg",
                    _region_names(spark, sf))


def _hist_sql(expr: str, bins: int = 50) -> str:
    return f"""{SH},
x AS (SELECT {expr} AS v FROM shipments),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
c AS (SELECT least({bins - 1}, floor((v - lo) * {float(bins)} / (hi - lo))) AS bin, count(*) AS n FROM x, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / {bins}), 9) AS lower,
       round(lo + (i + 1) * ((hi - lo) / {bins}), 9) AS upper, coalesce(n, 0) AS count
FROM b, range({bins}) t(i) LEFT JOIN c ON c.bin = i"""


def _hist(expr_fn):
    def fn(spark, sf):
        """50 equal-width bins over [min, max] of the shipment weight (last bin closed)."""
        from ..operators.eda import histogram
        h = histogram(T.shipments(spark, sf), expr_fn(), 50)
        return h.withColumn("lower", F.round("lower", 9)).withColumn("upper", F.round("upper", 9))
    return fn


query("histogram", _hist_sql("shipping_weight_kg"))(_hist(lambda: F.col("shipping_weight_kg")))
query("histogram_log1p", _hist_sql("ln(1 + shipping_weight_kg)"))(
    _hist(lambda: F.log1p("shipping_weight_kg")))


def _box_sql(by: str) -> str:
    return f"""{SH},
q AS (SELECT {by}, count(*) AS n, quantile_cont(shipping_weight_kg, 0.25) AS q1,
             quantile_cont(shipping_weight_kg, 0.5) AS median,
             quantile_cont(shipping_weight_kg, 0.75) AS q3 FROM shipments GROUP BY {by}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.{by}, n, q1, median, q3, iqr,
       CAST(min(CASE WHEN s.shipping_weight_kg BETWEEN lo_f AND hi_f THEN s.shipping_weight_kg END) AS DOUBLE) AS lower_whisker,
       CAST(max(CASE WHEN s.shipping_weight_kg BETWEEN lo_f AND hi_f THEN s.shipping_weight_kg END) AS DOUBLE) AS upper_whisker,
       CAST(sum(CASE WHEN s.shipping_weight_kg BETWEEN lo_f AND hi_f THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM shipments s JOIN f ON s.{by} = f.{by}
GROUP BY f.{by}, n, q1, median, q3, iqr"""


def _box(by):
    def fn(spark, sf):
        """Weight quartiles, 1.5 IQR whiskers and outlier count per group."""
        from ..operators.eda import box_stats
        return box_stats(T.shipments(spark, sf), "shipping_weight_kg", by)
    return fn


query("box_stats_region", _box_sql("region"))(_box("region"))
query("box_stats_urgency", _box_sql("request_urgency"))(_box("request_urgency"))

_CORR_REC = ["shipping_weight_kg", "request_urgency", "avg_repair_cycle_days",
             "failure_rate_pct", "day_of_week", "month", "is_quarter_end"]


def _corr_sql(src: str, cols: list[str]) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}) / "
                         f"nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6) AS corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


@query("correlation_records", f"{SH}\n" + _corr_sql("shipments", _CORR_REC))
def q_correlation_records(spark, sf):
    """Pearson matrix (long form) over record-level columns."""
    from ..operators.eda import correlation_long
    return correlation_long(T.shipments(spark, sf), _CORR_REC).withColumn(
        "corr", F.round("corr", 6))


_CORR_DAILY = ["shipping_weight_kg", "request_count", "request_urgency", "day_of_week",
               "month", "is_quarter_end"]


@query("correlation_daily", f"""{SH},
dd AS (SELECT date, sum(shipping_weight_kg) AS shipping_weight_kg, count(*) AS request_count,
              avg(request_urgency) AS request_urgency, isodow(date) - 1 AS day_of_week,
              month(date) AS month, max(is_quarter_end) AS is_quarter_end
       FROM shipments GROUP BY date)
""" + _corr_sql("dd", _CORR_DAILY))
def q_correlation_daily(spark, sf):
    """Pearson matrix (long form) over daily totals and counts."""
    from ..functions.columns import weekday0
    from ..operators.eda import correlation_long
    d = T.shipments(spark, sf).groupBy("date").agg(
        F.sum("shipping_weight_kg").alias("shipping_weight_kg"),
        F.count(F.lit(1)).alias("request_count"),
        F.avg("request_urgency").alias("request_urgency"),
        F.max("is_quarter_end").alias("is_quarter_end")).select(
        "*", weekday0("date").alias("day_of_week"), F.month("date").alias("month"))
    return correlation_long(d, _CORR_DAILY).withColumn("corr", F.round("corr", 6))


def _season_sql(key: str) -> str:
    return f"""{SH},
g AS (SELECT {key}, avg(shipping_weight_kg) AS mean, count(*) AS n FROM shipments GROUP BY {key})
SELECT {key}, round(mean, 6) AS mean, n, round(avg(mean) OVER (), 6) AS mean_of_means FROM g"""


def _season(key):
    def fn(spark, sf):
        """Mean shipment weight per calendar key and the mean of those means."""
        from ..operators.eda import mean_by
        m = mean_by(T.shipments(spark, sf), key, "shipping_weight_kg")
        return m.withColumn("mean", F.round("mean", 6)).withColumn(
            "mean_of_means", F.round("mean_of_means", 6))
    return fn


query("seasonal_profile_dow", _season_sql("day_of_week"))(_season("day_of_week"))
query("seasonal_profile_month", _season_sql("month"))(_season("month"))


@query("sku_profile", f"""{SH}
SELECT sku_category, round(avg(shipping_weight_kg), 6) AS mean_weight, count(*) AS count,
       CAST(row_number() OVER (ORDER BY avg(shipping_weight_kg), sku_category) AS INTEGER) AS rank
FROM shipments GROUP BY sku_category""")
def q_sku_profile(spark, sf):
    """Mean weight and count per SKU, ranked by mean."""
    from pyspark.sql import Window
    g = T.shipments(spark, sf).groupBy("sku_category").agg(
        F.avg("shipping_weight_kg").alias("mean_weight"), F.count(F.lit(1)).alias("count"))
    # one row per category: ordering the grouped rows is bounded by the category count
    return g.withColumn("rank", F.row_number().over(
        Window.orderBy("mean_weight", "sku_category"))).withColumn(
        "mean_weight", F.round("mean_weight", 6))


# --- 2.6 / 2.7 sorts, sets -------------------------------------------------------

@query("order_by_date", f"""{SH}
SELECT date, region, sum(shipping_weight_kg) AS y,
       CAST(row_number() OVER (PARTITION BY region ORDER BY date) AS INTEGER) AS position
FROM shipments GROUP BY date, region""")
def q_order_by_date(spark, sf):
    """Position of each daily row inside its region series."""
    from pyspark.sql import Window
    d = T.shipments(spark, sf).groupBy("date", "region").agg(F.sum("shipping_weight_kg").alias("y"))
    return d.withColumn("position", F.row_number().over(
        Window.partitionBy("region").orderBy("date")))


@query("distinct_values", f"{SH} SELECT DISTINCT region FROM shipments")
def q_distinct_values(spark, sf):
    """Distinct regions."""
    return T.shipments(spark, sf).select("region").distinct()
