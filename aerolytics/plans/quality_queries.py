"""Registered queries: quality rules, drift, metrics, model comparison.

The truth / prediction pair is ``value`` against the previous value of the same user, and
three baseline predictors (last value, 3-row mean, 24-row mean) give a ``model_runs``
table computed from the data, on which best-model choice, gates and the experiment
report run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolytics.functions.aqi import aqi_category, aqi_code
from aerolytics.functions.calendar import calendar_columns
from aerolytics.operators import evaluate, quality, sampling
from aerolytics.operators.features import lag_columns
from aerolytics.operators.keyed import keyed_frame
from aerolytics.plans.feature_queries import sql_category, sql_code
from aerolytics.plans.registry import R6, register, round_doubles
from aerolytics.sources.tables import readings, table

CHOICE = {"pm25_regression": "rmse", "aqi_classification": "f1_macro"}
BASELINES = [("last_value", 1), ("mean_3h", 2), ("mean_24h", 3)]

# --- truth / prediction pair ----------------------------------------------------------

_PAIR = ("SELECT * FROM (SELECT event_id, value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p "
         "FROM events) t WHERE p IS NOT NULL")


def pair(spark, sf_dir):
    r = readings(spark, sf_dir, "user_id")
    kf = keyed_frame(r, ["station"], ["datetime"], halo=1)
    out = kf.finish(kf.df.select("event_id", F.col("pm25").alias("y"),
                                 F.lag("pm25", 1).over(kf.window).alias("p")))
    return out.filter(F.col("p").isNotNull())


@register("regression_metrics", oracle=f"""
SELECT {R6('sqrt(sum((p - y) * (p - y)) / count(*))')} AS rmse, {R6('avg(abs(p - y))')} AS mae,
  {R6('1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y))')} AS r2
FROM ({_PAIR}) x
""")
def q_regression_metrics(spark, sf_dir):
    return round_doubles(evaluate.regression_metrics(pair(spark, sf_dir)))


@register("confusion_matrix", oracle=f"""
SELECT {sql_code('y')} AS label, {sql_code('p')} AS prediction, count(*) AS count FROM ({_PAIR}) x GROUP BY 1, 2
""")
def q_confusion_matrix(spark, sf_dir):
    p = pair(spark, sf_dir).select(aqi_code("y").alias("y"), aqi_code("p").alias("p"))
    return evaluate.confusion_matrix(p)


def _f1_sql(lab: str, by: str) -> str:
    """Accuracy and macro F1 per ``by`` over a (by..., yl, pl) relation."""
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    using = f"JOIN conf USING ({by})" if by else "CROSS JOIN conf"
    return f"""
conf AS (SELECT {sel}yl, pl, count(*) AS n FROM {lab} GROUP BY ALL),
cls AS (SELECT DISTINCT {sel}c FROM (SELECT {sel}yl AS c FROM conf UNION ALL SELECT {sel}pl AS c FROM conf) u),
per AS (SELECT {', '.join('cls.' + b.strip() for b in by.split(',')) + ', ' if by else ''}cls.c,
          sum(CASE WHEN yl = c AND pl = c THEN n ELSE 0 END) AS tp,
          sum(CASE WHEN yl = c THEN n ELSE 0 END) AS st, sum(CASE WHEN pl = c THEN n ELSE 0 END) AS sp
        FROM cls {using} GROUP BY ALL),
f1 AS (SELECT {sel}avg(CASE WHEN st + sp = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / CAST(st + sp AS DOUBLE) END) AS f1_macro
       FROM per {grp}),
acc AS (SELECT {sel}avg(CASE WHEN yl = pl THEN 1.0 ELSE 0.0 END) AS accuracy FROM {lab} {grp})
"""


@register("classification_metrics", oracle=f"""
WITH lab AS (SELECT {sql_code('y')} AS yl, {sql_code('p')} AS pl FROM ({_PAIR}) x),
{_f1_sql('lab', '')}
SELECT {R6('accuracy')} AS accuracy, {R6('f1_macro')} AS f1_macro FROM acc CROSS JOIN f1
""")
def q_classification_metrics(spark, sf_dir):
    p = pair(spark, sf_dir).select(aqi_code("y").alias("y"), aqi_code("p").alias("p"))
    return round_doubles(evaluate.classification_metrics(p))


# --- residual distribution (I9) --------------------------------------------------------

_RESID = f"SELECT y - p AS residual FROM ({_PAIR}) x"


@register("error_distribution", oracle=f"""
WITH r AS ({_RESID}), m AS (SELECT count(residual) AS n, avg(residual) AS mu FROM r),
c AS (SELECT n, mu, avg((residual - mu) * (residual - mu)) AS m2,
        avg((residual - mu) * (residual - mu) * (residual - mu)) AS m3,
        avg((residual - mu) * (residual - mu) * (residual - mu) * (residual - mu)) AS m4
      FROM r CROSS JOIN m GROUP BY n, mu)
SELECT CAST(n AS BIGINT) AS n, {R6('mu')} AS mean, {R6('sqrt(m2 * n / (n - 1))')} AS std,
  {R6('m3 / pow(m2, 1.5)')} AS skewness, {R6('m4 / (m2 * m2) - 3')} AS kurtosis FROM c
""")
def q_error_distribution(spark, sf_dir):
    r = pair(spark, sf_dir).select((F.col("y") - F.col("p")).alias("residual"))
    return round_doubles(evaluate.moments(r, "residual"))


@register("error_histogram", oracle=f"""
WITH r AS ({_RESID}), g AS (SELECT min(residual) AS lo, max(residual) AS hi FROM r),
b AS (SELECT lo, hi, CAST(CASE WHEN (hi - lo) / 10 = 0 THEN 0 ELSE least(floor((residual - lo) / ((hi - lo) / 10)), 9) END AS INTEGER) AS bin
      FROM r CROSS JOIN g WHERE residual IS NOT NULL)
SELECT bin, {R6('lo + (hi - lo) * bin / 10')} AS lower, {R6('lo + (hi - lo) * (bin + 1) / 10')} AS upper, count(*) AS count
FROM b GROUP BY bin, lo, hi
""")
def q_error_histogram(spark, sf_dir):
    r = pair(spark, sf_dir).select((F.col("y") - F.col("p")).alias("residual"))
    return round_doubles(evaluate.histogram(r, "residual", 10))


# --- model runs from baseline predictors ---------------------------------------------

def baseline_predictions(spark, sf_dir):
    """(model, trained_order, y, p) for three baselines, from one window pass."""
    r = readings(spark, sf_dir, "user_id")
    kf = keyed_frame(r, ["station"], ["datetime"], halo=24)
    w = kf.window
    means = [F.avg("pm25").over(w.rowsBetween(-n, -1)).alias(f"pm25_roll_mean{n}") for n in (3, 24)]
    wide = kf.finish(kf.df.select(F.col("pm25").alias("y"), *lag_columns("pm25", [1], w), *means))
    wide = wide.filter(F.col("pm25_lag1").isNotNull())
    stack = F.expr("stack(3, 'last_value', 1, pm25_lag1, 'mean_3h', 2, pm25_roll_mean3, "
                   "'mean_24h', 3, pm25_roll_mean24)").alias("model", "trained_order", "p")
    return wide.select("y", stack)


def model_runs(spark, sf_dir):
    preds = baseline_predictions(spark, sf_dir)
    by = ["model", "trained_order"]
    reg = evaluate.regression_metrics(preds, "y", "p", by)
    labelled = preds.select(*by, aqi_code("y").alias("y"), aqi_code("p").alias("p"))
    cls = evaluate.classification_metrics(labelled, "y", "p", by)
    return (evaluate.metrics_to_runs(reg, "pm25_regression")
            .unionByName(evaluate.metrics_to_runs(cls, "aqi_classification")))


_RUNS = f"""
WITH b AS (SELECT value AS y,
   lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p1,
   avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS p2,
   avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS p3
   FROM events),
l AS (SELECT 'last_value' AS model, 1 AS trained_order, y, p1 AS p FROM b WHERE p1 IS NOT NULL
      UNION ALL SELECT 'mean_3h', 2, y, p2 FROM b WHERE p1 IS NOT NULL
      UNION ALL SELECT 'mean_24h', 3, y, p3 FROM b WHERE p1 IS NOT NULL),
reg AS (SELECT model, trained_order, sqrt(sum((p - y) * (p - y)) / count(*)) AS rmse, avg(abs(p - y)) AS mae,
          1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y)) AS r2 FROM l GROUP BY 1, 2),
lab AS (SELECT model, trained_order, {sql_code('y')} AS yl, {sql_code('p')} AS pl FROM l),
{_f1_sql('lab', 'model, trained_order')},
runs AS (
  SELECT 'pm25_regression' AS task, model, CAST(trained_order AS INTEGER) AS trained_order, 'rmse' AS metric, rmse AS value FROM reg
  UNION ALL SELECT 'pm25_regression', model, trained_order, 'mae', mae FROM reg
  UNION ALL SELECT 'pm25_regression', model, trained_order, 'r2', r2 FROM reg
  UNION ALL SELECT 'aqi_classification', model, trained_order, 'accuracy', accuracy FROM acc
  UNION ALL SELECT 'aqi_classification', model, trained_order, 'f1_macro', f1_macro FROM f1)
"""


@register("model_runs", oracle=_RUNS + f"SELECT task, model, trained_order, metric, {R6('value')} AS value FROM runs")
def q_model_runs(spark, sf_dir):
    return round_doubles(model_runs(spark, sf_dir))


_BEST = """
best AS (SELECT task, model, metric, value FROM (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY CASE WHEN metric IN ('f1_macro', 'accuracy', 'silhouette', 'r2')
         THEN value ELSE -value END DESC, trained_order) AS rk
  FROM runs WHERE (task = 'pm25_regression' AND metric = 'rmse') OR (task = 'aqi_classification' AND metric = 'f1_macro')) t
  WHERE rk = 1)
"""


@register("best_model", oracle=_RUNS + "," + _BEST + f"SELECT task, model, metric, {R6('value')} AS value FROM best")
def q_best_model(spark, sf_dir):
    return round_doubles(evaluate.best_model(model_runs(spark, sf_dir), CHOICE))


@register("model_gate", oracle=_RUNS + f"""
SELECT task, model, metric, {R6('value')} AS value,
  CASE WHEN metric = 'rmse' THEN value < 60 ELSE value > 0.6 END AS passed
FROM runs WHERE metric IN ('rmse', 'accuracy')
""")
def q_model_gate(spark, sf_dir):
    return round_doubles(evaluate.model_gate(model_runs(spark, sf_dir)))


@register("experiment_report", oracle=_RUNS + "," + _BEST + f"""
SELECT CASE task WHEN 'pm25_regression' THEN 'Pm25 Regression' ELSE 'Aqi Classification' END AS task_title,
  r.model, r.metric, {R6('r.value')} AS value, coalesce(r.model = b.model, false) AS is_best
FROM runs r LEFT JOIN (SELECT task, model FROM best) b USING (task)
""")
def q_experiment_report(spark, sf_dir):
    return round_doubles(evaluate.experiment_report(model_runs(spark, sf_dir), CHOICE))


# --- quality report and integrity checks ----------------------------------------------

def _quality_input(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("station"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") - 20).alias("pm25"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("pm10"),
        aqi_code("value").alias("aqi_label"), aqi_category("value").alias("aqi_category"),
        *[c for c in calendar_columns("ts") if "hour_sin" in str(c)])


_QIN = f"""SELECT event_type AS station, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value - 20 END AS pm25,
  CASE WHEN event_id % 3 = 0 THEN value END AS pm10, {sql_code('value')} AS aqi_label,
  {sql_category('value')} AS aqi_category, sin(2 * pi() * hour(ts) / 24) AS hour_sin FROM events"""


def _qrow(rule, col, expr, passed):
    return f"SELECT '{rule}' AS rule, '{col}' AS column, {R6(f'CAST(({expr}) AS DOUBLE)')} AS observed, ({expr}) {passed} AS passed FROM q"


@register("quality_report", oracle=f"WITH q AS ({_QIN})\n" + "\nUNION ALL ".join([
    _qrow("not_all_null", "pm25", "count(pm25)", "> 0"),
    _qrow("null_rate", "pm25", "avg(CASE WHEN pm25 IS NULL THEN 1.0 ELSE 0.0 END)", "< 0.3"),
    _qrow("not_all_null", "pm10", "count(pm10)", "> 0"),
    _qrow("null_rate", "pm10", "avg(CASE WHEN pm10 IS NULL THEN 1.0 ELSE 0.0 END)", "< 0.3"),
    _qrow("no_negatives", "pm25", "count(*) FILTER (WHERE pm25 < 0)", "= 0"),
    _qrow("label_range", "aqi_label", "count(*) FILTER (WHERE NOT (aqi_label BETWEEN 0 AND 5) OR aqi_label IS NULL)", "= 0"),
    _qrow("category_valid", "aqi_category", "count(*) FILTER (WHERE aqi_category NOT IN ('Good', 'Moderate', "
          "'Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous') OR aqi_category IS NULL)", "= 0"),
    _qrow("cyclic_range", "hour_sin", "count(*) FILTER (WHERE NOT (hour_sin BETWEEN -1.01 AND 1.01))", "= 0"),
    _qrow("row_count", "*", "count(*)", ">= 1000"),
    _qrow("key_count", "station", "count(DISTINCT station)", ">= 5"),
]))
def q_quality_report(spark, sf_dir):
    rep = quality.quality_report(_quality_input(spark, sf_dir), ["pm25", "pm10"],
                                 label="aqi_label", category="aqi_category", cyclic=["hour_sin"],
                                 key="station", min_rows=1000, min_keys=5, nonneg=["pm25"])
    return round_doubles(rep)


@register("duplicate_rows", oracle="""
SELECT user_id, event_type, count(*) AS n_copies FROM events GROUP BY 1, 2 HAVING count(*) > 1
""")
def q_duplicate_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_type")
    return quality.duplicate_rows(ev)


@register("constant_columns", oracle="""
WITH a AS (SELECT min(event_id) = max(event_id) AS c1, min(event_type) = max(event_type) AS c2,
                  min(value) = max(value) AS c3, true AS c4, NULL AS c5 FROM events)
SELECT 'event_id' AS column, coalesce(c1, true) AS is_constant FROM a
UNION ALL SELECT 'event_type', coalesce(c2, true) FROM a
UNION ALL SELECT 'value', coalesce(c3, true) FROM a
UNION ALL SELECT 'source', true FROM a
UNION ALL SELECT 'empty', true FROM a
""")
def q_constant_columns(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.lit("sensor").alias("source"),
        F.lit(None).cast("double").alias("empty"))
    return quality.constant_columns(ev)


# --- drift between the time-split sides ---------------------------------------------

_SPLIT = """SELECT event_type AS station, ts, value,
  ts > min(ts) OVER (PARTITION BY event_type) + to_microseconds((date_diff('microsecond', min(ts) OVER (PARTITION BY event_type), max(ts) OVER (PARTITION BY event_type)) * 4) // 5) AS is_test
FROM events"""
_LONG = f"""l AS (SELECT 'pm25' AS feature, value, is_test FROM ({_SPLIT}) s
  UNION ALL SELECT 'hour', CAST(hour(ts) AS DOUBLE), is_test FROM ({_SPLIT}) s)"""


def _drift_long(spark, sf_dir):
    r = readings(spark, sf_dir).select("station", "datetime", "pm25")
    s = sampling.split_time(r, "station", "datetime", 0.2)
    s = s.withColumn("hour", F.hour("datetime").cast("double"))
    return quality.to_long(s, ["pm25", "hour"], keep=["is_test"])


@register("drift_ks", oracle=f"""
WITH {_LONG},
c AS (SELECT feature, value, count(*) FILTER (WHERE NOT is_test) AS c1, count(*) FILTER (WHERE is_test) AS c2
      FROM l WHERE value IS NOT NULL GROUP BY 1, 2),
cdf AS (SELECT feature,
  sum(c1) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(c1) OVER (PARTITION BY feature) AS f1,
  sum(c2) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(c2) OVER (PARTITION BY feature) AS f2
  FROM c)
SELECT feature, {R6('max(abs(f1 - f2))')} AS ks FROM cdf GROUP BY 1
""")
def q_drift_ks(spark, sf_dir):
    return round_doubles(quality.drift_ks(_drift_long(spark, sf_dir)))


@register("drift_psi", oracle=f"""
WITH {_LONG},
ref AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM l WHERE NOT is_test AND value IS NOT NULL GROUP BY 1),
b AS (SELECT l.feature, is_test, CASE WHEN value > q[1] THEN 1 ELSE 0 END + CASE WHEN value > q[2] THEN 1 ELSE 0 END + CASE WHEN value > q[3] THEN 1 ELSE 0 END + CASE WHEN value > q[4] THEN 1 ELSE 0 END + CASE WHEN value > q[5] THEN 1 ELSE 0 END + CASE WHEN value > q[6] THEN 1 ELSE 0 END + CASE WHEN value > q[7] THEN 1 ELSE 0 END + CASE WHEN value > q[8] THEN 1 ELSE 0 END + CASE WHEN value > q[9] THEN 1 ELSE 0 END AS bin
      FROM l JOIN ref USING (feature) WHERE value IS NOT NULL),
pb AS (SELECT feature, bin, count(*) FILTER (WHERE NOT is_test) AS c1, count(*) FILTER (WHERE is_test) AS c2 FROM b GROUP BY 1, 2),
t AS (SELECT feature, greatest(c1 / sum(c1) OVER (PARTITION BY feature), 1e-4) AS e,
             greatest(c2 / sum(c2) OVER (PARTITION BY feature), 1e-4) AS a FROM pb)
SELECT feature, {R6('sum((a - e) * ln(a / e))')} AS psi FROM t GROUP BY 1
""")
def q_drift_psi(spark, sf_dir):
    return round_doubles(quality.drift_psi(_drift_long(spark, sf_dir)))


# --- scoring input checks (F10) ------------------------------------------------------

_CHECK_IN = ("SELECT event_id, value - 20 AS pm25, CAST(hour(ts) + CASE WHEN event_id % 30 = 0 "
             "THEN 24 ELSE 0 END AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month FROM events")


@register("score_input_check", oracle=f"""
WITH c AS ({_CHECK_IN})
SELECT event_id, 'pm25_non_negative' AS failed_rule FROM c WHERE NOT coalesce(pm25 >= 0, false)
UNION ALL SELECT event_id, 'hour_in_range' FROM c WHERE NOT coalesce(hour BETWEEN 0 AND 23, false)
UNION ALL SELECT event_id, 'month_in_range' FROM c WHERE NOT coalesce(month BETWEEN 1 AND 12, false)
""")
def q_score_input_check(spark, sf_dir):
    """Negatives (value - 20) and out-of-range hours (every 30th row) go to the reject table."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") - 20).alias("pm25"),
        (F.hour("ts") + F.when(F.col("event_id") % 30 == 0, 24).otherwise(0)).alias("hour"),
        F.month("ts").alias("month"))
    rules = {"pm25_non_negative": F.col("pm25") >= 0,
             "hour_in_range": F.col("hour").between(0, 23),
             "month_in_range": F.col("month").between(1, 12)}
    return quality.input_checks(ev, rules, keep=["event_id"])
