"""Monitoring queries: baseline, windows, profile, drift, quality and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import drift as dr
from ebbtide.operators import monitor as mo
from ebbtide.operators import profile as pf
from ebbtide.operators import quality as ql
from ebbtide.operators.features import build_features
from ebbtide.operators.scoring import standin_score
from ebbtide.plans.oracle import VIEWS, u
from ebbtide.plans.registry import query
from ebbtide.sources.sinks import materialize_once

NUMERIC = (
    "monthly_charges", "total_charges", "tenure_months", "senior_citizen", "num_optional_services", "total_tickets",
    "billing_tickets", "technical_tickets", "cancellation_tickets", "high_priority_tickets", "avg_resolution_hours",
    "avg_price_increase", "churn_probability",
)
TEXTS = ("contract_type", "internet_service", "payment_method", "phone_service", "paperless_billing", "partner",
         "dependents")
CATEGORICAL = (*TEXTS, "prediction", "churn_label")

# ---- checking views -------------------------------------------------------------------

_SCORE = f"""least(0.99e0, greatest(0.01e0, 0.15e0
 + case when contract_type='Month-to-month' then 0.35e0 else 0e0 end
 + case when tenure_months < 12 then 0.20e0 else 0e0 end + ({u('customer_id', 'score')} - 0.5e0) * 0.30e0))"""

VIEWS["labelled"] = """select f.*, l.split, case when l.churn='Yes' then 1e0 else 0e0 end as churn_label,
 case when f.tenure_months > 0 then f.monthly_charges/f.tenure_months else 0e0 end as avg_price_increase
 from churn_labels l join features f on l.customer_id=f.customer_id"""

VIEWS["drifted"] = f"""select * exclude (m, tt) replace (m as monthly_charges, tt as total_charges,
  tenure_months + 6 as tenure_months,
  case when {u('customer_id', 'drift')} < 0.70 then 'Month-to-month' else contract_type end as contract_type,
  m / greatest(tenure_months + 6, 1) as avg_price_increase)
 from (select *, floor((cast(round(monthly_charges*100) as bigint)*115+50)/100)::double/100 as m,
  floor((cast(round(total_charges*100) as bigint)*120+50)/100)::double/100 as tt from labelled where split='test')"""


def _scored(source, stamp):
    return f"""select * exclude (split, p), case when p >= 0.5e0 then 1e0 else 0e0 end as prediction,
 p as churn_probability, timestamp '{stamp}' as inference_timestamp, 'churn_model' as model_id
 from (select *, {_SCORE} as p from {source})"""


VIEWS["baseline_rows"] = _scored("(select * from labelled where split='train')", "2025-06-01 00:00:00")
VIEWS["inference_log"] = (_scored("(select * from labelled where split='test')", "2025-07-01 00:00:00")
                          + " union all by name " + _scored("drifted", "2025-08-01 00:00:00"))


def _long(source, columns, kind, window):
    return " union all ".join(
        f"select {window} as \"window\", '{c}' as column_name, {c}::{kind} as v, count(*) as n from {source} "
        f"where {c} is not null group by all" for c in columns)


_W = "date_trunc('month', inference_timestamp)::timestamp"
VIEWS["num_base"] = _long("baseline_rows", NUMERIC, "double", "null::timestamp")
VIEWS["num_log"] = _long("inference_log", NUMERIC, "double", _W)
VIEWS["cat_base"] = _long("baseline_rows", CATEGORICAL, "varchar", "null::timestamp")
VIEWS["cat_log"] = _long("inference_log", CATEGORICAL, "varchar", _W)
VIEWS["log_windows"] = f"select distinct {_W} as \"window\" from inference_log"


def _stack_sql(base, log):
    return f"""select "window", column_name, v, sum(nb)::bigint as nb, sum(nw)::bigint as nw from (
 select w."window", b.column_name, b.v, b.n as nb, 0 as nw from {base} b, log_windows w
 union all select "window", column_name, v, 0, n from {log}) group by all"""


VIEWS["num_stack"] = _stack_sql("num_base", "num_log")
VIEWS["cat_stack"] = _stack_sql("cat_base", "cat_log")
VIEWS["num_cdf"] = """select *, sum(nb) over w / sum(nb) over a as fb, sum(nw) over w / sum(nw) over a as fw,
 lead(v) over w as nxt, sum(nb) over a as tb, sum(nw) over a as tw from num_stack
 window w as (partition by "window", column_name order by v rows unbounded preceding),
 a as (partition by "window", column_name)"""
VIEWS["ks_w1"] = """select "window", column_name, max(abs(fb-fw)) as ks, sum(abs(fb-fw)*(coalesce(nxt,v)-v)) as w1,
 max(tb)::double as tb, max(tw)::double as tw from num_cdf group by all"""
VIEWS["ks_p"] = """select *, case when lam < 0.2 then 1e0 else greatest(0e0, least(1e0, list_sum(list_transform(
 range(1,101), lambda k: (case when k%2=1 then 2e0 else -2e0 end)*exp(-2e0*k*k*lam*lam))))) end as pvalue
 from (select *, sqrt(tb*tw/(tb+tw))*ks as lam from ks_w1)"""
_EDGES = ", ".join(f"round(quantile_cont(v, {i / 10}), 6)" for i in range(1, 10))
_BASE_VALUES = " union all ".join(f"select '{c}' as column_name, {c}::double as v from baseline_rows" for c in NUMERIC)
VIEWS["edges"] = f"select column_name, [{_EDGES}] as e from ({_BASE_VALUES}) group by column_name"
VIEWS["drift_bins"] = """select "window", s.column_name, 'numeric' as kind,
 len(list_filter(e, lambda x: v > x))::varchar as bin, sum(nb)::bigint as nb, sum(nw)::bigint as nw
 from num_stack s join edges using (column_name) group by all
 union all select "window", column_name, 'categorical', v, nb, nw from cat_stack"""
VIEWS["drift_shares"] = """select *, nw::double/sum(nw) over (partition by "window", column_name) as p,
 nb::double/sum(nb) over (partition by "window", column_name) as q,
 sum(nw) over (partition by "window", column_name) as tw from drift_bins"""
VIEWS["distances"] = """select "window", column_name, kind,
 sum((greatest(p,1e-4)-greatest(q,1e-4))*ln(greatest(p,1e-4)/greatest(q,1e-4))) as psi,
 sqrt(greatest(0e0, sum(0.5e0*(case when p>0 then p*ln(p/((p+q)/2)) else 0 end)
  + 0.5e0*(case when q>0 then q*ln(q/((p+q)/2)) else 0 end)))) as js,
 sum(abs(p-q))/2 as tv, max(abs(p-q)) as max_bin,
 sum(case when kind='categorical' then pow(nw - (case when q>0 then q else 1e-4 end)*tw, 2)
  /((case when q>0 then q else 1e-4 end)*tw) end) as chi2, count(*)-1 as degrees
 from drift_shares group by all"""
# The chi-squared test at 5% against its critical value, degrees 1 to 3.
VIEWS["drift_facts"] = """select d.*, ks, w1, pvalue,
 coalesce(pvalue < 0.05, chi2 > case degrees when 1 then 3.841458820694124e0 when 2 then 5.991464547107979e0
  when 3 then 7.814727903251179e0 end, false) as significant
 from distances d left join ks_p using ("window", column_name)"""


# ---- shared frames --------------------------------------------------------------------

def _features(t):
    return build_features(t.customers, t.tickets)


def _baseline(t):
    """Stored once per run, as its readers scan it several times."""
    return t.once("baseline", lambda: materialize_once(mo.build_baseline(t.churn_labels, _features(t)), "baseline"))


def _log(t):
    return t.once("log", lambda: materialize_once(mo.build_inference_log(t.churn_labels, _features(t)), "log"))


def _drift(t):
    return dr.drift(_log(t), _baseline(t), "inference_timestamp", NUMERIC, CATEGORICAL)


def _compared(t):
    return t.once("compared", lambda: dr.compare(_windowed(t), _baseline(t), NUMERIC, CATEGORICAL))


def _numeric_only(t):
    return dr.numeric_distances(_compared(t))


def _binned_only(t):
    return dr.distribution_distances(_compared(t))


def _windowed(t):
    return _log(t).withColumn("window", pf.window_start("inference_timestamp"))


# ---- baseline and windows -------------------------------------------------------------

_LOG_COLUMNS = ("customer_id", "contract_type", "tenure_months", "monthly_charges", "total_charges",
                "prediction", "churn_label", "inference_timestamp", "model_id")
_LOG_SQL = ", ".join(_LOG_COLUMNS) + ", round(avg_price_increase,6) as avg_price_increase, " \
    "round(churn_probability,6) as churn_probability"


def _show_log(df):
    return df.select(*_LOG_COLUMNS, F.round("avg_price_increase", 6).alias("avg_price_increase"),
                     F.round("churn_probability", 6).alias("churn_probability"))


@query("baseline_build", f"select {_LOG_SQL} from baseline_rows")
def baseline_build(t):
    return _show_log(_baseline(t))


@query("window_union", f"select {_LOG_SQL} from inference_log")
def window_union(t):
    return _show_log(_log(t))


@query("union_all_windows", """select inference_timestamp, count(*) as n,
 sum(cast(round(monthly_charges*100) as bigint))::bigint as cents, sum(tenure_months)::bigint as months
 from inference_log group by 1""")
def union_all_windows(t):
    return _log(t).groupBy("inference_timestamp").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("monthly_charges") * 100).cast("bigint")).alias("cents"),
        F.sum("tenure_months").alias("months"))


@query("drift_simulate", """select customer_id, monthly_charges, total_charges, tenure_months, contract_type,
 round(avg_price_increase,6) as avg_price_increase from drifted""")
def drift_simulate(t):
    moved = mo.simulate_drift(mo.labelled_split(t.churn_labels, _features(t), "test"))
    return moved.select("customer_id", "monthly_charges", "total_charges", "tenure_months", "contract_type",
                        F.round("avg_price_increase", 6).alias("avg_price_increase"))


@query("class_summary", """select prediction, count(*) as n, round(avg(monthly_charges),4) as avg_monthly,
 round(avg(tenure_months),4) as avg_tenure from baseline_rows group by prediction""")
def class_summary(t):
    return _baseline(t).groupBy("prediction").agg(
        F.count("*").alias("n"), F.round(F.avg("monthly_charges"), 4).alias("avg_monthly"),
        F.round(F.avg("tenure_months"), 4).alias("avg_tenure"))


@query("window_manifest", """select inference_timestamp, count(*) as rows,
 round(100e0*avg(prediction),6) as pct_predicted_churn, count(churn_label) as labeled_rows
 from inference_log group by 1""")
def window_manifest(t):
    return mo.window_manifest(_log(t)).withColumn("pct_predicted_churn", F.round("pct_predicted_churn", 6))


# ---- profile --------------------------------------------------------------------------

def _stat_sql(source, window, numeric):
    """One row of statistics per column and window, as DuckDB computes them."""
    group = "group by 1" if window == _W else ""
    numbers = " union all ".join(
        f"""select {window} as "window", '{c}' as column_name, count({c}) as count,
 round(100e0*sum(({c} is null)::int)/count(*),6) as percent_nulls,
 round(100e0*sum(({c} = 0)::int)/count(*),6) as percent_zeros, round(avg({c}),4) as avg,
 round(stddev_samp({c}),4) as stddev, round(min({c}::double),6) as min, round(max({c}::double),6) as max,
 count(distinct {c}) as distinct_count, round(quantile_cont({c}::double,0.25),6) as p25,
 round(quantile_cont({c}::double,0.5),6) as median, round(quantile_cont({c}::double,0.75),6) as p75
 from {source} {group}""" for c in numeric)
    texts = " union all ".join(
        f"""select {window}, '{c}', count({c}), round(100e0*sum(({c} is null)::int)/count(*),6), null, null, null, null,
 null, count(distinct {c}), null, null, null from {source} {group}""" for c in TEXTS)
    return f"{numbers} union all {texts}"


_ALL_NUMERIC = (*NUMERIC, "prediction", "churn_label")
_STATS = {"percent_nulls": 6, "percent_zeros": 6, "avg": 4, "stddev": 4, "min": 6, "max": 6,
          "p25": 6, "median": 6, "p75": 6}


def _round_stats(df):
    return df.select("window", "column_name", "count", "distinct_count",
                     *[F.round(c, d).alias(c) for c, d in _STATS.items()])


@query("column_profile", _stat_sql("inference_log", _W, _ALL_NUMERIC))
def column_profile(t):
    return _round_stats(pf.column_profile(_windowed(t), ["window"], _ALL_NUMERIC, TEXTS))


@query("custom_metric", f"""select {_W} as "window", round(100e0*sum(case when prediction=1 then 1 else 0 end)/count(*),6)
 as high_risk_percentage from inference_log group by 1""")
def custom_metric(t):
    return pf.custom_metrics(
        _windowed(t), ["window"], {"high_risk_percentage": mo.HIGH_RISK}, {"prediction_col": "prediction"}
    ).withColumn("high_risk_percentage", F.round("high_risk_percentage", 6))


@query("udf_template_metric", f"""select {_W} as "window",
 round(sum(case when churn_label=1 and prediction=0 then 1e0 else 0e0 end)/count(*),6) as missed_share,
 round(avg(case when prediction=1 then monthly_charges else 0e0 end),4) as charge_at_risk
 from inference_log group by 1""")
def udf_template_metric(t):
    templates = {
        "missed_share": "sum(case when {{label_col}} = 1 and {{prediction_col}} = 0 then 1.0D else 0.0D end) / count(*)",
        "charge_at_risk": "avg(case when {{prediction_col}} = 1 then monthly_charges else 0.0D end)",
    }
    out = pf.custom_metrics(_windowed(t), ["window"], templates,
                            {"prediction_col": "prediction", "label_col": "churn_label"})
    return out.select("window", F.round("missed_share", 6).alias("missed_share"),
                      F.round("charge_at_risk", 4).alias("charge_at_risk"))


@query("filter_null_tests", f"""select {_W} as "window", count(*) filter (where inference_timestamp is not null
 and churn_label is not null) as usable, count(*) filter (where avg_resolution_hours is null) as unknown_hours
 from inference_log group by 1""")
def filter_null_tests(t):
    return _windowed(t).filter(F.col("window").isNotNull()).groupBy("window").agg(
        F.count(F.when(F.col("inference_timestamp").isNotNull() & F.col("churn_label").isNotNull(), 1)).alias("usable"),
        F.count(F.when(F.col("avg_resolution_hours").isNull(), 1)).alias("unknown_hours"))


# ---- drift ----------------------------------------------------------------------------

@query("baseline_join", """select "window", column_name, bin, nb, nw from drift_bins""")
def baseline_join(t):
    return dr.joined_bins(_compared(t)).select("window", "column_name", "bin", "nb", "nw")


@query("drift_ks", 'select "window", column_name, round(ks,6) as ks_statistic from ks_w1')
def drift_ks(t):
    return _numeric_only(t).select(
        "window", "column_name", F.round("ks_test.statistic", 6).alias("ks_statistic"))


@query("drift_ks_pvalue", 'select "window", column_name, round(pvalue,6) as ks_pvalue from ks_p')
def drift_ks_pvalue(t):
    return _numeric_only(t).select(
        "window", "column_name", F.round("ks_test.pvalue", 6).alias("ks_pvalue"))


# erf(sqrt(chi2 / 2)) by its series of positive terms; with it the tails of one and three degrees have closed forms.
_ERF = """(2/sqrt(pi()) * exp(-chi2/2) * list_sum(list_transform(range(0, 120),
 lambda n: pow(2e0, n) * pow(sqrt(chi2/2), 2*n+1) / list_product(list_transform(range(0, n+1), lambda k: 2e0*k+1)))))"""


@query("drift_chi2", f"""select "window", column_name, round(chi2,6) as chi2_statistic, degrees,
 round(case degrees when 2 then exp(-chi2/2) when 4 then exp(-chi2/2) * (1 + chi2/2)
  else greatest(1 - {_ERF} + (case degrees when 3 then sqrt(2*chi2/pi()) * exp(-chi2/2) else 0 end), 0) end, 6) as chi2_pvalue
 from distances where kind='categorical' and degrees between 1 and 4""")
def drift_chi2(t):
    tested = _binned_only(t).filter("chi_squared_test is not null")
    return tested.select(
        "window", "column_name", F.round("chi_squared_test.statistic", 6).alias("chi2_statistic"), "degrees",
        F.round("chi_squared_test.pvalue", 6).alias("chi2_pvalue"))


@query("drift_psi", 'select "window", column_name, round(psi,6) as psi from distances')
def drift_psi(t):
    return _binned_only(t).select("window", "column_name", F.round("population_stability_index", 6).alias("psi"))


@query("drift_wasserstein", 'select "window", column_name, round(w1,5) as wasserstein from ks_w1')
def drift_wasserstein(t):
    return _numeric_only(t).select(
        "window", "column_name", F.round("wasserstein_distance", 5).alias("wasserstein"))


@query("drift_js", 'select "window", column_name, round(js,6) as js_distance from distances')
def drift_js(t):
    return _binned_only(t).select("window", "column_name", F.round("js_distance", 6).alias("js_distance"))


@query("drift_tv", """select "window", column_name, round(tv,6) as tv_distance, round(max_bin,6) as max_bin_diff
 from distances""")
def drift_tv(t):
    return _binned_only(t).select("window", "column_name", F.round("tv_distance", 6).alias("tv_distance"),
                            F.round("max_bin_diff", 6).alias("max_bin_diff"))


_STATUS_SQL = """case when psi > 0.2 then 'MAJOR DRIFT' when psi > 0.1 then 'MODERATE DRIFT'
 when significant then 'SIGNIFICANT' else 'STABLE' end"""


@query("drift_status", f"""select "window", column_name, round(psi,6) as psi, round(coalesce(w1,0),5) as wasserstein,
 round(js,6) as js_distance, {_STATUS_SQL} as drift_status from drift_facts""")
def drift_status(t):
    return dr.drift_status(_drift(t)).select(
        "window", "column_name", F.round("psi", 6).alias("psi"),
        F.round(F.coalesce("wasserstein_distance", F.lit(0.0)), 5).alias("wasserstein"),
        F.round("js_distance", 6).alias("js_distance"), "drift_status")


@query("drift_rank", """select column_name, round(max(psi),6) as max_psi,
 (row_number() over (order by round(max(psi),6) desc, column_name))::int as place from drift_facts group by column_name""")
def drift_rank(t):
    from pyspark.sql import Window

    worst = dr.drift_rank(_drift(t)).groupBy("column_name").agg(F.round(F.max("psi"), 6).alias("max_psi"))
    return worst.withColumn("place", F.row_number().over(Window.orderBy(F.desc("max_psi"), "column_name")))


_ALERT_SQL = """case when psi > 0.2 then 'severe: the distribution has moved far'
 when psi > 0.1 then 'watch: the distribution is moving' else 'note: a test tells the samples apart' end"""


@query("drift_alerts", f"""select "window", column_name, round(psi,6) as psi, {_ALERT_SQL} as status
 from drift_facts where psi > 0.1 or significant""")
def drift_alerts(t):
    return dr.drift_alerts(_drift(t)).select("window", "column_name", F.round("psi", 6).alias("psi"), "status")


@query("filter_or_threshold", """select column_name, count(*) as windows from drift_facts
 where coalesce(psi,0) > 0.1 or significant group by column_name""")
def filter_or_threshold(t):
    return dr.drift_alerts(_drift(t)).groupBy("column_name").agg(F.count("*").alias("windows"))


@query("struct_field", """select "window", column_name, round(coalesce(ks, chi2),6) as statistic from drift_facts""")
def struct_field(t):
    return _drift(t).select("window", "column_name", F.round(
        F.coalesce("ks_test.statistic", "chi_squared_test.statistic"), 6).alias("statistic"))


@query("fn_coalesce", """select "window", column_name, round(coalesce(w1, -1),5) as wasserstein,
 round(coalesce(chi2, ks, 0),6) as statistic from drift_facts""")
def fn_coalesce(t):
    return _drift(t).select(
        "window", "column_name", F.round(F.coalesce("wasserstein_distance", F.lit(-1.0)), 5).alias("wasserstein"),
        F.round(F.coalesce("chi_squared_test.statistic", "ks_test.statistic", F.lit(0.0)), 6).alias("statistic"))


_SLICED = ("contract_type", "senior_citizen")
_PER_SLICE = " union all ".join(
    f"""select '{k}' as slice_key, {k}::varchar as slice_value, w as "window", '{c}' as column_name, v, sum(nb)::bigint as nb, sum(nw)::bigint as nw from (
 select b.{k}, l."window" as w, {c}::varchar as v, 1 as nb, 0 as nw from baseline_rows b, log_windows l
 union all select {k}, {_W}, {c}::varchar, 0, 1 from inference_log) group by all"""
    for k in _SLICED for c in ("internet_service", "prediction"))


@query("drift_slices", f"""with s as ({_PER_SLICE}),
 p as (select *, nb::double/sum(nb) over g as q, nw::double/sum(nw) over g as p from s
  window g as (partition by slice_key, slice_value, "window", column_name))
 select "window", slice_key, slice_value, column_name, 'churn_model' as model_id, '1 month' as granularity, round(sum(abs(p-q))/2, 6) as tv_distance,
 round(max(abs(p-q)), 6) as max_bin_diff, round(sum((greatest(p,1e-4)-greatest(q,1e-4))*ln(greatest(p,1e-4)/greatest(q,1e-4))), 6) as psi,
 count(*)-1 as degrees from p group by slice_key, slice_value, "window", column_name""")
def drift_slices(t):
    """Drift of two columns for each contract type and age group, and the model it belongs to."""
    moved = dr.drift(_log(t), _baseline(t), "inference_timestamp", (), ("internet_service", "prediction"), slices=_SLICED, model_id="model_id")
    return moved.filter("slice_key is not null").select(
        "window", "slice_key", "slice_value", "column_name", "model_id", "granularity", F.round("tv_distance", 6).alias("tv_distance"),
        F.round("max_bin_diff", 6).alias("max_bin_diff"), F.round("population_stability_index", 6).alias("psi"), "degrees")


# ---- quality --------------------------------------------------------------------------

VIEWS["confusion"] = f"""select {_W} as "window", count(*) filter (where churn_label=1 and prediction=1)::double as tp,
 count(*) filter (where churn_label=0 and prediction=1)::double as fp,
 count(*) filter (where churn_label=1 and prediction=0)::double as fn,
 count(*) filter (where churn_label=0 and prediction=0)::double as tn,
 avg(-ln(case when churn_label=1 then churn_probability else 1e0-churn_probability end)) as log_loss
 from inference_log group by 1"""
VIEWS["class_scores"] = """select *, case when tp+fp>0 then tp/(tp+fp) else 0 end as p1,
 case when tp+fn>0 then tp/(tp+fn) else 0 end as r1, case when tn+fn>0 then tn/(tn+fn) else 0 end as p0,
 case when tn+fp>0 then tn/(tn+fp) else 0 end as r0, 2*tp/(2*tp+fp+fn) as f1, 2*tn/(2*tn+fp+fn) as f0,
 tp+fp+fn+tn as n from confusion"""
VIEWS["auc"] = f"""select "window", sum(pos*(cneg - neg/2e0))/(max(tp)*max(tn)) as roc_auc from (
 select *, sum(neg) over (partition by "window" order by s rows unbounded preceding) as cneg,
 sum(pos) over (partition by "window") as tp, sum(neg) over (partition by "window") as tn from (
 select {_W} as "window", churn_probability as s, sum(churn_label) as pos, sum(1-churn_label) as neg
 from inference_log group by 1,2)) group by 1"""


@query("confusion_matrix", f"""select w."window", l.label, p.prediction, count(i.customer_id) as n from log_windows w
 cross join (values (0e0),(1e0)) l(label) cross join (values (0e0),(1e0)) p(prediction)
 left join inference_log i on i.churn_label=l.label and i.prediction=p.prediction and {_W}=w."window" group by all""")
def confusion_matrix(t):
    return ql.confusion_matrix(_windowed(t), "churn_label", "prediction", ["window"])


@query("classification_quality", """select "window", n::bigint as labeled_rows, round((tp+tn)/n,6) as accuracy,
 round(p1,6) as precision_positive, round(r1,6) as recall_positive, round(f1,6) as f1_positive,
 round((p1+p0)/2,6) as precision_macro, round((r1+r0)/2,6) as recall_macro, round((f1+f0)/2,6) as f1_macro,
 round((f1*(tp+fn)+f0*(tn+fp))/n,6) as f1_weighted, round(log_loss,6) as log_loss, round(roc_auc,6) as roc_auc
 from class_scores join auc using ("window")""")
def classification_quality(t):
    q = ql.quality(_windowed(t), "churn_label", "prediction", "churn_probability", ["window"])
    return q.select("window", "labeled_rows", *[F.round(c, 6).alias(a) for c, a in (
        ("accuracy_score", "accuracy"), ("precision_positive", "precision_positive"),
        ("recall_positive", "recall_positive"), ("f1_positive", "f1_positive"),
        ("precision.macro", "precision_macro"), ("recall.macro", "recall_macro"), ("f1_score.macro", "f1_macro"),
        ("f1_score.weighted", "f1_weighted"), ("log_loss", "log_loss"), ("roc_auc", "roc_auc"))])


@query("schema_adaptive_select", """select "window", round((p1*(tp+fn)+p0*(tn+fp))/n,6) as precision,
 round((r1*(tp+fn)+r0*(tn+fp))/n,6) as recall, round((f1*(tp+fn)+f0*(tn+fp))/n,6) as f1_score from class_scores""")
def schema_adaptive_select(t):
    q = ql.quality(_windowed(t), "churn_label", "prediction", None, ["window"])
    flat = ql.unwrap_averages(q)
    return flat.select("window", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")])


@query("roc_auc", 'select "window", round(roc_auc,6) as roc_auc from auc')
def roc_auc(t):
    return ql.roc_auc(_windowed(t), "churn_label", "churn_probability", ["window"]).withColumn(
        "roc_auc", F.round("roc_auc", 6))


@query("roc_curve", """select round(s,6) as threshold, round(cn/tn,6) as fpr, round(cp/tp,6) as tpr from (
 select s, sum(neg) over (order by s desc rows unbounded preceding) as cn,
 sum(pos) over (order by s desc rows unbounded preceding) as cp, sum(neg) over () as tn, sum(pos) over () as tp
 from (select churn_probability as s, sum(churn_label) as pos, sum(1-churn_label) as neg
 from baseline_rows group by 1))""")
def roc_curve(t):
    points = ql.roc_curve(_baseline(t), "churn_label", "churn_probability")
    return points.select(*[F.round(c, 6).alias(c) for c in ("threshold", "fpr", "tpr")])


# ---- the whole monitor ----------------------------------------------------------------

VIEWS["log_stats"] = _stat_sql("inference_log", _W, _ALL_NUMERIC)
VIEWS["base_stats"] = _stat_sql("baseline_rows", "null::timestamp", _ALL_NUMERIC)
_RISK_SHARE = "round(100e0*sum(case when prediction=1 then 1 else 0 end)/count(*),6)"
_HITS = "round(sum(case when prediction=churn_label then 1e0 else 0e0 end)/count(*),6) as accuracy"


def _refresh_sql(log_type, stats, source, window):
    group = "group by 2" if window == _W else ""
    return f"""select '{log_type}' as log_type, s."window", s.column_name, s.count, s.avg, s.median, s.distinct_count,
 null::double as high_risk_percentage, case when s.column_name='prediction' then a.accuracy end as accuracy
 from {stats} s left join (select 1 as one, {window} as w, {_HITS} from {source} {group}) a
 on a.w is not distinct from s."window"
 union all select '{log_type}', {window}, ':table', count(*), null, null, null, {_RISK_SHARE}, null from {source} {group}"""


@query("monitor_refresh", _refresh_sql("INPUT", "log_stats", "inference_log", _W) + " union all "
       + _refresh_sql("BASELINE", "base_stats", "baseline_rows", "null::timestamp"))
def monitor_refresh(t):
    metrics, _ = mo.monitor_refresh(_log(t), _baseline(t))
    return metrics.select(
        "log_type", "window", "column_name", "count", F.round("avg", 4).alias("avg"),
        F.round("median", 6).alias("median"), "distinct_count",
        F.round("high_risk_percentage", 6).alias("high_risk_percentage"),
        F.round("accuracy_score", 6).alias("accuracy"))


@query("monitor_refresh_drift", """select "window", column_name, round(ks,6) as ks, round(pvalue,6) as ks_pvalue,
 round(chi2,6) as chi2, round(w1,5) as wasserstein, round(psi,6) as psi, round(js,6) as js_distance,
 round(tv,6) as tv_distance, round(max_bin,6) as max_bin_diff from drift_facts""")
def monitor_refresh_drift(t):
    _, moved = mo.monitor_refresh(_log(t), _baseline(t))
    return moved.select("window", "column_name", *[F.round(c, d).alias(a) for c, d, a in (
        ("ks_test.statistic", 6, "ks"), ("ks_test.pvalue", 6, "ks_pvalue"), ("chi_squared_test.statistic", 6, "chi2"),
        ("wasserstein_distance", 5, "wasserstein"), ("population_stability_index", 6, "psi"),
        ("js_distance", 6, "js_distance"), ("tv_distance", 6, "tv_distance"), ("max_bin_diff", 6, "max_bin_diff"))])


@query("standin_score", "select customer_id, round(churn_probability,6) as churn_probability, prediction from scored")
def standin(t):
    return standin_score(t.customers).select(
        "customer_id", F.round("churn_probability", 6).alias("churn_probability"), "prediction")
