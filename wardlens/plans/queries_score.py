"""Registered queries over a score: metrics, calibration, bedside score, records, explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import explain, metrics, ordered, scoring, summaries
from .fixed_score import FIXED_BETA, RAW_SCORE_SQL, SCORE_SQL, with_fixed_score
from .oracle_ctes import linear_quantile, r6, with_ctes
from .queries_clean import _hist_oracle
from .queries_extract import rounded
from .registry import matrix_a, register

SCORED = {
    "scored": f"select icustay_id, adverse_event, {SCORE_SQL} score from matrix_a",
    "points": """select score, n, pos, tn_n - pos_all neg_all, pos_all, tn_n,
      sum(n) over (order by score desc) flagged, sum(pos) over (order by score desc) hits,
      sum(n - pos) over (order by score) - (n - pos) neg_below
      from (select score, count(*) n, sum(adverse_event) pos from scored group by score),
           (select count(*) tn_n, sum(adverse_event) pos_all from scored)""",
    "ranked": """select *, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2e0 r,
      count(*) over () n_all from scored""",
    "deciled": "select *, cast(floor(r * 10 / (n_all + 1)) as bigint) prob_decile from ranked",
}


def scored(spark, sf):
    return with_fixed_score(matrix_a(spark, sf)).select("icustay_id", "adverse_event", "score")


def _totals(spark, sf):
    return metrics.score_totals(scored(spark, sf))


@register("fixed_score", with_ctes("select * from scored", SCORED))
def fixed_score(spark, sf):
    return scored(spark, sf)


# --- ranking metrics ---------------------------------------------------------------
_AUC = "sum(pos * (neg_below + (n - pos) / 2e0)) / (max(pos_all) * max(neg_all))"
_AP = "sum(pos / pos_all * (hits / flagged))"


@register(
    "auc_and_average_precision",
    with_ctes(f"select cast(max(tn_n) as bigint) n, cast(max(pos_all) as bigint) n_pos, {r6(_AUC)} roc_auc, {r6(_AP)} avg_precision from points", SCORED),
)
def auc_and_average_precision(spark, sf):
    return rounded(metrics.ranking_metrics(_totals(spark, sf)))


@register(
    "roc_points",
    with_ctes(
        f"""select score threshold, cast(hits as bigint) tp, cast(flagged - hits as bigint) fp, {r6('hits / pos_all')} tpr,
        {r6('(flagged - hits) / neg_all')} fpr from points union all select null, 0, 0, 0e0, 0e0""", SCORED),
)
def roc_points(spark, sf):
    return rounded(metrics.roc_points(_totals(spark, sf)))


@register(
    "bending_roc_points",
    with_ctes(
        f"""select score threshold, cast(hits as bigint) tp, cast(flagged - hits as bigint) fp, {r6('hits / pos_all')} tpr, {r6('(flagged - hits) / neg_all')} fpr from (
          select *, lag(hits) over (order by score desc) h, lag(flagged) over (order by score desc) g,
            lead(hits) over (order by score desc) h2, lead(flagged) over (order by score desc) g2 from points)
        where h is null or h2 is null or hits - h <> h2 - hits or flagged - g <> g2 - flagged
        union all select null, 0, 0, 0e0, 0e0""", SCORED),
)
def bending_roc_points(spark, sf):
    """The ROC curve without points on straight stretches."""
    return rounded(metrics.bending_roc_points(_totals(spark, sf)))


@register(
    "pr_points",
    with_ctes(
        f"""select score threshold, {r6('hits / flagged')} "precision", {r6('hits / pos_all')} recall from points
        union all select null, 1e0, 0e0""", SCORED),
)
def pr_points(spark, sf):
    return rounded(metrics.pr_points(_totals(spark, sf)))


@register(
    "youden",
    with_ctes(
        f"""select score threshold, {r6('hits / pos_all')} tpr, {r6('(flagged - hits) / neg_all')} fpr,
        {r6('hits / pos_all - (flagged - hits) / neg_all')} youden_j from points
        order by hits * neg_all - (flagged - hits) * pos_all desc, score desc limit 1""", SCORED),
)
def youden(spark, sf):
    return rounded(metrics.youden_threshold(_totals(spark, sf)))


@register(
    "concordance",
    with_ctes(
        f"""select {r6('p')} pairs, {r6('100 * conc / p')} percent_concordant, {r6('100 * disc / p')} percent_discordant,
        {r6('100 * tied / p')} percent_tied, {r6('(conc - disc) / p')} somers_d, {r6('(conc - disc) / (conc + disc)')} gamma,
        {r6('(conc - disc) / (0.5e0 * n * (n - 1))')} tau_a, {r6('(conc + 0.5e0 * tied) / p')} c
        from (select p, conc, tied, p - conc - tied disc, n from (
          select cast(max(pos_all) * max(neg_all) as double) p, cast(sum(pos * neg_below) as double) conc,
                 cast(sum(pos * (n - pos)) as double) tied, cast(max(tn_n) as double) n from points))""", SCORED),
)
def concordance(spark, sf):
    return rounded(metrics.concordance(_totals(spark, sf)))


# --- threshold metrics ------------------------------------------------------------------
_COUNTS = {
    **SCORED,
    "counts": """select count(*) filter (score >= 0.5e0 and adverse_event = 1) tp, count(*) filter (score >= 0.5e0 and adverse_event = 0) fp,
      count(*) filter (score < 0.5e0 and adverse_event = 1) fn, count(*) filter (score < 0.5e0 and adverse_event = 0) tn from scored""",
}


def _q(top: str, bottom: str) -> str:
    return r6(f"coalesce(({top}) / nullif({bottom}, 0), 0)")


@register(
    "confusion",
    with_ctes(f"""select *, {_q('tp', 'tp + fn')} sensitivity, {_q('tn', 'tn + fp')} specificity, {_q('tp', 'tp + fp')} ppv,
      {_q('tn', 'tn + fn')} npv, tp + fp + fn + tn n_patients, tp + fn n_adverse from counts""", _COUNTS),
)
def confusion(spark, sf):
    return rounded(metrics.confusion(scored(spark, sf), 0.5))


_P0, _R0, _F0 = "coalesce(tn / nullif(tn+fn, 0), 0)", "coalesce(tn / nullif(tn+fp, 0), 0)", "coalesce(2*tn / nullif(2*tn+fn+fp, 0), 0)"
_P1, _R1, _F1 = "coalesce(tp / nullif(tp+fp, 0), 0)", "coalesce(tp / nullif(tp+fn, 0), 0)", "coalesce(2*tp / nullif(2*tp+fn+fp, 0), 0)"
_S0, _S1, _N = "(tn+fp)", "(tp+fn)", "(tp+tn+fp+fn)"


def _avg(a: str, b: str) -> str:
    return f"({a} + {b}) / 2"


def _wavg(a: str, b: str) -> str:
    return f"({a} * {_S0} + {b} * {_S1}) / {_N}"


_REPORT = [
    ("0", _P0, _R0, _F0, _S0), ("1", _P1, _R1, _F1, _S1), ("accuracy", *[f"(tp+tn) / {_N}"] * 3, _N),
    ("macro avg", _avg(_P0, _P1), _avg(_R0, _R1), _avg(_F0, _F1), _N),
    ("weighted avg", _wavg(_P0, _P1), _wavg(_R0, _R1), _wavg(_F0, _F1), _N),
]


@register(
    "class_report",
    with_ctes(" union all ".join(
        f"""select '{n}' "class", {r6(p)} "precision", {r6(r)} recall, {r6(f)} f1_score, {s} support from counts"""
        for n, p, r, f, s in _REPORT), _COUNTS),
)
def class_report(spark, sf):
    return rounded(metrics.class_report(metrics.confusion(scored(spark, sf), 0.5)))


# --- ranks and calibration ------------------------------------------------------------------
@register(
    "average_ranks",
    with_ctes("select score, count(*) n, any_value(r) avg_rank from ranked group by score", SCORED),
)
def average_ranks(spark, sf):
    return ordered.average_ranks(scored(spark, sf), "score").select("score", "n", "avg_rank")


@register("rank_groups", with_ctes("select icustay_id, score, prob_decile from deciled", SCORED))
def rank_groups(spark, sf):
    return ordered.with_rank_group(scored(spark, sf), "score", 10, "prob_decile").select("icustay_id", "score", "prob_decile")


_EDGES = ", ".join(linear_quantile("score", 10 * i) + f" e{i}" for i in range(1, 10))
_BIN = " + ".join(f"cast(e{i} < score as bigint)" for i in range(1, 10))


@register(
    "calibration_quantile",
    with_ctes(f"""select {_BIN} bin, count(*) n, {r6('avg(score)')} mean_score, {r6('avg(adverse_event)')} observed_rate
      from scored, edges group by 1""", {**SCORED, "edges": f"select {_EDGES} from scored"}),
)
def calibration_quantile(spark, sf):
    return rounded(metrics.calibration_by_quantile(scored(spark, sf)))


@register(
    "calibration_decile",
    with_ctes(f"""select prob_decile, cast(1 - grouping(prob_decile) as bigint) row_type, count(*) n_patients,
      {r6('avg(score)')} mean_pred, {r6('avg(adverse_event)')} mean_obs from deciled group by rollup (prob_decile)""", SCORED),
)
def calibration_decile(spark, sf):
    return rounded(metrics.calibration_by_decile(scored(spark, sf)))


@register(
    "hosmer_lemeshow",
    with_ctes(f"""select count(*) n_groups, {r6('sum((o - e) * (o - e) / (e * (1 - e / n)))')} chi_square, count(*) - 2 df
      from (select prob_decile, count(*) n, sum(adverse_event) o, sum(score) e from deciled group by prob_decile)""", SCORED),
)
def hosmer_lemeshow(spark, sf):
    return rounded(metrics.hosmer_lemeshow(scored(spark, sf)))


# --- histograms of the score --------------------------------------------------------------------
@register("hist_score_by_label", _hist_oracle(["score"], "scored", 40, "adverse_event", extra=SCORED))
def hist_score_by_label(spark, sf):
    return rounded(summaries.histogram(scored(spark, sf), ["score"], 40, ["adverse_event"]))


_CATEGORY = "case when p < 0.20e0 then 'Low' when p < 0.40e0 then 'Moderate' when p < 0.65e0 then 'High' else 'Critical' end"
_MESSAGE = "case " + " ".join(
    f"when {_CATEGORY} = '{c}' then '{m}'" for c, m in fv.RISK_MESSAGES.items()
) + " end"
# half to even at four digits, written out on the decimal value
_EVEN = """cast(case when abs(d * 10000 - trunc(d * 10000)) = 0.5
  then trunc(d * 10000 / 2 + 0.25) * 2 else round(d * 10000) end as double) / 10000e0"""
_RECORDS = {
    "probs": f"select icustay_id, adverse_event, p, cast(p as decimal(24,17)) d from (select *, {RAW_SCORE_SQL} p from matrix_a)",
    "records": f"""select icustay_id, {_EVEN} risk_score, {_CATEGORY} risk_category,
      cast(p >= 0.4e0 as bigint) adverse_event_flag, 0.4e0::double threshold_used, {_MESSAGE} clinical_message from probs""",
}


def _records(spark, sf):
    p = with_fixed_score(matrix_a(spark, sf), digits=None)
    return scoring.risk_records(p, 0.4, "score").select(
        "icustay_id", "risk_score", "risk_category", "adverse_event_flag", "threshold_used", "clinical_message"
    )


@register("risk_records", with_ctes("select * from records", _RECORDS))
def risk_records(spark, sf):
    return _records(spark, sf)


@register(
    "batch_summary",
    with_ctes(f"""select count(*) n_patients, count(*) filter (adverse_event_flag = 1) n_high_risk,
      {r6('avg(adverse_event_flag)')} high_risk_share, {r6('avg(risk_score)')} mean_risk_score from records""", _RECORDS),
)
def batch_summary(spark, sf):
    return rounded(summaries.batch_summary(_records(spark, sf)))


@register("hist_score_by_category", _hist_oracle(["risk_score"], "records", 20, "risk_category", True, _RECORDS))
def hist_score_by_category(spark, sf):
    return rounded(summaries.histogram(_records(spark, sf), ["risk_score"], 20, ["risk_category"], common_range=True))


@register(
    "category_counts",
    with_ctes(f"""select risk_category, count(*) n, {r6('100e0 * count(*) / sum(count(*)) over ()')} "percent" from records group by 1""", _RECORDS),
)
def category_counts(spark, sf):
    return rounded(summaries.frequency(_records(spark, sf), "risk_category"))


@register(
    "display_columns",
    with_ctes(f"""select risk_score "Risk Score", risk_category "Category",
      case when adverse_event_flag = 1 then '{fv.FLAG_YES}' else '{fv.FLAG_NO}' end "High Risk" from records""", _RECORDS),
)
def display_columns(spark, sf):
    return scoring.display_columns(_records(spark, sf))


# --- validation ---------------------------------------------------------------------------------------
def _bad(name: str) -> str:
    low, inclusive, high = fv.RECORD_BOUNDS[name]
    test = f"{name} is null or {name} {'<' if inclusive else '<='} {low}"
    return test + (f" or {name} > {high}" if high is not None else "")


_REASON = "concat_ws(',', " + ", ".join(f"case when {_bad(c)} then '{c}' end" for c in fv.RECORD_BOUNDS) + ")"


@register(
    "validate_accepted",
    with_ctes(f"select icustay_id, {', '.join(f'cast({c} as double) {c}' for c in fv.BASE_FEATURES)} from matrix_a where {_REASON} = ''"),
)
def validate_accepted(spark, sf):
    accepted, _ = scoring.validate_records(matrix_a(spark, sf))
    return accepted.select("icustay_id", *[F.col(c).cast("double").alias(c) for c in fv.BASE_FEATURES])


@register("validate_rejected", with_ctes(f"select icustay_id, {_REASON} reasons from matrix_a where {_REASON} <> ''"))
def validate_rejected(spark, sf):
    _, rejected = scoring.validate_records(matrix_a(spark, sf))
    return rejected.select("icustay_id", F.concat_ws(",", "reasons").alias("reasons"))


# --- bedside score -----------------------------------------------------------------------------------------
_BEDSIDE = {
    "parts": """select icustay_id, adverse_event,
      case when age < 45 then 0 when age < 65 then 1 when age < 80 then 2 else 3 end age_score,
      case when coalesce(heart_rate_mean, -1) < 60 then 2 when heart_rate_mean < 100 then 0 when heart_rate_mean < 130 then 1 else 3 end hr_score,
      case when coalesce(creatinine_max, -1) <= 1.2e0 then 0 when creatinine_max <= 2e0 then 1 when creatinine_max <= 5e0 then 2 else 3 end crea_score,
      case when wbc_mean between 4 and 12 then 0 when wbc_mean > 12 then 1 else 2 end wbc_score,
      case when drug_count < 5 then 0 when drug_count < 10 then 1 else 2 end drug_score,
      least(lab_abnormality_score, 3) lab_score from matrix_a""",
    "totalled": "select *, age_score + hr_score + crea_score + wbc_score + drug_score + lab_score ae_risk_score from parts",
    "bedside": """select *, case when ae_risk_score <= 3 then 'Low' when ae_risk_score <= 7 then 'Moderate'
      when ae_risk_score <= 11 then 'High' else 'Critical' end risk_category from totalled""",
}
_PART_NAMES = ["age_score", "hr_score", "crea_score", "wbc_score", "drug_score", "lab_score", "ae_risk_score"]


def _bedside(spark, sf):
    return scoring.bedside_score(matrix_a(spark, sf))


@register(
    "bedside_score",
    with_ctes("select icustay_id, " + ", ".join(f"cast({c} as bigint) {c}" for c in _PART_NAMES) + ", risk_category, adverse_event from bedside", _BEDSIDE),
)
def bedside_score(spark, sf):
    return _bedside(spark, sf).select("icustay_id", *_PART_NAMES, "risk_category", "adverse_event")


@register(
    "bedside_crosstab",
    with_ctes("""select risk_category, count(*) filter (adverse_event = 0) adverse_event_0,
      count(*) filter (adverse_event = 1) adverse_event_1 from bedside group by 1""", _BEDSIDE),
)
def bedside_crosstab(spark, sf):
    return summaries.cross_table(_bedside(spark, sf), "risk_category", "adverse_event", [0, 1])


@register(
    "bedside_rate_by_category",
    with_ctes(f"""select risk_category, cast(1 - grouping(risk_category) as bigint) row_type, count(adverse_event) n, {r6('avg(adverse_event)')} mean,
      {r6('stddev_samp(adverse_event)')} std from bedside group by rollup (risk_category)""", _BEDSIDE),
)
def bedside_rate_by_category(spark, sf):
    return rounded(summaries.class_means(_bedside(spark, sf), "risk_category", "adverse_event"))


# --- contributions of a linear score --------------------------------------------------------------------------
_MEANS = ", ".join(f"avg({c}) m_{c}" for c in FIXED_BETA)
_LONG_CONTRIB = " union all ".join(
    f"select icustay_id, '{c}' feature, {b}e0 * ({c} - m_{c}) contribution from matrix_a, means where {c} is not null"
    for c, b in FIXED_BETA.items()
)
_CONTRIB = {
    "means": f"select {_MEANS} from matrix_a",
    "contrib": _LONG_CONTRIB,
    "topped": """select *, row_number() over (partition by icustay_id
      order by abs(contribution) desc, feature) rn from contrib""",
    "worded": f"""select icustay_id, rn, feature, contribution,
      case when contribution > 0 then '{fv.DIRECTION_UP}' else '{fv.DIRECTION_DOWN}' end direction,
      case when abs(contribution) > 0.10e0 then 'high' when abs(contribution) > 0.02e0 then 'medium' else 'low' end magnitude
      from topped where rn <= 4""",
    "listed": f"""select icustay_id, rn, feature,
      case when contribution > 0 then '{fv.DIRECTION_UP}' else '{fv.DIRECTION_DOWN}' end direction,
      case when abs(contribution) > 0.10e0 then 'high' when abs(contribution) > 0.02e0 then 'medium' else 'low' end magnitude
      from topped where rn <= 8""",
}


def _contributions(spark, sf):
    return explain.linear_contributions(matrix_a(spark, sf), FIXED_BETA, ["icustay_id"])


@register("linear_contributions", with_ctes(f"select icustay_id, feature, {r6('contribution')} contribution from contrib", _CONTRIB))
def linear_contributions(spark, sf):
    long = _contributions(spark, sf).select("icustay_id", F.inline("contributions"))
    return rounded(long.filter(F.col("contribution").isNotNull()))


@register(
    "top_contributions",
    with_ctes(f"select icustay_id, rn as rank, feature, {r6('contribution')} contribution, direction, magnitude from worded", _CONTRIB),
)
def top_contributions(spark, sf):
    return rounded(explain.top_contributions(_contributions(spark, sf), ["icustay_id"], 4))


_BASE_VALUE = " + ".join(f"{b}e0 * m_{c}" for c, b in FIXED_BETA.items())
_ENTRY = "concat_ws(':', rn, feature, direction, magnitude)"


@register(
    "contribution_lists",
    with_ctes(f"""select m.icustay_id, {r6(f'-1.5e0 + {_BASE_VALUE}')} base_value, 'linear' as method,
      coalesce(string_agg(case when rn is not null then {_ENTRY} end, ';' order by rn), '') contributions
      from matrix_a m left join listed w on w.icustay_id = m.icustay_id, means group by all""", _CONTRIB),
)
def contribution_lists(spark, sf):
    """One explanation per stay: base value, method, and the ordered list as text."""
    found = explain.linear_explanations(matrix_a(spark, sf), FIXED_BETA, ["icustay_id"], 8, intercept=-1.5)
    entry = lambda e: F.concat_ws(":", e["rank"].cast("string"), e["feature"], e["direction"], e["magnitude"])
    return rounded(found.withColumn("contributions", F.array_join(F.transform("contributions", entry), ";")))


@register(
    "mean_absolute_contribution",
    with_ctes(f"select feature, {r6('avg(abs(contribution))')} importance from contrib group by feature", _CONTRIB),
)
def mean_absolute_contribution(spark, sf):
    return rounded(explain.mean_absolute(_contributions(spark, sf)))


_SENTENCE = """'This patient''s predicted risk of ' || printf('%.1f', 100 * risk_score) || '% is primarily driven by '''
  || feature || ''' which ' || direction || '.'"""


@register(
    "explanations",
    with_ctes(f"""select icustay_id, feature, regexp_replace(feature, '_', ' ', 'g') feature_words, {_SENTENCE} interpretation
      from worded join records using (icustay_id) where rn = 1""", {**_RECORDS, **_CONTRIB}),
)
def explanations(spark, sf):
    """The main driver of each score as a sentence; score and driver sit on one row."""
    p = with_fixed_score(matrix_a(spark, sf), digits=None)
    records = scoring.risk_records(p, 0.4, "score")
    entries = explain.linear_contributions(records, FIXED_BETA, ["icustay_id", "risk_score"])
    top = explain.top_contributions(entries, ["icustay_id", "risk_score"], 1)
    return top.select(
        "icustay_id",
        "feature",
        F.lower(scoring.feature_title(F.col("feature"))).alias("feature_words"),
        scoring.interpretation(F.col("risk_score"), F.col("feature"), F.col("direction")).alias("interpretation"),
    )


_IMPORTANCE = {"age": 0.3, "creatinine_max": 0.25, "length_of_stay": 0.2, "drug_count": 0.15, "gender": 0.1}
_IMP_ORDER = sorted(_IMPORTANCE, key=lambda c: -_IMPORTANCE[c])[:3]


@register(
    "importance_proxy",
    with_ctes(" union all ".join(
        f"""select icustay_id, cast({i} as bigint) as rank, '{c}' feature, {r6(f'{_IMPORTANCE[c]}e0 * coalesce({c}, 0)')} contribution,
        '{fv.DIRECTION_UP}' direction, '{'high' if _IMPORTANCE[c] > 0.2 else 'low'}' magnitude from matrix_a"""
        for i, c in enumerate(_IMP_ORDER, 1))),
)
def importance_proxy(spark, sf):
    return rounded(explain.importance_proxy(matrix_a(spark, sf), _IMPORTANCE, ["icustay_id"], 3))


# --- stacking of result tables -----------------------------------------------------------------------------------
@register(
    "stacked_tables",
    with_ctes(f"""select 'bedside' source, risk_category, count(*) n, cast(null as double) mean_risk_score from bedside group by 2
      union all select 'score' source, risk_category, count(*) n, {r6('avg(risk_score)')} mean_risk_score from records group by 2""",
              {**_BEDSIDE, **_RECORDS}),
)
def stacked_tables(spark, sf):
    """Two result tables one above the other, matched by column name."""
    a = _bedside(spark, sf).groupBy("risk_category").agg(F.count("*").alias("n")).withColumn("source", F.lit("bedside"))
    b = (
        _records(spark, sf)
        .groupBy("risk_category")
        .agg(F.count("*").alias("n"), F.avg("risk_score").alias("mean_risk_score"))
        .withColumn("source", F.lit("score"))
    )
    return rounded(a.unionByName(b, allowMissingColumns=True))


