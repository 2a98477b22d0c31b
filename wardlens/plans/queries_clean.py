"""Registered queries of the cleaning layer and the descriptive tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import cleaning, extract, features, sampling, summaries
from ..operators.ordered import quantile_table
from ..sources.materialize import materialize
from .oracle_ctes import averaged_quantile, describe_sql, linear_quantile, long_sql, r6, with_ctes
from .queries_extract import rounded
from .registry import matrix_a, register


def cleaned(spark, sf, policy="keep"):
    """The cleaned table later stages read, written once."""
    build = lambda: cleaning.clean(matrix_a(spark, sf), policy)
    return materialize(spark, f"cleaned_{policy}", sf, build)


def _with_copies(matrix):
    """The matrix plus exact and near copies: it has no duplicates of its own."""
    exact = matrix.filter(F.col("hadm_id") % 7 == 0)
    near = matrix.filter(F.col("hadm_id") % 11 == 0).withColumn("age", F.col("age") + 1)
    return matrix.unionByName(exact).unionByName(near)


# --- duplicates, ranges, fences ----------------------------------------------------------
@register("dedup_keep", with_ctes("select * exclude (rn) from numbered_dup where rn = 1"))
def dedup_keep(spark, sf):
    return cleaning.dedup_keep(_with_copies(matrix_a(spark, sf)))


@register("dedup_drop", with_ctes("select * exclude (rn) from numbered_dup where rn > 1"))
def dedup_drop(spark, sf):
    return cleaning.dedup_drop(_with_copies(matrix_a(spark, sf)))


@register("range_filter", with_ctes("select * from valid_a"))
def range_filter(spark, sf):
    return cleaning.valid_ranges_only(matrix_a(spark, sf))


_OUTSIDE = " union all ".join(
    f"select '{c}' feature, {lo!r}::double low, {hi!r}::double high, "
    f"count(*) filter ({c} < {lo!r} or {c} > {hi!r}) n_outside from matrix_a"
    for c, (lo, hi) in fv.CLINICAL_RANGES.items()
)


@register("range_report", with_ctes(_OUTSIDE))
def range_report(spark, sf):
    return summaries.range_report(matrix_a(spark, sf))


@register(
    "iqr_fences",
    with_ctes(f"""select feature, n, {r6('q1')} q1, {r6('q3')} q3, {r6('q3 - q1')} iqr,
      {r6('q1 - 3 * (q3 - q1)')} fence_low, {r6('q3 + 3 * (q3 - q1)')} fence_high from fences"""),
)
def iqr_fences(spark, sf):
    return rounded(cleaning.outlier_fences(cleaning.valid_ranges_only(matrix_a(spark, sf))))


@register("iqr_filter", with_ctes("select * from fenced_ref"))
def iqr_filter(spark, sf):
    return cleaning.drop_outliers(cleaning.valid_ranges_only(matrix_a(spark, sf)))


@register("iqr_filter_keep", with_ctes("select * from fenced_keep"))
def iqr_filter_keep(spark, sf):
    return cleaning.drop_outliers(cleaning.valid_ranges_only(matrix_a(spark, sf)), "keep")


# --- imputation, bands, caps ------------------------------------------------------------------
def _fenced(spark, sf):
    return cleaning.drop_outliers(cleaning.valid_ranges_only(matrix_a(spark, sf)), "keep")


@register("impute_rules", with_ctes("select * from imputed_keep"))
def impute_rules(spark, sf):
    return cleaning.impute_rules(_fenced(spark, sf))


@register(
    "strata_medians",
    with_ctes(
        " union all ".join(
            "select cast({v} as bigint) adverse_event, {cells}".format(
                v=v,
                cells=", ".join(
                    f"{r6(averaged_quantile(c, 50, 'fenced_keep', f'and adverse_event = {v}'))} {n}"
                    for c, n in fv.STRATA_MEDIANS.items()
                ),
            )
            for v in (0, 1)
        )
    ),
)
def strata_medians(spark, sf):
    return rounded(cleaning.strata_medians(_fenced(spark, sf)))


_BAND_COLUMNS = (
    "icustay_id, age_group, los_category, tachycardia, renal_impairment, leukocytosis, "
    f"{r6('clinical_risk_index')} clinical_risk_index, {r6('creatinine_zscore')} creatinine_zscore, hr_category"
)


@register("clinical_bands", with_ctes(f"select {_BAND_COLUMNS} from banded_keep"))
def clinical_bands(spark, sf):
    out = cleaning.clinical_columns(cleaning.impute_rules(_fenced(spark, sf)))
    return rounded(
        out.select(
            "icustay_id", "age_group", "los_category", "tachycardia", "renal_impairment", "leukocytosis",
            "clinical_risk_index", "creatinine_zscore", "hr_category",
        )
    )


_WINSOR = ", ".join(f"{r6(c)} {c}" for c in fv.WINSORIZE_PERCENT)


@register("winsorize", with_ctes(f"select icustay_id, {_WINSOR} from winsor_keep"))
def winsorize(spark, sf):
    out = cleaning.winsorize(cleaning.impute_rules(_fenced(spark, sf)))
    return rounded(out.select("icustay_id", *fv.WINSORIZE_PERCENT))


@register("complete_cases", with_ctes("select * from matrix_a where " + " and ".join(f"{c} is not null" for c in cleaning.COMPLETE_CASE_COLUMNS)))
def complete_cases(spark, sf):
    return cleaning.complete_cases(matrix_a(spark, sf))


_CLEAN_DOUBLES = ", ".join(f"{r6(c)} as {c}" for c in [*fv.WINSORIZE_PERCENT, "clinical_risk_index", "creatinine_zscore"])


@register("cleaned_reference", with_ctes(f"select * replace ({_CLEAN_DOUBLES}) from cleaned_ref"))
def cleaned_reference(spark, sf):
    return rounded(cleaning.clean(matrix_a(spark, sf), "reference"))


@register("cleaned_keep", with_ctes(f"select * replace ({_CLEAN_DOUBLES}) from cleaned_keep"))
def cleaned_keep(spark, sf):
    return rounded(cleaned(spark, sf))


# --- descriptive tables ---------------------------------------------------------------------------
@register("dataset_info", with_ctes("select count(*) n_rows, count(*) - count(adverse_event) missing_label from matrix_a"))
def dataset_info(spark, sf):
    return summaries.dataset_info(matrix_a(spark, sf))


_TYPES = {"age": "double", "length_of_stay": "double", "polypharmacy_score": "double", "admittime": "timestamp_ntz",
          "icu_intime": "timestamp_ntz", "diagnosis": "string", **dict.fromkeys(extract.MATRIX_A_DIGITS, "double")}
_MATRIX_COLUMNS = [
    *fv.ID_COLUMNS, "age", "gender", "length_of_stay", *extract.MATRIX_A_DIGITS, *extract.MATRIX_A_ZEROS,
    "polypharmacy_score", "adverse_event", "hospital_expire_flag", "icu_readmission", "has_sepsis", "critical_labs",
    "admittime", "icu_intime", "diagnosis",
]


@register(
    "schema_listing",
    with_ctes(" union all ".join(
        f"""select cast({i} as bigint) "position", '{c}' variable, '{_TYPES.get(c, 'bigint')}' "type", count(*) - count({c}) n_miss from matrix_a"""
        for i, c in enumerate(_MATRIX_COLUMNS, 1))),
)
def schema_listing(spark, sf):
    return summaries.schema_listing(matrix_a(spark, sf))


@register("describe_long", with_ctes(describe_sql(fv.BASE_FEATURES, "valid_a")))
def describe_long(spark, sf):
    return rounded(summaries.describe_long(cleaning.valid_ranges_only(matrix_a(spark, sf)), fv.BASE_FEATURES))


@register(
    "describe_by_label",
    with_ctes(describe_sql([*fv.BASE_FEATURES, "clinical_risk_index"], "cleaned_keep", "adverse_event")),
)
def describe_by_label(spark, sf):
    return rounded(
        summaries.describe_long(cleaned(spark, sf), [*fv.BASE_FEATURES, "clinical_risk_index"], ["adverse_event"])
    )


@register(
    "frequency",
    with_ctes(f"""select adverse_event, count(*) n, {r6('100.0e0 * count(*) / sum(count(*)) over ()')} "percent"
      from matrix_a group by adverse_event"""),
)
def frequency(spark, sf):
    return rounded(summaries.frequency(matrix_a(spark, sf), "adverse_event"))


_MISSING = " + ".join(f"avg(cast({c} is null as int))" for c in fv.BASE_FEATURES)


@register(
    "data_summary",
    with_ctes(f"""select count(*) n_patients, cast(9 as bigint) n_features, cast(sum(adverse_event) as bigint) adverse_event_n,
      {r6('avg(adverse_event)')} adverse_event_rate, {r6('avg(age)')} age_mean, {r6('stddev_samp(age)')} age_std,
      {r6(f'({_MISSING}) / 9')} missing_pct, {r6(linear_quantile('length_of_stay', 50))} los_median from matrix_a"""),
)
def data_summary(spark, sf):
    return rounded(summaries.data_summary(matrix_a(spark, sf)))


@register(
    "group_means",
    with_ctes("select adverse_event, " + ", ".join(f"{r6(f'avg({c})')} {c}" for c in fv.BASE_FEATURES)
              + " from matrix_a group by adverse_event"),
)
def group_means(spark, sf):
    return rounded(summaries.group_means(matrix_a(spark, sf), fv.BASE_FEATURES))


@register(
    "age_band_rate",
    with_ctes(f"""select case when age <= 45 then '18-44' when age <= 65 then '45-64' when age <= 80 then '65-79' else '80+' end age_interval,
      {r6('avg(adverse_event)')} ae_rate, count(adverse_event) n from matrix_a where age > 18 and age <= 110 group by 1"""),
)
def age_band_rate(spark, sf):
    return rounded(summaries.age_band_rate(matrix_a(spark, sf)))


def hist_sql(columns, source: str, bins: int, by: str, common: bool = False) -> str:
    span = "feature" if common else f"feature, {by}"
    return f"""
with_vals as ({long_sql(columns, source, by)}),
lims as (select {span}, min(value) - case when min(value) = max(value) then 0.5e0 else 0 end low,
  max(value) + case when min(value) = max(value) then 0.5e0 else 0 end high from with_vals group by {span}),
tots as (select feature, {by}, count(*) total from with_vals group by feature, {by}),
bins as (select feature, {by}, low, high, total, bin from tots join lims using ({span}), (select unnest(range({bins})) bin)),
counted as (select feature, {by}, least(cast(floor((value - low) / nullif(high - low, 0) * {bins}) as bigint), {bins - 1}) bin, count(*) n
  from with_vals join lims using ({span}) group by all)
select {by}, feature, bin, {r6(f'low + bin * ((high - low) / {bins})')} bin_from,
  {r6(f'low + (bin + 1) * ((high - low) / {bins})')} bin_to, coalesce(n, 0) n,
  {r6(f'coalesce(n, 0) / (total * ((high - low) / {bins}))')} density
from bins left join counted using (feature, {by}, bin)"""


def _hist_oracle(columns, source, bins, by, common=False, extra=None):
    text = hist_sql(columns, source, bins, by, common)
    head = with_ctes(f"select 1 from {source}", extra)
    return head[: head.rindex("\n")] + ",\n" + text.strip()


@register("hist_by_label", _hist_oracle(fv.BASE_FEATURES, "matrix_a", 30, "adverse_event"))
def hist_by_label(spark, sf):
    return rounded(summaries.histogram(matrix_a(spark, sf), fv.BASE_FEATURES, 30, ["adverse_event"]))


_CLIPPED = {
    "clipped": """select adverse_event, case when creatinine_max is not null then greatest(least(creatinine_max, 10e0), 0e0) end creatinine_max,
    greatest(least(cast(drug_count as double), 30e0), 0e0) drug_count from matrix_a"""
}


@register("hist_clipped", _hist_oracle(["drug_count"], "clipped", 20, "adverse_event", extra=_CLIPPED))
def hist_clipped(spark, sf):
    from ..operators.scoring import display_clips

    return rounded(summaries.histogram(display_clips(matrix_a(spark, sf)), ["drug_count"], 20, ["adverse_event"]))


@register("hist_creatinine_clipped", _hist_oracle(["creatinine_max"], "clipped", 30, "adverse_event", extra=_CLIPPED))
def hist_creatinine_clipped(spark, sf):
    from ..operators.scoring import display_clips

    return rounded(summaries.histogram(display_clips(matrix_a(spark, sf)), ["creatinine_max"], 30, ["adverse_event"]))


_PAIRS = [(a, b) for i, a in enumerate([*fv.BASE_FEATURES, fv.LABEL]) for b in [*fv.BASE_FEATURES, fv.LABEL][i + 1 :]]


@register(
    "corr_matrix",
    with_ctes(" union all ".join(
        f"select '{a}' feature_x, '{b}' feature_y, {r6(f'corr({a}, {b})')} r from matrix_a" for a, b in _PAIRS)),
)
def corr_matrix(spark, sf):
    return rounded(summaries.correlation_pairs(matrix_a(spark, sf), [*fv.BASE_FEATURES, fv.LABEL]))


@register(
    "corr_with_label",
    with_ctes(" union all ".join(
        f"select '{a}' feature, {r6(f'corr({a}, adverse_event)')} r from matrix_a" for a in fv.BASE_FEATURES)),
)
def corr_with_label(spark, sf):
    return rounded(summaries.label_correlations(matrix_a(spark, sf)))


_MW = with_ctes(
    f"""select feature, cast(n0 as bigint) n_no_event, cast(n1 as bigint) n_event, {r6('s0 / n0')} mean_no_event,
  {r6('s1 / n1')} mean_event, {r6('u')} u,
  {r6('(greatest(u, n0*n1 - u) - n0*n1/2e0 - 0.5e0) / sqrt(n0*n1/12e0*(n0+n1+1 - ties/((n0+n1)*(n0+n1-1))))')} z
from (select feature, n0, n1, s0, s1, ties, r0 - n0*(n0+1)/2e0 u from mw)""",
    {
        "mw_long": long_sql(fv.BASE_FEATURES, "matrix_a", "adverse_event"),
        "mw_rank": """select *, rank() over (partition by feature order by value)
          + (count(*) over (partition by feature, value) - 1) / 2e0 r,
          cast(count(*) over (partition by feature, value) as double) t from mw_long""",
        "mw": """select feature, cast(count(*) filter (adverse_event = 0) as double) n0,
          cast(count(*) filter (adverse_event = 1) as double) n1, sum(value) filter (adverse_event = 0) s0,
          sum(value) filter (adverse_event = 1) s1, sum(r) filter (adverse_event = 0) r0, sum(t*t - 1) ties
          from mw_rank group by feature""",
    },
)


@register("mann_whitney", _MW)
def mann_whitney(spark, sf):
    return rounded(summaries.mann_whitney(matrix_a(spark, sf)))


# --- quantiles of every base feature -------------------------------------------------------------------
@register(
    "quantiles_linear",
    with_ctes(" union all ".join(
        f"select '{c}' feature, count({c}) n, {r6(linear_quantile(c, 0.5))} q0_5, {r6(linear_quantile(c, 25))} q25, "
        f"{r6(linear_quantile(c, 50))} q50, {r6(linear_quantile(c, 75))} q75, {r6(linear_quantile(c, 99.5))} q99_5 from matrix_a"
        for c in fv.BASE_FEATURES)),
)
def quantiles_linear(spark, sf):
    return rounded(quantile_table(matrix_a(spark, sf), fv.BASE_FEATURES, [0.5, 25, 50, 75, 99.5]))


# --- sampling ------------------------------------------------------------------------------------------------
_HASH = "md5(concat_ws('|', cast(icustay_id as varchar), '42'))"
_ORDERED = {
    "ordered": f"""select icustay_id, adverse_event,
      row_number() over (partition by adverse_event order by {_HASH}, icustay_id) rn,
      count(*) over (partition by adverse_event) n from matrix_a"""
}


@register("fold_ids", with_ctes("select icustay_id, adverse_event, (rn - 1) % 5 fold from ordered", _ORDERED))
def fold_ids(spark, sf):
    rows = matrix_a(spark, sf).select("icustay_id", "adverse_event")
    return sampling.stratified_folds(rows, ["icustay_id"], 5)


@register(
    "train_test_split",
    with_ctes("select icustay_id, adverse_event, rn <= floor(n * 0.2e0 + 0.5e0) is_test from ordered", _ORDERED),
)
def train_test_split(spark, sf):
    rows = matrix_a(spark, sf).select("icustay_id", "adverse_event")
    return sampling.stratified_split(rows, ["icustay_id"], 0.2)


@register(
    "class_weights",
    with_ctes(f"""select adverse_event, count(*) n_class, {r6('sum(count(*)) over () / (2.0e0 * count(*))')} class_weight
      from matrix_a group by adverse_event"""),
)
def class_weights(spark, sf):
    return rounded(sampling.class_weights(matrix_a(spark, sf)))


@register(
    "repeatable_sample",
    with_ctes(f"select icustay_id, adverse_event from matrix_a order by {_HASH}, icustay_id limit 500"),
)
def repeatable_sample(spark, sf):
    rows = matrix_a(spark, sf).select("icustay_id", "adverse_event")
    return sampling.repeatable_head(rows, ["icustay_id"], 500)


# --- feature engineering ----------------------------------------------------------------------------------------
def _c(name: str) -> str:
    return f"coalesce(cast({name} as double), {fv.DERIVATION_DEFAULTS[name]}e0)"


def _f(test: str) -> str:
    return f"cast(coalesce({test}, false) as int)::double"


_AGE, _HR, _CR, _WB = _c("age"), _c("heart_rate_mean"), _c("creatinine_max"), _c("wbc_mean")
_LO, _DR, _LA, _PO = _c("length_of_stay"), _c("drug_count"), _c("lab_abnormality_score"), _c("polypharmacy_score")
DERIVED_SQL = {
    "tachycardia_flag": _f(f"{_HR} > 100"),
    "renal_impairment_flag": _f(f"{_CR} > 1.5e0"),
    "leukocytosis_flag": _f(f"{_WB} > 12"),
    "elderly_flag": _f(f"{_AGE} >= 65"),
    "long_stay_flag": _f(f"{_LO} >= 7"),
    "high_polypharmacy_flag": _f(f"{_PO} >= 7"),
    "critical_labs_flag": _f(f"{_LA} >= 3"),
    "organ_failure_score": f"{_f(f'{_CR} > 1.5e0')} + {_f(f'{_LA} >= 3')} + {_f(f'{_WB} > 12')}",
    "composite_clinical_risk": f"least(greatest(0.2e0*{_f(f'{_HR} > 100')} + 0.25e0*{_f(f'{_CR} > 1.5e0')} "
    f"+ 0.2e0*{_f(f'{_WB} > 12')} + 0.15e0*{_f(f'{_LA} >= 2')} + 0.1e0*{_f(f'{_PO} >= 7')} + 0.1e0*{_f(f'{_LO} >= 7')}, 0e0), 1e0)",
    "age_creatinine_interaction": f"({_AGE} / 65e0) * ({_CR} / 1.2e0)",
    "hr_los_interaction": f"({_HR} / 80e0) * ln(1e0 + {_LO})",
    "drug_lab_interaction": f"{_DR} * ({_LA} + 1)",
    "poly_creatinine_interaction": f"{_PO} * {_CR}",
    "log_creatinine": f"ln(1e0 + {_CR})",
    "log_los": f"ln(1e0 + {_LO})",
    "log_wbc": f"ln(1e0 + {_WB})",
    "log_drugs": f"ln(1e0 + {_DR})",
}
ENGINEERED_SQL = (
    "select icustay_id, adverse_event, "
    + ", ".join(f"cast({c} as double) {c}" for c in fv.BASE_FEATURES)
    + ", "
    + ", ".join(f"{e} {n}" for n, e in DERIVED_SQL.items())
    + " from matrix_a"
)
_ALL26 = [*fv.BASE_FEATURES, *fv.DERIVED_FEATURES]


@register(
    "derived_features",
    with_ctes("select icustay_id, adverse_event, " + ", ".join(f"{r6(c)} {c}" for c in _ALL26) + " from engineered",
              {"engineered": ENGINEERED_SQL}),
)
def derived_features(spark, sf):
    out = features.engineer_features(matrix_a(spark, sf), keep=["icustay_id", "adverse_event"])
    return rounded(out)


@register(
    "absent_columns",
    with_ctes("""select icustay_id, cast(age as double) age, cast(0e0 as double) wbc_mean, 5e0::double drug_count,
      2.5e0::double polypharmacy_score from matrix_a"""),
)
def absent_columns(spark, sf):
    """A file without three columns: one filled with 0, two with scoring defaults."""
    from ..operators.scoring import with_scoring_defaults

    part = matrix_a(spark, sf).select("icustay_id", F.col("age").cast("double").alias("age"))
    filled = features.with_base_columns(part, ["wbc_mean"])
    return with_scoring_defaults(filled).select("icustay_id", "age", "wbc_mean", "drug_count", "polypharmacy_score")


@register(
    "feature_metadata",
    with_ctes(
        " union all ".join(
            f"""select '{n}' "name", '{t}' "type", '{c}' category, '{d}' description, {lo}::double min_val, {hi}::double max_val,
            {r6(f'min({n})')} observed_min, {r6(f'max({n})')} observed_max, count({n}) n from matrix_a"""
            for n, t, c, d, lo, hi in fv.FEATURE_METADATA
        )
    ),
)
def feature_metadata(spark, sf):
    """The metadata table beside what the matrix really holds."""
    matrix = matrix_a(spark, sf)
    seen = summaries.describe_long(matrix, fv.BASE_FEATURES).select(
        F.col("variable").alias("name"), F.col("min").alias("observed_min"), F.col("max").alias("observed_max"), "n"
    )
    return rounded(features.feature_metadata(spark).join(seen, "name", "left"))


@register(
    "feature_dictionary",
    with_ctes(
        " union all ".join(
            f"""select '{v}' variable, '{d}' description, '{t}' "type", '{m}' missing_action, count(*) - count({v}) n_miss from matrix_a"""
            for v, d, t, m in fv.FEATURE_DICTIONARY
        )
    ),
)
def feature_dictionary(spark, sf):
    matrix = matrix_a(spark, sf)
    seen = summaries.describe_long(matrix, [v[0] for v in fv.FEATURE_DICTIONARY]).select("variable", "n_miss")
    return features.feature_dictionary(spark).join(seen, "variable", "left")


