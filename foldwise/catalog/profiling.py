"""Registered queries: table profiling and two-table comparison."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from foldwise.catalog import sql as S
from foldwise.catalog.registry import register
from foldwise.operators.drift import by_sets
from foldwise.functions import features as P
from foldwise.operators import profile as E
from foldwise.sources.tables import observations

W = S.with_
TR = "tr as (select * from obs where side = 'train')"
TE = "te as (select * from obs where side = 'test')"
OBS_COLS = [("id", "bigint"), ("label", "int"), ("grp", "int"), ("flag", "int"), ("cat", "string"),
            ("x1", "double"), ("x2", "double"), ("c1", "int"), ("c2", "int"), ("side", "string")]


def _train(spark, sf_dir):
    return observations(spark, sf_dir).where(F.col("side") == "train")


def _test(spark, sf_dir):
    return observations(spark, sf_dir).where(F.col("side") == "test")


@register("e1_table_info", ops=["E1"], sql=W(S.OBS, TR) + "\nunion all\n".join(
    f"select '{c}' as \"column\", '{t}' as dtype, count({c}) as non_null, count(*) as \"rows\" from tr"
    for c, t in OBS_COLS))
def e1_table_info(spark, sf_dir):
    return E.table_info(_train(spark, sf_dir))


@register("e2_missing_table", ops=["E2"], doubles=["missing_pct"], sql=W(S.OBS, TR) + "select * from (" + "\nunion all\n".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as missing, (count(*) - count({c})) * 100.0 / count(*) as missing_pct from tr"
    for c, _ in OBS_COLS) + ") where missing > 0")
def e2_missing_table(spark, sf_dir):
    return E.missing_table(_train(spark, sf_dir))


@register("e3_missing_compare", ops=["E3"], doubles=["pct_a", "pct_b", "delta_pts"], sql=W(S.OBS, TR, TE) + "\nunion all\n".join(
    f"""select '{c}' as "column", a.p as pct_a, b.p as pct_b, b.p - a.p as delta_pts
from (select (count(*) - count({c})) * 100.0 / count(*) as p from tr) a, (select (count(*) - count({c})) * 100.0 / count(*) as p from te) b"""
    for c in ("x1", "x2", "cat")))
def e3_missing_compare(spark, sf_dir):
    return E.missing_compare(_train(spark, sf_dir), _test(spark, sf_dir), ["x1", "x2", "cat"])


@register("e4_duplicate_rows", ops=["E4"], sql=W(S.OBS, TR) + """
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates, count(*) as distinct_rows
from (select label, grp, flag, cat, c1, c2, count(*) as n from tr group by all) g""")
def e4_duplicate_rows(spark, sf_dir):
    return E.duplicate_rows(_train(spark, sf_dir).select("id", "label", "grp", "flag", "cat", "c1", "c2"))


def _describe_sql(src: str, cols, by: str | None = None) -> str:
    parts = []
    for c in cols:
        b = f"{by}, " if by else ""
        parts.append(f"""select {b}'{c}' as "column", count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std,
  cast(min({c}) as double) as min, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50,
  quantile_cont({c}, 0.75) as q75, cast(max({c}) as double) as max from {src} {('group by ' + by) if by else ''}""")
    return "\nunion all\n".join(parts)


DESC = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@register("e5_describe_numeric", ops=["E5"], doubles=DESC,
          sql=W(S.OBS, TR) + _describe_sql("tr", ["x1", "x2", "c1", "c2"]))
def e5_describe_numeric(spark, sf_dir):
    return E.describe_numeric(_train(spark, sf_dir), ["x1", "x2", "c1", "c2"])


@register("e6_describe_categorical", ops=["E6"], sql=W(S.OBS) + "\nunion all\n".join(f"""
select '{c}' as "column", sum(n) as count, count(*) as "unique", min_by(v, (-n, v)) as top, max(n) as freq
from (select {c} as v, count(*) as n from obs where {c} is not null group by {c}) t""" for c in ("cat", "side")))
def e6_describe_categorical(spark, sf_dir):
    return E.describe_categorical(observations(spark, sf_dir), ["cat", "side"])


@register("e7_class_balance", ops=["E7"], doubles=["share"], sql=W(S.OBS, TR) + """
select label, count(*) as n, count(*) * 1.0 / sum(count(*)) over () as share from tr group by label""")
def e7_class_balance(spark, sf_dir):
    return E.category_shares(_train(spark, sf_dir), "label")


def _hist_sql(src: str, cols, by: str | None, bins: int = 30) -> str:
    parts = []
    for c in cols:
        b = f"{by}, " if by else ""
        parts.append(f"""select {b}'{c}' as "column", v.{c} as v, r.lo, r.hi from {src} v,
  (select min({c}) as lo, max({c}) as hi from {src}) r where v.{c} is not null""")
    st = "st as (" + "\nunion all\n".join(parts) + ")"
    b = f"{by}, " if by else ""
    counted = f"""(select {b}"column", lo, hi, cast(case when hi = lo then 0 else least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) end as integer) as bin, count(*) as n
  from st group by all)"""
    every = f"""(select distinct {b}"column", lo, hi, bin from st, (select cast(unnest(range({bins})) as integer) as bin) where bin = 0 or hi > lo)"""
    return (st, f"""select {b}"column", bin, lo + bin * (case when hi = lo then 1.0 else (hi - lo) / {bins} end) as bin_lo,
  n, n / (sum(n) over (partition by {b}"column") * (case when hi = lo then 1.0 else (hi - lo) / {bins} end)) as density
from (select {b}"column", lo, hi, bin, coalesce(n, 0) as n from {every} e left join {counted} c using ({b}"column", lo, hi, bin))""")


_h8 = _hist_sql("tr", ["x1", "x2"], None)


@register("e8_histogram_density", ops=["E8"], doubles=["bin_lo", "density"], sql=W(S.OBS, TR, _h8[0]) + _h8[1])
def e8_histogram_density(spark, sf_dir):
    return E.histogram(_train(spark, sf_dir), ["x1", "x2"], 30)


_h9 = _hist_sql("obs", ["x1", "x2"], "side")


@register("e9_histogram_two_tables", ops=["E9"], doubles=["bin_lo", "density"], sql=W(S.OBS, _h9[0]) + _h9[1])
def e9_histogram_two_tables(spark, sf_dir):
    return E.histogram(observations(spark, sf_dir), ["x1", "x2"], 30, by=["side"], shared=True)


@register("e10_gaussian_kde", ops=["E10"], doubles=["x", "density"], sql=W(
    S.OBS,
    "vc as (select side, x2 as v, count(*) as c from obs where x2 is not null group by side, x2)",
    "st as (select side, count(x2) as n, stddev_samp(x2) * pow(count(x2), -0.2) as h, min(x2) - (max(x2) - min(x2)) / 2 as g0, (max(x2) - min(x2)) * 2 / 999 as step from obs where x2 is not null group by side)",
    "gp as (select unnest(range(0, 1000)) as point)",
) + f"""select st.side, cast(gp.point as integer) as point, any_value(st.g0 + gp.point * st.step) as x,
  sum(vc.c * exp(-0.5 * ((st.g0 + gp.point * st.step - vc.v) / st.h) * ((st.g0 + gp.point * st.step - vc.v) / st.h)) / (st.n * st.h * {math.sqrt(2 * math.pi)!r})) as density
from st join vc on st.side = vc.side cross join gp
where (select count(distinct v) from vc v2 where v2.side = st.side) >= 6
group by st.side, gp.point""")
def e10_gaussian_kde(spark, sf_dir):
    return E.gaussian_kde(observations(spark, sf_dir), "x2", by=["side"], grid=1000)


@register("e11_adjusted_skewness", ops=["E11"], doubles=["skew", "skew_log1p"], sql=W(S.OBS, TR) + "\nunion all\n".join(
    f"select '{c}' as \"column\", skewness({c}) as skew, skewness(ln(1 + {c})) as skew_log1p from tr" for c in ("x2", "c1")))
def e11_adjusted_skewness(spark, sf_dir):
    return E.skewness_adjusted(_train(spark, sf_dir), ["x2", "c1"])


@register("e12_category_counts", ops=["E12"], doubles=["share"], sql=W(S.OBS, TR) + """
select cat, count(*) as n, count(*) * 1.0 / sum(count(*)) over () as share from tr where cat is not null group by cat""")
def e12_category_counts(spark, sf_dir):
    return E.category_shares(_train(spark, sf_dir), "cat")


@register("e13_target_rate_by_category", ops=["E13"], doubles=["rate"], sql=W(S.OBS, TR) + """
select cat, avg(label) as rate, count(*) as n from tr where cat is not null group by cat""")
def e13_target_rate_by_category(spark, sf_dir):
    return E.target_rate(_train(spark, sf_dir), ["cat"])


AGE_EDGES = (0, 12, 18, 30, 50, 80)
AGE_LABELS = ("0-12", "12-18", "18-30", "30-50", "50-80")


@register("e14_rate_by_fixed_bins", ops=["E14"], doubles=["rate"], sql=W(S.OBS, TR) + f"""
select d.bin, d.bin_order, a.rate, coalesce(a.n, 0) as n
from (values {', '.join(f"('{lb}', {i})" for i, lb in enumerate(AGE_LABELS))}) d(bin, bin_order)
left join (select case {' '.join(f"when x1 > {AGE_EDGES[i]} and x1 <= {AGE_EDGES[i + 1]} then '{AGE_LABELS[i]}'" for i in range(5))} end as bin,
  avg(label) as rate, count(*) as n from tr group by 1) a on a.bin = d.bin""")
def e14_rate_by_fixed_bins(spark, sf_dir):
    return E.binned_rate(_train(spark, sf_dir), "x1", AGE_EDGES, AGE_LABELS)


@register("e15_grouped_describe", ops=["E15"], doubles=DESC,
          sql=W(S.OBS, TR) + _describe_sql("tr", ["x2"], "label"))
def e15_grouped_describe(spark, sf_dir):
    return E.describe_numeric(_train(spark, sf_dir), ["x2"], by=["label"])


@register("e16_box_summary", ops=["E16"], doubles=["q1", "median", "q3", "iqr"], sql=W(
    S.OBS, TR,
    "q as (select label, quantile_cont(x2, 0.25) as q1, quantile_cont(x2, 0.5) as median, quantile_cont(x2, 0.75) as q3 from tr group by label)",
) + """select q.label, q1, median, q3, q3 - q1 as iqr,
  min(case when x2 >= q1 - 1.5 * (q3 - q1) then x2 end) as whisker_lo,
  max(case when x2 <= q3 + 1.5 * (q3 - q1) then x2 end) as whisker_hi,
  cast(sum(case when x2 < q1 - 1.5 * (q3 - q1) or x2 > q3 + 1.5 * (q3 - q1) then 1 else 0 end) as bigint) as outliers
from tr join q on tr.label = q.label group by q.label, q1, median, q3""")
def e16_box_summary(spark, sf_dir):
    return E.box_summary(_train(spark, sf_dir), "x2", ["label"])


@register("e17_rates_with_min_count", ops=["E17"], doubles=["rate"], sql=W(S.OBS, TR) + """
select cat, c1, c2, grp, avg(label) as rate, count(*) as n from tr where cat is not null
group by cat, c1, c2, grp having count(*) >= 5""")
def e17_rates_with_min_count(spark, sf_dir):
    return E.target_rate(_train(spark, sf_dir), ["cat", "c1", "c2", "grp"], min_n=5)


CORR_COLS = ["label", "grp", "flag", "x1", "x2", "c1", "c2"]


@register("e18_correlation_matrix", ops=["E18", "N6"], doubles=["corr"], sql=W(S.OBS, TR) + "\nunion all\n".join(
    f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as corr from tr"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def e18_correlation_matrix(spark, sf_dir):
    return E.correlations(_train(spark, sf_dir), CORR_COLS)


@register("e19_target_correlation_rank", ops=["E19"], doubles=["corr"], sql=W(S.OBS, TR) + "select *, rank() over (order by abs(round(corr, 9)) desc) as rnk from (" + "\nunion all\n".join(
    f"select '{a}' as a, 'label' as b, corr({a}, label) as corr from tr" for a in CORR_COLS if a != "label") + ") t")
def e19_target_correlation_rank(spark, sf_dir):
    c = E.correlations(_train(spark, sf_dir), CORR_COLS, target="label")
    # ranking a handful of rows: a one-partition window over (#features) rows is bounded
    return c.withColumn("rnk", F.rank().over(Window.orderBy(F.abs(F.round("corr", 9)).desc())))


@register("e20_pivot_rate", ops=["E20"], doubles=["0_rate", "1_rate"], sql=W(S.OBS, TR) + """
select grp, avg(case when flag = 0 then label end) as "0_rate", count(case when flag = 0 then 1 end) as "0_n",
  avg(case when flag = 1 then label end) as "1_rate", count(case when flag = 1 then 1 end) as "1_n"
from tr group by grp""")
def e20_pivot_rate(spark, sf_dir):
    tr = _train(spark, sf_dir)
    return (tr.groupBy("grp").pivot("flag", [0, 1])
            .agg(F.avg(F.col("label").cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))
            .na.fill(0, subset=["0_n", "1_n"]))


@register("e21_three_way_counts", ops=["E21"], sql=W(S.OBS, TR) + """
select grp, label, flag, count(*) as n from tr group by grp, label, flag""")
def e21_three_way_counts(spark, sf_dir):
    return _train(spark, sf_dir).groupBy("grp", "label", "flag").agg(F.count(F.lit(1)).alias("n"))


@register("e22_grouped_quartiles", ops=["E22"], doubles=["x1_q25", "x1_q50", "x1_q75"], sql=W(S.OBS, TR) + """
select grp, label, quantile_cont(x1, 0.25) as x1_q25, quantile_cont(x1, 0.5) as x1_q50, quantile_cont(x1, 0.75) as x1_q75
from tr where x1 is not null group by grp, label""")
def e22_grouped_quartiles(spark, sf_dir):
    from foldwise.operators.foldstats import fold_quantiles_multi

    q = fold_quantiles_multi(_train(spark, sf_dir), ["x1"], ["grp", "label"], [0.25, 0.5, 0.75], None, None)
    return q.drop("eval_fold")


@register("e23_rate_by_family_size", ops=["E23"], doubles=["rate"], sql=W(S.OBS, TR) + """
select 'family_size' as feature, c1 + c2 + 1 as value, avg(label) as rate, count(*) as n from tr group by c1 + c2 + 1
union all select 'is_alone', cast(c1 + c2 + 1 = 1 as integer), avg(label), count(*) from tr group by cast(c1 + c2 + 1 = 1 as integer)""")
def e23_rate_by_family_size(spark, sf_dir):
    tr = _train(spark, sf_dir).select("label", P.family_size("c1", "c2").alias("family_size"))
    tr = tr.withColumn("is_alone", (F.col("family_size") == 1).cast("int"))
    a = E.target_rate(tr, ["family_size"]).select(F.lit("family_size").alias("feature"),
                                                  F.col("family_size").alias("value"), "rate", "n")
    b = E.target_rate(tr, ["is_alone"]).select(F.lit("is_alone").alias("feature"),
                                               F.col("is_alone").alias("value"), "rate", "n")
    return a.unionByName(b)


@register("e24_upper_cut_q98", ops=["E24"], doubles=["x2_q98"], sql=W(S.OBS, TR) + """
select quantile_cont(x2, 0.98) as x2_q98 from tr""")
def e24_upper_cut_q98(spark, sf_dir):
    from foldwise.operators.foldstats import fold_quantiles_multi

    return fold_quantiles_multi(_train(spark, sf_dir), ["x2"], [], [0.98], None, None).select("x2_q98")


@register("e25_missingness_profile", ops=["E25"], doubles=["rate", "x2_mean", "missing_rate"], sql=W(S.OBS, TR) + """
select 'by_flag' as view, cast(x1 is null as integer) as x1_missing, null as grp, null as flag, avg(label) as rate, count(*) as n, avg(x2) as x2_mean, null as missing_rate from tr group by 2
union all select 'by_grp', null, grp, null, null, count(*), null, avg(cast(x1 is null as integer)) from tr group by grp
union all select 'by_flag_col', null, null, flag, null, count(*), null, avg(cast(x1 is null as integer)) from tr group by flag
union all select 'by_grp_flag', null, grp, flag, null, count(*), null, avg(cast(x1 is null as integer)) from tr group by grp, flag""")
def e25_missingness_profile(spark, sf_dir):
    tr = _train(spark, sf_dir).withColumn("x1_missing", F.col("x1").isNull().cast("int"))
    out = by_sets(tr, [["x1_missing"], ["grp"], ["flag"], ["grp", "flag"]], F.avg(F.col("label").cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"),
                  F.avg("x2").alias("x2_mean"), F.avg(F.col("x1").isNull().cast("double")).alias("missing_rate"))
    view = F.element_at(F.array(*[F.lit(v) for v in ("by_flag", "by_grp", "by_flag_col", "by_grp_flag")]), F.col("_set") + 1)
    first = F.col("_set") == 0  # the rates by missingness; the other views show missingness itself
    return out.select(view.alias("view"), "x1_missing", "grp", "flag", F.when(first, F.col("rate")).alias("rate"), "n",
                      F.when(first, F.col("x2_mean")).alias("x2_mean"), F.when(~first, F.col("missing_rate")).alias("missing_rate"))


@register("e26_two_table_numeric", ops=["E26"], doubles=["mean_a", "std_a", "q50_a", "min_a", "max_a", "mean_b",
                                                         "std_b", "q50_b", "min_b", "max_b", "mean_diff", "median_diff"],
          sql=W(S.OBS, TR, TE) + "\nunion all\n".join(f"""select '{c}' as "column", a.*, b.*, b.mean_b - a.mean_a as mean_diff, b.q50_b - a.q50_a as median_diff from
(select avg({c}) as mean_a, stddev_samp({c}) as std_a, quantile_cont({c}, 0.5) as q50_a, min({c}) as min_a, max({c}) as max_a from tr) a,
(select avg({c}) as mean_b, stddev_samp({c}) as std_b, quantile_cont({c}, 0.5) as q50_b, min({c}) as min_b, max({c}) as max_b from te) b"""
                                                                       for c in ("x1", "x2")))
def e26_two_table_numeric(spark, sf_dir):
    return E.two_table_numeric(_train(spark, sf_dir), _test(spark, sf_dir), ["x1", "x2"])


@register("e27_two_table_shares", ops=["E27"], doubles=["share_a", "share_b", "diff"], sql=W(
    S.OBS, TR, TE,
    "sa as (select cat, count(*) * 1.0 / sum(count(*)) over () as share_a from tr group by cat)",
    "sb as (select cat, count(*) * 1.0 / sum(count(*)) over () as share_b from te group by cat)",
) + """select coalesce(sa.cat, sb.cat) as cat, coalesce(share_a, 0.0) as share_a, coalesce(share_b, 0.0) as share_b,
  coalesce(share_b, 0.0) - coalesce(share_a, 0.0) as diff
from sa full outer join sb on sa.cat is not distinct from sb.cat""")
def e27_two_table_shares(spark, sf_dir):
    return E.two_table_shares(_train(spark, sf_dir), _test(spark, sf_dir), "cat")


_h28 = _hist_sql("m", ["family_size", "log_x2", "x2_per_person"], None)


@register("e28_feature_matrix_histograms", ops=["E28"], doubles=["bin_lo", "density"], sql=W(
    S.OBS, TR, "m as (select c1 + c2 + 1 as family_size, ln(1 + x2) as log_x2, x2 / (c1 + c2 + 1) as x2_per_person from tr)",
    _h28[0]) + _h28[1])
def e28_feature_matrix_histograms(spark, sf_dir):
    m = _train(spark, sf_dir).select(*P.base_derived("c1", "c2", "x2", "grp", "flag"))
    return E.histogram(m, ["family_size", "log_x2", "x2_per_person"], 30)
