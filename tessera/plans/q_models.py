"""Model analyses: factorization machines (M1-M5, S10), pyspark.ml jobs (M6-M13),
regression-table scoring (M14), evaluation of predictions (E2-E4)."""

import numpy as np
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import fm as FM
from ..operators import jobs as J
from ..session import scratch_path
from . import inputs as I
from .catalog import register
from .q_knn import REGISTRY_N5_SQL
from .q_scalars import _CENTROID_SQL, class_centroids

XS = ["x0", "x1", "x2", "x3"]
K_FM = 2


def fixed_fm(task):
    """A deterministic model for the value checks (weights from a simple rule)."""
    n = len(XS)
    w = np.array([0.1 * (i + 1) - 0.2 for i in range(n)])
    v = np.array([[0.05 * (i + 1) - 0.04 * (f + 1) for f in range(K_FM)] for i in range(n)])
    return FM.FMModel(0.05, w, v, task, min_target=0.0, max_target=1.0)


def _fm_rows(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir)
    return r.select("id", "label", F.array(*XS).alias("features"))


def _raw_sql(m):
    n, k = m.v.shape
    lin = " + ".join(f"x{i} * {float(m.w[i])!r}" for i in range(n))
    parts = []
    for f in range(k):
        s = "(0.0 + " + " + ".join(f"x{i} * {float(m.v[i, f])!r}" for i in range(n)) + ")"
        sq = "(0.0 + " + " + ".join(f"x{i} * x{i} * {float(m.v[i, f] ** 2)!r}" for i in range(n)) + ")"
        parts.append(f"0.5 * ({s} * {s} - {sq})")
    return f"({float(m.w0)!r} + {lin} + " + " + ".join(parts) + ")"


_M = fixed_fm(1)
_RAW = _raw_sql(_M)


@register("m1_fm_scoring", f"""
with r as ({I.REGRESSION_SQL})
select id, label, round({_RAW}, 6) as raw, round(1 / (1 + exp(-{_RAW})), 6) as probability,
       round(least(greatest({_RAW}, 0.0), 1.0), 6) as clipped from r
""")
def m1_fm_scoring(spark, sf_dir):
    rows = _fm_rows(spark, sf_dir)
    m1, m0 = fixed_fm(1), fixed_fm(0)
    out = rows.withColumn("raw", F.round(FM.raw_score(rows, m1), 6))
    out = FM.predict(out, m1, out="probability")
    out = FM.predict(out, m0, out="clipped")
    return out.select("id", "label", "raw", F.round("probability", 6).alias("probability"),
                      F.round("clipped", 6).alias("clipped"))


def _grad_sql(m):
    n, k = m.v.shape
    s = {f: "(0.0 + " + " + ".join(f"x{i} * {float(m.v[i, f])!r}" for i in range(n)) + ")" for f in range(k)}
    cols = ["sum(mult) as w0"] + [f"sum(mult * x{i}) as w_{i}" for i in range(n)]
    cols += [f"sum(mult * (x{i} * {s[f]} - {float(m.v[i, f])!r} * x{i} * x{i})) as v_{i}_{f}"
             for i in range(n) for f in range(k)]
    names = ["w0"] + [f"w_{i}" for i in range(n)] + [f"v_{i}_{f}" for i in range(n) for f in range(k)]
    body = f"""
with r as ({I.REGRESSION_SQL}),
p as (select *, case when label > 0 then 1.0 else -1.0 end as y, {_raw_sql(m)} as p from r),
q as (select *, -y * (1 - 1 / (1 + exp(-y * p))) as mult, ln(1 + exp(-y * p)) as l from p),
g as (select {', '.join(cols)}, sum(l) as loss, count(*) * 1.0 as count from q)
"""
    sel = " union all ".join(f"select '{nm}' as name, round({nm}, 6) as value from g" for nm in names + ["loss", "count"])
    return body + sel


@register("m2_fm_gradient", _grad_sql(_M))
def m2_fm_gradient(spark, sf_dir):
    t = FM.gradient_table(_fm_rows(spark, sf_dir), fixed_fm(1))
    return t.select("name", F.round("value", 6).alias("value"))


def _grad0_sql(m):
    n, k = m.v.shape
    s = {f: "(0.0 + " + " + ".join(f"x{i} * {float(m.v[i, f])!r}" for i in range(n)) + ")" for f in range(k)}
    cols = ["sum(mult) as w0"] + [f"sum(mult * x{i}) as w_{i}" for i in range(n)]
    cols += [f"sum(mult * (x{i} * {s[f]} - {float(m.v[i, f])!r} * x{i} * x{i})) as v_{i}_{f}" for i in range(n) for f in range(k)]
    names = ["w0"] + [f"w_{i}" for i in range(n)] + [f"v_{i}_{f}" for i in range(n) for f in range(k)]
    body = f"""
with r as ({I.REGRESSION_SQL}),
q as (select *, least(greatest({_raw_sql(m)}, 0.0), 1.0) - label as mult from r),
g as (select {', '.join(cols)}, sum(mult * mult) as loss, count(*) * 1.0 as count from q)
"""
    return body + " union all ".join(f"select '{nm}' as name, round({nm}, 6) as value from g" for nm in names + ["loss", "count"])


@register("m2_fm_gradient_regression", _grad0_sql(fixed_fm(0)))
def m2_fm_gradient_regression(spark, sf_dir):
    t = FM.gradient_table(_fm_rows(spark, sf_dir), fixed_fm(0))
    return t.select("name", F.round("value", 6).alias("value"))


# wide one-hot rows: three active entries of WIDE features ------------------------
PARTS, SUPPLIERS = 3000, 500
WIDE = PARTS + SUPPLIERS + 1


def wide_rows(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    idx = F.array((F.col("l_partkey") % PARTS).cast("int"), (PARTS + F.col("l_suppkey") % SUPPLIERS).cast("int"), F.lit(WIDE - 1))
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     F.struct(F.lit(WIDE).alias("size"), idx.alias("indices"),
                              F.array(F.lit(1.0), F.lit(1.0), F.col("l_discount") * 10.0).alias("values")).alias("features"),
                     F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))


def wide_fm(task):
    """Weights by a rule that SQL can state: see ``_w`` and ``_v``."""
    i = np.arange(WIDE)
    w = 0.1 * np.sin(i + 1.0)
    v = np.stack([0.1 * np.cos((f + 2.0) * (i + 1.0)) for f in range(K_FM)], axis=1)
    return FM.FMModel(0.05, w, v, task, min_target=0.0, max_target=1.0)


def _w(i):
    return f"0.1 * sin({i} + 1.0)"


def _v(i, f):
    return f"0.1 * cos({f + 2.0} * ({i} + 1.0))"


def _wide_sql():
    at = ["a", "b", "c"]
    s = {f: " + ".join(f"{_v(i, f)} * {x}" for i, x in zip(at, ("1.0", "1.0", "x"))) for f in range(K_FM)}
    q = {f: " + ".join(f"({_v(i, f)}) * ({_v(i, f)}) * {x} * {x}" for i, x in zip(at, ("1.0", "1.0", "x"))) for f in range(K_FM)}
    lin = " + ".join(f"{_w(i)} * {x}" for i, x in zip(at, ("1.0", "1.0", "x")))
    pair = " + ".join(f"0.5 * (s{f} * s{f} - q{f})" for f in range(K_FM))
    sums = ", ".join(f"{s[f]} as s{f}, {q[f]} as q{f}" for f in range(K_FM))
    return f"""
with r as (select l_orderkey * 8 + l_linenumber as id, l_partkey % {PARTS} as a, {PARTS} + l_suppkey % {SUPPLIERS} as b, {WIDE - 1}::bigint as c,
                  l_discount * 10.0 as x, case when l_returnflag = 'R' then 1.0 else 0.0 end as label from lineitem),
t as (select *, {lin} as lin, {sums} from r),
p as (select *, 0.05 + lin + {pair} as p from t)"""


@register("m1_fm_scoring_one_hot", _wide_sql() + """
select id, label, round(p, 6) as raw, round(1 / (1 + exp(-p)), 6) as probability, round(least(greatest(p, 0.0), 1.0), 6) as clipped from p
""")
def m1_fm_scoring_one_hot(spark, sf_dir):
    rows = wide_rows(spark, sf_dir)
    out = rows.withColumn("raw", F.round(FM.raw_score(rows, wide_fm(1)), 6))
    out = FM.predict(FM.predict(out, wide_fm(1), out="probability"), wide_fm(0), out="clipped")
    return out.select("id", "label", "raw", F.round("probability", 6).alias("probability"), F.round("clipped", 6).alias("clipped"))


@register("m1_fm_scoring_weight_table", _wide_sql() + """
select id, round(1 / (1 + exp(-p)), 6) as probability from p
""")
def m1_fm_scoring_weight_table(spark, sf_dir):
    m = wide_fm(1)
    out = FM.predict_by_join(wide_rows(spark, sf_dir), FM.weight_table(spark, m), m, out="probability")
    return out.select("id", F.round("probability", 6).alias("probability"))


def _wide_grad_sql(task):
    mult = "least(greatest(p, 0.0), 1.0) - label" if task == 0 else "-y * (1 - 1 / (1 + exp(-y * p)))"
    loss = "mult * mult" if task == 0 else "ln(1 + exp(-y * p))"
    entries = " union all ".join(f"select {i} as i, {x} as x, mult, s0, s1 from q" for i, x in (("a", "1.0"), ("b", "1.0"), ("c", "x")))
    parts = ", ".join(f"sum(mult * (x * s{f} - ({_v('i', f)}) * x * x)) as v{f}" for f in range(K_FM))
    rows = " union all ".join(f"select 'v_' || i || '_{f}', coalesce(v{f}, 0.0) from z" for f in range(K_FM))
    return _wide_sql() + f""",
y as (select *, case when label > 0 then 1.0 else -1.0 end as y from p),
q as (select *, {mult} as mult from y),
e as ({entries}),
g as (select i, sum(mult * x) as w, {parts} from e group by i),
z as (select range as i, w, v0, v1 from range({WIDE}) left join g on g.i = range)
select name, round(value, 6) as value from (
  select 'w0' as name, sum(mult) as value from q union all select 'loss', sum({loss}) from q union all select 'count', count(*) * 1.0 from q
  union all select 'w_' || i, coalesce(w, 0.0) from z union all {rows})"""


@register("m2_fm_gradient_one_hot", _wide_grad_sql(1))
def m2_fm_gradient_one_hot(spark, sf_dir):
    t = FM.gradient_table(wide_rows(spark, sf_dir), wide_fm(1))
    return t.select("name", F.round("value", 6).alias("value"))


@register("m2_fm_gradient_one_hot_regression", _wide_grad_sql(0))
def m2_fm_gradient_one_hot_regression(spark, sf_dir):
    t = FM.gradient_table(wide_rows(spark, sf_dir), wide_fm(0))
    return t.select("name", F.round("value", 6).alias("value"))


# one step of training from the fixed model: step 0.15, separate L2, switched-off parts stay ---
STEP_REG = (0.3, 0.2, 0.1)


def _step_sql(m, use_bias, use_linear):
    n, k = m.v.shape
    theta = [("w0", m.w0, STEP_REG[0])] + [(f"w_{i}", m.w[i], STEP_REG[1]) for i in range(n)] \
        + [(f"v_{i}_{f}", m.v[i, f], STEP_REG[2]) for i in range(n) for f in range(k)]
    used = FM.FMModel(m.w0 if use_bias else 0.0, m.w if use_linear else 0 * m.w, m.v, m.task)
    on = lambda nm: (use_bias or nm != "w0") and (use_linear or not nm.startswith("w_"))
    moved = " ".join(f"when '{nm}' then {float(t)!r} - {0.15 if on(nm) else 0.0} * (value / n + {r} * {float(t)!r})" for nm, t, r in theta)
    return f"""with grad as ({_grad_sql(used).replace("round(", "(").replace(", 6) as value", ") as value")}),
c as (select value as n from grad where name = 'count')
select name, round(case name {moved} end, 6) as value from grad, c where name not in ('loss', 'count')"""


def _step_rows(spark, sf_dir, use_bias, use_linear):
    m = fixed_fm(1)
    m.use_bias, m.use_linear = use_bias, use_linear
    out = FM.train_sgd(_fm_rows(spark, sf_dir), 1, K_FM, iterations=1, step=0.15, reg=STEP_REG, model=m)
    n, k = out.v.shape
    names = ["w0"] + [f"w_{i}" for i in range(n)] + [f"v_{i}_{f}" for i in range(n) for f in range(k)]
    rows = spark.createDataFrame(list(zip(names, map(float, out.flat()))), "name string, value double")
    return rows.select("name", F.round("value", 6).alias("value"))


@register("m3_fm_sgd_step", _step_sql(fixed_fm(1), True, True))
def m3_fm_sgd_step(spark, sf_dir):
    return _step_rows(spark, sf_dir, True, True)


@register("m3_fm_sgd_step_switched_off", _step_sql(fixed_fm(1), False, False))
def m3_fm_sgd_step_switched_off(spark, sf_dir):
    return _step_rows(spark, sf_dir, False, False)


@register("m3_fm_sgd_training")
def m3_fm_sgd_training(spark, sf_dir):
    hist = []
    FM.train_sgd(_fm_rows(spark, sf_dir), task=1, num_factors=4, iterations=20, step=0.15, history=hist)
    return spark.createDataFrame(hist, "iteration int, loss double")


@register("m4_fm_lbfgs_training")
def m4_fm_lbfgs_training(spark, sf_dir):
    hist = []
    FM.train_lbfgs(_fm_rows(spark, sf_dir), task=1, num_factors=4, iterations=20, history=hist)
    return spark.createDataFrame(hist, "iteration int, loss double")


@register("m5_fm_parallel_adagrad")
def m5_fm_parallel_adagrad(spark, sf_dir):
    rows = _fm_rows(spark, sf_dir)
    V = FM.train_parallel_adagrad(rows, num_factors=4, rounds=2)
    m = FM.FMModel(0.0, np.zeros(V.shape[0]), V, 1, use_bias=False, use_linear=False)
    return FM.predict(rows, m).select("id", "label", "prediction")


@register("s10_fm_model_save_load", f"""
with r as ({I.REGRESSION_SQL}), p as (select id, round(least(greatest({_RAW}, 0.0), 1.0), 6) as p from r)
select id, p as p_saved, p as p_loaded, true as same from p
""")
def s10_fm_model_save_load(spark, sf_dir):
    rows = _fm_rows(spark, sf_dir)
    m = fixed_fm(0)
    path = scratch_path(spark, "s10_fm")
    FM.save_model(spark, m, path)
    back = FM.load_model(spark, path)
    a = FM.predict(rows, m, out="p_saved")
    return FM.predict(a, back, out="p_loaded").select(
        "id", F.round("p_saved", 6).alias("p_saved"), F.round("p_loaded", 6).alias("p_loaded"),
        (F.col("p_saved") == F.col("p_loaded")).alias("same"))


# pyspark.ml jobs on the whole lineitem table ----------------------------------------
@register("m6_boosted_multiclass")
def m6_boosted_multiclass(spark, sf_dir):
    rows = I.class_rows(spark, sf_dir)
    model = J.boosted_multiclass(rows, XS, rounds=5)
    return model.transform(J._vec(rows, XS)).select("id", "label", "prediction")


@register("m7_random_forest")
def m7_random_forest(spark, sf_dir):
    from ..operators.features import first_n_formula
    from ..sources.files import save_pipeline
    rows = I.class_rows(spark, sf_dir).select("label", *XS)
    model = J.random_forest(rows, first_n_formula(rows.columns, "label", 1000), trees=10)
    save_pipeline(model, scratch_path(spark, "m7_rf"))
    return model.transform(rows).select("label", "prediction")


@register("m8_decision_tree")
def m8_decision_tree(spark, sf_dir):
    rows = I.class_rows(spark, sf_dir)
    model = J.decision_tree(rows, XS)
    tree = model.toDebugString
    return model.transform(J._vec(rows, XS)).select("id", "label", "prediction",
                                                     F.lit(len(tree.splitlines())).alias("tree_lines"))


@register("m9_linear_svm")
def m9_linear_svm(spark, sf_dir):
    rows = I.regression_rows(spark, sf_dir)
    model = J.linear_svm(rows, XS, iters=20)
    return model.transform(J._vec(rows, XS)).select("id", "label", "prediction")


@register("m10_logistic_pipeline")
def m10_logistic_pipeline(spark, sf_dir):
    rows = I.regression_rows(spark, sf_dir)
    model = J.logistic_pipeline(rows, "label ~ x0 + x1 + x2 + x3")
    return model.transform(rows).select("id", "label", "prediction")


@register("m11_kmeans_job")
def m11_kmeans_job(spark, sf_dir):
    from ..sources.files import save_pipeline
    rows = I.regression_rows(spark, sf_dir)
    model = J.kmeans(rows, XS, k=2)
    save_pipeline(model, scratch_path(spark, "m11_kmeans"))
    return model.transform(J._vec(rows, XS)).select("id", "prediction")


@register("m11_kmeans_assignment", _CENTROID_SQL + """
select id, cluster, round(distance, 6) as distance from (
  select v.id, cv.label as cluster, list_distance(v.features, cv.centroid) as distance,
         row_number() over (partition by v.id order by round(list_distance(v.features, cv.centroid), 9), cv.label) as r
  from v cross join cv) where r = 1
""")
def m11_kmeans_assignment(spark, sf_dir):
    """One assignment step: every embedding to the nearest per-label centre."""
    v = I.vectors(spark, sf_dir)
    c = class_centroids(v)
    res = J.nearest_centre(v.select("id", "features"), c, centre_id="label")
    return res.select("id", "cluster", F.round("distance", 6).alias("distance"))


@register("m12_mlp_classifier")
def m12_mlp_classifier(spark, sf_dir):
    rows = I.class_rows(spark, sf_dir)
    train, test = rows.randomSplit([0.7, 0.3], 1234)
    model = J.mlp(train, XS, [4, 3, 3, 3], iters=100)
    return model.transform(J._vec(test, XS)).select("id", "label", "prediction")


@register("m13_grid_search_cv")
def m13_grid_search_cv(spark, sf_dir):
    rows = I.regression_rows(spark, sf_dir)
    cv = J.grid_search(rows, XS, rounds=3)
    return spark.createDataFrame([(r["maxDepth"], r["stepSize"], r["avg_metric"], r["best"]) for r in J.grid_results(cv)],
                                 "depth int, eta double, avg_metric double, best boolean")


_M14_SQL = f"""
with c as ({I.CREDIT_SQL}),
z as (select *, -1.3068491709149153 + pay_0 * 0.12325947107501224 + pay_2 * 0.18065053351842655
                + pay_3 * 0.06526988375539071 + pay_4 * 0.10440956046307726 + pay_5 * 0.03271040044767765
                + pay_6 * 0.10934943733103335 as z from c),
s as (select *, 1 / (1 + exp(-z)) as p1 from z)
"""


@register("m14_regression_table_scoring", _M14_SQL + """
select l_orderkey, l_linenumber, round(p1, 6) as probability_1, round(1 - p1, 6) as probability_0,
       case when p1 > 1 - p1 then 1.0 else 0.0 end as prediction from s
""")
def m14_regression_table_scoring(spark, sf_dir):
    s = J.score_regression_table(I.credit_rows(spark, sf_dir), J.CREDIT_TABLE)
    return s.select("l_orderkey", "l_linenumber", F.round("probability_1", 6).alias("probability_1"),
                    F.round("probability_0", 6).alias("probability_0"), "prediction")


@register("e3_log_loss", _M14_SQL + """
select round(avg(-(next_month * ln(greatest(least(p1, 1 - 1e-15), 1e-15))
                   + (1 - next_month) * ln(1 - greatest(least(p1, 1 - 1e-15), 1e-15)))), 6) as log_loss,
       count(*) as n from s
""")
def e3_log_loss(spark, sf_dir):
    s = J.score_regression_table(I.credit_rows(spark, sf_dir), J.CREDIT_TABLE)
    r = ev.log_loss(s, "next_month", "probability_1")
    return r.select(F.round("log_loss", 6).alias("log_loss"), "n")


_PRED = f"with pred as ({REGISTRY_N5_SQL})"


@register("e4_per_class_stats", _PRED + """,
conf as (select label, prediction, count(*) as n from pred group by label, prediction),
tp as (select label as cls, n as tp from conf where label = prediction),
act as (select label as cls, sum(n) as actual from conf group by label),
prd as (select prediction as cls, sum(n) as predicted from conf group by prediction),
cls as (select cls from act union select cls from prd),
s as (select cls, coalesce(tp, 0) as tp, coalesce(actual, 0) as actual, coalesce(predicted, 0) as predicted
      from cls left join tp using (cls) left join act using (cls) left join prd using (cls))
select cast(cls as double) as cls, cast(tp as bigint) as tp, cast(actual as bigint) as actual,
       cast(predicted as bigint) as predicted,
       round(tp / nullif(predicted, 0), 6) as precision, round(tp / nullif(actual, 0), 6) as recall,
       round(2 * (tp / nullif(predicted, 0)) * (tp / nullif(actual, 0))
             / nullif(tp / nullif(predicted, 0) + tp / nullif(actual, 0), 0), 6) as f1
from s
""")
def e4_per_class_stats(spark, sf_dir):
    from .q_knn import n5_knn_classifier
    p = n5_knn_classifier(spark, sf_dir).select(F.col("label").cast("double").alias("label"), "prediction")
    st = ev.per_class_stats(p)
    return st.select(F.col("cls").cast("double").alias("cls"), "tp", "actual", "predicted",
                     *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register("e2_multiclass_metrics", _PRED + """,
conf as (select label, prediction, count(*) as n from pred group by label, prediction),
tp as (select label as cls, n as tp from conf where label = prediction),
act as (select label as cls, sum(n) as actual from conf group by label),
prd as (select prediction as cls, sum(n) as predicted from conf group by prediction),
cls as (select cls from act union select cls from prd),
s as (select cls, coalesce(tp, 0) as tp, coalesce(actual, 0) as actual, coalesce(predicted, 0) as predicted
      from cls left join tp using (cls) left join act using (cls) left join prd using (cls)),
m as (select *, tp / nullif(predicted, 0) as pr, tp / nullif(actual, 0) as rc from s),
m2 as (select *, 2 * pr * rc / nullif(pr + rc, 0) as f1 from m)
select round(sum(tp) / sum(actual), 6) as accuracy,
       round(sum(coalesce(pr, 0) * actual) / sum(actual), 6) as weighted_precision,
       round(sum(coalesce(rc, 0) * actual) / sum(actual), 6) as weighted_recall,
       round(sum(coalesce(f1, 0) * actual) / sum(actual), 6) as weighted_f1 from m2
""")
def e2_multiclass_metrics(spark, sf_dir):
    from .q_knn import n5_knn_classifier
    p = n5_knn_classifier(spark, sf_dir).select(F.col("label").cast("double").alias("label"), "prediction")
    m = ev.multiclass_metrics(p)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])
