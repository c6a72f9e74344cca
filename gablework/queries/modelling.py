"""Cross-validated models, tuning, predictions, explanations, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gablework.explain import summary
from gablework.explain.linear import linear_attributions
from gablework.explain.trees import explained_row, tree_attributions
from gablework.models import folds, linear, stack, trees, tune, wide
from gablework.models.graph import CrossFit
from gablework.operators import sparse
from gablework.operators.profile import describe_numeric
from gablework.queries import model_sql, tree_sql
from gablework.queries.inputs import FEATURES, SALES_SQL, TREE_FEATURES, sales
from gablework.queries.registry import neat, query, r, table
from gablework.shared import materialize, scratch_path
from gablework.sources import housing
from gablework.tracking import runs

# SQL of two-feature ridge: scaling and sums of each training set, solved for any alpha.
RIDGE_SQL = f"""
{SALES_SQL},
part AS (SELECT h.f, n, q, y FROM sales JOIN range(6) h(f) ON sales.fold <> h.f),
iqr AS (SELECT f, quantile_cont(n, 0.75) - quantile_cont(n, 0.25) AS wn, quantile_cont(q, 0.75) - quantile_cont(q, 0.25) AS wq
        FROM part GROUP BY f),
width AS (SELECT f, CASE WHEN wn = 0 THEN 1 ELSE wn END AS dn, CASE WHEN wq = 0 THEN 1 ELSE wq END AS dq FROM iqr),
mom AS (SELECT f, any_value(dn) AS dn, any_value(dq) AS dq, avg(n) AS mn, avg(q) AS mq, avg(y) AS my,
          count(*) * var_pop(n) / any_value(dn) / any_value(dn) AS a, count(*) * var_pop(q) / any_value(dq) / any_value(dq) AS c,
          count(*) * covar_pop(n, q) / any_value(dn) / any_value(dq) AS b, count(*) * covar_pop(n, y) / any_value(dn) AS p,
          count(*) * covar_pop(q, y) / any_value(dq) AS s, count(*) AS rows
        FROM part JOIN width USING (f) GROUP BY f)"""
# f = 5 leaves nothing out: the model of the whole table.


def ridge_fits(alphas: str) -> str:
    return f"""{RIDGE_SQL},
fits AS (SELECT f, alpha, mn, mq, my, dn, dq, ((c + alpha) * p - b * s) / ((a + alpha) * (c + alpha) - b * b) / dn AS wn,
           ((a + alpha) * s - b * p) / ((a + alpha) * (c + alpha) - b * b) / dq AS wq FROM mom, {alphas}),
cv AS (SELECT alpha, f AS fold, sqrt(avg(power(y - my - wn * (n - mn) - wq * (q - mq), 2))) AS rmse
       FROM sales JOIN fits ON sales.fold = fits.f GROUP BY alpha, f)"""


RIDGE_10 = ridge_fits("(SELECT 10.0 AS alpha)")


@query("cv_ridge", f"WITH {RIDGE_10} SELECT CAST(fold AS INTEGER) AS fold, {r('rmse')} AS rmse FROM cv")
def cv_ridge(spark, d):
    """Fold scores from one pass of cross-product sums; no refit."""
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    rows = linear.ridge_cv(data, FEATURES, [10.0])
    return neat(folds.score_frame(spark, [("ridge", f, v) for _, f, v in rows]).drop("model"))


@query("cv_ridge_refit", f"WITH {RIDGE_10} SELECT CAST(fold AS INTEGER) AS fold, {r('rmse')} AS rmse FROM cv")
def cv_ridge_refit(spark, d):
    """The same scores by refitting the library's regression on each training set."""
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    return neat(linear.linear_cv(data, FEATURES, 10.0, None))


def one_feature(alpha: float, l1_ratio: float) -> str:
    """Elastic net with one scaled feature in closed form: a soft threshold."""
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    return f"""{RIDGE_SQL},
en AS (SELECT f, mn, my, sign(p) * greatest(abs(p) / rows - {l1!r}, 0) / (a / rows + {l2!r}) / dn AS wn FROM mom)
SELECT CAST(fold AS INTEGER) AS fold, {r('sqrt(avg(power(y - my - wn * (n - mn), 2)))')} AS rmse
FROM sales JOIN en ON sales.fold = en.f GROUP BY fold"""


@query("cv_lasso", "WITH " + one_feature(0.05, 1.0))
def cv_lasso(spark, d):
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    return neat(linear.linear_cv(data, ["n"], 0.05, 1.0))


@query("cv_elastic_net", "WITH " + one_feature(0.05, 0.9))
def cv_elastic_net(spark, d):
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    return neat(linear.linear_cv(data, ["n"], 0.05, 0.9))


TWO_ALPHAS = ridge_fits("(VALUES (10.0), (1000.0)) t(alpha)")
MODEL_NAME = "CASE WHEN alpha = 10 THEN 'ridge' ELSE 'stiff ridge' END"


def two_ridges(spark, d):
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    names = {10.0: "ridge", 1000.0: "stiff ridge"}
    rows = linear.ridge_cv(data, FEATURES, list(names))
    return folds.score_frame(spark, [(names[a], f, v) for a, f, v in rows])


@query("cv_compare", f"""
WITH {TWO_ALPHAS} SELECT {MODEL_NAME} AS model, {r('avg(rmse)')} AS mean, {r('stddev_pop(rmse)')} AS std FROM cv GROUP BY 1""")
def cv_compare(spark, d):
    return neat(folds.compare(two_ridges(spark, d)))


@query("run_log", f"""
WITH {TWO_ALPHAS} SELECT {MODEL_NAME} AS run, CAST(CAST(alpha AS INTEGER) AS VARCHAR) AS alpha, {r('avg(rmse)')} AS rmse_mean,
  {r('stddev_pop(rmse)')} AS rmse_std FROM cv GROUP BY alpha""")
def run_log(spark, d):
    """Each model is one appended row of the run table, read back by query."""
    path = scratch_path(spark, "runs")
    runs.log_scores(spark, path, two_ridges(spark, d), {"ridge": {"alpha": 10}, "stiff ridge": {"alpha": 1000}})
    found = runs.read_runs(spark, path)
    return neat(found.select(
        "run", F.col("params")["alpha"].alias("alpha"),
        *[F.col("metrics")[m].alias(m) for m in ("rmse_mean", "rmse_std")],
    ))


TRIALS_SQL = ridge_fits("""(
  SELECT trial, exp(ln(0.1) + CAST('0x' || substr(md5('42:' || trial || ':alpha'), 1, 8) AS BIGINT) / 4294967296.0
    * (ln(100.0) - ln(0.1))) AS alpha FROM range(50) x(trial))""").replace(
    "SELECT alpha, f AS fold", "SELECT trial, alpha, f AS fold").replace(
    "SELECT f, alpha, mn", "SELECT f, trial, alpha, mn").replace("GROUP BY alpha, f)", "GROUP BY trial, alpha, f)") + """,
trials AS (SELECT 'ridge' AS study, CAST(trial AS INTEGER) AS trial, any_value(alpha) AS alpha, avg(rmse) AS value
           FROM cv GROUP BY trial)"""


def ridge_trials(spark, d):
    return tune.tune_ridge(folds.keep_folds(sales(spark, d).drop("fold"), "k"), FEATURES, tune.TRIALS["ridge"])


@query("tune_ridge", f"WITH {TRIALS_SQL} SELECT study, trial, {r('alpha')} AS alpha, {r('value')} AS value FROM trials")
def tune_ridge(spark, d):
    """Fifty trials, five folds each, from one read of the data."""
    t = ridge_trials(spark, d)
    return neat(t.select("study", "trial", F.col("params")["alpha"].alias("alpha"), "value"))


@query("best_trial", f"""
WITH {TRIALS_SQL} SELECT study, trial, {r('alpha')} AS alpha, {r('value')} AS value FROM trials ORDER BY trials.value, trial LIMIT 1""")
def best_trial(spark, d):
    b = tune.best_trial(ridge_trials(spark, d))
    return neat(b.select("study", "trial", F.col("params")["alpha"].alias("alpha"), "value"))


@query("tune_history", f"""
WITH {TRIALS_SQL} SELECT study, trial, {r('value')} AS value,
  {r('min(value) OVER (ORDER BY trial ROWS UNBOUNDED PRECEDING)')} AS best FROM trials""")
def tune_history(spark, d):
    return neat(tune.history(ridge_trials(spark, d)))


@query("tuned_vs_base", f"""
WITH {TRIALS_SQL}, base AS (SELECT f, my FROM mom WHERE f < 5),
b AS (SELECT avg(rmse) AS base FROM (SELECT sqrt(avg(power(y - my, 2))) AS rmse FROM sales JOIN base ON sales.fold = base.f GROUP BY f))
SELECT 'ridge' AS model, {r('any_value(base)')} AS base, {r('min(value)')} AS tuned,
  {r('(any_value(base) - min(value)) / any_value(base) * 100', 4)} AS improvement FROM trials, b""")
def tuned_vs_base(spark, d):
    """The best trial against the score of predicting the training mean."""
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    sums, _ = linear.fold_moments(data, FEATURES)
    whole = sum(m.gram for m in sums.values())
    scores = []
    for f, test in sums.items():
        mx, my = linear.Moments(whole - test.gram).means()
        scores.append(("ridge", f, float((test.about(mx, my)[-1, -1] / test.n) ** 0.5)))
    base = folds.compare(folds.score_frame(spark, scores)).select("model", F.col("mean").alias("rmse"))
    return neat(tune.tuned_vs_base(base, tune.tune_ridge(data, FEATURES, tune.TRIALS["ridge"])), improvement=4)


HELD_SQL = f"""{RIDGE_10}, scored AS (
  SELECT k, y, my + wn * (n - mn) + wq * (q - mq) AS pred FROM sales JOIN fits ON fits.f = 0 WHERE sales.fold = 0)"""


def held_predictions(spark, d):
    data = folds.keep_folds(sales(spark, d).drop("fold"), "k")
    fit = linear.ridge(FEATURES)(data.where(F.col("fold") != 0))
    return fit.add(data.where(F.col("fold") == 0), "pred").select("k", "y", "pred")


@query("fit_predict", f"WITH {HELD_SQL} SELECT k, {r('pred')} AS pred FROM scored")
def fit_predict(spark, d):
    """Fitted on four folds, applied to the fifth: scoring is a projection."""
    return neat(held_predictions(spark, d).drop("y"))


@query("prediction_error", f"""
WITH {HELD_SQL} SELECT k, {r('exp(y) - 1', 2)} AS actual, {r('exp(pred) - 1', 2)} AS predicted,
  {r('abs(exp(y) - exp(pred))', 2)} AS error FROM scored""")
def prediction_error(spark, d):
    return neat(summary.prediction_error(held_predictions(spark, d), "k", "y", "pred"), 2)


@query("describe_predictions", f"""
WITH {HELD_SQL}, p AS (SELECT exp(pred) - 1 AS price FROM scored)
SELECT 'price' AS "column", count(*) AS count, {r('avg(price)', 2)} AS mean, {r('stddev_samp(price)', 2)} AS std,
  {r('min(price)', 2)} AS min, {r('quantile_cont(price, 0.25)', 2)} AS q25, {r('quantile_cont(price, 0.5)', 2)} AS median,
  {r('quantile_cont(price, 0.75)', 2)} AS q75, {r('max(price)', 2)} AS max FROM p""")
def describe_predictions(spark, d):
    prices = held_predictions(spark, d).select(F.expm1("pred").alias("price"))
    return neat(describe_numeric(prices, ["price"]), 2)


# Linear attribution

SHAP_SQL = f"""{RIDGE_10}, shap AS (
  SELECT k, y, n, q, my AS base, wn * (n - mn) AS sn, wq * (q - mq) AS sq FROM sales JOIN fits ON fits.f = 5),
long AS (SELECT k, 'n' AS feature, n AS feature_value, sn AS shap FROM shap UNION ALL SELECT k, 'q', q, sq FROM shap)"""


def attributions(spark, d):
    data = materialize(sales(spark, d), "sales")
    return linear_attributions(data, linear.ridge(FEATURES)(data), "k", [*FEATURES, "y"])


@query("linear_shap", f"WITH {SHAP_SQL} SELECT k, feature, feature_value, {r('shap')} AS shap FROM long")
def linear_shap(spark, d):
    return neat(summary.to_long(attributions(spark, d), FEATURES, "k", values=True))


@query("shap_summary", f"WITH {SHAP_SQL} SELECT feature, {r('avg(abs(shap))')} AS shap_importance FROM long GROUP BY feature")
def shap_summary(spark, d):
    return neat(summary.global_importance(attributions(spark, d), FEATURES, 20))


@query("shap_deciles", f"WITH {SHAP_SQL} SELECT feature, " + ", ".join(
    f"{r(f'quantile_cont(shap, {i / 10})')} AS p{i * 10}" for i in range(11)) + " FROM long GROUP BY feature")
def shap_deciles(spark, d):
    q = summary.contribution_deciles(summary.to_long(attributions(spark, d), FEATURES, "k"))
    return neat(q.select("feature", *[F.col("quantiles")[i].alias(f"p{i * 10}") for i in range(11)]))


@query("shap_topk", f"""
WITH {SHAP_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY abs(shap) DESC, feature) AS rn FROM long)
SELECT k, CASE WHEN rn <= 1 THEN feature ELSE 'other' END AS feature, CAST(least(rn, 2) AS INTEGER) AS rank, {r('sum(shap)')} AS shap
FROM ranked GROUP BY 1, 2, 3""")
def shap_topk(spark, d):
    return neat(summary.row_breakdowns(attributions(spark, d), FEATURES, "k", 1))


@query("shap_breakdown", f"""
WITH {SHAP_SQL}, top AS (SELECT * FROM shap ORDER BY y DESC, k LIMIT 1),
l AS (SELECT long.*, row_number() OVER (ORDER BY abs(long.shap) DESC, feature) AS rn FROM long JOIN top USING (k))
SELECT 0 AS rank, 'base' AS feature, {r('base')} AS shap FROM top UNION ALL
SELECT CAST(rn AS INTEGER), feature, {r('shap')} FROM l UNION ALL SELECT 17, 'total', {r('base + sn + sq')} FROM top""")
def shap_breakdown(spark, d):
    """The dearest order, from the base value to its prediction."""
    return neat(summary.breakdown(attributions(spark, d), FEATURES, "k", "y", 15))


@query("shap_dependence", f"""
WITH {SHAP_SQL}, v AS (SELECT min(q) AS lo, max(q) AS hi FROM sales),
b AS (SELECT CAST(least(floor((q - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo AS l0, (hi - lo) / 20 AS w, sq FROM shap, v)
SELECT bin, {r('any_value(l0) + bin * any_value(w)')} AS lo, {r('any_value(l0) + bin * any_value(w) + any_value(w)')} AS hi,
  count(*) AS count, {r('avg(sq)')} AS mean_shap FROM b GROUP BY bin""")
def shap_dependence(spark, d):
    return neat(summary.dependence(attributions(spark, d), FEATURES, "q", 20))


# Trees and stacking. The comparison, stacking, the submissions and the study of ``tune_boosted`` use the parameter sets of ``models.trees`` and
# ``models.tune`` as they are, the other queries these with fewer trees; the SQL grows the same trees level by level. The features have few
# values, so that every value is a bin.

BINS = 1024
BOOST = {"n_estimators": 5}
XGB = {**trees.DEPTH_WISE, **BOOST}
LGB = {**trees.LEAF_WISE, **BOOST}
FOREST = {**trees.FOREST, "n_estimators": 20}
WIDTH = len(TREE_FEATURES)


def boosted(params, style="depth"):
    return trees.boosted(TREE_FEATURES, params, style=style, key="k", bins=BINS)


def forest_model(params=FOREST):
    return trees.forest(TREE_FEATURES, params, key="k", bins=BINS)


def steps_of(name: str, params: dict, style: str, rows: str = "rows0") -> list[tuple[str, str]]:
    return tree_sql.ensemble(name, trees.plan_of(name, params, style), rows, WIDTH)


def whole_boosted(names: dict[str, tuple[dict, str]], rows: str = "rows0") -> list[tuple[str, str]]:
    """Steps of ensembles of any number of trees, grown in one recursion: {step: (parameters, style)}."""
    every = "_".join(names)
    plans = [trees.plan_of(n, params, style) for n, (params, style) in names.items()]
    return [*tree_sql.boosted_together(every, plans, rows, WIDTH), *((n, f"SELECT f, k, pred FROM {every} WHERE m = {m}") for m, n in enumerate(names))]


WHOLE_BOOSTED = {"m_xgb": (trees.DEPTH_WISE, "depth"), "m_lgb": (trees.LEAF_WISE, "leaf")}
FOLD_ROWS = ("rows0", "SELECT s.f, k, y, fold, fold <> s.f AS train, n AS x0, q AS x1, band AS x2 FROM sales, range(5) s(f)")
WHOLE_ROWS = ("rows0", "SELECT 5 AS f, k, y, fold, TRUE AS train, n AS x0, q AS x1, band AS x2 FROM sales")


def nested_rows(lo: int, hi: int) -> tuple[str, str]:
    return "rows0", model_sql.NESTED.format(lo=lo, hi=hi)


def cv_sql(models: dict[str, str], f: str = "r.f = r.fold") -> str:
    """(model, fold, rmse) from steps that give (f, k, pred)."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS model, CAST(r.fold AS INTEGER) AS fold, {r('sqrt(avg(power(r.y - p.pred, 2)))')} AS rmse FROM rows0 r JOIN {step} p ON p.f = r.f AND p.k = r.k WHERE {f} GROUP BY r.fold"
        for name, step in models.items()
    )


def with_sales(steps) -> str:
    return f"WITH {SALES_SQL}, {tree_sql.with_steps(steps)} "


def folded(spark, d):
    return folds.keep_folds(sales(spark, d).drop("fold"), "k")


@query("cv_random_forest", with_sales([FOLD_ROWS, *steps_of("forest", FOREST, "forest")]) + cv_sql({"forest": "forest"}))
def cv_random_forest(spark, d):
    """Twenty trees of depth 15 for each of five training sets, grown level by level in the same passes."""
    return neat(CrossFit(folded(spark, d), {"forest": forest_model()}, "k").scores())


@query("cv_boosted", with_sales([FOLD_ROWS, *steps_of("xgb", XGB, "depth"), *steps_of("lgb", LGB, "leaf")]) + cv_sql({"xgb": "xgb", "lgb": "lgb"}))
def cv_boosted(spark, d):
    """Both styles and all folds share the passes."""
    return neat(CrossFit(folded(spark, d), {"xgb": boosted(XGB), "lgb": boosted(LGB, "leaf")}, "k").scores())


def four_bases():
    return {
        "ridge": linear.ridge(FEATURES), "lasso": linear.lasso(["n"], 0.0005),
        "xgb": boosted(trees.STACKED_DEPTH_WISE), "lgb": boosted(trees.STACKED_LEAF_WISE, "leaf"),
    }


BASE_STEPS = [
    *model_sql.ridge("s_ridge", "rows0", 2, 10.0), *model_sql.one_feature("s_lasso", "rows0", 0.0005, 1.0),
    *whole_boosted({"s_xgb": (trees.STACKED_DEPTH_WISE, "depth"), "s_lgb": (trees.STACKED_LEAF_WISE, "leaf")}),
    *model_sql.stacked("stacking", "rows0", ["s_ridge", "s_lasso", "s_xgb", "s_lgb"], 10.0),
]
FIRST = [nested_rows(0, 1), *BASE_STEPS]


@query("stacking", with_sales(FIRST) + f"SELECT r.k, {r('r.y')} AS y, {r('p.pred')} AS pred FROM rows0 r JOIN stacking p USING (f, k) WHERE r.fold = 0 AND r.f = 0")
def stacking(spark, d):
    """Out-of-fold base predictions (five inner folds) under a ridge; fitted on four folds, scored on the fifth."""
    found = CrossFit(folded(spark, d), {"pred": stack.stacking(four_bases(), "k")}, "k", held=[0])
    return neat(found.out_of_fold().select("k", "y", "pred"))


LINEAR_BASES = {"ridge": linear.ridge(FEATURES), "lasso": linear.lasso(["n"], 0.05)}
LINEAR_STEPS = [
    nested_rows(0, 5), *model_sql.ridge("b_ridge", "rows0", 2, 10.0), *model_sql.one_feature("b_lasso", "rows0", 0.05, 1.0),
    *model_sql.stacked("stacking", "rows0", ["b_ridge", "b_lasso"], 10.0),
]
OUTER = "r.o = r.fold AND r.f = r.o * 10"


@query("cv_stacking", with_sales(LINEAR_STEPS) + cv_sql({"ridge": "b_ridge", "lasso": "b_lasso", "stacking": "stacking"}, OUTER))
def cv_stacking(spark, d):
    """Five outer and five inner folds: thirty training sets of each base from one pass of sums."""
    models = {**LINEAR_BASES, "stacking": stack.stacking(LINEAR_BASES, "k")}
    return neat(CrossFit(folded(spark, d), models, "k").scores())


SEVEN_STEPS = [
    nested_rows(0, 5), ("outer0", "SELECT * FROM rows0 WHERE f % 10 = 0"),
    *model_sql.one_feature("m_elastic", "outer0", 0.0005, 0.9),
    *tree_sql.forest_of_any_size("m_forest", trees.plan_of("m_forest", trees.FOREST, "forest"), "outer0", WIDTH),
    *whole_boosted(WHOLE_BOOSTED, "outer0"), *BASE_STEPS,
]
SEVEN = {"ridge": "s_ridge", "lasso": "s_lasso", "elastic_net": "m_elastic", "forest": "m_forest", "xgb": "m_xgb", "lgb": "m_lgb", "stacking": "stacking"}


@query("cv_compare_all", with_sales(SEVEN_STEPS) + f"""SELECT model, {r('avg(score)')} AS mean, {r('stddev_pop(score)')} AS std FROM (
{cv_sql(SEVEN, OUTER).replace(' AS rmse', ' AS score').replace(r('sqrt(avg(power(r.y - p.pred, 2)))'), 'sqrt(avg(power(r.y - p.pred, 2)))')}) GROUP BY model""")
def cv_compare_all(spark, d):
    """Seven models, cross-validated; a fit that stacking and the comparison both need is made once."""
    bases = four_bases()
    models = {
        "ridge": bases["ridge"], "lasso": bases["lasso"], "elastic_net": linear.elastic_net(["n"]), "forest": forest_model(trees.FOREST),
        "xgb": boosted(trees.DEPTH_WISE), "lgb": boosted(trees.LEAF_WISE, "leaf"), "stacking": stack.stacking(bases, "k"),
    }
    return neat(folds.compare(CrossFit(folded(spark, d), models, "k").scores()))


FINAL = [*FIRST, ("outer0", "SELECT * FROM rows0 WHERE f = 0"), *whole_boosted(WHOLE_BOOSTED, "outer0")]
FIVE = {"ridge": "s_ridge", "lasso": "s_lasso", "xgb": "m_xgb", "lgb": "m_lgb", "stacking": "stacking"}


def blend_sql(weights: dict[str, float], steps: dict[str, str]) -> str:
    total = " + ".join(f"{w!r} * {m}.pred" for m, w in weights.items())
    joins = " ".join(f"JOIN {steps[m]} {m} ON {m}.f = r.f AND {m}.k = r.k" for m in weights)
    return f"SELECT r.k, {r(f'exp({total}) - 1', 2)} AS price FROM rows0 r {joins} WHERE r.fold = 0 AND r.f = 0"


@query("final_submission", with_sales(FINAL) + blend_sql(folds.BLEND_FIVE, FIVE))
def final_submission(spark, d):
    """Five models fitted on the training rows, their predictions for the others blended and brought back to prices."""
    bases = four_bases()
    models = {"ridge": bases["ridge"], "lasso": bases["lasso"], "xgb": boosted(trees.DEPTH_WISE), "lgb": boosted(trees.LEAF_WISE, "leaf"), "stacking": stack.stacking(bases, "k")}
    scored = CrossFit(folded(spark, d), models, "k", held=[0]).out_of_fold().withColumn("price", folds.blend(folds.BLEND_FIVE))
    return neat(housing.submission(scored, "k", F.col("price"), "price"), 2)


# Tuning

FEW_TREES = {"n_estimators": tune.Range(2, 4, whole=True)}
LEAF_TRIALS = {**tune.LEAF_SPACE, **FEW_TREES, "max_depth": tune.Range(3, 5, whole=True)}
TRIALS = 6


def trial_steps(study: str, space: dict, style: str, rows: str = "rows0") -> list[tuple[str, str]]:
    steps = []
    for t in range(TRIALS):
        params = {**tune.params_at(space, 42, t), "random_state": 42}
        steps += steps_of(f"{study}{t}", params, style, rows)
    return steps


def trials_sql(study: str) -> str:
    scores = cv_sql({f"{study}{t}": f"{study}{t}" for t in range(TRIALS)}).replace(r("sqrt(avg(power(r.y - p.pred, 2)))"), "sqrt(avg(power(r.y - p.pred, 2)))")
    return f"SELECT '{study}' AS study, CAST(substr(model, {len(study) + 1}) AS INTEGER) AS trial, avg(rmse) AS value FROM ({scores}) GROUP BY model"


def whole_study(study: str, space: dict, style: str) -> list[tuple[str, str]]:
    """All trials in one recursion; the last step, ``study``, gives (m, f, k, pred), m the trial."""
    plans = [trees.plan_of(study, {**tune.params_at(space, 42, t), "random_state": 42}, style) for t in range(tune.TRIALS[study])]
    return tree_sql.boosted_together(study, plans, "rows0", WIDTH)


WHOLE_TRIALS = """SELECT 'xgb' AS study, CAST(m AS INTEGER) AS trial, avg(rmse) AS value FROM (
  SELECT m, r.fold, sqrt(avg(power(r.y - p.pred, 2))) AS rmse FROM rows0 r JOIN xgb p ON p.f = r.f AND p.k = r.k WHERE r.f = r.fold GROUP BY ALL) GROUP BY ALL"""


def boosted_trials(spark, d, study: str, n: int, space: dict, style: str):
    return tune.tune_boosted(folded(spark, d), TREE_FEATURES, study, n, space, style, key="k", bins=BINS)


@query("tune_boosted", with_sales([FOLD_ROWS, *whole_study("xgb", tune.DEPTH_SPACE, "depth"), ("trials", WHOLE_TRIALS)]) + f"""
SELECT study, trial, {r('value')} AS value, {r('min(value) OVER (ORDER BY trial ROWS UNBOUNDED PRECEDING)')} AS best FROM trials""")
def tune_boosted(spark, d):
    """A hundred trials of a hundred to a thousand trees, for five training sets each."""
    return neat(tune.history(boosted_trials(spark, d, "xgb", tune.TRIALS["xgb"], tune.DEPTH_SPACE, "depth")))


@query("tune_leaf_wise", with_sales([FOLD_ROWS, *trial_steps("lgb", LEAF_TRIALS, "leaf"), ("trials", trials_sql("lgb"))]) + f"""
SELECT study, trial, {r('value')} AS value FROM trials ORDER BY trials.value, trial LIMIT 1""")
def tune_leaf_wise(spark, d):
    return neat(tune.best_trial(boosted_trials(spark, d, "lgb", TRIALS, LEAF_TRIALS, "leaf")).drop("params"))


# Attribution of the boosted model of the whole table

SHAPLEY_TREES = [f"m_g{t}" for t in range(XGB["n_estimators"])]
SHAPLEY = [WHOLE_ROWS, *steps_of("m", XGB, "depth"), *model_sql.leaves("leaf", XGB["max_depth"], SHAPLEY_TREES, WIDTH)]


def shapley(background: bool):
    return [*SHAPLEY, *model_sql.attributed("shap", "rows0", "leaf", WIDTH, XGB["learning_rate"], background)]


def shapley_rows(background: bool) -> str:
    columns = ", ".join(f"{r(f'shap{i}')} AS shap_{c}" for i, c in enumerate(TREE_FEATURES))
    return with_sales(shapley(background)) + f"SELECT shap.k, {r('paid + base')} AS base, {columns}, {r('m.pred')} AS pred FROM shap JOIN m USING (f, k) JOIN m_base USING (f)"


def boosted_fit(spark, d):
    data = materialize(sales(spark, d), "sales")
    return data, boosted(XGB)(data)


def with_prediction(found, fit):
    parts = [F.col("contributions")[i].alias(f"shap_{c}") for i, c in enumerate(TREE_FEATURES)]
    return neat(fit.add(found, "pred").select("k", "base", *parts, "pred"))


@query("tree_shap", shapley_rows(False))
def tree_shap(spark, d):
    """Contributions of every row, beside the prediction they add up to."""
    data, fit = boosted_fit(spark, d)
    return with_prediction(tree_attributions(data, fit, "k", TREE_FEATURES), fit)


@query("tree_shap_background", shapley_rows(True))
def tree_shap_background(spark, d):
    """The same against the whole table as background."""
    data, fit = boosted_fit(spark, d)
    return with_prediction(tree_attributions(data, fit, "k", TREE_FEATURES, data), fit)


GAINS = " UNION ALL ".join(f"SELECT feature, gain FROM {t}_b{i}" for t in SHAPLEY_TREES for i in range(XGB["max_depth"]))


@query("importance_compare", with_sales(shapley(False)) + f""", gains AS (SELECT feature, avg(gain) AS gain FROM ({GAINS}) GROUP BY feature),
sides AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, (SELECT avg(abs(shap{i})) FROM shap) AS s, coalesce((SELECT gain FROM gains WHERE feature = {i}), 0) AS g" for i, c in enumerate(TREE_FEATURES))})
SELECT feature, {r('s')} AS shap_importance, CAST(row_number() OVER (ORDER BY s DESC, feature) AS INTEGER) AS shap_rank,
  {r('g / sum(g) OVER ()')} AS importance, CAST(row_number() OVER (ORDER BY g DESC, feature) AS INTEGER) AS builtin_rank FROM sides""")
def importance_compare(spark, d):
    """Attribution and built-in importance of the same model, side by side."""
    data, fit = boosted_fit(spark, d)
    shares = summary.global_importance(tree_attributions(data, fit, "k"), TREE_FEATURES)
    return neat(summary.compare_importance(shares, trees.importance(fit, spark)))


@query("shap_interaction", with_sales(shapley(False)) + f""", v AS (SELECT min(x0) AS lo, max(x0) AS hi FROM rows0),
b AS (SELECT CAST(least(floor((x0 - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, x1, x2, shap0 FROM shap JOIN rows0 USING (f, k), v),
e AS (SELECT x1, x2, shap0 - avg(shap0) OVER (PARTITION BY bin) AS e FROM b),
c AS (SELECT '{TREE_FEATURES[1]}' AS "column", corr(x1, e) AS r FROM e UNION ALL SELECT '{TREE_FEATURES[2]}', corr(x2, e) FROM e)
SELECT "column", {r('r')} AS r, {r('abs(r)')} AS abs_r FROM c""")
def shap_interaction(spark, d):
    data, fit = boosted_fit(spark, d)
    found = tree_attributions(data, fit, "k", TREE_FEATURES)
    return neat(summary.interaction_partner(materialize(found, "shap"), TREE_FEATURES, "n"))


@query("shap_dependence_coloured", with_sales(shapley(False)) + f""", v AS (SELECT min(x0) AS lo, max(x0) AS hi FROM rows0),
b AS (SELECT CAST(least(floor((x0 - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo AS l0, (hi - lo) / 20 AS w, x1, x2, shap0 FROM shap JOIN rows0 USING (f, k), v),
e AS (SELECT x1, x2, shap0 - avg(shap0) OVER (PARTITION BY bin) AS e FROM b),
c AS (SELECT abs(corr(x1, e)) >= abs(corr(x2, e)) AS first FROM e)
SELECT bin, {r('any_value(l0) + bin * any_value(w)')} AS lo, {r('any_value(l0) + bin * any_value(w) + any_value(w)')} AS hi, count(*) AS count,
  {r('avg(shap0)')} AS mean_shap, any_value(CASE WHEN first THEN '{TREE_FEATURES[1]}' ELSE '{TREE_FEATURES[2]}' END) AS colour,
  {r('avg(CASE WHEN first THEN x1 ELSE x2 END)')} AS mean_colour FROM b, c GROUP BY bin""")
def shap_dependence_coloured(spark, d):
    """A dependence plot's data with the colour that explains most of what the feature leaves open."""
    data, fit = boosted_fit(spark, d)
    found = tree_attributions(data, fit, "k", TREE_FEATURES)
    return neat(summary.coloured_dependence(materialize(found, "shap"), TREE_FEATURES, "n", 20))


@query("tree_breakdown", with_sales(shapley(True)) + f""", top AS (SELECT * FROM shap JOIN rows0 USING (f, k) JOIN m_base USING (f) ORDER BY y DESC, k LIMIT 1),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, shap{i} AS s FROM top" for i, c in enumerate(TREE_FEATURES))})
SELECT 0 AS rank, 'base' AS feature, {r('paid + base')} AS shap FROM top UNION ALL
SELECT CAST(row_number() OVER (ORDER BY abs(s) DESC, feature) AS INTEGER), feature, {r('s')} FROM l UNION ALL
SELECT 17, 'total', {r('paid + base + ' + ' + '.join(f'shap{i}' for i in range(WIDTH)))} FROM top""")
def tree_breakdown(spark, d):
    """The dearest order alone, explained against the whole table."""
    data, fit = boosted_fit(spark, d)
    one = explained_row(data, fit, "k", "y", data)
    return neat(summary.breakdown(one, TREE_FEATURES, "k", "y", 15))


# The tuned chain: studies on the training rows, refits with the best parameters, the second blend.

TUNED_STEPS = [
    nested_rows(0, 1), *whole_study("xgb", tune.DEPTH_SPACE, "depth"), *whole_study("lgb", tune.LEAF_SPACE, "leaf"),
    ("r_d", "SELECT f, quantile_cont(x0, 0.75) - quantile_cont(x0, 0.25) AS d0, quantile_cont(x1, 0.75) - quantile_cont(x1, 0.25) AS d1 FROM rows0 WHERE train GROUP BY f"),
    ("r_m", """SELECT f, avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my, any_value(d0) AS d0, any_value(d1) AS d1, count(*) * var_pop(x0) / any_value(d0) / any_value(d0) AS a,
  count(*) * covar_pop(x0, x1) / any_value(d0) / any_value(d1) AS b, count(*) * var_pop(x1) / any_value(d1) / any_value(d1) AS c,
  count(*) * covar_pop(x0, y) / any_value(d0) AS p, count(*) * covar_pop(x1, y) / any_value(d1) AS s FROM rows0 JOIN r_d USING (f) WHERE train GROUP BY f"""),
    ("r_w", """SELECT f, trial, m0, m1, my, ((c + alpha) * p - b * s) / ((a + alpha) * (c + alpha) - b * b) / d0 AS w0,
  ((a + alpha) * s - b * p) / ((a + alpha) * (c + alpha) - b * b) / d1 AS w1 FROM r_m, (SELECT trial, exp(ln(0.1) + CAST('0x' || substr(md5('42:' || trial || ':alpha'), 1, 8) AS BIGINT) / 4294967296.0
  * (ln(100.0) - ln(0.1))) AS alpha FROM range(50) x(trial))"""),
    ("every", " UNION ALL ".join(
        f"SELECT '{s}' AS study, m AS trial, f, k, pred FROM {s}" for s in ("xgb", "lgb")
    ) + " UNION ALL SELECT 'ridge', trial, r.f, r.k, my + w0 * (x0 - m0) + w1 * (x1 - m1) FROM rows0 r JOIN r_w USING (f)"),
    ("scored", """SELECT study, trial, avg(e) AS value FROM (SELECT study, trial, r.f, sqrt(avg(power(y - pred, 2))) AS e FROM every e JOIN rows0 r ON r.f = e.f AND r.k = e.k
  WHERE r.f > 0 AND fold <> 0 AND inner_fold = r.f - 1 GROUP BY ALL) GROUP BY ALL"""),
    ("best", "SELECT study, trial FROM scored QUALIFY row_number() OVER (PARTITION BY study ORDER BY value, trial) = 1"),
    ("refit", "SELECT study, k, pred FROM every JOIN best USING (study, trial) WHERE f = 0"),
]


@query("submission_tuned", with_sales(TUNED_STEPS) + f"""
SELECT r.k, {r("exp(" + " + ".join(f"{w!r} * max(pred) FILTER (study = '{m}')" for m, w in folds.BLEND_TUNED.items()) + ") - 1", 2)} AS price
FROM refit JOIN rows0 r ON r.k = refit.k AND r.f = 0 WHERE r.fold = 0 GROUP BY r.k""")
def submission_tuned(spark, d):
    """Three studies on the training rows, each model refitted with its best parameters, blended 0.2 / 0.4 / 0.4."""
    data = folded(spark, d)
    train = folds.keep_folds(data.where(F.col("fold") != 0), "k", seed=43, name="inner")
    best = {"ridge": tune.best_trial(tune.tune_ridge(train, FEATURES, tune.TRIALS["ridge"], fold="inner")).first()["params"]}
    for study, space, style in (("xgb", tune.DEPTH_SPACE, "depth"), ("lgb", tune.LEAF_SPACE, "leaf")):
        found = tune.tune_boosted(train, TREE_FEATURES, study, tune.TRIALS[study], space, style, fold="inner", key="k", bins=BINS)
        best[study] = {**tune.best_trial(found).first()["params"], "random_state": 42}
    models = {"ridge": linear.ridge(FEATURES, best["ridge"]["alpha"]), "lgb": boosted(best["lgb"], "leaf"), "xgb": boosted(best["xgb"])}
    scored = CrossFit(data, models, "k", held=[0]).out_of_fold().withColumn("price", folds.blend(folds.BLEND_TUNED))
    return neat(housing.submission(scored, "k", F.col("price"), "price"), 2)


TUNED_XGB, TUNED_LGB = {**trees.TUNED_DEPTH_WISE, **BOOST}, {**trees.TUNED_LEAF_WISE, **BOOST, "max_depth": 5}
LOGGED = [FOLD_ROWS, *model_sql.ridge("Ridge_baseline", "rows0", 2, 10.0), *steps_of("XGBoost_tuned", TUNED_XGB, "depth"), *steps_of("LightGBM_tuned", TUNED_LGB, "leaf")]


@query("run_log_all", with_sales(LOGGED) + f"""SELECT model AS run, CAST(CASE model WHEN 'Ridge_baseline' THEN 1 WHEN 'XGBoost_tuned' THEN {len(TUNED_XGB)} ELSE {len(TUNED_LGB)} END AS INTEGER) AS params,
  {r('avg(score)')} AS rmse_mean, {r('stddev_pop(score)')} AS rmse_std FROM (
{cv_sql({m: m for m in ('Ridge_baseline', 'XGBoost_tuned', 'LightGBM_tuned')}).replace(' AS rmse', ' AS score').replace(r('sqrt(avg(power(r.y - p.pred, 2)))'), 'sqrt(avg(power(r.y - p.pred, 2)))')}) GROUP BY model""")
def run_log_all(spark, d):
    """The tuned boosters and the base line as rows of the run table."""
    params = {"Ridge_baseline": {"alpha": 10}, "XGBoost_tuned": TUNED_XGB, "LightGBM_tuned": TUNED_LGB}
    models = {"Ridge_baseline": linear.ridge(FEATURES), "XGBoost_tuned": boosted(TUNED_XGB), "LightGBM_tuned": boosted(TUNED_LGB, "leaf")}
    path = scratch_path(spark, "runs")
    runs.log_scores(spark, path, CrossFit(folded(spark, d), models, "k").scores(), params)
    found = runs.read_runs(spark, path)
    return neat(found.select("run", F.size("params").alias("params"), *[F.col("metrics")[m].alias(m) for m in ("rmse_mean", "rmse_std")]))


HALF_UP = "CAST('0x' || substr(md5('42:' || o_orderkey || ':{p}'), 1, 8) AS BIGINT) / 4294967296.0"


def sampled_sql(p: str, space) -> str:
    u = HALF_UP.format(p=p)
    if space.log:
        return f"exp(ln({space.low!r}) + {u} * (ln({space.high!r}) - ln({space.low!r})))"
    return f"CAST(floor({space.low!r} + {u} * {space.high - space.low + 1!r}) AS DOUBLE)" if space.whole else f"{space.low!r} + {u} * {space.high - space.low!r}"


@query("sampled_params", "SELECT o_orderkey AS trial, " + ", ".join(f"{r(sampled_sql(p, s))} AS {p}" for p, s in tune.LEAF_SPACE.items()) + " FROM orders")
def sampled_params(spark, d):
    """Whole, uniform and logarithmic ranges of a search space, one point per order."""
    found = tune.sampled_params(tune.LEAF_SPACE, 42, F.col("o_orderkey"))
    return neat(table(spark, d, "orders").select(F.col("o_orderkey").alias("trial"), *[v.cast("double").alias(p) for p, v in found.items()]))


@query("cv_ridge_sparse", f"""WITH {SALES_SQL}, s AS (SELECT sales.*, o_custkey AS c FROM sales JOIN orders ON k = o_orderkey),
a AS (SELECT alpha FROM (VALUES (1.0), (30.0)) t(alpha)), t AS (SELECT h.f, alpha, c, count(*) AS n, avg(y) AS m FROM s, range(5) h(f), a WHERE fold <> h.f GROUP BY ALL),
b AS (SELECT f, alpha, sum(n * alpha / (n + alpha) * m) / sum(n * alpha / (n + alpha)) AS b FROM t GROUP BY ALL),
w AS (SELECT t.f, t.alpha, c, n * (m - b) / (n + t.alpha) AS w FROM t JOIN b ON b.f = t.f AND b.alpha = t.alpha)
SELECT CAST(b.alpha AS DOUBLE) AS alpha, CAST(fold AS INTEGER) AS fold, {r('sqrt(avg(power(y - b.b - coalesce(w.w, 0), 2)))')} AS rmse
FROM s JOIN b ON b.f = s.fold LEFT JOIN w ON w.f = s.fold AND w.alpha = b.alpha AND w.c = s.c GROUP BY b.alpha, fold""")
def cv_ridge_sparse(spark, d):
    """One place per customer: thousands of features as sparse rows, solved by conjugate gradients."""
    names = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("string").alias("customer"))
    data = materialize(sales(spark, d).join(names, "k"), "sales")
    encoder = sparse.SparseEncoder.fit(data, ["customer"])
    return neat(wide.wide_ridge_cv(encoder.transform(data), encoder.width, [1.0, 30.0]))
