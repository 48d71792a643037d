"""Splits, regression, diagnostics, selection and classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions.words import word_array
from loomstat.operators import classify, clean, depths, diagnostics, evaluate, linear, selection, topics
from loomstat.operators.clean import Attr
from loomstat.operators.gram import gram, gram_cells, gram_table, grams
from loomstat.operators.logistic import LogitBatch
from loomstat.plans.catalog import STOP_WORDS, query, rounded, table
from loomstat.plans.clean_queries import HASH_SQL, KEYS, line_key
from loomstat.sources.tables import keep_packed, spread_rows

X = ["l_quantity", "l_discount", "l_tax"]
Y = "l_extendedprice"
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Target of the many-column models: what the customer pays. It depends on
# price, discount and tax and not on the other columns.
NET = "net_price"
DESIGN_MAP = {
    NET: Attr("interval", (0.0, 1e9)),
    Y: Attr("interval", (0.0, 1e9)),
    "l_quantity": Attr("interval", (0.0, 100.0)),
    "l_discount": Attr("interval", (0.0, 1.0)),
    "l_tax": Attr("interval", (0.0, 1.0)),
    "l_linenumber": Attr("nominal", tuple(range(1, 8))),
    "l_returnflag": Attr("nominal", ("A", "N", "R")),
    "l_linestatus": Attr("binary", ("F", "O")),
}


def _lines(spark, d):
    return table(spark, d, "lineitem")


def _split_lines(spark, d):
    return evaluate.split_train_valid(_lines(spark, d), line_key(), seed=7)


def _design(spark, d):
    """Encoded line items with their split: 13 input columns."""
    rows = _split_lines(spark, d).withColumn(NET, F.col(Y) * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
    cleaner = clean.TableCleaner(DESIGN_MAP, no_impute=[NET], keep=["split"])
    cleaner.fit(rows.filter("split = 'train'"))
    return cleaner.transform(rows), cleaner.features()


SPLIT_SQL = f"CASE WHEN {HASH_SQL} THEN 'train' ELSE 'valid' END"


@query(f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {SPLIT_SQL} AS split FROM lineitem")
def m1_split_70_30(spark, d):
    return _split_lines(spark, d).select(*KEYS, "split")


FOLD_HASH = "((o_orderkey % 1000000007) * 2654435761 + 3) % 2147483647"


@query(
    f"""SELECT o_orderkey, o_orderstatus,
        (row_number() OVER (PARTITION BY o_orderstatus ORDER BY {FOLD_HASH}, o_orderkey) - 1) % 5 AS fold FROM orders"""
)
def m2_kfold_stratified(spark, d):
    folds = evaluate.kfold(table(spark, d, "orders"), "o_orderkey", 5, stratify="o_orderstatus", seed=3)
    return folds.select("o_orderkey", "o_orderstatus", "fold")


@query(f"SELECT o_orderkey, {FOLD_HASH} % 10 AS fold FROM orders")
def m2_kfold_plain(spark, d):
    return evaluate.kfold(table(spark, d, "orders"), "o_orderkey", 10, seed=3).select("o_orderkey", "fold")


def _gram_sql() -> str:
    names = {"const": "1.0", **{c: c for c in [*X, Y]}}
    cells = [(a, b) for i, a in enumerate(names) for b in list(names)[i:]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row_term, '{b}' AS col_term, round(sum(CAST({names[a]} AS DOUBLE) * {names[b]}) / count(*), 4) AS value FROM lineitem"
        for a, b in cells
    )


@query(_gram_sql())
def m3_gram(spark, d):
    """Cross products, shown per row so that sums in any order print alike."""
    lines = _lines(spark, d)
    n = lines.agg(F.count(F.lit(1))).scalar()
    return rounded(gram_table(lines, X, Y).withColumn("value", F.col("value") / n), 4)


# Twelve columns, more than one aggregate takes: the matrix products of Arrow batches serve them.
WIDE = {
    "quantity": "l_quantity", "discount": "l_discount", "tax": "l_tax", "line": "l_linenumber", "supplier": "l_suppkey", "part": "l_partkey % 100",
    "cut": "l_quantity * l_discount", "paid": "l_quantity * l_tax", "kept": "CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END",
    "returned": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", "open": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END", "price": "l_extendedprice / 1000",
}


def _wide_gram_sql() -> str:
    names = ["const", *WIDE]
    cells = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items())
    sums = ", ".join(f"sum({a} * {b}) / (count(*) + 1) AS v{i}" for i, (a, b) in enumerate(cells))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS row_term, '{b}' AS col_term, round(v{i}, 5) + 0.0 AS value FROM s" for i, (a, b) in enumerate(cells))
    return f"WITH w AS (SELECT CAST(1 AS DOUBLE) AS const, {columns} FROM lineitem), s AS (SELECT {sums} FROM w) {rows}"


@query(_wide_gram_sql())
def m3_gram_wide(spark, d):
    """Cross products of twelve columns over rows plus one, an odd number by which no value falls between two roundings."""
    lines = _lines(spark, d).select(*[F.expr(e).cast("double").alias(c) for c, e in WIDE.items()])
    g = gram(lines, [c for c in WIDE if c != "price"], "price")
    return rounded(gram_cells(spark, g).withColumn("value", F.col("value") / (g.n + 1)), 5).withColumn("value", F.col("value") + F.lit(0.0))


@query(
    """WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
            regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
        e AS (SELECT *, (syy - b * b * sxx) / (n - 2) AS mse FROM s)
        SELECT 'const' AS term, round(a, 4) AS coef, round(sqrt(mse * (1.0 / n + mx * mx / sxx)), 6) AS std_err, round(a / sqrt(mse * (1.0 / n + mx * mx / sxx)), 4) AS t FROM e
        UNION ALL SELECT 'l_quantity', round(b, 4), round(sqrt(mse / sxx), 6), round(b / sqrt(mse / sxx), 4) FROM e"""
)
def m4_ols_one(spark, d):
    fit = linear.ols(_lines(spark, d), Y, ["l_quantity"])
    out = linear.coefficient_table(spark, fit)
    return out.select("term", F.round("coef", 4).alias("coef"), F.round("std_err", 6).alias("std_err"), F.round("t", 4).alias("t"))


@query(
    """WITH s AS (SELECT CAST(count(*) AS DOUBLE) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
            regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem),
        e AS (SELECT *, syy - b * b * sxx AS sse FROM s),
        l AS (SELECT *, -n / 2 * (ln(2 * pi()) + 1 + ln(sse / n)) AS ll FROM e)
        SELECT CAST(n AS BIGINT) AS n, CAST(n - 2 AS BIGINT) AS df_error, round(1 - sse / syy, 8) AS r2, round(1 - sse / syy * (n - 1) / (n - 2), 8) AS adj_r2,
               round((syy - sse) / (sse / (n - 2)), 2) AS f, round(ll, 2) AS ll, round(-2 * ll + 6, 2) AS aic, round(-2 * ll + 6 + 24 / (n - 4), 2) AS aicc,
               round(-2 * ll + 3 * ln(n), 2) AS bic FROM l"""
)
def m4_fit_summary(spark, d):
    s = linear.fit_summary(spark, linear.ols(_lines(spark, d), Y, ["l_quantity"]))
    digits = {"r2": 8, "adj_r2": 8, "f": 2, "ll": 2, "aic": 2, "aicc": 2, "bic": 2}
    return s.select("n", "df_error", *[F.round(c, k).alias(c) for c, k in digits.items()])


@query()
def m4_ols_full(spark, d):
    """All encoded columns, with standard errors, t, p and limits."""
    rows, xs = _design(spark, d)
    return linear.coefficient_table(spark, linear.ols(rows.filter("split = 'train'"), NET, xs))


RESID_SQL = """f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, count(*) AS n,
        avg(l_quantity) AS mx, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem),
    g AS (SELECT *, (syy - b * b * sxx) / (n - 2) AS mse FROM f)"""


@query(
    """WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders),
        e AS (SELECT o_orderkey, o_totalprice - a - b * o_custkey AS e FROM orders, f),
        l AS (SELECT e, e - lag(e) OVER (ORDER BY o_orderkey) AS s FROM e),
        m AS (SELECT count(*) AS n, avg(power(e, 2)) AS m2, avg(power(e, 3)) AS m3, avg(power(e, 4)) AS m4, sum(s * s) / sum(e * e) AS dw FROM l)
        SELECT n, round(m3 / power(m2, 1.5), 6) AS skew, round(m4 / (m2 * m2), 6) AS kurtosis,
               round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 4) AS jarque_bera, round(dw, 6) AS durbin_watson FROM m"""
)
def m5_residual_shape(spark, d):
    orders = table(spark, d, "orders")
    g = gram(orders, ["o_custkey"], "o_totalprice")
    scored = linear.predict(orders, linear.ols_from_gram(g))
    rows = scored.select("o_orderkey", (F.col("o_totalprice") - F.col("predicted")).alias("residual"))
    shape = linear.residual_shape(rows, "residual", "o_orderkey", g)
    return shape.select(
        "n", F.round("skew", 6).alias("skew"), F.round("kurtosis", 6).alias("kurtosis"),
        F.round("jarque_bera", 4).alias("jarque_bera"), F.round("durbin_watson", 6).alias("durbin_watson"),
    )


PATH_ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0, 5000.0]


@query()
def m8_lasso_path(spark, d):
    rows, xs = _design(spark, d)
    return linear.path_metrics(spark, linear.lasso_path(rows, NET, xs, PATH_ALPHAS, "split"))


@query(
    """WITH t AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS v, CAST(count(*) AS DOUBLE) AS n FROM lineitem),
        a AS (SELECT unnest([0.1, 10.0, 1000.0, 100000.0, 1000000.0]::DOUBLE[]) AS alpha),
        w AS (SELECT alpha, mx, my, sign(c) * greatest(abs(c) - alpha, 0) / v AS coef FROM a, t)
        SELECT w.alpha, CAST(max(coef != 0)::INT AS INTEGER) AS n_kept, round(any_value(coef), 4) + 0.0 AS coef,
               round(avg(power(l_extendedprice - (my + coef * (l_quantity - mx)), 2)), 0) AS train_ase
        FROM w, lineitem GROUP BY w.alpha"""
)
def m8_lasso_one(spark, d):
    """One predictor, where soft thresholding is the closed form."""
    steps = linear.lasso_path(_lines(spark, d), Y, ["l_quantity"], [0.1, 10.0, 1000.0, 100000.0, 1000000.0])
    metrics = linear.path_metrics(spark, steps)
    coefs = linear.path_coefficients(spark, steps).select("alpha", "coef")
    joined = metrics.join(coefs, "alpha").select("alpha", "n_kept", F.round("coef", 4).alias("coef"), F.round("train_ase", 0).alias("train_ase"))
    return joined


@query()
def m8_lasso_coefficients(spark, d):
    rows, xs = _design(spark, d)
    return linear.path_coefficients(spark, linear.lasso_path(rows, NET, xs, PATH_ALPHAS, "split"))


@query()
def m8_best_alpha(spark, d):
    rows, xs = _design(spark, d)
    return linear.best_alpha(linear.path_metrics(spark, linear.lasso_path(rows, NET, xs, PATH_ALPHAS, "split")))


@query()
def m8_best_alpha_bic(spark, d):
    """The penalty with the least validation BIC, the last on ties."""
    rows, xs = _design(spark, d)
    return linear.best_alpha(linear.path_metrics(spark, linear.lasso_path(rows, NET, xs, PATH_ALPHAS, "split")), by="valid_bic", last=True)


@query()
def m9_shrinkage_path(spark, d):
    rows, xs = _design(spark, d)
    steps = linear.shrinkage_path(rows, NET, xs, PATH_ALPHAS, [0.0, 0.25, 0.5, 0.75, 1.0], "split")
    return linear.path_metrics(spark, steps, refit=False)


# A fixed rule stands in for a fitted model where the twin has to repeat it.
RULE = "l_quantity * 1500.0 + 500.0"
METRIC_SQL = f"""WITH r AS (SELECT {SPLIT_SQL} AS split, l_extendedprice AS y, l_extendedprice - ({RULE}) AS e FROM lineitem),
    s AS (SELECT split, count(*) AS n, sum(e * e) AS sse, avg(abs(e)) AS mean_ae, median(abs(e)) AS median_ae, var_pop(y) * count(*) AS sst FROM r GROUP BY 1),
    l AS (SELECT *, -n / 2.0 * (ln(2 * pi()) + 1 + ln(sse / n)) AS ll FROM s)
    SELECT split, n, CAST(2 AS INTEGER) AS n_coef, n - 2 AS df_error, round(1 - sse / sst, 6) AS r2, round(1 - sse / sst * (n - 1) / (n - 2), 6) AS adj_r2,
        round(mean_ae, 4) AS mean_ae, round(median_ae, 6) AS median_ae, round(sse / n, 1) AS ase, round(sqrt(sse / n), 4) AS root_ase, round(ll, 3) AS ll,
        round(-2 * ll + 6, 3) AS aic, round(-2 * ll + 6 + 24.0 / (n - 4), 3) AS aicc, round(-2 * ll + 3 * ln(n), 3) AS bic FROM l"""


@query(METRIC_SQL)
def m12_regression_metrics(spark, d):
    scored = _split_lines(spark, d).withColumn("predicted", F.expr(RULE))
    out = linear.regression_metrics(scored, Y, "predicted", 1, "split")
    digits = {"r2": 6, "adj_r2": 6, "mean_ae": 4, "median_ae": 6, "ase": 1, "root_ase": 4, "ll": 3, "aic": 3, "aicc": 3, "bic": 3}
    return out.select("split", "n", "n_coef", "df_error", *[F.round(c, k).alias(c) for c, k in digits.items()])


@query(
    """WITH p AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 3) AS predicted FROM lineitem, p"""
)
def m11_predict(spark, d):
    lines = _lines(spark, d)
    return rounded(linear.predict(lines, linear.ols(lines, Y, ["l_quantity"])).select(*ROW_KEY, "predicted"), 3)


@query(
    f"""WITH s AS (SELECT {SPLIT_SQL} AS split, l_extendedprice AS y, l_quantity AS x FROM lineitem),
        f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s WHERE split = 'train'),
        e AS (SELECT split, CAST(count(*) AS DOUBLE) AS n, sum(power(y - a - b * x, 2)) AS sse FROM s, f GROUP BY 1),
        l AS (SELECT *, -n / 2 * (ln(2 * pi()) + 1 + ln(sse / n)) AS ll FROM e)
        SELECT split, round(sse / n, 1) AS ase, round(-2 * ll + 6, 2) AS aic, round(-2 * ll + 6 + 24 / (n - 4), 2) AS aicc, round(-2 * ll + 3 * ln(n), 2) AS bic FROM l"""
)
def m10_info_criteria(spark, d):
    """Criteria of a model fitted on the training rows, for both splits, from two Grams."""
    found = grams(_split_lines(spark, d), ["l_quantity"], Y, "split")
    fit = linear.ols_from_gram(found["train"])
    rows = []
    for split, g in found.items():
        sse = g.sse(fit.intercept, fit.coef)
        ic = linear.info_criteria(linear.gaussian_ll(sse, g.n), g.n, 1)
        rows.append((split, sse / g.n, ic["aic"], ic["aicc"], ic["bic"]))
    out = spark.createDataFrame(rows, "split string, ase double, aic double, aicc double, bic double")
    return out.select("split", F.round("ase", 1).alias("ase"), *[F.round(c, 2).alias(c) for c in ("aic", "aicc", "bic")])


# Rule classifier on orders: label = urgent or high priority, score from the price.
LABEL = "CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INT)"
SCORE = "o_totalprice / 500001.0"
ORDER_SPLIT = "CASE WHEN ((((o_orderkey % 1000000007) * 2654435761) % 2147483647) % 1000) < 700 THEN 'train' ELSE 'valid' END"


def _rule_scored(spark, d):
    orders = evaluate.split_train_valid(table(spark, d, "orders"), "o_orderkey")
    return orders.select(
        "split", "o_orderkey", F.expr(LABEL).alias("label"), F.expr(SCORE).alias("prob"), F.expr(f"CAST({SCORE} > 0.5 AS INT)").alias("prediction")
    )


RULE_SQL = f"SELECT {ORDER_SPLIT} AS split, {LABEL} AS label, {SCORE} AS prob, CAST({SCORE} > 0.5 AS INT) AS prediction FROM orders"


@query(f"SELECT split, label, prediction, count(*) AS n FROM ({RULE_SQL}) GROUP BY ALL")
def m13_confusion(spark, d):
    return evaluate.confusion(_rule_scored(spark, d), by=["split"])


@query(
    f"""WITH r AS ({RULE_SQL}), c AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
            count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
            avg(abs(label - prob)) AS mae, avg(power(label - prob, 2)) AS ase FROM r GROUP BY 1)
        SELECT split, n, tn, fp, fn, tp, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
            round(tn / (tn + fp), 6) AS specificity, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, fp + fn AS n_wrong, round(100 * (fp + fn) / n, 6) AS pct_wrong,
            round(100 * fp / (tn + fp), 6) AS pct_wrong_0, round(100 * fn / (tp + fn), 6) AS pct_wrong_1, round(mae, 6) AS mae, round(ase, 6) AS ase FROM c"""
)
def m14_classification_metrics(spark, d):
    return rounded(evaluate.classification_metrics(_rule_scored(spark, d), "label", "prob", "split"))


# Three classes: order status against a price band.
BAND = "CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END"


@query(
    f"""WITH r AS (SELECT o_orderstatus AS label, {BAND} AS pred FROM orders), k AS (SELECT label AS c FROM r UNION SELECT pred FROM r),
        m AS (SELECT c, count(*) FILTER (WHERE label = c AND pred = c) AS tp, count(*) FILTER (WHERE label = c) AS actual, count(*) FILTER (WHERE pred = c) AS called FROM r, k GROUP BY 1)
        SELECT round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(coalesce(tp / nullif(called, 0), 0)), 6) AS precision_macro,
               round(avg(coalesce(tp / nullif(actual, 0), 0)), 6) AS recall_macro, round(avg(coalesce(2 * tp / nullif(called + actual, 0), 0)), 6) AS f1_macro FROM m"""
)
def m15_macro_scores(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("label"), F.expr(BAND).alias("prediction"))
    return rounded(evaluate.macro_scores(evaluate.confusion(rows)))


@query(
    f"""WITH r AS ({RULE_SQL}), s AS (SELECT count(*) AS n, sum(power(label - prob, 2)) AS sse, var_pop(label) * count(*) AS sst FROM r)
        SELECT n, round(1 - sse / sst, 6) AS r2, round(greatest(1 - sse / sst * (n - 1) / (n - 2), 0), 6) + 0.0 AS adj_r2 FROM s"""
)
def m25_adj_r2_prob(spark, d):
    return rounded(linear.adj_r2_prob(_rule_scored(spark, d), "label", "prob", 1))


DIAG_SQL = f"""WITH {RESID_SQL},
    r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS observed, a + b * l_quantity AS predicted, l_extendedprice - a - b * l_quantity AS residual,
              (l_extendedprice - a - b * l_quantity) / sqrt(mse) AS standardized, 1.0 / n + power(l_quantity - mx, 2) / sxx AS leverage, n FROM lineitem, g),
    s AS (SELECT *, standardized / sqrt(1 - leverage) AS studentized FROM r),
    i AS (SELECT *, power(studentized, 2) * leverage / (1 - leverage) / 2 AS cooks_d FROM s)"""


def _influence(spark, d):
    lines = _lines(spark, d)
    fit = linear.ols(lines, Y, ["l_quantity"])
    return diagnostics.influence(lines, fit, ROW_KEY), fit


@query(
    DIAG_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, observed, round(predicted, 3) AS predicted, round(residual, 3) + 0.0 AS residual, round(standardized, 6) + 0.0 AS standardized,
        round(leverage, 9) AS leverage, round(studentized, 6) + 0.0 AS studentized, round(cooks_d, 9) AS cooks_d FROM i"""
)
def d1_influence(spark, d):
    rows, _ = _influence(spark, d)
    digits = {"predicted": 3, "residual": 3, "standardized": 6, "leverage": 9, "studentized": 6, "cooks_d": 9}
    return rows.select(*ROW_KEY, "observed", *[F.round(c, k).alias(c) for c, k in digits.items()])


@query(
    DIAG_SQL + """SELECT round(max(cooks_d), 9) AS max_cooks_d, round(4.0 / max(n), 9) AS cooks_d_cutoff, count(*) FILTER (WHERE cooks_d > 4.0 / n) AS n_over_cooks_d,
        round(max(leverage), 9) AS max_leverage, round(6.0 / max(n), 9) AS leverage_cutoff, count(*) FILTER (WHERE leverage > 6.0 / n) AS n_over_leverage FROM i"""
)
def d2_influence_cutoffs(spark, d):
    rows, fit = _influence(spark, d)
    return rounded(diagnostics.influence_cutoffs(rows, fit.n, fit.p), 9)


@query(
    DIAG_SQL + """SELECT sigma, CAST(round(max(n) * p) AS BIGINT) AS expected, count(*) FILTER (WHERE abs(standardized / sqrt(1 - leverage)) > sigma) AS observed
        FROM i, (VALUES (1, 0.31731050786291415), (2, 0.04550026389635842), (3, 0.0026997960632601965), (4, 0.00006334248366623996)) AS v(sigma, p) GROUP BY sigma, p"""
)
def d3_sigma_expectation(spark, d):
    rows, fit = _influence(spark, d)
    return diagnostics.sigma_expectation(rows, fit.n, (1, 2, 3, 4))


@query(
    DIAG_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, observed, round(predicted, 3) AS predicted, round(studentized, 5) AS studentized
        FROM i WHERE abs(studentized) > 1.7 ORDER BY 1, 2, 3, 4 LIMIT 15"""
)
def d4_residual_outliers(spark, d):
    """First fifteen in key order. Cut at 1.7: the data has no residual beyond 4."""
    rows, _ = _influence(spark, d)
    out = diagnostics.residual_outliers(rows, ROW_KEY, sigma=1.7)
    return out.select(*ROW_KEY, "observed", F.round("predicted", 3).alias("predicted"), F.round("studentized", 5).alias("studentized"))


@query(
    DIAG_SQL + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, round(min({m}), 5) + 0.0 AS min, round(avg({m}), 5) + 0.0 AS mean, round(max({m}), 5) + 0.0 AS max FROM i"
        for m in diagnostics.MEASURES
    )
)
def d5_diag_summary(spark, d):
    rows, _ = _influence(spark, d)
    return rounded(diagnostics.diag_summary(rows), 5)


@query(
    """WITH c AS (SELECT 'l_quantity' AS term, regr_r2(l_extendedprice, l_quantity) AS r2, regr_slope(l_extendedprice, l_quantity) AS b, count(*) AS n FROM lineitem)
       SELECT term, round(sign(b) * sqrt(r2 * (n - 2) / (1 - r2)), 3) AS t FROM c"""
)
def d6_strongest_one(spark, d):
    fit = linear.ols(_lines(spark, d), Y, ["l_quantity"])
    out = linear.strongest_attribute(linear.coefficient_table(spark, fit))
    return out.select("term", F.round("t", 3).alias("t"))


@query()
def d6_strongest_attribute(spark, d):
    rows, xs = _design(spark, d)
    return linear.strongest_attribute(linear.coefficient_table(spark, linear.ols(rows, NET, xs)))


@query(
    DIAG_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, observed, round(predicted, 3) AS predicted, round(residual, 3) AS residual
        FROM i ORDER BY observed DESC, 1, 2, 3, 4 LIMIT 10"""
)
def d7_top_observed(spark, d):
    rows, _ = _influence(spark, d)
    return rounded(diagnostics.top_observed(rows, ROW_KEY), 3)


@query()
def d1_influence_full(spark, d):
    """Diagnostics of the fit on all encoded columns, summarised."""
    rows, xs = _design(spark, d)
    fit = linear.ols(rows, NET, xs)
    return diagnostics.diag_summary(diagnostics.influence(rows, fit, ["split"]))


@query()
def m22_stepwise_linear(spark, d):
    rows, xs = _design(spark, d)
    _, moves = selection.stepwise(gram(rows.filter("split = 'train'"), xs, NET))
    return selection.stepwise_log(spark, moves)


@query()
def m23_genetic_linear(spark, d):
    """Best subsets by BIC; the table is read once for the whole search."""
    rows, xs = _design(spark, d)
    result = selection.genetic_select(selection.LinearFitness(gram(rows, xs, NET), "bic"), xs, n_generation=50)
    return selection.hall_of_fame(spark, result)


@query()
def m24_generation_log(spark, d):
    rows, xs = _design(spark, d)
    result = selection.genetic_select(selection.LinearFitness(gram(rows, xs, NET), "bic"), xs, n_generation=50)
    return selection.generation_log(spark, result)


DOC_X = ["n_chars", "n_words", "mean_word", "distinct_ratio", "punct_rate"]


WIDE_X = [
    *DOC_X, "upper_rate", "digit_rate", "accent_rate", "vowel_rate", "line_rate", "stop_rate", "longest_word", "short_rate", "lang_de", "lang_es", "lang_fr", "source_first",
]


def doc_features(spark, d, wide=False, keep=()):
    """Per labelled document simple measures of its whole text; label = quality. ``keep`` names columns to carry along."""
    # Spread the bare scan: asking a join for its partitions would run it.
    scan = spread_rows(table(spark, d, "documents").select("doc_id", "text", "n_chars", "lang", "source"), "doc_id")
    docs = scan.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    words = docs.select("doc_id", "quality", "text", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"), word_array(F.col("text")).alias("w"))
    n = F.size("w").cast("double")
    return words.select(
        "doc_id",
        *keep,
        F.col("quality").cast("double").alias("label"),
        F.log1p("n_chars").alias("n_chars"),
        F.log1p(n).alias("n_words"),
        (F.length(F.array_join("w", "")) / F.greatest(n, F.lit(1.0))).alias("mean_word"),
        (F.size(F.array_distinct("w")) / F.greatest(n, F.lit(1.0))).alias("distinct_ratio"),
        (F.regexp_count("text", F.lit(r"[^\p{L}\s]")) / F.greatest("n_chars", F.lit(1.0))).alias("punct_rate"),
        *(_more_features(n) if wide else []),
    )


def _more_features(n):
    """Further measures and the encoded nominal columns of a wide design."""
    per_char = [("upper_rate", r"\p{Lu}"), ("digit_rate", r"\d"), ("accent_rate", r"[^\x00-\x7F]"), ("vowel_rate", "[aeiouAEIOU]"), ("line_rate", r"\n")]
    rates = [(F.regexp_count("text", F.lit(p)) / F.greatest("n_chars", F.lit(1.0))).alias(c) for c, p in per_char]
    stops = F.size(F.filter("w", lambda w: w.isin(STOP_WORDS)))
    words = [
        (stops / F.greatest(n, F.lit(1.0))).alias("stop_rate"),
        F.coalesce(F.array_max(F.transform("w", lambda w: F.length(w))), F.lit(0)).cast("double").alias("longest_word"),
        (F.size(F.filter("w", lambda w: F.length(w) <= 2)) / F.greatest(n, F.lit(1.0))).alias("short_rate"),
    ]
    nominal = [(F.col("lang") == v).cast("double").alias(f"lang_{v}") for v in ("de", "es", "fr")]
    return [*rates, *words, *nominal, (F.col("source") == "src0").cast("double").alias("source_first")]


def _assembled(spark, d, k=5):
    """Standardised feature vectors with stratified folds."""
    amap = {"label": Attr("interval", (0.0, 1.0)), **{x: Attr("interval", (-1e9, 1e9)) for x in DOC_X}}
    features = doc_features(spark, d).persist()
    scaled = clean.TableCleaner(amap, no_impute=["label"], interval_scale="std", keep=["doc_id"]).fit_transform(features)
    rows = classify.assemble(scaled, DOC_X, "label", ["doc_id"])
    return keep_packed(evaluate.kfold(rows, "doc_id", k, stratify="label"))


# With one 0/1 predictor the logit has a closed form: log odds, and sums of reciprocal cell counts.
ONE_FACTOR_SQL = """WITH c AS (SELECT CAST(count_if(x = 0 AND y = 0) AS DOUBLE) AS n00, CAST(count_if(x = 0 AND y = 1) AS DOUBLE) AS n01,
        CAST(count_if(x = 1 AND y = 0) AS DOUBLE) AS n10, CAST(count_if(x = 1 AND y = 1) AS DOUBLE) AS n11
        FROM (SELECT CAST(l_quantity > 25 AS INTEGER) AS x, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem))
    SELECT 'const' AS term, round(ln(n01 / n00), 4) AS coef, round(sqrt(1 / n01 + 1 / n00), 4) AS std_err FROM c
    UNION ALL SELECT 'large', round(ln(n11 / n10) - ln(n01 / n00), 4), round(sqrt(1 / n00 + 1 / n01 + 1 / n10 + 1 / n11), 4) FROM c"""


@query(ONE_FACTOR_SQL)
def m6_logit_one_factor(spark, d):
    items = table(spark, d, "lineitem")
    rows = items.select((F.col("l_quantity") > 25).cast("double").alias("large"), (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    model = classify.logit(rows, "returned", ["large"])
    return rounded(classify.logit_coefficients(spark, model, ["large"]).select("term", "coef", "std_err"), 4)


@query()
def m6_logit(spark, d):
    rows, _ = keep_packed(doc_features(spark, d))
    return classify.logit_coefficients(spark, classify.logit(rows, "label", DOC_X), DOC_X)


@query()
def m6_logit_summary(spark, d):
    rows, n = keep_packed(doc_features(spark, d))
    return classify.logit_summary(spark, classify.logit(rows, "label", DOC_X), n, len(DOC_X))


@query()
def m7_logit_l2_sweep(spark, d):
    """Penalty sweep scored by cross-validation; best mean F1-macro flagged."""
    rows, n = _assembled(spark, d)
    settings = {c: (lambda c=c: classify.logit_l2(c, n * 4 // 5)) for c in classify.PENALTIES}
    return evaluate.sweep(rows, "C", settings, 5)


@query()
def m7_multinomial_logit(spark, d):
    """Ten classes of embeddings: confusion counts of the fitted model."""
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, d, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    rows, n = keep_packed(rows)
    model = classify.logit_l2(1.0, n, family="multinomial").fit(rows)
    return evaluate.confusion(model.transform(rows))


@query()
def m16_cross_validate(spark, d):
    rows, n = _assembled(spark, d, 10)
    return evaluate.cross_validate(rows, lambda: classify.logit_l2(1.0, n * 9 // 10), 10)


@query()
def m17_tree_depth_sweep(spark, d):
    return depths.sweep_depths(_assembled(spark, d)[0], "depth", classify.decision_tree, classify.TREE_DEPTHS, 5)


@query()
def m17_forest_depth_sweep(spark, d):
    return depths.sweep_depths(_assembled(spark, d)[0], "depth", classify.random_forest, classify.TREE_DEPTHS, 5)


@query()
def m18_decision_tree(spark, d):
    """Depth-6 tree: confusion counts per split."""
    rows = evaluate.split_train_valid(_assembled(spark, d)[0], "doc_id")
    model = classify.decision_tree(6).fit(rows.filter("split = 'train'"))
    return evaluate.confusion(model.transform(rows), by=["split"])


@query()
def m19_random_forest(spark, d):
    rows = evaluate.split_train_valid(_assembled(spark, d)[0], "doc_id")
    model = classify.random_forest(8).fit(rows.filter("split = 'train'"))
    return evaluate.confusion(model.transform(rows), by=["split"])


@query()
def m20_feature_importance(spark, d):
    return classify.feature_importance(spark, classify.random_forest(8).fit(_assembled(spark, d)[0]), DOC_X)


@query()
def m21_soft_vote(spark, d):
    """Forest, tree and logit: accuracy of each and of their averaged probabilities."""
    rows, n = _assembled(spark, d)
    makers = {
        "forest": lambda: classify.random_forest(8),
        "tree": lambda: classify.decision_tree(6),
        "logit": lambda: classify.logit_l2(1.0, n * 4 // 5),
    }
    return classify.cross_validated_vote(rows, makers, 5)


@query()
def m22_stepwise_logistic(spark, d):
    batch = LogitBatch(doc_features(spark, d), DOC_X, "label")
    _, moves = selection.stepwise(batch)
    batch.close()
    return selection.stepwise_log(spark, moves)


@query()
def m23_genetic_logistic(spark, d):
    """Best subsets of 17 encoded columns by BIC."""
    batch = LogitBatch(doc_features(spark, d, wide=True), WIDE_X, "label")
    result = selection.genetic_select(selection.LogitFitness(batch, "bic"), WIDE_X, n_generation=25)
    batch.close()
    return selection.hall_of_fame(spark, result)


# With one 0/1 predictor the multinomial logit has a closed form too: every cell gets its own share.
MULTI_SQL = """cells AS (SELECT CAST(l_quantity > 25 AS INTEGER) AS x, l_returnflag AS c, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1, 2),
    shares AS (SELECT *, n / sum(n) OVER (PARTITION BY x) AS fitted, sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS base, sum(n) OVER () AS total FROM cells)"""


@query(
    f"""WITH {MULTI_SQL}, odds AS (SELECT a.x, a.c, ln(a.n / b.n) AS v, 1 / a.n + 1 / b.n AS e FROM cells a JOIN cells b ON a.x = b.x AND b.c = 'A' WHERE a.c <> 'A')
        SELECT c AS class, 'const' AS term, round(v, 4) AS coef, round(sqrt(e), 4) AS std_err FROM odds WHERE x = 0
        UNION ALL SELECT o.c, 'large', round(o.v - z.v, 4), round(sqrt(o.e + z.e), 4) FROM odds o JOIN odds z ON o.c = z.c AND o.x = 1 AND z.x = 0"""
)
def m6_multinomial_one_factor(spark, d):
    """Log odds of each return flag against the first, of small and of large orders."""
    batch = _flag_batch(spark, d)
    fit = batch.fit([(0,)])[0]
    batch.close()
    error = fit.covariance.diagonal() ** 0.5
    rows = [
        (c, term, float(fit.coef[i, j]), float(error[i * 2 + j])) for i, c in enumerate(FLAGS[1:]) for j, term in enumerate(("const", "large"))
    ]
    return rounded(spark.createDataFrame(rows, "class string, term string, coef double, std_err double"), 4)


FLAGS = ("A", "N", "R")


def _flag_batch(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_quantity") > 25).cast("double").alias("large"), "l_returnflag")
    return LogitBatch(rows, ["large"], "l_returnflag", classes=FLAGS)


@query(
    f"""WITH {MULTI_SQL}, fits AS (
            SELECT '' AS columns, 0 AS p, sum(n * ln(base)) AS ll, sum(n * (1 - base)) / 2 AS sse, any_value(total) AS n FROM shares
            UNION ALL SELECT 'large', 1, sum(n * ln(fitted)), sum(n * (1 - fitted)) / 2, any_value(total) FROM shares),
        sizes AS (SELECT *, 3 * (p + 1) + 1 AS k, max(sse) OVER () AS sst FROM fits)
        SELECT columns, round(ll, 2) AS ll, round(-2 * ll + 2 * k, 2) AS aic, round(-2 * ll + k * ln(n), 2) AS bic,
            round(greatest(1 - sse / sst * (n - 1) / (n - p - 1), 0), 8) + 0.0 AS adjr2 FROM sizes"""
)
def m23_multiclass_fitness(spark, d):
    """What the search with three classes judges subsets by: the empty one and that of the one column."""
    batch = _flag_batch(spark, d)
    subsets = [(), (0,)]
    ll = [f.ll for f in batch.fit(subsets)]
    found = {c: selection.LogitFitness(batch, c).score(subsets) for c in selection.CRITERIA}
    batch.close()
    rows = [(",".join("large" for _ in cols), ll[i], *[float(found[c][i]) for c in ("aic", "bic", "adjr2")]) for i, cols in enumerate(subsets)]
    out = spark.createDataFrame(rows, "columns string, ll double, aic double, bic double, adjr2 double")
    return out.select("columns", *[F.round(c, 2).alias(c) for c in ("ll", "aic", "bic")], F.round("adjr2", 8).alias("adjr2"))


LANGUAGES = ("de", "en", "es", "fr")
LANGUAGE_X = [x for x in WIDE_X if not x.startswith("lang_")]


def _language_batch(spark, d):
    rows = doc_features(spark, d, wide=True, keep=["lang"])
    return LogitBatch(rows, LANGUAGE_X, "lang", classes=LANGUAGES)


@query()
def m22_stepwise_multiclass(spark, d):
    """Moves of the stepwise search for the language of a document, by joint Wald tests."""
    batch = _language_batch(spark, d)
    _, moves = selection.stepwise(batch)
    batch.close()
    return selection.stepwise_log(spark, moves)


@query()
def m23_genetic_multiclass(spark, d):
    """Best subsets of 14 columns by BIC for the language of a document (four classes)."""
    batch = _language_batch(spark, d)
    result = selection.genetic_select(selection.LogitFitness(batch, "bic"), LANGUAGE_X, n_generation=10)
    batch.close()
    return selection.hall_of_fame(spark, result)


@query()
def m23_genetic_topics(spark, d):
    """Best subsets of document measures and topic shares by BIC: the shares of all topics but the last join in as predictors."""
    k = 4
    weights = topics.doc_weights(table(spark, d, "documents"), "doc_id", stop_words=STOP_WORDS, min_df=4, max_df=0.5)
    found = topics.prob_columns(topics.topics_lda(weights, "doc_id", k).docs, k)
    shares = [f"prob{j}" for j in range(1, k)]
    # Documents without a kept term belong to each topic alike.
    rows = doc_features(spark, d).join(found, "doc_id", "left").fillna(1.0 / k, shares)
    batch = LogitBatch(rows, [*DOC_X, *shares], "label")
    result = selection.genetic_select(selection.LogitFitness(batch, "bic"), batch.xs, n_generation=10)
    batch.close()
    return selection.hall_of_fame(spark, result)


@query()
def m23_genetic_criteria(spark, d):
    """Best subset by each criterion from either start; one Gram matrix serves all six searches."""
    rows, xs = _design(spark, d)
    g = gram(rows, xs, NET)
    out = []
    for criterion in selection.CRITERIA:
        for start in ("star", "random"):
            found = selection.genetic_select(selection.LinearFitness(g, criterion), xs, n_generation=25, method=start)
            out.append((criterion, start, ",".join(found.features), len(found.best), float(found.fitness), found.distinct))
    return spark.createDataFrame(out, "criterion string, start string, features string, k int, fitness double, n_distinct int")


@query()
def s8_save_model(spark, d):
    """A tree stored, loaded again and applied."""
    from pyspark.ml.classification import DecisionTreeClassificationModel

    from loomstat.session import work_path
    from loomstat.sources.tables import save_model

    rows, _ = _assembled(spark, d)
    path = work_path(spark, "tree")
    save_model(classify.decision_tree(6).fit(rows), path)
    return evaluate.confusion(DecisionTreeClassificationModel.load(path).transform(rows))
