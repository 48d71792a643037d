"""Splits, folds, confusion tables, classification scores, cross-validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.reshape import union_all

# Fixed values of the keyed hash; products stay inside a bigint.
KEY_SPACE = 1_000_000_007
MULTIPLIER = 2_654_435_761
HASH_SPACE = 2_147_483_647


def key_hash(key: Column, seed: int = 0) -> Column:
    """A number in [0, 2147483647) that depends only on the key and the seed,
    so splits survive repartitioning and re-runs."""
    return F.pmod(F.pmod(key.cast("bigint"), F.lit(KEY_SPACE)) * F.lit(MULTIPLIER) + F.lit(seed), F.lit(HASH_SPACE))


def split_train_valid(df: DataFrame, key: Column | str, seed: int = 0, train: float = 0.7, out: str = "split") -> DataFrame:
    """Mark each row ``train`` or ``valid`` by hashing its key."""
    column = F.col(key) if isinstance(key, str) else key
    inside = key_hash(column, seed) % 1000 < int(round(train * 1000))
    return df.withColumn(out, F.when(inside, "train").otherwise("valid"))


def kfold(
    df: DataFrame,
    key: Column | str,
    k: int = 5,
    stratify: str | None = None,
    seed: int = 0,
    out: str = "fold",
    buckets: int = 8192,
) -> DataFrame:
    """Assign folds 0..k-1. With ``stratify`` every class is dealt out evenly:
    its fold sizes differ by at most one.

    The dealing order is the key hash. A class is ranked in ``buckets`` ranges
    of the hash and the ranges are then offset by their counts, so a class
    with most of the rows is still ranked by many tasks.
    """
    column = F.col(key) if isinstance(key, str) else key
    hashed = df.withColumn("_h", key_hash(column, seed)).withColumn("_k", column.cast("bigint"))
    if stratify is None:
        return hashed.withColumn(out, F.col("_h") % k).drop("_h", "_k")
    width = HASH_SPACE // buckets + 1
    placed = hashed.withColumn("_b", F.floor(F.col("_h") / F.lit(width)))
    sizes = placed.groupBy(F.col(stratify).alias("_c"), F.col("_b").alias("_bb")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_c", "_bb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    place = F.row_number().over(Window.partitionBy(stratify, "_b").orderBy("_h", "_k"))
    ranked = placed.withColumn("_place", place)
    joined = ranked.join(offsets, F.col(stratify).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_bb")))
    fold = ((F.col("_skip") + F.col("_place") - 1) % k).cast("bigint")
    return joined.withColumn(out, fold).drop("_h", "_k", "_b", "_c", "_bb", "_skip", "_place")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(cells: DataFrame, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """One row per label, one column per predicted class."""
    return cells.groupBy(*by, "label").pivot("prediction", list(classes)).agg(F.sum("n")).na.fill(0)


def _share(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0))


def binary_scores(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, specificity, F1 and errors from 0/1 confusion counts."""

    def cell(label, prediction):
        hit = (F.col("label") == label) & (F.col("prediction") == prediction)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    counts = cells.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return counts.select(
        *by,
        n.alias("n"),
        "tn",
        "fp",
        "fn",
        "tp",
        _share(tp + tn, n).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(tn, tn + fp).alias("specificity"),
        _share(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        (fp + fn).alias("n_wrong"),
        (100.0 * _share(fp + fn, n)).alias("pct_wrong"),
        (100.0 * _share(fp, tn + fp)).alias("pct_wrong_0"),
        (100.0 * _share(fn, tp + fn)).alias("pct_wrong_1"),
    )


def classification_metrics(
    scored: DataFrame, label: str, prob: str, split: str, cut: float = 0.5
) -> DataFrame:
    """Per split: mean absolute and squared error of the probability, and the
    scores of the prediction ``prob > cut``."""
    rows = scored.select(F.col(split).alias(split), F.col(label).cast("double").alias("label"), F.col(prob).alias("_p"))
    rows = rows.withColumn("prediction", (F.col("_p") > cut).cast("double"))
    parts = rows.groupBy(split, "label", "prediction").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(F.col("label") - F.col("_p"))).alias("_abs"),
        F.sum((F.col("label") - F.col("_p")) * (F.col("label") - F.col("_p"))).alias("_sq"),
    )
    errors = parts.groupBy(F.col(split).alias("_s")).agg(
        (F.sum("_abs") / F.sum("n")).alias("mae"), (F.sum("_sq") / F.sum("n")).alias("ase")
    )
    return binary_scores(parts, [split]).join(errors, F.col(split).eqNullSafe(F.col("_s"))).drop("_s")


def macro_scores(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the unweighted class means of precision, recall and F1;
    an undefined class value counts as 0."""
    row = F.array(
        F.struct(F.col("label").alias("_class"), F.lit(1).alias("_side")),
        F.struct(F.col("prediction").alias("_class"), F.lit(0).alias("_side")),
    )
    sides = cells.withColumn("_hit", F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).select(
        *by, "n", "_hit", F.inline(row)
    )
    classes = sides.groupBy(*by, "_class").agg(
        F.sum(F.when(F.col("_side") == 1, F.col("_hit")).otherwise(0)).alias("_tp"),
        F.sum(F.when(F.col("_side") == 1, F.col("n")).otherwise(0)).alias("_actual"),
        F.sum(F.when(F.col("_side") == 0, F.col("n")).otherwise(0)).alias("_called"),
    )
    zero = F.lit(0.0)
    per_class = classes.select(
        *by,
        "_tp",
        "_actual",
        F.coalesce(_share(F.col("_tp"), F.col("_called")), zero).alias("_p"),
        F.coalesce(_share(F.col("_tp"), F.col("_actual")), zero).alias("_r"),
        F.coalesce(_share(2.0 * F.col("_tp"), F.col("_called") + F.col("_actual")), zero).alias("_f"),
    )
    return per_class.groupBy(*by).agg(
        (F.sum("_tp") / F.sum("_actual")).alias("accuracy"),
        F.avg("_p").alias("precision_macro"),
        F.avg("_r").alias("recall_macro"),
        F.avg("_f").alias("f1_macro"),
    )


SCORES = ("accuracy", "precision_macro", "recall_macro", "f1_macro")


# Model fits submitted at the same time; the scheduler interleaves their jobs.
FIT_THREADS = 8


def _fold_prediction(df: DataFrame, make: Callable[[], object], i: int, fold: str, label: str) -> DataFrame:
    model = make().fit(df.filter(F.col(fold) != i))
    return model.transform(df.filter(F.col(fold) == i)).select(
        F.col(fold).cast("bigint").alias("fold"),
        F.col(label).cast("double").alias("label"),
        F.col("prediction").cast("double").alias("prediction"),
    )


def together(tasks: Sequence[Callable[[], object]], threads: int = FIT_THREADS) -> list:
    """Run independent fits side by side, so the cluster is not idle between them."""
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def fold_predictions(df: DataFrame, make: Callable[[], object], k: int, fold: str = "fold", label: str = "label") -> DataFrame:
    """Out-of-fold predictions of a freshly made estimator."""
    return union_all(*together([partial(_fold_prediction, df, make, i, fold, label) for i in range(k)]))


def cross_validate(df: DataFrame, make: Callable[[], object], k: int = 5, fold: str = "fold", label: str = "label") -> DataFrame:
    """Mean and population standard deviation over folds of each score."""
    cells = confusion(fold_predictions(df, make, k, fold, label), by=["fold"])
    per_fold = macro_scores(cells, ["fold"])
    stats = [f(s).alias(f"{s}_{n}") for s in SCORES for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    cells_out = F.array(
        *[F.struct(F.lit(s).alias("metric"), F.col(f"{s}_mean").alias("mean"), F.col(f"{s}_std").alias("std")) for s in SCORES]
    )
    return per_fold.agg(*stats).select(F.inline(cells_out))


def sweep(
    df: DataFrame,
    name: str,
    settings: Mapping[object, Callable[[], object]],
    k: int = 5,
    fold: str = "fold",
    label: str = "label",
) -> DataFrame:
    """Cross-validate one estimator per setting. All out-of-fold predictions
    form one table, so every score comes from a single aggregate. The best
    mean F1-macro is flagged, the first on ties."""
    makers = list(settings.values())
    jobs = [(position, i) for position in range(len(makers)) for i in range(k)]
    parts = together([partial(_fold_prediction, df, makers[position], i, fold, label) for position, i in jobs])
    named = [str(value) for value in settings]
    tagged = [
        rows.select(F.lit(position).alias("position"), F.lit(named[position]).alias(name), "*")
        for (position, _), rows in zip(jobs, parts)
    ]
    return score_settings(confusion(union_all(*tagged), by=["position", name, "fold"]), name)


def score_settings(cells: DataFrame, name: str) -> DataFrame:
    """Scores over folds of every setting from counts by (position, setting, fold, label, prediction)."""
    per_fold = macro_scores(cells, ["position", name, "fold"])
    table = per_fold.groupBy("position", name).agg(
        *[f(s).alias(f"{s}_{n}") for s in SCORES for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )
    best = table.agg(F.max_by("position", F.struct("f1_macro_mean", -F.col("position")))).scalar()
    return table.withColumn("best", F.col("position") == best)


def probability_of(column: str, index: int) -> Column:
    """One class probability out of an ML vector column."""
    return F.get(vector_to_array(F.col(column)), F.lit(index))
