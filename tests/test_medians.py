"""Exact medians of many columns and the imputation that stands on them."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from loomstat.operators import clean
from loomstat.operators.clean import Attr
from loomstat.operators.quantile import column_medians


def test_medians_of_many_columns(spark):
    """Odd and even counts, a hot value, nulls, NaN, negative values and one column that is the same all over."""
    draw = random.Random(5)
    rows = []
    for i in range(30_001):
        hot = 7.25 if i % 3 == 0 else draw.gauss(0, 50)
        rows.append((float(i), hot, None if i % 2 else draw.random(), math.nan if i % 5 == 0 else -float(i), 4.0))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    found = column_medians(df, {c: F.col(c) for c in df.columns})
    for at, c in enumerate(df.columns):
        known = [r[at] for r in rows if r[at] is not None and not math.isnan(r[at])]
        assert found[c] == pytest.approx(statistics.median(known), abs=1e-12), c


def test_nothing_known(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert column_medians(df, {"a": F.col("a"), "b": F.col("b")}) == {"b": 1.5}
    assert column_medians(df.limit(0), {"b": F.col("b")}) == {}
    assert column_medians(df, {}) == {}


def test_median_fill(spark):
    """Values outside the domain are filled by the median of those inside, and the spread is that of the filled column."""
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,), (99.0,), (4.0,)], "x double")
    cleaner = clean.TableCleaner({"x": Attr("interval", (0.0, 50.0))}, interval_fill="median").fit(df)
    assert cleaner.stats.fill["x"] == 3.0
    filled = [1.0, 2.0, 10.0, 3.0, 3.0, 4.0]
    assert cleaner.stats.centre["x"] == pytest.approx(statistics.mean(filled))
    assert cleaner.stats.spread["x"] == pytest.approx(statistics.pstdev(filled))
    assert sorted(r.x for r in cleaner.transform(df).collect()) == sorted(filled)


def test_no_value_inside(spark):
    df = spark.createDataFrame([(99.0,)], "x double")
    for fill in ("mean", "median"):
        with pytest.raises(ValueError, match="no value"):
            clean.TableCleaner({"x": Attr("interval", (0.0, 50.0))}, interval_fill=fill).fit(df)
