"""Cleaning and encoding driven by an attribute map.

The map says for each column what it means (its role) and which values are
valid (its domain). Fitting takes one aggregate over the table; applying is
one generated projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.operators.quantile import column_medians

ROLES = ("interval", "binary", "nominal", "id", "text", "ignore")
LEVELLED = ("binary", "nominal")


@dataclass(frozen=True)
class Attr:
    """Role of a column and its domain: (low, high) for an interval,
    the list of levels for a binary or nominal column, else empty."""

    role: str
    domain: tuple = ()

    def __post_init__(self):
        object.__setattr__(self, "role", self.role.lower())
        object.__setattr__(self, "domain", tuple(self.domain))
        if self.role not in ROLES:
            raise ValueError(f"unknown role {self.role!r}")
        if self.role in ("interval", "binary") and len(self.domain) != 2:
            raise ValueError(f"an attribute of role {self.role} needs a domain of two values")
        if self.role == "nominal" and not self.domain:
            raise ValueError("a nominal attribute needs its levels")


AttributeMap = Mapping[str, Attr]


def check_map(df: DataFrame, amap: AttributeMap) -> None:
    """The map must name existing columns, with numbers where it says interval."""
    missing = [c for c in amap if c not in df.columns]
    if missing:
        raise ValueError(f"attribute map names columns the table lacks: {missing}")
    wrong = [
        c for c, a in amap.items() if a.role == "interval" and not isinstance(df.schema[c].dataType, T.NumericType)
    ]
    if wrong:
        raise ValueError(f"interval attributes must be numeric: {wrong}")


def _known(column: str, attr: Attr) -> Column:
    """True where the value is inside its domain; false or null elsewhere.

    NaN sorts above every number in Spark, so it is outside any interval.
    """
    c = F.col(column)
    return c.between(*attr.domain) if attr.role == "interval" else c.isin(list(attr.domain))


def _absent(column: str, attr: Attr) -> Column:
    c = F.col(column)
    return (c.isNull() | F.isnan(c.cast("double"))) if attr.role == "interval" else c.isNull()


def _checked(attr: Attr) -> bool:
    return attr.role in ("interval", *LEVELLED)


def replace_outliers(df: DataFrame, amap: AttributeMap, skip: Sequence[str] = ()) -> DataFrame:
    """Values outside their domain become missing."""
    check_map(df, amap)
    out = []
    for c in df.columns:
        attr = amap.get(c)
        if attr and _checked(attr) and c not in skip:
            out.append(F.when(_known(c, attr), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def attribute_audit(df: DataFrame, amap: AttributeMap) -> DataFrame:
    """Per attribute its role, missing values and outliers, in one pass over the table."""
    check_map(df, amap)
    aggs = []
    for i, (c, attr) in enumerate(amap.items()):
        gone = _absent(c, attr)
        aggs.append(F.count_if(gone).alias(f"m{i}"))
        outside = F.count_if(~gone & ~F.coalesce(_known(c, attr), F.lit(False))) if _checked(attr) else F.lit(0)
        aggs.append(outside.cast("bigint").alias(f"o{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("attribute"),
                F.lit(a.role).alias("role"),
                F.col(f"m{i}").alias("missing"),
                F.col(f"o{i}").alias("outliers"),
            )
            for i, (c, a) in enumerate(amap.items())
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def role_counts(audit: DataFrame) -> DataFrame:
    """How many attributes have each role."""
    return audit.groupBy("role").agg(F.count(F.lit(1)).alias("n_attributes"))


def role_figures(audit: DataFrame) -> DataFrame:
    """How many attributes have each role, and how many values of theirs are missing or outliers."""
    return audit.groupBy("role").agg(F.count(F.lit(1)).alias("n_attributes"), F.sum("missing").alias("missing"), F.sum("outliers").alias("outliers"))


@dataclass
class CleanStats:
    """What fitting learns: fill values, and centre and spread of interval columns."""

    fill: dict = field(default_factory=dict)
    centre: dict = field(default_factory=dict)
    spread: dict = field(default_factory=dict)


def learn(
    df: DataFrame, amap: AttributeMap, no_impute: Sequence[str] = (), interval_fill: str = "mean"
) -> CleanStats:
    """All statistics in one aggregate. The mode needs no grouping because the
    map lists the levels: it is the largest of one conditional count per level.
    Medians are exact; the passes that refine them serve all columns at once.

    The spread is taken after filling, so it is what a scaler would see.
    """
    if interval_fill not in ("mean", "median"):
        raise ValueError("interval_fill must be 'mean' or 'median'")
    check_map(df, amap)
    todo = {c: a for c, a in amap.items() if _checked(a) and c not in no_impute}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, attr) in enumerate(todo.items()):
        if attr.role == "interval":
            value = F.when(_known(c, attr), F.col(c).cast("double"))
            aggs += [
                F.count(value).alias(f"n{i}"),
                F.avg(value).alias(f"a{i}"),
                F.var_pop(value).alias(f"v{i}"),
            ]
        else:
            aggs += [F.count_if(F.col(c) == F.lit(v)).alias(f"l{i}_{j}") for j, v in enumerate(attr.domain)]
    row = df.agg(*aggs).first()
    for i, (c, attr) in enumerate(todo.items()):
        if attr.role == "interval" and not row[f"n{i}"]:
            raise ValueError(f"{c} has no value inside its domain")
    medians = {}
    if interval_fill == "median":
        medians = column_medians(df, {c: F.when(_known(c, a), F.col(c).cast("double")) for c, a in todo.items() if a.role == "interval"})
    stats = CleanStats()
    for i, (c, attr) in enumerate(todo.items()):
        if attr.role != "interval":
            counts = [(-row[f"l{i}_{j}"], v) for j, v in enumerate(attr.domain)]
            stats.fill[c] = min(counts)[1]
            continue
        n, mean, var = row[f"n{i}"], row[f"a{i}"], row[f"v{i}"]
        fill = medians.get(c, mean)
        total = row["_rows"]
        centre = (n * mean + (total - n) * fill) / total
        square = n * (var + (mean - centre) ** 2) + (total - n) * (fill - centre) ** 2
        stats.fill[c], stats.centre[c], stats.spread[c] = fill, centre, (square / total) ** 0.5
    return stats


def level_name(column: str, index: int, level) -> str:
    """Name of a 0/1 column: ``cut0:Fair`` for text levels, ``Year2003`` for numbers."""
    return f"{column}{index}:{level}" if isinstance(level, str) else f"{column}{level}"


def _flag(condition: Column) -> Column:
    """1.0 where true, 0.0 where false or null."""
    return F.when(condition, 1.0).otherwise(0.0)


def _is_level(column: str, attr: Attr, level, fill=None) -> Column:
    """0/1 for one level. Without ``fill`` unknown values are missing; with it
    they count as the level ``fill``.

    Written per level and as short as possible: a wide one-hot projection has
    to stay small enough for the JVM to compile.
    """
    c = F.col(column)
    if fill is None:
        return F.when(_known(column, attr), _flag(c == F.lit(level)))
    if level != fill:
        return _flag(c == F.lit(level))
    others = [v for v in attr.domain if v != level]
    return F.when(c.isin(others), 0.0).otherwise(1.0) if others else F.lit(1.0)


def one_hot(column: str, attr: Attr, drop: bool = True, fill=None) -> list[Column]:
    """0/1 columns from the declared levels; ``drop`` leaves out the last level."""
    chosen = list(enumerate(attr.domain))
    return [
        _is_level(column, attr, v, fill).alias(level_name(column, i, v)) for i, v in (chosen[:-1] if drop else chosen)
    ]


class TableCleaner:
    """Outlier removal, imputation, scaling and encoding, learnt once and
    applied to any table with the same columns.

    Columns in ``no_impute`` (the target) are checked against their domain and
    encoded, but neither filled nor scaled. ``keep`` carries columns through
    unchanged; id, text and ignored columns otherwise leave the table.
    """

    def __init__(
        self,
        amap: AttributeMap,
        no_impute: Sequence[str] = (),
        interval_scale: str | None = None,
        drop: bool = True,
        interval_fill: str = "mean",
        keep: Sequence[str] = (),
    ):
        if interval_scale not in (None, "std"):
            raise ValueError("interval_scale must be None or 'std'")
        self.amap, self.no_impute, self.keep = dict(amap), tuple(no_impute), tuple(keep)
        self.interval_scale, self.drop, self.interval_fill = interval_scale, drop, interval_fill
        self.stats: CleanStats | None = None

    def fit(self, df: DataFrame) -> "TableCleaner":
        self.stats = learn(df, self.amap, self.no_impute, self.interval_fill)
        return self

    def _columns(self) -> list[Column]:
        stats = self.stats
        if stats is None:
            raise ValueError("fit the cleaner first")
        out = [F.col(c) for c in self.keep]
        for c, attr in self.amap.items():
            if not _checked(attr):
                continue
            fill = None if c in self.no_impute else stats.fill[c]
            if attr.role == "interval":
                value = F.when(_known(c, attr), F.col(c).cast("double"))
                if fill is not None:
                    value = value.otherwise(F.lit(float(fill)))
                    if self.interval_scale == "std" and stats.spread[c] > 0:
                        value = (value - F.lit(stats.centre[c])) / F.lit(stats.spread[c])
                out.append(value.alias(c))
            elif attr.role == "binary":
                out.append(_is_level(c, attr, attr.domain[1], fill).alias(c))
            elif fill is None:
                out.append(F.when(_known(c, attr), F.col(c)).alias(c))
            else:
                out += one_hot(c, attr, self.drop, fill)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*self._columns()).dropna(subset=list(self.no_impute) or None)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def features(self) -> list[str]:
        """Names of the encoded input columns, in output order."""
        names = []
        for c, attr in self.amap.items():
            if not _checked(attr) or c in self.no_impute:
                continue
            if attr.role == "nominal":
                chosen = list(enumerate(attr.domain))
                names += [level_name(c, i, v) for i, v in (chosen[:-1] if self.drop else chosen)]
            else:
                names.append(c)
        return names
