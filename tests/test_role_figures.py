"""Figures per role come from the table."""

from pyspark.sql import functions as F

from loomstat.operators import clean
from loomstat.plans import clean_queries


def test_role_figures_follow_the_rows(spark):
    rows = [(1, 5000.0), (2, None), (3, 5.0), (None, 7.0)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_extendedprice double")
    for name in clean_queries.LINE_MAP:
        if name not in lines.columns:
            lines = lines.withColumn(name, F.lit(None).cast("string" if name in ("l_returnflag", "l_linestatus", "l_shipdate") else "double"))
    got = {r.role: (r.n_attributes, r.missing, r.outliers) for r in clean.role_figures(clean.attribute_audit(lines, clean_queries.LINE_MAP)).collect()}
    assert got["id"] == (1, 1, 0) and got["interval"] == (4, 13, 2) and got["nominal"] == (1, 4, 0)
