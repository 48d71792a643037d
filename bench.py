"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
Each query runs once untimed (code generation, Python workers) and is then
timed to the end of a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from loomstat.plans import registry
from loomstat.session import build_session

HEADLINES = [
    "t12_sentiment_by_source",
    "t9_term_table",
    "t5_ngrams",
    "t6_doc_term",
    "t8_tfidf",
    "t10_zipf_table",
    "t2_apply_synonyms",
    "r2_dedup_text",
    "r14_crosstab_row",
    "r16_pivot_multi",
    "r10_count_terms",
    "s9_articles_from_pages",
    "p6_attribute_audit",
    "c9_fit_train_apply_valid",
    "m2_kfold_stratified",
    "m3_gram",
    "m4_ols_full",
    "m5_residual_shape",
    "m8_lasso_path",
    "m12_regression_metrics",
    "m22_stepwise_linear",
    "m23_genetic_linear",
    "m23_genetic_logistic",
    "d1_influence_full",
    "d5_diag_summary",
    "x2_running_group_sentiment",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        spark.catalog.clearCache()
        return took

    timings = {}
    for name in names:
        run(name)
        timings[name] = round(run(name), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
