"""The terms of clusters need one count of the words of all documents."""

import pytest

from loomstat.operators import topics


def test_words_are_counted_once(spark):
    rows = [(i, t, float(v)) for i in range(12) for t, v in (("both", 2), ("odd" if i % 2 else "even", 3))]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    weights = spark.createDataFrame(rows, "id long, term string, value double").mapInArrow(counted, "id long, term string, value double")
    assigned = spark.createDataFrame([(i, i % 2 if i < 10 else None) for i in range(13)], "id long, cluster int")
    terms = topics.cluster_terms(weights, "id", assigned, 2)
    # Two branches that happen to be planned alike are merged as they run, others are not, so the plan must have one.
    assert terms._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    found = {(r.cluster, r.place): (r.term, r.lift) for r in terms.collect()}
    assert seen.value == len(rows)
    # Thirteen documents, five in either cluster, two in none and one without words, which counts all the same.
    assert found == {
        (0, 1): ("even", pytest.approx(3.0 - 18 / 13)), (0, 2): ("both", pytest.approx(2.0 - 24 / 13)),
        (1, 1): ("odd", pytest.approx(3.0 - 18 / 13)), (1, 2): ("both", pytest.approx(2.0 - 24 / 13)),
    }
