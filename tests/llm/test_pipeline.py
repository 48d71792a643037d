"""The pipeline's stages on planted documents, and the contract's shape."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from loomstat.llm import pieces, queries, simhash


def test_whole_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now, before = docs, docs.count()
    texts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert sorted(now.columns) == sorted(docs.columns), name
        texts.append((name, now.count()))
        now = spark.createDataFrame(now.collect(), docs.schema)
    counts = dict(texts)
    assert before >= counts["toxicity"] == counts["line_dedup"] > counts["simhash_dedup"] > 0.7 * before
    machine = pieces.PieceTransducer(pieces.read_model(queries.PIECE_MODEL))
    coded = corpus_pipeline.STAGES[-1][1](spark, now, folder).collect()
    want = sorted((r.doc_id, tuple(machine.encode(r.text).tolist())) for r in now.collect())
    assert sorted((r.doc_id, tuple(r.pieces)) for r in coded) == want
    assert len(corpus_pipeline.run(spark, folder).collect()) == len(want)


def test_near_copies_leave_one(spark, folder):
    body = " ".join(f"word{i}" for i in range(300))
    rows = [(i, body + (f" tail{i}" if i % 2 else ""), "en", f"s{i % 3}", 1) for i in range(30)] + [(99, "another text of its own kind", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    groups = {r.doc_id: r.component_id for r in simhash.group_near_duplicates(docs).collect()}
    kept = {r.doc_id for r in corpus_pipeline.keep_first(spark, docs, folder).collect()}
    assert kept == {d for d, g in groups.items() if d == g} and 99 in kept and 0 in kept


def test_the_rest_stands_alone(tmp_path):
    """Without the subpackage and the pipeline the entry still imports, with the other queries."""
    root = Path(corpus_pipeline.__file__).parent
    code = (
        "import sys, importlib.util as u; real = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n in ('loomstat.llm', 'loomstat.llm.queries', 'corpus_pipeline') else real(n, *a)\n"
        "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q) and 'pipeline' not in q\n"
        "assert not any(m.startswith('loomstat.llm') for m in sys.modules)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
