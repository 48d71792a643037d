"""Spans against a plain Python reading of the rules."""

import hashlib
import re

from pyspark.sql import functions as F

from loomstat.llm import personal_data, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, found):
    number = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p or "0") <= 255 if len(p) < 4000 else int(p[-4000:]) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 8 <= len(number) <= 15
    return True


def base_spans(text):
    # Python's own email pattern would take quadratic time on long runs; those hold no match here.
    out = []
    for kind, pattern in BASE.items():
        if kind == "email" and not re.search("@[A-Za-z0-9]", text or ""):
            continue
        out += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return out


def check(rows):
    for row in rows:
        want = base_spans(row.text)
        got = [s for s in row.digest.split(",") if s.split(":")[0] in BASE]
        assert got == want, row.doc_id


def test_awkward_texts(awkward):
    found = personal_data.find_personal_data(awkward)
    assert found.columns == [*awkward.columns, "spans"]
    rows = found.select("doc_id", "text", personal_data.digest(F.col("spans")).alias("digest")).collect()
    assert len(rows) == awkward.count()
    check(rows)
    spans = {r.doc_id: r.digest for r in rows}
    assert spans[5].startswith("email:")
    assert spans[9].count("iban:") == 2
    assert spans[10] == "ssn:7:18"
    assert spans[0] == spans[1] == ""


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op7_personal_data(spark, folder).collect()}
    hits = 0
    for d in docs.collect():
        want = base_spans(d.text)
        row = rows[d.doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(k) for s in want) for k in BASE]
        hits += len(want)
    assert hits > 10 and len(rows) == docs.count()


def test_checks(spark):
    found = spark.createDataFrame([("4111111111111111", "DE89370400440532013000"), ("4111111111111112", "DE88370400440532013000")], "card string, iban string")
    got = found.select(personal_data.luhn(F.col("card")), personal_data.mod97(F.col("iban"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False)]


def test_redact_and_empty(awkward, nothing):
    found = personal_data.find_personal_data(awkward.where("doc_id = 10"))
    assert personal_data.redact(found).first().text == "my ssn <ssn> and 123-45-6789x"
    assert personal_data.find_personal_data(nothing).collect() == []


def test_no_python_in_plan(awkward):
    plan = personal_data.find_personal_data(awkward.drop("key"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("PythonRDD", "") or "ArrowEval" not in plan


def test_text_of_many_spans(make_docs):
    """100,000 addresses in one text and context words across block borders: time grows with the spans, not with their square."""
    far = "x" * 985 + " social security " + "123-45-6789 " + "y" * 3000 + "123-45-6789 " + "é😀" * 480 + " 123-45-6789 " + "z " * 15 + "SSN "
    docs = make_docs([" ".join(f"a{i}@b.example" for i in range(100_000)), far])
    rows = {r.doc_id: r for r in personal_data.find_personal_data(docs).select("doc_id", "text", personal_data.digest(F.col("spans")).alias("digest"), "spans").collect()}
    check(rows.values())
    assert len(rows[0].spans) == 100_000
    assert [s.start for s in rows[1].spans if s.kind == "ssn"] == [m.start() for m in re.finditer("123-45", far) if m.start() != 4014]
