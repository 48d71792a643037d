import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Clashes with names an operator might use for itself.
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)

AWKWARD = [
    None, "", " \t\n", "a", "same line\nsame line\n\nsame line", "mail x.y@a.b.c_d@e.f, a@b a@b.c@d.e a@b.c.", "é😀 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004",
    "4111 1111 1111 1111 4111-1111-1111-1112 1" + "2" * 40, "+1 (555) 010-9999 +12 +1234567 +49 30 1234567890 12345678", "IBAN DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 GB82WEST12345698765431",
    "my ssn 123-45-6789 and 123-45-6789x", "A b C d E f\x0bg\x0ch\x1ci", "word " * 30000, "x" * 50000, "1" * 20000 + " " + "a." * 20000 + "@", "+1" * 5000 + "0 1 " * 5000,
    "l'été naïve straße ÀÉ", "the same text in two rows of it", "the same text in two rows of it",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, **columns):
        rows = []
        for i, text in enumerate(texts):
            row = {"doc_id": i, "text": text, "lang": "en", "source": f"s{i % 4}" if i % 5 else None, "n_chars": len(text or ""), "key": "k", "size": 7}
            row |= {name: values[i] for name, values in columns.items()}
            rows.append(tuple(row[f.name] for f in DOCS.fields))
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Awkward texts, a null id and a repeated row."""
    texts = [*AWKWARD, "orphan", "the same row", "the same row"]
    ids = [*range(len(AWKWARD)), None, 100, 100]
    return make_docs(texts, doc_id=ids)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
