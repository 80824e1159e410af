"""Tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])
# Names that operators use for results or inside; as input columns they must do no harm.
CLASHES = ("n_words", "kept", "id", "h1", "bucket", "score", "fingerprint", "component_id", "n_lines", "n_dropped", "label",
           "spans_", "key", "text_hash", "keeper", "least", "_row", "_row0", "_key", "_salt", "distance", "x")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples."""
    def make(rows, extra=False):
        full = [(r[0], r[1], *(r[2:] or (None, None)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("x") for c in CLASHES})
        return df
    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text, odd bytes."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"
    long = " ".join(f"w{i % 997} x{i}" for i in range(60_000))
    return [
        (1, words, "en", "a"), (2, words, "en", "a"), (3, words + " tau", None, "a"), (3, words + " tau", None, "a"),
        (4, None, "de", None), (5, "", None, None), (6, " \t\n\x0b ", "fr", "b"), (None, words, "en", "b"),
        (None, None, None, None), (7, long, "en", "a"), (8, "É ü \U0001f600 <|endoftext|> token", "de", "b"),
        (9, "\n".join(["This line is shared by many documents."] * 3), "en", "a"),
        (10, "  this line is SHARED by many documents.\t\nown", "en", "a"),
        (11, "This line is shared by many documents.", "en", "a"), (12, "a", "en", "a"), (12, "b c", "en", "a"),
    ]
