"""No secret is cut at a length, no context at two words."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii, queries, stupid_backoff


@pytest.mark.parametrize("length", [6, 256, 257, 600, 20_000])
def test_a_secret_of_any_length_is_redacted(spark, length):
    secret = ("eyJhbGciOi.JIUzI1-NiJ9_" * (length // 20 + 1))[:length]
    df = pii.find_pii(spark.createDataFrame([(f"token: {secret} and more",)], "text string"))
    assert [r[0] for r in df.select(pii.redact(F.col("text"), F.col("pii"))).collect()] == ["token: <secret> and more"]


def test_trigrams_are_scored(spark, tmp_path):
    spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "x b d"), (4, "x b d")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.log_score for r in queries.op6_trigrams(spark, str(tmp_path)).collect()}
    # One word in twelve, twice; what follows is certain with two words before it, not with one.
    assert found[1] == pytest.approx(math.log(2 / 12), abs=1e-4)
    two = {r.doc_id: r.log_score for r in queries.op6_backoff(spark, str(tmp_path)).collect()}
    assert two[1] == pytest.approx(math.log(2 / 12) + math.log(2 / 4), abs=1e-4)
    assert stupid_backoff.ORDER == 2
