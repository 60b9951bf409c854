"""A corpus that no language can be learned from."""

import cases
from pyspark.sql import functions as F

from wonweave.llm import language


def test_lettered_rows_stay_without_a_model(spark):
    docs = cases.docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = language.drop_unknown(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in cases.DOCS) > 0
