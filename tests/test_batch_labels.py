"""Labels of batches: their values, and no pattern that is searched for at the end of a path."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeward.sources.batches import batch_label

LABELS = [("file:/a/b/batch_1.csv", "batch_1.csv"), ("s3://b/x/day=3", "3"), ("day=3=4", "3=4"), ("=x", "=x"), ("d=", ""), ("plain", "plain"),
          ("a=b/c", "c"), ("a/", ""), ("", ""), ("a\n/b\n", "b\n"), (None, None)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "path string, label string").withColumn("got", batch_label(F.col("path")))


def test_labels(labels):
    assert {r["path"]: r["got"] for r in labels.collect()} == dict(LABELS)


def test_labels_match_the_pattern_they_replace(labels):
    old = F.regexp_replace(F.regexp_extract("path", r"[^/]+$", 0), r"^[^=/]+=", "")
    assert labels.where(~F.col("got").eqNullSafe(old)).count() == 0


def test_no_row_searches_its_path_for_a_pattern(labels):
    assert "regexp_extract" not in labels._jdf.queryExecution().optimizedPlan().toString()
