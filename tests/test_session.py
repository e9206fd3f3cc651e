"""Scratch tables in the shared folder."""

import os
from urllib.parse import urlparse

from tallyloom.session import discard, written


def test_written_tables_read_back_and_go(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    table, path = written(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert spark.conf.get(setting, None) == before
    assert sorted(r["count"] for r in table.collect()) == [14] * 5 + [15] * 2
    other, kept = written(table, "copy")
    discard(spark, path)
    assert not os.path.exists(urlparse(path).path or path)
    assert other.count() == 7 and os.path.exists(urlparse(kept).path or kept)
    discard(spark, path)  # a table that is gone is no error
