"""Sending this package to the executors of a session that doesn't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_AT_ONCE = 1_000        # rows of an Arrow batch: a bound on what executors and workers hold of whole texts


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per application.

    ``spark-submit --py-files`` does the same; doing it here keeps queries runnable from
    any session.  The archive goes through Spark's own file distribution, so the driver's
    temporary folder needn't be shared.
    """
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "ampora_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Let rows go to the workers in batches of at most ``TEXTS_AT_ONCE``; a smaller setting of the session stays.

    Spark's default of 10,000 rows has a worker and the executor hold some 20 MB of texts of 2 KB for each task, several
    times over, and long-lived executors keep that memory.
    """
    if not 0 < int(spark.conf.get(_ROWS)) <= TEXTS_AT_ONCE:
        spark.conf.set(_ROWS, str(TEXTS_AT_ONCE))
