"""How many texts a Python worker is handed at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

TEXTS_PER_BATCH = 1_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``TEXTS_PER_BATCH`` rows.

    Texts are long: the default of 10,000 rows is held several times over in an
    executor and its workers. A session that asks for fewer rows keeps its value.
    """
    if int(spark.conf.get(_SETTING)) > TEXTS_PER_BATCH:
        spark.conf.set(_SETTING, str(TEXTS_PER_BATCH))
