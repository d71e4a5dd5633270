"""One audit record per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import inkmill


def conversion_log(
    converted: DataFrame,
    output_raw: Column | None = None,
    output_clean: Column | None = None,
    duration_seconds: float | None = None,
) -> DataFrame:
    """Audit fields of converted documents.

    The output columns say where the raw and clean text of a document are; by default they repeat its path. Skipped
    documents keep the location of their earlier output. The duration is that of the run.
    """
    raw = F.col("path") if output_raw is None else output_raw
    clean = F.col("path") if output_clean is None else output_clean
    skipped = F.col("status") == "skipped"
    return converted.select(
        F.col("path").alias("input_file"),
        F.col("size").alias("input_size_bytes"),
        F.col("ext").alias("detected_type"),
        F.col("mode").alias("selected_mode"),
        "escalated_to",
        "retry_count",
        F.lit(inkmill.__version__).alias("engine_version"),
        F.when(skipped | F.col("raw_md").isNotNull(), raw).alias("output_raw"),
        F.when(skipped | (F.col("status") == "success"), clean).alias("output_clean"),
        "validation",
        F.round(F.lit(duration_seconds).cast("double"), 3).alias("duration_seconds"),
        "status",
        "error",
    )


def stamped(log: DataFrame) -> DataFrame:
    """Add the time and the engine's platform, as at writing."""
    return log.withColumns({"timestamp": F.current_timestamp(), "spark_version": F.lit(log.sparkSession.version)})


def as_json(log: DataFrame) -> DataFrame:
    """One JSON object per record; missing values are written as null."""
    return log.select(F.to_json(F.struct(*log.columns), {"ignoreNullFields": "false"}).alias("json"))
