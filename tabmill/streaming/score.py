"""The fitted cleaning steps applied to new data as it arrives.

Clipping with fitted fences, filling with fitted medians, the positive
floor and the log columns are row-wise projections with literals, so the
same plan serves a batch or a streaming DataFrame; no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabmill.operators import clean
from tabmill.plans.pipeline import Preprocessed


def apply_cleaning(df: DataFrame, pre: Preprocessed) -> DataFrame:
    """Apply ``pre``'s fitted values to rows of the raw layout and keep the
    selected columns (no job runs here)."""
    targets = [t for t in pre.spec.targets if t not in pre.log_targets]
    out = clean.apply_clip(df, pre.fences)
    out = clean.apply_medians(out, pre.medians)
    fix = {c: F.when(F.col(c) < F.lit(clean.POSITIVE_FLOOR), F.lit(clean.POSITIVE_FLOOR))
           .otherwise(F.col(c)).cast("double") for c, n in pre.floor_counts.items() if n > 0}
    if fix:
        out = out.withColumns(fix)
    out = clean.log_targets(out, targets)
    return out.select(pre.spec.id, *pre.kept, *targets, *pre.log_targets)


def clean_stream(spark: SparkSession, source_dir: str, schema: T.StructType, pre: Preprocessed,
                 sink_dir: str, checkpoint_dir: str, fmt: str = "parquet") -> StreamingQuery:
    """Read new files of the raw layout from ``source_dir`` and append their
    cleaned rows to ``sink_dir`` (exactly once through the checkpoint)."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    return (apply_cleaning(stream, pre).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint_dir).outputMode("append")
            .start(sink_dir))
