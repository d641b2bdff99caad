"""Score arriving ticket files with a model fitted by the batch job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from catlens.config import JobConfig
from catlens.operators import cleaning, features, labels


def read_csv_dir_stream(spark: SparkSession, path: str, columns: list[str], max_files_per_trigger: int | None = None) -> DataFrame:
    """A1 as a file stream: header CSV files, every column a string (a stream
    needs its schema up front; all-string is what the batch reader yields). A
    file whose header has other or swapped columns raises, as in the batch reader."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.readStream.format("csv").option("header", "true").option("enforceSchema", "false").schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def score_stream(stream: DataFrame, model: PipelineModel, top_codes: list[int], cfg: JobConfig) -> DataFrame:
    """Clean, label with the batch job's top codes and predict, row by row.

    ``top_codes`` and ``model`` come from the batch run (``JobResult``); the
    result is an append-only stream of (display columns, actual, predicted).
    """
    cleaned = cleaning.clean(stream, cfg)
    labelled = labels.lump_other(cleaned, cfg.code_out, cfg.label_col, top_codes)
    pred = features.index_to_label(model, model.transform(labelled))
    keep = ([cfg.key_col] if cfg.key_col else []) + list(cfg.sample_cols) + [cfg.hour_bucket_out, cfg.label_col, features.PREDICTED_LABEL]
    return pred.select(*[cleaning.qcol(c) for c in keep])


def write_scored_stream(scored: DataFrame, out_path: str, checkpoint_location: str, available_now: bool = False):
    """Start the scored stream into a Parquet folder (A4 for a stream).

    The file sink and the source offsets are tracked in
    ``checkpoint_location``, a folder of this stream on storage that the cluster
    shares. Pass the same location again to resume: files already
    committed are neither re-read nor written twice, so a lost driver or
    executor means a restart, not duplicates. ``available_now`` processes
    what is there and stops.
    """
    w = scored.writeStream.format("parquet").outputMode("append").option("path", out_path).option(
        "checkpointLocation", checkpoint_location
    )
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
