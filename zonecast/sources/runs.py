"""Run tables: predictions, summaries and evaluations are rows of partitioned tables keyed by
``run_id`` (and model, district), not folders of per-district files (SURVEY 2.1
``sink_per_district``, ``latest_run_by_name``, ``latest_run_by_mtime``, ``publish_latest``,
``model_store``).

A run id is ``<prefix>_<UTC yyyyMMdd_HHmmss>``, so name order is time order. "Latest"
is a scalar subquery (``max(run_id)``), and partition pruning on ``run_id`` keeps the
read to that run's files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_run_id(prefix: str, now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{prefix}_{now.strftime('%Y%m%d_%H%M%S')}"


# rows per output file; a larger partition value is split into several files
MAX_RECORDS_PER_FILE = 5_000_000


def sink_run(df: DataFrame, path: str, run_id: str, partition_by=("run_id",)) -> None:
    """Write one run's rows (e.g. predictions partitioned by run_id, model, district).
    Writing a partition (run, model) again replaces it, so a rerun leaves no duplicates.

    Rows are first hash-partitioned by the partition columns that vary within the run
    (never by the constant run_id, which would funnel the run into one task), so each
    value is written by one task instead of one small file per task and value; large
    values are split at ``MAX_RECORDS_PER_FILE`` rows per file. Run tables hold model
    outputs (one row per district and hour at most), so one value per task is bounded
    even for the busiest district."""
    out = df.withColumn("run_id", F.lit(run_id)).withColumn("written_at", F.current_timestamp())
    varying = [c for c in partition_by if c != "run_id"]
    if varying:  # with the district, so that one model's rows are not one task's
        out = out.repartition(*varying, *[c for c in ("district", "cd_name") if c in df.columns and c not in varying])
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_by).parquet(path))


def latest_run_by_name(table: DataFrame, prefix: str) -> DataFrame:
    """Rows of the run whose id sorts last among the ids starting with ``prefix``."""
    runs = table.where(F.col("run_id").startswith(prefix))
    last = runs.agg(F.max("run_id")).scalar()
    return runs.where(F.col("run_id") == last)


def run_rows(table: DataFrame, run_id: str) -> DataFrame:
    """Rows of exactly this run."""
    return table.where(F.col("run_id") == run_id)


def latest_run_by_mtime(table: DataFrame, prefix: str) -> DataFrame:
    """Rows of the run written last (``written_at``), among ids starting with ``prefix``."""
    runs = table.where(F.col("run_id").startswith(prefix))
    last = runs.agg(F.max_by("run_id", "written_at")).scalar()
    return runs.where(F.col("run_id") == last)


def publish_latest(spark: SparkSession, eval_path: str, out_path: str, prefix: str = "eval") -> bool:
    """Copy the newest evaluation run to a fixed 'latest' table; False when none exists."""
    try:
        t = spark.read.parquet(eval_path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no table yet
            return False
        raise
    latest = latest_run_by_name(t, prefix)
    if latest.isEmpty():
        return False
    latest.write.mode("overwrite").parquet(out_path)
    return True


def save_models(path: str, run_id: str, features, **models: DataFrame) -> None:
    """Keep fitted models as rows: each named model (one row per district or tree) under
    ``path/<name>``, partitioned by run. Saving a run again replaces it. The feature names, in the
    order of the coefficients and feature numbers, go with every row."""
    names = F.array(*[F.lit(f) for f in features])
    for name, rows in models.items():
        sink_run(rows.withColumn("model_features", names), f"{path}/{name}", run_id)


def load_models(spark: SparkSession, path: str, prefix: str, names=("linear", "trees"), run_id: str | None = None) -> dict:
    """The models of a run (by default the latest whose id starts with ``prefix``) as
    DataFrames, with ``run_id`` and ``features``; apply them by join (``predict_linear``,
    ``trees.predict``)."""
    out: dict = {}
    for name in names:
        table = spark.read.parquet(f"{path}/{name}")
        if run_id is None:
            run_id = latest_run_by_name(table, prefix).agg(F.max("run_id")).first()[0]
            if run_id is None:
                raise LookupError(f"no run starting with {prefix!r} under {path}")
        rows = run_rows(table, run_id)
        first = rows.select("model_features").first()
        if first is None:
            raise LookupError(f"run {run_id!r} has no {name} model under {path}")
        out["features"] = list(first[0])
        out[name] = rows.drop("run_id", "written_at", "model_features")
    return {**out, "run_id": run_id}


def save_model(model, path: str) -> None:
    """Persist a fitted ``pyspark.ml`` model or pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
