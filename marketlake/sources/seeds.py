"""Static seed catalogues (SRC-20) and the model run log (HMM-10)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_seeds import COMMON_LABOUR_SERIES, MAJOR_CATEGORY_IDS
from ..operators.common import broadcast_fixed
from ..operators.joins import lookup_with_default
from ..operators.order import keep_first
from .sink import append_table


def major_categories(spark: SparkSession) -> DataFrame:
    """Seed category ids (fixed size) with their list position."""
    rows = [(int(c), i) for i, c in enumerate(sorted(MAJOR_CATEGORY_IDS))]
    return broadcast_fixed(spark.createDataFrame(rows, "category_id long, position int"))


def common_series(spark: SparkSession) -> DataFrame:
    rows = [(sid, title, survey, i) for i, (sid, title, survey) in enumerate(COMMON_LABOUR_SERIES)]
    return broadcast_fixed(spark.createDataFrame(rows, "series_id string, title string, survey string, position int"))


def label_seed_categories(spark: SparkSession, names: DataFrame) -> DataFrame:
    """Seed ids joined to known names (JOIN-11): unknown ids get
    'Category <id>'."""
    return lookup_with_default(major_categories(spark), names, "category_id", "name")


def first_category_per_series(series_by_category: DataFrame) -> DataFrame:
    """WIN-2 on a discovery result (series_id, category_id, position): a
    series seen under several seed categories keeps the first in order."""
    return keep_first(series_by_category, ["series_id"], ["position", "category_id"])


# --------------------------------------------------------------------- HMM-10
RUN_SCHEMA = ("run_id string, model_key string, params string, metrics string, tags string, "
              "logged_at timestamp")


def run_record(spark: SparkSession, run_id: str, model_key: str, params: dict, metrics: dict,
               tags: dict | None = None) -> DataFrame:
    """One row describing a fitted model: parameters, metrics and tags as
    JSON text (the model itself is stored by ``HMMParams.to_json``)."""
    row = (run_id, model_key, json.dumps(params, sort_keys=True, default=str),
           json.dumps(metrics, sort_keys=True, default=float), json.dumps(tags or {}, sort_keys=True),
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return spark.createDataFrame([row], RUN_SCHEMA)


def log_runs(records: DataFrame, runs_path: str) -> None:
    """Append run rows (one per model key) to the runs table."""
    append_table(records.withColumn("logged_date", F.to_date("logged_at")), runs_path)
