"""CSV and JSON tables, complaint scans, model folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The complaint file's header, and the names used in this package.
COMPLAINT_COLUMNS = {
    "Ticket ID": "ticket_id", "Ticket Created": "ticket_created", "Date of Issue": "date_of_issue",
    "Time of Issue": "time_of_issue", "Form": "form", "Method": "method", "Issue": "issue", "Caller ID Number": "caller_id",
    "Type of Call or Messge": "call_type", "Advertiser Business Number": "advertiser", "City": "city", "State": "state",
    "Zip": "zip", "Location (Center point of the Zip Code)": "location",
}


def scan_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text scan. Rows with too many fields are skipped; rows with too few are kept, padded with null."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_corrupt_record"])
    rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("multiLine", False)
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    too_long = F.col("_corrupt_record").isNotNull() & F.col(f"`{columns[-1]}`").isNotNull()
    return rows.filter(~too_long).drop("_corrupt_record")


def scan_complaints(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, list(COMPLAINT_COLUMNS)).withColumnsRenamed(COMPLAINT_COLUMNS)


def scan_csv_typed(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Text scan by header name, then the named casts; values that do not fit become null."""
    rows = spark.read.option("header", True).csv(path)
    return rows.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if c in rows.columns})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def save_model(model: PipelineModel, path: str, threshold: float, features: list[str]) -> None:
    """Model folder plus a one-row table with its threshold and feature order."""
    model.write().overwrite().save(f"{path}/model")
    SparkSession.active().createDataFrame([(threshold, features)], "threshold double, features array<string>").write.mode("overwrite").parquet(
        f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, float, list[str]]:
    meta = spark.read.parquet(f"{path}/meta").first()
    return PipelineModel.load(f"{path}/model"), meta["threshold"], list(meta["features"])


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
