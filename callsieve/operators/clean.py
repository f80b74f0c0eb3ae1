"""Cleaning and preparation of the fraud tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quantiles import exact_quantiles

# Fixed values.
POISON_CLUSTER = "C_POISON_BOT"
BOT_TEST_TAG = "機器人測試"
SCALED = ["Report_Count", "Financial_Loss", "report_loss_interaction", "financial_loss_log"]


def clean_fraud(df: DataFrame) -> DataFrame:
    """Type, filter, default, impute and clamp the production table; poison rows go last."""
    for name in ("Report_Count", "Financial_Loss", "Label"):
        df = df.withColumn(name, F.col(name).try_cast("double"))
    df = df.filter(F.col("Label").isin(0, 1)).withColumn("Label", F.col("Label").cast("int"))
    if "Cluster_ID" not in df.columns:
        df = df.withColumn("Cluster_ID", F.lit(None).cast("string"))
    df = df.fillna({"Cluster_ID": "C_UNKNOWN"}).fillna("UNKNOWN", [c for c in ("Age_Group", "Education") if c in df.columns])
    medians = exact_quantiles(df, {n: F.col(n) for n in ("Report_Count", "Financial_Loss")}, [0.5])
    for name, (median,) in medians.items():
        df = df.withColumn(name, F.greatest(F.coalesce(F.col(name), F.lit(median)), F.lit(0.0)))
    return df.filter(F.col("Cluster_ID") != POISON_CLUSTER)


def zscore_filter(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Keep rows with |z| < limit (population deviation); unchanged below 3 values or without spread."""
    stats = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("sd")).first()
    if stats["n"] < 3 or not stats["sd"]:
        return df
    return df.filter(F.abs((F.col(column) - stats["mean"]) / stats["sd"]) < limit)


def clip_percentile(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    floor, ceiling = exact_quantiles(df, {column: F.col(column)}, [low, high])[column]
    clipped = F.greatest(F.least(F.col(column), F.lit(ceiling)), F.lit(floor))
    return df.withColumn(column, F.when(F.col(column).isNotNull(), clipped))


def derive_fraud(df: DataFrame) -> DataFrame:
    cutoff = exact_quantiles(df, {"x": F.col("Report_Count")}, [0.90])["x"][0]
    return (df.withColumn("report_loss_interaction", F.col("Report_Count") * F.col("Financial_Loss"))
            .withColumn("financial_loss_log", F.log1p(F.greatest("Financial_Loss", F.lit(0.0))))
            .withColumn("high_frequency_flag", (F.col("Report_Count") > cutoff).cast("int")))


def levels(df: DataFrame, column: str) -> list[str]:
    """All distinct values of a category. Each becomes a column of the plan, which is what bounds their number."""
    return sorted(r[0] for r in df.filter(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """One 0/1 column per value, all levels kept; a null row gets only zeros."""
    for name in [c for c in columns if c in df.columns]:
        flags = {f"{name}_{v}": F.coalesce(F.col(name) == v, F.lit(False)).cast("int") for v in levels(df, name)}
        df = df.withColumns(flags).drop(name)
    return df


def robust_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - median) / IQR, with scale 1 for an IQR of 0."""
    quarters = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    scaled = {}
    for name, (q1, median, q3) in quarters.items():
        spread = (q3 - q1) if q1 is not None and q3 != q1 else 1.0
        scaled[name] = (F.col(name) - (median or 0.0)) / spread
    return df.withColumns(scaled)


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation, with scale 1 for a deviation of 0."""
    stats = df.agg(*[f(c).alias(f"{c}_{i}") for c in columns for i, f in enumerate((F.avg, F.stddev_pop))]).first()
    return df.withColumns({c: (F.col(c) - stats[f"{c}_0"]) / (stats[f"{c}_1"] or 1.0) for c in columns})


def prepare_fraud(df: DataFrame) -> DataFrame:
    """The whole production chain; the order of steps decides the result."""
    df = cut_lineage(clean_fraud(df))  # the statistics of the next steps read it again and again
    df = derive_fraud(clip_percentile(zscore_filter(df, "Report_Count"), "Financial_Loss"))
    df = df.drop("Report_Time", "Cluster_ID")
    return robust_scale(one_hot(df, ["Age_Group", "Education"]), SCALED)


def clean_legacy(df: DataFrame) -> DataFrame:
    df = df.withColumns({c: F.col(c).try_cast("double") for c in ("Report_Count", "Transaction_Amount", "Is_Fraud")})
    if "Tags" in df.columns:
        df = df.filter(~F.coalesce(F.col("Tags").contains(BOT_TEST_TAG), F.lit(False)))
    return zscore_filter(df.filter(F.col("Report_Count") < 5000), "Report_Count")


def prepare_legacy(df: DataFrame) -> DataFrame:
    df = clean_legacy(df).drop("Phone_Number", "Report_Time")
    return robust_scale(one_hot(df, ["Victim_Demographic", "Tags"]), ["Report_Count", "Transaction_Amount"])


def detect_schema(df: DataFrame) -> str:
    """Which preparation a table needs, from its column names."""
    marks = {"caller_id": "complaints", "Caller ID Number": "complaints", "Is_Fraud": "legacy", "Label": "production"}
    for column, layout in marks.items():
        if column in df.columns:
            return layout
    raise ValueError(f"unknown table layout: {sorted(df.columns)}")


def route(df: DataFrame) -> DataFrame:
    from .complaints import clean

    return {"complaints": clean, "production": prepare_fraud, "legacy": prepare_legacy}[detect_schema(df)](df)
