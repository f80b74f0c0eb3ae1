"""Table profiling: missing cells, duplicates, outliers, distributions, correlation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame, target: str | None = None) -> list[str]:
    return [n for n, t in df.dtypes if n != target and (t in NUMERIC or t.startswith("decimal"))]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def long_form(one_row: DataFrame, columns: list[str], measures: list[str], name: str = "column") -> DataFrame:
    """Turn one row of ``{column}__{measure}`` cells into a row per column."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), *[F.col(f"`{c}__{m}`").alias(m) for m in measures]) for c in columns
    ])).alias("r")).select("r.*")


def picked(df: DataFrame, columns: list[str] | None, target: str | None = None) -> list[str]:
    """The named columns, or all numeric ones but the target."""
    return numeric_columns(df, target) if columns is None else columns


def pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, 2), F.lit(0.0))


def missing(df: DataFrame, fail_at: float = 20.0) -> DataFrame:
    """Null count and share per column, in one pass."""
    row = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}__missing") for c in df.columns])
    share = {c: pct(F.col(f"{c}__missing"), F.col("_rows")) for c in df.columns}
    row = row.withColumns({f"{c}__missing_pct": s for c, s in share.items()})
    return long_form(row, df.columns, ["missing", "missing_pct"]).withColumn("pass", F.col("missing_pct") < fail_at)


def duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows; equal rows are combined map-side."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.sum("_n").alias("rows"), (F.sum("_n") - F.count("*")).alias("duplicates")).withColumn(
        "duplicate_pct", pct(F.col("duplicates"), F.col("rows")))


def iqr_outliers(df: DataFrame, columns: list[str] | None = None, guarded: bool = False, flag_above: float = 5.0) -> DataFrame:
    """Values beyond 1.5 IQR; ``guarded`` reports none below 5 values or for an IQR of 0."""
    columns = picked(df, columns)
    quarters = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.75])
    cells = []
    for c, (q1, q3) in quarters.items():
        spread = (q3 - q1) if q1 is not None else 0.0
        outside = F.lit(False) if q1 is None else (F.col(c) < q1 - 1.5 * spread) | (F.col(c) > q3 + 1.5 * spread)
        found = F.count_if(outside)
        if guarded:
            found = F.when((F.count(c) < 5) | F.lit(spread == 0), F.lit(0)).otherwise(found)
        cells += [F.count(c).alias(f"{c}__values"), found.cast("long").alias(f"{c}__outliers")]
    return (long_form(df.agg(*cells), columns, ["values", "outliers"])
            .withColumn("outlier_pct", pct(F.col("outliers"), F.col("values")))
            .withColumn("flagged", F.coalesce(F.try_divide("outliers", "values") * 100 > flag_above, F.lit(False))))


def z_extremes(df: DataFrame, columns: list[str] | None = None, limit: float = 3.0) -> DataFrame:
    """Values with |z| > limit; columns without spread are left out."""
    columns = picked(df, columns)
    stats = df.agg(*[f(c).alias(f"{c}__{i}") for c in columns for i, f in enumerate((F.avg, F.stddev_pop))]).first()
    spread = [c for c in columns if stats[f"{c}__1"]]
    row = df.agg(F.count("*").alias("_rows"), *[
        F.count_if(F.abs((F.col(c) - stats[f"{c}__0"]) / stats[f"{c}__1"]) > limit).alias(f"{c}__extremes") for c in spread])
    return long_form(row, spread, ["extremes"])


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact count, mean, sample deviation, minimum, quartiles and maximum per column."""
    columns = picked(df, columns)
    quarters = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    plain = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(F.col(c).cast("double") if m in ("min", "max") else c).alias(f"{c}__{m}")
                   for c in columns for m, f in plain.items()])
    row = row.withColumns({f"{c}__{m}": F.lit(v).cast("double") for c in columns
                           for m, v in zip(("q25", "q50", "q75"), quarters[c])})
    return long_form(row, columns, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"])


def categorical(df: DataFrame, columns: list[str], one_hot_below: int = 10) -> DataFrame:
    """Distinct values per text column with an encoding hint, counted in two combinable levels."""
    cells = df.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "value"))
    per_value = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    return per_value.groupBy("column").agg(F.count("value").alias("n_unique")).withColumn(
        "encoding_hint", F.when(F.col("n_unique") < one_hot_below, "One-Hot").otherwise("Target Encoding"))


def column_types(df: DataFrame) -> DataFrame:
    """Row count with each column's type and kind."""
    kinds = [F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.lit(
        "numeric" if n in numeric_columns(df) else "categorical" if t == "string" else "other").alias("kind"))
        for n, t in df.dtypes]
    return df.agg(F.count("*").alias("rows")).select("rows", F.explode(F.array(*kinds)).alias("c")).select("rows", "c.*")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class, and largest class / smallest class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    facts = counts.agg(F.sum("n").alias("total"), (F.max("n") / F.min("n")).alias("ratio"))
    return counts.select(
        F.col(label).alias("label"), "n", pct(F.col("n"), facts.select("total").scalar()).alias("pct"),
        F.round(facts.select("ratio").scalar(), 1).alias("imbalance_ratio"))


def checklist(df: DataFrame, target: str) -> DataFrame:
    """The five preparation checks as pass/fail rows."""
    worst = missing(df).agg(F.max("missing_pct").alias("worst"))
    numeric = numeric_columns(df)
    rest = [
        ("outliers identified", bool([c for c in numeric if c != target])),
        ("categorical columns reviewed", True),
        ("numeric columns reviewed", bool(numeric)),
        ("target distribution known", target in df.columns),
    ]
    rows = [F.struct(F.lit("missing below 20%").alias("check"), (F.col("worst") < 20).alias("passed"))] + [
        F.struct(F.lit(n).alias("check"), F.lit(p).alias("passed")) for n, p in rest]
    return worst.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def histogram(df: DataFrame, column: str, label: str, bins: int = 50) -> DataFrame:
    """Density histogram per class over the class's own range; the last bin includes its right edge."""
    rows = df.filter(F.col(column).isNotNull()).select(label, F.col(column).alias("_x"))
    facts = rows.groupBy(label).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    spine = facts.select(label, "lo", "total", width.alias("width"),
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    position = F.least(F.floor(F.try_divide(F.col("_x") - F.col("lo"), width)), F.lit(bins - 1)).cast("int")
    counted = rows.join(facts, label).groupBy(label, F.coalesce(position, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"))
    return spine.join(counted, [label, "bin"], "left").select(
        label, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"), F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce(F.try_divide(F.col("n"), F.col("total") * F.col("width")), F.lit(0.0)).alias("density"))


def correlation_pairs(df: DataFrame, columns: list[str] | None = None, strong_above: float = 0.9) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregation."""
    columns = picked(df, columns)
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{a}/{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{a}/{b}`").alias("r")) for a, b in pairs
    ])).alias("p")).select("p.*", (F.abs("p.r") > strong_above).alias("strong"))


def box_stats(df: DataFrame, columns: list[str] | None, label: str, classes: list) -> DataFrame:
    """Minimum, quartiles and maximum per column and class."""
    columns = picked(df, columns, label)
    parts = {(c, v): F.when(F.col(label) == v, F.col(c)) for c in columns for v in classes}
    found = exact_quantiles(df, {f"{c}__{i}": e for i, ((c, _), e) in enumerate(parts.items())}, [0, 0.25, 0.5, 0.75, 1])
    counts = df.groupBy(label).agg(*[F.count(c).alias(f"{c}__n") for c in columns]).filter(F.col(label).isin(classes))
    tall = counts.select(label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n")) for c in columns])).alias("r")).select(label, "r.*")
    for j, name in enumerate(("min", "q1", "median", "q3", "max")):
        chain = F.lit(None).cast("double")
        for i, (c, v) in enumerate(parts):
            chain = F.when((F.col("column") == c) & (F.col(label) == v), F.lit(found[f"{c}__{i}"][j]).cast("double")).otherwise(chain)
        tall = tall.withColumn(name, chain)
    return tall


def raw_clean_report(raw: DataFrame, prepared: DataFrame, label: str = "Label") -> DataFrame:
    """Long-form comparison (section, column, metric, value) of a raw fraud table and its prepared form."""
    num = {c: F.col(c).try_cast("double") for c in ("Report_Count", "Financial_Loss", label)}
    raw_row = raw.agg(
        F.count("*").alias("rows"), F.lit(len(raw.columns)).alias("columns"), F.count_if(num[label].isNull()).alias("invalid_label_rows"),
        F.count_if(num[label] == 0).alias("label_0_rows"), F.count_if(num[label] == 1).alias("label_1_rows"),
        F.count_if(num["Report_Count"] < 0).alias("negative_report_count_rows"),
        F.count_if(num["Financial_Loss"] < 0).alias("negative_financial_loss_rows"))
    features = [c for c in prepared.columns if c not in (label, "Phone_Number")]
    gaps = sum((F.col(f"`{c}`").isNull().cast("long") for c in features), F.lit(0))
    clean_row = prepared.agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == 0).alias("class_0_rows"),
        F.count_if(F.col(label) == 1).alias("class_1_rows"), F.sum(gaps).alias("missing_cells"),
        F.lit(len(features)).alias("columns"))
    clean_row = clean_row.withColumn("imbalance_0_to_1", F.round(
        F.col("class_0_rows") / F.greatest("class_1_rows", F.lit(1)), 4)).withColumn("any_missing", (F.coalesce("missing_cells", F.lit(0)) > 0).cast("int"))

    def tall(row: DataFrame, section: str) -> DataFrame:
        return row.select(F.explode(F.array(*[F.struct(
            F.lit(section).alias("section"), F.lit("").alias("column"), F.lit(m).alias("metric"),
            F.col(m).cast("double").alias("value")) for m in row.columns])).alias("r")).select("r.*")

    gaps_of = missing(raw)
    shares = gaps_of.select(F.lit("raw").alias("section"), "column", F.lit("missing_pct").alias("metric"), F.col("missing_pct").alias("value"))
    gone = gaps_of.filter("missing_pct >= 5").select(
        F.lit("raw").alias("section"), "column", F.lit("high_missing_pct").alias("metric"), F.col("missing_pct").alias("value"))
    typed = raw.select(*[num[c].alias(c) for c in ("Report_Count", "Financial_Loss")])
    outliers = iqr_outliers(typed, ["Report_Count", "Financial_Loss"], guarded=True).select(
        F.lit("raw").alias("section"), "column", F.lit("iqr_outliers").alias("metric"),
        F.col("outliers").cast("double").alias("value"))
    kept = prepared.agg(F.count("*").alias("kept")).select(
        (raw_row.select("rows").scalar() - F.col("kept")).alias("rows_dropped"),
        F.round(F.col("kept") / F.greatest(raw_row.select("rows").scalar(), F.lit(1)) * 100, 3).alias("rows_retained_pct"))
    return (tall(raw_row, "raw").unionByName(shares).unionByName(gone).unionByName(outliers)
            .unionByName(tall(clean_row, "clean")).unionByName(tall(kept, "diff")))
