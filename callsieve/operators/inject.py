"""Dirty-data injection: turns a clean table into a damaged one for robustness runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import numbered
from .profile import long_form, missing

# Rate ranges per profile, and how strongly each column is hit within the range.
PROFILES = {
    "light": {"missing": (0.05, 0.10), "error": (0.03, 0.05), "duplicates": 0.01, "junk": 0.005},
    "medium": {"missing": (0.10, 0.20), "error": (0.08, 0.12), "duplicates": 0.03, "junk": 0.01},
    "heavy": {"missing": (0.20, 0.35), "error": (0.15, 0.25), "duplicates": 0.05, "junk": 0.02},
}
MISSING_WEIGHTS = {
    "ticket_created": 0.6, "date_of_issue": 0.8, "time_of_issue": 0.9, "form": 0.4, "method": 0.8, "issue": 0.9,
    "caller_id": 0.7, "call_type": 0.8, "advertiser": 0.5, "city": 0.6, "state": 0.6, "zip": 0.6, "location": 0.5,
}
ERROR_WEIGHTS = {
    "caller_id": 1.0, "time_of_issue": 1.0, "date_of_issue": 1.0, "state": 0.8, "zip": 0.8, "method": 0.8, "issue": 0.8,
}
# Wrong values per column as SQL text; h is a number drawn from the cell's hash.
ERROR_VALUES = {
    "caller_id": [
        "concat('abcdefg', substr('hijabcdefg', cast(h % 7 as int) + 1, 3))", "cast(h % 9999 as string)", "'000-000-0000'",
        "'555-555-5555'", "concat('+1-', cast(100 + h % 899 as string), '-', lpad(cast(h % 9999999 as string), 7, '0'))",
        "concat('(', cast(100 + h % 899 as string), ') ', cast(100 + h % 797 as string), '-', cast(1000 + h % 8999 as string))",
        "'N/A'", "'UNKNOWN'", "'111-111-1111'", "'999-999-9999'",
        "concat('-', cast(100 + h % 899 as string), '-', cast(100 + h % 797 as string), '-', cast(1000 + h % 8999 as string))",
    ],
    "time_of_issue": [
        "concat(cast(25 + h % 74 as string), ':', lpad(cast(h % 59 as string), 2, '0'), ' am')",
        "concat(cast(1 + h % 11 as string), ':', cast(60 + h % 39 as string), ' pm')", "'abc'", "'N/A'", "'midnight'",
        "'noon-ish'", "concat(lpad(cast(h % 23 as string), 2, '0'), lpad(cast(h % 59 as string), 2, '0'))", "''",
        "concat(cast(h % 24 as string), '.', lpad(cast(h % 1000000 as string), 6, '0'))", "'25:00 pm'",
    ],
    "date_of_issue": [
        "concat(cast(13 + h % 7 as string), '/', cast(32 + h % 18 as string), '/', cast(2000 + h % 30 as string))",
        "'not_a_date'", "'N/A'",
        "concat(cast(1990 + h % 10 as string), '-', lpad(cast(1 + h % 11 as string), 2, '0'), '-', lpad(cast(1 + h % 27 as string), 2, '0'))",
        "concat(lpad(cast(1 + h % 11 as string), 2, '0'), '/', lpad(cast(1 + h % 27 as string), 2, '0'))", "'01/01/1900'",
        "'12/31/2099'",
        "concat('2017-', lpad(cast(1 + h % 11 as string), 2, '0'), '-', lpad(cast(1 + h % 27 as string), 2, '0'), 'T00:00:00Z')",
        "cast(1000000000 + h as string)",
    ],
    "state": ["'XX'", "'ZZ'", "cast(10 + h % 89 as string)", "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(h % 24 as int) + 1, 3)",
              "'n/a'", "'Unknown'", "''"],
    "zip": ["cast(null as string)", "cast(-1 - h % 99998 as string)", "cast(100000 + h % 899999 as string)", "'0.0'", "'99999.0'",
            "concat('0.', lpad(cast(h % 1000000 as string), 6, '0'))"],
    "method": ["'Pigeon Post'", "'Telepathy'", "'N/A'", "''", "'unknowN'", "cast(h % 100 as string)", "'Fax Machine (legacy)'"],
    "issue": ["'asdfghjkl'", "'COMPLAINT!!!'", "'N/A'", "''", "'Robocals'", "'Telemarkting'", "'其他問題'", "'TEST_ENTRY'",
              "cast(h % 100 as string)"],
}


def rate(span: tuple[float, float], weight: float) -> float:
    return round(span[0] + (span[1] - span[0]) * weight, 12)  # 0.112, not 0.11199999999999999


def cell_hash(id_col: str, column: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), column, F.lit(str(seed))))


def chosen_cells(df: DataFrame, id_col: str, rates: dict[str, float], seed: int, digits: int = 3) -> DataFrame:
    """Exactly floor(non-null cells x rate) cells per column, picked by hash: (id, column, hash)."""
    cells = df.select(id_col, F.explode(F.array(*[
        F.when(F.col(c).isNotNull(), F.lit(c)) for c in rates])).alias("column")).filter("column is not null")
    hashed = cells.withColumn("hash", cell_hash(id_col, F.col("column"), seed))
    ranked = numbered(hashed, ["column"], [F.col("hash"), F.col(id_col)], F.substring("hash", 1, digits), "rank")
    filled = df.agg(*[F.count(c).alias(c) for c in rates]).first()
    limit = F.lit(0)
    for column, r in rates.items():
        limit = F.when(F.col("column") == column, F.lit(math.floor(filled[column] * r))).otherwise(limit)
    return ranked.filter(F.col("rank") <= limit).select(id_col, "column", "hash")


def per_row(cells: DataFrame, id_col: str) -> DataFrame:
    """The chosen cells of a row as a map column -> hash (no larger than the table is wide)."""
    return cells.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("column", "hash"))).alias("_hit"))


def hash_number(hash_: Column) -> Column:
    return F.conv(F.substring(hash_, 26, 7), 16, 10).cast("long")


def inject_missing(df: DataFrame, id_col: str, profile: str = "medium", seed: int = 42) -> DataFrame:
    rates = {c: rate(PROFILES[profile]["missing"], w) for c, w in MISSING_WEIGHTS.items() if c in df.columns}
    hit = per_row(chosen_cells(df, id_col, rates, seed), id_col)
    joined = df.join(hit, id_col, "left")
    return joined.withColumns({c: F.when(F.col("_hit").isNull() | ~F.map_contains_key("_hit", c), F.col(c)) for c in rates}).drop("_hit")


def inject_errors(df: DataFrame, id_col: str, profile: str = "medium", seed: int = 43) -> DataFrame:
    rates = {c: rate(PROFILES[profile]["error"], w) for c, w in ERROR_WEIGHTS.items() if c in df.columns}
    hit = per_row(chosen_cells(df, id_col, rates, seed), id_col)
    joined = df.join(hit, id_col, "left")
    for c in rates:
        joined = joined.withColumn("h", hash_number(F.col("_hit")[c]))
        pick = (F.floor(F.col("h") / 16) % len(ERROR_VALUES[c])).cast("int")
        wrong = F.lit(None).cast("string")
        for i, text in enumerate(ERROR_VALUES[c]):
            wrong = F.when(pick == i, F.expr(text)).otherwise(wrong)
        joined = joined.withColumn(c, F.when(F.col("h").isNull(), F.col(c)).otherwise(wrong))
    return joined.drop("_hit", "h")


def inject_duplicates(df: DataFrame, id_col: str, profile: str = "medium", seed: int = 44) -> DataFrame:
    """Append copies of floor(rows x rate) rows picked by hash."""
    n = math.floor(df.count() * PROFILES[profile]["duplicates"])
    hashed = df.withColumn("_hash", cell_hash(id_col, F.lit("row"), seed))
    ranked = numbered(hashed, [], [F.col("_hash"), F.col(id_col)], F.substring("_hash", 1, 3), "_rank")
    return df.unionByName(ranked.filter(F.col("_rank") <= n).select(*df.columns))


def inject_junk_rows(df: DataFrame, id_col: str, rows: int, profile: str = "medium", seed: int = 45) -> DataFrame:
    """Append floor(rows x rate) rows of noise with negative ids."""
    n = math.floor(rows * PROFILES[profile]["junk"])
    number = F.col("id")
    cells = {c: F.substring(F.md5(F.concat_ws("|", number.cast("string"), F.lit(c), F.lit(str(seed)))), 1, 12)
             for c in df.columns if c != id_col}
    junk = df.sparkSession.range(n).select((-1 - number).alias(id_col), *[v.alias(c) for c, v in cells.items()])
    return df.unionByName(junk, allowMissingColumns=True)


def corrupt(df: DataFrame, id_col: str, profile: str = "medium") -> DataFrame:
    """All four kinds of damage in order. Every step reads its input several times, so each result is written once."""
    df = cut_lineage(df)
    gaps = cut_lineage(inject_missing(df, id_col, profile))
    wrong = cut_lineage(inject_errors(gaps, id_col, profile))
    return inject_junk_rows(inject_duplicates(wrong, id_col, profile), id_col, df.count(), profile)


def corruption_delta(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    """Per column: missing share before and after, how many cells of the given rows were emptied or made wrong, and the share of them.

    Rows are matched by id, which ``before`` has once each; copies and junk rows count for the shares only.
    """
    old = missing(before).select("column", F.col("missing_pct").alias("missing_before_pct"))
    new = missing(after).select("column", F.col("missing_pct").alias("missing_after_pct"))
    columns = [c for c in before.columns if c != id_col]
    left = before.select(id_col, *[F.col(c).alias(f"b_{c}") for c in columns])
    first = after.groupBy(id_col).agg(*[F.first(c).alias(f"a_{c}") for c in columns])  # copies of a row are equal
    both = left.join(first, id_col)
    emptied = {c: F.count_if(F.col(f"b_{c}").isNotNull() & F.col(f"a_{c}").isNull()) for c in columns}
    changed = {c: F.count_if(F.col(f"b_{c}") != F.col(f"a_{c}")) for c in columns}
    row = both.agg(*[f.alias(f"{c}__{n}") for n, fs in (("n_emptied", emptied), ("n_wrong", changed)) for c, f in fs.items()],
                   *[F.count(f"b_{c}").alias(f"{c}__n_filled") for c in columns])
    injected = long_form(row, columns, ["n_emptied", "n_wrong", "n_filled"])
    share = F.coalesce(F.round(F.try_divide(F.col("n_emptied") + F.col("n_wrong"), F.col("n_filled")) * 100, 2), F.lit(0.0))
    return old.join(new, "column").join(injected, "column", "left").select(
        "column", "missing_before_pct", "missing_after_pct", F.round(F.col("missing_after_pct") - F.col("missing_before_pct"), 2).alias("delta_pct"),
        F.coalesce("n_emptied", F.lit(0)).alias("n_emptied"), F.coalesce("n_wrong", F.lit(0)).alias("n_wrong"),
        F.coalesce(share, F.lit(0.0)).alias("injected_pct"))
