"""Running aggregates that never put a whole key into one task.

A plain ``Window.partitionBy(key)`` sorts every row of a key in one task, which fails when one key
holds a large share of the table. Here each key's ordered rows are cut into chunks (time slots, hash
prefixes, score bands): chunk totals are pre-aggregated, a window over the few totals of a key gives
each chunk its starting value, and a second window works inside single chunks. The chunk expression
must grow with the sort order. Null keys are a key, and rows with a null order value come first, in a chunk of
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    chunk: Column,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    before_row: bool = False,
) -> DataFrame:
    """Add running sums and maxima per key; ``before_row`` leaves the row itself out."""
    sums, maxes = sums or {}, maxes or {}
    group = [*keys, "_chunk"]
    rows = df.select("*", chunk.alias("_chunk"),
                     *[c.alias(f"_in_{n}") for n, c in {**sums, **maxes}.items()])
    totals = rows.groupBy(*group).agg(
        *[F.sum(f"_in_{n}").alias(f"_at_{n}") for n in sums],
        *[F.max(f"_in_{n}").alias(f"_at_{n}") for n in maxes])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *group,
        *[F.coalesce(F.sum(f"_at_{n}").over(earlier), F.lit(0)).alias(f"_at_{n}") for n in sums],
        *[F.max(f"_at_{n}").over(earlier).alias(f"_at_{n}") for n in maxes])
    inside = (Window.partitionBy(*group).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1 if before_row else 0))
    return matched(rows, starts, group).select(
        *df.columns,
        *[(F.col(f"_at_{n}") + F.coalesce(F.sum(f"_in_{n}").over(inside), F.lit(0))).alias(n) for n in sums],
        *[F.greatest(F.col(f"_at_{n}"), F.max(f"_in_{n}").over(inside)).alias(n) for n in maxes])


def matched(rows: DataFrame, totals: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the totals of their group, where null matches null."""
    same = totals.withColumnsRenamed({g: f"_of_{g}" for g in group})
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return rows.join(same, on).drop(*[f"_of_{g}" for g in group])


def numbered(df: DataFrame, keys: list[str], order: list[Column], chunk: Column, name: str) -> DataFrame:
    """1, 2, 3, ... per key in the given order."""
    return running(df, keys, order, chunk, sums={name: F.lit(1).cast("long")})


def ranged(df: DataFrame, order: list[str | Column], name: str, pieces: int | None = None) -> DataFrame:
    """Add the number of the range of ``order`` that a row lies in: a chunk expression for keys of any density.

    Spark samples the rows and cuts the whole order into ranges of about equal size (``pieces``, or as many as a shuffle has), so that
    a range holds no more than any other task does, even if one key and one moment own most rows. Rows equal in ``order`` stay together.
    Sampled ranges may differ between runs, hence the checkpoint.
    """
    parts = df.repartitionByRange(*([pieces] if pieces else []), *order)
    return cut_lineage(parts.withColumn(name, F.spark_partition_id()))


def previous_row(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, values: list[str], name: str
) -> DataFrame:
    """Add a struct of the previous row's values per key (null on the first row)."""
    group = [*keys, "_chunk"]
    rows = df.select("*", chunk.alias("_chunk"))
    last = rows.groupBy(*group).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    lasts = last.select(*group, F.lag("_last").over(
        Window.partitionBy(*keys).orderBy("_chunk")).alias("_last"))
    inside = Window.partitionBy(*group).orderBy(*order)
    return matched(rows, lasts, group).select(
        *df.columns, F.coalesce(F.lag(F.struct(*values)).over(inside), F.col("_last")).alias(name))


def hash_order(id_col: str, seed: int) -> Column:
    """Seeded pseudo-random sort key that any engine can reproduce."""
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def hash_numbered(
    df: DataFrame, keys: list[str], id_col: str, seed: int, name: str, digits: int = 3
) -> DataFrame:
    """Seeded random position per key; more ``digits`` make smaller chunks."""
    keyed = df.withColumn("_hash", hash_order(id_col, seed))
    return numbered(keyed, keys, [F.col("_hash"), F.col(id_col)],
                    F.substring("_hash", 1, digits), name).drop("_hash")
