"""Queries that damage the complaint table."""

from __future__ import annotations

from ..operators import inject as ops
from ..sources import views
from .oracle_views import over
from .registry import query

#: The rates of the medium profile, written down on their own: lowest plus span times the column's weight.
GAP_RATES = {"caller_id": 0.17, "date_of_issue": 0.18, "time_of_issue": 0.19, "issue": 0.19, "call_type": 0.18, "method": 0.18, "state": 0.16,
             "zip": 0.16, "advertiser": 0.15}
WRONG_RATES = {"caller_id": 0.12, "time_of_issue": 0.12, "date_of_issue": 0.12, "state": 0.112, "zip": 0.112, "method": 0.112, "issue": 0.112}
COPY_RATE, JUNK_RATE = 0.03, 0.01
COLUMNS = ["caller_id", "date_of_issue", "time_of_issue", "issue", "call_type", "method", "state", "zip", "advertiser"]
ALL = ["ticket_id", *COLUMNS]


def md5(column: str, seed: int) -> str:
    return f"md5(cast(ticket_id as varchar) || '|{column}|{seed}')"


def hit(column: str, rate: float, seed: int, source: str) -> str:
    """Whether the cell is among the first floor(n x rate) non-null cells in hash order."""
    order = f"row_number() over (partition by {column} is null order by {md5(column, seed)}, ticket_id)"
    count = f"(select floor(count({column}) * {rate!r}::double) from {source})"
    return f"({column} is not null and {order} <= {count})"


def missing_sql(source: str) -> str:
    parts = []
    for c in COLUMNS:
        parts.append(f"case when not {hit(c, GAP_RATES[c], 42, source)} then {c} end as {c}")
    return f"select ticket_id, {', '.join(parts)} from {source}"


def errors_sql(source: str) -> str:
    flags, values = [], []
    for c in COLUMNS:
        if c not in WRONG_RATES:
            values.append(c)
            continue
        flags.append(f"case when {hit(c, WRONG_RATES[c], 43, source)} then cast('0x' || substr({md5(c, 43)}, 26, 7) as bigint) end as h_{c}")
        options = " ".join(f"when {i} then {text.replace('(h ', f'(h_{c} ').replace(' h ', f' h_{c} ')}"
                           for i, text in enumerate(ops.ERROR_VALUES[c]))
        options = options.replace("+ h as", f"+ h_{c} as")
        values.append(f"case when h_{c} is null then {c} else case (h_{c} // 16) % {len(ops.ERROR_VALUES[c])} {options} end end as {c}")
    return f"select ticket_id, {', '.join(values)} from (select *, {', '.join(flags)} from {source})"


def duplicates_sql(source: str) -> str:
    return f"""
select {', '.join(ALL)} from {source} union all
select {', '.join(ALL)} from (select *, row_number() over (order by {md5('row', 44)}, ticket_id) as rn from {source})
where rn <= (select floor(count(*) * {COPY_RATE}::double) from {source})"""


def junk_sql(source: str, rows: str) -> str:
    cells = ", ".join(f"substr(md5(cast(i as varchar) || '|{c}|45'), 1, 12) as {c}" for c in COLUMNS)
    return f"""
select {', '.join(ALL)} from {source} union all
select -1 - i as ticket_id, {cells}
from (select unnest(range((select cast(floor(count(*) * {JUNK_RATE}::double) as bigint) from {rows}))) as i)"""


def share(source: str) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", round(count(*) filter ({c} is null) / count(*) * 100, 2) as p from {source}" for c in ALL)


def table(spark, sf):
    return views.complaints(spark, sf).select(ALL)


@query("inject_missing", over("complaints", missing_sql("complaints")))
def inject_missing(spark, sf):
    return ops.inject_missing(table(spark, sf), "ticket_id")


@query("inject_errors", over("complaints", errors_sql("complaints")))
def inject_errors(spark, sf):
    return ops.inject_errors(table(spark, sf), "ticket_id")


@query("inject_duplicates", over("complaints", duplicates_sql("complaints")))
def inject_duplicates(spark, sf):
    return ops.inject_duplicates(table(spark, sf), "ticket_id")


@query("inject_junk_rows", over("complaints", junk_sql("complaints", "complaints")))
def inject_junk_rows(spark, sf):
    rows = table(spark, sf)
    return ops.inject_junk_rows(rows, "ticket_id", rows.count())


def changes(source: str) -> str:
    """Cells of the given rows that the damage has emptied or made wrong."""
    return " union all ".join(f"""
select '{c}' as "column", count(*) filter (b.{c} is not null and a.{c} is null) as n_emptied, count(*) filter (b.{c} <> a.{c}) as n_wrong,
  round(count(*) filter (b.{c} is not null and (a.{c} is null or b.{c} <> a.{c})) / greatest(count(b.{c}), 1) * 100, 2) as injected_pct
from complaints b join (select distinct * from {source}) a using (ticket_id)""" for c in COLUMNS)


@query("corruption_delta", over("complaints", """
select b."column", b.p as missing_before_pct, a.p as missing_after_pct, round(a.p - b.p, 2) as delta_pct,
  coalesce(n_emptied, 0) as n_emptied, coalesce(n_wrong, 0) as n_wrong, coalesce(injected_pct, 0) as injected_pct
from before b join after a on a."column" = b."column" left join changed c on c."column" = b."column\"""", m=missing_sql("complaints"), e=errors_sql("m"),
                                d=duplicates_sql("e"), j=junk_sql("d", "complaints"), before=share("complaints"),
                                after=share("j"), changed=changes("j")))
def corruption_delta(spark, sf):
    rows = table(spark, sf)
    return ops.corruption_delta(rows, ops.corrupt(rows, "ticket_id"), "ticket_id")
