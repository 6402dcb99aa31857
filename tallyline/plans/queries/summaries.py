"""Averages, summary rows and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators.decode import decode_changes
from tallyline.operators.filters import complete_rows, exclude_prefix, order_summary_last
from tallyline.operators.summary import append_summary, averages
from tallyline.plans import derived
from tallyline.plans.queries import sql
from tallyline.plans.refreshes import average_statement, company_statement
from tallyline.schema import COMPANY, MEASURES, PERIOD, statement_schema
from tallyline.sinks import scratch_dir

KEYS = [PERIOD, COMPANY]
SCALE = 4


def prefix_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return exclude_prefix(derived.statements(spark, sf))


def complete(spark: SparkSession, sf: str) -> DataFrame:
    return complete_rows(derived.blank_zeros(derived.statements(spark, sf)), [PERIOD, *MEASURES])


def average(
    spark: SparkSession, sf: str, digits: int | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    rows = exclude_prefix(derived.blank_zeros(derived.statements(spark, sf)))
    return averages(rows, MEASURES, digits, by, scale=SCALE)


def summary_row_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = append_summary(derived.statements(spark, sf), digits=2, scale=SCALE)
    return order_summary_last(rows, leading=[COMPANY])


def summary_row_per_company(spark: SparkSession, sf: str) -> DataFrame:
    return append_summary(derived.statements(spark, sf), digits=2, by=[COMPANY], scale=SCALE)


def _refresh_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    stored, sent = derived.both_statements(spark, sf)
    log = derived.statement_log(derived.blank_zeros(sent))
    return stored, decode_changes(log, statement_schema(), KEYS)


def average_refresh(spark: SparkSession, sf: str) -> DataFrame:
    stored, events = _refresh_inputs(spark, sf)
    store = scratch_dir(spark, "merged")
    return average_statement(
        stored, events, KEYS, keep_trailing=False, digits=2, scale=SCALE, store=store
    )


def company_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return company_statement(*_refresh_inputs(spark, sf))


def _mean(m: str) -> str:
    return f"cast(sum(cast({m} as decimal(28,{SCALE}))) as double) / nullif(count({m}), 0)"


def _means(prefix: str, digits: int | None) -> str:
    cols = [
        f"{sql.rounded(_mean(m), digits) if digits is not None else _mean(m)} as {prefix}{m}"
        for m in MEASURES
    ]
    return ", ".join(cols)


_STMT = sql.stmt()
_BLANK = f"{_STMT}, {sql.blanked('b', 'stmt')}"
_NO_TTM = "not starts_with(date, 'TTM')"
_COLS = ", ".join(MEASURES)
_WHOLE = " and ".join(f"{m} is not null" for m in [PERIOD, *MEASURES])
_MERGED = (
    f"{sql.stmt('ex', 'F')}, {sql.stmt('inc0', 'O')}, {sql.blanked('inc', 'inc0')}, "
    f"{sql.merged('m', 'ex', 'inc')}"
)

QUERIES = {
    "prefix_exclusion": (prefix_exclusion, f"with {_STMT} select * from stmt where {_NO_TTM}"),
    "complete_rows": (complete, f"with {_BLANK} select * from b where {_WHOLE}"),
    "average_all": (
        average,
        f"with {_BLANK} select {_means('avg_', None)} from b where {_NO_TTM}",
    ),
    "average_all_rounded": (
        lambda s, d: average(s, d, 2),
        f"with {_BLANK} select {_means('avg_', 2)} from b where {_NO_TTM}",
    ),
    "average_by_group": (
        lambda s, d: average(s, d, None, (COMPANY,)),
        f"""with {_BLANK} select company_name, {_means('avg_', None)}
        from b where {_NO_TTM} group by company_name""",
    ),
    "summary_row_append": (
        summary_row_append,
        f"""with {_STMT} select date, {_COLS}, company_name from stmt union all
        select 'Average', {_means('', 2)}, null from stmt where {_NO_TTM}""",
    ),
    "summary_row_per_company": (
        summary_row_per_company,
        f"""with {_STMT} select date, {_COLS}, company_name from stmt union all
        select 'Average', {_means('', 2)}, company_name from stmt where {_NO_TTM}
        group by company_name""",
    ),
    "average_refresh": (
        average_refresh,
        f"""with {_MERGED}, k as (select * from m where {_NO_TTM}),
        u as (select date, {_COLS}, company_name from k union all
              select 'Average', {_means('', 2)}, null from k)
        select * from u where {_WHOLE}""",
    ),
    "company_refresh": (
        company_refresh,
        f"with {_MERGED} select * from m where {_NO_TTM}",
    ),
}
