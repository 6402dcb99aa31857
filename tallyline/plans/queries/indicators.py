"""Ratios, growth and the full indicator refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.numbers import growth, round_to
from tallyline.functions.periods import period_end
from tallyline.operators import indicators as ind
from tallyline.operators.decode import decode_changes
from tallyline.operators.filters import exclude_prefix, order_statements
from tallyline.operators.previous import with_previous
from tallyline.plans import derived
from tallyline.plans.queries import sql
from tallyline.plans.refreshes import indicator_statement
from tallyline.schema import COMPANY, PERIOD, statement_schema

KEYS = [PERIOD, COMPANY]


def only(spark: SparkSession, sf: str, specs: list[ind.Spec]) -> DataFrame:
    rows = derived.statements(spark, sf)
    return ind.with_indicators(rows, specs).select(*KEYS, *[s.name for s in specs])


def yoy_growth(spark: SparkSession, sf: str) -> DataFrame:
    rows = exclude_prefix(derived.statements(spark, sf, measures=["sales", "net_profit"]))
    grown = ind.with_indicators(rows, ind.GROWTHS)
    return grown.select(*KEYS, *[s.name for s in ind.GROWTHS])


def yoy_growth_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """The same growth with every company spread over calendar years."""
    rows = exclude_prefix(derived.statements(spark, sf, measures=["sales", "net_profit"]))
    grown = ind.with_indicators(rows, ind.GROWTHS, chunk=F.year(period_end(PERIOD)))
    return grown.select(*KEYS, *[s.name for s in ind.GROWTHS])


def kpi_statements(spark: SparkSession, sf: str) -> DataFrame:
    return ind.with_indicators(exclude_prefix(derived.statements(spark, sf)))


def kpi_full(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows (final lines), a change log (open lines), merge, indicators."""
    stored, sent = derived.both_statements(spark, sf)
    log = derived.statement_log(derived.blank_zeros(sent))
    return indicator_statement(stored, decode_changes(log, statement_schema(), KEYS))


def growth_long_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Growth from order to order inside each priority.

    Five groups hold all orders, so each is spread over its days.
    """
    orders = derived.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"
    )
    rows = with_previous(
        orders,
        ["o_orderpriority"],
        [F.col("o_orderdate"), F.col("o_orderkey")],
        ["o_totalprice"],
        chunk=F.col("o_orderdate"),
    )
    change = round_to(growth("o_totalprice", "_prev_o_totalprice"), 2)
    return rows.select("o_orderkey", "o_orderpriority", change.alias("price_growth"))


def sorted_statement(spark: SparkSession, sf: str) -> DataFrame:
    return order_statements(exclude_prefix(derived.statements(spark, sf)))


_STMT = sql.stmt()
_LAGGED = f"{_STMT}, {sql.with_lags('lagged', 'stmt')}"


def _only_sql(names: list[str]) -> str:
    return f"with {_STMT} select date, company_name, {sql.indicator_columns(names)} from stmt"


QUERIES = {
    "kpi_margins": (
        lambda s, d: only(s, d, ind.MARGINS),
        _only_sql(["net_profit_margin", "operating_profit_margin"]),
    ),
    "kpi_products": (
        lambda s, d: only(s, d, ind.PRODUCTS),
        _only_sql(["tax_amount", "dividend_yield"]),
    ),
    "kpi_coverage": (
        lambda s, d: only(s, d, ind.COVERAGE),
        _only_sql(["interest_coverage_ratio"]),
    ),
    "kpi_legacy": (
        lambda s, d: only(s, d, ind.LEGACY),
        _only_sql(["gross_margin", "expense_ratio"]),
    ),
    "yoy_growth": (
        yoy_growth,
        f"""with {_LAGGED} select date, company_name,
        {sql.indicator_columns(['yoy_sales_growth', 'yoy_net_profit_growth'])} from lagged""",
    ),
    "yoy_growth_chunked": (
        yoy_growth_chunked,
        f"""with {_LAGGED} select date, company_name,
        {sql.indicator_columns(['yoy_sales_growth', 'yoy_net_profit_growth'])} from lagged""",
    ),
    "kpi_statements": (
        kpi_statements,
        f"""with {_LAGGED}
        select * exclude (prev_sales, prev_net_profit), {sql.indicator_columns()} from lagged""",
    ),
    "kpi_full": (
        kpi_full,
        f"""with {sql.stmt('ex', 'F')}, {sql.stmt('inc0', 'O')}, {sql.blanked('inc', 'inc0')},
        {sql.merged('m', 'ex', 'inc')}, {sql.with_lags('lagged', 'm')}
        select * exclude (prev_sales, prev_net_profit), {sql.indicator_columns()} from lagged""",
    ),
    "growth_long_groups": (
        growth_long_groups,
        f"""with p as (select o_orderkey, o_orderpriority, o_totalprice, lag(o_totalprice) over (
          partition by o_orderpriority order by o_orderdate, o_orderkey) as before from orders)
        select o_orderkey, o_orderpriority,
          {sql.rounded('(o_totalprice - before) / nullif(before, 0) * 100')} as price_growth from p""",
    ),
    "sorted_statement": (
        sorted_statement,
        f"with {_STMT} select * from stmt where not starts_with(date, 'TTM')",
    ),
}
