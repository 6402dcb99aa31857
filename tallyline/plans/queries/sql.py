"""SQL pieces the checks share."""

from __future__ import annotations

from collections.abc import Sequence

from tallyline.schema import COMPANY, MEASURES, PERIOD

_P = "cast(l_extendedprice as decimal(18,2))"
_ZERO = "cast(0 as decimal(18,2))"

_SUMS = {
    "sales": f"sum({_P})",
    "expenses": f"sum({_P} * cast(1 - l_discount as decimal(4,2)))",
    "operating_profit": f"sum(case when l_returnflag = 'R' then {_P} else {_ZERO} end)",
    "opm_percent": "sum(case when l_linestatus = 'O' then 1 else 0 end)",
    "other_income": f"sum({_P} * cast(l_tax as decimal(4,2)))",
    "interest": "sum(case when l_discount <= 0.02 then cast(l_quantity as decimal(18,2)) "
    f"else {_ZERO} end)",
    "depreciation": "sum(cast(l_quantity as decimal(18,2)))",
    "profit_before_tax": f"sum(case when l_returnflag = 'A' then {_P} else {_ZERO} end)",
    "tax_percent": "count(*)",
    "net_profit": f"sum(case when l_returnflag = 'R' then {_P} when l_returnflag = 'N' "
    f"then -{_P} else {_ZERO} end)",
    "eps_in_rs": "sum(l_linenumber)",
    "dividend_payout_percent": "sum(case when l_quantity > 45 then 1 else 0 end)",
}


def stmt(name: str = "stmt", line_status: str | None = None) -> str:
    """CTEs ending in ``name``: statement rows per customer and order year."""
    where = f"where l_linestatus = '{line_status}'" if line_status else ""
    sums = ",\n  ".join(f"cast({_SUMS[m]} as double) as {m}" for m in MEASURES)
    return f"""{name}_lines as (
  select c.c_custkey, c.c_name, o.o_orderdate, l.*
  from orders o join lineitem l on o.o_orderkey = l.l_orderkey
                join customer c on o.o_custkey = c.c_custkey {where}),
{name}_labelled as (
  select *, 'Mar ' || cast(year(o_orderdate) as varchar) as label from {name}_lines
  union all
  select *, 'TTM' as label from {name}_lines where o_orderdate >= timestamp '2001-07-01'),
{name} as (
  select label as {PERIOD}, {sums}, c_name as {COMPANY}
  from {name}_labelled group by c_custkey, c_name, label)"""


def blanked(name: str, source: str) -> str:
    """CTE: ``source`` with NULL for zero measures."""
    cols = ", ".join(f"nullif({m}, 0) as {m}" for m in MEASURES)
    return f"{name} as (select {PERIOD}, {cols}, {COMPANY} from {source})"


def merged(name: str, existing: str, incoming: str, mode: str = "coalesce") -> str:
    """CTE: full outer merge of statement rows."""
    take = "coalesce(i.{m}, e.{m})"
    if mode == "replace":
        take = f"case when i.{PERIOD} is not null then i.{{m}} else e.{{m}} end"
    cols = ", ".join(f"{take.format(m=m)} as {m}" for m in MEASURES)
    return f"""{name} as (
  select coalesce(i.{PERIOD}, e.{PERIOD}) as {PERIOD}, {cols},
         coalesce(i.{COMPANY}, e.{COMPANY}) as {COMPANY}
  from {existing} e full join {incoming} i
    on e.{PERIOD} = i.{PERIOD} and e.{COMPANY} = i.{COMPANY})"""


def rounded(x: str, digits: int = 2) -> str:
    """Half-up rounding on the shortest decimal text, as the JVM rounds doubles."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), {digits}) as double)"


def per(num: str, den: str) -> str:
    return f"({num}) / nullif({den}, 0)"


def period_end(label: str = PERIOD) -> str:
    return f"try_strptime({label}, '%b %Y')"


def lag(column: str) -> str:
    return (
        f"lag({column}) over (partition by {COMPANY} "
        f"order by {period_end()} nulls first, {PERIOD} nulls first)"
    )


def indicator_columns(which: Sequence[str] | None = None) -> str:
    grown = "({c} - {p}) / nullif({p}, 0) * 100"
    every = {
        "net_profit_margin": per("net_profit", "sales") + " * 100",
        "operating_profit_margin": per("operating_profit", "sales") + " * 100",
        "tax_amount": "tax_percent * profit_before_tax / 100",
        "dividend_yield": "dividend_payout_percent * eps_in_rs / 100",
        "interest_coverage_ratio": per("operating_profit", "interest"),
        "yoy_sales_growth": grown.format(c="sales", p="prev_sales"),
        "yoy_net_profit_growth": grown.format(c="net_profit", p="prev_net_profit"),
        "gross_margin": per("sales - expenses", "sales") + " * 100",
        "expense_ratio": per("expenses", "sales") + " * 100",
    }
    names = which or list(every)[:7]
    return ", ".join(f"{rounded(every[n])} as {n}" for n in names)


def with_lags(name: str, source: str) -> str:
    """CTE: rows without trailing ones, with the two previous values growth needs."""
    return f"""{name} as (
  select *, {lag('sales')} as prev_sales, {lag('net_profit')} as prev_net_profit
  from {source} where not starts_with({PERIOD}, 'TTM'))"""


def events(name: str = "ev", clock_ms: int = 1) -> str:
    """CTE: the change log as decoded rows."""
    return f"""{name} as (
  select 'P' || cast(event_id % 7 as varchar) as date, cast(user_id as varchar) as company_name,
         case when event_type <> 'error' then value end as sales,
         case when event_type not in ('error', 'view') then value * 2 end as interest,
         case when event_type <> 'error' then value - 50 end as net_profit,
         epoch_us(ts) // 1000 - (epoch_us(ts) // 1000) % {clock_ms} as _ts_ms,
         cast(user_id % 4 as integer) as _partition,
         (event_id * 1000003) % 2147483647 as _offset,
         event_type = 'error' as _deleted
  from events)"""


def latest(name: str = "latest", source: str = "ev", where: str = "true") -> str:
    """CTE: last row per key."""
    return f"""{name} as (
  select * exclude (rn) from (
    select *, row_number() over (partition by date, company_name
      order by _ts_ms desc, _partition desc, _offset desc) as rn
    from {source} where {where}) where rn = 1)"""


ACCOUNTS = """accounts as (
  select 'P' || cast(c_nationkey % 7 as varchar) as date, cast(c_custkey as varchar) as company_name,
         c_acctbal as sales, cast(c_nationkey as double) as interest,
         case when c_acctbal > 0 then c_acctbal end as net_profit
  from customer)"""

ACCOUNT_MEASURES = ["sales", "interest", "net_profit"]


def filled() -> str:
    """Per measure the newest value since the key's last delete, stored accounts oldest."""
    place = "row(_ts_ms, _partition, _offset)"
    newest = ", ".join(
        f"arg_max({m}, {place}) filter (where {m} is not null and not _deleted and "
        f"(gone is null or {place} > gone)) as {m}"
        for m in ACCOUNT_MEASURES
    )
    cols = ", ".join(
        f"coalesce(n.{m}, case when n.gone is null then e.{m} end) as {m}" for m in ACCOUNT_MEASURES
    )
    return f"""marked as (
  select *, max(case when _deleted then {place} end) over (partition by date, company_name) as gone from ev),
newest as (
  select date, company_name, {newest}, any_value(gone) as gone from marked group by date, company_name)
select coalesce(n.date, e.date) as date, coalesce(n.company_name, e.company_name) as company_name, {cols}
from accounts e full join newest n on e.date = n.date and e.company_name = n.company_name
left join latest l on n.date = l.date and n.company_name = l.company_name
where not coalesce(l._deleted, false)"""


def accounts_merged(mode: str) -> str:
    """Select: stored accounts after the compacted change log."""
    take = "coalesce(i.{m}, e.{m})"
    if mode == "replace":
        take = "case when i.date is not null then i.{m} else e.{m} end"
    cols = ", ".join(f"{take.format(m=m)} as {m}" for m in ACCOUNT_MEASURES)
    return f"""select coalesce(i.date, e.date) as date,
       coalesce(i.company_name, e.company_name) as company_name, {cols}
from accounts e full join latest i on e.date = i.date and e.company_name = i.company_name
where not coalesce(i._deleted, false)"""
