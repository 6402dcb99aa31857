"""Decode, compact and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.compact import compact, latest_per_key
from tallyline.operators.decode import decode_changes, delete_keys, star_after, upserts
from tallyline.operators.merge import drop_keys, merge_state
from tallyline.plans import derived
from tallyline.plans.derived import EVENT_KEYS, EVENT_ROW
from tallyline.plans.queries import sql
from tallyline.schema import COMPANY, CONTROL, DELETED, PERIOD

KEYS = [PERIOD, COMPANY]
HOUR_MS = 3_600_000


def _events(spark: SparkSession, sf: str, clock_ms: int = 1) -> DataFrame:
    return decode_changes(derived.change_log(spark, sf, clock_ms), EVENT_ROW, EVENT_KEYS)


def envelope_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf)


def envelope_star(spark: SparkSession, sf: str) -> DataFrame:
    return star_after(derived.change_log(spark, sf), EVENT_ROW, EVENT_KEYS)


def envelope_decode_whole_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Money declared as whole numbers: decimals in it decode to NULL, the rest stays."""
    kinds = {"sales": T.LongType(), "interest": T.DoubleType(), "net_profit": T.DoubleType()}
    row = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in EVENT_ROW])
    return decode_changes(derived.change_log(spark, sf), row, EVENT_KEYS)


def delete_detection(spark: SparkSession, sf: str) -> DataFrame:
    return delete_keys(_events(spark, sf), EVENT_KEYS)


def latest(spark: SparkSession, sf: str, method: str, clock_ms: int = 1) -> DataFrame:
    return latest_per_key(upserts(_events(spark, sf, clock_ms)), EVENT_KEYS, method=method)


def compact_with_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return compact(_events(spark, sf), EVENT_KEYS)


def live_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    live = upserts(compact(_events(spark, sf, HOUR_MS), EVENT_KEYS))
    return live.drop(*CONTROL)


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    existing, incoming = derived.both_statements(spark, sf)
    incoming = derived.blank_zeros(incoming)
    return existing, incoming


def merge_statements(spark: SparkSession, sf: str, mode: str, keep: bool = True) -> DataFrame:
    existing, incoming = _sides(spark, sf)
    return merge_state(existing, incoming, KEYS, mode, keep)


def _daily(spark: SparkSession, sf: str, final: bool) -> DataFrame:
    """Totals per order day of the final or of the open orders, keyed by the day alone."""
    orders = derived.table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double")
    return (
        orders.filter(status == "F" if final else status != "F")
        .groupBy(F.col("o_orderdate").cast("date").cast("string").alias(PERIOD))
        .agg(
            (cents / F.lit(100.0)).alias("sales"),
            F.nullif(F.count_if(F.col("o_orderpriority") == "1-URGENT"), F.lit(0))
            .cast("double")
            .alias("interest"),
        )
    )


def merge_outer_single_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge_state(_daily(spark, sf, True), _daily(spark, sf, False), [PERIOD])


_DAILY_SQL = """select cast(cast(o_orderdate as date) as varchar) as date,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as sales,
    cast(nullif(sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end), 0) as double) as interest
  from orders where o_orderstatus {op} 'F' group by 1"""


def delete_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    gone = delete_keys(_events(spark, sf), EVENT_KEYS)
    return drop_keys(derived.stored_accounts(spark, sf), gone, EVENT_KEYS)


def exclude_listed_companies(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of companies without any delete; the list stays a table."""
    gone = delete_keys(_events(spark, sf), EVENT_KEYS)
    return drop_keys(derived.stored_accounts(spark, sf), gone, [COMPANY], null_safe=True)


def cdc_apply(spark: SparkSession, sf: str, mode: str = "coalesce") -> DataFrame:
    changes = compact(_events(spark, sf), EVENT_KEYS)
    return merge_state(derived.stored_accounts(spark, sf), changes, EVENT_KEYS, mode)


def cdc_apply_incoming_only(spark: SparkSession, sf: str) -> DataFrame:
    changes = compact(_events(spark, sf), EVENT_KEYS)
    stored = derived.stored_accounts(spark, sf)
    return merge_state(stored, changes, EVENT_KEYS, keep_existing=False)


_EV = sql.events()
_EV_HOUR = sql.events(clock_ms=HOUR_MS)
_UPSERTS = f"not {DELETED}"
_ROW = "date, company_name, sales, interest, net_profit"
_SIDES = f"{sql.stmt('ex', 'F')}, {sql.stmt('inc0', 'O')}, {sql.blanked('inc', 'inc0')}"

QUERIES = {
    "envelope_decode": (envelope_decode, f"with {_EV} select * from ev"),
    "envelope_star": (
        envelope_star,
        "with "
        + _EV
        + """ select case when _deleted then null else date end as date,
            case when _deleted then null else company_name end as company_name,
            sales, interest, net_profit from ev""",
    ),
    "envelope_decode_whole_numbers": (
        envelope_decode_whole_numbers,
        f"with {_EV} select * replace (cast(null as bigint) as sales) from ev",
    ),
    "delete_detection": (
        delete_detection,
        f"with {_EV} select distinct date, company_name from ev where _deleted",
    ),
    "latest_per_key": (
        lambda s, d: latest(s, d, "window"),
        f"with {_EV}, {sql.latest(where=_UPSERTS)} select * from latest",
    ),
    "latest_per_key_maxby": (
        lambda s, d: latest(s, d, "aggregate"),
        f"with {_EV}, {sql.latest(where=_UPSERTS)} select * from latest",
    ),
    "latest_per_key_ties": (
        lambda s, d: latest(s, d, "aggregate", HOUR_MS),
        f"with {_EV_HOUR}, {sql.latest(where=_UPSERTS)} select * from latest",
    ),
    "compact_with_deletes": (
        compact_with_deletes,
        f"with {_EV}, {sql.latest()} select * from latest",
    ),
    "live_after_compaction": (
        live_after_compaction,
        f"with {_EV_HOUR}, {sql.latest()} select {_ROW} from latest where not _deleted",
    ),
    "merge_outer_single_key": (
        merge_outer_single_key,
        f"""with e as ({_DAILY_SQL.format(op='=')}), i as ({_DAILY_SQL.format(op='<>')})
        select coalesce(i.date, e.date) as date, coalesce(i.sales, e.sales) as sales,
               coalesce(i.interest, e.interest) as interest
        from e full join i on e.date = i.date""",
    ),
    "merge_outer_composite_key": (
        lambda s, d: merge_statements(s, d, "coalesce"),
        f"with {_SIDES}, {sql.merged('m', 'ex', 'inc')} select * from m",
    ),
    "merge_replace": (
        lambda s, d: merge_statements(s, d, "replace"),
        f"with {_SIDES}, {sql.merged('m', 'ex', 'inc', 'replace')} select * from m",
    ),
    "merge_incoming_only": (
        lambda s, d: merge_statements(s, d, "coalesce", keep=False),
        f"""with {_SIDES}, {sql.merged('m', 'ex', 'inc')}
        select m.* from m where exists (
          select 1 from inc where inc.date = m.date and inc.company_name = m.company_name)""",
    ),
    "delete_anti_join": (
        delete_anti_join,
        f"""with {_EV}, {sql.ACCOUNTS} select a.* from accounts a where not exists (
          select 1 from ev where _deleted and ev.date = a.date
            and ev.company_name = a.company_name)""",
    ),
    "exclude_listed_companies": (
        exclude_listed_companies,
        f"""with {_EV}, {sql.ACCOUNTS} select * from accounts
        where company_name not in (select company_name from ev where _deleted)""",
    ),
    "cdc_apply": (
        cdc_apply,
        f"with {_EV}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('coalesce')}",
    ),
    "cdc_apply_replace": (
        lambda s, d: cdc_apply(s, d, "replace"),
        f"with {_EV}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('replace')}",
    ),
    "cdc_apply_incoming_only": (
        cdc_apply_incoming_only,
        f"""with {_EV}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('coalesce')}
        and i.date is not null""",
    ),
}
