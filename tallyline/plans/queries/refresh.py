"""Sinks read back, and the change log worked off as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.periods import period_order
from tallyline.operators.compact import compact
from tallyline.operators.decode import dead_letters, decode_changes
from tallyline.operators.merge import live_rows
from tallyline.operators.summary import averages
from tallyline.plans import derived
from tallyline.plans.derived import EVENT_KEYS, EVENT_ROW
from tallyline.plans.queries import sql
from tallyline.plans.queries.changes import HOUR_MS
from tallyline.schema import (
    COMPANY,
    LOG_OFFSET,
    LOG_PARTITION,
    MEASURES,
    PERIOD,
    statement_schema,
)
from tallyline.sinks import (
    BucketedState,
    Snapshot,
    assert_unique,
    create_table,
    load_table,
    scratch_dir,
    write_csv,
    write_single_csv,
)
from tallyline.sources import as_changes, read_changes, read_statements_csv
from tallyline.streaming import (
    Averages,
    ChangedIndicators,
    Indicators,
    Refresh,
    moved_average,
    newest_sums,
    run_moving_average,
    run_refresh,
)

KEYS = [PERIOD, COMPANY]


def _buckets(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def snapshot_upsert_roundtrip(spark: SparkSession, sf: str, mode: str = "replace") -> DataFrame:
    """Load stored rows, upsert the whole log, read the new version."""
    snapshot = Snapshot(spark, scratch_dir(spark, "snapshot"), EVENT_ROW, EVENT_KEYS, _buckets(spark))
    snapshot.load(derived.stored_accounts(spark, sf))
    snapshot.apply(decode_changes(derived.change_log(spark, sf), EVENT_ROW, EVENT_KEYS), mode)
    rows = snapshot.read()
    assert_unique(rows, EVENT_KEYS)
    return rows


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "statements-csv")
    write_csv(derived.blank_zeros(derived.statements(spark, sf)), path)
    return read_statements_csv(spark, path)


def csv_report(spark: SparkSession, sf: str) -> DataFrame:
    """Averages per period, a report of a few rows, as one file."""
    path = scratch_dir(spark, "report-csv")
    report = averages(derived.statements(spark, sf), MEASURES, 2, [PERIOD], scale=4, prefix="")
    write_single_csv(report, path, order=period_order(PERIOD))
    names = [PERIOD, *MEASURES]
    layout = statement_schema(with_company=False)
    return read_statements_csv(spark, path, layout).select(*names)


def table_load_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Create the table if missing, replace its rows, check its key, read it."""
    path = scratch_dir(spark, "statements-table")
    name = "statements_" + path.rsplit("-", 1)[-1]
    create_table(spark, name, statement_schema(), path=path)
    load_table(derived.statements(spark, sf), name, path=path)
    rows = spark.table(name)
    assert_unique(rows, KEYS)
    return rows


def change_log_text(spark: SparkSession, sf: str) -> DataFrame:
    """The log as text lines, which carry no positions."""
    path = scratch_dir(spark, "log-text")
    derived.change_log(spark, sf).select("value").write.text(path)
    events = decode_changes(read_changes(spark, "text", path), EVENT_ROW, EVENT_KEYS)
    return compact(events, EVENT_KEYS).drop(LOG_PARTITION, LOG_OFFSET)


def dead_letter_split(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation texts mixed into the log are set aside, envelopes are not."""
    talk = derived.table(spark, sf, "conversations").select(
        F.col("text").alias("value"),
        F.lit(0).alias("partition"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
    )
    mixed = as_changes(derived.change_log(spark, sf).unionByName(talk))
    return dead_letters(mixed, EVENT_ROW, EVENT_KEYS)


def _stored_log(spark: SparkSession, log: DataFrame) -> tuple[str, str]:
    """The log as files in arrival order of their offsets, and how many make a quarter.

    A file is read in few tasks, however large, so a quarter has one per core.
    """
    path = scratch_dir(spark, "log")
    quarter = max(1, spark.sparkContext.defaultParallelism)
    log.repartition(4 * quarter, F.col("offset")).write.parquet(path)
    return path, str(quarter)


def stream_cdc_apply(spark: SparkSession, sf: str, mode: str = "replace") -> DataFrame:
    """The log in four micro-batches against stored rows; equals the batch result."""
    base = scratch_dir(spark, "refresh")
    snapshot = Snapshot(spark, f"{base}/state", EVENT_ROW, EVENT_KEYS, _buckets(spark))
    snapshot.load(derived.stored_accounts(spark, sf))
    path, quarter = _stored_log(spark, derived.change_log(spark, sf, HOUR_MS))
    changes = read_changes(spark, "parquet", path, streaming=True, maxFilesPerTrigger=quarter)
    refresh = Refresh(snapshot, EVENT_ROW, EVENT_KEYS, mode, dead_letter_path=f"{base}/dead")
    run_refresh(changes, refresh, f"{base}/checkpoint").awaitTermination()
    return snapshot.read()


def _bucketed_state(spark: SparkSession, sf: str) -> BucketedState:
    name = f"accounts_{uuid.uuid4().hex}"
    state = BucketedState(spark, name, EVENT_ROW, EVENT_KEYS, _buckets(spark))
    state.load(derived.stored_accounts(spark, sf))
    return state


def cdc_apply_bucketed(spark: SparkSession, sf: str, mode: str = "replace") -> DataFrame:
    """The log merged into rows stored by key; only the log is shuffled."""
    state = _bucketed_state(spark, sf)
    events = decode_changes(derived.change_log(spark, sf), EVENT_ROW, EVENT_KEYS)
    return live_rows(state.merged(events, mode))


def stream_cdc_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The log in four micro-batches, each a new version of the bucketed state."""
    base, state = scratch_dir(spark, "refresh"), _bucketed_state(spark, sf)
    path, quarter = _stored_log(spark, derived.change_log(spark, sf, HOUR_MS))
    changes = read_changes(spark, "parquet", path, streaming=True, maxFilesPerTrigger=quarter)
    refresh = Refresh(state, EVENT_ROW, EVENT_KEYS, keep_versions=2)
    run_refresh(changes, refresh, f"{base}/checkpoint").awaitTermination()
    return state.read()


def _stream_statements(spark: SparkSession, sf: str, load: bool = False) -> tuple[Indicators, Averages]:
    """Follow-up tables after the log; with ``load``, stored rows (open
    lines') came first and the log has the finished lines'."""
    base = scratch_dir(spark, "follow")
    row, buckets = statement_schema(), _buckets(spark)
    snapshot = Snapshot(spark, f"{base}/state", row, KEYS, buckets, bucket_by=[COMPANY])
    if load:
        snapshot.load(derived.statements(spark, sf, "O"))
    indicators = Indicators(spark, f"{base}/indicators", row, buckets)
    averages = Averages(spark, f"{base}/averages", buckets=buckets, scale=4)
    sent = derived.statements(spark, sf, "F" if load else None)
    path, quarter = _stored_log(spark, derived.statement_log(sent))
    changes = read_changes(spark, "parquet", path, streaming=True, maxFilesPerTrigger=quarter)
    refresh = Refresh(snapshot, row, KEYS, keep_versions=4, after=[indicators, averages])
    run_refresh(changes, refresh, f"{base}/checkpoint").awaitTermination()
    return indicators, averages


def stream_indicators(spark: SparkSession, sf: str, load: bool = False) -> DataFrame:
    return _stream_statements(spark, sf, load)[0].read()


def stream_averages(spark: SparkSession, sf: str, load: bool = False) -> DataFrame:
    return _stream_statements(spark, sf, load)[1].average(digits=2)


def stream_indicators_by_change(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows, then the finished lines' log; each commit moves only what differs."""
    base, row, buckets = scratch_dir(spark, "moved"), statement_schema(), _buckets(spark)
    snapshot = Snapshot(spark, f"{base}/state", row, KEYS, buckets, bucket_by=[COMPANY])
    indicators = ChangedIndicators(spark, f"{base}/indicators", row, KEYS, buckets)
    indicators(snapshot, snapshot.load(derived.statements(spark, sf, "O")))
    path, quarter = _stored_log(spark, derived.statement_log(derived.statements(spark, sf, "F")))
    changes = read_changes(spark, "parquet", path, streaming=True, maxFilesPerTrigger=quarter)
    refresh = Refresh(snapshot, row, KEYS, keep_versions=2, after=[indicators])
    run_refresh(changes, refresh, f"{base}/checkpoint").awaitTermination()
    return indicators.read()


def stream_averages_by_images(spark: SparkSession, sf: str) -> DataFrame:
    """Averages from old and new images alone, the log in four micro-batches."""
    base, row = scratch_dir(spark, "moving"), statement_schema()
    path, quarter = _stored_log(spark, derived.image_log(derived.statements(spark, sf)))
    changes = read_changes(spark, "parquet", path, streaming=True, maxFilesPerTrigger=quarter)
    run_moving_average(changes, row, KEYS, f"{base}/sums", f"{base}/checkpoint").awaitTermination()
    return moved_average(newest_sums(spark.read.parquet(f"{base}/sums")), digits=2)


def snapshot_rebucket_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows in one bucket layout, moved to another, then the log."""
    buckets = _buckets(spark)
    snapshot = Snapshot(spark, scratch_dir(spark, "snapshot"), EVENT_ROW, EVENT_KEYS, buckets)
    snapshot.load(derived.stored_accounts(spark, sf))
    snapshot.relayout(2 * buckets + 1)
    snapshot.apply(decode_changes(derived.change_log(spark, sf), EVENT_ROW, EVENT_KEYS))
    rows = snapshot.read()
    assert_unique(rows, EVENT_KEYS)
    return rows


_STMT = sql.stmt()
# Rows of the log win over stored rows of the same key.
_BOTH = f"""{sql.stmt('f', 'F')}, {sql.stmt('o', 'O')}, stmt as (
  select * from f union all select o.* from o anti join f on o.date = f.date and o.company_name = f.company_name)"""
_MEANS = ", ".join(
    sql.rounded(f"cast(sum(cast({m} as decimal(28,4))) as double) / nullif(count({m}), 0)")
    + f" as {m}"
    for m in MEASURES
)

QUERIES = {
    "snapshot_upsert_roundtrip": (
        snapshot_upsert_roundtrip,
        f"""with {sql.events()}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('replace')}""",
    ),
    "snapshot_upsert_coalesce": (
        lambda s, d: snapshot_upsert_roundtrip(s, d, "coalesce"),
        f"""with {sql.events()}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('coalesce')}""",
    ),
    "cdc_apply_bucketed": (
        cdc_apply_bucketed,
        f"""with {sql.events()}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('replace')}""",
    ),
    "stream_cdc_bucketed": (
        stream_cdc_bucketed,
        f"""with {sql.events(clock_ms=HOUR_MS)}, {sql.latest()}, {sql.ACCOUNTS}
        {sql.accounts_merged('replace')}""",
    ),
    "snapshot_rebucket_roundtrip": (
        snapshot_rebucket_roundtrip,
        f"""with {sql.events()}, {sql.latest()}, {sql.ACCOUNTS} {sql.accounts_merged('replace')}""",
    ),
    "csv_report": (
        csv_report,
        f"with {_STMT} select date, {_MEANS} from stmt group by date",
    ),
    "table_load_roundtrip": (table_load_roundtrip, f"with {_STMT} select * from stmt"),
    "change_log_text": (
        change_log_text,
        f"with {sql.events()}, {sql.latest()} select * exclude (_partition, _offset) from latest",
    ),
    "csv_roundtrip": (
        csv_roundtrip,
        f"with {_STMT}, {sql.blanked('b', 'stmt')} select * from b",
    ),
    "dead_letter_split": (
        dead_letter_split,
        """select text as value, 0 as "partition", conv_id * 1000 + turn as "offset"
        from conversations where text is not null""",
    ),
    "stream_cdc_apply": (
        stream_cdc_apply,
        f"""with {sql.events(clock_ms=HOUR_MS)}, {sql.latest()}, {sql.ACCOUNTS}
        {sql.accounts_merged('replace')}""",
    ),
    "stream_cdc_fill": (
        lambda s, d: stream_cdc_apply(s, d, "fill"),
        f"""with {sql.events(clock_ms=HOUR_MS)}, {sql.latest()}, {sql.ACCOUNTS}, {sql.filled()}""",
    ),
    "stream_indicators": (
        stream_indicators,
        f"""with {_STMT}, {sql.with_lags('lagged', 'stmt')}
        select * exclude (prev_sales, prev_net_profit), {sql.indicator_columns()} from lagged""",
    ),
    "stream_indicators_after_load": (
        lambda s, d: stream_indicators(s, d, load=True),
        f"""with {_BOTH}, {sql.with_lags('lagged', 'stmt')}
        select * exclude (prev_sales, prev_net_profit), {sql.indicator_columns()} from lagged""",
    ),
    "stream_indicators_by_change": (
        stream_indicators_by_change,
        f"""with {_BOTH}, {sql.with_lags('lagged', 'stmt')}
        select * exclude (prev_sales, prev_net_profit), {sql.indicator_columns()} from lagged""",
    ),
    "stream_averages_after_load": (
        lambda s, d: stream_averages(s, d, load=True),
        f"with {_BOTH} select 'Average' as date, {_MEANS} from stmt where not starts_with(date, 'TTM')",
    ),
    "stream_averages_by_images": (
        stream_averages_by_images,
        f"with {_STMT} select 'Average' as date, {_MEANS} from stmt where not starts_with(date, 'TTM')",
    ),
    "stream_averages": (
        stream_averages,
        f"with {_STMT} select 'Average' as date, {_MEANS} from stmt where not starts_with(date, 'TTM')",
    ),
}
