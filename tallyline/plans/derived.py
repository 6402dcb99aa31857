"""Statement rows, change logs and pages derived from the general test tables.

``statements``  one row per customer and order year (label ``Mar <year>``), plus
                a trailing row over the orders since July 2001.
``change_log``  one JSON envelope per event; the key repeats, arrival is out of
                order, and about a fifth of the events are deletes.
``pages``       one HTML page per customer with the statement as a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.periods import period_order
from tallyline.operators.extract import PROFIT_LOSS
from tallyline.schema import COMPANY, MEASURES, PERIOD, TRAILING_PREFIX
from tallyline.sinks.workspace import scratch_dir

TRAILING_SINCE = "2001-07-01"

# The headings statement pages print for the measures.
HEADINGS = {
    "sales": "Sales&nbsp;+",
    "expenses": "Expenses&nbsp;+",
    "operating_profit": "Operating Profit",
    "opm_percent": "OPM %",
    "other_income": "Other Income&nbsp;+",
    "interest": "Interest",
    "depreciation": "Depreciation",
    "profit_before_tax": "Profit before tax",
    "tax_percent": "Tax %",
    "net_profit": "Net Profit&nbsp;+",
    "eps_in_rs": "EPS in Rs",
    "dividend_payout_percent": "Dividend Payout %",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_measures() -> dict[str, Column]:
    """Per-line integers: money in hundredths, products with a rate in ten-thousandths.

    Integer sums are exact in any order and keep the aggregation in primitive
    buffers, where decimal sums would need objects.
    """
    price = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    kept = (100 - F.rint(F.col("l_discount") * 100)).cast("bigint")
    tax = F.rint(F.col("l_tax") * 100).cast("bigint")
    quantity = F.rint(F.col("l_quantity") * 100).cast("bigint")

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(F.lit(0).cast("bigint"))

    flag = F.col("l_returnflag")
    return {
        "sales": price,
        "expenses": price * kept,
        "operating_profit": only(flag == "R", price),
        "opm_percent": only(F.col("l_linestatus") == "O", F.lit(1).cast("bigint")),
        "other_income": price * tax,
        "interest": only(F.col("l_discount") <= 0.02, quantity),
        "depreciation": quantity,
        "profit_before_tax": only(flag == "A", price),
        "tax_percent": F.lit(1).cast("bigint"),
        "net_profit": only(flag == "R", price) - only(flag == "N", price),
        "eps_in_rs": F.col("l_linenumber").cast("bigint"),
        "dividend_payout_percent": only(F.col("l_quantity") > 45, F.lit(1).cast("bigint")),
    }


# The unit each measure is summed in.
_UNITS = {
    "sales": 100,
    "expenses": 10_000,
    "operating_profit": 100,
    "other_income": 10_000,
    "interest": 100,
    "depreciation": 100,
    "profit_before_tax": 100,
    "net_profit": 100,
}


def statements(
    spark: SparkSession,
    sf_dir: str,
    line_status: str | None = None,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Statement rows, optionally of one line status.

    Lines are summed per order before they meet the orders: the sum uses the
    join's own partitioning, so it adds no shuffle, shrinks what is sorted and
    joined, and an order with very many lines arrives as one row per task.
    """
    lines = table(spark, sf_dir, "lineitem")
    if line_status is not None:
        lines = lines.filter(F.col("l_linestatus") == line_status)
    exprs = _line_measures()
    lines = lines.select("l_orderkey", *[exprs[m].alias(m) for m in measures])
    return _per_period(spark, sf_dir, lines, measures)


def _per_period(
    spark: SparkSession, sf_dir: str, lines: DataFrame, measures: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Statement rows of line measures, apart for each ``by``."""
    per_order = lines.groupBy("l_orderkey", *by).agg(*[F.sum(m).alias(m) for m in measures])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    year = F.concat(F.lit("Mar "), F.year("o_orderdate").cast("string"))
    recent = F.col("o_orderdate") >= F.lit(TRAILING_SINCE).cast("timestamp_ntz")
    labels = F.when(recent, F.array(year, F.lit(TRAILING_PREFIX))).otherwise(F.array(year))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    by_period = (
        joined.select("o_custkey", F.explode(labels).alias(PERIOD), *by, *measures)
        .groupBy("o_custkey", PERIOD, *by)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    named = by_period.join(customers, F.col("o_custkey") == F.col("c_custkey"))

    def in_units(measure: str) -> Column:
        value = F.col(measure).cast("double")
        unit = _UNITS.get(measure)
        return (value / F.lit(float(unit)) if unit else value).alias(measure)

    return named.select(PERIOD, *[in_units(m) for m in measures], F.col("c_name").alias(COMPANY), *by)


def both_statements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Statement rows of finished and of open lines, from one pass over the lines.

    Both sides come from one stored table: a filter on the line status would be pushed
    down into two scans of everything.
    """
    lines = table(spark, sf_dir, "lineitem")
    exprs = _line_measures()
    status = F.col("l_linestatus")
    lines = lines.select("l_orderkey", status, *[exprs[m].alias(m) for m in MEASURES])
    folder = scratch_dir(spark, "statements")
    _per_period(spark, sf_dir, lines, MEASURES, ["l_linestatus"]).write.partitionBy("l_linestatus").parquet(folder)
    rows = spark.read.parquet(folder)
    final, still_open = (rows.filter(status == s).select(PERIOD, *MEASURES, COMPANY) for s in ("F", "O"))
    return final, still_open


EVENT_ROW = T.StructType(
    [
        T.StructField(PERIOD, T.StringType()),
        T.StructField(COMPANY, T.StringType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("interest", T.DoubleType()),
        T.StructField("net_profit", T.DoubleType()),
    ]
)
EVENT_KEYS = [PERIOD, COMPANY]


def _epoch_millis(ts: Column) -> Column:
    """Milliseconds of a zone-less timestamp, whatever the session's zone."""
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86_400
    seconds = seconds + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1_000)


def change_log(spark: SparkSession, sf_dir: str, clock_ms: int = 1) -> DataFrame:
    """``(value, partition, offset)`` records built from ``events``.

    ``clock_ms`` coarsens the event time, which makes ties for the offset to
    settle.  ``view`` events carry no interest (an update to NULL), ``error``
    events delete their key.
    """
    events = table(spark, sf_dir, "events")
    millis = _epoch_millis(F.col("ts"))
    millis = millis - F.pmod(millis, F.lit(clock_ms))
    key = F.concat(F.lit("P"), (F.col("event_id") % 7).cast("string")).alias(PERIOD)
    company = F.col("user_id").cast("string").alias(COMPANY)
    interest = F.when(F.col("event_type") != "view", F.col("value") * 2).alias("interest")
    row = F.struct(
        key,
        company,
        F.col("value").alias("sales"),
        interest,
        (F.col("value") - 50).alias("net_profit"),
    )
    deleted = F.col("event_type") == "error"
    # Inserts have no old image; every other upsert and each delete names its key there.
    old = F.when(F.col("event_type") != "signup", F.struct(key, company)).alias("before")
    payload = F.struct(
        old,
        F.when(~deleted, row).alias("after"),
        F.struct(millis.alias("ts_ms")).alias("source"),
    )
    return events.select(
        F.to_json(F.struct(payload.alias("payload"))).alias("value"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        ((F.col("event_id") * 1000003) % 2147483647).alias("offset"),
    )


def blank_zeros(rows: DataFrame) -> DataFrame:
    """The rows with NULL for zero measures."""
    blanked = {m: F.nullif(F.col(m), F.lit(0.0)) for m in MEASURES}
    return rows.withColumns(blanked)


def statement_log(rows: DataFrame) -> DataFrame:
    """Envelopes for statement rows: each row twice, an older draft arriving last.

    The draft differs in every measure, so a refresh that took it would show.
    """
    row = F.struct(PERIOD, *MEASURES, COMPANY)
    draft = F.struct(PERIOD, *[(F.col(m) + 1).alias(m) for m in MEASURES], COMPANY)
    key = F.struct(PERIOD, COMPANY)
    versions = F.array(
        F.struct(F.lit(None).cast(key_type()).alias("before"), row.alias("after"),
                 F.struct(F.lit(2).cast("bigint").alias("ts_ms")).alias("source")),
        F.struct(key.alias("before"), draft.alias("after"),
                 F.struct(F.lit(1).cast("bigint").alias("ts_ms")).alias("source")),
    )
    sent = rows.select(PERIOD, COMPANY, F.posexplode(versions).alias("_nth", "payload"))
    place = F.pmod(F.xxhash64(PERIOD, COMPANY), F.lit(1 << 40)) * 2 + F.col("_nth")
    return sent.select(
        F.to_json(F.struct("payload")).alias("value"),
        F.pmod(F.xxhash64(COMPANY), F.lit(16)).cast("int").alias("partition"),
        place.alias("offset"),
    )


def image_log(rows: DataFrame) -> DataFrame:
    """Envelopes with whole old images: each row inserted as a draft, then corrected; a
    second row of another company comes and goes, so that nothing of it may be left."""
    whole = [PERIOD, *MEASURES, COMPANY]
    row = F.struct(*whole)
    draft = F.struct(PERIOD, *[(F.col(m) + 1).alias(m) for m in MEASURES], COMPANY)
    passing = F.struct(PERIOD, *MEASURES, F.concat(COMPANY, F.lit("-gone")).alias(COMPANY))
    none = F.when(F.lit(False), row)
    steps = [(none, draft), (draft, row), (none, passing), (passing, none)]
    events = [
        F.struct(old.alias("before"), new.alias("after"), F.struct(F.lit(i).cast("long").alias("ts_ms")).alias("source"))
        for i, (old, new) in enumerate(steps, 1)
    ]
    sent = rows.select(PERIOD, COMPANY, F.posexplode(F.array(*events)).alias("_nth", "payload"))
    place = F.pmod(F.xxhash64(PERIOD, COMPANY), F.lit(1 << 40)) * len(steps) + F.col("_nth")
    return sent.select(
        F.to_json(F.struct("payload")).alias("value"),
        F.pmod(F.xxhash64(COMPANY), F.lit(16)).cast("int").alias("partition"),
        place.alias("offset"),
    )


def key_type() -> T.StructType:
    return T.StructType([T.StructField(k, T.StringType()) for k in (PERIOD, COMPANY)])


def stored_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows for the change log: one per customer, some keys known to it."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("P"), (F.col("c_nationkey") % 7).cast("string")).alias(PERIOD),
        F.col("c_custkey").cast("string").alias(COMPANY),
        F.col("c_acctbal").alias("sales"),
        F.col("c_nationkey").cast("double").alias("interest"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("net_profit"),
    )


def statement_pages(
    rows: DataFrame, company: str = COMPANY, section_id: str = PROFIT_LOSS
) -> DataFrame:
    """One page per company; a company's periods (one row per label) are its columns."""
    first, second = period_order(PERIOD)
    packed = F.struct(
        first.isNull().alias("last"), first.alias("end"), second.alias("label"), *MEASURES
    )
    grouped = rows.groupBy(company).agg(F.sort_array(F.collect_list(packed)).alias("_rows"))

    def cells(tag: str, values: Column) -> Column:
        wrapped = F.transform(values, lambda v: F.concat(F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")))
        return F.array_join(wrapped, "")

    header = F.concat(F.lit("<tr><th></th>"), cells("th", F.col("_rows.label")), F.lit("</tr>"))
    body = []
    for measure, heading in HEADINGS.items():
        texts = F.transform(f"_rows.{measure}", lambda v: F.format_number(v, 4))
        if "%" in heading:
            texts = F.transform(texts, lambda v: F.concat(v, F.lit("%")))
        label = F.lit(f'<tr class="row"><td class="text">{heading}</td>')
        body.append(F.concat(label, cells("td", texts), F.lit("</tr>")))
    html = F.concat(
        F.lit(f'<section id="{section_id}" class="card"><h2>Statement</h2><table><thead>'),
        header,
        F.lit("</thead><tbody>"),
        *body,
        # A row narrower than the header, which no statement row may come from.
        F.lit('<tr><td colspan="9">Notes &amp; remarks</td></tr></tbody></table></section>'),
    )
    return grouped.select(company, html.alias("html"))
