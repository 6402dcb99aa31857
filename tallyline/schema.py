"""Row layouts: statement rows, change envelopes, stored state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Column names of a statement row, in table order.
PERIOD = "date"
COMPANY = "company_name"
MEASURES = [
    "sales",
    "expenses",
    "operating_profit",
    "opm_percent",
    "other_income",
    "interest",
    "depreciation",
    "profit_before_tax",
    "tax_percent",
    "net_profit",
    "eps_in_rs",
    "dividend_payout_percent",
]
# Measures that carry decimals even where the others are whole numbers.
FRACTIONAL_MEASURES = ["tax_percent", "eps_in_rs", "dividend_payout_percent"]
# Indicator columns, in output order.
INDICATORS = [
    "net_profit_margin",
    "operating_profit_margin",
    "tax_amount",
    "dividend_yield",
    "interest_coverage_ratio",
    "yoy_sales_growth",
    "yoy_net_profit_growth",
]
TRAILING_PREFIX = "TTM"
AVERAGE_LABEL = "Average"

# Columns the change-log operators carry beside the row itself.
EVENT_TIME = "_ts_ms"
LOG_PARTITION = "_partition"
LOG_OFFSET = "_offset"
DELETED = "_deleted"
CONTROL = [EVENT_TIME, LOG_PARTITION, LOG_OFFSET, DELETED]
# Offsets compare only inside one log partition; the partition makes ties
# between partitions deterministic, it does not prove an order.
EVENT_ORDER = [EVENT_TIME, LOG_PARTITION, LOG_OFFSET]

CONTROL_FIELDS = [
    T.StructField(EVENT_TIME, T.LongType()),
    T.StructField(LOG_PARTITION, T.IntegerType()),
    T.StructField(LOG_OFFSET, T.LongType()),
    T.StructField(DELETED, T.BooleanType()),
]


def statement_schema(
    with_company: bool = True, measure_type: T.DataType | None = None
) -> T.StructType:
    """Label, the measures, and (multi-company form) the company, in table order."""
    kind = measure_type or T.DoubleType()
    fields = [T.StructField(PERIOD, T.StringType())]
    fields += [T.StructField(m, kind) for m in MEASURES]
    if with_company:
        fields.append(T.StructField(COMPANY, T.StringType()))
    return T.StructType(fields)


def whole_number_schema(with_company: bool = False) -> T.StructType:
    """Layout with ``bigint`` money; a decimal arriving in such a field decodes to NULL."""
    fields = [T.StructField(PERIOD, T.StringType())]
    fields += [
        T.StructField(m, T.DoubleType() if m in FRACTIONAL_MEASURES else T.LongType())
        for m in MEASURES
    ]
    if with_company:
        fields.append(T.StructField(COMPANY, T.StringType()))
    return T.StructType(fields)


def indicator_schema() -> T.StructType:
    """Statement row followed by the indicator columns."""
    return T.StructType(
        statement_schema().fields
        + [T.StructField(name, T.DoubleType()) for name in INDICATORS]
    )


def envelope_schema(row: T.StructType, keys: Sequence[str], images: bool = False) -> T.StructType:
    """Change envelope for ``row``.

    Unless ``images``, the old image is only read for its key, so only key fields are
    declared there: the JSON parser skips the rest.
    """
    key_fields = row.fields if images else [row[k] for k in keys]
    return T.StructType(
        [
            T.StructField(
                "payload",
                T.StructType(
                    [
                        T.StructField("before", T.StructType(key_fields)),
                        T.StructField("after", row),
                        T.StructField(
                            "source",
                            T.StructType([T.StructField("ts_ms", T.LongType())]),
                        ),
                    ]
                ),
            )
        ]
    )


def state_schema(row: T.StructType) -> T.StructType:
    """Stored state: the row plus what late events are compared against."""
    return T.StructType(row.fields + CONTROL_FIELDS)
