"""Indicator columns: ratios, products and period-over-period growth."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.numbers import growth, percent_of, product, ratio, round_to
from tallyline.functions.periods import period_order
from tallyline.operators.previous import with_previous
from tallyline.schema import COMPANY, DELETED, PERIOD

_PREV = "_prev_"


@dataclass(frozen=True)
class Ratio:
    """``num / den * scale``."""

    name: str
    num: str
    den: str
    scale: float = 1

    def column(self) -> Column:
        return ratio(self.num, self.den, self.scale)


@dataclass(frozen=True)
class Share:
    """``(part - minus) / whole * 100``."""

    name: str
    part: str
    minus: str
    whole: str

    def column(self) -> Column:
        return percent_of(self.part, self.whole, self.minus)


@dataclass(frozen=True)
class Product:
    """``a * b / divisor``."""

    name: str
    a: str
    b: str
    divisor: float = 100

    def column(self) -> Column:
        return product(self.a, self.b, self.divisor)


@dataclass(frozen=True)
class Growth:
    """Percent change against the previous period."""

    name: str
    of: str

    def column(self) -> Column:
        return growth(self.of, _PREV + self.of)


Spec = Ratio | Share | Product | Growth

# The indicator formulas.
MARGINS = [
    Ratio("net_profit_margin", "net_profit", "sales", 100),
    Ratio("operating_profit_margin", "operating_profit", "sales", 100),
]
PRODUCTS = [
    Product("tax_amount", "tax_percent", "profit_before_tax"),
    # Payout percent of earnings per share: an amount per share despite its name.
    Product("dividend_yield", "dividend_payout_percent", "eps_in_rs"),
]
COVERAGE = [Ratio("interest_coverage_ratio", "operating_profit", "interest")]
GROWTHS = [
    Growth("yoy_sales_growth", "sales"),
    Growth("yoy_net_profit_growth", "net_profit"),
]
STANDARD = [*MARGINS, *PRODUCTS, *COVERAGE, *GROWTHS]
LEGACY = [
    Share("gross_margin", "sales", "expenses", "sales"),
    Ratio("expense_ratio", "expenses", "sales", 100),
]


def with_indicators(
    df: DataFrame,
    specs: Sequence[Spec] = STANDARD,
    by: Sequence[str] = (COMPANY,),
    order: Sequence[Column] | None = None,
    digits: int | None = 2,
    chunk: Column | None = None,
) -> DataFrame:
    """Appends one column per spec, rounded half up; a zero base gives NULL.

    Only growth needs the previous period, and all growth columns share one
    sort; without any the operator is a plain projection.  ``chunk`` is passed to
    :func:`with_previous`.
    """
    lagged = list(dict.fromkeys(s.of for s in specs if isinstance(s, Growth)))
    names = df.columns
    if lagged:
        df = with_previous(df, by, order or period_order(PERIOD), lagged, chunk, _PREV)
    return df.select(*names, *[round_to(s.column(), digits).alias(s.name) for s in specs])


def changed_indicators(
    old: DataFrame,
    new: DataFrame,
    specs: Sequence[Spec] = STANDARD,
    keys: Sequence[str] = (PERIOD, COMPANY),
    by: Sequence[str] = (COMPANY,),
    order: Sequence[Column] | None = None,
    digits: int | None = 2,
) -> DataFrame:
    """What :func:`with_indicators` of ``new`` has otherwise than that of ``old``.

    Rows that are new or changed, and rows whose predecessor is another or has another
    value now, with their indicators; keys that left, with ``_deleted`` set.  A single
    changed period gives itself and its successor.  Each key is in either side at most
    once; ``keys`` hold ``by``.  Both sides meet in one exchange, by ``by``.
    """
    lagged = list(dict.fromkeys(s.of for s in specs if isinstance(s, Growth)))
    names, keys = new.columns, list(keys)
    values = F.struct(*[c for c in names if c not in keys])
    sides = old.select(*keys, values.alias("_old")).unionByName(
        new.select(*keys, values.alias("_new")), allowMissingColumns=True
    )
    # partitioned by company, rows of one key meet where the company's periods do
    pairs = sides.repartition(*by).groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    before = Window.partitionBy(*by).orderBy(*(order or period_order(PERIOD))).rowsBetween(
        Window.unboundedPreceding, -1
    )
    changed, columns = ~F.col("_old").eqNullSafe(F.col("_new")), []
    for side in ("_old", "_new"):
        # a struct, so that a predecessor's NULL is a value and a missing row isn't
        held = F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{c}") for c in lagged]))
        columns.append(F.last(held, ignorenulls=True).over(before).alias(f"{side}_prev"))
    if lagged:
        pairs = pairs.select("*", *columns)
        moved = F.col("_new").isNotNull() & ~F.col("_old_prev").eqNullSafe(F.col("_new_prev"))
        changed = changed | moved
    rows = pairs.filter(changed).select(
        *keys,
        F.col("_new").isNull().alias(DELETED),
        *[F.col(f"_new.{c}").alias(c) for c in names if c not in keys],
        *[F.col(f"_new_prev.{c}").alias(_PREV + c) for c in lagged],
    )
    return rows.select(*names, *[round_to(s.column(), digits).alias(s.name) for s in specs], DELETED)
