"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: every number, name and unit is a typed placeholder, every other
word itself.  Windows of template words are hash-joined with the benchmark's.  A match
counts if its slots are consistent: two slots of the document window hold the same value
exactly where the benchmark's do, so a question with its values exchanged is caught and a
chance meeting of placeholders is not.

Each window has a second, folded key: names are words like any other, without regard to case,
and so is a number between two numbers.  It finds copies in another case, and series of
numbers, which templates say nothing about.  Items shorter than a window are looked for by
this key alone: with their names exchanged they are other questions.

Everything is DataFrame expressions.  Window hashes are put together by doubling (pairs,
fours, eights of words), so a word costs a few hash steps whatever the window's length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.sinks.workspace import scratch_dir

#: Words of a window; a shorter item is matched as a whole.
WINDOW = 12
#: Items of fewer words are not looked for unless asked: too short to tell a leak from chance.
LEAST_WORDS = 6
#: Words of a window, of twelve, that must not be placeholders.
LITERAL_SHARE = 0.5
#: Benchmark windows that are broadcast at a time; more go in several blocks.
BLOCK_ROWS = 200_000

#: Units of measure that count as such behind a number (fixed list).
UNITS = (
    "mm cm m km inch inches ft feet foot yard yards mile miles mg g kg lb lbs pound pounds ounce ounces oz ton tons "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week "
    "weeks month months year years percent cent cents dollar dollars euro euros usd eur mph kmh kph hz khz mhz ghz "
    "w kw kwh v a degree degrees c f k b kb mb gb tb"
).split()

_NUMBER, _NAME, _UNIT = 1, 2, 3

_WINDOWS = {"item_id": "long", "size": "int", "hash": "long", "folded": "boolean", "slots": "array<int>"}
_MATCHES = {"doc_id": "long", "item_id": "long", "begin": "int"}


def words_of(text: Column) -> Column:
    """Words of a text: letters and digits, with the marks inside numbers taken out.

    A text without any has one empty word.
    """
    joined = F.regexp_replace(text, r"(?<=[0-9])[.,](?=[0-9])", "")
    return F.split(F.trim(F.regexp_replace(joined, r"[^\p{L}\p{M}\p{N}]+", " ")), " ")


def _typed(word: Column, at: Column, words: Column) -> Column:
    """1 to 3 for a number, name or unit, else 0; most words fail on their first letter."""
    first, before = F.ascii(word), F.ascii(F.get(words, at - 1))
    rest = F.substring(word, 2, 1_000_000_000)
    capital = (first.between(65, 90) | (first >= 128)) & (word != F.lower(word))
    return (
        F.when(first.between(48, 57), _NUMBER)
        .when(capital & (rest != "") & (rest == F.lower(rest)), _NAME)
        .when(before.between(48, 57) & F.lower(word).isin(UNITS), _UNIT)
        .otherwise(0)
    )


def _coded(rows: DataFrame) -> DataFrame:
    """Adds a number per word, ``_codes`` and ``_folded``: its placeholder's type, or the hash
    of the lower-cased word."""
    words, kinds = F.col("words"), F.col("_kinds")
    rows = rows.withColumn("_kinds", F.transform(words, lambda w, i: _typed(w, i, words)))
    rows = rows.withColumn("_low", F.transform(words, lambda w: F.xxhash64(F.lower(w))))

    def folded(kind: Column, at: Column) -> Column:
        series = (F.get(kinds, at - 1) == _NUMBER) & (F.get(kinds, at + 1) == _NUMBER)
        typed = (kind == _UNIT) | ((kind == _NUMBER) & ~F.coalesce(series, F.lit(False)))
        return F.when(typed, kind.cast("long")).otherwise(F.get("_low", at))

    codes = F.zip_with("_kinds", "_low", lambda kind, low: F.when(kind > 0, kind.cast("long")).otherwise(low))
    return rows.withColumns({"_codes": codes, "_folded": F.transform(kinds, folded)})


def _hashed(rows: DataFrame, codes: str, size: int, out: str) -> DataFrame:
    """Adds ``out``: hashes of all windows of ``size`` codes; each step is a column of its own.

    Steps refer to the one before twice, so they must not be merged into one expression;
    Spark keeps projections apart for that reason.
    """
    columns = rows.columns

    def later(name: str, places: int) -> Column:
        return F.slice(F.col(name), places + 1, F.greatest(F.size(codes), F.lit(1)))

    def joined(one: Column, other: Column) -> Column:
        return F.zip_with(one, other, lambda a, b: F.xxhash64(a, b))

    span, name, whole, done, left = 1, codes, "", 0, size
    while left:
        if left & 1:
            if done:
                rows = rows.withColumn(f"_to{done + span}", joined(F.col(whole), later(name, done)))
                whole = f"_to{done + span}"
            else:
                whole = name
            done += span
        left >>= 1
        if left:
            rows = rows.withColumn(f"_by{2 * span}", joined(F.col(name), later(name, span)))
            span *= 2
            name = f"_by{span}"
    n = F.greatest(F.size(codes) - (size - 1), F.lit(0))
    return rows.select(*columns, F.slice(F.col(whole), 1, n).alias(out))


def _with_keys(rows: DataFrame, size: int) -> DataFrame:
    """Adds ``keys``: both hashes of every window, first all templates', then the folded ones,
    null where they are the same; and ``places``, how many windows there are."""
    columns = rows.columns
    rows = _hashed(_hashed(_coded(rows), "_codes", size, "_hashes"), "_folded", size, "_others")
    other = F.zip_with("_others", "_hashes", lambda f, h: F.when(f != h, f))
    return rows.select(
        *columns, F.concat("_hashes", other).alias("keys"), F.greatest(F.size("_hashes"), F.lit(1)).alias("places")
    )


def _passage(size: int) -> Column:
    """The word before a window (its type may hang on it) and the window's words."""
    words, begin = F.col("words"), F.col("begin")
    return F.concat(F.array(F.coalesce(F.get(words, begin - 1), F.lit(""))), F.slice(words, begin + 1, size))


def _is_slot(word: Column) -> Column:
    return (word["kind"] > 0) & ~(F.col("folded") & (word["kind"] == _NAME))


def _with_slots(rows: DataFrame, size: int) -> DataFrame:
    """Replaces ``passage`` by ``slots``: where each slot's value first stands among them.

    Names are no slots where ``folded``.
    """

    def slot(i: Column) -> Column:
        word = F.get(F.col("passage"), i)
        return F.struct(_typed(word, i, F.col("passage")).alias("kind"), F.lower(word).alias("value"))

    typed = F.transform(F.sequence(F.lit(1), F.lit(size)), slot)
    rows = rows.withColumn("_held", F.filter(typed, _is_slot))
    slots = F.transform(F.col("_held"), lambda k: F.array_position(F.col("_held"), k))
    return rows.withColumn("slots", slots).drop("passage", "_held")


def benchmark_windows(
    benchmark: DataFrame, window: int = WINDOW, least: int = LEAST_WORDS, literal: float = LITERAL_SHARE
) -> DataFrame:
    """``item_id``, ``size``, ``hash``, ``folded`` and ``slots`` of the windows to look for.

    Null items and those under ``least`` words have none; neither have templates or folded
    windows with less than a ``literal`` share of words that are no placeholders.
    """
    words = benchmark.select(F.col("item_id").cast("long"), words_of(F.col("text").cast("string")).alias("words"))
    words = words.where(F.size("words") >= least)
    # at most one row per size; only those that occur are planned
    sizes = words.select(F.least(F.size("words"), F.lit(window)).alias("size")).distinct().collect()
    none = [F.lit(None).cast(t).alias(c) for c, t in _WINDOWS.items()]
    parts = [benchmark.sparkSession.range(0).select(*none)]
    for size in sorted(r["size"] for r in sizes):
        own = words.where(F.size("words") >= size if size == window else F.size("words") == size)
        own = _hashed(_hashed(_coded(own), "_codes", size, "_hashes"), "_folded", size, "_others")
        found = own.select("item_id", "words", "_folded", F.posexplode(F.arrays_zip("_hashes", "_others")).alias("begin", "_h"))
        held = F.slice("_folded", F.col("begin") + 1, size)
        shared = found.select(
            "item_id",
            _passage(size).alias("passage"),
            F.size(F.filter(held, lambda c: c.between(_NUMBER, _UNIT))).alias("_placed"),
            F.inline(
                F.array(
                    F.struct(F.lit(False).alias("folded"), F.col("_h._hashes").alias("hash")),
                    F.struct(F.lit(True).alias("folded"), F.col("_h._others").alias("hash")),
                )
            ),
        )
        if size < window:
            shared = shared.where("folded")
        shared = _with_slots(shared, size)
        placed = F.when(F.col("folded"), F.col("_placed")).otherwise(F.size("slots"))
        shared = shared.where(size - placed >= math.ceil(size * literal))
        slots = F.col("slots").cast("array<int>").alias("slots")
        parts.append(shared.select("item_id", F.lit(size).alias("size"), "hash", "folded", slots))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_rows: int = BLOCK_ROWS,
    least: int = LEAST_WORDS,
    literal: float = LITERAL_SHARE,
) -> DataFrame:
    """``doc_id, item_id, n_windows, first_word`` of every benchmark item in a document.

    ``n_windows`` counts the places of the document where a consistent window of the item
    begins, ``first_word`` is the first of them (from 0).  A null text holds nothing; rows
    with a null ``doc_id`` are left out; rows that repeat a ``doc_id`` count as one document.

    The benchmark's windows are counted and broadcast in blocks of at most ``block_rows``,
    so a large benchmark means more passes and never a larger broadcast.  ``least`` and
    ``literal`` are those of :func:`benchmark_windows`.  Documents are
    not shuffled; only matches are grouped.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "benchmark")
    benchmark_windows(benchmark, window, least, literal).write.parquet(f"{folder}/windows")
    wanted = spark.read.parquet(f"{folder}/windows")
    count = {r["size"]: r["n"] for r in wanted.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    # no rows made in Python: its workers would stay, and hold memory, next to these stages
    matches = spark.range(0).select(*(F.lit(None).cast(t).alias(c) for c, t in _MATCHES.items()))
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), words_of(F.col("text").cast("string")).alias("words")
    )
    for size, n in sorted(count.items()):
        coded = _with_keys(texts, size)
        blocks = -(-n // block_rows)
        for block in range(blocks):
            some = wanted.where((F.col("size") == size) & (F.pmod(F.col("hash"), F.lit(blocks)) == block))
            # the outer form: else Spark infers a filter on the hashes and works them out twice
            exploded = coded.select("doc_id", "words", "places", F.posexplode_outer("keys").alias("_at", "hash"))
            met = exploded.join(
                F.broadcast(some.select("item_id", "hash", "folded", F.col("slots").alias("_slots"))), "hash"
            ).withColumn("begin", F.col("_at") % F.col("places"))
            # stored before the slots are compared: within the join every window would
            # carry its document's words along, here only those that met do
            place = f"{folder}/met-{size}-{block}"
            met.select("doc_id", "item_id", "begin", "folded", "_slots", _passage(size).alias("passage")).write.parquet(place)
            met = _with_slots(spark.read.parquet(place), size).where("slots = _slots")
            matches = matches.unionByName(met.select("doc_id", "item_id", "begin"))
    return matches.groupBy("doc_id", "item_id").agg(
        F.countDistinct("begin").alias("n_windows"), F.min("begin").alias("first_word")
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark item was found, all columns as they are.

    Rows with a null ``doc_id`` stay.
    """
    found = leaks(docs, benchmark, window).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(found, docs["doc_id"] == F.col("_leaked"), "left_anti")
