"""Personal data in texts: labelers vote, expectation-maximisation weighs them, a span
classifier decides.

Spans of four kinds are proposed by patterns.  Those of the base patterns stand by
themselves.  Looser ones are decided: regular expressions, gazetteers and the words around
a span each vote for, against or not at all; expectation-maximisation estimates how far
each labeler can be trusted without any labelled span; its posteriors train a logistic
classifier on votes and shape, which keeps or drops every looser span.

All of it is DataFrame expressions.  What is estimated is estimated from counts of vote
patterns, of which there are a fixed number however large the corpus is.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.scans import bound, running_max, running_sum
from tallyline.sinks.workspace import scratch_dir

KINDS = ["email", "ip", "card", "phone"]

# The base patterns (fixed by contract), with possessive repeats, which match the same
# and neither recurse nor retry, and with starts only where a run of their characters
# begins or the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns: masked addresses, version-6 addresses, grouped digits without prefix.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT|@)[\])]\x20?"
    r"[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(](?:dot|DOT|\.)[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9.-])[0-9]{4}[./][0-9]{4}[./][0-9]{4}[./][0-9]{4}(?![0-9.-])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])",
}
#: What a text must hold before a pattern is tried on it.
_FIRST = {
    ("email", True): "contains(text, '@')",
    ("ip", True): r"text rlike '[0-9]\\.[0-9]'",
    ("card", True): r"text rlike '[0-9][ -]?[0-9]'",
    ("phone", True): "contains(text, '+')",
    ("email", False): r"text rlike '[\\[(](at|AT|@)[\\])]'",
    ("ip", False): "text rlike ':[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:'",
    ("card", False): "text rlike '[0-9]{4}[./][0-9]{4}[./]'",
    ("phone", False): r"text rlike '[0-9]{3}[ .)-]+[0-9]{3}[ .-][0-9]{4}'",
}

#: Gazetteers (fixed lists): domain ends, issuers' first digits, and words around spans.
DOMAIN_ENDS = "com org net edu gov mil int info biz io eu de fr es uk us it nl ch at be se no pl pt example test".split()
ISSUERS = "^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
WORDS_FOR = {
    "email": "email e-mail mail mailto contact write reach correo courriel",
    "ip": "ip ipv4 ipv6 address host server from client login adresse",
    "card": "card visa mastercard amex credit debit payment pay karte carte tarjeta",
    "phone": "phone tel telephone call fax mobile cell contact ring whatsapp telefon teléfono téléphone",
}
WORDS_AGAINST = "version isbn issn doi order invoice article section page serial id part model build release ticket no nr"
#: How much of the text on either side of a span the labelers see, in characters.
CONTEXT = 40
#: Characters in a piece of a text that is redacted: places are looked up piece by piece.
PIECE = 512

LABELERS = ["shape", "gazetteer", "before", "against", "alone"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn test."""
    turned = F.reverse(digits)

    def add(total: Column, at: Column) -> Column:
        d = F.substr(turned, at, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(at % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """The tests a base match must pass."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.try_to_number(p, F.lit("999")) <= 255))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _valid_of(kind: str) -> Callable[[Column], Column]:
    return lambda row: _valid(kind, row["m"])


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _cut(kind: str, base: bool) -> list[Column]:
    """A pattern's matches in ``text`` and the texts around them, if it can match at all."""
    name = f"{kind}_{'base' if base else 'loose'}"
    pattern = (BASE if base else LOOSE)[kind]
    none = F.array().cast("array<string>")
    parts = [F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)]
    return [
        F.when(F.expr(_FIRST[kind, base]), part).otherwise(none).alias(f"_{side}_{name}")
        for part, side in zip(parts, ("found", "gaps"), strict=True)
    ]


def _lengths(kind: str, base: bool) -> Column:
    """The length of each match of a pattern together with the gap before it."""
    name = f"{kind}_{'base' if base else 'loose'}"
    found, gaps = F.col(f"_found_{name}"), F.col(f"_gaps_{name}")
    return F.transform(found, lambda match, i: F.length(F.get(gaps, i)) + F.length(match))


def _matches(kind: str, base: bool, done: Column) -> Column:
    """Array of (start, end, match, before, after) of a pattern's matches in ``text``.

    Places are code points.  The text between matches gives each match its place: matches
    and gaps follow each other, so ``done``, the running sum of their lengths, is where the
    last match ended.  All are columns by now: within a lambda they would be worked out
    for every match.
    """
    name = f"{kind}_{'base' if base else 'loose'}"
    found, gaps = F.col(f"_found_{name}"), F.col(f"_gaps_{name}")

    def row(match: Column, i: Column) -> Column:
        start = F.get(done, i) + F.length(F.get(gaps, i))
        return F.struct(
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            match.alias("m"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
        )

    return F.transform(found, row)


def _has_word(text: Column, words: str) -> Column:
    return text.rlike(rf"(?i)(?<![\p{{L}}])(?:{'|'.join(words.split())})(?![\p{{L}}])")


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _votes(kind: str, row: Column, base: bool) -> list[Column]:
    """The labelers' votes on a span, in the order of ``LABELERS``."""
    match = row["m"]
    digits = _digits(match)
    if kind == "email":
        end = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
        gazetteer = _vote(end.isin(DOMAIN_ENDS), F.length(end) < 2)
        shape = _vote(match.rlike(r"^[A-Za-z0-9]"), match.rlike(r"^[^A-Za-z]+[\[(@]"))
    elif kind == "ip":
        gazetteer = _vote(match.rlike(r"^(10|127|172|192|fe80|2001|fd)"))
        shape = F.lit(1) if base else _vote(match.rlike(":"), match.rlike(r"^0"))
    elif kind == "card":
        gazetteer = _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
        shape = _vote(F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False), F.lit(True))
    else:
        gazetteer = _vote(match.rlike(r"^\+|^\(?[2-9]"), digits.rlike("^[01]"))
        shape = _vote(F.length(digits).between(9, 15), F.lit(True))
    against = F.when(_has_word(row["before"], WORDS_AGAINST) & ~_has_word(row["before"], WORDS_FOR[kind]), -1).otherwise(0)
    alone = F.when(row["before"].rlike(r"[\p{L}\p{N}=/#]$") | row["after"].rlike(r"^[\p{L}\p{N}=/]"), -1).otherwise(1)
    return [shape, gazetteer, _vote(_has_word(row["before"], WORDS_FOR[kind])), against, alone]


def _proposed(kind: str, base: bool) -> Column:
    """Spans of a pattern as structs with their votes."""

    def row(m: Column) -> Column:
        votes = [v.cast("tinyint").alias(n) for n, v in zip(LABELERS, _votes(kind, m, base), strict=True)]
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), m["start"], m["end"], F.lit(base).alias("base"), *votes
        )

    found = F.col(f"_{kind}_{'base' if base else 'loose'}")
    return F.transform(found, row)


def _apart(loose: Column, base: Column) -> Column:
    """The loose spans that overlap no base span.

    In order of base starts and loose ends, a loose span overlaps a base one if the
    furthest end of the base spans before it lies behind its start.
    """
    fixed = F.transform(
        base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("base"), b["end"].alias("end"), F.lit(0).alias("start"), F.lit(0).alias("place"))
    )
    tried = F.transform(
        loose, lambda s, i: F.struct(s["end"].alias("at"), F.lit(0).alias("base"), F.lit(0).alias("end"), s["start"].alias("start"), i.alias("place"))
    )

    def free(marks: Column) -> Column:
        reach = running_max(F.transform(marks, lambda m: m["end"]))
        places = F.zip_with(marks, reach, lambda m, r: F.when((m["base"] == 0) & (r <= m["start"]), m["place"]))
        return F.transform(F.filter(places, lambda p: p.isNotNull()), lambda p: F.get(loose, p))

    return F.when(F.size(loose) > 0, bound(F.sort_array(F.concat(fixed, tried)), free)).otherwise(loose)


def with_spans(docs: DataFrame) -> DataFrame:
    """Adds ``spans``: base matches and looser candidates that overlap none of them.

    A null text is empty.  Text columns of each pattern are worked out once and kept
    apart, so that nothing is matched twice.  Work grows with the text and its matches.
    """
    columns = docs.columns
    rows = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    both = [(k, b) for k in KINDS for b in (True, False)]
    rows = rows.select("*", *[c for k, b in both for c in _cut(k, b)])
    rows = rows.withColumn("_done", F.transform(F.array(*[_lengths(k, b) for k, b in both]), running_sum))
    matches = [_matches(k, b, F.get("_done", i)).alias(f"_{k}_{'base' if b else 'loose'}") for i, (k, b) in enumerate(both)]
    rows = rows.select(*columns, *matches)
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}_base", F.filter(f"_{kind}_base", _valid_of(kind)))
    rows = rows.withColumn("_base", F.concat(*[_proposed(k, True) for k in KINDS]))
    rows = rows.withColumn("_loose", F.concat(*[_proposed(k, False) for k in KINDS]))
    # through a generator: a filter pushed below would work the matches out within its lambdas
    spans = F.concat("_base", _apart(F.col("_loose"), F.col("_base"))).alias("spans")
    return rows.select(*columns, F.inline(F.array(F.struct(spans))))


class Classifier:
    """Labeler reliabilities and span weights, learned from counts of vote patterns."""

    def __init__(self, patterns: dict[tuple, int], rounds: int = 50) -> None:
        """``patterns``: (kind, base, votes...) to how often it occurs."""
        self.reliability = self._reliabilities(patterns, rounds)
        self.weights = self._weights(patterns)

    def _reliabilities(self, patterns: dict[tuple, int], rounds: int) -> dict:
        # share of each vote among true and among false spans; priors of one span each
        share = {
            (c, j, v): (0.6 if v == (1 if c else -1) else 0.2)
            for c in (0, 1) for j in range(len(LABELERS)) for v in (-1, 0, 1)
        }
        prior = dict.fromkeys(range(len(KINDS)), 0.5)
        for _ in range(rounds):
            total: dict = defaultdict(lambda: 0.0)
            kinds: dict = defaultdict(lambda: [1.0, 2.0])
            for (kind, base, *votes), n in patterns.items():
                p = 1.0 if base else self._posterior(share, prior[kind], votes)
                kinds[kind][0] += n * p * (not base)
                kinds[kind][1] += n * (not base)
                for j, v in enumerate(votes):
                    total[1, j, v] += n * p
                    total[0, j, v] += n * (1 - p)
            for c in (0, 1):
                for j in range(len(LABELERS)):
                    mass = sum(total[c, j, v] + 10 * (0.6 if v == (1 if c else -1) else 0.2) for v in (-1, 0, 1))
                    for v in (-1, 0, 1):
                        share[c, j, v] = (total[c, j, v] + 10 * (0.6 if v == (1 if c else -1) else 0.2)) / mass
            prior = {k: kinds[k][0] / kinds[k][1] for k in range(len(KINDS))}
        self.prior = prior
        return share

    @staticmethod
    def _posterior(share: dict, prior: float, votes: list[int]) -> float:
        yes, no = math.log(prior), math.log(1 - prior)
        for j, v in enumerate(votes):
            yes += math.log(share[1, j, v])
            no += math.log(share[0, j, v])
        return 1 / (1 + math.exp(min(max(no - yes, -50), 50)))

    def _weights(self, patterns: dict[tuple, int], steps: int = 300) -> list[list[float]]:
        """Per kind: a bias and a weight per vote, by gradient ascent on the posteriors."""
        out = []
        for kind in range(len(KINDS)):
            rows = []
            for (k, base, *votes), n in patterns.items():
                if k == kind:
                    p = 1.0 if base else self._posterior(self.reliability, self.prior[kind], votes)
                    rows.append(([1.0, *votes], p, math.log1p(n)))
            # without spans of this kind: what the labelers say, unweighed
            w = [-1.5] + [1.0] * len(LABELERS)
            whole = sum(n for _, _, n in rows) or 1.0
            for _ in range(steps if rows else 0):
                slope = [0.01 * (a - b) for a, b in zip([-1.5] + [1.0] * len(LABELERS), w, strict=True)]
                for x, p, n in rows:
                    guess = 1 / (1 + math.exp(-min(max(sum(a * b for a, b in zip(w, x, strict=True)), -50), 50)))
                    for j, value in enumerate(x):
                        slope[j] += n / whole * (p - guess) * value
                w = [a + 0.5 * b for a, b in zip(w, slope, strict=True)]
            out.append([round(v, 9) for v in w])
        return out

    def keeps(self, span: Column) -> Column:
        """Whether a span is personal data: base ones always, others from even odds on."""
        odds = F.lit(None).cast("double")
        for kind, (bias, *weights) in enumerate(self.weights):
            score = F.lit(bias)
            for name, w in zip(LABELERS, weights, strict=True):
                score = score + span[name].cast("double") * w
            odds = F.when(span["kind"] == kind, score).otherwise(odds)
        return span["base"] | (odds >= 0)


def learn(spans: DataFrame) -> Classifier:
    """A classifier from a table with a column ``spans``; only pattern counts are collected."""
    rows = spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.base", *[f"s.{n}" for n in LABELERS])
    return Classifier({tuple(r)[:-1]: r[-1] for r in rows.count().collect()})


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of spans by kind, then start, comma-joined."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(order, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of base spans per kind, ``base_list`` and ``spans`` of every document.

    Texts are searched once; the spans found (no text) are stored, the classifier is
    learned from them and decides them.  A null text has no spans; rows with a null or a
    repeated ``doc_id`` give a row each; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "spans")
    with_spans(docs.select("doc_id", "text")).drop("text").write.parquet(folder)
    found = spark.read.parquet(folder)
    judge = learn(found)
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS)
    ]
    kept = F.filter("spans", judge.keeps)
    return found.select("doc_id", *counts, _listed(base).alias("base_list"), _listed(kept).alias("spans"))


def _between(pieces: Column, first: Column, end: Column) -> Column:
    """The text from place ``first`` to ``end``, cut from its pieces of ``PIECE`` characters."""
    low, high = F.floor(first / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    within = F.substr(F.get(pieces, low), first % PIECE + 1, F.when(low == high, end - first).otherwise(PIECE))
    whole = F.array_join(F.slice(pieces, low + 2, F.greatest(high - low - 1, F.lit(0))), "")
    tail = F.when(high > low, F.substr(F.get(pieces, high), F.lit(1), end % PIECE))
    return F.concat(F.coalesce(within, F.lit("")), whole, F.coalesce(tail, F.lit("")))


def redact(docs: DataFrame) -> DataFrame:
    """Every document, each kept span replaced by its kind in brackets.

    Overlapping spans are replaced together, by the kind of the first.  A column
    ``n_chars`` follows the text; a null text stays null; other columns are as they were.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "spans")
    # the whole row in one column: no name of the documents' can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = with_spans(docs.select(whole, "text"))
    # all of them: a filter would be pushed down, and the spans worked out within its lambdas
    rows.select("spans").write.parquet(folder)
    judge = learn(spark.read.parquet(folder))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    rows = rows.withColumn("spans", F.filter("spans", judge.keeps))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    rows = rows.withColumn("spans", order)
    some = F.size("spans") > 0
    rows = rows.withColumn("_reach", running_max(F.transform("spans", lambda s: s["end"])))
    rows = rows.withColumn("_pieces", F.when(some, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))

    def part(s: Column) -> Column:
        return F.concat(_between(F.col("_pieces"), s["reach"], s["start"]), F.get(names, s["kind"]))

    met = F.zip_with("spans", "_reach", lambda s, r: F.struct(r.alias("reach"), s["start"].alias("start"), s["kind"].alias("kind")))
    parts = F.transform(F.filter(met, lambda s: s["start"] >= s["reach"]), part)
    last = F.array_max(F.transform("spans", lambda s: s["end"]))
    rest = _between(F.col("_pieces"), last, F.length("text"))
    rows = rows.withColumn("_new", F.when(some, F.array_join(F.concat(parts, F.array(rest)), "")))
    given = F.col("_row")
    out = {c: given[c] for c in docs.columns}
    out["text"] = F.coalesce("_new", given["text"].cast("string"))
    if "n_chars" in out:
        out["n_chars"] = F.coalesce(F.length("_new"), given["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[column.alias(c) for c, column in out.items()])
