"""Base spans against Python's regular expressions, added spans, redaction."""

from __future__ import annotations

import random
import re
import time

import pytest
from corpora import awkward_rows, frame
from pyspark.sql import functions as F

from conftest import plan_of
from tallyline.llm.personal_data import KINDS, LABELERS, Classifier, _apart, personal_data, redact, with_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    turned = [int(c) for c in reversed(digits)]
    return sum((d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(turned)) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [
        f"{k}:{m.start()}:{m.end()}" for k in KINDS for m in re.finditer(PATTERNS[k], text or "") if valid(k, m[0])
    ]


def texts():
    rng = random.Random(11)
    parts = [
        "a@b.c", "a@b", "x_y@d.e-f.g", "@", ".", "1.2.3.4", "256.1.1.1", "001.002.003.004", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
        "4111111111111112", "4111-1111-1111-1111", "+1 (555) 123-4567", "+1", "+", "123456789", " ", "-", "é", "\U0001F600", "\n",
        "+49 89 1234567", "00000000000000000000001.1.1.1", "(", ")", "mail", "9" * 30,
    ]
    out = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    out += [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    return out + ["7" * 30_000, "a" * 50_000, "a." * 20_000 + "@" + "b." * 20_000, "+" + "1 " * 20_000, "1." * 20_000, "a@b.c " * 800]


def test_base_spans_against_python(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts())]
    for r in personal_data(frame(spark, rows)).collect():
        want = base_spans(rows[r["doc_id"]][1])
        assert r["base_list"] == ",".join(want), rows[r["doc_id"]][1][:200]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w.startswith(f"{k}:") for w in want) for k in KINDS]
        assert set(want) <= set(r["spans"].split(",")) | {""}


def test_method_adds_what_labelers_agree_on(spark):
    rows = [
        (1, "Please call 415-555-0132 today", None, None, None),
        (2, "my email is jane.roe (at) example (dot) com thanks", None, None, None),
        (3, "invoice no 415-555-0132x and serial 4111.1111.1111.1112", None, None, None),
        (4, "card 4111.1111.1111.1111 expires", None, None, None),
        (5, "Nothing here but words, 12 of them. Version 1.2.3 of 2024-05-06.", None, None, None),
        (6, "server 2001:0db8:0000:0000:0000:ff00:0042:8329 is up", None, None, None),
    ]
    rows += [(100 + i, f"write to person{i}@example.com or +1 (555) 555-01{i % 100:02d}", None, None, None) for i in range(60)]
    found = {r["doc_id"]: r["spans"] for r in personal_data(frame(spark, rows)).collect()}
    assert found[1] == "phone:12:24"
    assert found[2] == "email:12:43"
    assert found[3] == ""
    assert found[4] == "card:5:24"
    assert found[5] == ""
    assert found[6] == "ip:7:46"


def test_reliable_labelers_gain_trust():
    good, bad = [1, 1, 0, 0, 1], [-1, -1, 0, -1, -1]
    patterns = {(0, True, *good): 500, (0, False, *good): 40, (0, False, *bad): 400, (0, False, 1, -1, 0, -1, -1): 30}
    judge = Classifier(patterns)
    assert judge.reliability[1, 0, 1] > 0.8 > 0.2 > judge.reliability[0, 3, 0]
    bias, *weights = judge.weights[0]
    assert bias + sum(w * v for w, v in zip(weights, good, strict=True)) > 0
    assert bias + sum(w * v for w, v in zip(weights, bad, strict=True)) < 0
    assert len(weights) == len(LABELERS)


def test_awkward_rows(spark):
    rows = awkward_rows()
    found = personal_data(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    assert personal_data(frame(spark, [])).collect() == []


def test_redaction(spark):
    rows = [
        (1, "é write a@b.com, or +1 (555) 123-4567.", "keep", 7),
        (2, "nothing", "x", 99),
        (3, None, None, None),
        (4, "4111 1111 1111 1111 and +4111 1111 1111 1111", "y", 1),
        (1, "é write a@b.com, or +1 (555) 123-4567.", "keep", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = sorted((tuple(r) for r in redact(docs).collect()), key=repr)
    clean = "é write [EMAIL], or [PHONE]."
    want = [
        (1, clean, "keep", len(clean)), (1, clean, "keep", len(clean)), (2, "nothing", "x", 99), (3, None, None, None),
        (4, "[CARD] and [CARD]", "y", 17),
    ]
    assert [r[:1] + r[2:3] for r in got] == [r[:1] + r[2:3] for r in sorted(want, key=repr)]
    assert [r for r in got if r[0] != 4] == [r for r in sorted(want, key=repr) if r[0] != 4]
    assert not re.search("[0-9]{4}", next(r[1] for r in got if r[0] == 4))
    assert redact(docs.limit(0)).collect() == []


def redacted_by_hand(text, spans):
    """Kept spans in order of their starts; those that overlap go together."""
    out, at = [], 0
    for start, end, kind in sorted((int(s), int(e), KINDS.index(k)) for k, s, e in (x.split(":") for x in spans.split(",") if x)):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_against_python(spark):
    rng = random.Random(5)
    filler = ["é" * 511, "x " * 256, "\U0001F600" * 513, "\n", "call ", "415-555-0132", "x@y (at) z (dot) com", " "]
    made = ["".join(rng.choice([*filler, *texts()[:60]]) for _ in range(rng.randrange(1, 25))) for _ in range(150)]
    rows = [(i, t, None, None, None) for i, t in enumerate([*made, *texts()])]
    docs = frame(spark, rows)
    spans = {r["doc_id"]: r["spans"] for r in personal_data(docs).collect()}
    got = {r["doc_id"]: r["text"] for r in redact(docs).collect()}
    assert sum(map(bool, spans.values())) > 300
    for doc, text, *_ in rows:
        assert got[doc] == redacted_by_hand(text, spans[doc]), doc


def test_overlaps_against_python(spark):
    rng = random.Random(6)

    def some(n):
        return [(s, s + rng.randrange(1, 9)) for s in (rng.randrange(200) for _ in range(n))]

    rows = [(i, some(rng.randrange(40)), some(rng.randrange(12))) for i in range(200)]
    spans = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame(rows, f"i int, loose {spans}, base {spans}")
    for r in df.select("i", _apart(df["loose"], df["base"]).alias("free")).collect():
        _, loose, base = rows[r["i"]]
        want = [s for s in loose if not any(b[0] < s[1] and s[0] < b[1] for b in base)]
        assert sorted(map(tuple, r["free"])) == sorted(want)


@pytest.mark.parametrize("matches", [2_000, 16_000, 64_000])
def test_many_matches_in_one_text(spark, matches):
    """In proportion to the matches: a quadratic form needs minutes from 8,000 on."""
    text = "".join(f"write to p{i}@example.com or call {200 + i % 700}-555-{i % 10000:04d} é\n" for i in range(matches))
    docs = frame(spark, [(1, text, None, None, None)])
    spans = with_spans(docs.select("doc_id", "text")).where(F.size("spans") > 0).select("spans")
    clean = redact(docs)
    began = time.perf_counter()
    [[found]] = spans.collect()
    [row] = clean.collect()
    assert time.perf_counter() - began < 5 + matches / 1_000
    assert [sum(s["kind"] == k for s in found) for k in (0, 3)] == [matches, matches]
    assert row["text"] == "write to [EMAIL] or call [PHONE] é\n" * matches


def test_no_python_in_the_plan(spark):
    docs = frame(spark, awkward_rows())
    for df in (personal_data(docs), redact(docs)):
        assert not re.search("Python|Pandas|Arrow", plan_of(df))
    assert pytest
