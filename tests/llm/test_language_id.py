"""Language identification: gradients, held-out accuracy, defined results."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from corpora import awkward_rows, frame

from tallyline.llm.language_id import (
    Labeler,
    Network,
    identify,
    labelled_sample,
    learn,
    least_score,
    lowered,
    predicted_languages,
    student_quantile,
    train_network,
)

FOLD = "pmod(crc32(cast(doc_id as string)), 4) = 2"
PARTS = {"aa": "ka ko mi ta na", "bb": "sch ung ei str ver", "cc": "ção ñi ê lha qu"}


def documents(n):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        words = ["".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 30))]
        text = " ".join(words)
        rows.append((i, text.upper() if i % 9 == 0 else text, lang, "s", 1))
    return rows


def test_gradients_match_differences():
    net = Network.new(["a", "b", "c"], hidden=3)
    for part in (net.there, net.back):
        for name in part.NAMES:
            setattr(part, name, getattr(part, name).astype(float))
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    x = np.array([[97, 98, 99, 0], [100, 97, 0, 0]], np.uint8)
    lengths, y = np.array([3, 2]), np.array([0, 2])

    def loss():
        p, _ = net.label(x, lengths)
        return -sum(np.log(p[i, t, y[i]]) for i in range(2) for t in range(lengths[i])) / lengths.sum()

    for part, name, gradient in net.gradients(x, lengths, y):
        values = getattr(part, name)
        for at in np.argsort(-np.abs(gradient).ravel())[:4]:
            place = np.unravel_index(at, values.shape)
            kept = values[place]
            values[place] = kept + 1e-3
            up = loss()
            values[place] = kept - 1e-3
            down = loss()
            values[place] = kept
            assert gradient[place] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=2e-4), name


def test_held_out_accuracy(spark):
    rows = documents(400)
    found = predicted_languages(frame(spark, rows), FOLD).collect()
    want = {r[0]: r[2] for r in rows}
    assert len(found) == 400
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97


def test_prediction_uses_text_alone(spark):
    rows = documents(200)
    net = learn(frame(spark, rows), FOLD)
    bare = frame(spark, [(None, r[1], None, None, None) for r in rows])
    one = sorted((r["text"], r["lang_pred"], r["score"]) for r in identify(frame(spark, rows), net).collect())
    assert one == sorted((r["text"], r["lang_pred"], r["score"]) for r in identify(bare, net).collect())


def test_held_out_rows_teach_nothing(spark):
    rows = documents(200)
    other = [(i, "zz zz", "zz", s, n) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, g, s, n) for i, t, g, s, n in rows]
    assert learn(frame(spark, other), FOLD).languages == ["aa", "bb", "cc"]
    sample = labelled_sample(frame(spark, rows), docs_per_language=5, chars=20)
    assert len(sample) == 15
    assert all(len(text) <= 20 for _, _, text in sample)


def test_awkward_rows(spark):
    rows = awkward_rows()
    net = train_network(["the one word", "ein das wort", "é ñ"], ["en", "de", "fr"], steps=5)
    docs = frame(spark, rows).withColumnRenamed("source", "score")
    found = identify(docs, net)
    assert found.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score"]
    for r in found.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters == (r["score"] > 0)


def test_no_letters_outside_ascii_and_no_labels(spark):
    net = train_network(["ab", "cd"], ["x", "y"], steps=2)
    rows = [(1, "…—“”", None, None, None), (2, "日本", None, None, None)]
    assert [r["lang_pred"] == "und" for r in identify(frame(spark, rows), net).orderBy("doc_id").collect()] == [True, False]
    none = learn(frame(spark, rows), FOLD)
    assert {(r["lang_pred"], r["score"]) for r in identify(frame(spark, rows), none).collect()} == {("und", 0.0)}
    assert predicted_languages(frame(spark, []), FOLD).collect() == []


def test_remembered_runs_change_nothing(monkeypatch):
    net = train_network(["kami tako", "sching verei"], ["a", "b"], steps=20)
    text = np.frombuffer(b"kami sching " + b"q" * 70 + b" kami", np.uint8)
    offsets = np.array([0, 5, len(text)])
    labeler = Labeler(net)
    first = labeler.documents(text, offsets)
    assert np.allclose(first, labeler.documents(text, offsets))
    monkeypatch.setattr("tallyline.llm.language_id.CACHED_RUNS", 1)
    assert np.allclose(first, Labeler(net).documents(text, offsets))
    assert first[:, -1].tolist() == [4, 6 + 70 + 4]


def test_lowered_latin_capitals():
    assert lowered(np.frombuffer("ÀÖ×ØÞaZ".encode(), np.uint8)).tobytes().decode() == "àö×øþaz"


def test_student_quantiles_and_interval():
    assert student_quantile(0.025, 1) == pytest.approx(12.706, rel=1e-3)
    assert student_quantile(0.01, 8) == pytest.approx(2.896, rel=1e-3)
    assert student_quantile(0.001, 200) == pytest.approx(3.131, rel=1e-3)
    assert least_score(np.array([0.9])) == -np.inf
    few, many = least_score(np.array([1.0, 0.99, 0.98])), least_score(np.array([1.0, 0.99, 0.98] * 50))
    assert few < 0 < many < 0.98
