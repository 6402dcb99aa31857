"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The network reads each run of non-space bytes forwards and backwards and gives every
byte a distribution over the languages.  A document's probabilities are the mean over
its letter positions.  It is trained in numpy by backpropagation through time, on a
bounded sample of labelled rows; prediction uses nothing but the text.

Runs recur, so a worker keeps the pooled outputs of runs it has met.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.words import _LOWER, _SPACE, pieces, run_hashes, tidy

#: Bytes the network reads in one go; longer runs are cut, every byte is labelled.
RUN_BYTES = 32
#: Bounds of the training sample: documents per language, characters of each, runs in all.
SAMPLE_DOCS = 200
SAMPLE_CHARS = 2000
SAMPLE_RUNS = 24_000
#: Share of texts in the languages that may score below a judge's interval.
STRAY_SHARE = 1e-6
#: Characters to which sample texts are cut to see how far short texts' scores stray.
SHORT_CHARS = (20, 60, 200)
#: Code points of other scripts: Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, kana, Han, Hangul.
SCRIPTS = (
    (0x3B1, 0x3CA), (0x430, 0x450), (0x5D0, 0x5EB), (0x621, 0x64B), (0x905, 0x93A), (0xE01, 0xE2F),
    (0x3041, 0x30FB), (0x4E00, 0x9FA0), (0xAC00, 0xD7A4),
)
#: Runs a worker remembers.
CACHED_RUNS = 2_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the accented capitals of Latin-1 in small letters."""
    out = _LOWER[data]
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    out[lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    return out


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of all texts, none over ``RUN_BYTES``."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.append(True, ~solid[:-1]) if len(data) else solid
    after = np.append(~solid[1:], True) if len(data) else solid
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    parts = -(-(ends - starts) // RUN_BYTES)
    if len(parts) and parts.max() > 1:
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + nth * RUN_BYTES
        ends = np.minimum(starts + RUN_BYTES, np.repeat(ends, parts))
    return starts, ends


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One direction's gated recurrent units; columns are update, reset, new."""

    NAMES = ("w", "u", "b")

    def __init__(self, hidden: int, random: np.random.Generator) -> None:
        self.hidden = hidden
        self.w = random.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = random.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        self.b = np.zeros(3 * hidden, np.float32)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """States after every byte of ``x`` (runs by bytes)."""
        k = self.hidden
        h = np.zeros((len(x), k), np.float32)
        states, steps = [], []
        for t in range(x.shape[1]):
            given, kept = self.w[x[:, t]] + self.b, h @ self.u
            gates = _sigmoid(given[:, : 2 * k] + kept[:, : 2 * k])
            z, r, a = gates[:, :k], gates[:, k:], kept[:, 2 * k :]
            n = np.tanh(given[:, 2 * k :] + r * a)
            steps.append((h, z, r, a, n))
            h = n + z * (h - n)
            states.append(h)
        return np.stack(states, 1), steps

    def backward(self, x: np.ndarray, steps: list, grads: np.ndarray) -> dict[str, np.ndarray]:
        """Parameter gradients from the gradients of all states, back through time."""
        k = self.hidden
        out = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        later = np.zeros((len(x), k), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, a, n = steps[t]
            d = grads[:, t] + later
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * a * r * (1 - r)
            given = np.concatenate([dz, dr, dn], 1)
            kept = np.concatenate([dz, dr, dn * r], 1)
            np.add.at(out["w"], x[:, t], given)
            out["b"] += given.sum(0)
            out["u"] += h.T @ kept
            later = d * z + kept @ self.u.T
        return out


def _mirrored(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places that turn each row's first ``lengths`` columns round."""
    at = np.arange(x.shape[1])[None, :]
    return np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)


@dataclass
class Network:
    """Languages and weights of a bidirectional network."""

    languages: list[str]
    there: Direction
    back: Direction
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], hidden: int = 16, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        out = random.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        return cls(
            languages, Direction(hidden, random), Direction(hidden, random), out,
            np.zeros(len(languages), np.float32),
        )

    def label(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Distribution over languages at every position."""
        turn = _mirrored(x, lengths)
        rows = np.arange(len(x))[:, None]
        ahead, steps = self.there.forward(x)
        behind, turned = self.back.forward(x[rows, turn])
        state = np.concatenate([ahead, behind[rows, turn]], 2)
        logits = state @ self.out + self.bias
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        return p, (state, steps, turned, turn, rows)

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> list[tuple[object, str, np.ndarray]]:
        p, (state, steps, turned, turn, rows) = self.label(x, lengths)
        real = np.arange(x.shape[1])[None, :] < lengths[:, None]
        d = p.copy()
        d[rows, np.arange(x.shape[1])[None, :], y[:, None]] -= 1
        d *= real[:, :, None] / real.sum()
        k = self.there.hidden
        ds = d @ self.out.T
        found = [(self, "out", np.tensordot(state, d, ([0, 1], [0, 1]))), (self, "bias", d.sum((0, 1)))]
        found += [(self.there, n, g) for n, g in self.there.backward(x, steps, ds[:, :, :k]).items()]
        back = self.back.backward(x[rows, turn], turned, ds[:, :, k:][rows, turn])
        return found + [(self.back, n, g) for n, g in back.items()]


def _matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = ends - starts
    at = starts[:, None] + np.arange(int(lengths.max()))[None, :]
    x = data[np.minimum(at, len(data) - 1)]
    x[np.arange(x.shape[1])[None, :] >= lengths[:, None]] = 0
    return x, lengths


def train_network(
    texts: list[str], labels: list[str], steps: int = 900, batch: int = 96, hidden: int = 16, seed: int = 7
) -> Network:
    """Trains by Adam on runs drawn alike from every language."""
    languages = sorted(set(labels))
    net = Network.new(languages, hidden, seed)
    if len(languages) < 2:
        return net
    random = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    data = lowered(np.frombuffer(b"".join(raw), np.uint8))
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    starts, ends = runs_of(data, offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    y = np.array([languages.index(v) for v in labels])[owner]
    share = SAMPLE_RUNS // len(languages)
    pools = [random.permutation(np.flatnonzero(y == i))[:share] for i in range(len(languages))]
    pools = [p for p in pools if len(p)]
    moments: dict[tuple[int, str], list[np.ndarray]] = {}
    each = max(1, batch // len(pools))
    for step in range(1, steps + 1):
        at = np.concatenate([random.choice(p, each) for p in pools])
        x, lengths = _matrix(data, starts[at], ends[at])
        rate = 0.02 * (1 - step / (steps + 1))
        for part, name, g in net.gradients(x, lengths, y[at]):
            m, v = moments.setdefault((id(part), name), [np.zeros_like(g), np.zeros_like(g)])
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            setattr(part, name, (getattr(part, name) - move).astype(np.float32))
    return net


def labelled_sample(docs: DataFrame, docs_per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list:
    """A bounded sample: per language the documents of smallest id hash, one stretch of each.

    Ranks are taken on ids alone (each task passes on its few best of every language);
    the chosen rows' texts are read in a second pass.
    """
    known = docs.where("lang is not null and doc_id is not null and text is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("_r", F.row_number().over(order))
    chosen = chosen.where(F.col("_r") <= docs_per_language).select("doc_id").distinct()
    begin = f"1 + pmod(xxhash64(doc_id, 1), greatest(length(text) - {chars}, 1))"
    stretch = F.expr(f"substring(text, cast({begin} as int), {chars})").alias("text")
    # broadcast: at most docs_per_language ids of each language
    rows = known.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "lang", stretch)
    return sorted(tuple(r) for r in rows.dropDuplicates(["doc_id", "lang", "text"]).collect())


class Labeler:
    """A worker's network with the pooled outputs of runs it has met."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.sums = np.zeros((0, len(self.net.languages) + 1), np.float32)

    def _pooled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums over letter positions of the distributions, and their number."""
        out = np.zeros((len(starts), len(self.net.languages) + 1), np.float32)
        order = np.argsort(ends - starts, kind="stable")
        for some in np.array_split(order, max(1, len(order) // 2048)):
            if not len(some):
                continue
            x, lengths = _matrix(data, starts[some], ends[some])
            letter = _LETTER[x] & (np.arange(x.shape[1])[None, :] < lengths[:, None])
            if self.net.languages:
                p, _ = self.net.label(x, lengths)
                out[some, :-1] = (p * letter[:, :, None]).sum(1)
            out[some, -1] = letter.sum(1)
        return out

    def documents(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean distribution of every text, and the number of letter positions."""
        data = lowered(raw)
        starts, ends = runs_of(data, offsets)
        keys, where, which = np.unique(
            run_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if len(self.keys) + int(new.sum()) > CACHED_RUNS:
            self._clear()
            at, new = np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        if new.any():
            made = self._pooled(data, starts[where[new]], ends[where[new]])
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.sums = np.insert(self.sums, at[new], made, axis=0)
        total = np.zeros((len(starts) + 1, self.sums.shape[1]))
        if len(keys):
            np.cumsum(self.sums[np.searchsorted(self.keys, keys)][which], axis=0, out=total[1:])
        owned = np.searchsorted(starts, offsets)
        sums = total[owned[1:]] - total[owned[:-1]]
        sums[:, :-1] /= np.maximum(sums[:, -1:], 1)
        return sums


def identify(docs: DataFrame, net: Network, together: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1), replacing columns of these names.

    The score is the best language's, with ``together`` that of all but ``und``.

    Null texts and texts without a letter get ``und`` and 0, and so does every text if no
    language was learned.  All other columns pass unchanged, in one narrow step.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    real = [i for i, v in enumerate(net.languages) if v != "und"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeler = Labeler(net)
        for batch in batches:
            for row, stop, data, offsets in pieces(batch):
                part = batch.slice(row, stop - row)
                mean = labeler.documents(data, offsets)
                found = mean[:, -1] > 0
                plain = np.append(0, np.cumsum(_LETTER[data] & (data < 0x80)))[offsets]
                for i in np.flatnonzero(found & (np.diff(plain) == 0)):
                    text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    found[i] = any(c.isalpha() for c in text)
                best = mean[:, :-1].argmax(1) if net.languages else np.zeros(len(mean), int)
                langs = [net.languages[b] if f and net.languages else "und" for b, f in zip(best, found, strict=True)]
                most = mean[:, real].sum(1) if together else mean[:, :-1].max(1, initial=0)
                score = np.where(found, np.clip(most, 0, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    [*names, "lang_pred", "score"],
                )

    return docs.mapInArrow(tidy(emit), f"{kept}, lang_pred string, score double")


def learn(docs: DataFrame, fold: str) -> Network:
    """A network from labelled documents where ``fold`` (SQL over ``doc_id``) is false."""
    rows = labelled_sample(docs.where(f"not ({fold})"))
    return train_network([r[2] for r in rows], [r[1] for r in rows])


def unlike_texts(texts: list[str], seed: int = 11) -> list[str]:
    """Texts no language wrote: words of random letters, and of scripts that ``texts`` don't use."""
    random = np.random.default_rng(seed)
    used = {ord(c) for c in set("".join(texts))}
    free = [b for b in SCRIPTS if not any(b[0] <= c < b[1] for c in used)]
    out = []
    for i, text in enumerate(texts):
        lengths = [len(w) for w in text.split()][:100]
        low, high = free[i // 2 % len(free)] if i % 2 and free else (0x61, 0x7B)
        out.append(" ".join("".join(map(chr, random.integers(low, high, n))) for n in lengths))
    return out


@dataclass
class Judge:
    """A network with a class ``und`` for what no language fits, and the least scores of clean text.

    The fewer letters a text has, the further its score strays from ``usual``.  Whatever
    scores ``least`` or more is in the languages: texts the network had not seen do.
    """

    net: Network
    usual: float
    stray: float
    least: float

    def identify(self, docs: DataFrame) -> DataFrame:
        """``identify`` with the languages' probabilities taken together as ``score``."""
        return identify(docs, self.net, together=True)

    def fits(self, text: Column) -> Column:
        """Whether a row of ``identify`` with ``text`` is in the languages.

        Repeated words count once.
        """
        words = F.array_join(F.array_distinct(F.split(text, r"\s+")), "")
        letters = F.regexp_replace(words, r"[^\p{L}]", "")
        near = F.lit(self.usual) - F.lit(self.stray) / F.sqrt(F.greatest(F.length(letters), F.lit(1)))
        seen = (F.col("lang_pred") != "und") & ((F.col("score") >= self.usual) | (F.col("score") >= near))
        return seen | (text.rlike(r"\p{L}") & (F.col("score") >= self.least))


def _scores(net: Network, texts: list[str]) -> np.ndarray:
    """The languages' probabilities taken together, of each text."""
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    mean = Labeler(net).documents(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return mean[:, [i for i, v in enumerate(net.languages) if v != "und"]].sum(1)


def _judging_network(texts: list[str], labels: list[str]) -> Network:
    unlike = unlike_texts(texts)
    return train_network(texts + unlike, labels + ["und"] * len(unlike))


def unseen_scores(texts: list[str], labels: list[str]) -> np.ndarray:
    """Each text's score by a network that learned from the other half of the texts."""
    out = np.zeros(len(texts))
    for half in (0, 1):
        taught, asked = range(1 - half, len(texts), 2), range(half, len(texts), 2)
        if taught and asked:
            net = _judging_network([texts[i] for i in taught], [labels[i] for i in taught])
            out[asked] = _scores(net, [texts[i] for i in asked])
    return out


def student_quantile(share: float, freedom: int) -> float:
    """The value that Student's t exceeds with a probability of ``share``.

    With t = sqrt(freedom) / tan(angle), the angle's density is a power of its sine.
    """
    angle = np.geomspace(1e-9, np.pi, 200_000)
    density = np.abs(np.sin(angle)) ** (freedom - 1)
    mass = np.append(0, np.cumsum((density[1:] + density[:-1]) / 2 * np.diff(angle)))
    return float(np.sqrt(freedom) / np.tan(np.interp(share, mass / mass[-1], angle)))


def least_score(scores: np.ndarray) -> float:
    """Lower end of the prediction interval for one more score of the same kind.

    By Student's t, so that few scores give a wide interval and one alone no bound.
    """
    n = len(scores)
    spread = np.std(scores, ddof=1) * np.sqrt(1 + 1 / n) if n > 1 else np.inf
    return float(np.median(scores) - student_quantile(STRAY_SHARE, max(n - 1, 1)) * spread)


def learn_to_judge(docs: DataFrame, fold: str) -> Judge | None:
    """A judge from labelled documents where ``fold`` is false; none without any.

    ``stray`` is the widest that the sample's texts, whole and cut short, fall below
    their median score, per root of their letters, and half as much again.  ``least`` is
    what texts that weren't learned from score at least (:func:`least_score`): the less a
    sample tells about texts unlike its own, the lower that is.
    """
    rows = [r for r in labelled_sample(docs.where(f"not ({fold})")) if any(c.isalpha() for c in r[2])]
    if not rows:
        return None
    texts, labels = [r[2] for r in rows], [r[1] for r in rows]
    net = _judging_network(texts, labels)
    cut = [t[:n] for t in texts for n in SHORT_CHARS if len(t) > n]
    clean = [t for t in texts + cut if any(c.isalpha() for c in t)]
    score = _scores(net, clean)
    letters = np.array([sum(c.isalpha() for c in "".join(set(t.split()))) for t in clean])
    usual = float(np.median(score[: len(texts)]))
    stray = 1.5 * float(((usual - score) * np.sqrt(letters)).max())
    return Judge(net, usual, stray, least_score(unseen_scores(texts, labels)))


def predicted_languages(docs: DataFrame, fold: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    ``held_out`` rows (``fold`` true, or a null ``doc_id``) teach nothing.
    """
    net = learn(docs, fold)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    held = plain.withColumn("held_out", F.coalesce(F.expr(fold), F.lit(True)))
    return identify(held, net).select("doc_id", "held_out", "lang_pred", "score")
