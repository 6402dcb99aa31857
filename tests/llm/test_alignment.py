"""Token alignment against whole texts, byte by byte."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from corpora import awkward_rows, frame, many
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyline.llm import alignment
from tallyline.llm.alignment import aligned, aligned_documents, byte_level_tokens, links_inside, piece_tokens
from tallyline.llm.tokens import tokenizer_path

FILES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def expected(rows):
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=FILES[1])
    a_bytes, b_bytes = byte_level_tokens(first), piece_tokens(second)
    docs = []
    for row in rows:
        text, links, groups, a, b = row[1] or "", [], [], [], []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            whole = (" " + text).encode()
            if not b"".join(a_bytes[i] for i in a) == b"".join(b_bytes[i] for i in b) == whole:
                a, b = [], []
        owners = [[i for i, t in enumerate(ids) for _ in table[t]] for ids, table in ((a, a_bytes), (b, b_bytes))]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*owners, strict=True)))]
        ends = [{n for n in range(1, len(o) + 1) if n == len(o) or o[n] != o[n - 1]} for o in owners]
        at = 0
        for end in sorted(ends[0] & ends[1]):
            parts = [",".join(str(ids[i]) for i in dict.fromkeys(o[at:end])) for ids, o in zip((a, b), owners, strict=True)]
            groups.append("|".join(parts))
            at = end
        docs.append((row[0], a, b, links, groups))
    counts = Counter(p for *_, links, _ in docs for p in set(links))
    most: Counter = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (
                doc, len(a), len(b), len(groups), len(links),
                sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            )
            for doc, a, b, links, groups in docs
        ),
        key=repr,
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  ", "  a  b  ", "\n", " \n x\n\n", "a\tb \t c", "a▁b", "▁", "<0x41> <unk> </s> <s>",
    "<|endoftext|> q <|endoftext|>", "\x00a \x01", "ａ① ﬁ", "é 日本語の文 と 空白", "x   y  z  ", "　 　a  b",
    "it's 's  's don't", "123 4,567.89 0x1F", "naïve façade – “quotes” …", "👩‍👩‍👧 ok 🙂🙂", "a\x1c b\x1c", "x" * 3000, "word " * 500,
    "\r\n\r\n a\x0b\x0cc\x85d", "ѐ ӿ ԱԲ ابجد हिन्दी", None, "a​ b", "Tab\t\t\tend   .", " ' s", "﻿ bom",
]


def test_whole_texts(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(None, "a null id", None, None, 1)]
    assert result(aligned_documents(frame(spark, rows).repartition(3), *FILES)) == expected(rows)


@pytest.mark.parametrize("block_bytes", [1, 700])
def test_awkward_rows_and_small_blocks(spark, block_bytes, monkeypatch):
    rows = awkward_rows() + many(40)
    assert result(aligned_documents(frame(spark, rows), *FILES, block_bytes=block_bytes)) == expected(rows)


def test_random_characters_and_a_full_cache(spark, monkeypatch):
    rng = random.Random(4)
    some = "ab  \n\t.,'é日 　́🙂1"
    rows = [(i, "".join(rng.choice(some) for _ in range(rng.randrange(60))), "en", "s", 1) for i in range(120)]
    monkeypatch.setattr(alignment, "CACHED_CHUNKS", 7)
    work = alignment.Aligner(*FILES)
    texts = [(" " + r[1]).encode() for r in rows if r[1]]
    import numpy as np

    for text in texts:
        slots, _ = work.chunks(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert int(work.facts[slots, 0].sum()) == len(work.a.encode(text.decode(), add_special_tokens=False).ids)
    assert result(aligned_documents(frame(spark, rows), *FILES)) == expected(rows)


def test_links_inside_a_group():
    assert aligned([2, 3, 1, 4], [1, 3, 2, 1, 3]) == [(0, 3, 0, 3), (3, 4, 3, 5)]
    assert links_inside([2, 3, 1], [1, 3, 2]) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]
    assert links_inside([4], [1, 3]) == [(0, 0), (0, 1)]


def test_empty_table_and_extra_columns(spark):
    assert aligned_documents(frame(spark, []), *FILES).collect() == []
    rows = [(1, "a b", 1, "y"), (2, None, 2, None)]
    clashing = frame(spark, rows, "doc_id long, text string, block long, pairs string")
    assert result(aligned_documents(clashing, *FILES)) == expected(rows)
