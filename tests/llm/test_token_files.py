"""Token files: exact round trip, order, layout and look-up."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow.orc as orc
from corpora import awkward_rows, frame
from tokenizers import Tokenizer

from tallyline.llm.token_files import (
    documents_by_id,
    read_token_files,
    token_digests,
    token_starts,
    write_token_files,
)
from tallyline.llm.tokens import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_round_trip(spark, tmp_path):
    rows = awkward_rows()
    folder = str(tmp_path / "orc")
    write_token_files(frame(spark, rows), folder, PATH, index_rows=1000)
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(
        ((r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows), key=repr
    )
    read = read_token_files(spark, folder)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in read.collect()), key=repr) == want
    assert [list(r["ids"]) for r in documents_by_id(spark, folder, [14]).collect()] == [dict(want)[14]]

    found = token_starts(token_digests(read)).collect()
    order = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    start = 0
    sums = sorted((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want if d is not None)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found if r["doc_id"] is not None) == sums
    for r in order:
        assert r["start"] == start
        start += r["n_tokens"]


def test_files_are_in_order_with_indexes(spark, tmp_path):
    rows = [(i * 7 % 1000, f"text {i}", None, None, None) for i in range(1000)]
    write_token_files(frame(spark, rows), str(tmp_path / "orc"), PATH)
    last = -1
    for file in sorted((tmp_path / "orc").glob("part-*.orc")):
        stored = orc.ORCFile(str(file))
        ids = stored.read(["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
        assert not ids or ids[0] > last
        last = ids[-1] if ids else last
        assert stored.row_index_stride == 1000


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "orc")
    write_token_files(frame(spark, []), folder, PATH)
    assert token_starts(token_digests(read_token_files(spark, folder))).collect() == []


def test_files_are_ordered_by_what_they_hold(spark):
    rows = [(1, "part-99998", 3, 1), (2, "part-99999", 4, 2), (3, "part-100000", 5, 3), (None, "part-00000", 2, 4)]
    digests = spark.createDataFrame(rows, "doc_id long, file string, n_tokens long, ids_crc32 long")
    found = {r["doc_id"]: r["start"] for r in token_starts(digests).collect()}
    assert found == {None: 0, 1: 2, 2: 5, 3: 9}
