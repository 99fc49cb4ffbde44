import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import packing
from tests.conftest import SF0001
from tests.llm.helpers import EDGE, docs_of

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def expected(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, rows, seq_len=2048):
    """Pieces cover each document once, sequences have no gap, and the
    checksums are those of the tokenizers file's ids."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(expected(t))
    assert set(by_doc) == set(want)
    for i, mine in by_doc.items():
        found = sorted((p.start, p.length, p.ids_crc32) for p in mine)
        again = sorted((s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for s, n, _ in found
                       for ids in want[i][:1])
        assert found == again
        assert sum(p.length for p in mine) == sum(map(len, want[i]))
        assert {p.doc_tokens for p in mine} == {len(x) for x in want[i]}
    padding = total = 0
    for mine in by_seq.values():
        at = 0
        for p in sorted(mine, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= seq_len
        padding += 0 if at & (at - 1) == 0 else seq_len - at
        total += at
    return padding / total


def test_edge_cases(spark):
    check(packing.pack_documents(docs_of(spark, EDGE)).collect(), EDGE)


def test_real_documents_pack_tightly(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert check(packing.pack_documents(docs).collect(), rows) < 0.01


def test_empty_table_and_ids(spark):
    assert packing.pack_documents(docs_of(spark, [])).count() == 0
    rows = packing.pack_documents(docs_of(spark, EDGE[:1]), with_ids=True).collect()
    assert sum((r.ids for r in sorted(rows, key=lambda r: r.start)), []) == expected(EDGE[0][1])


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "x  <|endoftext|>\n\n y", "é<|endoftext|>😀",
    "<|endoftext| >", "<|endof<|endoftext|>text|>", "it<|endoftext|>'s", " \n " * 3 + "<|endoftext|>" + " \n " * 3])
def test_added_tokens(spark, text):
    """The ids are those of the tokenizers file as it is."""
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids + [1]
    piece, = packing.pack_documents(docs_of(spark, [(1, text)]), seq_len=64, keep_fill=0, with_ids=True).collect()
    assert piece.ids == ids and piece.doc_tokens == piece.length == len(ids)
    assert piece.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    size, packer = 30, packing.SumOfSquares(30)
    for _ in range(300):
        n = int(rng.integers(1, size))
        before = packer.count.copy()
        costs = {}
        for h in range(size - n + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + n] += h + n < size
            costs[h] = int((after[1:size] ** 2).sum())
        packer.place((0, 0, 0, b"\0" * 4 * n), n)
        assert int((packer.count[1:size] ** 2).sum()) == min(costs.values())


@pytest.mark.parametrize("length", [1, 5, 2047, 2048, 2049, 4096, 5000])
def test_piece_sizes(spark, length):
    rows = [(1, " a" * (length - 1))]
    check(packing.pack_documents(docs_of(spark, rows)).collect(), rows)


@pytest.mark.parametrize("text", [
    " " * 1_000_000, "a" + " " * 300_000 + "b", "\n" * 200_000, " \n\t" * 90_000, "x" * 300_000, "!" * 200_000,
    "é" * 100_000, "one <|endoftext|>" + " " * 20_000 + "<|endoftext|> two", "\u00a0" * 50_000 + " x"])
def test_long_runs(spark, text):
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids + [1]
    pieces = packing.pack_documents(docs_of(spark, [(1, text)]), with_ids=True).collect()
    assert sum((p.ids for p in sorted(pieces, key=lambda p: p.start)), []) == ids


def test_the_largest_runs():
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder()
    for text in (" " * 5_000_000, "z" * 2_000_000):
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text,long", [
    ("", False), ("ab " * 10, False), ("a" * 9, False), ("a" * 10, True), (" " * 9, False), (" " * 10, True),
    ("x" + " \n" * 5, True), ("x y" + " " * 9 + "z", False), ("x y" + "\u3000" * 10 + "z", True)])
def test_what_is_a_long_run(text, long):
    assert packing.has_long_run(text, 10) == long
