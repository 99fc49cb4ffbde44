"""Packing documents into fixed-length sequences, online sum of squares."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.registry import query, table

SEQ_LEN = 2048
END_ID = 1
KEEP_FILL = 0.98
LONG_RUN = 10_000   # characters with or without white space in a row that the fast encoder gets at most

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def vocabulary(path: str | None = None) -> tiktoken.Encoding:
    """Byte-level BPE of ``byte_bpe_50k``: the ranks of the same vocabulary
    and the added tokens of the tokenizers file beside them give the ids that
    the tokenizers file gives (tests compare the two)."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added, beside = {}, path.removesuffix(".tiktoken") + ".json"
    if beside != path and os.path.exists(beside):
        with open(beside, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=added)


def has_long_run(text: str, least: int = LONG_RUN) -> bool:
    """Whether ``least`` white-space characters, or ``least`` others, follow
    each other in a text."""
    if len(text) < least:
        return False
    words = text.split()
    if max(map(len, words), default=0) >= least:
        return True
    blanks = len(text) - sum(map(len, words))
    return blanks - len(words) >= least - 2 and re.search(rf"\s{{{least}}}", text) is not None


class Encoder:
    """Ids of a text as the tokenizers file gives them. The same ranks in the
    other library are several times as fast, but its pattern fails on very
    long runs: texts that hold one are encoded by the file itself."""

    def __init__(self, path: str | None = None):
        self.path, self.fast, self.whole = path, vocabulary(path), None

    def __call__(self, text: str) -> list[int]:
        if not has_long_run(text):
            return self.fast.encode(text, allowed_special="all")
        if self.whole is None:
            path = self.path or public_tokenizers.path("byte_bpe_50k.tiktoken")
            self.whole = tokenizers.Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")
        return self.whole.encode(text, add_special_tokens=False).ids


class SumOfSquares:
    """Online packing: each piece goes to the fill level that minimises the
    sum over levels of (number of open windows at that level) squared."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)   # open windows per level
        self.open: dict[int, list[list]] = {}        # level -> windows (lists of pieces)

    def place(self, piece: tuple, length: int) -> list | None:
        """Add a piece; the window it completes, if it does."""
        size, count = self.size, self.count
        # Change of the sum when a window moves from level h to h + length,
        # up to a constant; h = 0 opens a window. A full window leaves.
        after = 2 * count[length:size + 1] + 1
        after[-1] = 0
        before = 1 - 2 * count[:size + 1 - length]
        before[0] = 0
        cost = after + before
        cost[1:][count[1:size + 1 - length] == 0] = np.iinfo(np.int64).max
        h = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self.open[h].pop() if h else []
        if h:
            count[h] -= 1
        window.append(piece)
        level = h + length
        if level == size:
            return window
        count[level] += 1
        self.open.setdefault(level, []).append(window)
        return None

    def rest(self) -> list[tuple[int, list]]:
        return [(h, w) for h in sorted(self.open, reverse=True) for w in self.open[h]]


def _pack(size: int, keep: float, vocab_path: str | None, with_ids: bool):
    def run(batches):
        encode = Encoder(vocab_path)
        packer = SumOfSquares(size)
        next_seq = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], "<u4").tobytes()
        rows: list[tuple] = []

        def emit(window):
            nonlocal next_seq
            offset = 0
            for doc_id, start, total, ids in window:
                n = len(ids) // 4
                rows.append((doc_id, start, n, zlib.crc32(ids), total, next_seq, offset, ids))
                offset += n
            next_seq += 1

        def flush():
            cols = list(zip(*rows)) if rows else [[]] * 8
            out = [pa.array(c, pa.int64()) for c in cols[:7]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cols[7]],
                                    pa.list_(pa.int32())))
                names.append("ids")
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = array("I", encode(text.as_py() or "")).tobytes() + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = (doc_id, start, total, ids[4 * start:4 * (start + size)])
                    n = len(piece[3]) // 4
                    if n == size:
                        emit([piece])
                    elif window := packer.place(piece, n):
                        emit(window)
                if len(rows) >= 4096:
                    yield flush()
        # Windows still open: nearly full ones are padded, the others are
        # cut anew into full windows and a tail of powers of two.
        tail: list[tuple] = []
        room = size
        for level, window in packer.rest():
            if level >= keep * size:
                emit(window)
                continue
            for doc_id, start, total, ids in window:
                while ids:
                    cut, ids = ids[:4 * room], ids[4 * room:]
                    tail.append((doc_id, start, total, cut))
                    start += len(cut) // 4
                    room -= len(cut) // 4
                    if not room:
                        emit(tail)
                        tail, room = [], size
        left = size - room
        while left:
            part = 1 << (left.bit_length() - 1)
            left -= part
            window = []
            while part:
                doc_id, start, total, ids = tail.pop(0)
                cut, ids = ids[:4 * part], ids[4 * part:]
                window.append((doc_id, start, total, cut))
                part -= len(cut) // 4
                if ids:
                    tail.insert(0, (doc_id, start + len(cut) // 4, total, ids))
            emit(window)
        if rows:
            yield flush()
    return run


def pack_documents(docs: DataFrame, seq_len: int = SEQ_LEN, keep_fill: float = KEEP_FILL,
                   vocab_path: str | None = None, with_ids: bool = False,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document in a sequence of ``seq_len`` ids.

    Every partition tokenizes its documents (ids, then the end id 1) and
    packs them online: whole windows leave at once, the last piece of a
    document goes to the fill level minimising the sum of squared counts of
    open windows. A partition ends with its open windows: those filled to
    ``keep_fill`` are padded, the others are cut into full windows, and the
    last one into lengths that are powers of two. Memory is one batch plus
    the open windows; nothing is shuffled.

    Added tokens of the vocabulary (``<|endoftext|>``) that stand in a text
    are one id each, as the tokenizers file has it. Texts of any length are
    packed whole, also those of one long run of blanks, letters or marks
    (``vocab_path`` needs the tokenizers file beside it for these). A null or empty text is
    its end id alone. Pieces that fit equally well go to the fullest window. A null doc_id is carried.
    Repeated rows are packed once each. Other columns are not read; an empty
    table gives no rows. ``with_ids`` adds the ids themselves.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(_pack(seq_len, keep_fill, vocab_path, with_ids), schema)


@query("op1_sum_of_squares_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
