import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import recompression as R
from tests.conftest import SF0001
from tests.llm.helpers import EDGE, docs_of


def brute(words, least=24, periods=3):
    """Runs (start, length, period), period by period."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, periods * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_runs(words, **how):
    return sorted(brute(words, **how), key=lambda r: (r[0], r[2]))


def text_of(parts):
    """Documents as one string of numbers with unique marks, and their starts."""
    text, starts = [-1], []
    for words in parts:
        starts.append(len(text))
        text += list(words) + [-1]
    text = np.array(text)
    marks = np.flatnonzero(text < 0)
    text[marks] = 1000 + np.arange(len(marks))
    return text, starts


word = st.integers(0, 3)
tail = st.tuples(st.lists(word, max_size=12), st.lists(word, min_size=1, max_size=9), st.integers(0, 12),
                 st.lists(word, max_size=8)).map(lambda x: x[0] + x[1] * x[2] + x[3])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(tail, st.lists(word, max_size=60)), min_size=1, max_size=4), st.integers(1, 24))
def test_runs_are_those_of_brute_force(parts, least):
    text, starts = text_of(parts)
    got = list(zip(*(x.tolist() for x in R.periodic_runs(text, max(map(len, parts)), least))))
    want = [(s + b, s + b + n, q) for p, b in zip(parts, starts) for s, n, q in brute_runs(p, least=least)]
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.one_of(tail, st.lists(word, min_size=1, max_size=80)), st.randoms())
def test_agreement_of_two_places(words, rnd):
    text, _ = text_of([words])
    rounds = R.grammar(text)
    a = np.array([rnd.randrange(len(text)) for _ in range(40)])
    b = np.array([rnd.randrange(len(text)) for _ in range(40)])
    a, b = a[a != b], b[a != b]
    for step in (1, -1):
        want = []
        for x, y in zip(a.tolist(), b.tolist()):
            n = 0
            while text[x] == text[y]:
                x, y, n = x + step, y + step, n + 1
            want.append(n)
        assert R.agreement(rounds, a, b, step).tolist() == want


def test_the_grammar_ends_in_one_symbol_and_derives_the_text():
    text, _ = text_of([[random.Random(5).randrange(3) for _ in range(500)], [7] * 300])
    rounds = R.grammar(text)
    assert len(rounds[-1].child) == 2 and rounds[-1].child[1] == len(rounds[-1].symbols)
    assert rounds[0].symbols.tolist() == text.tolist()
    for here, above in zip(rounds, rounds[1:]):
        spelt = {}
        for k, name in enumerate(above.symbols.tolist()):
            part = tuple(here.symbols[here.child[k]:here.child[k + 1]].tolist())
            assert spelt.setdefault(name, part) == part
            assert (len(set(part)) == 1) if here.block else len(part) <= 2
        assert len(set(spelt.values())) == len(spelt)


def test_a_text_of_one_word_costs_few_queries():
    text, _ = text_of([[5] * 100_000])
    assert [x.tolist() for x in R.periodic_runs(text, 100_000)] == [[1], [100_001], [1]]


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        R.periodic_runs(np.arange(5), 3, 4, 2)


def tailed(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(doc_id, text):
    words = tailed(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] * 10 ** 12 // r[2], -r[0], -r[2]), default=(None,) * 3)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()
            if len(r.text or "") < 20_000]
    got = {r.doc_id: tuple(r) for r in R.op12(spark, SF0001).collect()}
    for i, t in rows:
        assert got[i] == digest(i, t)


def test_edge_cases(spark, tmp):
    line = "a line that recurs " * 40
    rows = [*EDGE, (20, "same " * 5000), (21, "x " + line + "y"), (22, ("a b " * 12) + ("b " * 30)), (23, "é " * 24),
            (24, "é " * 23)]
    docs_of(spark, rows).write.parquet(f"{tmp}/documents.parquet")
    got = sorted(map(tuple, R.op12(spark, tmp).collect()), key=str)
    assert got == sorted((digest(i, t) for i, t in rows), key=str)
    docs_of(spark, []).write.parquet(f"{tmp}/none/documents.parquet")
    assert R.op12(spark, f"{tmp}/none").collect() == []


def test_batches_do_not_change_runs(spark):
    rows = [(k, " ".join(f"w{j % (2 + k % 5)}" for j in range(20 + k))) for k in range(60)]
    one = sorted(map(str, R.find_runs(docs_of(spark, rows)).collect()))
    assert sorted(map(str, R.find_runs(docs_of(spark, rows), batch_words=50).collect())) == one
