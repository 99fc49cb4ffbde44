import re
from collections import Counter, defaultdict

import duckdb
import pytest

from roadpulse.llm import spimi
from tests.conftest import SF0001
from tests.llm.helpers import DOCS, EDGE


def brute(rows, least=30, top=50):
    """The contract, term by term and pair by pair; rows of (text, lang, source)."""
    docs = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))),
             lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        held, group = Counter(), defaultdict(Counter)
        for terms, this, source in docs:
            if this == lang:
                held.update(set(terms))
                group[source].update(terms)
        kept = [t for t, n in held.items() if n >= least]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in group.items()}
        q = shares(sum(group.values(), Counter()))
        for s in group:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in group if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if group[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def run(spark, rows, **how):
    data = [(k, t, lang, source, 1, 7.0, 7, "x", 7, "x", True, "x") for k, (t, lang, source) in enumerate(rows)]
    return sorted(map(tuple, spimi.source_divergence(spark.createDataFrame(data, DOCS), **how).collect()))


def corpus():
    rows = [(t, "en", None) for _, t in EDGE]
    for k in range(160):
        lang = ("en", "de", None, "\0x")[k % 4]
        text = " ".join(f"{'AbÉ漢zq'[(k * j) % 6]}w{'abcdefg'[(k + j * j) % 7]}-{k % 3}" for j in range(1 + k % 40))
        rows.append((text, lang, f"s{(k * k) % 5}"))
    return rows + [("only here", "fr", "a"), ("", "fr", "b"), (None, "fr", None)]


def test_brute_force(spark):
    rows = corpus()
    assert run(spark, rows, least_docs=3, top_terms=4) == brute(rows, 3, 4)
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_several_merges(spark, monkeypatch):
    """Blocks of few postings, two runs merged at once, sums of pairs and terms cut up: same result."""
    for name, value in (("PART_POSTINGS", 7), ("MERGE_POSTINGS", 20), ("SLICE", 11), ("PAIRS", 10), ("CELLS", 3),
                        ("SHARD_POSTINGS", 40)):
        monkeypatch.setattr(spimi, name, value)
    rows = corpus()
    assert run(spark, rows, least_docs=3, block_postings=30, fan_in=2) == brute(rows, 3)


def test_one_hot_source_and_repeats(spark):
    rows = [("the same words again", "en", "hot")] * 90 + [("other words", "en", f"s{k % 4}") for k in range(45)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_shares_are_exact():
    import numpy as np
    counts = np.array([0, 1, 7, 10 ** 13, 8 * 10 ** 15], np.int64)
    for total in (1, 11, 10 ** 9 + 7, 9 * 10 ** 15):
        some = counts[counts + 5 <= total]
        assert spimi._share(some, total, 5).tolist() == [1 + 10 ** 9 * (int(c) + 5) // total for c in some]


@pytest.mark.parametrize("sf", [SF0001])
def test_sql_twin(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, spimi.op13(spark, sf).collect())) == sorted(con.sql(spimi.SQL).fetchall())
