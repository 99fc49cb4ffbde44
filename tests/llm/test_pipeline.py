import re
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from roadpulse.llm import registry
from roadpulse.llm.common import materialize
from tests.conftest import SF001, SF0001
from tests.llm.helpers import DOCS, EDGE, docs_of
from tests.oracle_check import compare, duck

ROOT = Path(__file__).parents[2]


def test_registered_queries():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_oracles_match(spark):
    registry.load_all()
    con = duck(SF001)
    for name, sql in registry.ORACLE.items():
        assert compare(spark, con, name, registry.QUERIES[name], sql, SF001)[0] == [], name


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF0001))
        ids = [r.doc_id for r in docs.collect()]
        assert docs.columns == columns and len(ids) == len(set(ids)) and set(ids) <= seen, name
        assert len(ids) >= 0.8 * len(seen), name
        seen = set(ids)
    packed = corpus_pipeline.run(spark, SF0001).collect()
    assert {r.doc_id for r in packed} == seen


def test_stages_take_edge_rows(spark):
    for rows in (EDGE, []):
        docs = docs_of(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF0001))
            assert docs.columns == [f.name for f in DOCS]
        left = {r.doc_id for r in docs.collect()}
        # Rows 1 and 6 are copies, as are the texts without words 2, 3.
        assert left == ({1, 2, 4, 5, 7, 8, 9, None} if rows else set())
        assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, SF0001).collect()} == left


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "roadpulse").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "roadpulse.llm" not in path.read_text(), path


def test_no_local_checkpoints_or_folders():
    for path in [*(ROOT / "roadpulse/llm").glob("*.py"), ROOT / "corpus_pipeline.py"]:
        assert not re.search(r"localCheckpoint|tempfile|mkdtemp|crossJoin|open\(f?\"/", path.read_text()), path
