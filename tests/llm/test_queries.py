"""The registered queries of the training-data operators, against their SQL or what their contracts fix."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, FOLDER, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_soft_mixing", "op5_line_frequency", "op7_distinct_word_bpe", "op8_byte_network",
                                  "op9_context_tree", "op10_ball_hashing", "op11_string_kernel"])
def test_a_row_for_every_document(spark, name):
    docs = sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, FOLDER).collect()) == docs


def test_recall_of_neighbours(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    found = {}
    for r in QUERIES["op1_graph_neighbours"](spark, FOLDER).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        got = [found[q][rank] for rank in range(1, 21)]
        hits += len({i for i, _ in got} & set(ids[order]))
        assert all(s == pytest.approx(score[ids == i][0], abs=1e-12) for i, s in got)
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()
