"""The multi-index against brute force, the pipeline's stages, the registered queries."""

from __future__ import annotations

import math

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import near_brute
from test_text_operators import check_packing

from checks.compare import compare, duck
from courierlake.llm import multi_index
from courierlake.llm.common import clear_stored, stored_so_far
from courierlake.llm.queries import ORACLES, QUERIES

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    """Exact neighbours of the queries: {query: [(id, score), ...]}."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            score = (x * q).sum(1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({v for _, v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_and_scores(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(multi_index.nearest(df)), brute(rows)
    assert recall(got, want) >= 0.9
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, near in got.items():
        assert [r for r, *_ in near] == list(range(1, 21))
        assert [(-s, v) for _, v, s in near] == sorted((-s, v) for _, v, s in near)
        assert all(math.isclose(s, float((x[q] * x[v]).sum()), abs_tol=1e-12) for _, v, s in near)


def test_a_vector_that_a_third_repeats(spark, monkeypatch):
    """Ties go by id over all blocks that the copies are spread over."""
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 50)
    monkeypatch.setattr(multi_index, "QUERY_ROWS", 7)
    rnd = np.random.default_rng(1)
    rows = [(k, [0.5] * 6 if k % 3 == 0 else rnd.normal(size=6).tolist()) for k in range(900)]
    got = found(multi_index.nearest(spark.createDataFrame(rows, KIND)))
    want = brute([(i, v) for i, v in rows])
    assert recall(got, want) >= 0.9
    assert [v for _, v, _ in got[60]] == [v for v, _ in want[60]]


def test_index_edges(spark):
    good = [(k, [float(k % 7) + 1, 1.0, -2.0]) for k in range(30)]
    bad = [(40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 2.0]), (100, [float("nan"), 1.0, 1.0])]
    bad += [(120, [float("inf"), 1.0, 1.0]), (140, [1.0, 2.0]), (160, []), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(good + bad, KIND).withColumn("cell", F.lit("x")).withColumn("block", F.lit(1))
    got = found(multi_index.nearest(df))
    assert set(got) == {0, 20}
    assert all(v < 30 for near in got.values() for _, v, _ in near)
    few = found(multi_index.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (0, [1.0, 2.0])], KIND)))
    assert [(r, v) for r, v, _ in few[0]] == [(1, 1)]
    assert multi_index.nearest(spark.createDataFrame([], KIND)).count() == 0
    assert multi_index.nearest(spark.createDataFrame([(0, [1.0, 2.0])], KIND)).count() == 0


def test_cells_are_visited_by_falling_sum():
    rnd = np.random.default_rng(2)
    left, right = rnd.normal(size=(5, 2)), rnd.normal(size=(4, 3))
    none = np.zeros(20, np.int64)
    index = multi_index.Index(left, right, 1.0, np.ones(20, np.int64), none, none)
    q = rnd.normal(size=5)
    cells = multi_index.visit(q, index, 20)
    sums = [left[c // 4] @ q[:2] + right[c % 4] @ q[2:] for c in cells]
    assert sorted(cells) == list(range(20)) and sums == sorted(sums, reverse=True)
    assert multi_index.visit(q, index, 3) == cells[:3]


# --- queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cursor = duck(sf).execute(ORACLES[name])
    assert compare(rows, df.columns, cursor.fetchall(), [d[0] for d in cursor.description]) is None
    assert rows


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("__row", F.lit("x"))
    before = docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before, results[name] = (results[name] if name in results else before), stage(spark, before, sf).persist()
        before = results[name]
        if name != "best-fit packing":
            assert results[name].columns == docs.columns
    rows = {n: {r.doc_id: r.text for r in d.collect()} for n, d in results.items() if n != "best-fit packing"}
    good, exact, near, clean = (rows[n] for n, _ in corpus_pipeline.STAGES[:4])
    assert 0 < len(good) < docs.count()

    def key(t):
        return "".join(t.split(" ")).translate(dict.fromkeys(range(9, 14)))

    assert len(exact) == len({key(t) for t in good.values()}) == len({key(t) for t in exact.values()})
    heads = {c for _, _, c in near_brute(exact.items())}
    empty = {i for i, t in exact.items() if not t.split()}
    assert set(near) == heads | empty
    assert set(clean) == set(near)
    assert any("[SECRET]" in t for t in clean.values())
    used, least = check_packing(results["best-fit packing"].collect(), clean)
    assert used <= least + 1
    for d in results.values():
        d.unpersist()


def test_a_run_leaves_its_result_only(spark, sf):
    before = stored_so_far()
    pieces = corpus_pipeline.run(spark, sf)
    assert stored_so_far() == before + 1
    assert pieces.count() >= pieces.select("doc_id").distinct().count() > 0
    clear_stored(spark, since=before)
    assert stored_so_far() == before


def test_pipeline_of_no_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
