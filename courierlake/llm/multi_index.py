"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut in two halves and each half is quantised by its own centroids; a pair of centroids is
a cell of the index. For a query the pairs are visited by falling summed inner product of the halves
with their centroids, with a heap over the two sorted lists, until the cells visited hold a given
share of all entries. Entries of visited cells are then ranked by their exact inner product.

Centroids, and the share to visit, are fitted on a bounded sample (``SAMPLE_ROWS`` vectors with the
smallest hashed ids): the share is the smallest at which ``TARGET`` of the sample's own nearest
neighbours lie in visited cells. Every vector is indexed. Cells are dealt to blocks of about
``BLOCK_ROWS`` entries; a cell with more entries, such as one vector a third of all rows repeat, is
spread over several blocks, and small cells share one. A group of work is one block against at most
about ``QUERY_ROWS`` queries, so its memory is bounded; each sends on its ``k`` best per query only.

Defined results: vectors that are null, zero, of another than the most frequent length (ties: the
shorter), or hold a null or non-finite component take no part, neither do null ids. Equal scores go
by smaller id. Rows that repeat id and vector are separate candidates, but a query's own id never is
one; queries that repeat an id and a vector give one result. An empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierlake.llm.common import stored

CENTROIDS = 64
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 512
TARGET = 0.96
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
#: Queries whose cells one task visits, about. They are few bytes and much work, so they are dealt by number.
VISITS = 128
STEPS = 12
QUERY_EVERY = 20


@dataclass
class Index:
    """The bounded part of the index: centroids of both halves, entries by cell, blocks by cell."""

    left: np.ndarray
    right: np.ndarray
    share: float
    counts: np.ndarray
    first_block: np.ndarray
    n_blocks: np.ndarray

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        cut = vectors.shape[1] // 2
        a, b = _nearest(vectors[:, :cut], self.left), _nearest(vectors[:, cut:], self.right)
        return a * len(self.right) + b


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1)[None] - 2 * x @ centroids.T).argmin(1)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; an empty centroid stays where it is."""
    found = np.unique(x, axis=0)
    found = found[np.linspace(0, len(found) - 1, min(k, len(found))).astype(int)].copy()
    for _ in range(STEPS):
        of = _nearest(x, found)
        sums = np.zeros_like(found)
        np.add.at(sums, of, x)
        n = np.bincount(of, minlength=len(found))
        found[n > 0] = sums[n > 0] / n[n > 0, None]
    return found


def visit(query: np.ndarray, index: Index, need: float) -> list[int]:
    """Cells in the order of the summed inner product, until they hold ``need`` entries."""
    cut, width = len(query) // 2, len(index.right)
    near, far = index.left @ query[:cut], index.right @ query[cut:]
    by_near, by_far = np.argsort(-near, kind="stable"), np.argsort(-far, kind="stable")
    heap, seen, held, cells = [(-(near[by_near[0]] + far[by_far[0]]), 0, 0)], {(0, 0)}, 0, []
    while heap and held < need:
        _, i, j = heapq.heappop(heap)
        cell = int(by_near[i]) * width + int(by_far[j])
        if n := index.counts[cell]:
            cells.append(cell)
            held += n
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(near) and b < len(far) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (-(near[by_near[a]] + far[by_far[b]]), a, b))
    return cells


def _share(sample: np.ndarray, index: Index, k: int, total: int) -> float:
    """The share of entries to visit; ``k`` of ``total`` rows are fewer of the sample."""
    k = min(max(1, round(k * len(sample) / total)), len(sample) - 1)
    if k < 1:
        return 1.0
    queries = sample[:SAMPLE_QUERIES]
    scores = queries @ sample.T
    np.fill_diagonal(scores, -np.inf)
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    cut, cells = sample.shape[1] // 2, index.cells(sample)
    seen = (queries[:, :cut] @ index.left.T)[:, cells // len(index.right)]
    seen = seen + (queries[:, cut:] @ index.right.T)[:, cells % len(index.right)]
    rank = np.argsort(np.argsort(-seen, axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, top, 1).ravel()) + 1
    return float(needed[int(np.ceil(TARGET * len(needed))) - 1]) / len(sample)


def valid_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("vector"),
    ).where("vec_id is not null and size(vector) > 0")
    sizes = rows.groupBy(F.size("vector").alias("n")).count()
    usual = sizes.orderBy(F.desc("count"), "n").limit(1).collect()
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    some = "exists(vector, x -> x <> 0)"
    return rows.where(f"size(vector) = {usual[0].n if usual else 0} and {finite} and {some}")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def fit(rows: DataFrame, k: int) -> Index | None:
    """Fit on the sample; ``rows`` are valid vectors. None if there is no row."""
    total = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()
    if picked.empty:
        return None
    sample = _matrix(picked["vector"])
    cut = sample.shape[1] // 2
    left, right = _centroids(sample[:, :cut], CENTROIDS), _centroids(sample[:, cut:], CENTROIDS)
    none = np.zeros(len(left) * len(right), dtype=np.int64)
    index = Index(left, right, 1.0, none, none, none)
    index.share = _share(sample, index, k, total)
    return index


def _deal(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell."""
    first, blocks = np.zeros_like(counts), np.ones_like(counts)
    block, held = 0, 0
    for cell, n in enumerate(counts):
        if held and held + n > BLOCK_ROWS:
            block, held = block + 1, 0
        first[cell] = block
        if n > BLOCK_ROWS:
            blocks[cell] = -(-n // BLOCK_ROWS)
            block, held = block + int(blocks[cell]), 0
        else:
            held += n
    return first, blocks


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows of ``queries``."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, vec_id, embedding)
    index = fit(rows, k)
    result = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], result)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["cell"] = index.cells(_matrix(batch["vector"]))
                yield batch

    entries = stored(rows.mapInPandas(place, "vec_id long, vector array<double>, cell long"), "entries")
    for r in entries.groupBy("cell").count().collect():  # a row for each cell in use, 4096 at most
        index.counts[r.cell] = r["count"]
    index.first_block, index.n_blocks = _deal(index.counts)
    asked = entries.where(queries).dropDuplicates(["vec_id", "vector"])
    n_asked = asked.count()
    salts = max(1, -(-n_asked // QUERY_ROWS))
    need = index.share * index.counts.sum()
    shared = spark.sparkContext.broadcast(index)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            if not len(batch):
                continue
            visited, blocks = [], []
            for vector in batch["vector"]:
                cells = np.array(visit(np.asarray(vector, dtype=np.float64), table, need))
                mask = np.zeros(len(table.counts), dtype=bool)
                mask[cells] = True
                visited.append(np.packbits(mask).tobytes())
                spread = [
                    np.arange(table.first_block[c], table.first_block[c] + table.n_blocks[c]) for c in cells
                ]
                blocks.append(np.unique(np.concatenate(spread)))
            yield batch.assign(visited=visited, block=blocks)[["vec_id", "vector", "visited", "block"]]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            cell = batch["cell"].to_numpy()
            yield batch.assign(block=table.first_block[cell] + batch["part"].to_numpy() % table.n_blocks[cell])

    salt = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(salts))
    routed = (
        asked.select("vec_id", "vector")
        .repartition(max(1, -(-n_asked // VISITS)), "vec_id", "vector")
        .mapInPandas(route, "vec_id long, vector array<double>, visited binary, block array<long>")
        .select("vec_id", "vector", "visited", F.explode("block").alias("block"), salt.alias("salt"))
    )
    dealt = (
        entries.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(11)), F.lit(1 << 30)))
        .mapInPandas(spread, "vec_id long, vector array<double>, cell long, part long, block long")
        .select("vec_id", "vector", "cell", "block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        .withColumn("salt", F.col("salt").cast("long"))
    )

    def rank(found: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return _block_top(found, asking, k)

    best = (
        dealt.groupBy("block", "salt")
        .cogroup(routed.groupBy("block", "salt"))
        .applyInPandas(rank, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _block_top(found: pd.DataFrame, asking: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best entries of a block for each query, among the cells that it visits."""
    out: list[tuple] = []
    if len(found) and len(asking):
        entries, ids, cells = _matrix(found["vector"]), found["vec_id"].to_numpy(), found["cell"].to_numpy()
        queries = _matrix(asking["vector"])
        for start in range(0, len(queries), 256):
            about = queries[start : start + 256] @ entries.T
            for row, query, own, visited in zip(
                about,
                queries[start : start + 256],
                asking["vec_id"].to_numpy()[start : start + 256],
                asking["visited"].iloc[start : start + 256],
                strict=True,
            ):
                mask = np.unpackbits(np.frombuffer(visited, dtype=np.uint8)).astype(bool)[cells]
                row = np.where(mask & (ids != own), row, -np.inf)
                cut = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                # The product's last bits depend on a row's place; so all near the cut are exact.
                at = np.flatnonzero((row >= cut - 1e-9 * (1 + abs(cut))) & (row > -np.inf))
                score = (entries[at] * query).sum(1)
                top = np.lexsort((ids[at], -score))[:k]
                out += zip([own] * len(top), ids[at][top], score[top], strict=True)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame) -> DataFrame:
    """The search for the rows whose id is divisible by ``QUERY_EVERY``."""
    return search(vectors, F.col("vec_id") % QUERY_EVERY == 0)
