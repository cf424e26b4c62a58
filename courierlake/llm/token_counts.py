"""Token counts by a sentencepiece model with a map-side two-tier lookup.

Texts are cut into pre-tokens where the model can't merge across (``metaspace``). The first tier is
a broadcast table of the token counts of frequent pre-tokens, at most ``TABLE_ROWS`` entries of at
most ``LONGEST_KEPT`` characters. The second tier is a bounded cache in each worker, filled by
encoding what the table lacks in batches. No pre-token is shuffled: to find the frequent ones, each
task sends one summary of at most ``SUMMARY_ROWS`` entries. The table saves work only; counts are
the library's, whatever it holds.

Defined results: null text counts as empty; empty text has no token and no byte; null ids and
repeated rows pass through; further columns are ignored. Strings of special tokens inside texts are
ordinary text, as the library treats them by default.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import whole_text
from courierlake.llm.metaspace import (
    LONGEST_KEPT,
    Cache,
    cuttable,
    encode_segments,
    processor,
    segments,
)

TABLE_ROWS = 65_536
SUMMARY_ROWS = 4_096
CACHE_ROWS = 400_000
#: A task's counter is cut back to its most frequent entries when it reaches this size.
COUNTER_ROWS = 262_144
MAX_TOKENS = 4096


def frequent_pretokens(docs: DataFrame, text: str = "text", rows: int = TABLE_ROWS) -> list[str]:
    """The pre-tokens that the tasks' summaries show most often, over all documents."""

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch["text"]:
                for found in segments(value):
                    seen.update(found)
                if len(seen) > COUNTER_ROWS:
                    seen = Counter(dict(seen.most_common(COUNTER_ROWS // 4)))
        top = [(k, n) for k, n in seen.most_common(SUMMARY_ROWS) if len(k) <= LONGEST_KEPT]
        yield pd.DataFrame(top, columns=["pretoken", "n"])

    found = (
        docs.select(whole_text(F.col(text)).alias("text"))
        .mapInPandas(summary, "pretoken string, n long")
        .groupBy("pretoken")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pretoken")
        .limit(rows)
    )
    return [r.pretoken for r in found.collect()]


@lru_cache(maxsize=4)
def _worker_cache(model: str) -> Cache:
    return Cache(CACHE_ROWS)


def counter(model: str, table: dict[str, int]):
    """A function from text to its number of tokens, for use in a worker."""
    sp, cache = processor(model), _worker_cache(model)
    if not cuttable(model):
        return lambda text: len(sp.encode(text))

    def count(text: str) -> int:
        total = 0
        for found in segments(text):
            rare = []
            for n, key in zip(map(table.get, found), found, strict=True):
                if n is None:
                    rare.append(key)
                else:
                    total += n
            lost = cache.missing(rare)
            if lost:
                cache.update(zip(lost, map(len, encode_segments(model, lost)), strict=True))
            total += sum(map(cache.__getitem__, rare))
            cache.trim()
        return total

    return count


def token_counts(
    docs: DataFrame,
    model: str,
    text: str = "text",
    doc_id: str = "doc_id",
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    table: dict[str, int] = {}
    if cuttable(model) and (keys := frequent_pretokens(docs, text)):
        table = dict(zip(keys, map(len, encode_segments(model, keys)), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(model, shared.value)
        for batch in batches:
            yield batch.map(count).astype("int64")

    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole_text(F.col(text))).cast("long").alias("n_bytes"),
        n_tokens(whole_text(F.col(text))).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > max_tokens)
