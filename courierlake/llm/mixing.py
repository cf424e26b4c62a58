"""A mixture of sources in given proportions, cut to the word.

Sources have the weights 1, 2, 3, repeating, in the order of their names (null last), and share the size
of the whole table. No source gives more than ``EPOCHS`` times its own size: what it can't give is shared
by the others by weight, until none is above.

1. *Keys.* A document's place in its source is the MD5 of its id: random, and the same in every run.
2. *Prefix sums.* Documents are range-sorted by source and key, and the words before each one in its
   source are summed over slices (``prefix``). No source is in one task.
3. *Cuts.* A source's target, rounded down to words, is so many whole epochs and a rest. Every document is
   taken once for each epoch, those in front once more, and the one at the cut for as many of its first
   words as the rest still needs, so that a source gives exactly its budget.

Shares are found by rounds over one row for each source; a round sends two sums to the driver.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]``; null and empty texts have none, and nothing
of them is taken; a null id has a key of its own; documents with equal keys go by id, then by size, and
rows that are equal in these get what equal rows get, in any order; a table without words has
targets of 0; an empty table gives no row; further columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import stored, whole_text
from courierlake.llm.prefix import sums_before

EPOCHS = 3
WEIGHTS = 3
SEED = "mix"

_WORD = r"[^\x20\x09-\x0D]++"


def n_words(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(_WORD)).cast("long")


def sources(sizes: DataFrame, epochs: int = EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """(source, source_size, target) of (source, size) rows."""
    sums = stored(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).select(
            "source", "source_size", F.col("source").isNull().alias("unnamed")
        ),
        "sources",
    )
    order = [F.col("unnamed").asc(), F.col("source").asc()]
    ranked = stored(
        sums_before(sums, [], order, {"place": F.lit(1)}).select(
            "source",
            "source_size",
            (F.col("place") % weights + 1).alias("weight"),
            (F.col("source_size") * epochs).alias("most"),
        ),
        "weights",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = F.lit(0.0), -1
    while True:
        # Sources below the level of the last round stay below: the level only rises.
        is_capped = F.col("most") < F.col("weight") * level
        full, shares, n = ranked.agg(
            F.coalesce(F.sum(F.when(is_capped, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(F.when(is_capped, 1)), F.lit(0)),
        ).first()
        if n == capped:
            break
        capped = n
        level = F.lit(float(total - full) / shares if shares else 0.0)
    share = F.lit(float(total - full)) * F.col("weight") / F.lit(float(shares or 1))
    target = F.when(is_capped, F.col("most").cast("double")).otherwise(share)
    return ranked.select("source", "source_size", target.alias("target"))


def taken_words(sizes: DataFrame, epochs: int = EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """Rows of (doc_id, source, size) with ``source_size``, ``target`` and ``taken``."""
    key = F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")))
    keyed = stored(sizes.withColumn("key", key), "sizes")
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc()]
    placed = sums_before(keyed, ["source"], order, {"before": F.col("size")})
    shares = sources(keyed, epochs, weights).withColumnRenamed("source", "__source")
    joined = placed.join(shares, F.col("source").eqNullSafe(F.col("__source")))
    cuts = joined.withColumn("budget", F.floor("target")).withColumn(
        "whole", F.expr("if(source_size > 0, budget div source_size, 0)")
    )
    rest = F.col("budget") - F.col("whole") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    taken = (F.col("whole") * F.col("size") + part).cast("long").alias("taken")
    return cuts.select("doc_id", "source", "size", "source_size", "target", taken)


def mix(docs: DataFrame, epochs: int = EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
    )
    taken = taken_words(sizes, epochs, weights)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def first_words(text: str, n: int) -> str:
    """``text`` up to the end of its ``n``-th word."""
    end = 0
    for k, word in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", text), 1):
        if k > n:
            break
        end = word.end()
    return text[:end]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        pairs = zip(frame["text"], frame["words"], strict=True)
        yield frame.assign(text=[first_words(t, n) for t, n in pairs])


def mixture(docs: DataFrame, epochs: int = EPOCHS, weights: int = WEIGHTS) -> DataFrame:
    """The mix itself: (doc_id, source, epoch, words, text), a row for each time a text is taken.

    Only the texts at the cuts, at most one for each source, are shortened.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        whole_text(F.col("text")).alias("text"),
    ).withColumn("size", n_words(F.col("text")))
    # Rows that agree in id, source and size are told apart by nothing that the cut looks at, so
    # they are numbered, and the numbered decisions are dealt to the numbered rows.
    names = ["doc_id", "source", "size"]
    numbered = stored(sums_before(rows, names, [F.col("text").asc()], {"copy": F.lit(1)}), "texts")
    taken = taken_words(numbered.select(*names), epochs, weights)
    taken = sums_before(taken, names, [F.col("taken").desc()], {"copy": F.lit(1)}).select(
        *[F.col(c).alias(f"__{c}") for c in (*names, "copy")], "taken"
    )
    same = F.lit(True)
    for c in (*names, "copy"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    times = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    parts = (
        numbered.join(taken, same)
        .where("taken > 0")
        .select("doc_id", "source", "size", "taken", "text", times.alias("epoch"))
        .withColumn("words", F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size")))
    )
    out = parts.select("doc_id", "source", "epoch", "words", "text", (F.col("words") < F.col("size")).alias("short"))
    cut = out.where("short").drop("short")
    return out.where("not short").drop("short").unionByName(cut.mapInPandas(_cut, cut.schema))
