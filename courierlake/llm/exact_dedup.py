"""Exact deduplication over an extendible-hash index kept as files in the shared folder.

Texts are equal when they are identical after deleting every character of ``[\\x20\\x09-\\x0D]``.
Everything here is DataFrame expressions.

1. *Compare bytes.* Rows are grouped by (hash key, normalised text). The grouping compares the
   texts byte by byte and combines copies inside each map task, so a text that a third of all
   rows share leaves each task as one row.
2. *Directory.* The distinct texts are counted by the leading bits of their keys. A bucket starts
   as the whole key space and is halved, which doubles the directory, as long as it holds more
   than ``bucket_rows`` texts and bits are left. A bucket that still overflows just has more rows.
3. *Owner tasks.* The texts' records are range-partitioned by (bucket, key), so each task owns a
   range of keys. It chains the records of colliding keys and writes its part of the index, sorted,
   as Parquet: a probe by bucket or key reads few row groups.
4. *Probe.* Every row looks its key up and takes the chain entry with its SHA-256.

Defined results: null text counts as empty, and empty texts are copies of each other; a null
``doc_id`` sorts after all others; of rows that repeat both ``doc_id`` and text exactly one is
kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import lookup, stored, whole_text

BUCKET_ROWS = 100_000
#: Depth of the directory at most: it has 2**16 entries, a bounded broadcast.
MAX_DEPTH = 16

#: The characters [\x20\x09-\x0D], which do not count.
BLANKS = " \t\n\x0b\x0c\r"

# A rank packs (code points, smaller doc_id first, null last) into one number, because a number
# can be updated in place while rows are hashed, which a struct can't.
_IDS = "18446744073709551616BD"  # 2**64
_HALF = "9223372036854775808BD"  # 2**63


def normalised(text: Column) -> Column:
    return F.translate(whole_text(text), BLANKS, "")


def _rank(n_chars: str, doc_id: str) -> Column:
    return F.expr(
        f"cast({n_chars} as decimal(11,0)) * 2 * {_IDS}"
        f" + coalesce({_HALF} - cast({doc_id} as decimal(20,0)), 0BD)"
    ).cast("decimal(38,0)")


def _ranked_id(rank: str) -> Column:
    low = f"({rank} % (2BD * {_IDS}))"
    return F.expr(f"case when {low} = 0 then null else cast({_HALF} - {low} as bigint) end")


def distinct_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One record for each distinct normalised text: (key, sha, n_bytes, keep_id, size)."""
    return (
        docs.select(
            F.xxhash64(normalised(F.col(text))).alias("key"),
            normalised(F.col(text)).alias("bytes"),
            F.char_length(whole_text(F.col(text))).alias("n_chars"),
            F.col(doc_id).cast("bigint").alias("doc_id"),
        )
        .select("key", "bytes", _rank("n_chars", "doc_id").alias("rank"))
        .groupBy("key", "bytes")
        .agg(F.max("rank").alias("rank"), F.count("*").alias("size"))
        .select(
            "key",
            F.sha2("bytes", 256).alias("sha"),
            F.octet_length("bytes").alias("n_bytes"),
            _ranked_id("rank").alias("keep_id"),
            "size",
        )
    )


def directory(texts: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(leaf, depth, bucket) of every leaf in use; a leaf is the key's first MAX_DEPTH bits."""
    leaves = texts.groupBy(_leaf("key").alias("leaf")).agg(F.count("*").alias("n"))
    levels = leaves.select(
        "leaf", "n", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth")
    ).withColumn("prefix", F.expr(f"shiftright(leaf, {MAX_DEPTH} - depth)"))
    fits = (
        levels.groupBy("depth", "prefix")
        .agg(F.sum("n").alias("held"))
        .where((F.col("held") <= bucket_rows) | (F.col("depth") == MAX_DEPTH))
    )
    # The first depth at which the bucket of a leaf fits is the depth at which splitting stops.
    # ``fits`` has at most 2 ** (MAX_DEPTH + 1) rows, so it may go to every task.
    return (
        levels.join(F.broadcast(fits), ["depth", "prefix"])
        .groupBy("leaf")
        .agg(F.min("depth").alias("depth"))
        .withColumn(
            "bucket", F.expr(f"shiftleft(shiftright(leaf, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)")
        )
    )


def _leaf(key: str) -> Column:
    return F.expr(f"cast(shiftrightunsigned({key}, {64 - MAX_DEPTH}) as int)")


def build_index(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """The stored index: (bucket, depth, key, chain), a chain entry for each text of the key."""
    texts = stored(distinct_texts(docs, text, doc_id), "texts")
    table = directory(texts, bucket_rows)
    owned = texts.withColumn("leaf", _leaf("key")).join(F.broadcast(table), "leaf")
    index = (
        owned.repartitionByRange("bucket", "key")
        .groupBy("bucket", "key")
        .agg(
            F.min("depth").alias("depth"),
            F.collect_list(F.struct("sha", "n_bytes", "keep_id", "size")).alias("chain"),
        )
        .sortWithinPartitions("bucket", "key")
    )
    return stored(index, "index")


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    index = build_index(docs, text, doc_id, bucket_rows)
    entries = index.select("key", F.explode("chain").alias("e")).select("key", "e.*")
    total = entries.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Rows that repeat id and text become one row with a number of copies. The hashes are stored,
    # so that the two ways of the lookup read them instead of the texts.
    probes = (
        docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("bytes"))
        .select("doc_id", F.xxhash64("bytes").alias("key"), F.sha2("bytes", 256).alias("sha"))
        .groupBy("doc_id", "key", "sha")
        .agg(F.count("*").alias("copies"))
    )
    found = lookup(
        stored(probes, "probes"),
        entries.select("key", "sha", "keep_id", "size"),
        ["key", "sha"],
        "size",
        total,
    )
    return found.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("doc_id").cast("bigint").eqNullSafe(F.col("keep_id")).alias("keeps"),
        F.col("sha").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("keeps") & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_distinct(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Of the rows that repeat id and normalised text the one with most code points stays.
    """

    def keys(number: Column, sha: Column) -> list[Column]:
        number = number.cast("bigint")
        none, some = number.isNull().alias("__none"), F.coalesce(number, F.lit(0)).alias("__id")
        return [none, some, sha.alias("__sha")]

    kept = exact_dedup(docs, text, doc_id).where("kept")
    of = F.col(f"__row.{text}")
    # One row for each id and text first, in each map task: copies without an id are one key.
    once = (
        docs.select(F.struct("*").alias("__row"), F.col(doc_id).alias("__of"))
        .select("__row", *keys(F.col("__of"), F.sha2(normalised(of), 256)))
        .groupBy("__none", "__id", "__sha")
        .agg(F.max_by("__row", F.struct(F.char_length(whole_text(of)), F.xxhash64(of))).alias("__row"))
    )
    ids = kept.select(*keys(F.col("doc_id"), F.col("text_sha256")))
    return once.join(ids, ["__none", "__id", "__sha"], "left_semi").select("__row.*")
