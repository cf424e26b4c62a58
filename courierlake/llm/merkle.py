"""A Merkle manifest of a table, and proofs by a recursive climb.

A row's leaf is the digest of its fields. The leaves of a part (``lang``) ascend by ``doc_id``; while a
level has more than one node, every two neighbours (a last one by itself) become the digest of their
hexadecimal texts. What remains is the part's subroot, and the subroots, ordered by part, make the root in
the same way.

1. *Positions.* Leaves are numbered within their part by distributed running counts (``prefix``).
2. *Levels.* A block of ``2 ** LINK`` neighbours is the base of ``LINK`` levels and is digested in one task,
   so a level of any width is spread over blocks. Each row of a base level is stored as a node that is
   linked to its ancestor ``LINK`` levels up, with the siblings on the way there. These ancestors are the
   base of the next levels, and the subroots that of the last tree.
3. *Climb.* A recursive query starts at every leaf and joins, as often as there are links, the node that
   the row has reached: it appends the siblings of the link and folds them into the row's own digest. Rows
   that have arrived at the root are the result. A table of N rows is climbed in about log2(N) / LINK joins.

With ``LINK = 1`` a node is linked to its parent. Longer links give the same rows and spare shuffles of all
leaves, of which the recursion keeps one or two for each link until it ends.

Defined results: null fields count as ``-``; a null id comes first and is not tampered; null ``n_chars``
stay null; rows that repeat id and part are ordered by their leaf, and equal rows are leaves of their own;
a null part is a part, before all others; a part of one row has its leaf as subroot; a proof without
siblings is the digest of nothing; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm.common import stored
from courierlake.llm.prefix import sums_before

LINK = 10
#: Number of the tree over the subroots; the trees of the parts count from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A step of a path is a side and a sibling's digest.
_STEP = 33
_LEFT, _RIGHT, _NONE = b"l", b"r", b"-" + bytes(32)

_NODE = (
    "tree long, level int, idx long, height int, hash binary, doc_id long, start binary,"
    " path binary, up_tree long, up_level int, up_idx long, up_hash binary"
)


@dataclass(frozen=True)
class Manifest:
    """The stored trees: leaves and inner nodes with their links, and the root (None: no rows)."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _field(value: Column) -> Column:
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(counted)


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""
    fields = [changed.get(name, F.col(name)) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def tampered() -> Column:
    """The rows whose digest of 32 bits of the decimal id is divisible by 7."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, hash, start): ``start`` is the leaf that a climb begins with."""
    more = leaf_digest(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1)
    return docs.select(
        "lang",
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest().alias("hash"),
        F.when(tampered(), more).alias("changed"),
    ).select("lang", "doc_id", "hash", F.coalesce("changed", "hash").alias("start"))


def _digest(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _link_block(rows: pd.DataFrame, link: int) -> pd.DataFrame:
    """The rows of one block with the siblings on the way to the block's top."""
    rows = rows.sort_values("idx")
    tree, level, height = (int(rows[c].iloc[0]) for c in ("tree", "level", "height"))
    steps = min(link, height - level)
    hashes, paths = rows["hash"].tolist(), [bytearray() for _ in range(len(rows))]
    for step in range(steps):
        for k, path in enumerate(paths):
            own = k >> step
            other = own ^ 1
            path += (_LEFT if own & 1 else _RIGHT) + hashes[other] if other < len(hashes) else _NONE
        hashes = [_digest(hashes[k : k + 2]) for k in range(0, len(hashes), 2)]
    done = level + steps == height
    up = (TOP, 0, tree) if done else (tree, level + steps, int(rows["idx"].iloc[0]) >> steps)
    if done and tree == TOP:
        up = (None, None, None)
    above = dict(zip(("up_tree", "up_level", "up_idx"), up, strict=True))
    return rows.assign(path=[bytes(p) for p in paths], **above, up_hash=hashes[0])


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def _levels(base: DataFrame, height: int, link: int) -> list[DataFrame]:
    """All base levels of a forest, stored: leaves first."""
    out = []
    for level in range(0, max(height, 1), link):
        if out:
            tops = out[-1].where(f"idx % {1 << link} = 0 and level + {link} < height")
            base = tops.selectExpr(
                "tree", f"{level} as level", f"shiftright(idx, {link}) as idx", "height", "up_hash as hash",
                "cast(null as long) as doc_id", "cast(null as binary) as start",
            )
        blocks = base.withColumn("block", F.shiftright("idx", link)).groupBy("tree", "block")
        linked = blocks.applyInPandas(lambda rows: _link_block(rows.drop(columns="block"), link), _NODE)
        out.append(stored(linked, f"level-{level}"))
    return out


def build(rows: DataFrame, link: int = LINK) -> Manifest:
    """The trees over ``leaves``."""
    rows = stored(rows, "leaves")
    langs = sums_before(
        rows.select("lang").distinct(), [], [F.col("lang").asc_nulls_first()], {"tree": F.lit(1)}
    ).select(F.col("lang").alias("__lang"), "tree")
    own = rows.join(langs, F.col("lang").eqNullSafe(F.col("__lang"))).select("tree", "doc_id", "hash", "start")
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()]
    placed = stored(sums_before(own, ["tree"], order, {"idx": F.lit(1)}), "positions")
    heights = stored(placed.groupBy("tree").agg(_height(F.count("*")).alias("height")), "heights")
    parts, highest = heights.agg(F.count("*"), F.max("height")).first()
    if not parts:
        empty = rows.sparkSession.createDataFrame([], _NODE)
        return Manifest(empty, empty, None)
    base = placed.join(heights, "tree").selectExpr(
        "tree", "0 as level", "idx", "height", "hash", "doc_id", "start"
    )
    lower = _levels(base, highest, link)
    done = [
        x.where(f"idx % {1 << link} = 0 and level + {link} >= height").select("tree", "up_hash") for x in lower
    ]
    subroots = reduce(DataFrame.unionByName, done).select(
        F.lit(TOP).cast("long").alias("tree"),
        F.lit(0).alias("level"),
        F.col("tree").alias("idx"),
        F.lit(max(0, parts - 1).bit_length()).alias("height"),
        F.col("up_hash").alias("hash"),
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("start"),
    )
    upper = _levels(subroots, max(0, parts - 1).bit_length(), link)
    root = upper[-1].where("up_tree is null").first().up_hash
    return Manifest(lower[0], reduce(DataFrame.unionByName, [*lower[1:], *upper]), root.hex())


def _folded(start: str, path: str) -> str:
    """SQL: the digest ``start`` folded with the siblings of a path."""
    side = f"substring({path}, {_STEP} * i + 1, 1)"
    sibling = f"lower(hex(substring({path}, {_STEP} * i + 2, {_STEP - 1})))"
    both = (
        f"concat(if({side} = X'{_LEFT.hex()}', {sibling}, ''), lower(hex(acc)),"
        f" if({side} = X'{_RIGHT.hex()}', {sibling}, ''))"
    )
    steps = f"sequence(0, octet_length({path}) div {_STEP} - 1)"
    return (
        f"if(octet_length({path}) = 0, {start},"
        f" aggregate({steps}, {start}, (acc, i) -> unhex(sha2({both}, 256))))"
    )


_SIBLINGS = (
    f"transform(filter(sequence(0, octet_length(path) div {_STEP}), i -> {_STEP} * i < octet_length(path)"
    f" and substring(path, {_STEP} * i + 1, 1) <> X'{_NONE[:1].hex()}'),"
    f" i -> lower(hex(substring(path, {_STEP} * i + 2, {_STEP - 1}))))"
)

CLIMB = f"""
WITH RECURSIVE climb(doc_id, leaf, subroot, tree, level, idx, folded, path) AS (
    SELECT doc_id, hash, CAST(NULL AS BINARY), up_tree, up_level, up_idx, {_folded("start", "path")}, path
    FROM {{leaves}}
    UNION ALL
    SELECT c.doc_id, c.leaf, coalesce(c.subroot, if(n.tree = {TOP} AND n.level = 0, n.hash, NULL)),
           n.up_tree, n.up_level, n.up_idx, {_folded("c.folded", "n.path")}, concat(c.path, n.path)
    FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.idx = n.idx
)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, {_SIBLINGS} AS siblings,
       lower(hex(folded)) AS folded_root
FROM climb WHERE tree IS NULL
"""


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """The recursion may make any number of rows; the session's own limit stands again afterwards."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, siblings, folded_root) of every leaf, siblings from the leaf upwards."""
    spark = manifest.leaves.sparkSession
    with _any_number_of_rows(spark):
        return stored(spark.sql(CLIMB, leaves=manifest.leaves, nodes=manifest.nodes), "proofs")


def manifest_digests(docs: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``."""
    manifest = build(leaves(docs), link)
    root = F.lit(manifest.root).cast("string")
    return proofs(manifest).select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
