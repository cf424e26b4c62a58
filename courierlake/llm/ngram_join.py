"""A Jaccard self-join over word shingles with prefix filters under several token orders.

Two documents link when 100 * |A & B| >= 75 * |A | B| for their sets of distinct five-word shingles.
If they do, then under any total order of the shingles the first ``n - ceil(0.75 n) + 1`` of each
share one; for a given pair, which must share ``o``, the first ``n - o + 1`` of each do. One filter of
that kind is weak; a pair must pass it under several orders: all put rare shingles first (by document
frequency, or its order of magnitude) and break ties by different hashes.

1. *Classes.* Equal sets are one class, named by a 128-bit digest; copies never meet each other again.
2. *Frequencies.* Tasks send their classes' shingles, packed, to buckets of the hash space, which
   count in how many classes each occurs. Only shingles of two or more classes go back. A class whose
   prefix holds nothing else has no partner and leaves; in ordinary text that is nearly all of them.
3. *Leaders.* Of the classes that share a prefix shingle of the first order one is the leader, and
   those of other components are only held against it. What links joins the leader's component.
   Rounds of this, the first led by the classes with the least text of their own and the others by
   chance, melt large groups of near copies without forming their pairs.
4. *Rest.* Pairs of different components that share a prefix shingle, and only those, are held against
   each other, all of them; pairs inside a component can't change it.

Candidates must pass the size filter and the prefix filters of all orders before their overlap is
counted. The result is exact: no list, pair or group is capped.

Defined results: null and empty texts and texts without words have no shingles and link with nothing;
texts of fewer than five words have their whole sequence as only shingle; null ids: the row's
component is named by the smallest id other than null (null if there is none); repeated rows are
copies; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import lookup, stored, whole_text
from courierlake.llm.components import components
from courierlake.llm.words import mix, shingle_sets

WORDS = 5
PERCENT = 75
ORDERS = 3
#: Shingles that a task packs before it sends them, and that a bucket counts at once, about.
PACK = 1 << 19
BUCKET = 1 << 21
#: Bits of a shingle's hash that are sent besides its bucket's.
WIDTH = 48
#: Leader rounds go on while pairs between components outnumber the prefix entries by this factor
#: and the last round took off this share of them.
REST, GAIN = 4, 0.9
#: Buckets of the hash space are at least two to this power.
LEAST_BITS = 7
#: Pairs that a leader is sent to at once.
LEADER_ROWS = 512


def prefix_size(n: np.ndarray) -> np.ndarray:
    """How many shingles of a set a partner must share one of, under any order."""
    return n - -(-n * PERCENT // 100) + 1


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set: sums of two independent mixes of its members."""
    first, second = mix(shingles, 11), mix(shingles, 12)
    return first.sum(dtype=np.uint64).tobytes() + second.sum(dtype=np.uint64).tobytes()


def shingled(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carried: Column | None = None
) -> DataFrame:
    """(doc_id, n, cls, carried) for every row; ``cls`` is null where there is no shingle."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [(len(s), _digest(s) if len(s) else None) for s in shingle_sets(batch["text"], WORDS)]
            out = pd.DataFrame(sets, columns=["n", "cls"])
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n": out["n"],
                    "cls": out["cls"].astype(object),
                    "carried": batch["carried"],
                }
            )

    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        whole_text(F.col(text)).alias("text"),
        (F.lit(None) if carried is None else carried).cast("string").alias("carried"),
    )
    return narrow.mapInPandas(measure, "doc_id long, n long, cls binary, carried string")


def _pack(tokens: np.ndarray, bits: int) -> bytes:
    """The leading ``WIDTH`` bits behind the bucket's, as bytes."""
    width = min(WIDTH, 64 - bits)
    kept = (tokens << np.uint64(bits) >> np.uint64(64 - width)).astype("<u8")
    return np.ascontiguousarray(kept.view(np.uint8).reshape(-1, 8)[:, : WIDTH // 8]).tobytes()


def _unpack(data: bytes, bucket: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, WIDTH // 8)
    full = np.zeros((len(raw), 8), dtype=np.uint8)
    full[:, : WIDTH // 8] = raw
    return full.view("<u8").ravel() | np.uint64(bucket << min(WIDTH, 64 - bits))


def _postings(docs: DataFrame, bits: int, text: str) -> DataFrame:
    """Packed shingles by bucket, and a row of its classes for each pack (bucket < 0)."""

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        seen: set[bytes] = set()
        sets: list[np.ndarray] = []
        names: list[bytes] = []
        size = 0

        def send() -> pd.DataFrame:
            pack = (task << 24) + number
            tokens = np.concatenate(sets)
            of = np.repeat(np.arange(len(sets), dtype="<u4"), [len(s) for s in sets])
            bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), int)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
            counts = np.array([len(s) for s in sets], dtype="<u4")
            rows = [(-1 - pack, pack, b"".join(names), counts.tobytes())]
            for b in range(1 << bits):
                part = order[bounds[b] : bounds[b + 1]]
                if len(part):
                    rows.append((b, pack, _pack(tokens[part], bits), of[part].tobytes()))
            return pd.DataFrame(rows, columns=["bucket", "pack", "tokens", "of"])

        for batch in batches:
            for found in shingle_sets(batch["text"], WORDS):
                if not len(found) or (name := _digest(found)) in seen:
                    continue
                seen.add(name)
                sets.append(found)
                names.append(name)
                size += len(found)
                if size >= PACK:
                    yield send()
                    number += 1
                    sets, names, size = [], [], 0
        if sets:
            yield send()

    schema = "bucket long, pack long, tokens binary, of binary"
    return docs.select(whole_text(F.col(text)).alias("text")).mapInPandas(packs, schema)


def _count(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Of one bucket: for each pack its shingles that occur more than once, with their counts."""
    bucket = int(rows["bucket"].iloc[0])
    columns = ["pack", "names", "tokens", "of", "df"]
    if bucket < 0:
        row = rows.iloc[0]
        return pd.DataFrame([(row["pack"], row["tokens"], None, row["of"], None)], columns=columns)
    parts = [_unpack(data, bucket, bits) for data in rows["tokens"]]
    tokens = np.concatenate(parts)
    order = np.argsort(tokens)
    ranked = tokens[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group = np.cumsum(new) - 1
    df = np.empty(len(tokens), dtype="<u4")
    df[order] = np.bincount(group)[group]
    out, start = [], 0
    for part, pack, of in zip(parts, rows["pack"], rows["of"], strict=True):
        here = df[start : start + len(part)]
        keep = here > 1
        start += len(part)
        if keep.any():
            of = np.frombuffer(of, dtype="<u4")[keep]
            out.append((pack, None, part[keep].tobytes(), of.tobytes(), here[keep].tobytes()))
    return pd.DataFrame(out, columns=columns)


def _regroup(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one pack: its classes that may have a partner, with their shared shingles."""
    named = rows["names"].notna()
    head, rest = rows[named].iloc[0], rows[~named]
    names, n = head["names"], np.frombuffer(head["of"], dtype="<u4").astype(np.int64)
    if not len(rest):
        return pd.DataFrame(columns=["cls", "n", "tokens", "df"])
    tokens, of, df = (
        np.concatenate([np.frombuffer(x, dtype=kind) for x in rest[c]])
        for c, kind in (("tokens", "<u8"), ("of", "<u4"), ("df", "<u4"))
    )
    order = np.lexsort((tokens, of))
    tokens, of, df = tokens[order], of[order], df[order]
    bounds = np.searchsorted(of, np.arange(len(n) + 1))
    alone = n - np.diff(bounds)
    out = []
    for c in np.flatnonzero(alone < prefix_size(n)):
        part = slice(bounds[c], bounds[c + 1])
        out.append((names[16 * c : 16 * c + 16], int(n[c]), tokens[part].tobytes(), df[part].tobytes()))
    return pd.DataFrame(out, columns=["cls", "n", "tokens", "df"])


def partners(docs: DataFrame, total: int, text: str = "text") -> DataFrame:
    """(cls, n, packs, tokens, df) of the classes that share a prefix shingle with another class.

    ``tokens`` are the class's shingles that were counted more than once, sorted, and ``df`` their
    counts. A class that several packs hold is counted in each: where ``df`` equals ``packs`` the
    shingle is the class's own. Counts order the shingles, so they are left as they are, alike in
    all classes.
    """
    bits = min(24, max(LEAST_BITS, int(np.ceil(np.log2(max(1, total / BUCKET))))))
    shared = (
        _postings(docs, bits, text)
        .groupBy("bucket")
        .applyInPandas(
            lambda rows: _count(rows, bits), "pack long, names binary, tokens binary, of binary, df binary"
        )
        .groupBy("pack")
        .applyInPandas(_regroup, "cls binary, n long, tokens binary, df binary")
        .groupBy("cls")
        .agg(
            F.count("*").alias("packs"),
            F.first("n").alias("n"),
            F.first("tokens").alias("tokens"),
            F.first("df").alias("df"),
        )
        .select("cls", "n", "packs", "tokens", "df")
    )

    def with_partner(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for n, packs, tokens, df in batch[["n", "packs", "tokens", "df"]].itertuples(index=False):
                df = np.frombuffer(df, dtype="<u4")
                order = _order(np.frombuffer(tokens, dtype="<u8"), df, 0)
                room = int(prefix_size(np.int64(n))) - (n - len(df))
                keep.append(bool((df[order[:room]] > packs).any()) if room > 0 else False)
            yield batch[np.array(keep, dtype=bool)]

    return shared.mapInPandas(with_partner, shared.schema)


def _order(tokens: np.ndarray, df: np.ndarray, order: int) -> np.ndarray:
    rarity = df if order == 0 else np.log2(df).astype(np.int64)
    return np.lexsort((mix(tokens, 20 + order), rarity))


def ordered(tokens: np.ndarray, df: np.ndarray, order: int) -> np.ndarray:
    """The shingles by an order. Those that were counted once come before them all."""
    return tokens[_order(tokens, df, order)]


def _entries(classes: DataFrame) -> DataFrame:
    """(token, cls, n, shared, place) for the prefixes under the first order.

    ``shared`` is the number of the class's shingles that others have, ``place`` the token's place
    among all its shingles. Shingles of the class alone take places but make no entry.
    """

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for cls, n, packs, tokens, df in batch.itertuples(index=False):
                tokens, df = np.frombuffer(tokens, dtype="<u8"), np.frombuffer(df, dtype="<u4")
                first = n - len(df)
                at = _order(tokens, df, 0)[: int(prefix_size(np.int64(n))) - first]
                place = np.flatnonzero(df[at] > packs)
                found = tokens[at[place]].view(np.int64)
                shared = int((df > packs).sum())
                rows += [(t, cls, n, shared, first + k + 1) for t, k in zip(found, place, strict=True)]
            yield pd.DataFrame(rows, columns=["token", "cls", "n", "shared", "place"])

    columns = ["cls", "n", "packs", "tokens", "df"]
    schema = "token long, cls binary, n long, shared long, place long"
    return classes.select(*columns).mapInPandas(explode, schema)


def least_overlap(n_a: int, n_b: int) -> int:
    """How many shingles two sets of these sizes must share to link."""
    return -(-PERCENT * (n_a + n_b) // (100 + PERCENT))


def _may_link(b: str) -> str:
    """SQL: the size filter, and the prefix filter with the place of the token in both classes."""
    least = f"ceil({PERCENT} * (n + {b}n) / {100 + PERCENT})"
    return (
        f"100 * least(n, {b}n) >= {PERCENT} * greatest(n, {b}n) and least(shared, {b}shared) >= {least}"
        f" and place <= n - {least} + 1 and {b}place <= {b}n - {least} + 1"
    )


def linked(n_a: int, tokens_a: bytes, df_a: bytes, n_b: int, tokens_b: bytes, df_b: bytes) -> bool:
    """Whether two classes link: filters of all further orders first, then the overlap."""
    a, b = np.frombuffer(tokens_a, dtype="<u8"), np.frombuffer(tokens_b, dtype="<u8")
    rare_a, rare_b = np.frombuffer(df_a, dtype="<u4"), np.frombuffer(df_b, dtype="<u4")
    least = least_overlap(n_a, n_b)
    room_a, room_b = len(a) - least + 1, len(b) - least + 1
    if room_a < 1 or room_b < 1:
        return False
    for order in range(1, ORDERS):
        first = (ordered(a, rare_a, order)[:room_a], ordered(b, rare_b, order)[:room_b])
        if not len(np.intersect1d(*first, assume_unique=True)):
            return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. Pairs of one ``a`` are dealt out in groups of bounded size."""
    total = pairs.count()
    sizes = pairs.groupBy("a").agg(F.count("*").alias("pairs"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("pairs") / LEADER_ROWS).cast("int"))
    dealt = lookup(pairs, sizes, ["a"], "pairs", total).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    )
    names = {c: F.col(c).alias(f"{c}_a") for c in ("n", "tokens", "df")}
    leaders = (
        classes.withColumnRenamed("cls", "a")
        .join(sizes, "a")
        .select("a", *names.values(), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["n_a", "tokens_a", "df_a", "n", "tokens", "df"]
        for batch in batches:
            if len(batch):
                yes = [linked(*row) for row in batch[columns].itertuples(index=False)]
                yield batch.loc[np.array(yes, dtype=bool), ["a", "b"]]

    return (
        dealt.join(leaders.hint("shuffle_merge"), ["a", "part"])
        .join(classes.withColumnRenamed("cls", "b").hint("shuffle_merge"), "b")
        .mapInPandas(check, "a binary, b binary")
    )


def _labelled(entries: DataFrame, links: DataFrame | None) -> DataFrame:
    """Prefix entries with the component of their class; tokens of one component are left out."""
    if links is None:
        return entries.withColumn("root", F.col("cls"))
    roots = components(links)
    rows = entries.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls")
    )
    return _mixed(stored(rows, "labelled"))


def _mixed(rows: DataFrame) -> DataFrame:
    held = rows.groupBy("token").agg(
        F.count("*").alias("held"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    total = rows.count()
    return stored(
        lookup(rows, held, ["token"], "held", total).where("low <> high").drop("held", "low", "high"),
        "mixed",
    )


def _led(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of a leader and the classes of other components that share its shingle."""
    own = F.expr("(n - shared) / n") if turn == 0 else F.lit(0.0)
    rank = F.struct(
        own.alias("own"), F.xxhash64("root", F.lit(turn)).alias("h"), "root", "cls", "n", "shared", "place"
    )
    leads = rows.groupBy("token").agg(F.count("*").alias("held"), F.min(rank).alias("lead"))
    found = lookup(rows, leads, ["token"], "held", rows.count())
    return (
        found.where("root <> lead.root and " + _may_link("lead."))
        .select(F.col("lead.cls").alias("a"), F.col("cls").alias("b"))
        .distinct()
    )


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of classes of different components that share a shingle.

    Every such pair has a class outside the token's largest component, so only those are held
    against the token's list.
    """
    by_root = rows.groupBy("token", "root").agg(F.count("*").alias("m"))
    most = by_root.groupBy("token").agg(
        F.sum("m").alias("held"), F.max(F.struct("m", "root")).getField("root").alias("most")
    )
    outside = lookup(rows, most, ["token"], "held", rows.count()).where("root <> most")
    names = {c: f"b_{c}" for c in rows.columns if c != "token"}
    other = rows.withColumnsRenamed(names)
    return (
        outside.join(other, "token")
        .where("root <> b_root and " + _may_link("b_"))
        .select(F.least("cls", "b_cls").alias("a"), F.greatest("cls", "b_cls").alias("b"))
        .distinct()
    )


def _pairs_across(rows: DataFrame) -> tuple[int, int]:
    """Number of entries, and of pairs of entries that ``_across`` would form."""
    by_root = rows.groupBy("token", "root").agg(F.count("*").alias("m"))
    held = by_root.groupBy("token").agg(F.sum("m").alias("s"), F.max("m").alias("most"))
    found = held.agg(F.sum("s"), F.sum(F.expr("cast(s - most as double) * s"))).first()
    return int(found[0] or 0), int(found[1] or 0)


def class_links(classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between classes that connect exactly what all links connect."""
    entries = stored(_entries(classes), "entries")
    links: DataFrame | None = None
    rows = _mixed(entries.withColumn("root", F.col("cls")))
    before, turn = float("inf"), 0
    while True:
        held, across = _pairs_across(rows)
        if across <= REST * held or across > (1 - GAIN) * before:
            break
        found = stored(_verified(stored(_led(rows, turn), "led"), classes), "links")
        links = found if links is None else links.unionByName(found)
        rows = _labelled(entries, links)
        before, turn = across, turn + 1
    if rows.limit(1).count():
        found = stored(_verified(stored(_across(rows), "across"), classes), "links")
        links = found if links is None else links.unionByName(found)
    return links


def _with_components(docs: DataFrame, text: str, doc_id: str, carried: Column | None = None) -> DataFrame:
    """(doc_id, n, carried, root, component_id) for every row; ``root`` is null without shingles.

    Components of rows that repeat an id may have the same ``component_id``, but never the same root.
    """
    rows = stored(shingled(docs, text, doc_id, carried), "shingled")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    classes = stored(partners(docs, total, text), "classes")
    links = class_links(classes)
    own = rows.where("cls is not null").groupBy("cls").agg(
        F.count("*").alias("held"), F.min("doc_id").alias("least")
    )
    if links is not None:
        own = own.join(components(links).withColumnRenamed("node", "cls"), "cls", "left")
    else:
        own = own.withColumn("root", F.lit(None).cast("binary"))
    own = stored(own.withColumn("root", F.coalesce("root", "cls")), "own")
    named = own.groupBy("root").agg(
        F.count("*").alias("classes"), F.min("least").alias("component_id")
    )
    ids = lookup(own, named, ["root"], "classes", own.count()).select("cls", "held", "root", "component_id")
    found = lookup(rows.where("cls is not null"), ids, ["cls"], "held", rows.count())
    return found.select("doc_id", "n", "carried", "root", "component_id").unionByName(
        rows.where("cls is null").select(
            "doc_id", "n", "carried", F.col("cls").alias("root"), F.col("doc_id").alias("component_id")
        )
    )


def ngram_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    found = _with_components(docs, text, doc_id)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id.

    If that id has several texts in the component, the one with the smallest SHA-256 stays. A component
    of rows without an id keeps the one with the smallest SHA-256, and rows without an id leave for those
    that have one. Rows that repeat id and text stay once; rows without shingles all stay, of those
    without an id every copy.
    """

    def sha(of: Column) -> Column:
        return F.sha2(whole_text(of), 256)

    def keyed(rows: DataFrame, number: Column, digest: Column) -> DataFrame:
        none, some = number.isNull().alias("__none"), F.coalesce(number, F.lit(0)).alias("__of")
        return rows.select("*", none, some, digest.alias("__sha"))

    keys = ["__none", "__of", "__sha"]
    found = _with_components(docs, text, doc_id, sha(F.col(text))).where("doc_id <=> component_id")
    stays = (
        found.where("root is not null")
        .groupBy("root")
        .agg(F.first("doc_id").alias("doc_id"), F.min("carried").alias("carried"))
        .select("doc_id", "carried")
        .unionByName(found.where("root is null and doc_id is not null").select("doc_id", "carried"))
    )
    ids = keyed(stays, F.col("doc_id"), F.col("carried")).select(*keys)
    unknown = found.where("root is null and doc_id is null").select(F.col("carried").alias("__sha")).distinct()
    given = docs.select(F.struct("*").alias("__row"), F.col(doc_id).cast("long").alias("__id"))
    rows = keyed(given, F.col("__id"), sha(F.col(f"__row.{text}")))
    once = rows.groupBy(*keys, F.col(f"__row.{text}").isNull().alias("__empty")).agg(
        F.first("__row").alias("__row")
    )
    kept = once.join(ids, keys, "left_semi")
    alone = rows.where("__none").join(unknown, "__sha", "left_semi")
    return kept.select("__row.*").unionByName(alone.select("__row.*"))
