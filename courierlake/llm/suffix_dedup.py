"""Removal of long repeated byte strings with suffix arrays by shard.

Every byte that is covered by a string of ``LENGTH`` bytes which also starts anywhere else, in the same
document or another, is removed. Strings are judged on the input.

1. *Records.* A window (a string of ``LENGTH`` bytes) is owned by its anchor: of the ``ANCHOR``-byte
   strings inside it the one with the smallest hash, leftmost first. Equal windows have equal anchors
   at equal places, wherever they are. Neighbouring windows with one anchor make a record: about one
   for 170 bytes, with a hash of the anchor and one of the record's whole stretch of text.
2. *Equal stretches.* Records with the same stretch in two places are repeated as a whole; counting
   them needs no text. An anchor that occurs once rules its record's windows out, which is nearly all
   text. What is left are anchors with different stretches, some of them seen once: text around the
   borders of copied passages. Only these records' stretches are fetched, one for each.
3. *Suffix arrays.* All stretches of an anchor go to one shard of bounded size. A shard sorts the
   suffixes of its stretches, a few anchors at a time, by Larsson-Sadakane refinement in numpy: ranks by 7 bytes,
   doubled as long as groups are unsorted, groups of one left alone. Kasai's common prefixes of neighbours, for all
   stretches in step, tell which windows occur twice.
4. *Cross-shard merge.* An anchor with more stretches than a shard holds is spread over several. They
   exchange one digest for each different window by digest range; the owner of a range finds the
   windows of other shards by binary search in the merged, sorted digests.

Texts that occur twice as a whole are removed as a whole and worked on once. Hashes of 64 bits and
more stand for equal strings in steps 1, 2 and 4.

Defined results: null text counts as empty; texts under ``LENGTH`` bytes lose nothing; repeated rows
are copies like any others; null ids pass through; an empty table gives no row; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import lookup, stored, whole_text
from courierlake.llm.words import mix

LENGTH = 400
ANCHOR = 64
#: Bytes of text that are worked on at once; longer texts are worked on in overlapping stretches.
CHUNK_BYTES = 1 << 19
#: Bytes of stretches in a shard, about.
SHARD_BYTES = 2 << 20
#: Bytes of stretches whose suffixes are sorted at once, about; one anchor's are sorted together.
SORT_BYTES = 1 << 19

_PLACE_BITS = np.uint64(20)
_BASE = 0xD1342543DE82EF95
_BYTES = mix(np.arange(1, 257, dtype=np.uint64), 5)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, np.uint64(_BASE)), np.full(size, np.uint64(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


class Hashes:
    """Hashes of any substrings of some bytes, by sums of powers."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[: len(raw)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts], seed)

    def all_of(self, size: int, seed: int) -> np.ndarray:
        n = len(self.total) - size
        return mix((self.total[size:] - self.total[:n]) * self.down[:n], seed)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _chunk_records(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor's hash, stretch's hash) of the records of a chunk."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    if len(raw) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = Hashes(raw)
    anchors = hashes.all_of(ANCHOR, 6)
    place = np.arange(len(anchors), dtype=np.uint64)
    least = _sliding_least((anchors >> _PLACE_BITS << _PLACE_BITS) | place, LENGTH - ANCHOR + 1)
    at = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(at)), side="right")
    inside = np.flatnonzero(np.arange(len(at)) + LENGTH <= ends[text])
    if not len(inside):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    new = np.concatenate(
        [[True], (at[inside[1:]] != at[inside[:-1]]) | (text[inside[1:]] != text[inside[:-1]])]
    )
    first = inside[new]
    last = inside[np.concatenate([new[1:], [True]])]
    of = text[first]
    starts = ends[of] - np.array([len(t) for t in texts])[of]
    stretch = hashes.of(first, last + LENGTH, 7) ^ mix((at[first] - first).astype(np.uint64), 8)
    return of, first - starts, last - starts, anchors[at[first]], stretch


def records(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Records of whole texts; the first array holds the texts' indexes."""
    held: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        if len(text) > CHUNK_BYTES:
            for start in range(0, len(text) - LENGTH + 1, CHUNK_BYTES):
                of, first, last, *rest = _chunk_records([text[start : start + CHUNK_BYTES + LENGTH - 1]])
                yield np.full(len(of), k), first + start, last + start, *rest
        elif len(text) >= LENGTH:
            held.append(k)
            size += len(text)
        if size > CHUNK_BYTES or (held and k == len(texts) - 1):
            of, *rest = _chunk_records([texts[i] for i in held])
            yield np.array(held)[of], *rest
            held, size = [], 0
    if held:
        of, *rest = _chunk_records([texts[i] for i in held])
        yield np.array(held)[of], *rest


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of each different text that a task meets."""
    seen: set[bytes] = set()
    for batch in batches:
        new = [k for k, name in enumerate(batch["name"]) if not (name in seen or seen.add(name))]
        texts = [batch["text"].iloc[k].encode() for k in new]
        names, ids = batch["name"].to_numpy()[new], batch["doc_id"].astype("Int64").iloc[new]
        for of, first, last, anchor, stretch in records(texts):
            name = np.array([int.from_bytes(names[k][:8], "little") for k in range(len(new))], np.uint64)
            spot = mix(name[of] + mix(first.astype(np.uint64), 9), 10)
            yield pd.DataFrame(
                {
                    "doc_id": ids.iloc[of].array,
                    "name": names[of],
                    "anchor": anchor.view(np.int64),
                    "stretch": stretch.view(np.int64),
                    "first": first,
                    "last": last,
                    "spot": spot.view(np.int64),
                }
            )


def refine(text: np.ndarray) -> np.ndarray:
    """The suffix array by Larsson-Sadakane refinement; ``text`` holds numbers below 512.

    Suffixes are sorted to the end, not only to the length asked for: the bound on the next common
    prefix, which Kasai's method rests on, holds in a full order only. Places have 32 bits.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint16), np.zeros(8, np.uint16)])
    word = np.zeros(n, np.uint64)
    for k in range(7):  # seven numbers of nine bits
        word <<= np.uint64(9)
        word |= padded[k : n + k]
    order = np.argsort(word, kind="stable").astype(np.int32)
    word = word[order]
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])).astype(np.int32)
    del word
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    step = 7
    while step < n:
        # Groups are runs of equal rank; a group of one is sorted and is left alone.
        here = rank[order]
        same = here[1:] == here[:-1]
        loose = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]])).astype(np.int32)
        if not len(loose):
            break
        members = order[loose]
        key = here[loose].astype(np.uint64)
        key <<= np.uint64(32)
        key |= (rank[np.minimum(members + step, n)] + 1).astype(np.uint64)
        by = np.argsort(key, kind="stable").astype(np.int32)
        members, key = members[by], key[by]
        order[loose] = members
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        rank[members] = np.repeat(loose[begin], np.diff(np.append(begin, len(loose))))
        step *= 2
    return order


def common_prefixes(
    raw: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int
) -> np.ndarray:
    """Kasai's common prefix of each suffix with its predecessor, up to ``most``.

    Stretches advance in step: each loses at most one byte of its prefix from a place to the next.
    Only the first ``sizes`` places of each stretch are needed.
    """
    before = np.full(len(raw), -1, np.int32)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([raw, np.zeros(most + 8, raw.dtype)])
    out = np.zeros(len(raw), np.int32)
    length = np.zeros(len(starts), np.int64)
    block = 16
    reach = np.arange(block)
    for k in range(int(sizes.max(initial=0))):
        live = np.flatnonzero((sizes > k) & (before[np.minimum(starts + k, len(raw) - 1)] >= 0))
        rest = np.flatnonzero(sizes > k)
        length[rest] = np.maximum(length[rest] - 1, 0)
        length[np.setdiff1d(rest, live, assume_unique=True)] = 0
        here, other = starts[live] + k, before[starts[live] + k]
        go = np.arange(len(live))
        while len(go):
            at = length[live[go]][:, None] + reach
            equal = padded[here[go][:, None] + at] == padded[np.minimum(other[go][:, None] + at, len(padded) - 1)]
            gain = np.where(equal.all(1), block, equal.argmin(1))
            length[live[go]] = np.minimum(length[live[go]] + gain, most)
            go = go[(gain == block) & (length[live[go]] < most)]
        out[here] = length[live]
    return out


def repeated_windows(stretches: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each stretch which windows occur twice; and all windows' places and classes."""
    sizes = np.array([len(s) - LENGTH + 1 for s in stretches])
    starts = np.cumsum([0] + [len(s) + 1 for s in stretches[:-1]])
    raw = np.zeros(sum(map(len, stretches)) + len(stretches), np.uint16)
    for start, s in zip(starts, stretches, strict=True):
        raw[start : start + len(s)] = np.frombuffer(s, np.uint8).astype(np.uint16) + 1
    order = refine(raw)
    prefix = common_prefixes(raw, order, starts, sizes, LENGTH)
    long = prefix[order] >= LENGTH  # this suffix and the one before it
    twice = np.zeros(len(raw), bool)
    twice[order] = long | np.append(long[1:], False)
    window = np.zeros(len(raw), bool)
    for start, size in zip(starts, sizes, strict=True):
        window[start : start + size] = True
    heads = order[~long & window[order]]
    return [twice[a : a + n] for a, n in zip(starts, sizes, strict=True)], heads, starts


def _spans(rows: pd.DataFrame, flags: list[np.ndarray]) -> list[tuple]:
    """(name, start, end) for the runs of repeated windows of the open rows."""
    out = []
    for name, first, closed, twice in zip(rows["name"], rows["first"], rows["closed"], flags, strict=True):
        if not closed and twice.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
            out += [(name, first + a, first + b - 1 + LENGTH) for a, b in edges.reshape(-1, 2)]
    return out


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates(["anchor", "stretch"]).sort_values("anchor", kind="stable")
    # Equal windows have one anchor, so anchors are worked on apart: memory follows SORT_BYTES, not the shard.
    sizes = rows["bytes"].map(len)
    begin = (sizes.cumsum() - sizes).groupby(rows["anchor"]).transform("min")
    out = []
    for _, some in rows.groupby(begin // SORT_BYTES):
        flags, _, _ = repeated_windows(some["bytes"].to_list())
        out += _spans(some, flags)
    return pd.DataFrame(out, columns=["name", "start", "end"])


def _part(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one part of a large anchor: its spans, and its windows' digests by range."""
    rows = rows.drop_duplicates(["anchor", "stretch"]).reset_index(drop=True)
    stretches = rows["bytes"].to_list()
    flags, heads, starts = repeated_windows(stretches)
    out = [(0, 0, 0, n, a, b, None, None) for n, a, b in _spans(rows, flags)]
    of = np.searchsorted(starts, heads, side="right") - 1
    at = heads - starts[of]
    digest = np.zeros(len(heads), np.uint64)
    by = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[by], np.arange(len(rows) + 1))
    for k in range(len(rows)):
        own = by[bounds[k] : bounds[k + 1]]
        if len(own):
            hashes = Hashes(np.frombuffer(stretches[k], np.uint8))
            digest[own] = hashes.of(at[own], at[own] + LENGTH, 13)
    # Windows of open rows that are alone here wait for other parts; the rest are known already.
    alone = np.array([not rows["closed"].iloc[k] and not flags[k][a] for k, a in zip(of, at, strict=True)], bool)
    order = np.argsort(digest)
    ranges = int(rows["parts"].iloc[0])
    owner = (digest[order] >> np.uint64(32)).astype(np.int64) * ranges >> 32
    bounds = np.searchsorted(owner, np.arange(ranges + 1))
    anchor, part = int(rows["anchor"].iloc[0]), int(rows["part"].iloc[0])
    names = rows["name"].to_numpy()
    for r in range(ranges):
        own = order[bounds[r] : bounds[r + 1]]
        if len(own):
            refs = [
                (names[of[k]], int(rows["first"].iloc[of[k]]) + int(at[k])) if alone[k] else (b"", -1) for k in own
            ]
            data = digest[own].tobytes()
            spots = np.array([s for _, s in refs], "<i8").tobytes()
            out.append((anchor, r, part, None, 0, 0, data, b"".join(n.ljust(16, b"\0") for n, _ in refs) + spots))
    columns = ["anchor", "range", "part", "name", "start", "end", "digests", "refs"]
    return pd.DataFrame(out, columns=columns)


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one range: windows that another part has, by binary search in the merged digests."""
    lists = [np.frombuffer(d, "<u8") for d in rows["digests"]]
    merged = np.sort(np.concatenate(lists))
    out = []
    for own, refs in zip(lists, rows["refs"], strict=True):
        many = np.searchsorted(merged, own, "right") - np.searchsorted(merged, own, "left") > 1
        spots = np.frombuffer(refs[16 * len(own) :], "<i8")
        for k in np.flatnonzero(many & (spots >= 0)):
            out.append((refs[16 * k : 16 * k + 16], int(spots[k]), int(spots[k]) + LENGTH))
    return pd.DataFrame(out, columns=["name", "start", "end"])


def _repeats(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans, candidates): repeated spans (name, start, end), and the texts that may hold some."""
    found = stored(texts.mapInPandas(_find, "doc_id long, name binary, anchor long, stretch long, first long, last long, spot long"), "records")
    total = found.count()
    kinds = stored(
        found.groupBy("anchor", "stretch").agg(
            F.count("*").alias("held"),
            F.min("spot").alias("spot_of"),
            (F.min("spot") != F.max("spot")).alias("closed"),
        ),
        "kinds",
    )
    anchors = kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.max(~F.col("closed")).alias("open")
    )
    mixed = lookup(
        kinds, anchors.where("kinds > 1 and open"), ["anchor"], "kinds", kinds.count()
    ).withColumn("mixed", F.lit(True)).drop("open")
    # What is neither repeated as a whole nor has company at its anchor ends here.
    wanted = stored(
        mixed.unionByName(
            kinds.where("closed").select("*", F.lit(0).cast("long").alias("kinds"), F.lit(False).alias("mixed"))
        ),
        "wanted",
    )
    flags = wanted.groupBy("anchor", "stretch").agg(
        F.max("held").alias("held"), F.max("kinds").alias("kinds"), F.max("mixed").alias("mixed"),
        F.max("closed").alias("closed"), F.max("spot_of").alias("spot_of"),
    )
    kept = stored(lookup(found, flags, ["anchor", "stretch"], "held", total), "kept")
    whole = kept.where("closed").select("name", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    spots = kept.groupBy("doc_id", "name").agg(
        F.collect_list(
            F.when(
                F.col("mixed") & (F.col("spot") == F.col("spot_of")),
                F.struct("anchor", "stretch", "first", "last", "closed", "kinds"),
            )
        ).alias("spots")
    )
    rows = texts.withColumn("__id", F.coalesce("doc_id", F.lit(0)))
    candidates = stored(
        rows.join(spots.withColumn("__id", F.coalesce("doc_id", F.lit(0))).drop("doc_id"), ["__id", "name"]).drop("__id"),
        "candidates",
    )

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, text, spots in zip(batch["name"], batch["text"], batch["spots"], strict=True):
                if len(spots):
                    data = text.encode()
                    for s in spots:
                        piece = data[s["first"] : s["last"] + LENGTH]
                        out.append((name, s["anchor"], s["stretch"], s["first"], s["closed"], s["kinds"], piece))
            columns = ["name", "anchor", "stretch", "first", "closed", "kinds", "bytes"]
            yield pd.DataFrame(out, columns=columns)

    schema = "name binary, anchor long, stretch long, first long, closed boolean, kinds long, bytes binary"
    stretches = candidates.select("name", "text", "spots").mapInPandas(fetch, schema)
    size = kept.where("mixed and spot = spot_of").agg(F.sum(F.col("last") - F.col("first") + LENGTH)).first()[0] or 0
    shards = max(8, -(-int(size) // SHARD_BYTES))
    per_shard = SHARD_BYTES // (LENGTH + 170)
    parts = F.ceil(F.col("kinds") / per_shard).cast("int")
    dealt = stored(
        stretches.withColumn("parts", parts)
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .withColumn("part", F.pmod(F.xxhash64("stretch"), F.col("parts")).cast("int")),
        "stretches",
    )
    span = "name binary, start long, end long"
    alone = dealt.where("parts = 1").groupBy("shard").applyInPandas(_shard, span)
    spread = stored(
        dealt.where("parts > 1")
        .groupBy("anchor", "part")
        .applyInPandas(
            _part, "anchor long, range int, part int, name binary, start long, end long, digests binary, refs binary"
        ),
        "parts",
    )
    across = spread.where("digests is not null").groupBy("anchor", "range").applyInPandas(_merge, span)
    spans = whole.unionByName(alone).unionByName(
        spread.where("digests is null").select("name", "start", "end")
    ).unionByName(across)
    return stored(spans, "spans"), candidates


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for name, text, spans in zip(batch["name"], batch["text"], batch["spans"], strict=True):
            data, runs = text.encode(), merged([(s["start"], s["end"]) for s in spans])
            kept, at = [], 0
            for a, b in runs:
                kept.append(data[at:a])
                at = b
            rest = b"".join(kept) + data[at:]
            out.append((name, len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
        yield pd.DataFrame(out, columns=["name", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(F.col(text)).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256)).withColumn(
        "name", F.unhex(F.substring("sha", 1, 32))
    )
    rows = stored(texts.select("doc_id", "name", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "rows")
    long_texts = texts.where(F.octet_length("text") >= LENGTH).select("doc_id", "name", "text")
    spans, candidates = _repeats(long_texts)
    copies = rows.groupBy("name").agg(F.count("*").alias("held"), F.max("n_bytes").alias("n_bytes"))
    single = copies.where("held = 1").select("name")
    by_name = (
        spans.join(single, "name", "left_semi")
        .distinct()
        .groupBy("name")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    cut = (
        candidates.select("name", "text")
        .join(by_name, "name")
        .mapInPandas(_cut, "name binary, n_removed long, n_spans long, kept_sha256 string")
        .withColumn("held", F.lit(1).cast("long"))
    )
    whole = copies.where(f"held > 1 and n_bytes >= {LENGTH}").select(
        "name",
        F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"),
        "held",
    )
    changed = stored(cut.unionByName(whole), "changed")
    hit = lookup(rows, changed, ["name"], "held", rows.count()).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    hot = F.broadcast(changed.where("held > 1000").select("name"))
    left = rows.join(hot, "name", "left_anti").join(changed.select("name"), "name", "left_anti")
    return hit.unionByName(
        left.select(
            "doc_id",
            "n_bytes",
            F.lit(0).cast("long").alias("n_removed"),
            F.lit(0).cast("long").alias("n_spans"),
            F.col("sha").alias("kept_sha256"),
        )
    )
