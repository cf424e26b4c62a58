"""The manifest, the mixture and the filter audit against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from courierlake.llm import filter_audit, merkle, mixing
from courierlake.llm.prefix import sums_before

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def table(spark):
    """``table([(doc_id, text, lang, source, n_chars), ...])``, with columns of clashing names."""

    def make(rows):
        extra = "tree idx size before key target failed part n path __row __slice hash".split()
        return spark.createDataFrame(rows, SCHEMA).selectExpr("*", *(f"'x' as `{c}`" for c in extra))

    return make


# --- running sums --------------------------------------------------------------------


def test_sums_of_equal_rows_spread_over_slices(spark):
    rows = [(None, 1, 2)] * 300 + [("a", k % 7, k) for k in range(200)] + [("b", 1, 1)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(3)
    got = sums_before(df, ["g"], [F.col("o").asc()], {"pos": F.lit(1), "sum": F.col("v")}).collect()
    for g in (None, "a", "b"):
        own = sorted((r.pos, r.sum, r.o, r.v) for r in got if r.g == g)
        assert [p for p, *_ in own] == list(range(len(own)))
        assert [o for *_, o, _ in own] == sorted(o for *_, o, _ in own)
        total = 0
        for _, before, _, v in own:
            assert before == total
            total += v


# --- manifest ------------------------------------------------------------------------


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    texts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return H(*texts)


def tree(nodes):
    """All levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H(*at[k : k + 2]) for k in range(0, len(at), 2)])
    return levels


def manifest_brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {
        x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        for x in langs
    }
    trees = {x: tree([leaf(*r) for r in own[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for k, r in enumerate(own[x]):
            i, _, lang, source, n = r
            changed = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
            folded, siblings = leaf(i, r[1], lang, source, n + 1) if changed else leaf(*r), []
            for levels, at in ((trees[x], k), (top, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1 : (at ^ 1) + 1]
                    folded = H(*other, folded) if at & 1 else H(folded, *other)
                    siblings += other
                    at >>= 1
            root = top[-1][0]
            out.append((i, leaf(*r), trees[x][-1][0], root, H(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CORNERS = (
    [(i, f"text {i}", "en", "a", i) for i in range(21)]
    + [(i, f"texte {i}", "fr", None, None) for i in range(30, 38)]
    + [(50, "allein", "de", "b", 6)]
    + [(60, "", None, "b", 0), (None, None, None, None, None), (None, "x", "en", "a", 1)]
    + [(7, "text 7", "en", "a", 7)] * 3  # repeated rows
    + [(7, "another text of the id", "en", "a", 7), (70, "é ü 漢字", "", "", 2**62), (-3, "z " * 200_000, "en", "c", 5)]
)


@pytest.mark.parametrize("link", [1, 2, 3, merkle.LINK])
def test_manifest_equals_brute_force(table, link):
    df = merkle.manifest_digests(table(CORNERS), link)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert manifest_rows(df) == manifest_brute(CORNERS)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 33])
def test_manifest_of_every_shape(table, n):
    rows = [(i, str(i), "en", "a", i) for i in range(n)]
    assert manifest_rows(merkle.manifest_digests(table(rows), 2)) == manifest_brute(rows)


def test_manifest_over_several_links(spark, table):
    rows = [(i, str(i), "en" if i % 3 else None, "a", i) for i in range(1500)]
    got = manifest_rows(merkle.manifest_digests(table(rows), 4))
    assert got == manifest_brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_no_limit_on_the_rows_of_the_recursion(spark, table):
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        rows = [(i, str(i), "en", "a", i) for i in range(300)]
        assert merkle.manifest_digests(table(rows), 2).count() == 300
        assert spark.conf.get(key) == "100"  # the session's own limit stands again
    finally:
        spark.conf.set(key, before)


def test_manifest_of_nothing(table):
    assert merkle.manifest_digests(table([])).collect() == []


def test_manifest_stores_linked_nodes(table):
    manifest = merkle.build(merkle.leaves(table([(i, "", "en", "a", 0) for i in range(40)])), 3)
    assert manifest.leaves.count() == 40
    nodes = {(r.tree, r.level, r.idx): r for r in manifest.nodes.collect()}
    assert sorted(k for k in nodes if k[0] != merkle.TOP) == [(0, 3, k) for k in range(5)]
    for r in [*manifest.leaves.collect(), *nodes.values()]:
        if r.up_tree is not None:
            assert nodes[r.up_tree, r.up_level, r.up_idx].hash == r.up_hash
    siblings = merkle.proofs(manifest).where("doc_id = 39").first().siblings
    assert len(siblings) == 4  # 39 is the last of 40: alone twice, on levels of five and three nodes


# --- mixture -------------------------------------------------------------------------


def targets(sizes: dict, epochs=3, weights=3) -> dict:
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % weights + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        shares = sum(weight[s] for s in sizes if s not in capped)
        got = {s: epochs * sizes[s] if s in capped else left * weight[s] / shares for s in sizes}
        above = {s for s in sizes if s not in capped and got[s] > epochs * sizes[s]}
        if not above:
            return got
        capped |= above


def mix_brute(rows):
    """(doc_id, size, source_size, target, taken), word by word."""
    docs = [(r[0], r[3], len(WORDS.findall(r[1] or ""))) for r in rows]
    sizes = {s: sum(n for _, x, n in docs if x == s) for s in {x for _, x, _ in docs}}
    out = []
    for source, target in targets(sizes).items():

        def key(d):
            number = "mix" if d[0] is None else f"mix:{d[0]}"
            return hashlib.md5(number.encode()).hexdigest(), d[0] is not None, d[0] or 0, d[2]

        own = sorted((d for d in docs if d[1] == source), key=key)
        taken, left = [0] * len(own), math.floor(target)
        while left and sizes[source]:
            for k, (_, _, n) in enumerate(own):
                taken[k] += min(n, left)
                left -= min(n, left)
        out += [(i, n, sizes[source], target, t) for (i, _, n), t in zip(own, taken, strict=True)]
    return sorted(out, key=repr)


def mix_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check_mix(df, rows):
    got, want = mix_rows(df), mix_brute(rows)
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-12) for g, w in zip(got, want, strict=True))
    assert all(g[4] <= 3 * g[1] for g in got)


MIXED = (
    [(i, "w " * (i % 13), "en", "a", 0) for i in range(400)]  # a third and more of all rows
    + [(1000 + i, "x\ty\x0bz " * (i % 5 + 1), "en", "b", 0) for i in range(60)]
    + [(2000 + i, "é\x85ü w\n\n", "en", "c", 0) for i in range(9)]  # far below its share
    + [(3000, "one two", "en", None, 0), (None, "three four five", "en", None, 0), (3001, None, "en", "", 0)]
    + [(5, "w " * 5, "en", "a", 0)] * 40
    + [(4000, "long " * 100_000, "en", "d", 0), (4001, "", "en", "d", 0)]
)


def test_mix_equals_brute_force(table):
    check_mix(mixing.mix(table(MIXED)), MIXED)


def test_sources_below_their_share_are_repeated_three_times(table):
    rows = [(k, "w " * 100, "en", "a", 0) for k in range(30)] + [(100, "u v", "en", "b", 0), (101, "t", "en", "c", 0)]
    got = {r.doc_id: r for r in mixing.mix(table(rows)).collect()}
    assert (got[100].target, got[100].taken, got[101].taken) == (6.0, 6, 3)
    assert sum(r.taken for r in got.values()) == 3003
    check_mix(mixing.mix(table(rows)), rows)


def test_mix_of_one_source_nothing_and_no_words(table):
    one = [(k, "a b c", "en", None, 0) for k in range(5)]
    check_mix(mixing.mix(table(one)), one)
    empty = [(1, None, "en", "a", 0), (2, " \n", "en", "b", 0)]
    assert mix_rows(mixing.mix(table(empty))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mix(table([])).collect() == []


def test_mix_is_the_same_in_another_layout(table):
    df = table(MIXED)
    assert mix_rows(mixing.mix(df)) == mix_rows(mixing.mix(df.repartition(7)))


def test_mixture_holds_the_words_that_are_counted(table):
    df = table(MIXED)
    taken = {}
    for r in mixing.mixture(df).collect():
        assert len(WORDS.findall(r.text)) == r.words and 1 <= r.epoch <= 3
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.words
    want = {}
    for i, _, _, _, t in mix_rows(mixing.mix(df)):
        want[i] = want.get(i, 0) + t
    assert taken == {i: t for i, t in want.items() if t}


def test_whole_tables_are_mixed_to_their_targets(sf_documents):
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    check_mix(mixing.mix(sf_documents), [tuple(r) for r in sf_documents.select(*columns).collect()])


def test_manifest_of_a_whole_table(sf_documents):
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in sf_documents.select(*columns).collect()]
    assert manifest_rows(merkle.manifest_digests(sf_documents)) == manifest_brute(rows)


# --- audit ---------------------------------------------------------------------------


def audit_brute(rows, labels):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    docs = []
    for i, text, _, source, _ in rows:
        text = text or ""
        words = WORDS.findall(text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": text in first and (i is None or i > first[text]),
        }
        good, toxic = (any(x[k] == 1 for x in labels if x[0] is not None and x[0] == i) for k in (1, 2))
        docs.append((source or "", fails, good, toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, removals, lines = [d for d in docs if d[0] == part], {f: 0 for f in "ABCDE"}, []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, kept = [d for d in left if d[1][f]], [d for d in left if not d[1][f]]
                removals[f] += len(gone)
                redundant = sum(d[1][f] for d in own) - len(gone)
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in own)
                lines.append((f, part, "".join(order), step, len(kept), len(gone), redundant, alone,
                              sum(d[2] for d in gone), sum(d[3] for d in gone)))
                left = kept
        out += [(*line[1:], removals[line[0]]) for line in lines]
    return sorted(out)


def prose(k, n):
    return " ".join(f"w{k}x{j}" for j in range(n))


AUDITED = (
    [(i, prose(i, 60), "en", "a", 0) for i in range(12)]
    + [(20 + i, prose(i, 60), "en", "b", 0) for i in range(6)]  # copies of those
    + [(40 + i, prose(0, 60) + " $", "en", "a", 0) for i in range(5)]
    + [(50, "again " * 80, "en", "b", 0), (51, "AGAIN # " * 80, "en", "", 0), (52, "CAPITALS", "en", None, 0)]
    + [(60, None, "en", "a", 0), (61, "", "en", "a", 0), (62, " \t", "en", "c", 0)]
    + [(None, prose(3, 60), "en", "a", 0), (None, "unique", "en", "a", 0), (None, "unique", "en", "c", 0)]
    + [(70, "short", "en", "a", 0)] * 3  # repeated rows
    + [(71, ("lang " * 30 + "# ") * 4000, "en", "c", 0)]
)
SOME_LABELS = [(0, 1, 0), (20, 1, 1), (40, 0, 1), (41, None, 1), (None, 1, 1), (60, 1, None), (50, 0, 0), (50, 1, 1), (70, 1, 0), (999, 1, 1)]


def audit_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_audit_equals_brute_force(spark, table):
    labels = spark.createDataFrame(SOME_LABELS, LABELS).selectExpr("*", "'x' as part", "'x' as failed")
    df = filter_audit.filter_audit(table(AUDITED), labels)
    assert df.schema.simpleString() == spark.createDataFrame([], filter_audit.AUDIT).schema.simpleString()
    assert audit_rows(df) == audit_brute(AUDITED, SOME_LABELS)


def test_audit_of_whole_tables(spark, sf, sf_documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [tuple(r) for r in sf_documents.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    known = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    assert audit_rows(filter_audit.filter_audit(sf_documents, labels)) == audit_brute(rows, known)


def test_audit_without_labels_or_documents(spark, table):
    none = spark.createDataFrame([], LABELS)
    rows = AUDITED[:6]
    assert audit_rows(filter_audit.filter_audit(table(rows), none)) == audit_brute(rows, [])
    assert filter_audit.filter_audit(table([]), none).collect() == []


def test_more_parts_than_a_batch(spark, table, monkeypatch):
    monkeypatch.setattr(filter_audit, "BATCH", 4)
    rows = [(i, prose(i % 9, 40 + i), "en", f"s{i % 11}", 0) for i in range(60)]
    none = spark.createDataFrame([], LABELS)
    assert audit_rows(filter_audit.filter_audit(table(rows), none)) == audit_brute(rows, [])
