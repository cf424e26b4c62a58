"""Exact dedup, the n-gram join, suffix arrays and seed chains against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from courierlake.llm import components as graph
from courierlake.llm import exact_dedup, ngram_join, seed_chains, suffix_dedup, words
from courierlake.llm.common import clear_stored, stored

LONG = "word " * 60_000


# --- exact dedup


def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[key].append((-len(text or ""), doc_id))
    return {
        (i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(k.encode()).hexdigest())
        for k, g in groups.items()
        for _, i in g
    }


def test_exact_dedup_equals_brute_force(sf_documents, sf_texts):
    got = [tuple(r) for r in exact_dedup.exact_dedup(sf_documents, bucket_rows=20).collect()]
    assert len(got) == len(sf_texts)
    assert set(got) == exact_brute(sf_texts.items())


def test_exact_dedup_edges(documents):
    rows = [(1, "a b"), (2, None), (3, ""), (4, " \t\n"), (5, "ab"), (6, "a  b"), (7, "é ₂"), (8, LONG)]
    got = {tuple(r) for r in exact_dedup.exact_dedup(documents(rows, "key sha rank bytes kept")).collect()}
    assert got == exact_brute(rows)
    again = exact_dedup.exact_dedup(documents([(1, "a"), (1, "a"), (None, "a"), (None, "b")])).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in again) == [
        (0, 0, 1, True),
        (0, 1, 3, False),
        (1, 1, 3, False),
        (1, 1, 3, True),
    ]
    assert exact_dedup.exact_dedup(documents([])).count() == 0


def test_exact_dedup_keeps_whole_rows(documents):
    df = documents([(1, "a"), (1, "a"), (2, "a "), (3, None), (4, "b")], "key __key kept")
    kept = exact_dedup.keep_distinct(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text, r.kept) for r in kept.collect()) == [
        (2, "a ", "x"),
        (3, None, "x"),
        (4, "b", "x"),
    ]


def test_exact_dedup_keeps_what_it_decided(documents):
    """Ids that repeat with other texts, rows without an id, and copies of one id and text."""
    rows = [(5, "A"), (7, "A"), (7, "B"), (None, "A"), (None, "C"), (None, "C"), (None, "B"), (8, "D"), (8, "D  ")]
    decided = {(r.doc_id, r.text_sha256) for r in exact_dedup.exact_dedup(documents(rows)).collect() if r.kept}
    assert len(decided) == 4
    kept = exact_dedup.keep_distinct(documents(rows).repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "C"), (5, "A"), (7, "B"), (8, "D  ")]


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    table = exact_dedup.directory(keys, 100)
    size = (
        keys.withColumn("leaf", exact_dedup._leaf("key")).join(table, "leaf").groupBy("bucket", "depth").count()
    ).collect()
    assert sum(r["count"] for r in size) == 4000
    assert max(r["count"] for r in size) <= 100
    # A bucket was only split because its parent held too many.
    assert all(r.depth > 3 for r in size)


def test_directory_keeps_a_bucket_that_cannot_split(spark):
    keys = spark.range(500).select(F.lit(5).cast("long").alias("key"))
    rows = exact_dedup.directory(keys, 100).collect()
    assert [(r.depth) for r in rows] == [exact_dedup.MAX_DEPTH]


# --- components


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    edges += [(1000, k) for k in range(1001, 1400)] + [(k, k + 1) for k in range(2000, 2040)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(n, find(n)) for n in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram join


def shingles(text):
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    holders, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        overlap = Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, n in overlap.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i)) for i in sets}


def mutated(seed, families, copies):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(families):
        base = [rnd.choice(words) for _ in range(rnd.randint(8, 80))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    return rows


def test_ngram_components_equal_brute_force(sf_documents, sf_texts):
    got = [tuple(r) for r in ngram_join.ngram_components(sf_documents).collect()]
    assert len(got) == len(sf_texts)
    assert set(got) == near_brute(sf_texts.items())


@pytest.mark.parametrize("rest", [0, 4])
def test_ngram_components_of_near_copies(documents, monkeypatch, rest):
    """Many copies around the threshold; ``rest`` 0 also makes leader rounds do what they can."""
    monkeypatch.setattr(ngram_join, "REST", rest)
    rows = mutated(7, 6, 60)
    got = {tuple(r) for r in ngram_join.ngram_components(documents(rows).repartition(7)).collect()}
    assert got == near_brute(rows)


def test_ngram_copies_in_several_packs(documents, monkeypatch):
    """Copies are counted in each pack that holds them, and must not look like other classes."""
    monkeypatch.setattr(ngram_join, "PACK", 200)
    rows = mutated(9, 5, 20)
    rows += [(1000 + k, rows[k % 10][1]) for k in range(80)]
    got = {tuple(r) for r in ngram_join.ngram_components(documents(rows).repartition(9)).collect()}
    assert got == near_brute(rows)


def test_ngram_edges(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "two one"), (7, LONG), (8, LONG + "x")]
    df = documents(rows, "cls n tokens df root a b token")
    assert {tuple(r) for r in ngram_join.ngram_components(df).collect()} == near_brute(rows)
    odd = documents([(3, "a b c"), (None, "a b c"), (3, "a b c"), (None, "z")])
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_join.ngram_components(odd).collect())
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3)]
    assert ngram_join.ngram_components(documents([])).count() == 0


def test_one_of_each_component_stays(documents):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text), (2, text + " end"), (2, text + " end"), (9, "other"), (10, None), (None, text)]
    df = documents(rows, "cls __key")
    kept = ngram_join.keep_one_of_each(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert got == [(2, text + " end"), (9, "other"), (10, None)]  # a row without an id is a copy like others


def test_rows_without_an_id_are_near_copies_too(documents):
    text, other, third = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [(None, text), (None, text), (None, text + " end"), (4, other), (None, other + " end"), (None, third)]
    rows += [(None, ""), (None, None), (None, ""), (8, ""), (None, "one"), (None, "one")]
    kept = ngram_join.keep_one_of_each(documents(rows).repartition(3)).collect()
    first = min(text, text + " end", key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    want = [(0, first), (4, other), (0, third), (0, "one"), (0, ""), (0, ""), (0, ""), (8, "")]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(want)


def thue_morse(n, turned=0):
    return "".join("ab"[(bin(k).count("1") + turned) % 2] for k in range(n))


@pytest.mark.parametrize("n", [8, 16, 32, 64, 256, 1024, 4096])
def test_words_that_polynomials_confuse(documents, n):
    a, b = thue_morse(n), thue_morse(n, 1)
    rows = [(1, f"{a} one two three four"), (2, f"{b} one two three four"), (3, f"{a.upper()} One two three FOUR")]
    assert {tuple(r) for r in ngram_join.ngram_components(documents(rows)).collect()} == near_brute(rows)


def test_long_words_across_blocks(documents, monkeypatch):
    """Words and texts longer than the blocks that are hashed at once."""
    monkeypatch.setattr(words, "CHUNK_BYTES", 64)
    tail = " ".join(f"w{k}" for k in range(200))
    rows = [(1, "x" * 500 + " " + tail), (2, "X" * 500 + "\n" + tail), (3, "x" * 501 + " " + tail), (4, "y" * 70)]
    rows += [(5, ("é" * 40 + " ") * 9), (6, ("é" * 40 + "\t") * 9 + "z")]
    assert {(i, len(s)) for (i, _), s in zip(rows, words.shingle_sets([t for _, t in rows], 5), strict=True)} == {
        (i, n) for i, n, _ in near_brute(rows)
    }


def test_one_of_each_component_stays_with_repeated_ids(documents):
    text, other, third = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    rows = [(1, text), (2, text + " end"), (2, other), (3, other + " end"), (3, third), (4, third), (4, third + " end")]
    rows += [(6, "six words that stand alone here"), (6, "SIX words that stand alone here"), (2, "")]
    kept = ngram_join.keep_one_of_each(documents(rows).repartition(3)).collect()
    six = min((t for i, t in rows if i == 6), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, text), (2, ""), (2, other), (3, third), (6, six)])


# --- suffix arrays


def cut_brute(rows, size=400):
    count = Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[k : k + size] for k in range(len(data) - size + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for k in range(len(data) - size + 1):
            if count[data[k : k + size]] > 1:
                cover[k] += 1
                cover[k + size] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(gone) else 0
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(df):
    return sorted((tuple(r) for r in suffix_dedup.suffix_dedup(df).collect()), key=str)


def test_suffix_array_is_sorted():
    rnd = random.Random(1)
    for alphabet in ("a", "ab", "abcdefgh"):
        text = np.array([ord(rnd.choice(alphabet)) for _ in range(500)], np.uint16)
        order = suffix_dedup.refine(text)
        suffixes = [text[k:].tobytes()[::2] for k in range(len(text))]
        assert order.tolist() == sorted(range(len(text)), key=lambda k: suffixes[k])
        prefix = suffix_dedup.common_prefixes(text, order, np.array([0]), np.array([len(text)]), 50)
        for a, b in zip(order[:-1], order[1:], strict=True):
            x, y = suffixes[a], suffixes[b]
            n = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert prefix[b] == min(n, 50) or min(len(x), len(y)) < 50


def test_suffix_dedup_equals_brute_force(sf_documents, sf_texts):
    assert suffix_rows(sf_documents) == cut_brute(sf_texts.items())


def passages(seed):
    rnd = random.Random(seed)

    def prose(n):
        return "".join(rnd.choice("abcdefghij é") for _ in range(n))

    shared = [prose(n) for n in (380, 420, 700, 1500)]
    rows = []
    for k in range(60):
        parts = [prose(rnd.randint(0, 900))]
        for p in rnd.sample(shared, rnd.randint(0, 2)):
            a = rnd.randint(0, 100)
            parts += [p[a:], prose(rnd.randint(0, 300))]
        rows.append((k, "".join(parts)))
    return rows + [(100, "xy" * 700), (101, "yx" * 500), (102, rows[0][1]), (103, shared[3] * 2)]


@pytest.mark.parametrize("shard", [1500, 1 << 20])
def test_suffix_dedup_of_passages(documents, monkeypatch, shard):
    """Small shards spread the stretches of an anchor, so that digests are merged across shards."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rows = passages(3)
    assert suffix_rows(documents(rows).repartition(5)) == cut_brute(rows)


def test_suffix_dedup_of_long_texts(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1000)
    rows = passages(5)
    assert suffix_rows(documents(rows)) == cut_brute(rows)


def test_a_shard_sorts_a_few_anchors_at_a_time(monkeypatch):
    """Memory is bounded by the suffixes that are sorted at once, however many stretches a shard holds."""
    rnd = random.Random(8)
    rows = []
    for anchor in range(200):
        text = rnd.randbytes(900)
        for first in (0, rnd.randint(1, 300), rnd.randint(301, 500)):
            rows.append((b"%d" % len(rows), anchor, len(rows), first, False, 3, text[first : first + 400 + rnd.randint(0, 100)]))
    rows = pd.DataFrame(rows, columns=["name", "anchor", "stretch", "first", "closed", "kinds", "bytes"])
    rows = rows.sample(frac=1, random_state=1)
    found = {}
    for size in (1, 1 << 14, 1 << 30):
        monkeypatch.setattr(suffix_dedup, "SORT_BYTES", size)
        found[size] = sorted(suffix_dedup._shard(rows).itertuples(index=False, name=None))
    assert found[1] == found[1 << 14] == found[1 << 30] != []
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 1 << 14)
    tracemalloc.start()
    suffix_dedup._shard(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * rows["bytes"].map(len).sum()


def test_suffix_dedup_edges(documents):
    rows = [(1, None), (2, ""), (3, "a" * 399), (4, "a" * 399), (None, "b" * 400), (5, "b" * 400), (5, "b" * 400)]
    rows += [(6, "c" * 401), (7, "d" * 400)]
    df = documents(rows, "name anchor stretch first sha held")
    assert suffix_rows(df) == cut_brute(rows)
    assert suffix_dedup.suffix_dedup(documents([])).count() == 0


# --- seed chains


def exact_run_docs(texts, size):
    """Documents that share ``size`` words in a row with another text."""
    holders = defaultdict(set)
    for doc_id, text in texts.items():
        words = re.sub(r"[A-Z]", lambda m: m[0].lower(), text).split()
        for k in range(len(words) - size + 1):
            holders[hash(tuple(words[k : k + size]))].add(doc_id)
    return {i for found in holders.values() if len(found) > 1 for i in found}


def test_chains_find_all_exact_runs(sf_documents, sf_texts):
    found = seed_chains.passages(sf_documents).collect()
    hit = {r.doc_id for r in found} | {r.other_id for r in found}
    assert exact_run_docs(sf_texts, 50) <= hit
    # Whatever is reported shares much: some 20 words in a row, since seeds are exact.
    assert hit <= exact_run_docs(sf_texts, 10)


def test_chains_find_fuzzy_passages(documents):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    passage = [rnd.choice(words) for _ in range(90)]
    rows, planted = [], set()
    for k in range(40):
        text = [rnd.choice(words) for _ in range(rnd.randint(60, 300))]
        if k % 4 == 0:
            copy = list(passage)
            copy[30], copy[60] = "changed", "other"
            del copy[45]
            at = rnd.randrange(len(text))
            text[at:at] = copy if k % 8 else passage
            planted.add(k)
        rows.append((k, " ".join(text)))
    found = seed_chains.passages(documents(rows)).collect()
    assert {r.doc_id for r in found} | {r.other_id for r in found} == planted
    texts = dict(rows)
    for r in found:
        mine, theirs = texts[r.doc_id].split()[r.start : r.end], texts[r.other_id].split()[r.other_start : r.other_end]
        assert len(mine) >= 80 and r.identity > 0.9
        assert len(set(mine) & set(theirs)) >= 80


def test_chains_keep_both_passages_around_a_gap(documents):
    """Header and footer word for word, 20 to 300 other words between, on one side or on both."""
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(50_000)]
    rows, shared = [], {}
    for n in (20, 60, 64, 65, 80, 100, 200, 300):
        for mine, theirs in ((n, n), (0, n), (n, 10)):
            head, foot = ([rnd.choice(words) for _ in range(80)] for _ in range(2))
            for m in (mine, theirs):
                text = head + [rnd.choice(words) for _ in range(m)] + foot
                shared[len(rows)] = set(range(80)) | set(range(80 + m, 160 + m))
                rows.append((len(rows), " ".join(text)))
    texts = {i: t.split() for i, t in rows}
    covered = defaultdict(set)
    for r in seed_chains.passages(documents(rows)).collect():
        assert r.doc_id // 2 == r.other_id // 2
        covered[r.doc_id] |= set(range(r.start, r.end))
        covered[r.other_id] |= set(range(r.other_start, r.other_end))
        mine, theirs = texts[r.doc_id][r.start : r.end], texts[r.other_id][r.other_start : r.other_end]
        alike = len(set(mine) & set(theirs))
        assert min(len(mine), len(theirs)) >= 40 and alike >= 0.75 * max(len(mine), len(theirs))
    for i, places in shared.items():
        assert places <= covered[i]


def test_chains_find_passages_of_frequent_lines(documents):
    """Two texts share lines in a row, each of which many others hold alone."""
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(50_000)]

    def prose(n):
        return [rnd.choice(words) for _ in range(n)]

    rows, planted = [], {}
    for k in range(4):
        lines = [prose(27) for _ in range(2)]
        for line in lines:
            rows += [(len(rows) + m, prose(50) + line + prose(30)) for m in range(30)]
        # The last two hold a line early, and the passage later.
        texts = [prose(40) + lines[0] + prose(1) + lines[1] + prose(9) for _ in range(2)]
        texts += [lines[m] + prose(60) + lines[0] + prose(1) + lines[1] for m in range(2)]
        planted[k] = {len(rows) + m for m in range(len(texts))}
        rows += [(len(rows) + m, text) for m, text in enumerate(texts)]
    found = seed_chains.passages(documents([(i, " ".join(t)) for i, t in rows]).repartition(4)).collect()
    assert {r.doc_id for r in found} | {r.other_id for r in found} == set().union(*planted.values())
    texts = dict(rows)
    for r in found:
        mine, theirs = texts[r.doc_id][r.start : r.end], texts[r.other_id][r.other_start : r.other_end]
        assert len(mine) >= 55 and len(set(mine) & set(theirs)) >= 54


def test_chains_find_exact_passages_among_frequent_lines(documents):
    """50 to 60 words in a row that two texts share, made of lines that many others hold in other orders."""
    rnd = random.Random(13)
    words = [f"w{k}" for k in range(50_000)]
    lines = [[rnd.choice(words) for _ in range(rnd.randint(12, 30))] for _ in range(30)]
    rows, planted = [], set()
    for _ in range(300):
        text = []
        for _ in range(rnd.randint(2, 5)):
            text += [rnd.choice(words) for _ in range(rnd.randint(10, 40))] + rnd.choice(lines)
        rows.append((len(rows), " ".join(text)))
    for size in range(50, 61):
        passage = [w for line in rnd.sample(lines, 6) for w in line][:size]
        for _ in range(2):
            planted.add(len(rows))
            around = [[rnd.choice(words) for _ in range(rnd.randint(0, 60))] for _ in range(2)]
            rows.append((len(rows), " ".join(around[0] + passage + around[1])))
    found = seed_chains.passages(documents(rows).repartition(3)).collect()
    assert planted <= {r.doc_id for r in found} | {r.other_id for r in found}


def changed_apart(rnd, words, passage):
    """The passage with a word changed, left out or put in after every three to eight."""
    out, left = [], rnd.randint(4, 8)
    for w in passage:
        left -= 1
        if left:
            out.append(w)
        else:
            out += rnd.choice([[rnd.choice(words)], [], [w, rnd.choice(words)]])
            left = rnd.randint(4, 8)
    return out


def test_chains_find_changed_passages_around_a_frequent_line(documents):
    """Each pair has nothing but a line of many others equal for ten words, and is alike around it."""
    rnd = random.Random(19)
    words = [f"w{k}" for k in range(50_000)]

    def prose(n):
        return [rnd.choice(words) for _ in range(n)]

    line = prose(20)
    rows = [(k, " ".join(prose(40) + line + prose(40))) for k in range(200)]
    pairs = []
    for _ in range(12):
        before, after = prose(40), prose(40)
        ahead, behind = changed_apart(rnd, words, before[::-1])[::-1], changed_apart(rnd, words, after)
        # The words next to the line differ, so no run of ten goes beyond it.
        texts = [before + prose(1) + line + prose(1) + after, ahead + prose(1) + line + prose(1) + behind]
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows) + k, " ".join(prose(30) + text + prose(30))) for k, text in enumerate(texts)]
    hashes = {k: {int(h) for h in seed_chains.seeds(w)[0]} for k, w in enumerate(seed_chains._words([t for _, t in rows]))}
    expected = {(a, b) for a, b in pairs if hashes[a] & hashes[b]}
    assert len(expected) > 3
    found = {(r.doc_id, r.other_id) for r in seed_chains.passages(documents(rows).repartition(3)).collect()}
    assert all((a, b) in found or (b, a) in found for a, b in expected), expected - found
    assert {min(p) for p in found} <= {a for a, _ in pairs}


def test_a_context_passes_what_alignment_finds():
    """The test before alignment is passed by every lone match in a passage, and by few others."""
    rnd = random.Random(23)
    words = [int(k) for k in np.random.default_rng(3).integers(0, 2**63, 5000)]
    none = np.zeros(0, np.int64)
    hits = passed = 0
    for k in range(600):
        before, seed, after = ([rnd.choice(words) for _ in range(n)] for n in (rnd.randint(0, 40), seed_chains.SEED, rnd.randint(0, 40)))
        x = [rnd.choice(words) for _ in range(8)] + before + seed + after + [rnd.choice(words) for _ in range(8)]
        head = changed_apart(rnd, words, before[::-1])[::-1]
        y = head + seed + changed_apart(rnd, words, after) + [rnd.choice(words) for _ in range(8)]
        p, q = 8 + len(before), len(head)
        found = bool(seed_chains.alike_parts(seed_chains.align(x, y, [p], [q])[2]))
        for (a, m), (b, n) in (((x, p), (y, q)), ((y, q), (x, p))):
            inner = seed_chains._context(np.array(a, np.uint64), none.view(np.uint64), none, m)[0]
            outer = seed_chains._context(np.array(b, np.uint64), none.view(np.uint64), none, n)[1]
            assert not found or set(inner.tolist()) & set(outer.tolist())
        other = [rnd.choice(words) for _ in range(60)]
        outer = seed_chains._context(np.array(other, np.uint64), none.view(np.uint64), none, 25)[1]
        passed += bool(set(inner.tolist()) & set(outer.tolist()))
        hits += found
    assert hits > 100 and not passed


def test_stretches_of_one_word_meet_at_both_ends(documents):
    """Texts with one word over and over are linked through a reference, not each with each."""
    rnd = random.Random(29)
    words = [f"w{k}" for k in range(50_000)]
    rows = []
    for k in range(60):
        ends = [[rnd.choice(words) for _ in range(rnd.randint(20, 40))] for _ in range(2)]
        rows.append((k, " ".join(ends[0] + ["of"] * rnd.randint(60, 100) + ends[1])))
    found = {(r.doc_id, r.other_id) for r in seed_chains.passages(documents(rows).repartition(3)).collect()}
    assert len(found) <= 2 * len(rows)
    linked, todo = set(), [0]
    while todo:
        a = todo.pop()
        if a not in linked:
            linked.add(a)
            todo += [x + y - a for x, y in found if a in (x, y)]
    assert linked == {k for k, _ in rows}


def test_matches_are_tried_if_their_equal_words_go_on():
    """What alignment finds passes, with one seed or two; a short line between other words does not."""
    rnd = random.Random(31)
    words = [int(k) for k in np.random.default_rng(5).integers(0, 2**63, 5000)]

    def prose(n):
        return [rnd.choice(words) for _ in range(n)]

    def fits(x, y, pa, pb):
        sides = ([], [])
        for side, text, at in ((sides[0], x, pa), (sides[1], y, pb)):
            text, at = np.array(text, np.uint64), np.array(at)
            found = seed_chains.runs(text, seed_chains.SEED)[at]
            side += [seed_chains._beside(text, found, at, p) for p in at]
        return seed_chains.can_be_in_a_passage(*sides)

    hits = 0
    for k in range(600):
        before, first, second, after = prose(rnd.randint(0, 40)), prose(seed_chains.SEED), prose(seed_chains.SEED), prose(rnd.randint(0, 40))
        gaps = [prose(rnd.randint(1, 30)) for _ in range(2)] if k % 2 else [[], []]
        head = changed_apart(rnd, words, before)
        x = before + first + gaps[0] + second + after
        y = head + first + gaps[1] + second + changed_apart(rnd, words, after)
        pa, pb = ([len(b), len(b) + len(first) + len(g)] for b, g in ((before, gaps[0]), (head, gaps[1])))
        start, _, steps = seed_chains.align(x, y, pa, pb)
        parts = seed_chains.alike_parts(steps)
        for p, fit in zip(pa, fits(x, y, pa, pb), strict=True):
            inside = any(start + low <= p and p + seed_chains.SEED <= start + high for low, high, *_ in parts)
            assert fit or not inside
            hits += inside
        line = prose(20)
        assert not fits(prose(40) + line + prose(k % 40), prose(30) + line + prose(50), [43, 48], [33, 38]).any()
    assert hits > 200


def test_matches_of_a_cell_are_those_that_can_be_in_a_passage(monkeypatch):
    """All matches of a seed at once, without a row for each pair of places, are those that a look at each pair gives."""
    monkeypatch.setattr(seed_chains, "FREQUENT", 3)
    monkeypatch.setattr(seed_chains, "PLACES", 7)
    rnd = random.Random(8)
    size, rows = seed_chains.SEED, []
    for k in range(24):  # stretches of one word over and over, as texts that have many seeds in common
        text = np.array([w for _ in range(6) for w in [rnd.randint(1, 4)] * rnd.choice((13, 26))] + [100 + k], np.uint64)
        found, at = seed_chains.seeds(text)
        for seed, place in zip(found, at.tolist(), strict=True):
            context = (c.tobytes() for c in seed_chains._context(text, found, at, place))
            around = (*context, *seed_chains._beside(text, found, at, place))
            rows.append((int(seed.view(np.int64)), 0, 0, bytes([0, k]), k, place, rnd.random() < 0.7, *around))
    columns = ["seed", "row", "column", "name", "doc_id", "place", "open", "inner", "outer", "near", "beside", "seeds", "apart"]
    right = seed_chains.pd.DataFrame(rows, columns=columns)
    found = seed_chains._fitting(right[right["open"]].reset_index(drop=True), right)

    def later(x, y):
        """Whether the equal words before or behind the seeds are passed, and how many these are."""
        x, y = np.frombuffer(x, "<u4").tolist(), np.frombuffer(y, "<u4").tolist()
        n = next((i for i, (v, w) in enumerate(zip(x, y, strict=True)) if v != w or not v), len(x))
        low = min(n, len(x) - 5)
        threes = ((x[low + i : low + i + 3], y[low + j : low + j + 3]) for i, j in seed_chains._PASSED)
        return any(v == w and 0 not in v for v, w in threes), n

    def fits(r, o):
        if not any(set(np.frombuffer(r[c], "<i8")) & set(np.frombuffer(o[d], "<i8")) for c, d in (("inner", "outer"), ("near", "near"))):
            return False
        half = 4 * seed_chains.BESIDE
        (more, before), (also, behind) = later(r["beside"][:half], o["beside"][:half]), later(r["beside"][half:], o["beside"][half:])
        (s, m), (t, n) = (([*np.frombuffer(v["seeds"], "<u4")], np.frombuffer(v["apart"], "i1").tolist()) for v in (r, o))
        near = any(
            v == w and i * j > 0 and not (i == j and -before <= i <= behind) for v, i in zip(s, m, strict=True) for w, j in zip(t, n, strict=True)
        )
        return more or also or before + size + behind >= seed_chains.MIN_WORDS or near

    asked = [dict(zip(columns, r, strict=True)) for r in rows]
    expected, tried = [], 0
    for r in asked:
        for o in asked if r["open"] else ():
            if r["seed"] == o["seed"] and (r["name"] < o["name"] or r["name"] > o["name"] and not o["open"]):
                tried += 1
                a, b = sorted((r, o), key=lambda v: v["name"])
                expected += [(a["name"], a["doc_id"], a["place"], b["name"], b["doc_id"], b["place"])] * fits(r, o)
    assert sorted(found[["a", "id_a", "pa", "b", "id_b", "pb"]].itertuples(index=False, name=None)) == sorted(expected)
    assert 500 < len(expected) < tried
    assert len(seed_chains._fitting(right[:0], right)) == 0


def test_only_first_alignments_tell_the_places_that_are_left():
    text = np.arange(1, 101, dtype="<u4")
    match = {"a": b"a", "b": b"b", "first_a": 0, "first_b": 0, "words_a": text.tobytes()}
    match |= {"pa": np.array([45], "<i4").tobytes(), "pb": np.array([45], "<i4").tobytes()}
    alone = np.where((text > 45) & (text <= 55), text, text + 1000).astype("<u4")
    rows = seed_chains.pd.DataFrame([match | {"words_b": w.tobytes()} for w in (text, alone)])
    both, rest = (next(f(iter([rows]))) for f in (seed_chains._align_rows, seed_chains._passage_rows))
    assert both["other"].tolist() == [b"b", None] and both["start"].tolist() == [0, 45]
    assert rest["other"].tolist() == [b"b"] and rest["start"].tolist() == [0]


def test_recall_of_changed_passages(documents):
    """Passages with one word in so many changed at random places, each in two texts: what is found is stated."""
    rnd = random.Random(17)
    words = [f"w{k}" for k in range(50_000)]
    rows, pairs = [], defaultdict(list)
    for apart in (30, 20, 15):
        for _ in range(40):
            passage = [rnd.choice(words) for _ in range(150)]
            changed = [w if rnd.random() > 1 / apart else rnd.choice(words) for w in passage]
            pairs[apart].append((len(rows), len(rows) + 1))
            for text in (passage, changed):
                rows.append((len(rows), " ".join([rnd.choice(words) for _ in range(50)] + text)))
    found = {(r.doc_id, r.other_id) for r in seed_chains.passages(documents(rows)).collect()}
    recall = {k: sum((a, b) in found or (b, a) in found for a, b in v) / len(v) for k, v in pairs.items()}
    assert recall[30] >= 0.95 and recall[20] >= 0.9 and recall[15] >= 0.8, recall


def test_chain_prefers_collinear_matches():
    a, b = np.array([0, 20, 25, 40, 60]), np.array([100, 120, 10, 140, 160])
    assert seed_chains.chains(a, b)[0] == [0, 1, 3, 4]


def test_edit_matches_is_a_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        x, y = ([rnd.randrange(4) for _ in range(rnd.randrange(9))] for _ in range(2))
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        assert seed_chains.edit_matches(np.array(x), np.array(y)) == table[-1][-1]


def test_chain_edges(documents):
    text = " ".join(f"v{k}" for k in range(60))
    rows = [(4, text), (2, text), (None, text), (7, None), (8, ""), (9, "again " * 300), (10, "again " * 200)]
    found = seed_chains.passages(documents(rows, "name seed place rank held found")).collect()
    copies = sorted((r.doc_id or 0, r.other_id, r.start, r.end) for r in found if r.end == 60 and r.other_id == 2)
    assert copies == [(0, 2, 0, 60), (4, 2, 0, 60)]
    assert seed_chains.passages(documents([])).count() == 0


def test_cleared_results_are_gone(spark):
    df = stored(spark.range(3), "gone")
    assert df.count() == 3
    folder = df.inputFiles()[0].rsplit("/", 1)[0]
    clear_stored(spark)
    with pytest.raises(Exception, match=r"(?i)path|exist|file"):
        spark.read.parquet(folder).count()
