"""Classifier, packing, token counts, sentencepiece, secrets: brute force, libraries, held-out rows."""

from __future__ import annotations

import binascii
import hashlib
import random
import re
import struct
import zlib
from array import array
from collections import defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from courierlake.llm import byte_bpe, metaspace, packing, quality, secret_scan, token_counts
from courierlake.llm import sentencepiece_codec as codec

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "Thand onthe, of er. " * 20_000
ODD = ["a", "b", "the", " ", " ", "  ", "\n", "\n\n", "\t", "é", "①", "<|endoftext|>", "<s>", "<unk>", ".", ","]
ODD += ["'s", "er", "0", "▁", "　", "\x00", "日本", "\xa0", "\x1c", "​", " the", "<0x0A>", "x\n"]


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


# --- quality


def test_quality_on_held_out_rows(spark, sf_documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality_scores(sf_documents, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == sf_documents.count()
    for i, r in got.items():
        assert r.held_out == (binascii.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    tried = [(r.predicted, truth[i]) for i, r in got.items() if r.held_out and i in truth]
    assert sum(p == y for p, y in tried) >= 0.9 * len(tried)


def test_quality_does_not_learn_from_held_out_rows(spark, sf_documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality"
    )
    assert quality.fit(sf_documents, labels) == quality.fit(sf_documents, turned)


def test_quality_edges(spark, documents):
    kind = "doc_id long, quality int"
    df = documents([(1, None), (2, ""), (3, "text"), (None, "text"), (3, "text")], "score id y order")
    none = quality.quality_scores(df, spark.createDataFrame([], kind)).collect()
    assert len(none) == 5 and {r.score for r in none} == {0.5}
    one_class = quality.quality_scores(df, spark.createDataFrame([(1, 1), (3, 1), (2, None)], kind)).collect()
    assert len({r.score for r in one_class}) == 1 and one_class[0].score > 0.5
    assert [r.held_out for r in none if r.doc_id is None] == [False]
    assert quality.quality_scores(documents([]), spark.createDataFrame([(1, 1)], kind)).count() == 0


def test_quality_stage_keeps_good_rows_whole(spark, documents):
    rnd = random.Random(3)
    rows, labels = [], []
    for k in range(300):
        good = k % 4 != 0
        word = (lambda: rnd.choice(["stone", "river", "cloud", "meadow", "harbour"])) if good else (lambda: "BUY!! ")
        rows.append((k, " ".join(word() for _ in range(rnd.randint(30, 80)))))
        labels.append((k, int(good)))
    df = documents(rows, "score __score label")
    kept = quality.keep_good(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, y in labels if y}


# --- byte-level ids and packing


def test_byte_ids_are_the_librarys(monkeypatch):
    ids, library = byte_bpe.id_bytes(BPE), Tokenizer.from_file(BPE)
    for stretch in (1 << 20, 30):
        monkeypatch.setattr(byte_bpe, "STRETCH", stretch)
        for text in [*odd_texts(1500), " lead", "\nlead", "tail ", LONG[:5000]]:
            want = library.encode(text, add_special_tokens=False).ids
            assert ids(text) == array("I", want).tobytes(), text


def check_packing(rows, texts, size=packing.SEQUENCE):
    library = Tokenizer.from_file(BPE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    total = 0
    for doc_id, pieces in by_doc.items():
        ids = array("I", [*library.encode(texts[doc_id], add_special_tokens=False).ids, 0])
        at = 0
        for k, p in enumerate(sorted(pieces, key=lambda p: p.piece)):
            assert (p.piece, p.start) == (k, at)
            assert p.length == size or k == 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
        total += at
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence), -(-total // size)


def test_packing_of_documents(sf_documents, sf_texts):
    used, least = check_packing(packing.pack(sf_documents, BPE).collect(), sf_texts)
    assert used <= least + 1


def test_packing_edges(documents):
    rows = [(1, None), (2, ""), (3, "a b"), (4, LONG), (5, "x" * 9000)]
    df = documents(rows, "length number task before sequence_id")
    check_packing(packing.pack(df, BPE).collect(), {i: t or "" for i, t in rows})
    again = packing.pack(documents([(1, "a"), (1, "a"), (None, "a")]), BPE).collect()
    assert sorted((r.doc_id or 0, r.offset) for r in again) in ([(0, 0), (1, 2), (1, 4)], [(0, 2), (1, 0), (1, 4)], [(0, 4), (1, 0), (1, 2)])
    assert packing.pack(documents([]), BPE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rnd = random.Random(seed)
    size = rnd.choice([10, 64, 2048])
    histogram = {rnd.randint(1, size): rnd.randint(1, 500) for _ in range(rnd.randint(1, 60))}
    plan = packing.plan_sequences(histogram, size)
    placed = defaultdict(int)
    for config, times in plan:
        assert times > 0 and sum(n * a for n, a in config.items()) <= size
        for n, a in config.items():
            placed[n] += a * times
    assert placed == histogram
    runs = packing._runs(plan)
    for n, own in runs.groupby("length"):
        ends = own["first"].tolist()[1:] + [histogram[n]]
        assert all(b > a for a, b in zip(own["first"], ends, strict=True))


def test_plan_finds_perfect_packings():
    # Pairs that fill a sequence, which first-fit by size would also find, and triples it would not.
    plan = packing.plan_sequences({4: 300, 5: 200, 6: 100, 3: 200, 10: 7}, 10)
    assert sum(t for _, t in plan) <= -(-(4 * 300 + 5 * 200 + 6 * 100 + 3 * 200 + 70) // 10) + 12


# --- token counts


def test_token_counts_are_the_librarys(documents, sp):
    rows = [*enumerate(odd_texts(300)), (900, None), (901, LONG), (902, "a" * 5000), (None, "a  "), (1, "again")]
    df = documents(rows, "pretoken n n_bytes")
    got = sorted(tuple(r) for r in token_counts.token_counts(df, PIECES).selectExpr("coalesce(doc_id, -1)", "n_bytes", "n_tokens", "over_limit").collect())
    want = []
    for i, t in rows:
        n = len(sp.encode(t or ""))
        want.append((-1 if i is None else i, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want)
    assert token_counts.token_counts(documents([]), PIECES).count() == 0


def test_token_counts_of_documents(sf_documents, sf_texts, sp):
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(sf_documents, PIECES).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in sf_texts.items()}


def test_counts_do_not_depend_on_table_or_cache(sp, monkeypatch):
    monkeypatch.setattr(metaspace, "STRETCH", 25)
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 10)
    token_counts._worker_cache.cache_clear()
    for table in ({}, {"the": len(sp.encode("the"))}):
        count = token_counts.counter(PIECES, table)
        for text in odd_texts(1500, 2):
            assert count(text) == len(sp.encode(text)), text
    token_counts._worker_cache.cache_clear()


# --- sentencepiece codec


def test_codec_is_the_librarys(sp):
    use = codec.Codec(PIECES)
    for text in [*odd_texts(1500, 3), LONG[:4000]]:
        data, parity = use.encode(text)
        ids = array("I", data).tolist()
        assert ids == sp.encode(text) and parity
        assert use.decode([ids]) == [text.replace("▁", " ")] == [use.encode_and_back(text)[2]]


def piece(text, score, kind=1):
    data = text.encode()
    body = b"\x0a" + bytes([len(data)]) + data + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind])
    return b"\x0a" + bytes([len(body)]) + body


def unigram_model():
    """A small model message, written by hand: unigram, identity normaliser, byte fallback."""
    pieces = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    pieces += b"".join(piece(f"<0x{b:02X}>", -20.0, 6) for b in range(256))
    words = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -3.2, "▁ab": -4.0, "▁a": -2.5, "ba": -4.1, "c": -5.0, "▁c": -4.5}
    pieces += b"".join(piece(w, s) for w, s in words.items())
    trainer = b"\x18\x01" + b"\x98\x02\x01"  # unigram; byte fallback
    normaliser = b"\x0a\x08identity" + b"\x18\x01" + b"\x20\x00"
    return pieces + b"\x12" + bytes([len(trainer)]) + trainer + b"\x1a" + bytes([len(normaliser)]) + normaliser


def test_unigram_models_are_rebuilt():
    data = unigram_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = codec.parse(data)
    assert model.kind == codec.UNIGRAM and model.byte_fallback and model.normaliser == "identity"
    mine = codec.rebuild(model)
    rnd = random.Random(6)
    for _ in range(500):
        text = "".join(rnd.choice("abc éa") for _ in range(rnd.randint(1, 15)))
        assert mine.encode(text, add_special_tokens=False).ids == library.encode(text), text


def test_codec_digests(documents, sp):
    rows = [(1, None), (2, ""), (3, "a  b\n①"), (4, LONG), (None, "▁x"), (3, "a  b\n①")]
    got = codec.codec_digests(documents(rows, "d ids"), PIECES).collect()
    assert len(got) == len(rows)
    for r in got:
        text = {1: "", 2: "", 3: "a  b\n①", 4: LONG, None: "▁x"}[r.doc_id]
        ids = sp.encode(text)
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(array("I", ids).tobytes()))
        assert r.text_sha256 == hashlib.sha256(text.replace("▁", " ").encode()).hexdigest()
        assert r.round_trip and r.parity
    assert codec.codec_digests(documents([]), PIECES).count() == 0


def test_encoded_then_decoded(documents):
    rows = [(1, "one two"), (2, None), (3, " x ")]
    ids = codec.encoded(documents(rows), PIECES)
    back = codec.decoded(ids, PIECES, into="back")
    assert [(r.doc_id, r.back) for r in back.orderBy("doc_id").collect()] == [(1, "one two"), (2, ""), (3, " x ")]


# --- secrets

PARTS = ["password", "PassWD", "secret", "token", "api_key", "apikey", ":", "=", " ", '"', "'", "abcdefgh123456"]
PARTS += ["AKIA", "ABCD1234EFGH56", "deadbeef01234567", "é", "ſecret", "toKen", "\n", "x", "ghp_" + "a" * 36]
PARTS += ["-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890ab", "eyJhbGciOiJI.eyJzdWIiOiIx.x-_"]


def base_spans(text):
    """The three base rules, one after the other, over the whole text."""
    rules = [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    ]
    out = []
    for k, (kind, pattern, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[group]) >= least:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_secret_digests_equal_a_full_scan(documents):
    rnd = random.Random(8)
    rows = [(k, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))) for k in range(400)]
    rows += [(500, None), (501, "clean " * 50_000), (502, "f" * 200_000), (None, "token=abcdefghijkl")]
    got = secret_scan.secret_digests(documents(rows, "found spans kind")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s.startswith(k + ":") for s in want) for k in ("assign", "access", "hex")
        )
        every = r.spans.split(",") if r.spans else []
        assert [s for s in every if s.split(":")[0] in ("assign", "access", "hex")] == want
    assert secret_scan.secret_digests(documents([])).count() == 0


def test_trigram_candidates_hold_all_matches():
    rnd = random.Random(9)
    for _ in range(100):
        texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 12))) for _ in range(40)]
        want = [
            sorted((a, k, b) for k, r in enumerate(secret_scan.RULES) for a, b in r.spans(t)) for t in texts
        ]
        assert secret_scan.scan_block(texts) == want


def test_trigram_queries():
    def shown(pattern):
        return [sorted("&".join(sorted(a)) for a in c) for c in secret_scan.trigram_query(pattern)]

    assert shown(r"abcd\d+xyz") == [["abc&bcd"], ["xyz"]]
    assert shown(r"(abc|xyz)q") == [["abc&bcq", "xyz&yzq"]]
    assert shown(r"ab?cd") == [["abc&bcd", "acd"]]
    assert shown(r"[0-9a-f]+") == [] and shown(r"a.*b") == []


def test_masking(documents):
    secret = "password=abcdefghijklmnop"
    rows = [(1, f"x {secret} y"), (2, "clean"), (3, None), (4, "deadbeefdeadbeefdeadbeef")]
    df = documents(rows, "__new spans")
    out = secret_scan.mask_secrets(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("x [SECRET] y", 12), 2: ("clean", 5), 3: (None, None), 4: ("[SECRET]", 8)}
    assert secret_scan.mask_text("abcdef", [(1, 3), (2, 4)]) == "a[SECRET]ef"
