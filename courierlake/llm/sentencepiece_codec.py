"""Sentencepiece encoding and decoding on the tokenizers library.

The model file, a protobuf message, is parsed here: pieces with scores and kinds, the kind of model,
the normaliser's settings. From these a ``tokenizers.Tokenizer`` is rebuilt: normaliser (a marker in
front, markers for spaces), the unigram model with its scores or the merges that a BPE model's scores
stand for, and byte fallback. Texts are cut at segment borders (``metaspace``), each worker remembers
a bounded number of segments, and what it lacks is encoded in multithreaded batches. Every segment
that is encoded is also encoded by the sentencepiece library, so parity is verified over all texts:
``parity`` tells whether the rebuilt tokenizer gave the library's ids for each segment of a text.
Where it did not, the library's ids stand, so ``ids`` are right in any case.

Defined results: null text counts as empty; empty text has no ids and decodes to itself; strings of
special tokens inside texts are ordinary text; repeated rows and null ids pass through; further
columns are ignored. Decoding gives the model's normalised text: U+2581 becomes a space.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import whole_text
from courierlake.llm.metaspace import (
    MARK,
    Cache,
    cuttable,
    encode_segments,
    processor,
    segments,
)

CACHE_ROWS = 700_000
#: Threads of a worker's encoding batches.
THREADS = 2

# Fixed values of the model file's format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    normaliser: str
    dummy_prefix: bool
    extra_spaces_removed: bool
    unknown: int

    def ids(self, *kinds: int) -> list[int]:
        return [k for k, (_, _, kind) in enumerate(self.pieces) if kind in kinds]


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        match tag & 7:
            case 0:
                value, at = varint(at)
            case 1:
                value, at = data[at : at + 8], at + 8
            case 2:
                size, at = varint(at)
                value, at = data[at : at + size], at + size
            case 5:
                value, at = data[at : at + 4], at + 4
            case kind:
                raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


def parse(data: bytes) -> Model:
    """Parse a serialised model. Field numbers are those of the public message definition."""
    model = Model([], UNIGRAM, False, "", True, True, 0)
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normaliser = dict(_fields(value))
            model.normaliser = normaliser.get(1, b"").decode()
            model.dummy_prefix = bool(normaliser.get(3, 1))
            model.extra_spaces_removed = bool(normaliser.get(4, 1))
    unknown = model.ids(UNKNOWN)
    model.unknown = unknown[0] if unknown else 0
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces to a third, best score first, as the model merges."""
    own = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for k, (piece, score, kind) in enumerate(model.pieces):
        if kind == NORMAL:
            ways = ((piece[:c], piece[c:]) for c in range(1, len(piece)))
            found += [(-score, k, a, b) for a, b in ways if a in own and b in own]
    return [(a, b) for *_, a, b in sorted(found)]


def rebuild(model: Model):
    """The tokenizer of the tokenizers library that stands for the model."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    from tokenizers import Tokenizer, decoders, models, normalizers

    if model.normaliser not in ("", "identity") or model.extra_spaces_removed:
        raise ValueError("only models that leave characters and spaces as they are are rebuilt")
    names = [p for p, _, _ in model.pieces]
    if model.kind == UNIGRAM:
        # Control pieces never match text; a score below all others keeps them out.
        low = min((s for _, s, _ in model.pieces), default=0.0) - 100.0
        scored = [(p, s if kind in (NORMAL, BYTE, USER_DEFINED) else low) for p, s, kind in model.pieces]
        core = models.Unigram(scored, model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: k for k, p in enumerate(names)},
            _merges(model),
            unk_token=names[model.unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are rebuilt")
    out = Tokenizer(core)
    marks = [normalizers.Replace(" ", MARK)]
    out.normalizer = normalizers.Sequence([normalizers.Prepend(MARK)] * model.dummy_prefix + marks)
    out.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix
    )
    return out


@lru_cache(maxsize=4)
def backend(path: str):
    return rebuild(parse(processor(path).serialized_model_proto()))


class Codec:
    """Encodes and decodes in a worker.

    ``differing`` holds the segments without parity, ``changed`` what those segments decode to that
    do not decode to themselves. Byte fallback never runs across a segment's first marker, so a
    text decodes to its segments' texts, with a space for each marker between them.
    """

    def __init__(self, path: str):
        self.path, self.backend = path, backend(path)
        self.cut = cuttable(path)
        self.lone = array("I", [processor(path).piece_to_id(MARK)]).tobytes()
        self.cache, self.differing, self.changed = Cache(CACHE_ROWS), set(), {}

    def _learn(self, keys: list[str]) -> None:
        mine = self.backend.encode_batch_fast(keys, add_special_tokens=False)
        ids = encode_segments(self.path, keys)
        back = self.decode(ids)
        for key, own, theirs, text in zip(keys, mine, ids, back, strict=True):
            if own.ids != theirs and key:
                self.differing.add(key)
            if text != key:
                self.changed[key] = text
            self.cache[key] = array("I", theirs).tobytes()

    def encode(self, text: str) -> tuple[bytes, bool]:
        """Ids as little-endian unsigned 32-bit numbers, and whether there was parity."""
        return self.encode_and_back(text)[:2]

    def encode_and_back(self, text: str) -> tuple[bytes, bool, str]:
        """What ``encode`` gives, and the text that the ids decode to."""
        out, back, parity = [], [], True
        for found in segments(text) if self.cut else ([text] if text else [],):
            if lost := self.cache.missing(found):
                self._learn(lost)
            out += map(self.cache.__getitem__, found)
            parity = parity and (not self.differing or self.differing.isdisjoint(found))
            back += [self.changed.get(s, s) for s in found] if self.changed else found
            self.cache.trim()
        return b"".join(out), parity, " ".join(back)

    def decode(self, batch: list[list[int]]) -> list[str]:
        return self.backend.decode_batch(batch, skip_special_tokens=False)


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _ids(data: bytes) -> list[int]:
    return array("I", data).tolist()


def encoded(docs: DataFrame, model: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: _ids(codec(model).encode(t)[0]))

    return docs.withColumn(into, encode(whole_text(F.col(text))))


def decoded(docs: DataFrame, model: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``docs`` with the text that each array of ids stands for; null ids give empty text."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = codec(model).decode([[] if x is None else [int(i) for i in x] for x in batch])
            yield pd.Series(found, dtype=object)

    return docs.withColumn(into, decode(F.col(ids)))


def codec_digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text_sha256, round_trip, parity) for every row of ``docs``.

    The ids are decoded again: ``text_sha256`` is of the decoded text, ``round_trip`` tells whether
    that is the document's text, up to U+2581.
    """
    import hashlib

    kinds = "n_tokens long, ids_crc32 long, text_sha256 string, round_trip boolean, parity boolean"

    @F.pandas_udf(kinds)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        use = codec(model)
        for batch in batches:
            rows = []
            for text in batch:
                data, parity, back = use.encode_and_back(text)
                sha = hashlib.sha256(back.encode()).hexdigest()
                same = back == text.replace(MARK, " ")
                rows.append((len(data) // 4, zlib.crc32(data), sha, same, parity))
            yield pd.DataFrame(rows, columns=[k.split()[0] for k in kinds.split(", ")])

    return docs.select(F.col("doc_id"), digest(whole_text(F.col("text"))).alias("d")).select(
        "doc_id", "d.*"
    )
