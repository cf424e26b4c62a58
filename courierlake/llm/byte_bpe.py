"""Token ids by a byte-level BPE of the tokenizers library, for blocks of texts at once.

The pre-tokeniser's pattern starts a pre-token wherever white space follows something else, so the
units between such places are encoded independently of each other. The units of a block are told apart
by Arrow, and each different one is encoded once. Nothing is remembered from one block to the next.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from courierlake.llm.metaspace import STRETCH

#: Characters that are worked on at once.
BLOCK = 1 << 23

# The characters of the Unicode property White_Space.
_WHITE = r" \t-\r\x85\xa0  -     　"
_UNIT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
#: Control characters, of which one that no text of a block holds parts its units.
_PARTS = [chr(c) for c in (0, 1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16)]
_BORDER = re.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_names() -> dict[int, str]:
    """Byte-level vocabularies name printable bytes by themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


_NAMES = _byte_names()


def _stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH and (cut := _BORDER.search(text, start + STRETCH)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where the units of each text start among all of them, each one's number, and the different units."""
    part = next((c for c in _PARTS if not any(c in t for t in texts)), None)
    if part is None:
        found = pa.array([_UNIT.findall(t) for t in texts], pa.list_(pa.string()))
    else:
        marked = pc.replace_substring_regex(
            pa.array(texts, pa.string()), pattern=f"([{_WHITE}]+)", replacement=part + r"\1"
        )
        found = pc.split_pattern(marked, part)
    numbered = found.values.dictionary_encode()
    return found.offsets.to_numpy(), numbered.indices.to_numpy(), numbered.dictionary.to_pylist()


class _Encoder:
    """Ids of single units."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.tokenize = self.library.model.tokenize
        # Pre-tokenising cuts these off a word.
        self.ends = {c: self.library.encode(c, add_special_tokens=False).ids for c in ",."}

    def word(self, unit: str) -> list[int] | None:
        """Ids of a space and a word, with a comma or full stop, by the model alone; None for other units."""
        end = self.ends.get(unit[-1:])
        stem = unit[1:] if end is None else unit[1:-1]
        # Letters below U+0250 are letters in all versions of Unicode.
        if unit[:1] != " " or not stem.isalpha():
            return None
        if not stem.isascii():
            if max(stem) >= "\u0250":
                return None
            stem = stem.encode().decode("latin-1").translate(_NAMES)
        ids = [t.id for t in self.tokenize(_NAMES[0x20] + stem)]
        return ids if end is None else ids + end

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of each unit start among them and how many they are."""
        flat, lengths, done, others = array("I"), array("I"), array("I"), array("I")
        for k, unit in enumerate(units):
            ids = self.word(unit) if unit else []
            if ids is None:
                others.append(k)
                continue
            done.append(k)
            flat.extend(ids)
            lengths.append(len(ids))
        for e in self.library.encode_batch_fast([units[k] for k in others], add_special_tokens=False):
            flat.extend(e.ids)
            lengths.append(len(e.ids))
        order = np.array(done + others, np.int64)
        size, first = np.empty(len(units), np.int32), np.empty(len(units), np.int32)
        size[order] = lengths
        first[order] = np.cumsum(lengths, dtype=np.int64) - lengths
        return np.array(flat, np.uint32), first, size


@lru_cache(maxsize=4)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _block_ids(path: str, texts: list[str]) -> list[np.ndarray]:
    starts, number, units = _units(texts)
    flat, first, size = _encoder(path)(units)
    of_unit = size[number]
    ends = np.cumsum(of_unit, dtype=np.int32)
    # The place in ``flat`` of every id: its unit's first one, and so many further as it is in its unit.
    at = np.repeat(first[number] - (ends - of_unit), of_unit)
    at += np.arange(len(at), dtype=np.int32)
    bounds = np.concatenate([[0], ends])[starts]
    return np.split(flat[at], bounds[1:-1])


def _blocks(texts: Iterable[str], size: int) -> Iterator[list[str]]:
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def token_ids(path: str, texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The ids of each text, as unsigned 32-bit numbers."""

    def whole(text: str) -> np.ndarray:
        blocks = _blocks(_stretches(text), BLOCK)
        return np.concatenate([ids for block in blocks for ids in _block_ids(path, block)])

    held, n = [], 0
    for text in texts:
        if len(text) > STRETCH or n >= BLOCK:
            yield from _block_ids(path, held) if held else ()
            held, n = [], 0
        if len(text) > STRETCH:
            yield whole(text)
        else:
            held.append(text)
            n += len(text)
    if held:
        yield from _block_ids(path, held)


def id_bytes(path: str):
    """A function from a text to its ids as little-endian unsigned 32-bit numbers."""
    return lambda text: next(token_ids(path, [text])).astype("<u4").tobytes()
