"""Cutting text where a sentencepiece model can't merge across, and caches of what was encoded.

A model marks a space with U+2581 and merges symbols over the whole text. When no piece of its
vocabulary has the marker behind another character, nothing is merged across a place where a marker
follows another character. The segments between such places are encoded independently of each
other, and the library, which puts a marker in front of any text it is given, encodes
``segment[1:]`` as the segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

MARK = "▁"
#: Long texts are cut into stretches of about so many characters, at segment borders.
STRETCH = 1 << 20
#: Longer segments are encoded but not remembered.
LONGEST_KEPT = 64


@lru_cache(maxsize=4)
def processor(path: str):
    """The sentencepiece processor of a worker."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def cuttable(path: str) -> bool:
    """Whether the model allows cutting: see the module's text. Asks the library only."""
    sp = processor(path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    inner = any(MARK in p.lstrip(MARK) for p in pieces)
    # Spaces must be kept as they are, and a marker be put in front.
    as_is = sp.normalize(" a  ① ") == f"{MARK}{MARK}a{MARK}{MARK}①{MARK}"
    return as_is and not inner and sp.id_to_piece(sp.piece_to_id(MARK)) == MARK


def encode_segments(path: str, found: list[str]) -> list[list[int]]:
    """The library's ids of each segment. The empty one is a lone marker at the end of a text."""
    sp = processor(path)
    lone = [sp.piece_to_id(MARK)]
    return [i if s else lone for s, i in zip(found, sp.encode(found, num_threads=1), strict=True)]


def segments(text: str) -> Iterator[list[str]]:
    """Lists of segments without their first marker, for stretches of the text."""
    if not text:
        return
    text = text.replace(MARK, " ")
    start = 0
    while start <= len(text):
        end = start + STRETCH
        if end < len(text):
            end = text.find(" ", end)
            while end > 0 and text[end - 1] == " ":
                end = text.find(" ", end + 1)
        if end < 0 or end > len(text):
            end = len(text)
        found = text[start:end].split(" ")
        yield found if "" not in found else _with_runs(found)
        start = end + 1


def _with_runs(found: list[str]) -> list[str]:
    """An empty string stands for one more space in front of what follows."""
    out, spaces = [], 0
    for piece in found:
        if piece:
            out.append(" " * spaces + piece)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(" " * (spaces - 1))
    return out


class Cache(dict):
    """Remembers up to ``2 * limit`` values: when a half is full, the older half is forgotten."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def missing(self, keys: list[str]) -> list[str]:
        """The keys that have no value yet, once each. Values of the older half move up."""
        lost = {k for k in keys if k not in self}
        if lost and self.older:
            known = {k: self.older[k] for k in lost if k in self.older}
            self.update(known)
            lost -= known.keys()
        return list(lost)

    def trim(self) -> None:
        """Call between texts; keys of a text in work are never forgotten."""
        if len(self) > self.limit:
            self.older = {k: v for k, v in self.items() if len(k) <= LONGEST_KEPT}
            self.clear()
