"""Splitting of texts into the pieces whose merges a byte-level BPE works on."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
import regex

PIECES = regex.compile(public_tokenizers.PATTERN)
_SPACE_RUN = re.compile(r" (?:\s|\Z)")
_UNIT_END = re.compile(r" (?=\S)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = [""] * 256
    for b in plain:
        letters[b] = chr(b)
    spare = 0x100
    for b in range(256):
        if not letters[b]:
            letters[b] = chr(spare)
            spare += 1
    return letters


LETTERS = byte_letters()
_AS_LETTERS = {b: LETTERS[b] for b in range(256)}


def as_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_AS_LETTERS)


def units(text: str) -> list[str]:
    """Parts of a text that no piece crosses: cut before every space that a word follows.

    That space belongs to the part after it and is left out; the first part had none. A piece
    never crosses such a cut, as white space before it ends at the cut and a space before a word
    always goes with the word.
    """
    return _UNIT_END.split(text) if _SPACE_RUN.search(text) else text.split(" ")


def over_units(text: str, first: Callable, rest: dict) -> list:
    """`first` of the first unit, then of each other one what `rest` has for it."""
    parts = units(text)
    return [first(parts[0]), *map(rest.__getitem__, parts[1:])]
