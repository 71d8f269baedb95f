"""How byte-level BPE vocabularies cut a text into the words within which they merge."""

from __future__ import annotations

import re

import regex

#: Fixed value: the pattern of public byte-level BPE vocabularies.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Letters and numbers of Unicode 17, which the regex package knows and the tokenizers library doesn't.
NEWER_LETTERS = [
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f), (0x209d, 0x209f),
    (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2), (0xa7f1, 0xa7f1),
    (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7), (0x10ed9, 0x10eee),
    (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1), (0x1246f, 0x1246f),
    (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff6),
    (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20), (0x18d80, 0x18df2), (0x18e00, 0x19191),
    (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24),
    (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2),
    (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4), (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f),
    (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479), (0x3d000, 0x3fc3f),
]


def compiled(letter: str, number: str, flags: int = 0) -> regex.Pattern:
    """This engine's \\s also takes four control characters, so white space is named."""
    text = BYTE_LEVEL_WORDS.replace(r"[^\s\p{L}\p{N}]", f"[^\\p{{White_Space}}{letter}{number}]")
    text = text.replace(r"\p{L}+", f"{letter}+").replace(r"\p{N}+", f"{number}+")
    return regex.compile(text.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"), flags)


_newer = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER_LETTERS)
NEWER = regex.compile(f"[{_newer}]")
WORD = compiled(r"\p{L}", r"\p{N}")
WORD_WITH_NEWER = compiled(rf"[\p{{L}}--[{_newer}]]", rf"[\p{{N}}--[{_newer}]]", regex.V1)


#: Texts of these characters alone are cut faster by the standard engine, which then agrees.
NOT_SIMPLE = re.compile("[^\t\n\x0b\x0c\r -~À-ÖØ-öø-ɏ]")
SIMPLE_WORD = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: A space beside other white space.
LOOSE_SPACE = re.compile(r"\s | \s")


def words(text: str) -> list[str]:
    if not NOT_SIMPLE.search(text):
        return SIMPLE_WORD.findall(text)
    if not NEWER.search(text):
        return WORD.findall(text)
    return WORD_WITH_NEWER.findall(text)


def spaced(text: str) -> list[str]:
    """Parts of a text of which each consists of whole words and all but the first start with a space: a space
    between two other characters always begins a word. Elsewhere, the words."""
    if LOOSE_SPACE.search(text):
        return words(text)
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]]
