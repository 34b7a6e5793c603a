"""Character classes and word patterns of the two public byte-pair vocabularies.

The classes are made from the Unicode categories by rule. Texts whose characters all lie below U+0250 take the short
classes, any other text the full ones; both give the same pieces.
"""

from __future__ import annotations

import re
import unicodedata

#: White space as the vocabularies' own splitter sees it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LATIN_END = 0x250

# Letters and numbers of Unicode 16 that an older ``unicodedata`` does not know yet (fixed values).
_NEW_LETTERS = (
    "\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85"
    "\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1"
    "\U000113d3\U00011bc0-\U00011be0\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff"
    "\U0001e5d0-\U0001e5ed\U0001e5f0"
)
_NEW_NUMBERS = (
    "\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79"
    "\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa"
)


def _class_of(kind: str, end: int) -> str:
    """Members of a major Unicode category below ``end``, as the inside of a character class."""
    out, begin = [], None
    for c in range(end + 1):
        inside = c < end and unicodedata.category(chr(c))[0] == kind
        if inside and begin is None:
            begin = c
        elif not inside and begin is not None:
            out.append(f"\\U{begin:08x}-\\U{c - 1:08x}")
            begin = None
    return "".join(out)


def _patterns(end: int) -> tuple[re.Pattern, re.Pattern]:
    letter, number = _class_of("L", end), _class_of("N", end)
    if end > _LATIN_END:
        letter, number = letter + _NEW_LETTERS, number + _NEW_NUMBERS
    spaced = (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )
    # letters first: an apostrophe never starts a letter run, so the order of these alternatives does not matter
    words = rf"[{letter}]+|'(?:[stmd]|re|ve|ll)|[{number}]|[^{SPACE}{letter}{number}]+"
    return re.compile(spaced), re.compile(words)


_BEYOND = re.compile(f"[^\\x00-\\u{_LATIN_END - 1:04x}]")
_SPACED_LATIN, _WORDS_LATIN = _patterns(_LATIN_END)
_SPACED_ANY, _WORDS_ANY = _patterns(0x110000)
_KIND = re.compile(
    f"(?P<S>[{SPACE}])|(?P<L>[{_class_of('L', 0x110000)}{_NEW_LETTERS}])"
    f"|(?P<N>[{_class_of('N', 0x110000)}{_NEW_NUMBERS}])|(?P<O>.)", re.DOTALL
)


def is_latin(text: str) -> bool:
    return _BEYOND.search(text) is None


def spaced_pieces(text: str) -> list[str]:
    """Pieces that keep their leading space; joined they give the text back."""
    return (_SPACED_LATIN if is_latin(text) else _SPACED_ANY).findall(text)


def word_pieces(text: str) -> list[str]:
    """Words, single digits and runs of signs; white space is dropped."""
    return (_WORDS_LATIN if is_latin(text) else _WORDS_ANY).findall(text)


def kind(char: str) -> str:
    """S white space, L letter, N number, O anything else."""
    return _KIND.match(char).lastgroup


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where printable,
    else the next free character from U+0100 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]
