"""Cutting texts where a byte-level or word tokenizer's result is the same in parts."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Before an ASCII space, tab or line break that follows something not blank. No match of the
#: tokenizers' split patterns goes on from a non-blank into a blank, and none looks back.
_CUT = re.compile(r"(?<=\S)(?=[ \t-\r])")
#: All parts between such cuts, if there are no blanks but ASCII ones.
_CHUNKS = re.compile(r"[\t-\r ]*+[^\t-\r ]+|[\t-\r ]+")
#: Blanks beyond ASCII ones, after which a cut is not safe.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut at safe boundaries only: a part
    grows until there is one."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def chunks(text: str) -> list[str]:
    """``text`` cut at every safe boundary, so that parts come back often; a text with blanks
    beyond ASCII ones stays whole."""
    return [text] if _ODD.search(text) else _CHUNKS.findall(text)
