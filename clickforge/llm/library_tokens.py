"""Ids and counts of the tokenizers library, one library call for many words.

A text is cut into chunks (blanks, then non-blanks) at boundaries over which no result
reaches, see :mod:`clickforge.llm.text_blocks`. The library encodes the chunks that a worker
has not met lately, many in one call: they are joined by a special token, at which the ids
are cut again. Chunks that hold a special token's text are encoded on their own, as the
library's default treats them.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from typing import Any
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickforge.llm.text_blocks import blocks

#: Chunks are blanks and then a run of Latin letters and digits before a punctuation mark, or all
#: that is not blank. No token reaches from a Latin letter or a digit into these marks; other
#: letters may end in a combining mark once they are normalised, and are not cut off.
_CHUNKS = re.compile(r"[\t-\r ]*+(?:[0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]++"
                     r"(?=[.,;:!?])|[^\t-\r ]+)|[\t-\r ]+")
#: A mark before which chunks end.
_AFTER_LETTER = re.compile(r"[.,;:!?](?<=[0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f].)")
#: Blanks beyond ASCII ones, after which a chunk boundary is not safe.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Chunks kept per worker (half of them; the older half gives way), chunks per call, and the
#: longest chunk kept.
MAX_CHUNKS, PER_CALL, KEPT_CHUNK = 300_000, 2_000, 40


def _is_odd(text: str) -> bool:
    if text.isascii():  # a regular expression looks at every character, this does not
        return any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _ODD.search(text) is not None


def packed(ids: list[int] | np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.tobytes() if isinstance(ids, np.ndarray) else struct.pack(f"<{len(ids)}I", *ids)


_BLANKS = "\t\n\x0b\x0c\r "


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1
    characters for themselves, the others for U+0100 onwards, in order."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(0x100 + hidden.index(b)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


def _lowers_words(described: dict) -> bool:
    """Whether a word of Latin letters is, lower-cased and without blanks around it, one piece
    for the byte-level model of a tokenizer file. The library's model can be asked directly
    then, without its normaliser and splitter."""
    def kinds(part, inner):
        return [x["type"] for x in (part or {}).get(inner, [])]
    split = (described["pre_tokenizer"] or {}).get("pretokenizers", [])
    return kinds(described["normalizer"], "normalizers") == ["NFC", "Replace", "Lowercase"] \
        and kinds(described["pre_tokenizer"], "pretokenizers") == ["Split", "ByteLevel"] \
        and r"[\p{L}]+" in split[0]["pattern"].get("Regex", "") and split[0]["invert"] \
        and split[0]["behavior"] == "Removed" and not split[1]["add_prefix_space"] \
        and not split[1]["use_regex"]


#: A split whose pieces hold no blanks, so that blanks only part words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _drops_blanks(described: dict) -> bool:
    """Whether the words between blanks of a text give its ids one after the other, with blanks
    giving none, and ASCII text those of its lower-cased form."""
    added = described["added_tokens"]
    return _lowers_words(described) \
        and described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _WORDS \
        and described["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"} \
        and described["normalizer"]["normalizers"][1]["content"] == " " \
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                    or re.search(r"\s", t["content"]) for t in added)


class LibraryTokens:
    """Results of a ``.json`` file of the tokenizers library, without added special tokens,
    truncation or padding. ``value`` makes what is kept of some ids, such as their number."""

    def __init__(self, path: str, value: Callable[[Any], Any]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library, self.value = Tokenizer.from_file(path), value
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        added = described["added_tokens"]
        self.lower_words, self.drops_blanks = _lowers_words(described), _drops_blanks(described)
        self.marks = [t["content"] for t in added]
        # a mark that takes no neighbouring blanks and is looked for in the text as it is
        plain = [t for t in added if t["special"] and not re.search(r"\s", t["content"])
                 and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])]
        self.mark, self.mark_id = (plain[-1]["content"], plain[-1]["id"]) if plain else (None, -1)
        self.known: dict[str, Any] = {}
        self.older: dict[str, Any] = {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4")
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> dict[str, Any]:
        got = {}
        if self.lower_words:
            for c in chunks:
                word = c.lstrip(_BLANKS)
                if not word.isalpha():
                    continue
                if word.isascii():
                    got[c] = self.value([t.id for t in self.library.model.tokenize(word.lower())])
                elif max(word) < "\u0250" and is_normalized("NFC", word) and "\u0130" not in word:
                    word = "".join(map(_BYTE_LETTERS.__getitem__, word.lower().encode()))
                    got[c] = self.value([t.id for t in self.library.model.tokenize(word)])
            chunks = [c for c in chunks if c not in got]
        odd = [c for c in chunks if any(m in c for m in self.marks)]
        got |= zip(odd, map(self.value, self._encode(odd))) if odd else {}
        rest = [c for c in chunks if c not in got]
        for at in range(0, len(rest), PER_CALL):
            part = rest[at:at + PER_CALL]
            ids = self._encode([self.mark.join(part)])[0]
            ends = np.flatnonzero(ids == self.mark_id)
            starts = np.concatenate(([0], ends + 1)).tolist()
            for c, s, e in zip(part, starts, [*ends.tolist(), len(ids)], strict=True):
                got[c] = self.value(ids[s:e])
        return got

    def _values(self, cut: list[list[str]]) -> list[list]:
        """The values of lists of chunks."""
        if len(self.known) >= MAX_CHUNKS:
            self.known, self.older = {}, self.known
        missing = set().union(*cut).difference(self.known)
        long = [c for c in missing if len(c) > KEPT_CHUNK]
        if missing:
            back = {c: self.older[c] for c in missing if c in self.older}
            self.known |= back
            self.known |= self._learn(sorted(missing.difference(back)))
        out = [list(map(self.known.__getitem__, p)) for p in cut]
        for c in long:
            del self.known[c]
        return out

    def parts(self, texts: list[str]) -> list[list]:
        """For each text the values of its parts, in order."""
        if self.mark is None:
            return [[self.value(i)] for i in self._encode(texts)]
        whole = [i for i, t in enumerate(texts) if _is_odd(t)]
        odd = dict(zip(whole, self._encode([texts[i] for i in whole]))) if whole else {}
        cut = [[] if i in odd else _CHUNKS.findall(t) for i, t in enumerate(texts)]
        out = self._values(cut)
        for i, ids in odd.items():
            out[i] = [self.value(ids)]
        return out


class LibraryIds(LibraryTokens):
    """Packed ids of texts. Where blanks only part words, Arrow cuts the texts of a call at
    them and finds the distinct words, and only these are looked at one by one."""

    def __init__(self, path: str):
        super().__init__(path, packed)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        if self.mark is None or not self.drops_blanks or not texts:
            return [b"".join(p) for p in self.parts(texts)]
        whole = [i for i, t in enumerate(texts) if _is_odd(t)]
        odd = dict(zip(whole, self._encode([texts[i] for i in whole]))) if whole else {}
        plain = ["" if i in odd else self._parted(t) for i, t in enumerate(texts)]
        split = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._values([words])[0], pa.large_binary()).take(coded.indices)
        _, places, data = ids.buffers()
        places = np.frombuffer(places, np.int64)[ids.offset:][split.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [packed(odd[i]) if i in odd else bytes(data[s:e])
                for i, (s, e) in enumerate(zip(places, places[1:]))]

    def _parted(self, text: str) -> str:
        """A text of the same ids that has fewer distinct words."""
        low = text.lower() if text.isascii() else text
        if any(m in text or m.lower() in low for m in self.marks):
            return text
        return _AFTER_LETTER.sub(r" \g<0>", low)


def by_bytes(texts: Iterable[str], most: int = 1 << 20) -> Iterator[list[tuple[int, str]]]:
    """Batches of (number of the text, part of it) of about ``most`` bytes: short texts
    together, long ones in parts cut at safe boundaries."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        for part in blocks(text, most):
            batch.append((i, part))
            size += len(part) if part.isascii() else len(part.encode("utf-8", "surrogatepass"))
            if size >= most:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


@functools.cache
def library_counts(path: str) -> LibraryTokens:
    return LibraryTokens(path, len)


@functools.cache
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)
