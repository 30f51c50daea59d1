"""Byte-level BPE encoding and decoding.

Encoding runs a finite-state transducer over the bytes of each pre-token. In the
nondeterministic machine a run is a chain of tokens in which every two neighbours are
*compatible*: the pair encodes to just these two tokens. Exactly one such chain spells a
string, and it is the result of the merges. The machine is determinised lazily: a state is
the set of runs that can still go on (a trie node, the tokens not yet written, the last
token), a byte moves all of them, and what all of them agree on is written. So tokens come
out after the bounded lookahead that settles them, in time linear in the text, and moves are
computed once. Decoding is a second machine over tokens, whose state is the unfinished
UTF-8 sequence.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.text_blocks import blocks, chunks

#: States, and half of the chunks and pre-tokens, kept per worker. Further states are made and
#: forgotten; of the chunks and pre-tokens the older half gives way.
MAX_STATES = 60_000
MAX_PIECES = 150_000
#: Compatible or incompatible pairs of tokens kept per worker.
MAX_PAIRS = 200_000
#: Longer ones are not kept.
KEPT_PIECE = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file (a base64 token and a number on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[int]:
    """Ranks of the tokens that merging gives: the leftmost pair of least rank, repeatedly,
    until ``stop`` tokens are left or nothing merges."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best, at = min((ranks.get(a + b, 1 << 62), i)
                       for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == 1 << 62:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class _State:
    __slots__ = ("runs", "moves", "rest")

    def __init__(self, runs: tuple):
        self.runs, self.moves = runs, {}
        # what a text that ends here still writes: the run that has no token under way
        self.rest = next((pending for node, pending, _ in runs if node == 0), None)


class Transducer:
    """The encoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.spelling = ranks, {r: t for t, r in ranks.items()}
        self.child, self.token = [{}], [-1]
        for t, r in ranks.items():
            node = 0
            for b in t:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = r
        self._find_parts()
        first = ((0, (), -1),)
        self.start = _State(first)
        self.states = {first: self.start}

    def _find_parts(self) -> None:
        """For every token the two tokens that its last merge joins."""
        self.parts: dict[int, tuple[int, int]] = {}
        for t, r in self.ranks.items():
            if len(t) > 1:
                parts = merge(t, self.ranks, stop=2)
                if len(parts) != 2 or max(parts) > r:
                    raise ValueError(f"rank {r} is not reached by merges of lower ranks")
                self.parts[r] = parts[0], parts[1]
        self.joined = {p: r for r, p in self.parts.items()}
        self.left, self.right, self.fitting = {}, {}, {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stood at one edge (0 left, 1 right) of a token while it was being
        merged, each with the rank of the merge that ended it."""
        known = self.right if side else self.left
        if token not in known:
            out, until = [(token, float("inf"))], token
            while until in self.parts:
                until, last = self.parts[until][side], until
                out.append((until, last))
            known[token] = out
        return known[token]

    def _fits(self, last: int, token: int) -> bool:
        """Whether the two tokens' bytes encode to just them. Merges run in rank order (the
        leftmost first), so a merge across the border happens if and only if both of its
        parts stand at the border when its rank is due."""
        if last < 0:
            return True
        pair = last << 32 | token
        known = self.fitting.get(pair)
        if known is None:
            if len(self.fitting) >= MAX_PAIRS:
                self.fitting.clear()
            known = self.fitting[pair] = self._stays_cut(last, token)
        return known

    def _stays_cut(self, last: int, token: int) -> bool:
        for l, left_until in self._edge(last, 1):
            for r, right_until in self._edge(token, 0):
                across = self.joined.get((l, r))
                if across is not None and across < left_until and across <= right_until:
                    return False
        return True

    def _move(self, state: _State, byte: int) -> tuple[_State, tuple]:
        runs, done, child, tokens = [], None, self.child, self.token
        for node, pending, last in state.runs:
            node = child[node].get(byte)
            if node is None:
                continue
            # exactly one run ends here: once it is found, the others only go on
            if done is None and (token := tokens[node]) >= 0 and self._fits(last, token):
                done = (0, (*pending, token), token)
            if child[node]:
                runs.append((node, pending, last))
        if done is None:
            raise ValueError(f"byte {byte} has no single encoding: the ranks lack a byte or a merge")
        runs.append(done)
        written, n = runs[0][1], 0
        if written:
            most = min(len(r[1]) for r in runs)
            while n < most and all(r[1][n] == written[n] for r in runs):
                n += 1
            written = written[:n]
        if n:
            runs = [(node, pending[n:], last) for node, pending, last in runs]
        key = tuple(runs)
        known = self.states.get(key)
        if known is None:
            known = _State(key)
            if len(self.states) >= MAX_STATES:  # the common ones are there by now
                return known, written
            self.states[key] = known
        move = state.moves[byte] = (known, written)
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Ranks of a pre-token. One that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = self.start, []
        for byte in piece:
            move = state.moves.get(byte) or self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        out += state.rest
        return out


def utf8_step(pending: bytes, more: bytes) -> tuple[str, bytes]:
    """Characters completed by ``more`` after the unfinished sequence ``pending``, and the
    sequence that is unfinished now. Each maximal malformed part becomes U+FFFD."""
    data, text, i = pending + more, [], 0
    while i < len(data):
        lead = data[i]
        if lead < 0x80:
            need, low, high = 0, 0, 0
        elif 0xC2 <= lead <= 0xDF:
            need, low, high = 1, 0x80, 0xBF
        elif 0xE0 <= lead <= 0xEF:
            need, low, high = 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        elif 0xF0 <= lead <= 0xF4:
            need, low, high = 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        else:
            text.append("�")
            i += 1
            continue
        end = i + 1
        while end <= i + need and end < len(data) and low <= data[end] <= high:
            end, low, high = end + 1, 0x80, 0xBF
        if end == i + 1 + need:
            text.append(data[i:end].decode())
        elif end == len(data):
            return "".join(text), data[i:]
        else:
            text.append("�")
        i = end
    return "".join(text), b""


class Decoder:
    """Streaming decoder: tokens in, characters out as soon as they are complete."""

    def __init__(self, spelling: dict[int, bytes]):
        self.spelling, self.moves = spelling, {}
        self.closed = {}  # what a token writes that begins and ends between two characters
        for token, data in spelling.items():
            text, rest = utf8_step(b"", data)
            if rest:
                self.moves[b"", token] = text, rest
            else:
                self.closed[token] = text

    def decode(self, ids: Iterator[int]) -> Iterator[str]:
        """Ids outside the table, and a sequence left unfinished, give U+FFFD."""
        pending, moves = b"", self.moves
        for i in ids:
            move = moves.get((pending, i))
            if move is None:
                if i not in self.spelling:
                    yield "�" * (1 + bool(pending))
                    pending = b""
                    continue
                move = moves[pending, i] = utf8_step(pending, self.spelling[i])
            pending = move[1]
            if move[0]:
                yield move[0]
        if pending:
            yield "�"

    def text(self, ids: list[int]) -> str:
        """All characters of ``ids``. Moves from the state without an unfinished sequence back to
        itself are taken together; from the first other token on the machine goes step by step."""
        closed = self.closed
        texts = [*map(closed.get, ids)]
        if None not in texts:
            return "".join(texts)
        out, at = [], 0
        while at < len(ids):
            try:
                end = texts.index(None, at)
            except ValueError:
                end = len(ids)
            out += texts[at:end]
            pending, at = b"", end
            while at < len(ids) and (pending or texts[at] is None):
                i = ids[at]
                if i not in self.spelling:
                    out.append("�" * (1 + bool(pending)))
                    pending = b""
                else:
                    move = self.moves.get((pending, i))
                    if move is None:
                        move = self.moves[pending, i] = utf8_step(pending, self.spelling[i])
                    out.append(move[0])
                    pending = move[1]
                at += 1
            if pending:
                out.append("�")
        return "".join(out)


class TextEncoder:
    """Packed ids (little-endian unsigned 32-bit integers) of texts: a transducer behind the
    split pattern, with the results of short recent chunks and pre-tokens at hand."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.machine, self.split = Transducer(ranks), regex.compile(pattern).findall
        self.known, self.older = {}, {}

    def _encode(self, piece: str) -> bytes:
        ids = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _kept(self, part: str, packed: bytes) -> bytes:
        if len(part) <= KEPT_PIECE:
            if len(self.known) >= MAX_PIECES:  # what is met again comes back from the older half
                self.known, self.older = {}, self.known
            self.known[part] = packed
        return packed

    def _chunk(self, chunk: str) -> bytes:
        """A chunk that is not at hand: its pre-tokens, one by one."""
        packed = self.older.get(chunk)
        if packed is None:
            pieces = self.split(chunk)
            if len(pieces) == 1:
                packed = self._encode(chunk)
            else:
                packed = b"".join([self.known.get(p) or self._piece(p) for p in pieces])
        return self._kept(chunk, packed)

    def _piece(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        return self._kept(piece, self._encode(piece) if packed is None else packed)

    def encode(self, text: str) -> bytes:
        out = []
        for block in blocks(text):
            known = self.known.get
            for c in chunks(block):
                packed = known(c)
                if packed is None:
                    packed = self._chunk(c)
                    known = self.known.get
                out.append(packed)
        return b"".join(out)


@functools.cache
def text_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(path), pattern)


@functools.cache
def decoder(path: str) -> Decoder:
    return Decoder({r: t for t, r in read_ranks(path).items()})


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that the results of one are small too."""
    for b in batches:
        yield from (b.slice(at, rows) for at in range(0, b.num_rows, rows))


def split_pattern() -> str:
    from public_tokenizers import PATTERN
    return PATTERN


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` (binary, little-endian unsigned 32-bit integers) of every row.

    A null text counts as empty and gives no ids. Ids may be null or repeated; rows come out
    as they come in. Other columns are ignored. Long texts are cut at safe boundaries, so
    memory beside the text is bounded. ``ranks_path`` is a rank file on every machine.
    """
    split = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = text_encoder(ranks_path, split)
        for b in slices(batches):
            ids = [own.encode(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())],
                                             [b.schema.names[0], "ids"])

    kept = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    return kept.mapInArrow(run, kept.select(id_col, F.lit(b"").alias("ids")).schema)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``ids`` and ``decoded`` (the text) of rows as :func:`encode` gives them. A
    null or empty ``ids`` gives an empty text; malformed sequences give U+FFFD; bytes after
    the last whole id are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(ranks_path)
        for b in slices(batches):
            texts = []
            for ids in b.column(1):
                data = ids.as_py() or b""
                texts.append(own.text(np.frombuffer(data, "<u4", len(data) // 4).tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string())],
                [*b.schema.names[:2], "decoded"])

    kept = encoded.select(id_col, "ids")
    return kept.mapInArrow(run, kept.select("*", F.lit("").alias("decoded")).schema)
