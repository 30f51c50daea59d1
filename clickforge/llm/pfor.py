"""Token file format: patched frame-of-reference blocks.

Layout, all little-endian: the blocks; the index (u64 offset of each block, i64 id and u8
null flag of each document, u64 number of the first token of each document and of the end);
the trailer (magic, u32 values in a block, u64 blocks, u64 documents, u64 place of the index).

A block holds ``BLOCK_VALUES`` ids (the last one fewer): a header (u32 values, u32 minimum,
u32 width, u32 exceptions); the ids less the minimum packed at the width, value i at bit
i * width; and the exceptions, u32 positions and u32 values. The width is what the 90th
percentile needs: larger values keep their low bits in place and stand among the exceptions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

MAGIC = b"CFPFOR01"
BLOCK_VALUES = 16_384
PERCENTILE = 90
_TRAILER = np.dtype([("magic", "S8"), ("values", "<u4"), ("blocks", "<u8"), ("docs", "<u8"),
                     ("index", "<u8")])


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of unsigned values, one after the other. 32 values fill
    ``width`` words, so each of 32 columns is shifted for all rows at once."""
    if width == 0:
        return b""
    rows = -(-len(values) // 32)
    v = np.zeros((rows, 32), np.uint64)
    v.ravel()[:len(values)] = values & np.uint64((1 << width) - 1)
    out = np.zeros((rows, width + 1), np.uint64)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        both = v[:, i] << np.uint64(shift)
        out[:, word] |= both & np.uint64(0xFFFFFFFF)
        out[:, word + 1] |= both >> np.uint64(32)
    return out[:, :width].astype("<u4").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width == 0:
        return np.zeros(n, np.uint64)
    words = np.frombuffer(data, "<u4").reshape(-1, width).astype(np.uint64)
    words = np.concatenate((words, np.zeros((len(words), 1), np.uint64)), axis=1)
    out = np.empty((len(words), 32), np.uint64)
    for i in range(32):
        word, shift = divmod(i * width, 32)
        both = words[:, word] | words[:, word + 1] << np.uint64(32)
        out[:, i] = both >> np.uint64(shift) & np.uint64((1 << width) - 1)
    return out.ravel()[:n]


def encode_block(ids: np.ndarray) -> bytes:
    """One block of at least one unsigned 32-bit id."""
    low = int(ids.min())
    rest = ids.astype(np.uint64) - np.uint64(low)
    at = -(-PERCENTILE * (len(rest) - 1) // 100)  # of the sorted values
    width = int(np.partition(rest, at)[at]).bit_length()
    over = np.flatnonzero(rest >> np.uint64(width))
    head = np.array([len(ids), low, width, len(over)], "<u4")
    return b"".join((head.tobytes(), pack(rest, width), over.astype("<u4").tobytes(),
                     rest[over].astype("<u4").tobytes()))


def decode_block(data: bytes) -> np.ndarray:
    n, low, width, over = np.frombuffer(data, "<u4", 4).tolist()
    end = 16 + 4 * width * -(-n // 32)
    rest = unpack(data[16:end], n, width)
    rest[np.frombuffer(data, "<u4", over, end)] = np.frombuffer(data, "<u4", over, end + 4 * over)
    return (rest + np.uint64(low)).astype("<u4")


class Writer:
    """Writes documents' ids to a stream, holding one block and the index."""

    def __init__(self, out: BinaryIO):
        self.out, self.place, self.tokens = out, 0, 0
        self.held, self.n_held = [], 0
        self.offsets, self.ids, self.nulls, self.starts = [], [], [], [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.tokens += len(ids)
        self.starts.append(self.tokens)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_VALUES:
            all_held = np.concatenate(self.held)
            full = len(all_held) // BLOCK_VALUES * BLOCK_VALUES
            for at in range(0, full, BLOCK_VALUES):
                self._block(all_held[at:at + BLOCK_VALUES])
            self.held, self.n_held = [all_held[full:]], len(all_held) - full

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.place)
        self._write(encode_block(ids))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.place += len(data)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        index = self.place
        for values, kind in ((self.offsets, "<u8"), (self.ids, "<i8"), (self.nulls, "u1"),
                             (self.starts, "<u8")):
            self._write(np.array(values, kind).tobytes())
        self._write(np.array([(MAGIC, BLOCK_VALUES, len(self.offsets), len(self.ids), index)],
                             _TRAILER).tobytes())


class Reader:
    """Reads documents from a seekable file by its index, a few blocks at a time."""

    def __init__(self, file: BinaryIO, size: int):
        self.file = file
        end = np.frombuffer(self._read(size - _TRAILER.itemsize, _TRAILER.itemsize), _TRAILER)[0]
        if end["magic"] != MAGIC:
            raise ValueError("not a token file")
        self.values, n, m, at = (int(end[c]) for c in ("values", "blocks", "docs", "index"))
        index = self._read(at, size - _TRAILER.itemsize - at)
        self.offsets = [*np.frombuffer(index, "<u8", n).tolist(), at]
        self.ids = np.frombuffer(index, "<i8", m, 8 * n)
        self.nulls = np.frombuffer(index, "u1", m, 8 * (n + m))
        self.starts = np.frombuffer(index, "<u8", m + 1, 8 * (n + m) + m).astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, i: int) -> np.ndarray:
        return decode_block(self._read(self.offsets[i], self.offsets[i + 1] - self.offsets[i]))

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, by random access."""
        return next(self._between([(int(self.starts[i]), int(self.starts[i + 1]))]))

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, number of the first token, ids) of every document in order; each block is
        decoded once."""
        spans = list(zip(self.starts[:-1].tolist(), self.starts[1:].tolist()))
        for i, (span, ids) in enumerate(zip(spans, self._between(spans))):
            yield None if self.nulls[i] else int(self.ids[i]), span[0], ids

    def _between(self, spans: list[tuple[int, int]]) -> Iterator[np.ndarray]:
        at, block = -1, np.zeros(0, "<u4")
        for start, end in spans:
            out = []
            while start < end:
                if start // self.values != at:
                    at = start // self.values
                    block = self.block(at)
                part = block[start - at * self.values:end - at * self.values]
                out.append(part)
                start += len(part)
            yield np.concatenate(out) if out else block[:0]
