"""Vectorised word hashing for Pandas UDFs.

A batch of texts is cut into blocks of bounded size (a single text may be
longer, it is then cut at white space), and each block becomes numpy arrays:
one 64-bit hash and one document index per word. UTF-8 bytes of the separator
characters never occur inside a longer character, so bytes are enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BLOCK_BYTES = 1 << 19
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MUL = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
IS_SPACE.setflags(write=False)

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(n, _U(base))
        p[0] = _U(1)
        np.multiply.accumulate(p, out=p)
        out.append(p)
    if n <= 2 * BLOCK_BYTES:
        _powers[:] = out
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby inputs get unrelated outputs."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Block:
    """Words of a few whole documents, or of one long document."""

    first: int            # index of the first document in the batch
    n_docs: int
    data: list[bytes]     # their UTF-8 bytes
    hashes: np.ndarray    # one per word
    doc: np.ndarray       # document of each word, from 0 within the block
    n_words: np.ndarray   # per document


def _hash_piece(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one byte array."""
    inside = np.empty(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(IS_SPACE[b], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    power, inverse = _power_tables(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[b] * power[: len(b)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64)), start


def _cuts(b: np.ndarray) -> Iterator[np.ndarray]:
    """A long byte array in pieces of about BLOCK_BYTES, cut at white space."""
    at = 0
    while at < len(b):
        end = at + BLOCK_BYTES
        while end < len(b):
            near = np.flatnonzero(IS_SPACE[b[end:end + BLOCK_BYTES]])
            if len(near):
                end += int(near[0])
                break
            end += BLOCK_BYTES
        yield b[at:end]
        at = end


def blocks(data: list[bytes]) -> Iterator[Block]:
    """Blocks over a batch of UTF-8 texts, in order; every document is in
    exactly one block, whole."""
    i = 0
    while i < len(data):
        j, size = i, 0
        while j < len(data) and (j == i or size + len(data[j]) <= BLOCK_BYTES):
            size += len(data[j]) + 1
            j += 1
        part = data[i:j]
        if j == i + 1 and size > 2 * BLOCK_BYTES:
            found = [_hash_piece(p)[0] for p in _cuts(np.frombuffer(part[0], np.uint8))]
            h = np.concatenate(found) if found else np.empty(0, np.uint64)
            doc = np.zeros(len(h), np.int64)
        else:
            h, start = _hash_piece(np.frombuffer(b"\n".join(part), np.uint8))
            begins = np.cumsum([0] + [len(x) + 1 for x in part[:-1]])
            doc = np.searchsorted(begins, start, side="right") - 1
        yield Block(i, j - i, part, h, doc, np.bincount(doc, minlength=j - i))
        i = j


def windows(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``width`` words inside a document."""
    h, n = block.hashes, len(block.hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = h[:n] * _MUL[0]
    for k in range(1, width):
        w = w + h[k:n + k] * _MUL[k]
    whole = block.doc[:n] == block.doc[width - 1:]
    return np.where(whole, mix(w), _U(0)), np.where(whole, block.doc[:n], -1)
