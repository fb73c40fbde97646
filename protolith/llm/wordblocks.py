"""Texts as word numbers: blocks of neighbouring texts with a dictionary of their own.

A block is bounded by its bytes, so work on a whole block is a few array passes and needs memory for
the block only.  Its dictionary holds exact words; nothing rests on a hash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

from .textkit import Block, word_spans

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]


def byte_set(*codes: int) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(codes)] = True
    return out


class Words(NamedTuple):
    code: np.ndarray         # int32, number of each word occurrence in ``words``
    start: np.ndarray        # byte places in the block
    stop: np.ndarray
    owner: np.ndarray        # text of the block
    words: pa.Array          # large_binary, distinct, A-Z lower-cased


def encode_words(block: Block, separators: np.ndarray) -> Words:
    """Number the words of a block (runs of bytes that are no separators) by first occurrence."""
    start, stop, owner = word_spans(block, separators)
    offsets = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(stop - start, out=offsets[1:])
    letters = LOWER[block.data[~separators[block.data]]] if len(start) else np.zeros(0, np.uint8)
    all_words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    found = all_words.dictionary_encode()
    return Words(found.indices.to_numpy(zero_copy_only=False).astype(np.int32), start, stop, owner, found.dictionary)


def word_hashes(block: Block, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start, stop and text number of every word of a block.

    Each distinct word is hashed once as a whole; unlike sums of powers, xxHash has no words of a simple
    pattern that meet.
    """
    found = encode_words(block, separators)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, found.words.to_pylist()), dtype=np.uint64, count=len(found.words))
    return each[found.code] if len(each) else np.zeros(0, np.uint64), found.start, found.stop, found.owner


def pack_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a word array that starts at its first value."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = words.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def unpack_words(data: bytes | pa.Buffer, offsets: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data, dtype=np.uint8), np.frombuffer(offsets, dtype=np.int64)
