"""Word shingles of whole texts, hashed for a batch of documents at a time.

A text is lower-cased in A-Z only and split at the six ASCII white-space bytes. Its
tokens are its distinct ``WIDTH``-word shingles as hashes of ``TOKEN_BITS`` bits; a text of
fewer words has one token, the whole sequence; a text without words has none. All
work is array arithmetic over the bytes of a bounded chunk of documents; of a longer text, over pieces cut
at white space, and a word longer than a piece is summed up in parts.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
TOKEN_BITS = 54
CHUNK_BYTES = 1 << 20
CHUNK_DOCS = 1 << (64 - TOKEN_BITS)

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every bit depends on all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers = {_BASE: np.ones(1, _U), _BASE_INVERSE: np.ones(1, _U)}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < n:
        with np.errstate(over="ignore"):
            known = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(n - 1, base, _U)]))
        _powers[base] = known
    return known[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``CHUNK_BYTES`` together, or one longer document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), first + CHUNK_DOCS, n)
        yield first, last
        first = last


def _long_words(data: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the words of one text, a piece of about ``CHUNK_BYTES`` at a time."""
    low, n = 0, len(data)
    while low < n:
        high = min(low + CHUNK_BYTES, n)
        spaces = np.flatnonzero(_SPACE[data[low:high]])
        if high == n or len(spaces):
            high = n if high == n else low + int(spaces[-1]) + 1
            yield _words(data[low:high], np.array([0, high - low]))[0]
        else:
            whole, offset = 0, 0
            while low < n and not _SPACE[data[low]]:
                part = data[low:low + CHUNK_BYTES]
                spaces = np.flatnonzero(_SPACE[part])
                part = part[:spaces[0]] if len(spaces) else part
                with np.errstate(over="ignore"):
                    value = int((_OF_BYTE[_LOWER[part]] * _power(_BASE, len(part))).sum())
                whole = (whole + value * pow(_BASE, offset, 1 << 64)) % (1 << 64)
                low, offset = low + len(part), offset + len(part)
            with np.errstate(over="ignore"):
                yield mix(np.array([whole], _U))
            continue
        low = high


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of each word; ``bounds`` are the documents' byte offsets."""
    if len(bounds) == 2 and len(data) > CHUNK_BYTES:
        hashes = np.concatenate(list(_long_words(data)))
        return hashes, np.zeros(len(hashes), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_OF_BYTE[_LOWER[data]] * _power(_BASE, len(data)), out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * _power(_BASE_INVERSE, len(data))[starts])
    return hashes, np.searchsorted(bounds, starts, "right") - 1


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of a chunk in order of (document, token): document numbers and tokens."""
    n_docs = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    hashes, doc = _words(data, bounds)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    with np.errstate(over="ignore"):
        steps = np.array([pow(_STEP, k, 1 << 64) for k in range(WIDTH)], _U)
        n = len(hashes) - WIDTH + 1
        found, owner = np.zeros(0, _U), np.zeros(0, np.int64)
        if n > 0:
            whole = np.zeros(n, _U)
            for k in range(WIDTH):
                whole += hashes[k:k + n] * steps[k]
            same = doc[:n] == doc[WIDTH - 1:]
            found, owner = whole[same], doc[:n][same]
        count = np.bincount(doc, minlength=n_docs)
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        for length in range(1, WIDTH):
            short = np.flatnonzero(count == length)
            if len(short):
                whole = np.full(len(short), length, _U)
                for k in range(length):
                    whole += hashes[first[short] + k] * steps[k]
                found, owner = np.concatenate([found, whole]), np.concatenate([owner, short])
        keys = (mix(found) >> _U(64 - TOKEN_BITS)) | (owner.astype(_U) << _U(TOKEN_BITS))
    keys = np.unique(keys)
    return (keys >> _U(TOKEN_BITS)).astype(np.int64), keys & _U((1 << TOKEN_BITS) - 1)


class TokenSets:
    """Token sets of one chunk: documents ``first`` to ``last`` of a batch."""

    def __init__(self, first: int, last: int, doc: np.ndarray, token: np.ndarray):
        self.first, self.last, self.doc, self.token = first, last, doc, token
        self.size = np.bincount(doc, minlength=last - first).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        with np.errstate(over="ignore"):
            digest = np.zeros(last - first, _U)
            np.add.at(digest, doc, mix(token + _U(1)))
            self.set_id = mix(digest ^ mix(self.size.astype(_U))).view(np.int64)


#: Module in which a worker process keeps its tokenizers from task to task.
TOKENIZERS = "_tickloom_tokenizers"


def make_room() -> None:
    """Drop the tokenizers that tasks of an earlier stage left in this worker process."""
    if sys.modules.pop(TOKENIZERS, None) is not None:
        gc.collect()
        release()


def release() -> None:
    """Hand the memory of freed arrays back to the system, as worker processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def token_sets(column: pa.Array) -> Iterator[TokenSets]:
    offsets, data = text_buffers(column)
    for first, last in chunks(offsets):
        low, high = offsets[first], offsets[last]
        yield TokenSets(first, last, *tokens(data[low:high], offsets[first:last + 1] - low))
    release()
