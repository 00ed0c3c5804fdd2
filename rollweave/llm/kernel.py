"""Words, lines and shingles of whole Arrow text columns as numpy arrays, without a Python loop over words.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. UTF-8 continuation bytes never fall into that
set, so working on bytes equals working on code points. Hashes are 64 bit polynomials over the bytes,
mixed at the end; they depend on the word alone, not on its place.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NEWLINE = 10
BLOCK = 1 << 20

#: Calls that drop what a step remembers in its worker from task to task.
FORGET: list[Callable[[], object]] = []
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library
    _trim = None

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, dtype=np.uint64)


def give_back(forget: bool = True) -> None:
    """Memory that a task has freed goes to the system; ``forget`` drops what other steps remember here.

    A worker lives on between tasks and serves all steps, while its allocators keep what they once got.
    """
    for drop in FORGET if forget else ():
        drop()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def lean(run, forget: bool = True):
    """``run`` over a task's Arrow batches, then ``give_back``."""

    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back(forget)

    return task


def lean_group(run):
    """``run`` on a group, then ``give_back``."""

    @wraps(run)
    def group(table):
        try:
            return run(table)
        finally:
            give_back()

    return group


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base; the table grows with the longest word seen."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        table = np.full(size, _BASE, dtype=np.uint64)
        table[0] = 1
        _powers = np.cumprod(table, dtype=np.uint64)
    return _powers[:n]


@dataclass(frozen=True)
class Texts:
    """Rows ``first ..`` of a column: their bytes on end, and where each row starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


@dataclass(frozen=True)
class Words:
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    #: Of each row, its first word; one more at the end.
    bounds: np.ndarray


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[Texts]:
    """The column in runs of whole rows of about ``limit`` bytes; one longer text is a run of its own."""
    data, offsets = raw_text(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def _cuts(data: np.ndarray, edges: np.ndarray) -> list[int]:
    """Places that end a block: behind a white-space byte, or where a row starts."""
    cuts, at = [], 0
    while len(data) - at > BLOCK:
        near = at + BLOCK
        space = np.flatnonzero(SPACE[data[near : near + 4096]])
        row = int(edges[np.searchsorted(edges, near)])
        if len(space):
            at = min(row, near + int(space[0]) + 1)
        else:
            rest = np.flatnonzero(SPACE[data[near:row]])
            at = near + int(rest[0]) + 1 if len(rest) else row
        cuts.append(at)
    return [*cuts, len(data)] if not cuts or cuts[-1] < len(data) else cuts


def words(texts: Texts, lower: bool = False) -> Words:
    """All words with their places and hashes; ``lower`` folds A-Z."""
    data, offsets = texts.data, texts.offsets
    starts, ends, hashes, at = [], [], [], 0
    for cut in _cuts(data, offsets) if len(data) else []:
        part = data[at:cut]
        space = SPACE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, cut, side="right")] - at] = True
        edge[0] = edge[-1] = True
        solid = ~space
        before, behind = np.empty_like(space), np.empty_like(space)
        before[0] = behind[-1] = True
        before[1:], behind[:-1] = space[:-1], space[1:]
        start = np.flatnonzero(solid & (before | edge[:-1]))
        end = np.flatnonzero(solid & (behind | edge[1:])) + 1
        if len(start):
            length = end - start
            first = np.cumsum(length) - length
            value = (LOWER[part] if lower else part)[solid].astype(np.uint64) + np.uint64(1)
            place = np.arange(len(value)) - np.repeat(first, length)
            hashes.append(np.add.reduceat(value * powers(int(length.max()))[place], first) + length.astype(np.uint64))
            starts.append(start + at)
            ends.append(end + at)
        at = cut
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64))
    start = np.concatenate(starts)
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, np.concatenate(ends), row, mix(np.concatenate(hashes)), np.searchsorted(start, offsets))


def factors(n: int) -> np.ndarray:
    """Odd multipliers that make a sum of hashes depend on their order."""
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` hashes."""
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k, factor in enumerate(factors(width)):
        out += hashes[k : k + len(out)] * factor
    return mix(out + np.uint64(width))


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One hash of each stretch of consecutive hashes (all of ``hashes`` in order, no gaps)."""
    if not len(first):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(len(hashes)) - np.repeat(first, length)
    powered = hashes * powers(int(length.max()) + 1)[place]
    sums = np.zeros(len(first), dtype=np.uint64)
    full = length > 0
    if len(hashes):
        sums[full] = np.add.reduceat(powered, first[full])
    return mix(sums + length.astype(np.uint64))


def shingle_sets(found: Words, rows: int, width: int) -> Iterator[np.ndarray]:
    """Of each row, its distinct shingle hashes in ascending order.

    A row of fewer words than ``width`` has its whole sequence as one shingle; a row without words none.
    """
    whole = windows(found.hash, width)
    for row in range(rows):
        first, last = int(found.bounds[row]), int(found.bounds[row + 1])
        if last - first >= width:
            yield np.unique(whole[first : last - width + 1])
        elif last > first:
            yield windows(found.hash[first:last], last - first)
        else:
            yield np.zeros(0, dtype=np.uint64)


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Start of each line (split at ``\\n``; an empty text is one empty line) and the first line of each row."""
    breaks = np.flatnonzero(texts.data == NEWLINE) + 1
    start = np.sort(np.concatenate([texts.offsets[:-1], breaks]), kind="stable")
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    row_of_break = np.searchsorted(texts.offsets[1:], breaks - 1, side="right")
    first[1:] = np.cumsum(np.bincount(row_of_break, minlength=len(texts)) + 1)
    return start, first


def signed(x: np.ndarray) -> np.ndarray:
    """64 bit hashes as Spark's long."""
    return x.view(np.int64)
