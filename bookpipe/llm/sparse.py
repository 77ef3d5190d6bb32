"""Sparse matrices of whole numbers in compressed rows, and their products."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Single products formed at a time.
BLOCK = 4 << 20


class Csr(NamedTuple):
    """Row i holds ``values[bounds[i]:bounds[i + 1]]`` in columns ``columns[...]``."""

    bounds: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.bounds) - 1

    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.bounds))

    def row_sums(self) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(self.values)])
        return before[self.bounds[1:]] - before[self.bounds[:-1]]


def runs(lengths: np.ndarray) -> Csr:
    """Row i has a one in each of the next ``lengths[i]`` columns: what a token covers."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(bounds, np.arange(bounds[-1]), np.ones(bounds[-1], dtype="int64"), int(bounds[-1]))


def one_each(columns: np.ndarray, width: int) -> Csr:
    """Row i has a single one, in ``columns[i]``."""
    return Csr(np.arange(len(columns) + 1), columns, np.ones(len(columns), dtype="int64"), width)


def summed(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Csr:
    """A matrix of entries in any order; entries of one cell are added up."""
    key = rows * width + columns
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype="int64")
    key, values = key[first], np.add.reduceat(values, first) if len(first) else values
    bounds = np.searchsorted(key, np.arange(height + 1) * width)
    return Csr(bounds, key % max(width, 1), values, width)


def transposed(m: Csr) -> Csr:
    return summed(m.columns, m.row_of(), m.values, m.width, m.height)


def product(a: Csr, b: Csr, block: int = BLOCK) -> Csr:
    """A B by rows (Gustavson): row i is the sum of B's rows k that row i of A names, times A's values.

    Rows of A are taken in blocks that form at most ``block`` single products, or one row.
    """
    sizes = np.diff(b.bounds)[a.columns]
    formed = np.concatenate([[0], np.cumsum(sizes)])[a.bounds]
    parts, start = [], 0
    while start < a.height:
        stop = max(start + 1, int(np.searchsorted(formed, formed[start] + block, side="right")) - 1)
        low, high = a.bounds[start], a.bounds[stop]
        named, size = a.columns[low:high], sizes[low:high]
        rows = np.repeat(np.repeat(np.arange(stop - start), np.diff(a.bounds[start : stop + 1])), size)
        at = np.arange(len(rows)) + np.repeat(b.bounds[named] - (np.cumsum(size) - size), size)
        values = np.repeat(a.values[low:high], size) * b.values[at]
        parts.append(summed(rows, b.columns[at], values, stop - start, b.width))
        start = stop
    if not parts:
        return Csr(np.zeros(1, dtype="int64"), np.zeros(0, dtype="int64"), np.zeros(0, dtype="int64"), b.width)
    offsets = np.cumsum([0, *(p.bounds[-1] for p in parts[:-1])])
    bounds = np.concatenate([[0], *(p.bounds[1:] + o for p, o in zip(parts, offsets, strict=True))])
    return Csr(bounds, np.concatenate([p.columns for p in parts]), np.concatenate([p.values for p in parts]), b.width)
