"""Sparse incidence matrices in compressed rows, and their products row by row (Gustavson)."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 21         # products expanded at a time


class CSR:
    """Row i holds the columns indices[indptr[i]:indptr[i + 1]], ascending; `data` their values (ones where None)."""

    __slots__ = ("indptr", "indices", "columns", "data")

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, columns: int, data: np.ndarray | None = None):
        self.indptr, self.indices, self.columns, self.data = indptr, indices, columns, data

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.indptr)

    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.rows), self.sizes())

    def transposed(self) -> CSR:
        """Columns as rows, by a counting sort of the entries (which ascending columns are already)."""
        if np.all(self.indices[1:] >= self.indices[:-1]):
            order, rows = None, self.row_of()
        else:
            order = np.argsort(self.indices, kind="stable")
            rows = self.row_of()[order]
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return CSR(indptr, rows, self.rows, None if self.data is None else self.data if order is None else self.data[order])

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The product with a column vector."""
        terms = vector[self.indices] if self.data is None else vector[self.indices] * self.data
        upto = np.concatenate([np.zeros(1, terms.dtype), np.cumsum(terms)])
        return upto[self.indptr[1:]] - upto[self.indptr[:-1]]


def spans(ends: np.ndarray, columns: int) -> CSR:
    """Row i holds every column from ends[i - 1] (0 for the first row) to ends[i] - 1."""
    return CSR(np.concatenate([[0], ends]), np.arange(columns), columns)


def labels(of_row: np.ndarray, columns: int) -> CSR:
    """Row i holds the one column of_row[i]."""
    return CSR(np.arange(len(of_row) + 1), of_row, columns)


def product_sizes(a: CSR, b: CSR) -> np.ndarray:
    """For each row of a·b the number of products that are summed into it: its entries, where no two meet."""
    return CSR(a.indptr, a.indices, a.columns).times(b.sizes())


def product(a: CSR, b: CSR) -> CSR:
    """a·b of incidence matrices: each row of a brings the rows of b that it names, and equal columns are summed.
    Rows are taken in blocks of about BLOCK products."""
    upto = np.concatenate([[0], np.cumsum(product_sizes(a, b))])
    cuts, at = [0], 0
    while at < a.rows:
        at = max(at + 1, int(np.searchsorted(upto, upto[at] + BLOCK, "right")) - 1)
        cuts.append(min(at, a.rows))
    single = b.rows == len(b.indices) and bool(np.all(b.sizes() == 1))
    sizes, columns, data = [], [], []
    for low, high in zip(cuts, cuts[1:], strict=False):
        first, last = a.indptr[low], a.indptr[high]
        inner = a.indices[first:last]
        row = np.repeat(np.arange(high - low), np.diff(a.indptr[low:high + 1]))
        if single:
            col = b.indices[inner]
        else:
            width = b.indptr[inner + 1] - b.indptr[inner]
            skip = np.cumsum(width) - width
            col = b.indices[np.arange(width.sum()) + np.repeat(b.indptr[inner] - skip, width)]
            row = np.repeat(row, width)
        if np.any((row[1:] == row[:-1]) & (col[1:] < col[:-1])):
            order = np.lexsort((col, row))
            row, col = row[order], col[order]
        start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (col[1:] != col[:-1])])) if len(row) else np.zeros(0, np.int64)
        sizes.append(np.bincount(row[start], minlength=high - low))
        columns.append(col[start])
        data.append(np.diff(np.append(start, len(row))))
    indptr = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return CSR(indptr, join(columns), b.columns, join(data))
