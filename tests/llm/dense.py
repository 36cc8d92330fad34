"""Dense twins of sparse rows, for tests."""

import numpy as np

from trendlens.llm.csr import CSR


def to_rows(matrix) -> CSR:
    rows, cols = np.nonzero(matrix)
    return CSR(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(matrix)))]), cols, matrix.shape[1])


def of(m: CSR) -> np.ndarray:
    out = np.zeros((m.rows, m.columns), int)
    out[m.row_of(), m.indices] = 1 if m.data is None else m.data
    return out
