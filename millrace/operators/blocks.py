"""Best k rows per query inside one block of vectors, on NumPy arrays.

These are the small helpers that run inside Spark tasks.  A block is whatever one
Arrow batch holds; nothing here sees more than a batch and the queries it meets.

Scores are larger for better rows.  A matrix product finds the rows that may be
among the best, with a margin for its rounding; those are scored again pair by
pair, always in the same order of additions.  Equal vectors thus get equal scores
wherever they lie, and ties fall to the id as they should.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

METRICS = ("dot", "cosine", "l2", "l2_expanded")
ROWS_AT_ONCE = 4096
FEW_ROWS = 64
VALUES_AT_ONCE = 1 << 22
NO_ID = np.iinfo(np.int64).min


def to_matrix(column: pa.Array) -> np.ndarray:
    """List column without nulls to an n x d double matrix; rows must be equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) == 0:
        return np.empty((0, 0))
    if len(flat) % len(column) or len(set(np.diff(column.offsets.to_numpy()))) > 1:
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1).astype(np.float64)


def with_vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows that have a vector.

    Done here and not by a Spark filter, since a filter on a computed vector would be
    pushed below the computation and repeat it.
    """
    known = batch.column("vec").is_valid()
    return batch.filter(known) if batch.column("vec").null_count else batch


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN and is never a best row."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def spare_copies_dropped(ids: np.ndarray, matrix: np.ndarray, most: int, high_id_first: bool) -> np.ndarray:
    """Places of the rows without those that have ``most`` equals of better id.

    Equal vectors have equal scores, so of any number of copies only the first few by
    id can be among the best.  Sorting by one weighted sum brings copies together; a
    copy it should fail to bring together is merely kept.
    """
    weights = np.random.default_rng(0).normal(size=matrix.shape[1])
    order = np.lexsort((-ids if high_id_first else ids, (matrix * weights).sum(axis=1)))
    near = matrix[order]
    same = np.zeros(len(ids), dtype=bool)
    same[1:] = (near[1:] == near[:-1]).all(axis=1)
    if not same.any():
        return np.arange(len(ids))
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
    return order[np.arange(len(ids)) - start < most]


@dataclass(frozen=True)
class Queries:
    """Query vectors of one block: ids, the row id each must not return, vectors."""

    ids: np.ndarray
    skip: np.ndarray
    matrix: np.ndarray

    @classmethod
    def from_arrow(cls, ids: pa.Array, skip: pa.Array, vec: pa.Array, metric: str) -> Queries:
        matrix = to_matrix(vec)
        return cls(
            ids.to_numpy(zero_copy_only=False),
            skip.fill_null(NO_ID).to_numpy(zero_copy_only=False),
            unit_rows(matrix) if metric == "cosine" else matrix,
        )

    @classmethod
    def from_table(cls, table: pa.Table, id_name: str, metric: str) -> Queries:
        return cls.from_arrow(
            *(table.column(name).combine_chunks() for name in (id_name, "skip", "vec")), metric)

    def __len__(self) -> int:
        return len(self.ids)


class Best:
    """The best k (score, id) seen so far for each query."""

    def __init__(self, queries: Queries, k: int, metric: str, high_id_first: bool, query_block: int):
        self.queries, self.k, self.metric = queries, k, metric
        self.high_id_first, self.query_block = high_id_first, query_block
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), NO_ID, dtype=np.int64)
        #: Scores below this are not wanted.
        self.floor = np.full(len(queries), -np.inf)

    def bar(self, places: np.ndarray) -> np.ndarray:
        """What a score of these queries must reach to count."""
        return np.maximum(self.scores[places, -1], self.floor[places])

    def scan(self, ids: np.ndarray, matrix: np.ndarray, only: np.ndarray | None = None) -> None:
        """Offer rows to all queries, or to the queries at the positions in ``only``."""
        if self.metric == "cosine":
            matrix = unit_rows(matrix)
        if len(ids) > FEW_ROWS:
            wanted = spare_copies_dropped(ids, matrix, self.k + 1, self.high_id_first)
            ids, matrix = ids[wanted], matrix[wanted]
        places = np.arange(len(self.queries)) if only is None else only
        for start in range(0, len(ids), ROWS_AT_ONCE):
            rows = slice(start, start + ROWS_AT_ONCE)
            for first in range(0, len(places), self.query_block):
                self._scan_block(ids[rows], matrix[rows], places[first:first + self.query_block])

    def _scan_block(self, ids: np.ndarray, matrix: np.ndarray, places: np.ndarray) -> None:
        asked = self.queries.matrix[places]
        rough, margin = self._rough_scores(matrix, asked)
        skip = self.queries.skip[places]
        own = np.flatnonzero(np.isin(ids, skip[skip != NO_ID]))
        row, col = np.nonzero(ids[own][:, None] == skip[None, :])
        rough[own[row], col] = -np.inf
        bar = self.bar(places)
        found = self._reaching(rough, bar - margin)
        if len(ids) > self.k and len(found) > 4 * self.k * len(places):
            # Mostly the scores so far leave few; the k-th best of these rows is dear to find for more than one.
            best = rough.max(axis=0) if self.k == 1 else np.partition(rough, -self.k, axis=0)[-self.k]
            found = self._reaching(rough, np.maximum(bar, best) - margin)
        row, col = np.divmod(found, len(places))
        step = max(1, VALUES_AT_ONCE // max(1, matrix.shape[1]))
        for first in range(0, len(row), step):
            r, c = row[first:first + step], col[first:first + step]
            self._offer(places[c], self._exact_scores(matrix[r], asked[c]), ids[r])

    @staticmethod
    def _reaching(rough: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """Flat places of the scores that reach the bar, and are scores."""
        return np.flatnonzero(rough >= np.maximum(bar, np.finfo(np.float64).min))

    def _rough_scores(self, matrix: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rounding = 32 * (matrix.shape[1] + 4) * np.finfo(np.float64).eps
        with np.errstate(invalid="ignore", over="ignore"):
            here, there = (matrix * matrix).sum(axis=1), (asked * asked).sum(axis=1)
            product = matrix @ asked.T
            if self.metric.startswith("l2"):
                product *= 2
                product -= here[:, None]
                product -= there[None, :]
            margin = rounding * (np.nan_to_num(here).max(initial=0.0) + np.nan_to_num(there))
            if not (np.isfinite(here).all() and np.isfinite(there).all()):
                product[~(product > -np.inf)] = -np.inf
        return product, margin

    def _exact_scores(self, rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
        if self.metric == "l2":
            return -((rows - asked) ** 2).sum(axis=1)
        product = (rows * asked).sum(axis=1)
        if self.metric == "l2_expanded":
            return 2 * product - (rows * rows).sum(axis=1) - (asked * asked).sum(axis=1)
        return product

    def _offer(self, places: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(places)
        known = self.scores[touched].ravel()
        held = known > -np.inf
        places = np.concatenate([np.repeat(touched, self.k)[held], places])
        scores = np.concatenate([known[held], scores])
        ids = np.concatenate([self.ids[touched].ravel()[held], ids])
        order = np.lexsort((-ids if self.high_id_first else ids, -scores, places))
        places, scores, ids = places[order], scores[order], ids[order]
        fresh = np.ones(len(places), dtype=bool)
        fresh[1:] = (places[1:] != places[:-1]) | (ids[1:] != ids[:-1])
        places, scores, ids = places[fresh], scores[fresh], ids[fresh]
        rank = np.arange(len(places)) - np.searchsorted(places, places)
        kept = rank < self.k
        self.scores[touched], self.ids[touched] = -np.inf, NO_ID
        self.scores[places[kept], rank[kept]] = scores[kept]
        self.ids[places[kept], rank[kept]] = ids[kept]

    def rows(self) -> pa.RecordBatch:
        """What was found, as ``qid, id, score``."""
        place, slot = np.nonzero(self.scores > -np.inf)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.queries.ids[place]), pa.array(self.ids[place, slot]),
             pa.array(self.scores[place, slot])],
            names=["qid", "id", "score"],
        )
