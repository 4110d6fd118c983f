"""Cells of the neighbour search: which one a vector belongs to, and which others it looks through."""

import tracemalloc

import numpy as np
import pytest

from pacewatch.operators import oversample
from pacewatch.operators.oversample import Cells

RNG = np.random.default_rng(11)


def cells_of(pivots, v):
    count = len(pivots)
    own, d = Cells(pivots, np.zeros(count, np.int64), np.zeros(count)).home(v)
    sizes, radii = np.bincount(own, minlength=count), np.zeros(count)
    np.maximum.at(radii, own, d)
    return Cells(pivots, sizes, radii), own, d


def apart(v, pivots):
    return np.sqrt(((v[:, None] - pivots) ** 2).sum(2))


def test_home_of_many_vectors_takes_little_memory():
    """All distances of these at once are 160 MB."""
    v, pivots = RNG.normal(size=(10_000, 6)), RNG.normal(size=(2_000, 6))
    cells = Cells(pivots, np.zeros(2_000, np.int64), np.zeros(2_000))
    tracemalloc.start()
    own, d = cells.home(v)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6
    true = apart(v[:500], pivots)
    assert (own[:500] == true.argmin(1)).all() and np.allclose(d[:500], true.min(1), rtol=1e-14)


@pytest.mark.parametrize("shift", [0.0, 1e5, 1e8])
def test_a_vector_looks_through_every_cell_with_a_nearer_one(shift):
    """Far from zero a product is rounded to more than the distances between these."""
    v = shift + RNG.normal(size=(900, 5))
    pivots = np.concatenate([v[:60], v[:3]])
    cells, own, d = cells_of(pivots, v)
    true = apart(v, pivots)
    assert (own == true.argmin(1)).all() and (d == true.min(1)).all()
    between = apart(v, v)
    np.fill_diagonal(between, np.inf)
    within = np.sort(between, axis=1)[:, 4]
    seen = set(zip(*(x.tolist() for x in cells.visits(v, own, within))))
    needed = {(int(i), int(own[j])) for i, j in zip(*np.nonzero(between <= within[:, None])) if own[j] != own[i]}
    assert needed <= seen and all(cells.sizes[c] > 0 and c != own[i] for i, c in seen)


def test_no_number_of_compared_vectors_ends_a_search(monkeypatch):
    """However many vectors lie in cells with nearer bounds, the others are looked through too."""
    monkeypatch.setattr(oversample, "VISITED", 40)
    v = RNG.normal(size=(600, 8))
    cells, own, _ = cells_of(v[:50], v)
    row, cell = cells.visits(v, own, np.full(len(v), np.inf))
    assert (np.bincount(row) == 49).all() and len(set(zip(row.tolist(), cell.tolist()))) == len(row)


def test_rounds_take_every_visit_once_and_leave_out_those_seen():
    v = RNG.normal(size=(300, 6))
    cells, own, _ = cells_of(v[:30], v)
    within = np.where(np.arange(len(v)) % 3 == 0, np.inf, 1.5)
    whole = cells.visits(v, own, within)
    left, rounds, seen = whole, 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
    while len(left[0]):
        now = cells.begun(*left, 60)
        first = np.unique(left[0], return_index=True)[1]
        assert now[first].all()
        compared = np.bincount(left[0][now], weights=cells.sizes[left[1][now]])
        assert compared.max() < 60 + cells.sizes.max()
        seen = tuple(np.concatenate([a, b[now]]) for a, b in zip(seen, left))
        left, rounds = cells.visits(v, own, within, seen), rounds + 1
    assert rounds > 2 and sorted(zip(*seen)) == sorted(zip(*whole))


def test_vectors_without_distances_belong_to_the_first_cell():
    v = np.array([[0.0, 1.0], [np.nan, 0.0], [np.inf, 0.0], [5.0, 5.0]])
    pivots = np.array([[9.0, 9.0], [0.0, 0.0], [5.0, 5.0]])
    with np.errstate(all="ignore"):
        own, d = Cells(pivots, np.zeros(3, np.int64), np.zeros(3)).home(v)
    assert own.tolist() == [1, 0, 0, 2] and d[0] == 1 and np.isnan(d[1]) and np.isinf(d[2]) and d[3] == 0
