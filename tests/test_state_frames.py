"""The frames of a state's rows, taken together."""

import numpy as np
import pytest

from pacewatch.schema import WINDOWS
from pacewatch.streaming import state


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_frames_equal_a_walk_row_by_row(monkeypatch, limit):
    monkeypatch.setattr(state, "SPREAD_VALUES", limit)
    rng = np.random.default_rng(3)
    at = np.sort(rng.integers(0, 10 * state.DAY, 300))
    at[100:110] = at[100]
    amounts = np.where(rng.random(300) < 0.3, np.nan, rng.random(300) * 90)
    amounts[:8] = np.nan
    chosen = np.flatnonzero(rng.random(300) < 0.7)
    got = state.frames(at, amounts, chosen)
    for n, i in enumerate(chosen):
        for name, (agg, window) in state.FRAMES.items():
            frame = amounts[(at >= at[i] - WINDOWS[window]) & (at < at[i])]
            there = frame[~np.isnan(frame)]
            if agg == "count":
                want = len(frame)
            elif len(there) < (2 if agg == "stddev" else 1):
                want = None
            else:
                want = np.std(there, ddof=1) if agg == "stddev" else {"sum": np.sum, "avg": np.mean, "max": np.max, "min": np.min}[agg](there)
            assert got[name][n] == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-12))


def test_frames_of_no_rows():
    empty = state.frames(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    assert set(empty) == set(state.FRAMES) and not any(empty.values())
