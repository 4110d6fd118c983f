"""How an account's days lie in the state: together while they are few rows, else day by day."""

import random

import pytest

from pacewatch.streaming import state
from pacewatch.streaming.state import DAY, AccountFeatures

START = 1_704_067_200


class Map:
    def __init__(self):
        self.held, self.puts, self.gets = {}, 0, 0

    def getValue(self, key):  # noqa: N802
        self.gets += 1
        return self.held.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.puts += 1
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.held[key]

    def keys(self):
        return iter(list(self.held))

    def iterator(self):
        return iter(list(self.held.items()))


class Value:
    held = None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Handle:
    """One account's state in memory, and its clock."""

    def __init__(self):
        self.days, self.mark, self.watermark, self.timers = Map(), Value(), 0, []

    def getMapState(self, *_):  # noqa: N802
        return self.days

    def getValueState(self, *_):  # noqa: N802
        return self.mark

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark

    def feed(self, rows, lateness=60 * DAY):
        account = AccountFeatures()
        account.init(self)
        given = iter([(i, "a", None, s * 1_000_000, amount, at, 0, 0) for i, s, amount, at in rows])
        out = [r.asDict() for r in account.handleInputRows(("a",), given, self)]
        self.watermark = max(self.watermark, (max(r[1] for r in rows) - lateness) * 1000)
        each = [dict(zip(state._LISTED, values)) for r in out for values in zip(*(r[name] for name in state._LISTED))]
        return sorted(each, key=lambda r: (r["event_micros"], r["transaction_id"]))

    def entries(self):
        return sorted(day for (day,) in self.days.held)


def batches(days=30, n=40):
    rng = random.Random(days)
    made = [[(f"t{b}_{k}", START + rng.randrange(days * DAY), rng.choice([None, 2.0, rng.random() * 90]), k) for k in range(n)] for b in range(4)]
    made[2] += [(i, s, 777.0, at - 1) for i, s, _, at in made[0][:5]] + [(i, s, 5.0, at + 1) for i, s, _, at in made[0][5:9]]
    return made


def test_an_account_of_few_rows_is_written_in_one_message():
    handle = Handle()
    for n, rows in enumerate(batches(), 1):
        handle.feed(rows)
        assert len(handle.days.held) == 1 and handle.days.puts == n


@pytest.mark.parametrize("lateness", [60 * DAY, 3 * DAY])
@pytest.mark.parametrize("at_once", [40, 6])
@pytest.mark.parametrize("together", [0, 25, 60])
def test_rows_out_do_not_depend_on_how_days_lie(monkeypatch, together, at_once, lateness):
    def outputs():
        handle = Handle()
        later = [(f"z{k}", START + (50 + k) * DAY, 1.0, k) for k in range(4)]
        got = [handle.feed(rows, lateness) for rows in [*batches(), later, [("end", START + 54 * DAY, 3.0, 0)]]]
        return got, handle.mark.held[:3], handle

    want, mark, _ = outputs()
    monkeypatch.setattr(state, "TOGETHER", together)
    monkeypatch.setattr(state, "AT_ONCE", at_once)
    got, marked, handle = outputs()
    assert got == want and marked == mark
    assert handle.mark.held[3] == len(handle.entries())


def test_an_account_that_grows_and_shrinks_changes_its_entries(monkeypatch):
    monkeypatch.setattr(state, "TOGETHER", 30)
    handle = Handle()
    handle.feed([(f"a{k}", START + k * DAY, 1.0, k) for k in range(20)])
    assert len(handle.entries()) == 1
    handle.feed([(f"b{k}", START + k * DAY, 1.0, k) for k in range(20)])
    assert handle.entries() == [START // DAY + k for k in range(20)]
    handle.feed([("c", START + 40 * DAY, 1.0, 0)], lateness=DAY)
    handle.feed([("d", START + 41 * DAY, 1.0, 0)], lateness=DAY)
    assert len(handle.entries()) == 1 and handle.mark.held[1:] == (START + 19 * DAY, (START + 41 * DAY + state.REACH + 1) * 1000, 1)


def test_an_output_holds_a_bounded_number_of_rows(monkeypatch):
    handle = Handle()
    monkeypatch.setattr(state, "CHUNK", 7)
    account = AccountFeatures()
    account.init(handle)
    given = iter([(f"t{k}", "a", None, (START + k) * 1_000_000, 1.0, k, 0, 0) for k in range(30)])
    sizes = [len(r["transaction_id"]) for r in account.handleInputRows(("a",), given, handle)]
    assert max(sizes) <= 7 and sum(sizes) >= 30
