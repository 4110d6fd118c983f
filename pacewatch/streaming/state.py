"""Features of a stream kept in Spark's state store, account by account.

Each account's recent rows lie in its state: second, id, amount and what orders deliveries. An
account of few rows has one entry, a larger one an entry a day. A batch brings an account new rows; the state gives the rows around them,
and every row whose features changed goes out again with a higher revision: the new rows,
what follows them within the longest window, and the next row, whose gap changed. No table
of earlier rows is read, and a batch touches only the accounts and days it changes.

The watermark bounds the state. Rows that come later than ``lateness`` are dropped by Spark
and counted in the query's progress. A day leaves the state once no row that may still come
can see it: the longest window after its end. Of the rows that left, the last second stays,
so that the gap of the next row is known however long the account was silent. Timers remove
days of accounts that get no more rows.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from pacewatch.operators.features import GAP, completed
from pacewatch.operators.stage import arrival
from pacewatch.schema import ROLLING_COLUMNS, SPEND_FRAMES, VELOCITY_FRAMES, VOLATILITY_FRAMES, WINDOWS
from pacewatch.streaming.bronze import trigger

DAY = 86_400
FRAMES = VELOCITY_FRAMES | SPEND_FRAMES | VOLATILITY_FRAMES
REACH = max(WINDOWS.values())
#: Rows of an account that are worked in at a time.
CHUNK = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Entries of an account that are read in one message; of more, only the days that are needed are read.
AT_ONCE = 40
#: Rows up to which an account's days lie in one entry, so that a batch writes it in one message.
TOGETHER = 256
#: Values that standard deviations are taken from at a time.
SPREAD_VALUES = 1_000_000

#: An entry's rows as one value: Spark converts values of a state element by element.
_DAY_STATE = "rows binary"
#: Rows of an account come out as lists, column by column: Spark makes a message of every output of an account.
_LISTED = {
    "transaction_id": "string",
    "event_micros": "bigint",
    "amount": "double",
    **{name: "bigint" if agg == "count" else "double" for name, (agg, _) in FRAMES.items()},
    GAP: "bigint",
}
_OUT = ", ".join(["user_id string, revision bigint", *(f"{name} array<{of}>" for name, of in _LISTED.items())])
_OUT_ROW = Row("user_id", "revision", *_LISTED)


def _reduced(ufunc: np.ufunc, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``ufunc`` over ``values[start:end]`` of each frame, none of them empty."""
    between = np.stack([starts, ends], axis=1).ravel()
    return ufunc.reduceat(np.append(values, 0.0), between)[::2]


def _deviations(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Standard deviations of frames of two values and more."""
    sizes, out = ends - starts, np.empty(len(starts))
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SPREAD_VALUES)) + 1
    for part in np.split(np.arange(len(starts)), cuts):
        if not len(part):
            continue
        n = sizes[part]
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first - starts[part], n)
        squares = (values[place] - np.repeat(means[part], n)) ** 2
        out[part] = np.sqrt(np.add.reduceat(squares, first) / (n - 1))
    return out


def frames(at: np.ndarray, amounts: np.ndarray, chosen: np.ndarray) -> dict[str, list]:
    """All frames of the chosen rows: ``at`` are the seconds of all rows in order, NaN amounts count as null."""
    there = ~np.isnan(amounts)
    values, upto = amounts[there], np.concatenate([[0], np.cumsum(there)])
    end = np.searchsorted(at, at[chosen])
    out = {}
    for window, length in WINDOWS.items():
        start = np.searchsorted(at, at[chosen] - length)
        s, e = upto[start], upto[end]
        found, several = e > s, e - s > 1
        s, e = s[found], e[found]
        total = _reduced(np.add, values, s, e)
        for name, (agg, w) in FRAMES.items():
            if w != window:
                continue
            if agg == "count":
                out[name] = (end - start).tolist()
                continue
            if agg == "stddev":
                of, most = several, several[found]
                got = _deviations(values, s[most], e[most], (total / (e - s))[most])
            else:
                of = found
                got = total if agg == "sum" else total / (e - s) if agg == "avg" else _reduced({"max": np.maximum, "min": np.minimum}[agg], values, s, e)
            column = np.full(len(chosen), None, object)
            column[of] = got.tolist()
            out[name] = column.tolist()
    return out


class Days:
    """The days of one account that a batch needs: their rows by id. ``entries`` are the state's keys."""

    def __init__(self, read, entries: list[int], held: dict[int, dict[str, tuple]] | None = None):
        self.read, self.entries, self.held = read, set(entries), {} if held is None else held
        self.whole = held is not None
        self.known = sorted(self.held if self.whole else self.entries)
        #: Days that changed; and whether days share an entry.
        self.changed, self.shared = set(), len(self.held) > len(self.entries)

    def day(self, number: int) -> dict[str, tuple]:
        """Rows (second, id, micros, amount, arrival) of a day."""
        if number not in self.held:
            self.held[number] = self.read(number) if number in self.known else {}
        return self.held[number]

    def put(self, second: int, ident: str, micros: int, amount: float | None, came: tuple) -> list[int]:
        """Add a row unless an earlier delivery is there; the seconds whose surroundings changed."""
        rows = self.day(second // DAY)
        if second // DAY not in self.known:
            self.known = sorted([*self.known, second // DAY])
        there = rows.get(ident)
        if there is not None and there[4] <= came:
            return []
        rows[ident] = (second, ident, micros, amount, came)
        self.changed.add(second // DAY)
        return [second] if there is None else [second, there[0]]

    def around(self, seconds: list[int]) -> None:
        """Load what the rows that may have changed, and the gaps at their ends, look at."""
        for number in {s // DAY for s in seconds}:
            # The windows before the first and after the last second of that day, and the next row's window.
            after = [d for d in self.known if d > number][:1]
            before = [d for d in self.known if d < number][-1:]
            reach = -(-REACH // DAY)
            ends = [(number - reach, number + 1 + reach), *((d - reach, d) for d in after)]
            for d in self.known:
                if d in before or any(a <= d <= b for a, b in ends):
                    self.day(d)


def changed_rows(days: Days, seconds: list[int], last: int | None) -> tuple[list[tuple], dict[str, list], list[int | None]]:
    """Rows, frames and gaps of all rows whose features the changes at ``seconds`` can have changed."""
    rows = sorted(r for day in days.held.values() for r in day.values())
    at = np.array([r[0] for r in rows], np.int64)
    amounts = np.array([np.nan if r[3] is None else r[3] for r in rows], float)
    moved = np.unique(np.array(seconds, np.int64))
    # Rows within the longest window after a change, and the row that follows it.
    edges = np.zeros(len(rows) + 1, np.int64)
    np.add.at(edges, np.searchsorted(at, moved), 1)
    np.add.at(edges, np.searchsorted(at, moved + REACH, "right"), -1)
    changed = np.cumsum(edges)[:-1] > 0
    following = np.searchsorted(at, moved, "right")
    changed[following[following < len(rows)]] = True
    chosen = np.flatnonzero(changed)
    seconds_of = at.tolist()
    before = [seconds_of[i - 1] if i else last for i in chosen.tolist()]
    gaps = [None if b is None else seconds_of[i] - b for i, b in zip(chosen.tolist(), before)]
    return [rows[i] for i in chosen.tolist()], frames(at, amounts, chosen), gaps


class AccountFeatures(StatefulProcessor):
    """State of an account: its recent days, its revision, the last second that left, its next timer and number of entries."""

    def init(self, handle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day bigint", _DAY_STATE)
        self.mark = handle.getValueState("mark", "revision bigint, last bigint, waking bigint, count bigint")

    def _read(self, day: int) -> dict[str, tuple]:
        return {r[1]: r for r in pickle.loads(self.days.getValue((day,))[0])}

    def _write(self, entry: int, rows: list[tuple]) -> None:
        rows.sort(key=lambda r: r[:2])
        self.days.updateValue((entry,), (pickle.dumps(rows),))

    def _open(self, count: int) -> Days:
        """The account's days; few entries are read together, of many only the days that are asked for."""
        if count > AT_ONCE:
            return Days(self._read, [day for (day,) in self.days.keys()])
        entries, held = [], {}
        for (entry,), (rows,) in self.days.iterator() if count else ():
            entries.append(entry)
            for r in pickle.loads(rows):
                held.setdefault(r[0] // DAY, {})[r[1]] = r
        return Days(self._read, entries, held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        revision, last, waking, count = self.mark.get() or (0, None, None, 0)
        days = self._open(count)
        while chunk := list(itertools.islice(rows, CHUNK)):
            seconds = []
            for ident, _, _, micros, amount, *came in chunk:
                seconds += days.put(micros // 1_000_000, ident, micros, amount, tuple(came))
            if not seconds:
                continue
            days.around(seconds)
            revision += 1
            found, framed, gaps = changed_rows(days, seconds, last)
            _, idents, micros, amounts, _ = zip(*found)
            columns = [idents, micros, amounts, *(framed[name] for name in FRAMES), gaps]
            for at in range(0, len(found), CHUNK):
                yield _OUT_ROW(key[0], revision, *(list(column[at : at + CHUNK]) for column in columns))
        self._keep(days, revision, last, waking, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        mark = self.mark.get()
        if mark is not None:
            revision, last, _, count = mark
            self._keep(self._open(count), revision, last, None, timerValues)
        return iter(())

    def _keep(self, days: Days, revision: int, last: int | None, waking: int | None, timers) -> None:
        """Write what changed, drop the days that no row still to come can see; wake up when the next one can go."""
        watermark = timers.getCurrentWatermarkInMs()
        known = sorted(days.known)
        left = [d for d in known if self._leaves(d) > watermark]
        gone = known[: len(known) - len(left)]
        for day in gone:
            last = max(*(r[0] for r in days.day(day).values()), last if last is not None else -(1 << 62))
        if days.whole and left and sum(len(days.held[d]) for d in left) <= TOGETHER:
            entry = min(days.entries.intersection(left), default=left[0])
            entries = {entry}
            if days.changed or gone or days.entries != entries:
                self._write(entry, [r for d in left for r in days.held[d].values()])
        else:
            entries = set(left)
            for day in left if days.shared else sorted(days.changed.intersection(left)):
                self._write(day, list(days.held[day].values()))
        for entry in days.entries - entries:
            self.days.removeKey((entry,))
        if left and self._leaves(left[0]) != waking:
            waking = self._leaves(left[0])
            self.handle.registerTimer(waking)
        self.mark.update((revision, last, waking, len(entries)))

    @staticmethod
    def _leaves(day: int) -> int:
        return ((day + 1) * DAY + REACH + 1) * 1000

    def close(self) -> None:
        pass


def start_state_features(
    events: DataFrame,
    path: str,
    checkpoint: str,
    lateness: str = "7 days",
    mode: str = "continuous",
    interval: str = "1 minute",
) -> StreamingQuery:
    """Keep rolling features current from a stream of decoded events, in state alone.

    Appends rows (transaction_id, user_id, event_time, amount, rolling columns, revision) to
    files under ``path``; :func:`current_state_features` reads the newest of each. Of the
    deliveries of an id the first to arrive counts, in whatever batch it comes; a delivery
    has the account and the time of the others. Rows without an account form one account.
    Rows without an id or a time can neither be looked up nor placed in a window and are left
    out. NaN amounts count as null. An account's state holds the longest window and
    ``lateness``, in whole days, and one task works on one account at a time.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    came = arrival(events)
    rows = events.filter("transaction_id is not null and event_time is not null").select(
        "transaction_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_time").cast("timestamp").alias("event_time"),
        F.unix_micros(F.col("event_time").cast("timestamp")).alias("event_micros"),
        F.when(~F.isnan("amount"), F.col("amount")).cast("double").alias("amount"),
        F.unix_micros(came["at"].cast("timestamp")).alias("at"),
        came["part"].alias("part"),
        came["place"].alias("place"),
    )
    framed = (
        rows.withWatermark("event_time", lateness)
        .groupBy("user_id")
        .transformWithState(AccountFeatures(), _OUT, "Append", "EventTime")
        .select("user_id", "revision", F.inline(F.arrays_zip(*_LISTED)))
        .withColumn("event_time", F.timestamp_micros("event_micros"))
    )
    out = completed(framed).select("transaction_id", "user_id", "event_time", "amount", *ROLLING_COLUMNS, "revision")
    return (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger(mode, interval))
        .start()
    )


def current_state_features(spark: SparkSession, path: str) -> DataFrame:
    """The newest revision of every row."""
    newest = F.row_number().over(Window.partitionBy("transaction_id").orderBy(F.desc("revision")))
    return spark.read.parquet(path).withColumn("_n", newest).filter("_n = 1").drop("_n", "revision")
