"""Minority oversampling: new rows between a minority row and one of its neighbours.

SMOTE (Chawla et al., 2002) as joins. Equal vectors collapse to one with a copy count; a
vector with more than ``k`` copies has only its copies as neighbours. The others are found
through cells: some vectors are pivots, every vector belongs to its nearest pivot's cell, and
is searched there first. Its k-th distance so far then bounds where else to look: a cell is
passed over if the triangle inequality, or the plane halfway between its pivot and the
vector's own, puts all of it farther away. Cells are visited nearest bound first, in rounds
of about ``VISITED`` vectors each; the k-th distance is drawn tighter after every round, and
the search ends when the bound of every cell that is left passes it.

So the neighbours are exact whatever the vectors are, and a round compares a vector with a
bounded number of others. Where bounds rule nothing out, as for independent normal columns,
the rounds together compare all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.schema import MODEL_COLUMNS, OVERSAMPLE_NEIGHBOURS, OVERSAMPLE_RATIO
from pacewatch.session import use_checkpoints

#: Vectors a cell is meant to hold, and the most cells there are: their pivots go to every task.
CELL, MAX_CELLS = 4_096, 16_384
#: Vectors that one vector is compared with in a round outside its own cell, but for the last cell's.
VISITED = 131_072
#: Vectors that look through one piece of a cell in one task, and in one step of it.
LOOKING, STEP = 65_536, 256
_INDEX_BUCKETS = 1024


def dense_index(df: DataFrame, key: str, name: str = "index") -> DataFrame:
    """Number rows 0..n-1 by a unique key, without one ordering of all rows."""
    bucketed = df.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(_INDEX_BUCKETS)))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy(key)) - 1
    # _INDEX_BUCKETS rows at most.
    return (
        bucketed.join(F.broadcast(starts), "_b")
        .withColumn(name, F.col("_start") + place)
        .drop("_b", "_start")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rounding(width: int) -> float:
    """Bound of a product's rounding error, as a share of the squares that go into it."""
    return 8 * (width + 4) * np.finfo(float).eps


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances of rows by one product, and a bound of their rounding error."""
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    slack = _rounding(x.shape[1]) * float(xx.max(initial=0) + yy.max(initial=0))
    return xx[:, None] + yy - 2 * (x @ y.T), slack


def nearest_in(
    q: np.ndarray, q_ids: np.ndarray, within: np.ndarray, v: np.ndarray, ids: np.ndarray, h: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """(q_id, d, h, id) of the k nearest other rows of each q, no farther than ``within``.

    One product finds what can be near enough, allowing for its rounding; the distances of
    those are then taken from the differences.
    """
    found = []
    for at in range(0, len(q), STEP):
        part, limit = q[at : at + STEP], within[at : at + STEP]
        about, slack = _squares(part, v)
        about[q_ids[at : at + STEP, None] == ids] = np.inf
        open_ended = np.isinf(limit)
        top = np.where(open_ended, np.inf, limit * limit) * (1 + 1e-12)
        if open_ended.any() and len(ids) > k:
            top[open_ended] = np.partition(about[open_ended], k - 1, axis=1)[:, k - 1]
        row, col = np.nonzero((about <= top[:, None] + 2 * slack) & np.isfinite(about))
        d = np.concatenate(
            [np.zeros(0), *(np.sqrt(((part[row[i : i + 65_536]] - v[col[i : i + 65_536]]) ** 2).sum(1)) for i in range(0, len(row), 65_536))]
        )
        near = d <= limit[row]
        row, col, d = row[near], col[near], d[near]
        order = np.lexsort((ids[col], h[col], d, row))
        row, col, d = row[order], col[order], d[order]
        first = np.searchsorted(row, np.arange(len(part)))
        kept = np.arange(len(row)) - first[row] < k
        found.append((q_ids[at : at + STEP][row[kept]], d[kept], h[col[kept]], ids[col[kept]]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))


class Cells:
    """Pivots of all cells, with how many vectors a cell holds and how far they lie from its pivot."""

    def __init__(self, pivots: np.ndarray, sizes: np.ndarray, radii: np.ndarray):
        self.pivots, self.sizes, self.radii = pivots, sizes, radii

    def home(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each vector and the distance to it.

        One product finds the pivots that can be nearest, allowing for its rounding; the
        distances of those are then taken from the differences.
        """
        own, far = np.zeros(len(v), np.int64), np.zeros(len(v))
        for at in range(0, len(v), STEP):
            part = v[at : at + STEP]
            about, slack = _squares(part, self.pivots)
            # Not what is farther: a vector without distances belongs to the first pivot.
            row, col = np.nonzero(~(about > about.min(1, keepdims=True) + 2 * slack))
            d = np.sqrt(((part[row] - self.pivots[col]) ** 2).sum(1))
            order = np.lexsort((col, d, row))
            best = order[np.searchsorted(row[order], np.arange(len(part)))]
            own[at : at + STEP], far[at : at + STEP] = col[best], d[best]
        return own, far

    def distances(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """To every pivot by one product: their squares and the most that these can be off."""
        vv, pp = (v * v).sum(1)[:, None], (self.pivots * self.pivots).sum(1)
        return vv + pp - 2 * (v @ self.pivots.T), _rounding(v.shape[1]) * (vv + pp)

    def visits(
        self, v: np.ndarray, own: np.ndarray, within: np.ndarray, seen: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells that each vector has to look through, nearest first, but for its own and those seen."""
        squares, slack = self.distances(v)
        # No farther than it is.
        squares = np.maximum(squares - slack, 0.0)
        d = np.sqrt(squares)
        mine = np.sqrt(((v - self.pivots[own]) ** 2).sum(1))[:, None]
        apart = self.between[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            halfway = np.where(apart > 0, (squares - mine * mine) / (2 * apart), 0.0)
        bound = np.maximum(d - self.radii, halfway) - 1e-9 * (d + mine)
        bound[np.arange(len(v)), own] = np.inf
        if seen is not None:
            bound[seen] = np.inf
        # One key to sort by: cells within no bound come first, by distance.
        with np.errstate(divide="ignore"):
            order = np.argsort(np.where(bound <= 0, -1 / d, bound), axis=1)
        nearest_first = np.take_along_axis(bound, order, 1)
        row, place = np.nonzero((nearest_first <= within[:, None]) & np.isfinite(nearest_first))
        cell = order[row, place]
        there = self.sizes[cell] > 0
        return row[there], cell[there]

    def begun(self, row: np.ndarray, cell: np.ndarray, most: int) -> np.ndarray:
        """Which of the visits of each row start before ``most`` vectors were compared: always the first."""
        ahead = np.cumsum(self.sizes[cell]) - self.sizes[cell]
        return ahead - ahead[np.searchsorted(row, row)] < most

    @property
    def between(self) -> np.ndarray:
        """Distances between pivots, made once in a worker; by differences, so that bounds can rely on them."""
        if not hasattr(self, "_between"):
            self._between = np.sqrt(np.stack([((self.pivots - p) ** 2).sum(1) for p in self.pivots], axis=1))
        return self._between


def _searched(members: DataFrame, looking: DataFrame, visits: dict[int, int], sizes: np.ndarray, width: int, k: int) -> DataFrame:
    """(q_id, d, h, id): the k nearest members of a cell of each row (cell, q_id, v, within) that looks through it.

    A cell's members are cut into pieces and those that look into chunks, so a task holds
    about ``CELL`` and ``LOOKING`` rows however many there are.
    """
    spark = members.sparkSession
    plan = [(c, max(1, -(-int(sizes[c]) // CELL)), max(1, -(-n // LOOKING))) for c, n in visits.items()]
    # One row a cell, MAX_CELLS at most.
    cut = F.broadcast(spark.createDataFrame(plan, "cell int, pieces int, chunks int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = members.join(cut, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"), every("chunks").alias("chunk"), "id", "h", "v", F.lit(None).cast("double").alias("within")
    )
    sent = looking.join(cut, "cell").select(
        "cell", every("pieces").alias("piece"), F.pmod(F.xxhash64("q_id"), F.col("chunks")).cast("int").alias("chunk"), F.col("q_id").alias("id"), F.lit(0).cast("long").alias("h"), "v", "within"
    )

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("within").is_valid()
        asked, there = group.filter(asks), group.filter(pa.compute.invert(asks))
        numbers = lambda table, name: table.column(name).to_numpy()
        found = nearest_in(
            _matrix(asked.column("v"), width), numbers(asked, "id"), numbers(asked, "within"),
            _matrix(there.column("v"), width), numbers(there, "id"), numbers(there, "h"), k,
        )
        return pa.table(dict(zip(("q_id", "d", "h", "id"), map(pa.array, found))))

    return held.unionByName(sent).groupBy("cell", "piece", "chunk").applyInArrow(search, "q_id long, d double, h long, id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each q_id: (q_id, d, h, id)."""
    order = Window.partitionBy("q_id").orderBy("d", "h", "id")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def _near(numbered: DataFrame, distinct: int, width: int, k: int) -> DataFrame:
    """(q_id, d, h, id): the k nearest other vectors of each."""
    spark = numbered.sparkSession
    count = min(MAX_CELLS, -(-distinct // CELL))
    chosen = numbered.orderBy(F.xxhash64("h"), "h", "id").limit(count).select("v").collect()
    cells = Cells(np.array([r["v"] for r in chosen], float), np.zeros(count), np.zeros(count))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            cell, d = cells.home(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("h"), batch.column("v"), pa.array(cell, pa.int32()), pa.array(d)], names=["id", "h", "v", "cell", "d"]
            )

    members = numbered.select("id", "h", "v").mapInArrow(place, "id long, h long, v array<double>, cell int, d double").checkpoint()
    sizes, radii = np.zeros(count, np.int64), np.zeros(count)
    for r in members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far")).collect():
        sizes[r["cell"]], radii[r["cell"]] = r["n"], r["far"]
    cells = Cells(cells.pivots, sizes, radii)
    everyone = members.select("cell", F.col("id").alias("q_id"), "v", F.lit(float("inf")).alias("within"))
    here = _best(_searched(members, everyone, {c: int(n) for c, n in enumerate(sizes) if n}, sizes, width, k), k)
    if count == 1:
        return here
    looking = members.select(F.col("id").alias("q_id"), "v", F.col("cell").alias("own"), F.array().cast("array<int>").alias("seen"))

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                numbers = lambda name: part.column(name).to_numpy()  # noqa: E731, B023
                ended = part.column("seen")
                seen = np.repeat(np.arange(len(part)), ended.value_lengths().to_numpy()), ended.flatten().to_numpy()
                row, cell = cells.visits(_matrix(part.column("v"), width), numbers("own"), numbers("within"), seen)
                now = cells.begun(row, cell, VISITED)
                each = np.bincount(row[now], minlength=len(part))
                go = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(each)), pa.int32()), pa.array(cell[now], pa.int32()))
                more = pa.array(np.bincount(row[~now], minlength=len(part)) > 0)
                columns = [*(part.column(x) for x in ("q_id", "v", "own", "within", "seen")), go, more]
                yield pa.RecordBatch.from_arrays(columns, names=["q_id", "v", "own", "within", "seen", "go", "more"]).filter(pa.array(each > 0))

    while True:
        here = here.checkpoint()
        # Fewer than k found bound nothing.
        reach = here.groupBy("q_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("d")).alias("within"))
        known = looking.join(reach, "q_id", "left").withColumn("within", F.coalesce("within", F.lit(float("inf"))))
        # Written once: what a round looks through is what the next one leaves out.
        leaving = known.mapInArrow(leave, "q_id long, v array<double>, own int, within double, seen array<int>, go array<int>, more boolean").checkpoint()
        going = leaving.select(F.explode("go").alias("cell"), "q_id", "v", "within")
        visits = {r["cell"]: r["count"] for r in going.groupBy("cell").count().collect()}
        if not visits:
            return here
        here = _best(here.unionByName(_searched(members, going, visits, sizes, width, k)), k)
        looking = leaving.filter("more").select("q_id", "v", "own", F.concat("seen", "go").alias("seen"))
        if looking.isEmpty():
            return here


def nearest_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(v, neighbours): the k nearest rows of each distinct vector, copies counted singly.

    ``vectors`` are (v, copies), all of one width, without nulls.
    """
    distinct, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
    if distinct == 1:
        return vectors.select("v", F.array_repeat(F.col("v"), F.least(F.col("copies") - 1, F.lit(k)).cast("int")).alias("neighbours"))
    numbered = vectors.select("v", "copies", F.monotonically_increasing_id().alias("id"), F.xxhash64("v").alias("h"))
    # Written once: the ids stay what they are in every use below.
    numbered = numbered.checkpoint()
    pairs = _near(numbered, distinct, width, k)
    listed = (
        pairs.join(numbered.select("id", "v", "copies"), "id")
        .groupBy("q_id")
        .agg(F.sort_array(F.collect_list(F.struct("d", "h", "id", "v", "copies"))).alias("near"))
    )
    around = F.flatten(F.transform("near", lambda n: F.array_repeat(n["v"], F.least(n["copies"], F.lit(k)).cast("int"))))
    around = F.coalesce(around, F.array().cast("array<array<double>>"))
    own = F.array_repeat(F.col("v"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    return numbered.join(listed, F.col("id") == F.col("q_id"), "left").select(
        "v", F.slice(F.concat(own, around), 1, k).alias("neighbours")
    )


def positives(df: DataFrame, features: Sequence[str] = MODEL_COLUMNS, label: str = "is_fraud", id_col: str = "transaction_id") -> DataFrame:
    """(id, v) of the minority rows, missing values 0."""
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return df.filter(F.col(label) == 1).select(id_col, values.alias("v"))


def nearest_rows(rows: DataFrame, k: int, id_col: str = "transaction_id") -> DataFrame:
    """(id, rank, distance): how far the k nearest other rows of each row (id, v) lie."""
    use_checkpoints(rows.sparkSession)
    rows = rows.checkpoint()
    near = nearest_vectors(rows.groupBy("v").agg(F.count(F.lit(1)).alias("copies")), k)
    each = rows.join(near, "v").select(id_col, "v", F.posexplode("neighbours").alias("place", "other"))
    squares = F.zip_with("v", "other", lambda x, y: (x - y) * (x - y))
    return each.select(id_col, (F.col("place") + 1).alias("rank"), F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, x: t + x)).alias("distance"))


def drawn(i: Column, seed: int, what: str, digits: int = 15) -> Column:
    """An integer of so many hexadecimal digits from the MD5 of (seed, what, i)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(what), i.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def smote(
    df: DataFrame,
    features: Sequence[str] = MODEL_COLUMNS,
    label: str = "is_fraud",
    ratio: float = OVERSAMPLE_RATIO,
    k: int = OVERSAMPLE_NEIGHBOURS,
    seed: int = 42,
    id_col: str = "transaction_id",
    draws: bool = False,
) -> DataFrame:
    """``df``'s features and label, plus synthetic positives up to ``ratio`` x negatives.

    Synthetic row i draws its base row, neighbour and position from MD5 digests of (seed,
    i), so a rerun gives the same rows and SQL can follow. With ``draws`` the synthetic
    rows come back alone, with i, the three draws, and the two ends of their segment.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    original = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features], F.col(label).cast("int").alias(label))
    sizes = original.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) == 0, 1))).head()
    minority_rows, majority_rows = sizes[0], sizes[1]
    wanted = int(majority_rows * ratio) - minority_rows
    if wanted <= 0 and not draws:
        return original
    if minority_rows <= k:
        raise ValueError(f"{minority_rows} positives are too few for {k} neighbours")
    # The feature plan behind these few rows would otherwise run once per use below.
    minority = positives(df, features, label, id_col).checkpoint()
    distinct = minority.groupBy("v").agg(F.count(F.lit(1)).alias("copies"))
    neighbours = nearest_vectors(distinct, k)
    numbered = dense_index(minority, id_col).select("index", "v")

    i = F.col("id")
    plan = spark.range(wanted).select(
        i.alias("i"),
        (drawn(i, seed, "base") % minority_rows).alias("index"),
        (drawn(i, seed, "neighbour") % k + 1).cast("int").alias("which"),
        (drawn(i, seed, "gap", 13) / F.lit(float(1 << 52))).alias("gap"),
    )
    towards = F.element_at("neighbours", F.col("which"))
    point = F.zip_with("v", towards, lambda a, b: a + F.col("gap") * (b - a))
    made = plan.join(numbered, "index").join(neighbours, "v")
    if draws:
        return made.select("i", "index", "which", "gap", F.col("v").alias("base"), towards.alias("towards"), point.alias("point"))
    made = made.select(point.alias("s"))
    synthetic = made.select(
        *[F.col("s")[i].alias(c) for i, c in enumerate(features)], F.lit(1).alias(label)
    )
    return original.unionByName(synthetic)
