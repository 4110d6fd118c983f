"""Model quality from scored rows, exact and without collecting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.schema import DECISION_THRESHOLD
from pacewatch.session import use_checkpoints

# Score ranges ranked independently. Ranges hold about equally many distinct scores.
# A range is found in three steps of at most ten comparisons.
_FANOUT = 10
CURVE_RANGES = _FANOUT**3


def _flags(scored: DataFrame, threshold: float, score: str, label: str) -> DataFrame:
    return scored.select(
        F.col(label).cast("int").alias("actual"),
        F.when(F.col(score) >= threshold, 1).otherwise(0).alias("predicted"),
    )


def confusion(
    scored: DataFrame,
    threshold: float = DECISION_THRESHOLD,
    score: str = "probability",
    label: str = "is_fraud",
) -> DataFrame:
    """Counts for all four (actual, predicted) cells, empty ones included."""
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = _flags(scored, threshold, score, label).agg(
        *[
            F.count(F.when((F.col("actual") == a) & (F.col("predicted") == p), 1)).alias(f"n{a}{p}")
            for a, p in cells
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("rows"))
            for a, p in cells
        ]
    )
    return counts.select(F.inline(rows))


def threshold_metrics(
    scored: DataFrame,
    threshold: float = DECISION_THRESHOLD,
    score: str = "probability",
    label: str = "is_fraud",
) -> DataFrame:
    """Precision, recall and F1 at a threshold; 0 where one is undefined."""
    counts = _flags(scored, threshold, score, label).agg(
        F.count(F.when((F.col("actual") == 1) & (F.col("predicted") == 1), 1)).alias("hit"),
        F.count(F.when(F.col("predicted") == 1, 1)).alias("flagged"),
        F.count(F.when(F.col("actual") == 1, 1)).alias("wanted"),
    )

    def share(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    hit, flagged, wanted = F.col("hit"), F.col("flagged"), F.col("wanted")
    return counts.select(
        share(hit, flagged).alias("precision"),
        share(hit, wanted).alias("recall"),
        share(2 * hit, flagged + wanted).alias("f1"),
    )


def score_curve(
    scored: DataFrame, score: str = "probability", label: str = "is_fraud"
) -> DataFrame:
    """Per distinct score: positives and negatives at it, and at higher scores.

    Equal scores collapse first. Quantiles of the distinct scores cut them into ranges,
    each range runs its own cumulative sum, and the totals of higher ranges (one row per
    range) are added, so no task orders all scores.
    """
    points = (
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(
            F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
            F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
        )
    )
    shares = f"array({', '.join(f'{i / CURVE_RANGES}D' for i in range(1, CURVE_RANGES))})"
    quantiles = F.expr(f"percentile_approx(score, {shares}, {10 * CURVE_RANGES})")

    def every(n: int) -> Column:
        return F.filter("edges", lambda _, i: (i + 1) % n == 0)

    # The sums are not needed here; with them, this subquery, the range totals and the
    # ranked rows all read the same shuffled points, which Spark then computes once.
    summary = points.agg(quantiles.alias("edges"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    tree = summary.select(
        F.struct("edges", "p", "n", every(_FANOUT).alias("tens"), every(_FANOUT**2).alias("hundreds"))
    ).scalar()

    def passed(edges: Column) -> Column:
        # Never null, so no null test of this search is pushed down to the input rows.
        return F.coalesce(F.size(F.filter(edges, lambda c: c <= F.col("score"))), F.lit(0))

    def descend(level: str, above: str) -> Column:
        start = F.col(above) * _FANOUT
        return start + passed(F.slice(F.col("tree").getField(level), start + 1, _FANOUT))

    placed = (
        points.withColumn("tree", tree)
        .withColumn("first", passed(F.col("tree").getField("hundreds")))
        .withColumn("second", descend("tens", "first"))
        .select("score", "pos", "neg", descend("edges", "second").alias("range"))
    )

    higher = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("p0"),
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n0"),
    )
    within = (
        Window.partitionBy("range")
        .orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per range: at most CURVE_RANGES, whatever the data holds.
    return placed.join(F.broadcast(offsets), "range").select(
        "score",
        "pos",
        "neg",
        (F.col("p0") + F.coalesce(F.sum("pos").over(within), F.lit(0))).alias("pos_above"),
        (F.col("n0") + F.coalesce(F.sum("neg").over(within), F.lit(0))).alias("neg_above"),
    )


def _area(curve: DataFrame) -> DataFrame:
    """Rank statistic with ties at one half; null unless both classes occur."""
    pairs = F.col("neg") * (F.col("pos_above").cast("double") + F.col("pos") / 2)
    return curve.agg(
        F.try_divide(F.sum(pairs), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")
    )


def _precision_area(curve: DataFrame) -> DataFrame:
    """Sum of recall steps times precision; null without positives."""
    hit = (F.col("pos_above") + F.col("pos")).cast("double")
    flagged = hit + F.col("neg_above") + F.col("neg")
    return curve.agg(
        F.try_divide(F.sum(F.col("pos") * hit / flagged), F.sum("pos").cast("double")).alias(
            "average_precision"
        )
    )


def roc_auc(scored: DataFrame, **columns) -> DataFrame:
    return _area(score_curve(scored, **columns))


def average_precision(scored: DataFrame, **columns) -> DataFrame:
    return _precision_area(score_curve(scored, **columns))


def evaluate(
    scored: DataFrame,
    threshold: float = DECISION_THRESHOLD,
    score: str = "probability",
    label: str = "is_fraud",
) -> DataFrame:
    """(metric, value) rows of all quality figures and the test-set sizes."""
    # A prediction may stand behind the scores: it runs once, and all parts read its two columns.
    use_checkpoints(scored.sparkSession)
    scored = scored.select(score, label).checkpoint()
    sizes = scored.agg(
        F.count(F.lit(1)).cast("double").alias("test_size"),
        F.coalesce(F.sum(F.col(label)), F.lit(0)).cast("double").alias("test_positives"),
    )
    curve = score_curve(scored, score=score, label=label).checkpoint()
    parts = [
        _area(curve),
        _precision_area(curve),
        threshold_metrics(scored, threshold, score, label),
        sizes,
    ]
    report = None
    for part in parts:
        long = part.select(
            F.inline(
                F.array(
                    *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in part.columns]
                )
            )
        )
        report = long if report is None else report.unionByName(long)
    return report
