"""Mix sources to target weights.

The words of a source, documents in order, are one stream that is packed into blocks of a
fixed length. Output shards have as many slots each; their slots are dealt to the sources as
a multinomial draw given that every source's total comes out at its target. The slots of a
source, numbered, run through a pseudorandom permutation of its block numbers, epoch after
epoch, and fetch the block of that number by a join. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import WORD, settled, stored

#: Words of a block.
BLOCK = 128
#: Slots of an output shard.
SHARD_SLOTS = 4096
#: Documents of a source that one sort places, about; large sources have many such buckets.
BUCKET_DOCS = 2048
#: Rounds of the permutation.
ROUNDS = 14
#: Slots generated from one row.
RUN = 1 << 14

SHARE, CAP = 1.5, 2.0
WEIGHTS = (3.0, 1.0, 2.0)


def sized(docs: DataFrame, text: str = "text") -> Column:
    """Number of words of the text; null counts as none."""
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(F.col(text), F.lit(WORD))).cast("long")


def permuted(x: Column, n: Column, seed: Column, inverse: bool = False, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..n-1 (swap-or-not): a hashed bit of each round swaps x and its partner.

    Each round is its own inverse, so the rounds in reverse order undo it.
    """

    def swap(acc: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(seed, r), n) - acc, n)
        return F.when(F.pmod(F.xxhash64(seed, r, F.greatest(acc, partner)), F.lit(2)) == 1, partner).otherwise(acc)

    order = (F.lit(rounds), F.lit(1), F.lit(-1)) if inverse else (F.lit(1), F.lit(rounds), F.lit(1))
    return F.aggregate(F.sequence(*order), x.cast("long"), swap)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Target words of each source, from one row per source: (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and split ``share``
    times all words. A target stops at ``cap`` times its source; what is over is split anew
    by weight until none is above. Sources fill up in the order of cap by weight, so the
    split is known once it is known which come first: running sums in that order. One row
    per source is sorted in one task here. Returns source, source_size, ordinal, target.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "ordinal")
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("ordinal"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("ordinal", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    level = left / open_weight
    full = F.col("level") * F.col("weight") >= cap * F.col("source_size")
    # Whoever comes after the first that is not full shares its level.
    placed = ranked.withColumn("level", level).withColumn("rank", F.row_number().over(by_fill)).withColumn("full", full)
    first_open = F.min(F.when(~F.col("full"), F.col("rank"))).over(everything)
    common = F.max(F.when(F.col("rank") == F.col("first_open"), F.col("level"))).over(everything)
    ready = placed.withColumn("first_open", first_open).withColumn("common", common)
    capped = F.col("first_open").isNull() | (F.col("rank") < F.col("first_open"))
    target = F.when(capped, cap * F.col("source_size")).otherwise(F.col("common") * F.col("weight"))
    return ready.select("source", F.col("source_size").cast("long").alias("source_size"), "ordinal", target.cast("double").alias("target"))


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Give every row that has words its place in the stream of its source: (ordinal, start).

    ``rows`` has columns source, size and key; others are carried, and a number in ``_place``
    orders rows of one key and size. Rows go to buckets by a
    hash of the key; buckets follow one another, and the rows of one are in hash order. So
    no sort holds more than a bucket, whatever the size of the source, and repeated rows
    stand side by side at places of their own.
    """
    spread = F.xxhash64("key", "size", F.lit("place"))
    n = F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_DOCS))
    names = sources.select(F.col("source").alias("_source"), "docs", "ordinal")
    bucketed = (
        rows.filter("size > 0")
        .join(names, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("spread", spread)
        .withColumn("bucket", F.pmod("spread", n))
        .drop("docs", "_source")
    )
    totals = bucketed.groupBy("ordinal", "bucket").agg(F.sum("size").alias("words"))
    until = Window.partitionBy("ordinal").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("ordinal", "bucket", F.coalesce(F.sum("words").over(until), F.lit(0)).alias("offset"))
    ties = [c for c in ("_place",) if c in rows.columns]
    within = Window.partitionBy("ordinal", "bucket").orderBy("spread", "key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    start = (F.col("offset") + F.col("before")).alias("start")
    kept = [c for c in bucketed.columns if c not in ("spread", "bucket")]
    return local.join(offsets, ["ordinal", "bucket"]).select(*kept, start)


def plan(sources: DataFrame, seed: int = 1) -> DataFrame:
    """Slots of the mix: (ordinal, epoch, r, block, words, position, shard).

    A source takes whole blocks until its target, rounded to words, is reached; its last
    slot is cut there. Slot r of an epoch holds block ``permutation(r)``. Where the short
    last block of a source comes up is known from the inverse permutation, so the number of
    slots follows without running through them. Positions over all shards are a permutation
    of all slots: a multinomial draw of source counts per shard, given their totals.
    """
    n, size = F.col("blocks"), F.col("source_size")
    base = sources.filter("source_size > 0").select(
        "ordinal", "source_size", F.round("target").cast("long").alias("want"), F.ceil(size / BLOCK).cast("long").alias("blocks")
    )
    epochs = base.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.expr("want div source_size").cast("int"))))
    seeded = F.concat_ws(":", F.lit(seed).cast("string"), F.col("ordinal").cast("string"), F.col("epoch").cast("string"))
    epochs = (
        epochs.withColumn("seed", seeded)
        .withColumn("gap", n * BLOCK - size)
        .withColumn("rest", F.least(size, F.col("want") - F.col("epoch") * size))
        .filter("rest > 0")
        .withColumn("short_at", permuted(n - 1, n, F.col("seed"), inverse=True))
        .withColumn("some", F.ceil(F.col("rest") / BLOCK).cast("long"))
    )
    lacking = (F.col("short_at") < F.col("some")) & (F.col("some") * BLOCK - F.col("gap") < F.col("rest"))
    epochs = epochs.withColumn("slots", F.col("some") + lacking.cast("long"))
    earlier = Window.orderBy("ordinal", "epoch").rowsBetween(Window.unboundedPreceding, -1)
    epochs = epochs.withColumn("offset", F.coalesce(F.sum("slots").over(earlier), F.lit(0))).withColumn(
        "all_slots", F.sum("slots").over(Window.partitionBy())
    )
    runs = epochs.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {RUN}"))))
    upto = F.least((F.col("run") + 1) * RUN, F.col("slots")) - 1
    # A number of partitions is named, else the few small rows would be merged into one task.
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = runs.repartition(parts, "ordinal", "epoch", "run").withColumn("r", F.explode(F.sequence(F.col("run") * RUN, upto)))
    block = permuted(F.col("r"), n, F.col("seed"))
    position = permuted(F.col("offset") + F.col("r"), F.col("all_slots"), F.lit(f"{seed}:shards"))
    before = F.col("r") * BLOCK - F.when(F.col("short_at") < F.col("r"), F.col("gap")).otherwise(0)
    length = F.when(F.col("block") == n - 1, BLOCK - F.col("gap")).otherwise(BLOCK)
    return (
        slots.withColumn("block", block)
        .withColumn("position", position)
        .withColumn("words", F.least(length, F.col("rest") - before))
        .filter("words > 0")
        .select("ordinal", "epoch", "r", "block", "words", "position", F.expr(f"position div {SHARD_SLOTS}").alias("shard"))
    )


def shard_counts(slots: DataFrame) -> DataFrame:
    """Slots that each shard draws from each source."""
    return slots.groupBy("shard", "ordinal").agg(F.count(F.lit(1)).alias("slots"), F.sum("words").alias("words"))


def source_table(rows: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source with its number of documents, size, ordinal and target."""
    counted = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    goals = targets(counted.select("source", "source_size"), weights, share, cap)
    counts = counted.select(F.col("source").alias("_source"), "docs")
    return settled(goals.join(counts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))


def _pieces(places: DataFrame, slots: DataFrame, keys: list[str]) -> DataFrame:
    """What the slots take of each document: (keys, epoch, from, to), word numbers in the document."""
    last = F.expr(f"(start + size - 1) div {BLOCK}")
    parts = places.select(*keys, "size", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), last)).alias("block"))
    # Slots come from a few rows per source, so Spark would take them for small and broadcast them.
    taken = slots.select("ordinal", "epoch", "block", "words").hint("merge")
    met = parts.join(taken, ["ordinal", "block"])
    low = F.greatest(F.col("start"), F.col("block") * BLOCK)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * BLOCK + F.col("words"))
    return met.filter(high > low).select(*keys, "epoch", (low - F.col("start")).alias("from"), (high - F.col("start")).alias("to"))


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 1
) -> DataFrame:
    """Words that the mix takes of every row: (doc_id, source, size, source_size, target, taken).

    Null and empty texts have size 0 and nothing is taken of them; a source of such texts
    only has target 0. Null sources are one source of their own, last in order. Repeated
    rows are documents of their own. Other columns are not read. An empty table gives no
    rows. Reruns agree, whatever the partitions.
    """
    rows = settled(docs.select(F.col("doc_id").cast("long").alias("key"), F.col("source").cast("string").alias("source"), sized(docs).alias("size")))
    sources = source_table(rows, weights, share, cap)
    places = settled(placed(rows, sources))
    keys = ["ordinal", "start", "key"]
    taken = (
        _pieces(places, plan(sources, seed), keys)
        .groupBy("ordinal", "start")
        .agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    )
    found = places.join(taken, ["ordinal", "start"], "left").select("key", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    empty = rows.filter("size = 0").select("key", "source", "size", F.lit(0).cast("long").alias("taken"))
    goals = sources.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        found.unionByName(empty)
        .join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .select(F.col("key").alias("doc_id"), "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 1
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each document and epoch that takes of it.

    A document that an epoch takes whole keeps its text as it is; of others the words taken
    are joined by blanks, in order. ``n_chars``, if there is such a column, is set anew.
    """
    # Numbered once and written, so that places and cuts are found without the texts, which move once, at the end.
    kept = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_place"), F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("key"),
            F.col("source").cast("string").alias("source"), sized(docs).alias("size"),
        )
    )
    rows = kept.drop("_row")
    sources = source_table(rows, weights, share, cap)
    places = placed(rows, sources)
    keys = ["ordinal", "start", "_place"]
    cuts = (
        _pieces(places, plan(sources, seed), keys)
        .groupBy("_place", "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("parts"), F.sum(F.col("to") - F.col("from")).alias("taken"))
    )
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"({WORD})"))
    chosen = F.flatten(F.transform("parts", lambda p: F.slice(words, p["from"].cast("int") + 1, (p["to"] - p["from"]).cast("int"))))
    text = F.when(F.col("taken") == F.col("size"), F.col("_row.text")).otherwise(F.array_join(chosen, " "))
    out = kept.select("_place", "_row", "size").join(cuts, "_place").withColumn("_text", text)
    columns = {name: F.col("_row")[name].alias(name) for name in docs.columns}
    columns["text"] = F.col("_text").alias("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("_text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*columns.values())
