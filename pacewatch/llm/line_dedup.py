"""Repeated runs of lines, by a suffix array over line numbers built by distributed prefix doubling.

Lines that occur twice become numbers in the order of their digests. A step of prefix doubling
names the next 2**(k+1) lines of a place by its name for 2**k lines and the names 2**k lines
on, numbers the distinct pairs by a range sort, and goes on with the places whose names still
occur twice and whose stretch of repeated lines goes on. It ends when no place is left, so the
array is whole. The names of a place, shortest first, are its path: sorted paths are the
suffix array, and neighbours share as many lines as their paths say, the rest looked up where
the paths part (LCP). At a depth of b lines the array falls into LCP intervals, cut where the
LCP is below b; an interval with two places is a repeated run. The shortest runs that hold
enough words, counted forwards and backwards from each line, cover every longer one, so all
maximal repeated runs are their unions; all but the first copy is deleted.
Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import WORD, stored

#: Words that a repeated run must have; shorter ones are found in any two texts.
MIN_WORDS = 5

#: What may part words within a line.
BLANKS = " \t\r\f\x0b"

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition (fixed by Spark).
ROW_BITS = 33


def _words(body: Column) -> Column:
    """Words of a line that has one; where single blanks part them, counting the blanks is enough."""
    bare = F.btrim(body, F.lit(BLANKS))
    odd = reduce(Column.__or__, [F.contains(bare, F.lit(x)) for x in ("  ", *BLANKS[1:])])
    blanks = F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "), F.lit("")))
    return F.when(odd, F.regexp_count(body, F.lit(WORD))).otherwise(blanks + 1)


def lines_of(rows: DataFrame) -> DataFrame:
    """(row, doc_id, pos, line, h, g, words): every line with a word; ``pos`` counts them, ``line`` all lines."""
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("body")))
    filled = F.filter(numbered, lambda x: F.length(F.btrim(x["body"], F.lit(BLANKS))) > 0)
    body = F.col("x.body")
    return rows.select("row", "doc_id", F.posexplode(filled).alias("pos", "x")).select(
        "row", "doc_id", "pos", F.col("x.line").alias("line"),
        F.xxhash64(body).alias("h"), F.xxhash64(F.lit(7), body).alias("g"), _words(body).alias("words"),
    )


def _numbered(keys: DataFrame, *order: str) -> DataFrame:
    """Distinct keys with ``name``, a number that grows in their order."""
    return stored(keys.orderBy(*order).withColumn("name", F.monotonically_increasing_id()))


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """(row, doc_id, pos, line, words, off, left, name): lines that occur twice, in stretches with enough words.

    A repeated run holds repeated lines only, so a line that occurs once ends a stretch.
    ``off`` lines of the stretch come before the line, ``left`` are left with it.
    """
    often = lines.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "g")
    twice = lines.join(_numbered(often, "h", "g"), ["h", "g"]).drop("h", "g")
    island = F.col("pos") - F.row_number().over(Window.partitionBy("row").orderBy("pos"))
    whole = Window.partitionBy("row", "island")
    placed = twice.withColumn("island", island).select(
        "*",
        (F.row_number().over(whole.orderBy("pos")) - 1).alias("off"),
        F.count(F.lit(1)).over(whole).alias("size"),
        F.sum("words").over(whole).alias("all_words"),
    )
    left = (F.col("size") - F.col("off")).cast("int").alias("left")
    return stored(placed.filter(F.col("all_words") >= min_words).select("row", "doc_id", "pos", "line", "words", "off", left, "name"))


def suffix_paths(active: DataFrame) -> DataFrame:
    """(row, doc_id, pos, off, left, path): ``path[k]`` names the next 2**k lines, as far as they occur twice.

    A stretch that ends within those lines ends the name too. Equal paths are equal suffixes.
    A step reads only places that can still be told apart and those 2**k lines on.
    """
    live = active.select("row", "doc_id", "pos", "off", "left", F.array("name").alias("path"), F.lit(True).alias("open"))
    ended: list[DataFrame] = []
    step = 1
    while True:
        known = reduce(DataFrame.unionByName, [*ended, live]).filter(F.col("off") >= step)
        ahead = known.select("row", (F.col("pos") - step).alias("pos"), F.col("path").alias("ahead"))
        goes_on = F.col("open") & (F.col("left") > step)
        paired = stored(live.filter(goes_on).join(ahead, ["row", "pos"]).withColumn("here", F.element_at("path", -1)))
        if paired.isEmpty():
            return reduce(DataFrame.unionByName, [*ended, live]).drop("open")
        ended.append(live.filter(~goes_on))
        names = _numbered(paired.groupBy("here", "ahead").agg((F.count(F.lit(1)) > 1).alias("again")), "here", "ahead")
        longer = F.concat("path", F.array("name")).alias("path")
        live = stored(paired.join(names, ["here", "ahead"]).select("row", "doc_id", "pos", "off", "left", longer, F.col("again").alias("open")))
        step *= 2


def suffix_array(paths: DataFrame) -> DataFrame:
    """(sa, row, doc_id, pos, left, path): ``sa`` grows in the order of the suffixes, equal ones by place."""
    ordered = paths.drop("off").orderBy("path", "doc_id", "row", "pos")
    return stored(ordered.withColumn("sa", F.monotonically_increasing_id()))


def _part(sa: str = "sa") -> Column:
    return F.shiftright(sa, ROW_BITS)


def _matched(pairs: DataFrame) -> DataFrame:
    """Move both places of a pair on by the lines that their paths share; ``open`` if more can follow."""
    same = F.zip_with("path", "other_path", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    levels = F.aggregate(same, F.lit(0), lambda n, x: n + x)
    shared = F.when(F.col("levels") == 0, 0).otherwise(F.least(F.expr("shiftleft(1, levels - 1)"), "left", "other_left"))
    on = pairs.withColumn("levels", levels).withColumn("shared", shared)
    moved = on.select(
        "sa", (F.col("lcp") + F.col("shared")).alias("lcp"),
        "row", (F.col("pos") + F.col("shared")).alias("pos"), "other_row", (F.col("other_pos") + F.col("shared")).alias("other_pos"),
        ((F.col("shared") > 0) & (F.least("left", "other_left") > F.col("shared"))).alias("open"),
    )
    return stored(moved)


def neighbour_lcp(array: DataFrame) -> DataFrame:
    """(sa, lcp): the lines that a suffix shares with the one before it; the first suffix has no row.

    A round moves a pair on by a power of two, each smaller than the last, so there are as
    many rounds as the largest LCP has binary ones.
    """
    # The one before the first of a partition is the last of the partition before: one row a partition.
    parts = array.withColumn("part", _part()).withColumn("here", F.struct("row", "pos", "left", "path"))
    ends = parts.groupBy("part").agg(F.max_by("here", "sa").alias("last"))
    edges = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("edge"))
    before = F.lag("here").over(Window.partitionBy("part").orderBy("sa"))
    beside = parts.withColumn("before", before).join(edges, "part").withColumn("other", F.coalesce("before", "edge"))
    other = [F.col("other")[c].alias(f"other_{c}") for c in ("row", "pos", "left", "path")]
    pairs = _matched(beside.filter("other is not null").select("sa", "row", "pos", "left", "path", *other, F.lit(0).alias("lcp")))
    at = array.select("row", "pos", "left", "path")
    at_other = at.select(*(F.col(c).alias(f"other_{c}") for c in at.columns))
    closed: list[DataFrame] = []
    while True:
        closed.append(pairs.filter(~F.col("open")).select("sa", "lcp"))
        going = pairs.filter("open").drop("open")
        if going.isEmpty():
            return reduce(DataFrame.unionByName, closed)
        pairs = _matched(going.join(at, ["row", "pos"]).join(at_other, ["other_row", "other_pos"]))


def _shortest(near: Column, sign: int, min_words: int) -> Column:
    """Lines of the shortest run of at least ``min_words``, 0 if none; ``near`` are (pos, words) outwards."""
    first = F.element_at(near, 1)["pos"]

    def state(n: Column, words: Column, more: Column) -> Column:
        return F.struct(n.cast("int").alias("n"), words.cast("int").alias("words"), more.cast("int").alias("open"))

    def step(acc: Column, x: Column) -> Column:
        on = (acc["open"] == 1) & (acc["words"] < min_words) & (x["pos"] == first + sign * acc["n"])
        return state(
            F.when(on, acc["n"] + 1).otherwise(acc["n"]),
            F.when(on, acc["words"] + x["words"]).otherwise(acc["words"]),
            F.when(on, 1).otherwise(0),
        )

    start = state(F.lit(0), F.lit(0), F.lit(1))
    return F.aggregate(near, start, step, lambda acc: F.when(acc["words"] >= min_words, acc["n"]).otherwise(0))


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(row, doc_id, start, m): the shortest long-enough runs from each line forwards and up to it backwards.

    Each line has a word at least, so a run has at most ``min_words`` lines.
    """
    order = Window.partitionBy("row").orderBy("pos")
    around = F.struct("pos", "words")
    ahead = F.collect_list(around).over(order.rowsBetween(0, min_words - 1))
    behind = F.reverse(F.collect_list(around).over(order.rowsBetween(1 - min_words, 0)))
    sized = lines.select("row", "doc_id", "pos", ahead.alias("ahead"), behind.alias("behind")).select(
        "row", "doc_id", "pos", _shortest(F.col("ahead"), 1, min_words).alias("f"), _shortest(F.col("behind"), -1, min_words).alias("b")
    )
    forward = F.struct(F.col("pos").alias("start"), F.col("f").alias("m"))
    backward = F.struct((F.col("pos") - F.col("b") + 1).alias("start"), F.col("b").alias("m"))
    both = sized.select("row", "doc_id", F.explode(F.array(forward, backward)).alias("w"))
    return both.select("row", "doc_id", "w.start", "w.m").filter("m > 0").distinct()


def intervals(runs: DataFrame) -> DataFrame:
    """``runs`` (sa, lcp, m, ...) with ``head``, the first ``sa`` of the LCP interval of depth ``m`` that holds the run.

    All suffixes of an interval share their first m lines and so have the same run, hence an
    interval starts where the LCP is below m. The last start is carried over the partitions
    of the array: a row for each of them and each m, and m is at most the least words of a run.
    """
    starts = F.max(F.when(F.col("lcp") < F.col("m"), F.col("sa")))
    cut = runs.withColumn("part", _part())
    ends = cut.groupBy("part", "m").agg(starts.alias("last"))
    earlier = Window.partitionBy("m").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(ends.select("part", "m", F.max("last").over(earlier).alias("carried")))
    so_far = Window.partitionBy("part", "m").orderBy("sa").rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumn("inside", starts.over(so_far)).join(carried, ["part", "m"])
    return inside.withColumn("head", F.coalesce("inside", "carried")).drop("part", "inside", "carried")


def repeated_lines(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, line) of every line to delete. ``rows`` has (row, doc_id, text), with ``row`` unique."""
    active = stretches(lines_of(rows), min_words)
    array = suffix_array(suffix_paths(active))
    lcp = neighbour_lcp(array)
    suffixes = array.select("sa", "row", F.col("pos").alias("start")).join(lcp, "sa", "left")
    wanted = windows(active, min_words).join(suffixes, ["row", "start"])
    place = F.struct("doc_id", "row", "start").alias("place")
    runs = stored(intervals(wanted.select("sa", F.coalesce("lcp", F.lit(0)).alias("lcp"), "m", place)))
    first = stored(runs.groupBy("m", "head").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    copies = runs.join(first, ["m", "head"]).filter("place <> first").select("place.row", "place.start", "m")
    gone = copies.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("pos")).distinct()
    return gone.join(active.select("row", "pos", "line"), ["row", "pos"]).select("row", "line")


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, plus ``n_lines`` and ``n_deleted``, with later copies deleted from ``text``.

    A run of consecutive lines (blank ones apart) that holds ``min_words`` words and occurs
    before, in a smaller doc_id (null first) or earlier in the text, is deleted; the first
    copy stays, so no line is lost everywhere. Null texts stay null, texts without repeats
    stay as they are, and one that is all repeats becomes empty. Repeated rows count as
    later copies of the first. Columns named n_lines or n_deleted are replaced. An empty
    table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    whole = F.struct(*names).alias("_row")
    kept = stored(docs.select(F.monotonically_increasing_id().alias("row"), whole))
    rows = kept.select("row", F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.text").cast("string").alias("text"))
    gone = repeated_lines(rows, min_words).groupBy("row").agg(F.collect_list("line").alias("gone"))
    body = F.col("_row.text")

    def joined(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n")

    # The lines are bound to a name, else every one would cut the text anew.
    text = F.element_at(F.transform(F.array(F.split(body, "\n")), joined), 1)
    out = kept.join(gone, "row", "left")
    columns = [F.col("_row")[c].alias(c) if c != "text" else F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(text).alias("text") for c in names]
    ends = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit("")))
    counted = F.when(body.isNull(), 0).otherwise(ends + 1)
    return out.select(*columns, counted.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_deleted"))
