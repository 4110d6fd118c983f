"""Near duplicates by SimHash fingerprints and anchors of a covering code.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit of
one of their halves. The anchors of a half are the words of a covering code of radius 1:
the perfect Hamming code on 31 bits, with the 32nd bit free. A fingerprint's home is the
anchor nearest to it, at most one bit away; it is replicated to every anchor within the
covering radius plus the half's threshold, two bits, at most 17 of them. A linked pair so
meets at the home anchor of either, and only homes are compared with what is replicated
there. Equal fingerprints collapse before, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, given_back, only, settled, spans, texts_of, whole_keys
from pacewatch.llm.components import components

#: Bits that may differ between linked fingerprints; the halves' thresholds follow from it.
THRESHOLD = 3
SEED = 42
#: Shingles turned to bits at a time.
CHUNK = 1 << 16
#: Bytes of the texts whose shingle hashes are held at a time.
HELD_BYTES = 2 << 20
#: Members of an anchor that are compared row by row; larger anchors are searched by spreading.
SMALL_ANCHOR = 32
#: Fingerprints of an anchor that one task compares; larger anchors are cut into pieces.
LARGE_ANCHOR = 65_536
#: One fingerprint in so many is counted to find large anchors. It decides the cut, not the links.
COUNTED = 64


def fingerprints_of(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """SimHash of each text: a bit is 1 if more than half of the shingle hashes have it."""
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()
        before = len(hashes)
        if len(words) >= shingle:
            hashes += [digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle))))]
        elif words:
            hashes.append(digest(b" ".join(words), SEED))
        sizes[i] = len(hashes) - before
    totals = np.zeros((len(texts), 64), np.int64)
    values = np.array(hashes, np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    for at in range(0, len(values), CHUNK):
        part, of = values[at : at + CHUNK], owner[at : at + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts, _ = spans(of)
        totals[of[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    ones = totals * 2 > sizes[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row; null and empty texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            texts = texts_of(batch)
            ends = np.cumsum([len(x) for x in texts]) // HELD_BYTES
            cut = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
            parts = [fingerprints_of(texts[a:b], shingle) for a, b in zip(cut, cut[1:])]
            fps = np.concatenate(parts).view(np.int64)
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Position (1 to 31) of the bit by which a 31-bit word misses the Hamming code, 0 for none."""
    out = np.zeros(len(words), np.uint64)
    for bit, mask in enumerate(_PARITY):
        out |= (np.bitwise_count(words & mask) & 1).astype(np.uint64) << np.uint64(bit)
    return out


_PARITY = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1)) for bit in range(5)]
#: Error patterns of two bits for each syndrome: 15 pairs i ^ j = s.
_PAIRS = np.array(
    [[0] * 15, *([(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < (i ^ s)] for s in range(1, 32))], np.uint64
)
_TOP = np.uint64(1 << 31)


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home) of every anchor within two bits of either half of each fingerprint."""
    rows, keys, homes = [], [], []
    index = np.arange(len(fps))
    for half in (0, 1):
        word = (fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        low = word & ~_TOP
        s = _syndromes(low)
        nearest = word ^ np.where(s > 0, np.uint64(1) << np.where(s > 0, s - np.uint64(1), 0).astype(np.uint64), np.uint64(0))
        off = np.flatnonzero(s)
        two = (word[off, None] ^ _PAIRS[s[off].astype(np.int64)]).reshape(-1)
        tag = np.uint64(half << 32)
        rows += [index, index, np.repeat(off, 15)]
        keys += [nearest | tag, (nearest ^ _TOP) | tag, two | tag]
        homes += [np.ones(len(index), bool), np.zeros(len(index), bool), np.zeros(len(two), bool)]
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _spread(fps: np.ndarray, home: np.ndarray, limit: int) -> np.ndarray:
    """Index of a linked representative for each member of one anchor, by spreading.

    Every round compares what was reached last with what is not reached yet, so a dense
    group costs about its size times a few, and pairs are never listed.
    """
    label = np.full(len(fps), -1)
    left = np.arange(len(fps))
    while len(left):
        seed = left[np.argmax(home[left])]
        label[seed] = seed
        if not home[left].any():
            label[left] = left
            break
        front, left = np.array([seed]), left[left != seed]
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for at in range(0, len(front), 64):
                f = front[at : at + 64]
                near = np.bitwise_count(fps[f, None] ^ fps[None, left]) <= limit
                reached |= (near & (home[f, None] | home[None, left])).any(0)
            front, left = left[reached], left[~reached]
            label[front] = seed
    return label


def links_at_anchors(keys: np.ndarray, fps: np.ndarray, home: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join up all fingerprints within ``limit`` bits at each anchor; keys are sorted."""
    starts, sizes = spans(keys)
    a, b = [], []
    small = np.repeat(sizes <= SMALL_ANCHOR, sizes)
    for gap in range(1, SMALL_ANCHOR):
        i = np.flatnonzero((keys[gap:] == keys[:-gap]) & small[gap:])
        if not len(i):
            break
        i = i[(home[i] | home[i + gap]) & (np.bitwise_count(fps[i] ^ fps[i + gap]) <= limit)]
        a.append(fps[i])
        b.append(fps[i + gap])
    for start, size in zip(starts[sizes > SMALL_ANCHOR], sizes[sizes > SMALL_ANCHOR]):
        own = fps[start : start + size]
        label = _spread(own, home[start : start + size], limit)
        joined = np.flatnonzero(label != np.arange(size))
        a.append(own[joined])
        b.append(own[label[joined]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _cells(placed: DataFrame, distinct: DataFrame, replicate, large: int) -> DataFrame:
    """(cell, fp, home): what is compared together, at most about twice ``large`` rows a cell.

    An anchor of bounded size is one cell. A larger one is cut into pieces by hash; the homes
    of every piece meet all members of every piece, each two pieces in a cell of their own.
    """
    step = min(COUNTED, large)
    some = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("fp")
    counted = some.mapInArrow(replicate, _PLACED).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") * step / F.lit(large)).cast("int")
    crowded = settled(counted.select(F.col("anchor").alias("at"), pieces.alias("pieces")).filter("pieces > 1"))
    if crowded.isEmpty():
        return placed.withColumnRenamed("anchor", "cell")
    met = placed.join(crowded, placed.anchor == crowded["at"], "left")
    plain = met.filter("pieces is null").select(F.col("anchor").alias("cell"), "fp", "home")
    cut = met.filter("pieces is not null").withColumn("own", F.pmod(F.xxhash64("fp", F.lit("piece")), F.col("pieces")))
    every = F.explode(F.expr("sequence(0L, pieces - 1L)")).alias("other")
    cell = F.xxhash64("anchor", "row", "column").alias("cell")
    homes = cut.filter("home").select("anchor", "fp", F.col("own").alias("row"), every).withColumnRenamed("other", "column")
    members = cut.select("anchor", "fp", "home", F.col("own").alias("column"), every).withColumnRenamed("other", "row")
    # Where a piece meets itself its homes are there already.
    members = members.filter("not home or row <> column")
    return plain.unionByName(homes.select(cell, "fp", F.lit(True).alias("home"))).unionByName(
        members.select(cell, "fp", F.lit(False).alias("home"))
    )


_PLACED = "anchor long, fp long, home boolean"


def near_links(distinct: DataFrame, limit: int = THRESHOLD, large: int = LARGE_ANCHOR) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (column ``fp``) that are within ``limit`` bits.

    One task holds about ``large`` fingerprints of an anchor, however many it has.
    """
    if limit > THRESHOLD:
        raise ValueError("two halves with radius 1 cover at most three differing bits")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            fps = column_of(batch, "fp").to_numpy(zero_copy_only=False).view(np.uint64)
            row, key, home = anchors(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(fps[row].view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_keys(batches, "cell"):
            a, b = links_at_anchors(
                group.column("cell").to_numpy(),
                group.column("fp").to_numpy().view(np.uint64),
                group.column("home").to_numpy(),
                limit,
            )
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    placed = distinct.select("fp").mapInArrow(replicate, _PLACED)
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = _cells(placed, distinct, replicate, large).repartition(parts, "cell").sortWithinPartitions("cell")
    return met.mapInArrow(compare, "a long, b long")


def near_groups(docs: DataFrame, shingle: int = 3, limit: int = THRESHOLD) -> DataFrame:
    """One row per document: (doc_id, fp, component_id, group_size).

    ``component_id`` is the smallest doc_id that links reach, the row's own included. Null
    and empty texts have fingerprint zero and are linked like any other. Repeated rows are
    members like any other; a null doc_id never names a component unless all members are
    null. Other columns are not read. An empty table gives no rows.
    """
    prints = settled(fingerprints(docs, shingle))
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    roots = components(near_links(distinct, limit))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("group_size"))
    classes = settled(rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "group_size"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id", "group_size")


def drop_near(docs: DataFrame, key: str = "doc_id", shingle: int = 3, limit: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group: the smallest key.

    The key names a document: rows that repeat a key with near-equal texts are copies, and
    one of them stays; rows that share a key but have unlike texts all stay. Where all keys
    of a group are null, one row stays. Columns of any name may be present.
    """
    packed = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )
    groups = near_groups(packed, shingle, limit)
    stays = groups.filter("group_size = 1 or doc_id <=> component_id")
    stay = settled(stays.groupBy(F.col("doc_id").alias("stays")).agg(F.max(F.col("group_size") == 1).alias("single")))
    kept = packed.join(stay, F.col("doc_id").eqNullSafe(F.col("stays")))
    first = kept.filter(~F.col("single")).groupBy("stays").agg(F.first("row").alias("row"))
    return kept.filter("single").select("row").unionByName(first.select("row")).select("row.*")
