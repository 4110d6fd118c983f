"""Exact duplicates by counting quotient filters.

Every partition packs the fingerprints of its texts into a counting quotient filter: the
quotient (high bits) names a run, the remainders of a run are sorted, and each carries its
count. Filters of the same quotient range merge losslessly, since equal remainders of one
run just add their counts. Fingerprints with a total above one are suspects; only their
texts are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import column_of, lower_ascii, settled

#: Fingerprints a merged filter segment should hold.
SEGMENT_KEYS = 1 << 18
#: Fingerprints gathered before a partition's filter is sealed and sent on.
FILTER_KEYS = 1 << 20

#: Bits, as a power of two, of the map of suspects that goes to every task: a million rows of two
#: numbers, 16 MB, at most. With very many suspects it fills up and lets more rows through, never fewer.
MAP_BITS = 26

FILTER_SCHEMA = "segment int, quotients binary, remainders binary, counts binary"


class QuotientFilter:
    """A counting quotient filter over 64-bit fingerprints, in sorted form.

    ``quotient_bits`` high bits are the quotient. The rest, the remainder, is stored in
    sorted order within the run of its quotient, together with a count.
    """

    def __init__(self, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray, quotient_bits: int):
        self.quotients, self.remainders, self.counts = quotients, remainders, counts
        self.quotient_bits = quotient_bits

    @classmethod
    def build(cls, fingerprints: np.ndarray, quotient_bits: int) -> QuotientFilter:
        keys, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
        shift = np.uint64(64 - quotient_bits)
        return cls((keys >> shift).astype(np.uint32), keys & ((np.uint64(1) << shift) - np.uint64(1)), counts, quotient_bits)

    @classmethod
    def merged(cls, parts: list[QuotientFilter]) -> QuotientFilter:
        """One filter by sorted (quotient, remainder); the counts of equal pairs add up."""
        quotients = np.concatenate([p.quotients for p in parts])
        remainders = np.concatenate([p.remainders for p in parts])
        counts = np.concatenate([p.counts for p in parts])
        order = np.lexsort((remainders, quotients))
        quotients, remainders = quotients[order], remainders[order]
        new = np.ones(len(order), bool)
        new[1:] = (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], at) if len(at) else counts
        return cls(quotients[at], remainders[at], total, parts[0].quotient_bits)

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        return QuotientFilter.merged([self, other])

    def fingerprints(self) -> np.ndarray:
        return (self.quotients.astype(np.uint64) << np.uint64(64 - self.quotient_bits)) | self.remainders

    def segments(self, bits: int) -> Iterator[tuple[int, QuotientFilter]]:
        """Cut by the top ``bits`` of the quotient."""
        top = self.quotients >> np.uint32(self.quotient_bits - bits)
        names, starts = np.unique(top, return_index=True)
        for name, a, b in zip(names, starts, [*starts[1:], len(top)]):
            yield int(name), QuotientFilter(self.quotients[a:b], self.remainders[a:b], self.counts[a:b], self.quotient_bits)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.quotients.tobytes(), self.remainders.tobytes(), self.counts.astype(np.uint32).tobytes()

    @classmethod
    def unpacked(cls, quotients: bytes, remainders: bytes, counts: bytes, quotient_bits: int) -> QuotientFilter:
        return cls(
            np.frombuffer(quotients, np.uint32),
            np.frombuffer(remainders, np.uint64),
            np.frombuffer(counts, np.uint32).astype(np.int64),
            quotient_bits,
        )


def repeated_fingerprints(fingerprints: DataFrame, rows: int, quotient_bits: int = 24) -> DataFrame:
    """The fingerprints (column ``fp``, long) that occur more than once, each once.

    ``rows`` sets how many segments the quotient range is cut into. A fingerprint reaches
    the merge at most once per sealed filter, however often it occurs.
    """
    bits = min(quotient_bits, max(4, (max(rows, 1) // SEGMENT_KEYS).bit_length()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def seal() -> pa.RecordBatch:
            parts = list(QuotientFilter.build(np.concatenate(held).view(np.uint64), quotient_bits).segments(bits))
            columns = zip(*(part.packed() for _, part in parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([name for name, _ in parts], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                names=["segment", "quotients", "remainders", "counts"],
            )

        for batch in batches:
            if batch.num_rows:
                held.append(column_of(batch, "fp").to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= FILTER_KEYS:
                yield seal()
                held.clear()
        if held:
            yield seal()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[QuotientFilter]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts = held.setdefault(row.pop("segment"), [])
                parts.append(QuotientFilter.unpacked(**row, quotient_bits=quotient_bits))
                # As many as there are sorted ones: each key is merged a few times, however many filters come.
                if len(parts) > 2 and sum(len(p.counts) for p in parts[1:]) > max(SEGMENT_KEYS, len(parts[0].counts)):
                    parts[:] = [QuotientFilter.merged(parts)]
        for parts in held.values():
            part = QuotientFilter.merged(parts)
            found = part.fingerprints()[part.counts > 1]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["fp"])

    filters = fingerprints.select("fp").mapInArrow(build, FILTER_SCHEMA)
    return filters.repartition(1 << bits, "segment").mapInArrow(merge, "fp long")


def _slot(key: Column) -> tuple[Column, Column]:
    """Word and bit of a 64-bit hash in a map of 2**MAP_BITS bits."""
    bit = key.bitwiseAND(F.lit(63)).cast("int")
    return F.shiftrightunsigned(key, 64 - MAP_BITS + 6), F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bit_map(keys: DataFrame, key: Column) -> DataFrame:
    """(word, bits): a bit for every hash, at most 2**(MAP_BITS - 6) rows."""
    word, bit = _slot(key)
    return keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def in_map(key: Column) -> Column:
    """Whether a row joined with a map by ``same_word`` may have its hash there."""
    return F.coalesce(F.col("bits").bitwiseAND(_slot(key)[1]) != 0, F.lit(False))


def same_word(key: Column) -> Column:
    return F.col("word") == _slot(key)[0]


def _digest(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def repeated_texts(docs: DataFrame, text: str = "text", key: str = "doc_id", normal=lower_ascii) -> DataFrame:
    """Groups of two rows or more with one text: (text_sha256, keep_id, group_size).

    Texts whose hash has no bit in the map of suspects, which is broadcast and bounded, never
    leave their task; the others meet the suspects themselves. Of a group of copies each
    map task then sends one. Byte verification: the least and the greatest text of a digest
    must be equal.
    """
    body: Column = normal(F.col(text))
    prints = settled(docs.select(F.xxhash64(body).alias("fp")))
    suspects = settled(repeated_fingerprints(prints, prints.count()))
    texts = docs.select(F.xxhash64(body).alias("fp"), body.alias("body"), F.col(key).cast("long").alias("doc_id"))
    marked = F.broadcast(bit_map(suspects, F.col("fp")))
    groups = (
        texts.join(marked, same_word(F.col("fp")) & in_map(F.col("fp")), "left_semi")
        .join(suspects, "fp", "left_semi")
        .groupBy(_digest(F.col("body")).alias("text_sha256"))
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
            F.min("body").alias("low"),
            F.max("body").alias("high"),
        )
        .filter("group_size > 1")
    )
    same = F.when(F.col("low") == F.col("high"), F.col("group_size"))
    clash = F.raise_error(F.lit("different texts have one SHA-256 digest")).cast("long")
    return settled(groups.select("text_sha256", "keep_id", same.otherwise(clash).alias("group_size")))


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", normal=lower_ascii) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, text_sha256).

    Null text counts as empty, so empty and null texts form one group. A repeated row is one
    more member of its group. Rows with a null key are members too; ``keep_id`` is null only
    where no member has a key. Texts of any length are read whole. Other columns are not
    read. An empty table gives no rows.
    """
    groups = repeated_texts(docs, text, key, normal)
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), _digest(normal(F.col(text))).alias("text_sha256"))
    return slim.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )


def drop_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", normal=lower_ascii) -> DataFrame:
    """The rows of ``docs``, all columns, without later copies: the largest key of a group stays.

    Of fully repeated rows one stays. Columns of any name may be present. Rows whose digest
    has no bit in a bounded map of the repeated ones stay without a shuffle.
    """
    groups = repeated_texts(docs, text, key, normal).withColumnRenamed("text_sha256", "digest")
    packed = docs.select(
        F.col(key).cast("long").alias("id"),
        _digest(normal(F.col(text))).alias("digest"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )
    key64 = F.xxhash64("digest")
    hinted = packed.join(F.broadcast(bit_map(groups, key64)), same_word(key64), "left").withColumn("hinted", in_map(key64))
    alone = hinted.filter(~F.col("hinted")).select("row")
    marked = hinted.filter("hinted").select("id", "digest", "row").join(groups, "digest", "left")
    chance = marked.filter("group_size is null").select("row")
    best = marked.filter(F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
    first = best.groupBy("digest").agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(chance).unionByName(first).select("row.*")
