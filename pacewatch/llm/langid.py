"""Language of texts by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, drawn from its code point. An
n-gram's vector binds its letters' vectors, each permuted (rolled) by its distance from the
end, by multiplication. A text's vector bundles (adds) those of its n-grams, a language's
prototype those of all its texts, and a text has the language whose prototype has the
largest cosine with it.

Letters are compared in lower case; a run of anything else is one boundary mark, which is a
letter of its own. All sums are of whole numbers, so neither order nor partitions matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, fold, given_back, only, spans, texts_of

FOLDS, HELD_OUT = 5, 0
#: Answer for texts without a letter, and where no language was learnt.
UNKNOWN = "und"
#: Signs of a vector, and letters of an n-gram.
DIMENSIONS, GRAM = 2_048, 3
SEED = 42
#: Texts that are bundled together, and the letters after which they are.
TOGETHER, LETTERS = 32, 1 << 17
#: Characters of a text that are cut at a time.
SLICE = 1 << 20
#: N-gram vectors that a worker holds, and n-grams that are bound or added at a time.
HELD, BOUND = 1 << 14, 1 << 12
#: Languages that a model may hold: its prototypes go to every task.
LANGUAGES = 4_096
#: Whole numbers add up exactly in single precision below this.
SINGLE = 1 << 24


@cache
def _letters() -> np.ndarray:
    """The code point of every letter, 0 for all else."""
    points = np.arange(0x110000, dtype=np.int64)
    return np.where([chr(p).isalpha() for p in range(0x110000)], points, 0)


def grams(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text as numbers, slice by slice; none if it has no letter."""
    last = np.zeros(1, np.int64)
    found = False
    for at in range(0, len(text), SLICE):
        part = text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass")
        marks = np.concatenate([last, _letters()[np.frombuffer(part, np.uint32)]])
        # What the slice before has given stays in front for its n-grams across the cut.
        own = np.r_[np.ones(len(last), bool), (marks[len(last) :] > 0) | (marks[len(last) - 1 : -1] > 0)]
        marks = marks[own]
        found = found or bool((marks > 0).any())
        if found:
            yield _numbered(marks)
        last = marks[-(GRAM - 1) :]
    if found and last[-1] > 0:
        yield _numbered(np.append(last, 0))


def _numbered(marks: np.ndarray) -> np.ndarray:
    """Each window of letters as one number of 21 bits a letter."""
    n = max(0, len(marks) - GRAM + 1)
    out = np.zeros(n, np.int64)
    for k in range(GRAM):
        out = out << 21 | marks[k : k + n]
    return out


class Space:
    """Vectors of n-grams, bound when first met; what is held is bounded."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.known = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, DIMENSIONS), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= HELD:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox([SEED, point])).integers(0, 2, DIMENSIONS, np.int8)
            self.letters[point] = bits * 2 - 1
        return self.letters[point]

    def bind(self, numbers: np.ndarray) -> np.ndarray:
        """Vectors of n-grams: the letters' vectors, permuted by their distance from the end, multiplied."""
        out = np.ones((len(numbers), DIMENSIONS), np.int8)
        for k in range(GRAM):
            points, which = np.unique(numbers >> (21 * k) & 0x1FFFFF, return_inverse=True)
            out *= np.stack([np.roll(self.letter(int(p)), k) for p in points])[which]
        return out

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Vectors of at most ``BOUND`` sorted distinct n-grams."""
        place = np.searchsorted(self.known, numbers)
        there = np.zeros(len(numbers), bool)
        inside = place < len(self.known)
        there[inside] = self.known[place[inside]] == numbers[inside]
        if not there.all():
            new = numbers[~there]
            if len(self.known) + len(new) > HELD:
                self.known, self.vectors = numbers, self.bind(numbers)
                return self.vectors
            known, vectors = np.r_[self.known, new], np.concatenate([self.vectors, self.bind(new)])
            order = np.argsort(known, kind="stable")
            self.known, self.vectors = known[order], vectors[order]
            place = np.searchsorted(self.known, numbers)
        return self.vectors[place]

    def bundle(self, owners: np.ndarray, numbers: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Sums of the n-grams' vectors times counts, by owner (0 to n - 1)."""
        out = np.zeros((n, DIMENSIONS), np.int64)
        kind = np.float32 if counts.sum() < SINGLE else np.float64
        distinct, which = np.unique(numbers, return_inverse=True)
        for at in range(0, len(distinct), BOUND):
            part = distinct[at : at + BOUND]
            mine = (which >= at) & (which < at + len(part))
            table = np.zeros((n, len(part)), kind)
            np.add.at(table, (owners[mine], which[mine] - at), counts[mine])
            out += (table @ self.of(part).astype(kind)).astype(np.int64)
        return out


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) of all texts."""
    owners, numbers, counts = [], [], []
    for i, text in enumerate(texts):
        for part in grams(text):
            part.sort()
            starts, sizes = spans(part)
            numbers.append(part[starts])
            counts.append(sizes)
            owners.append(np.full(len(starts), i))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in (owners, numbers, counts))


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut into few texts of bounded size; one text may be larger."""
    for batch in given_back(batches):
        sizes = np.array([len(x) for x in texts_of(batch)], np.int64)
        start, held = 0, 0
        for i, size in enumerate([*sizes.tolist(), None]):
            if size is None or (i > start and (i - start >= TOGETHER or held + size > LETTERS)):
                if i > start:
                    part = batch.slice(start, i - start)
                    yield part, [x.decode("utf-8", "replace") for x in texts_of(part)]
                start, held = i, 0
            held += size or 0


class Model:
    """Prototypes of the languages, in the order of their names' bytes."""

    def __init__(self, languages: list[str], prototypes: np.ndarray):
        order = sorted(range(len(languages)), key=lambda i: languages[i].encode("utf-8", "surrogatepass"))
        self.languages = [languages[i] for i in order]
        wide = prototypes[order].astype(np.float64).reshape(len(order), DIMENSIONS)
        norms = np.sqrt((wide * wide).sum(1, keepdims=True))
        self.prototypes = wide / np.where(norms > 0, norms, 1)

    def judge(self, space: Space, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and cosine, at least 0, of each text; equal cosines go to the first name."""
        owners, numbers, counts = counted(texts)
        wide = space.bundle(owners, numbers, counts, len(texts)).astype(np.float64)
        lettered = np.zeros(len(texts), bool)
        lettered[owners] = True
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        norms = np.sqrt((wide * wide).sum(1))
        # A text's row is multiplied by itself, so that its company does not change its last bits.
        cosines = np.stack([self.prototypes @ row for row in wide]) / np.where(norms > 0, norms, 1)[:, None]
        best = cosines.argmax(1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0)


def train(docs: DataFrame) -> Model:
    """Prototypes from all documents outside the held-out fold that have a language.

    A task keeps one vector for each language it has met and sends it on; the driver gets one
    a language. More than ``LANGUAGES`` languages are an error: prototypes are broadcast.
    """
    rows = only(docs, doc_id="long", text="string", lang="string")
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, held = Space(), {}

        def sent() -> pa.RecordBatch:
            names = list(held)
            at = np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(names))
            values = np.concatenate([np.zeros(0, np.int64), *held.values()])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names, object), DIMENSIONS), pa.string()), pa.array(at), pa.array(values)], names=["lang", "at", "value"])

        for part, texts in _together(batches):
            langs, which = np.unique(np.array(column_of(part, "lang").to_pylist(), object), return_inverse=True)
            owners, numbers, counts = counted(texts)
            for name, vector in zip(langs, space.bundle(which[owners], numbers, counts, len(langs))):
                held[name] = held[name] + vector if name in held else vector
            if len(held) >= LANGUAGES:
                yield sent()
        yield sent()

    bounded_batches(docs.sparkSession)
    summed = rows.mapInArrow(sums, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    whole = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")).select("lang", "v.value")
    found = whole.limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages in the column lang")
    # A language whose texts hold no letter has no profile.
    found = [r for r in found if any(r["value"])]
    return Model([r["lang"] for r in found], np.array([r["value"] for r in found], np.int64).reshape(-1, DIMENSIONS))


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learns from the documents outside the held-out fold unless a model is given. Null texts
    and texts without a letter have the language ``und`` and score 0, as all texts have where
    no language was learnt. The score is the cosine with the language's prototype, at least
    0. A null doc_id counts as the empty text in its fold; repeated rows count, and are
    judged, each. Texts of any length are read whole, slice by slice. Other columns are not
    read. An empty table gives no rows.
    """
    model = train(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, own = Space(), shared.value
        for part, texts in _together(batches):
            names, score = own.judge(space, texts)
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "doc_id"), column_of(part, "held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = only(docs, doc_id="long", text="string").withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    bounded_batches(docs.sparkSession)
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double")
