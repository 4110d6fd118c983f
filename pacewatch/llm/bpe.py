"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

A sequence of tokens is the encoding of its text exactly if every two neighbours are the
encoding of theirs. So the encoding of a prefix is known from its last token alone: the one
token that ends there and fits the last token of the prefix it leaves. Distinct words are
taken in sorted order, which is the depth-first order of their trie; the common prefix with
the word before is the path that is kept, so the state of a trie node is computed once at most, when a longer prefix asks for it.
The last symbol of a word is another one (it carries the word end), hence a leaf of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pacewatch.llm.common import bounded_batches, column_of, given_back, only

#: White space as the tokenizer file's ``\\s`` has it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Distinct words whose encodings a task keeps before it starts afresh.
KEPT_WORDS = 150_000
#: Rows of a batch that goes back to Spark.
ROWS_OUT = 500
#: Longest chain of prefix states that is worked out at a time.
DEEP = 64
#: Neighbour checks that a task keeps.
KEPT_CHECKS = 300_000
#: Characters of the texts whose words are held at a time.
HELD_CHARS = 2 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class TrieEncoder:
    """Encoder for a vocabulary with merges over byte-level symbols and a word-end suffix."""

    def __init__(self, spec: str):
        """``spec`` is the content of a tokenizer file."""
        file = json.loads(spec)
        model = file["model"]
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for order, (left, right) in enumerate(model["merges"]):
            self.rank.setdefault((vocab[left], vocab[right]), (order, vocab[left + right]))
        self.tokens: dict[int, str] = {i: token for token, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.tokens |= {i: token for token, i in self.special.items()}
        symbols = byte_symbols()
        byte_of = {symbol: b for b, symbol in enumerate(symbols)}
        self.parts: dict[int, list[int]] = {}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            ends = token.endswith(self.end)
            body = token[: -len(self.end)] if ends else token
            if not body or any(c not in byte_of for c in body):
                continue
            (self.final if ends else self.inner)[bytes(byte_of[c] for c in body)] = i
            self.parts[i] = [vocab[c] for c in body]
            if ends:
                self.parts[i][-1] = vocab[body[-1] + self.end]
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.fits: dict[tuple[int, int], bool] = {}
        names = "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({names})") if names else None
        # Python's own matcher is faster and cuts ASCII text the same way.
        self.word = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        self.ascii_word = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9]+")

    def merged(self, symbols: list[int]) -> list[int]:
        """Plain merging: lowest rank first, then leftmost."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            symbols[i : i + 2] = [self.rank[symbols[i], symbols[i + 1]][1]]
        return symbols

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens (left -1: the start) are the encoding of their joint text."""
        if len(self.fits) > KEPT_CHECKS:
            self.fits.clear()
        if left < 0:
            good = self.merged(self.parts[right]) == [right]
        else:
            good = self.merged(self.parts[left] + self.parts[right]) == [left, right]
        self.fits[left, right] = good
        return good

    def _last(self, word: bytes, depth: int, vocab: dict[bytes, int], last: list, sizes: list[int]) -> tuple[int, int]:
        """The last token of the prefix of this depth, and its length.

        States of shorter prefixes are worked out when they are first asked for.
        """
        fits = self.fits
        for size in range(min(self.longest, depth), 0, -1):
            token = vocab.get(word[depth - size : depth])
            if token is None:
                continue
            left = last[depth - size]
            if left is None:
                left, sizes[depth - size] = self._last(word, depth - size, self.inner, last, sizes)
                last[depth - size] = left
            good = fits.get((left, token))
            if good or (good is None and self._fit(left, token)):
                return token, size
        raise ValueError(f"no encoding of {word!r}")

    def encode_words(self, words: set[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Encoding of each distinct word, in the trie's depth-first order."""
        last: list[int | None] = [-1]
        sizes = [0]
        before = b""
        for word in sorted(words):
            inner = len(word) - 1
            shared, most = 0, min(len(before) - 1, inner)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            last[shared + 1 :] = [None] * (inner - shared)
            sizes[shared + 1 :] = [0] * (inner - shared)
            # Long words are worked through in steps, so that no chain of states gets deep.
            for depth in range(DEEP, inner + 1, DEEP):
                if last[depth] is None:
                    last[depth], sizes[depth] = self._last(word, depth, self.inner, last, sizes)
            token, size = self._last(word, inner + 1, self.final, last, sizes)
            ids, at = [token], inner + 1 - size
            while at:
                ids.append(last[at])
                at -= sizes[at]
            yield word, ids[::-1]
            before = word

    def words(self, text: str) -> Iterator[str]:
        """Normalise and cut; special tokens come out as they are."""
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                yield part
            elif part:
                if part.isascii():
                    yield from self.ascii_word.findall(part.lower())
                else:
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                    yield from self.word.findall(part.lower())

    def decode(self, ids) -> str:
        """The library's decoding where a file names no decoder: tokens joined by blanks."""
        return " ".join([self.tokens[i] for i in ids])


class TextEncoder:
    """Encodes texts in turn, keeping what is known of distinct words up to a bound."""

    def __init__(self, spec: str):
        self.trie = TrieEncoder(spec)
        self.known: dict[str, tuple[bytes, str]] = {}

    def run(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= HELD_CHARS or i == len(texts) - 1:
                yield from self._some(texts[start : i + 1])
                start, size = i + 1, 0

    def _some(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        cut = [list(self.trie.words(text)) for text in texts]
        new = set().union(*cut) - self.known.keys()
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = set().union(*cut)
        for name in new & self.trie.special.keys():
            self._learn(name, [self.trie.special[name]])
        plain = {word.encode(): word for word in new - self.trie.special.keys()}
        for word, ids in self.trie.encode_words(plain.keys()):
            self._learn(plain[word], ids)
        for words in cut:
            found = [self.known[word] for word in words]
            yield b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def _learn(self, word: str, ids: list[int]) -> None:
        packed = array("I", ids)
        self.known[word] = packed.tobytes(), self.trie.decode(packed)


@functools.lru_cache(maxsize=1)
def _encoder(spec: str) -> TextEncoder:
    """One encoder for all tasks of a worker process, with what it knows of words so far."""
    return TextEncoder(spec)


def _mapped(docs: DataFrame, spec: str, schema: str, row: Callable[[bytes, str], tuple]) -> DataFrame:
    """(doc_id, *row(ids, decoded)) of every document; the file's content goes out as a broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    names = ["doc_id", *(part.split()[0] for part in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in given_back(batches):
            texts = [x or "" for x in column_of(batch, "text").to_pylist()]
            rows = [row(*x) for x in encoder.run(texts)]
            # Token ids take more room than their text: they go out in several batches.
            for a in range(0, len(rows), ROWS_OUT):
                some = rows[a : a + ROWS_OUT]
                keys = column_of(batch, "doc_id").slice(a, len(some))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, zip(*some))], names=names)

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, f"doc_id long, {schema}")


def encoded(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row, texts whole.

    Null and empty texts have no ids and decode to the empty text. Repeated rows are encoded
    like any other; other columns are not read; an empty table gives no rows. Texts that
    hold the name of a special token get its id there.
    """

    def row(ids: bytes, decoded: str) -> tuple:
        return np.frombuffer(ids, np.int32), decoded

    return _mapped(docs, spec, "ids array<int>, decoded string", row)


def tokenized(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every row; see ``encoded``."""

    def row(ids: bytes, decoded: str) -> tuple:
        return len(ids) // 4, np.frombuffer(ids, np.int32), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _mapped(docs, spec, "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string", row)


def digests(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; see ``encoded``."""

    def row(ids: bytes, decoded: str) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _mapped(docs, spec, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
