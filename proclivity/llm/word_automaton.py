"""BPE encoding and decoding over a minimal acyclic transducer of frequent words.

Words are counted over the whole corpus; those with at least one millionth of all occurrences (so at most a million
words) are compiled, in sorted order, into a minimal acyclic automaton: equal suffixes share states, and the
numbers along a word's path add up to its place in a table of id sequences. The arrays are broadcast, written to an
unlinked file on each worker and memory-mapped. Words outside it are merged by rank, exactly. Both give the
vocabulary's ids, so the automaton changes nothing but speed.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .ragged import PairTable
from .shared import free, text_or_empty

#: Share of all word occurrences from which a word is compiled; 1 / FREQUENT bounds the automaton.
FREQUENT = 1e-6
#: A worker forgets rare chunks when it knows so many, all if half of them are frequent.
CACHE = 250_000
#: Distinct chunks counted by a task before they are sent on.
FLUSH = 200_000
#: Characters for which this module's cutting is the same as the library's in every Unicode version.
PLAIN = re.compile(r"[^\n\t\r -~\xa1-\xac\xae-įĲ-ž–-…]")


@dataclass
class Vocabulary:
    """What is needed of a tokenizers file: byte-level BPE with a word-end suffix, lower case, words by a pattern."""

    source: str
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    pattern: str
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            source = f.read()
        spec = json.loads(source)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or model["type"] != "BPE" or spec["decoder"]:
            raise ValueError("only lower-casing byte-level BPE with word ends and without a decoder is supported")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(
            source, model["vocab"], {m: i for i, m in enumerate(merges)}, model["end_of_word_suffix"],
            split["pattern"]["Regex"], special,
        )


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


#: Marks a key that is one whole word or special token, not a chunk still to be cut.
WHOLE = "\0"


class WordCutter:
    """Cuts texts into chunks and chunks into words, together as the library cuts texts.

    No word reaches across white space, so the words of a text are those of its chunks.
    """

    def __init__(self, vocabulary: Vocabulary):
        plain = [chr(c) for c in range(0x250) if PLAIN.search(chr(c)) is None]
        classes = {kind: "".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN"}
        pattern = vocabulary.pattern.replace(r"\p{L}", classes["L"]).replace(r"\p{N}", classes["N"])
        self.words = re.compile(pattern)
        self.special = vocabulary.special
        self.split = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.vocabulary, self.slow = vocabulary, None

    def _unusual(self, text: str) -> list[str]:
        """Any characters: the library's own normaliser and pattern."""
        if self.slow is None:
            from tokenizers import Regex, Tokenizer, pre_tokenizers

            normalizer = Tokenizer.from_str(self.vocabulary.source).normalizer
            self.slow = (normalizer, pre_tokenizers.Split(Regex(self.vocabulary.pattern), "removed", invert=True))
        normalizer, cut = self.slow
        return [WHOLE + w for w, _ in cut.pre_tokenize_str(normalizer.normalize_str(text))]

    def chunks(self, text: str) -> list[str]:
        """Keys in order: lower-cased runs without white space, or whole words and special tokens."""
        parts = [text] if self.split is None or "<|" not in text else self.split.split(text)
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append(WHOLE + part)
            elif PLAIN.search(part) is None:
                out += part.lower().split()
            else:
                out += self._unusual(part)
        return out

    def words_of(self, chunk: str) -> list[str]:
        return [chunk[1:]] if chunk[0] == WHOLE else self.words.findall(chunk)


class Merger:
    """Ids of words by their pairs' ranks, many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        ids, suffix, self.special = vocabulary.ids, vocabulary.suffix, vocabulary.special
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)
        self.pairs = PairTable.of(len(ids), [(ids[a], ids[b], r, ids[a + b]) for (a, b), r in vocabulary.ranks.items()])

    def __call__(self, words: list[str]) -> list[list[int]]:
        plain = [w.encode("utf-8", "surrogatepass") for w in words if w not in self.special]
        lengths = np.fromiter(map(len, plain), np.int64, len(plain))
        data = np.frombuffer(b"".join(plain), np.uint8)
        flat = self.inner[data]
        ends = np.cumsum(lengths) - 1
        flat[ends] = self.last[data[ends]]
        merged, counts = self.pairs.merge(flat, lengths)
        ids = merged.tolist()
        found = iter([ids[e - n : e] for e, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True)])
        return [[self.special[w]] if w in self.special else next(found) for w in words]


@dataclass
class Automaton:
    """Arcs sorted by ``state * 256 + byte`` with target and number; words end in final states; id sequences.

    A word's place is the sum of its arcs' numbers: how many compiled words come before it.
    """

    keys: np.ndarray
    targets: np.ndarray
    numbers: np.ndarray
    final: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray

    @classmethod
    def compile(cls, words: list[bytes], ids: list[list[int]]) -> Automaton:
        """From distinct non-empty words in ascending order, without building a trie first."""
        register: dict[tuple, int] = {}
        arcs_of: list[tuple[tuple[int, int], ...]] = []
        finals: list[bool] = []

        def freeze(final: bool, arcs: list[list[int]]) -> int:
            key = (final, tuple(map(tuple, arcs)))
            if key not in register:
                register[key] = len(arcs_of)
                arcs_of.append(key[1])
                finals.append(final)
            return register[key]

        # The states along the last word, not frozen yet: [is final, [[byte, frozen target], ...]].
        path: list[list] = [[False, []]]
        last = b""
        for word in words:
            shared = len(os.path.commonprefix([word, last]))
            for depth in range(len(last), shared, -1):
                state = path.pop()
                path[-1][1].append([last[depth - 1], freeze(state[0], state[1])])
            path.extend([False, []] for _ in word[shared:])
            path[-1][0] = True
            last = word
        for depth in range(len(last), 0, -1):
            state = path.pop()
            path[-1][1].append([last[depth - 1], freeze(state[0], state[1])])
        root = freeze(path[0][0], path[0][1])
        # Targets are frozen before the states that lead to them, so counts of words below are known in order.
        below = np.zeros(len(arcs_of), np.int64)
        keys, targets, numbers = [], [], []
        for state, arcs in enumerate(arcs_of):
            number = int(finals[state])
            for byte, target in arcs:
                keys.append(state * 256 + byte)
                targets.append(target)
                numbers.append(number)
                number += int(below[target])
            below[state] = number
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        lengths = np.array([len(x) for x in ids], np.int64)
        return cls(
            np.array(keys, np.int64)[order], np.array(targets, np.int64)[order], np.array(numbers, np.int64)[order],
            np.array([*finals, False], bool) if root == len(finals) - 1 else np.array(finals, bool),
            np.concatenate([[0], np.cumsum(lengths)]), np.array([i for x in ids for i in x], np.int64),
        )

    @property
    def root(self) -> int:
        return len(self.final) - 2

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 for words not compiled: all words walk in step, byte by byte."""
        n = len(words)
        place = np.zeros(n, np.int64)
        if not len(self.keys) or not n:
            return place - 1
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        state = np.full(n, self.root)
        active = np.arange(n)
        step = 0
        while len(active := active[lengths[active] > step]):
            key = state[active] * 256 + data[starts[active] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            state[active] = np.where(found, self.targets[at], -1)
            place[active] += self.numbers[at]
            active = active[found]
            step += 1
        return np.where(self.final[state], place, -1)

    def packed(self) -> tuple[list[tuple[str, str, int, int]], bytes]:
        """Names, types, offsets and lengths of the arrays, and their bytes one after another."""
        parts, data = [], b""
        for name in self.__dataclass_fields__:
            a = np.ascontiguousarray(getattr(self, name))
            parts.append((name, a.dtype.str, len(data), len(a)))
            data += a.tobytes() + b"\0" * (-a.nbytes % 8)
        return parts, data

    @classmethod
    def mapped(cls, parts: list[tuple[str, str, int, int]], data: bytes) -> Automaton:
        """Memory-mapped from a file that is unlinked at once: nothing stays behind on the worker."""
        with tempfile.TemporaryFile() as f:
            f.write(data or b"\0")
            f.flush()
            whole = np.asarray(np.memmap(f, np.uint8, "r"))
        view = lambda kind, at, n: whole[at : at + n * np.dtype(kind).itemsize].view(kind)
        return cls(**{name: view(kind, at, n) for name, kind, at, n in parts})


def count_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """(word, n) over all texts. Each task adds up what it reads before anything is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, counts = WordCutter(shared.value), Counter()

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["chunk", "n"]
            )

        for batch in batches:
            for value in batch.column(0):
                counts.update(cutter.chunks(value.as_py()))
                if len(counts) > FLUSH:
                    yield packed()
                    counts.clear()
        yield packed()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = WordCutter(shared.value)
        for batch in batches:
            counts = Counter()
            for chunk, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in cutter.words_of(chunk):
                    counts[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

    chunks = docs.select(text_or_empty(text).alias("_text")).mapInArrow(run, "chunk string, n long")
    distinct = chunks.groupBy("chunk").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(cut, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(ws, docs: DataFrame, vocabulary: Vocabulary, text: str = "text", frequent: float = FREQUENT) -> Automaton:
    """The automaton of the corpus's frequent words: at most ``1 / frequent`` of them reach the driver."""
    counts = ws.write(count_words(docs, vocabulary, text), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") >= max(2.0, total * frequent)).select("word").toArrow().column(0).to_pylist()
    ws.drop(counts)
    words = sorted(w.encode() for w in often if w)
    merge = Merger(vocabulary)
    return Automaton.compile(words, merge([w.decode() for w in words]))


class Encoder:
    """Ids of texts: words from the automaton, others merged; remembers the chunks it has met."""

    def __init__(self, vocabulary: Vocabulary, automaton: Automaton):
        self.automaton = automaton
        self.cutter, self.merge = WordCutter(vocabulary), Merger(vocabulary)
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}
        self.frequent: list[str] = []
        self.tokens = {i: t for t, i in [*vocabulary.ids.items(), *vocabulary.special.items()]}

    def learn(self, chunks: list[str]) -> None:
        """Ids and decoding, as text, of new chunks."""
        cut = [self.cutter.words_of(c) for c in chunks]
        words, a = list(set().union(*cut)), self.automaton
        places = a.places([w.encode("utf-8", "surrogatepass") for w in words]).tolist()
        unseen = [w for w, place in zip(words, places, strict=True) if place < 0]
        ids = dict(zip(unseen, self.merge(unseen), strict=True))
        for word, place in zip(words, places, strict=True):
            if place >= 0:
                ids[word] = a.ids[a.offsets[place] : a.offsets[place + 1]].tolist()
        tokens, rare = self.tokens, set(unseen)
        for chunk, parts in zip(chunks, cut, strict=True):
            found = [i for w in parts for i in ids[w]]
            self.ids[chunk] = " ".join(map(str, found))
            self.decoded[chunk] = " ".join([tokens[i] for i in found])
            if rare.isdisjoint(parts):
                self.frequent.append(chunk)

    def forget(self) -> None:
        """Drops all but chunks of compiled words; those too if they are many."""
        if len(self.frequent) > CACHE // 2:
            self.frequent = []
        self.ids = {c: self.ids[c] for c in self.frequent}
        self.decoded = {c: self.decoded[c] for c in self.frequent}

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Per text: number of tokens, decimal ids joined by spaces, decoded text."""
        chunks = [self.cutter.chunks(t) for t in texts]
        if len(self.ids) > CACHE:
            self.forget()
        self.learn(list(set().union(*chunks) - self.ids.keys()))
        for own in chunks:
            ids = " ".join(map(self.ids.__getitem__, own))
            yield ids.count(" ") + 1 if own else 0, ids, " ".join(map(self.decoded.__getitem__, own))


#: The encoder of this worker process, kept between tasks with what it knows.
_worker: dict[str, Encoder] = {}


def _kept(call: str, shared: Broadcast) -> Encoder:
    if call not in _worker:
        _worker.clear()
        vocabulary, packed = shared.value
        _worker[call] = Encoder(vocabulary, Automaton.mapped(*packed))
    return _worker[call]


def encode(ws, docs: DataFrame, tokenizer_file: str, text: str = "text", digests: bool = False, frequent: float = FREQUENT) -> DataFrame:
    """All columns of ``docs`` except ``text``, with ``n_tokens`` and the encoded and decoded text.

    These are ``ids`` (array of int) and ``decoded``, or with ``digests`` their ``ids_sha256`` (of the decimal ids
    joined by one space) and ``decoded_sha256``. Existing columns of these names are replaced. Null text is the
    empty text: no ids, empty decoding. Special tokens' strings inside texts become their ids, as by default.
    """
    added = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    rest = [c for c in docs.columns if c not in (text, *added)]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], text_or_empty(text).alias(*free(rest, "_text")))
    vocabulary = Vocabulary.load(tokenizer_file)
    automaton = compile_lexicon(ws, docs, vocabulary, text, frequent)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, automaton.packed()))
    call = uuid.uuid4().hex
    schema = StructType(rows.schema.fields[:-1]).add("n_tokens", "long")
    for name in added[1:]:
        schema = schema.add(name, ArrayType(IntegerType()) if name == "ids" else StringType())

    def columns_of(found: list[tuple[int, str, str]]) -> list[pa.Array]:
        counts = pa.array([n for n, _, _ in found], pa.int64())
        if digests:
            digest = lambda s: sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
            return [counts, pa.array([digest(i) for _, i, _ in found]), pa.array([digest(t) for _, _, t in found])]
        ids = pa.array([[int(x) for x in i.split()] for _, i, _ in found], pa.list_(pa.int32()))
        return [counts, ids, pa.array([t for _, _, t in found], pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(call, shared)
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                *others, source = part.columns
                columns = columns_of(list(encoder(source.to_pylist())))
                yield pa.RecordBatch.from_arrays([*others, *columns], [*rest, *added])

    return rows.mapInArrow(run, schema)
