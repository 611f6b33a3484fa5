"""Token counts of a piece vocabulary by rank-synchronous merging of ragged arrays.

Texts are cut where no piece can reach across: before a run of space marks, and at characters in no longer piece.
The distinct cuts a worker has not met yet are laid out as one flat array of symbols with sequence offsets. Each
round finds every sequence's best pair (leftmost of equal ones) and merges all of them at once, until no
sequence has a pair left; surviving symbols are counted, characters without a piece as their bytes. A very
long sequence is merged alone with a heap, in the same order.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .ragged import PairTable
from .shared import free, text_or_empty

MARK = "▁"
#: A worker forgets its counts beyond so many cuts.
CACHE = 500_000
#: Texts whose new cuts are merged together.
BATCH = 128


@dataclass
class PieceTable:
    """Symbols of single characters, pairs that make a piece, and a character to cut at (or none)."""

    pairs: PairTable
    symbols: dict[str, int]
    cut: str

    @classmethod
    def load(cls, model_file: str) -> PieceTable:
        """Reads a model file of the sentencepiece library; it must have byte fallback and identity normalisation."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        ids = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not special(i)}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("a piece reaches across a space mark")
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in ids.values()}, reverse=True))}
        size = model.get_piece_size()
        pairs = PairTable.of(size, [
            (ids[p[:k]], ids[p[k:]], order[model.get_score(i)], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ])
        joined = {c for p in ids if len(p) > 1 for c in p}
        # New lines stand alone in most vocabularies: cutting at them keeps the cuts few and short.
        cut = "" if "\n" in joined else "\n"
        return cls(pairs, {p: i for p, i in ids.items() if len(p) == 1}, cut)

    def chunks(self, text: str) -> list[str]:
        """Parts of a text whose counts add up: its words if single spaces part them, else cuts, told from words
        by one more mark in front."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [MARK + c for c in self.cuts(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def cuts(self, marked: str) -> list[str]:
        """A text with space marks, cut where no merge can reach across."""
        return self._pattern.findall(marked)

    def __post_init__(self) -> None:
        self._by_point = np.full(0x110000, -1, np.int32)
        for char, piece in self.symbols.items():
            self._by_point[ord(char)] = piece
        c = re.escape(self.cut)
        self._pattern = re.compile(f"{MARK}*[^{MARK}{c}]+|{MARK}+" + (f"|{c}" if c else ""))

    def count(self, cuts: list[str]) -> list[int]:
        """Number of tokens of each (non-empty) cut: surviving pieces, and bytes of characters without a piece."""
        if not cuts:
            return []
        points = np.frombuffer("".join(cuts).encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self._by_point[points]
        widths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        flat = np.where(found >= 0, found, -widths).astype(np.int64)
        merged, lengths = self.pairs.merge(flat, np.fromiter(map(len, cuts), np.int64, len(cuts)))
        return np.add.reduceat(np.where(merged >= 0, 1, -merged), np.cumsum(lengths) - lengths).tolist()


class Counter:
    """Counts texts, remembering the cuts it has met."""

    def __init__(self, table: PieceTable):
        self.table, self.known = table, {}

    def __call__(self, texts: Iterable[str]) -> list[int]:
        chunks = [self.table.chunks(t) for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        new = list(set().union(*chunks) - self.known.keys())
        # A word stands for itself with the space mark before it; line breaks inside cut it again.
        cuts = [[c[1:]] if c[0] == MARK else self.table.cuts(MARK + c) for c in new]
        counts = iter(self.table.count([x for c in cuts for x in c]))
        self.known.update((c, sum([next(counts) for _ in x])) for c, x in zip(new, cuts, strict=True))
        known = self.known.__getitem__
        return [sum(map(known, c)) for c in chunks]


#: The counter of this worker process, kept between tasks with what it knows.
_worker: dict[str, Counter] = {}


def _kept(name: str, shared: Broadcast) -> Counter:
    if name not in _worker:
        _worker.clear()
        _worker[name] = Counter(shared.value)
    return _worker[name]


def count_tokens(docs: DataFrame, model_file: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """All columns of ``docs`` except ``text``, with ``n_bytes`` and ``out``; null text is the empty text (0 tokens).

    Columns already named ``n_bytes`` or like ``out`` are replaced. The model's tables (a few MB) are broadcast.
    """
    rest = [c for c in docs.columns if c not in (text, "n_bytes", out)]
    whole = text_or_empty(text)
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias(*free([*rest, "n_bytes"], "_text")))
    schema = StructType(rows.schema.fields[:-1]).add(out, "long")
    shared = docs.sparkSession.sparkContext.broadcast(PieceTable.load(model_file))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _kept(name, shared)
        for batch in batches:
            *others, source = batch.columns
            counts: list[int] = []
            for low in range(0, len(source), BATCH):
                counts += counter(source.slice(low, BATCH).to_pylist())
            yield pa.RecordBatch.from_arrays([*others, pa.array(counts, pa.int64())], [*rest, "n_bytes", out])

    return rows.mapInArrow(run, schema)
