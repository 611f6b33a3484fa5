"""Token-id files: documents as one sequence of ids, range coded in blocks that can be read alone.

A folder of ids holds Parquet files with a row for each block: its part (a range of documents), its number in the
part, how many ids it holds, their checksum, their code (see ``id_coder``), and the pieces of documents that lie in
it. Parts follow one another in ascending order of the documents' keys, as blocks do inside a part. Every block holds
``BLOCK`` ids but the last one of a part, and may begin or end inside a document.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .id_coder import checksum, decode_blocks, digits_for, encode_blocks
from .shared import text_or_empty

#: Ids in a block.
BLOCK = 2048
#: Blocks that a task codes side by side.
SIDE_BY_SIDE = 2048
#: A worker forgets words not met of late beyond so many.
CACHE = 250_000
#: Unknown parts that are encoded as one text.
TOGETHER = 2000
#: Bytes of text that are split at a time.
TEXT = 1 << 22
#: A piece of a document in a block: where the document starts in its part, where the piece starts in the document.
PIECE = "array<struct<key:{key},start:long,skipped:long,n:long>>"


class Encoder:
    """Ids of texts as the tokenizers library gives them; parts of texts between single spaces are remembered.

    The library's byte-level splitting never joins what stands on both sides of a space between two other
    characters, and takes that space to the right part. So unknown parts are encoded many at a time, as one text with
    spaces between them: each begins with the only token that holds a space. Distinct parts are looked up once a call.
    """

    _safe = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: Whether no special string can arise where two parts meet.
        self.joinable = not any(" " in s for s in self.special)
        vocabulary = self.library.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        #: Ids of parts with a space before them: those met of late, and those met before.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part after a space; no part holds one."""
        ids = np.array(self.library.encode_batch_fast([" " + " ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(parts) or starts[0]:
            return self._encode([" " + p for p in parts])
        flat, edges = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
        return [flat[low:high] for low, high in pairwise(edges)]

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts after a space, from what is known where possible."""
        if len(self.known) > CACHE // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        if missing := [p for p in parts if p not in known]:
            known.update((p, older[p]) for p in missing if p in older)
            new = [p for p in missing if p not in older]
            alone = [p for p in new if " " in p] if self.joinable else new
            known.update(zip(alone, self._encode([" " + p for p in alone]), strict=True))
            rest = [p for p in new if p not in known]
            for low in range(0, len(rest), TOGETHER):
                some = rest[low : low + TOGETHER]
                known.update(zip(some, self._encode_parts(some), strict=True))
        return [known[p] for p in parts]

    def _join(self, words: list[str], codes: np.ndarray, edges: np.ndarray) -> list[bytes]:
        """Ids of texts that are given as the numbers of their parts in ``words``, at least one each."""
        tail = np.ones(len(codes), bool)
        tail[edges[:-1]] = False
        heads = self._encode([words[i] for i in codes[edges[:-1]].tolist()])
        codes = codes[tail]
        used = np.flatnonzero(np.bincount(codes, minlength=len(words)))
        ids = self._ids_of([words[i] for i in used.tolist()])
        sizes, first = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        sizes[used] = [len(x) // 4 for x in ids]
        first[used] = np.cumsum(sizes[used]) - sizes[used]
        flat, counts = np.frombuffer(b"".join(ids), "<u4"), sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        flat = flat[np.repeat(first[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        # A text has one part less in its tail than in all.
        place = ends[edges - np.arange(len(edges))]
        return [head + flat[low:high].tobytes() for head, (low, high) in zip(heads, pairwise(place.tolist()), strict=True)]

    def __call__(self, texts: Iterable[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        whole = np.zeros(len(texts), bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        words, codes, edges = _numbered(pc.split_pattern(texts, " "))
        # Where white space is next to a space or at an end, only other spaces are cut.
        odd = np.array([not p or p[0].isspace() or p[-1].isspace() for p in words], bool)
        odd = np.logical_or.reduceat(odd[codes], edges[:-1]) & ~whole
        plain = ~odd & ~whole
        found: list[bytes] = [b""] * len(texts)

        def put(which: np.ndarray, ids: list[bytes]) -> None:
            for i, x in zip(np.flatnonzero(which).tolist(), ids, strict=True):
                found[i] = x

        if whole.any():
            put(whole, self._encode(texts.filter(pa.array(whole)).to_pylist()))
        if odd.any():
            put(odd, self._join(*_numbered(pa.array([self._safe.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]))))
        if plain.any():
            sizes = np.diff(edges)
            put(plain, self._join(words, codes[np.repeat(plain, sizes)], np.concatenate([[0], np.cumsum(sizes[plain])])))
        return found


def _numbered(cut: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of lists of parts, the number of each part among them, and where each list begins and ends."""
    edges = cut.offsets.to_numpy().astype(np.int64)
    parts = cut.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
    return parts.dictionary.to_pylist(), parts.indices.to_numpy(), edges - edges[0]


#: The encoder of this worker process, kept between tasks with what it knows.
_worker: dict[str, Encoder] = {}


def _kept(call: str, definition: Broadcast) -> Encoder:
    if call not in _worker:
        _worker.clear()
        _worker[call] = Encoder(definition.value)
    return _worker[call]


class _Blocks:
    """Cuts the ids of a part's documents into blocks and codes many of them at a time."""

    def __init__(self, part: int, digits: tuple[int, int, int], schema: pa.Schema):
        self.part, self.digits, self.schema = part, digits, schema
        self.number, self.position, self.waiting = 0, 0, []
        self.held = 0

    def add(self, key, ids: bytes) -> None:
        self.waiting.append((key, self.position, 0, np.frombuffer(ids, "<u4")))
        self.position += len(ids) // 4
        self.held += len(ids) // 4

    def give(self, last: bool) -> pa.RecordBatch:
        """Codes all full blocks, at the end also the rest."""
        ids = np.concatenate([np.zeros(0, "<u4"), *[w[3] for w in self.waiting]])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        blocks = [ids[low : min(low + BLOCK, whole)] for low in range(0, whole, BLOCK)]
        pieces, rest, at = [[] for _ in blocks], [], 0
        for key, start, skipped, own in self.waiting:
            done = 0
            while done < len(own) and at < whole:
                n = min(len(own) - done, BLOCK - at % BLOCK)
                pieces[at // BLOCK].append({"key": key, "start": start, "skipped": skipped + done, "n": n})
                done, at = done + n, at + n
            if done < len(own):
                rest.append((key, start, skipped + done, own[done:]))
        self.waiting, self.held = rest, len(ids) - whole
        numbers = range(self.number, self.number + len(blocks))
        self.number += len(blocks)
        codes = encode_blocks(blocks, self.digits)
        columns = [[self.part] * len(blocks), numbers, map(len, blocks), map(checksum, blocks), codes, pieces]
        arrays = [pa.array(list(c), self.schema.field(i).type) for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def write_ids(docs: DataFrame, folder: str, tokenizer_file: str, end: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all documents in ascending order of ``key`` (nulls first), each followed by the id ``end``.

    Null text is the empty text: only the end id. Documents of equal key are ordered by a hash of their text; equal
    rows are all written. Other columns are not read. An empty table gives an empty folder of ids.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    library = Tokenizer.from_file(tokenizer_file)
    size = max(library.get_vocab_size(with_added_tokens=True), max(library.get_vocab().values()) + 1, end + 1)
    digits, definition, call = digits_for(size), spark.sparkContext.broadcast(library.to_str()), uuid.uuid4().hex
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_or_empty(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"part int, block int, n int, crc32 long, code binary, pieces {PIECE.format(key=kind)}"
    final = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, blocks = _kept(call, definition), None
        for batch in batches:
            if blocks is None:
                field = pa.list_(pa.struct([("key", batch.schema.field(0).type), *[(c, pa.int64()) for c in ("start", "skipped", "n")]]))
                kinds = [("part", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("crc32", pa.int64()), ("code", pa.binary()), ("pieces", field)]
                blocks = _Blocks(TaskContext.get().partitionId(), digits, pa.schema(kinds))
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + TEXT, side="right")))
                some, low = batch.slice(low, high - low), high
                for k, ids in zip(some.column(0).to_pylist(), encoder(some.column(1)), strict=True):
                    blocks.add(k, ids + final)
                    if blocks.held >= SIDE_BY_SIDE * BLOCK:
                        yield blocks.give(False)
        if blocks is not None:
            yield blocks.give(True)

    coded = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    coded.write.option("compression", "none").parquet(f"{folder}/digits={'-'.join(map(str, digits))}")


def read_pieces(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Decodes all blocks of a folder, checks them, and gives a row for each piece of a document.

    Columns: part, key, start (of the document in its part), skipped (ids of the document before the piece), n,
    crc32 (of the piece), with ``with_ids`` also ids. A block that does not match its checksum is an error.
    """
    stored = spark.read.parquet(folder)
    schema = StructType([f for f in stored.schema if f.name in ("part",)])
    piece = stored.schema["pieces"].dataType.elementType
    for f in piece:
        schema = schema.add(f)
    schema = schema.add("crc32", "long")
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            groups = -(-whole.num_rows // SIDE_BY_SIDE)
            size = -(-whole.num_rows // groups) if groups else 1
            for low in range(0, whole.num_rows, size):
                batch = whole.slice(low, size)
                part, number, n, crc, code, pieces, digits = (c.to_pylist() for c in batch.columns)
                own, sums, lists, parts = [], [], [], []
                blocks = decode_blocks(code, n, tuple(map(int, digits[0].split("-"))))
                for p, k, ids, check, inside in zip(part, number, blocks, crc, pieces, strict=True):
                    if checksum(ids) != check:
                        raise ValueError(f"block {k} of part {p} is damaged")
                    at = 0
                    for x in inside:
                        piece_ids = ids[at : at + x["n"]]
                        at += x["n"]
                        own.append(x)
                        parts.append(p)
                        sums.append(checksum(piece_ids))
                        if with_ids:
                            lists.append(piece_ids)
                kind = batch.schema.field("pieces").type.value_type
                table = pa.array(own, kind)
                columns = [pa.array(parts, pa.int32()), *table.flatten(), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return stored.select("part", "block", "n", "crc32", "code", "pieces", F.col("digits").cast("string")).mapInArrow(run, schema)


def joined_checksum(pieces: Iterable[dict]) -> int:
    """The CRC-32 of a sequence from those of its pieces in order: sums are affine, so zeros stand in for the piece."""
    total, zeros = 0, bytes(4 * BLOCK)
    for x in pieces:
        blank = memoryview(zeros)[: 4 * x["n"]]
        total = zlib.crc32(blank, total) ^ zlib.crc32(blank) ^ x["crc32"]
    return total


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """A row for each document of a folder: its key, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32``. Pieces are put together by the documents' places, so equal and null keys stay apart."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = spark.read.parquet(folder).groupBy("part").agg(F.sum("n").alias("n"))
    # One row per part, that is per task of the writing job.
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    whole = read_pieces(spark, folder).groupBy("part", "start").agg(
        F.first("key").alias("key"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("skipped", "n", "crc32"))).alias("pieces"),
    )

    @F.pandas_udf("long")
    def combined(pieces: pd.Series) -> pd.Series:
        return pieces.map(joined_checksum)

    placed = whole.join(offsets, "part")
    one = F.col("pieces")[0]["crc32"]
    return placed.select(
        F.col("key").alias(key),
        (F.col("offset") + F.col("start")).alias("start"),
        "n_tokens",
        F.when(F.size("pieces") == 1, one).otherwise(combined("pieces")).alias("ids_crc32"),
    )
