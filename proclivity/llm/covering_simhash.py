"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the hashes of a text's shingles. For radius r every bit position
is given a vector of r + 1 bits; each of the ``2**(r + 1) - 1`` non-zero vectors v makes one mask, of the
positions whose vector has an even product with v. Any r positions span at most r dimensions, so some v is
orthogonal to all of them and its mask leaves them out: two fingerprints that differ in at most r bits agree
under at least one mask. No pair is missed.

Only distinct fingerprints are looked up. A bucket (mask, masked value) of more than ``BUCKET`` fingerprints is cut
by the same construction on the bits its mask leaves free, again until it is small or free bits cannot exceed
the radius, where all its members are linked. So no task compares more than a bounded bucket, no pairs of a
bucket leave it (only a spanning forest does), and every link still joins the same component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import smallest_reachable
from .shared import Workspace, free, text_or_empty

RADIUS = 4
SEED = 42
#: A bucket with more distinct fingerprints is cut further.
BUCKET = 16384
#: Hashes whose bits are counted at once: bounds memory for very long texts.
CHUNK = 1 << 15
#: Up to so many dropped keys (about 100 bytes each) are sent to every executor; more are shuffled.
BROADCAST_KEYS = 500_000


def fingerprint_of(text: str, words: int) -> int:
    """Majority bits over the shingles of one text (A-Z lower-cased, ASCII white space); no words gives 0."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    n = len(tokens) - words + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, n, CHUNK):
        high = min(n, low + CHUNK)
        cuts = zip(starts[low:high].tolist(), ends[low + words - 1 : high + words - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(view[a:b], SEED) for a, b in cuts), np.uint64, high - low)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """All columns of ``docs`` but the text, with the fingerprint ``mark`` (long); null text is the empty text."""
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(*rest, text_or_empty(text).alias(*free(rest, "_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            marks = np.fromiter((fingerprint_of(x.as_py(), words) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*others, pa.array(marks.view(np.int64))], [*rest, "mark"])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, docs.select(*rest).schema.add("mark", "long"))


def covering_masks(free: int, radius: int, level: int = 0) -> list[int]:
    """Masks over the set bits of ``free``: any ``radius`` of these bits are all outside at least one mask."""
    positions = [i for i in range(64) if free >> i & 1]
    # Unit vectors first, so that no mask is empty, then every non-zero vector in turn.
    units = [1 << i for i in range(radius + 1)]
    others = [v for v in range(1, 2 ** (radius + 1)) if v not in units] + units
    vectors = units + [others[i % len(others)] for i in range(max(0, len(positions) - len(units)))]
    # Neighbouring bits get unrelated vectors, other ones at each level.
    positions = np.random.default_rng(level).permutation(positions).tolist()
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        picked = [p for p, m in zip(positions, vectors, strict=False) if (m & v).bit_count() % 2 == 1]
        masks.append(sum(1 << p for p in picked))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _links(marks: np.ndarray, nodes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the radius, by growing from one fingerprint after the other."""
    edges = []
    while len(nodes):
        front = [(marks[0], nodes[0])]
        marks, nodes = marks[1:], nodes[1:]
        while front and len(nodes):
            mark, node = front.pop()
            near = np.bitwise_count(marks ^ mark) <= radius
            if near.any():
                edges.extend((int(node), int(x)) for x in nodes[near])
                front.extend(zip(marks[near], nodes[near], strict=True))
                marks, nodes = marks[~near], nodes[~near]
    return edges


def _link_buckets(buckets: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) of nodes inside bounded buckets; whole buckets lie in one task, sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((3, 0), np.int64)

        def edges_of(rows: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
            edges = []
            for part in np.split(rows, cuts, axis=1):
                edges += _links(part[1].view(np.uint64), part[2], radius)
            a, b = np.array(edges, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            # The last bucket may go on in the next batch.
            last = int(np.flatnonzero(rows[0] == rows[0, -1])[0])
            rest = rows[:, last:]
            if last:
                yield edges_of(rows[:, :last])
        if rest.shape[1]:
            yield edges_of(rest)

    return buckets.select("bucket", "mark", "node").mapInArrow(run, "a long, b long")


def link_fingerprints(ws: Workspace, marks: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET) -> DataFrame:
    """Edges (a, b) that join nodes exactly as all pairs within ``radius`` bits do.

    ``marks`` has (node, mark), a node for each distinct fingerprint.
    """
    every, level = (1 << 64) - 1, 0
    edges = None
    # A path is a sequence of masks taken so far, by number; together they fix known bits.
    fixed_by = {0: 0}
    current = marks.select("mark", "node", F.lit(0).alias("path"))
    while True:
        table = []
        for path, fixed in fixed_by.items():
            for m in covering_masks(every & ~fixed, radius, level):
                table.append((path, len(table), _signed(fixed | m)))
        steps = ws.spark.createDataFrame(table, "path int, further int, mask long")
        spread = current.join(F.broadcast(steps), "path").select(
            F.xxhash64("further", F.col("mark").bitwiseAND(F.col("mask"))).alias("bucket"), "mark", "node", "further"
        )
        # Buckets are counted before their members meet, and a large one is not brought to one task: the join may split it.
        sizes = ws.write(spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), f"sizes-{level}")
        members = ws.write(spread.join(sizes, "bucket"), f"buckets-{level}")
        ws.drop(sizes)
        # Where all free bits may differ, any two members are within the radius.
        narrow = [further for _, further, mask in table if 64 - (mask & every).bit_count() <= radius]
        is_narrow = F.col("further").isin(narrow) if narrow else F.lit(False)
        fits = F.col("n") <= bucket_limit
        small = members.where(fits & ~is_narrow)
        found = _link_buckets(small.repartition("bucket").sortWithinPartitions("bucket"), radius)
        if narrow:
            masks = F.broadcast(steps.select("further", "mask"))
            tight = members.where(is_narrow).join(masks, "further").withColumn("value", F.col("mark").bitwiseAND(F.col("mask")))
            least = tight.groupBy("further", "value").agg(F.min("node").alias("b"))
            found = found.unionByName(tight.join(least, ["further", "value"]).select(F.col("node").alias("a"), "b"))
        found = ws.write(found.where("a <> b").distinct(), f"links-{level}")
        edges = found if edges is None else edges.unionByName(found)
        large = members.where(~fits & ~is_narrow)
        used = {r.further for r in large.select("further").distinct().collect()}  # masks, not data
        if not used:
            return edges
        current, level = large.select("mark", "node", F.col("further").alias("path")), level + 1
        fixed_by = {further: mask & every for _, further, mask in table if further in used}


def _with_roots(ws: Workspace, marked: DataFrame, radius: int, bucket_limit: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(marked rows, (mark, root)): root is one number for each component of linked fingerprints."""
    marked = ws.write(marked, "fingerprints")
    nodes = ws.write(marked.select("mark").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    linked = smallest_reachable(ws, link_fingerprints(ws, nodes, radius, bucket_limit))
    roots = ws.write(nodes.join(linked, "node", "left").select("mark", F.coalesce("root", "node").alias("root")), "roots")
    ws.drop(nodes)
    return marked, roots


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: (key, fingerprint as 16 hex digits, component_id).

    ``component_id`` is the smallest key reachable over fingerprints that differ in at most ``radius`` bits.
    Texts without words (null, empty, white space) have fingerprint zero and are linked like any other. A null key
    takes part but is never a component's id unless all keys of the component are null. Other columns are
    not looked at; an empty table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "simhash")
    marked, roots = _with_roots(ws, fingerprints(docs.select(key, text), text, words), radius)
    # Per fingerprint first: a group of copies is one row before its component is added up.
    smallest = marked.groupBy("mark").agg(F.min(key).alias("least"))
    known = ws.write(smallest.join(roots, "mark"), "known")
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "root").select("mark", "component_id")
    return marked.join(known, "mark").select(
        F.col(key), F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = RADIUS, bucket_limit: int = BUCKET
) -> DataFrame:
    """One row of each class of ``near_classes`` (all columns): the one with the smallest key.

    Rows without key come last in a class, and by their text's SHA-256; of rows equal in key and text one stays. Texts
    without words are one class. An empty table gives an empty result. Two copies of a name among the columns are an error.
    """
    ws = Workspace(docs.sparkSession, "near-copies")
    its_key, its_sha = free(docs.columns, "_key", "_sha")
    sha = F.sha2(text_or_empty(text), 256)
    rows = docs.select(F.col(key).alias("key"), sha.alias("sha"), F.col(text).alias("_source"))
    marked, roots = _with_roots(ws, fingerprints(rows, "_source", words), radius, bucket_limit)
    place = F.struct(F.col("key").isNull().alias("nameless"), "key", "sha")
    first = marked.groupBy("mark").agg(F.min(place).alias("first"))
    first = ws.write(first.join(roots, "mark"), "first")
    stays = first.groupBy("root").agg(F.min("first").alias("stays")).select("root", "stays.key", "stays.sha")
    # Only rows of classes with several rows or fingerprints can go.
    kept = ws.write(stays.select("key", "sha"), "stays")
    same = [F.col("m.key").eqNullSafe(F.col("s.key")), F.col("m.sha") == F.col("s.sha")]
    gone = ws.write(
        marked.alias("m").join(kept.alias("s"), same, "left_anti").select(F.col("key").alias(its_key), F.col("sha").alias(its_sha)).distinct(), "gone"
    )
    twice = marked.groupBy("key", "sha").count().where("count > 1").select(F.col("key").alias(its_key), F.col("sha").alias(its_sha))
    twice = ws.write(twice, "twice")
    found = [F.col(key).eqNullSafe(F.col(its_key)), sha == F.col(its_sha)]
    small = gone.count() <= BROADCAST_KEYS
    stay = docs.join(F.broadcast(gone) if small else gone, found, "left_anti")
    if twice.isEmpty():
        return stay
    once = stay.join(twice, found, "left_semi").dropDuplicates([key, text])
    return stay.join(twice, found, "left_anti").unionByName(once)
