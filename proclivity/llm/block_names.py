"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered, then
adjacent numbers are paired, the distinct pairs are sorted and numbered again, and so on until each text has
one number. Blocks and pairs are compared by content, so two texts share a number (at the same depth) exactly
when their bytes are equal: no hash can merge two texts.

What moves: the distinct blocks cross the network once, reduced in every map task first, so a text that fills
a third of the rows counts once per task. All later steps move numbers. A block's number is looked up by a
128-bit address whose uniqueness over the blocks at hand is verified; a clash draws new addresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, free, text_or_empty

BLOCK_BYTES = 2048


def blocks_of(data: Column, block_bytes: int) -> Column:
    """The blocks of a binary column; the empty value has one empty block."""
    last = F.greatest(F.ceil(F.length(data) / F.lit(block_bytes)), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0), last.cast("int")),
        lambda i: F.substr(data, i * block_bytes + 1, F.lit(block_bytes)),
    )


def _address(block: Column, draw: int) -> list[Column]:
    """Two 64-bit hashes; the salt comes first since it seeds the hash of the block."""
    return [
        F.xxhash64(F.lit(f"{side}{draw}"), block).alias(side) for side in ("left", "right")
    ]


def _number(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Sorted rows of each partition numbered; numbers of different partitions never meet."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(ws: Workspace, cut: DataFrame) -> tuple[DataFrame, int]:
    """Numbers of the distinct blocks by address, and the draw of addresses that proved unique."""
    for draw in range(64):
        named = _number(cut.select("block").distinct(), ["block"])
        names = ws.write(named.select(*_address(F.col("block"), draw), "name"), "block-names")
        if names.groupBy("left", "right").count().where("count > 1").isEmpty():
            return names, draw
        ws.drop(names)
    raise RuntimeError("no draw of block addresses is unique")


def text_names(ws: Workspace, rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One (key, sha, depth, name) per distinct (key, sha) of ``rows`` (key, sha, data).

    Two texts have the same (depth, name) exactly when they are equal.
    """
    blocks = rows.select("key", "sha", blocks_of(F.col("data"), block_bytes).alias("blocks"))
    cut = blocks.select("key", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
    names, draw = _name_blocks(ws, cut)
    located = cut.select("key", "sha", "n", "pos", *_address(F.col("block"), draw))
    level = ws.write(
        located.join(names, ["left", "right"]).select("key", "sha", "n", "pos", "name"), "level"
    )
    done, depth = None, 0
    while True:
        named = level.where("n = 1").select("key", "sha", F.lit(depth).alias("depth"), "name").distinct()
        done = named if done is None else done.unionByName(named)
        # One row per two neighbours; an odd last entry is paired with -1, which is no name.
        pairs = level.where("n > 1").groupBy("key", "sha", "n", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = ws.write(pairs, "pairs")
        if pairs.isEmpty():
            return done
        depth += 1
        numbered = _number(pairs.select("a", "b").distinct(), ["a", "b"])
        level = ws.write(
            pairs.join(numbered, ["a", "b"]).select(
                "key", "sha", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"
            ),
            "level",
        )


def copy_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: (key, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the largest key stays; a null key counts as smallest. Null text is the empty
    text. Of rows that agree in key and text exactly one is kept. Other columns, whatever their names, are
    not looked at. An empty table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "copies")
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text")).select(
        "key",
        F.unhex(F.sha2("text", 256)).alias("sha"),
        F.col("text").cast("binary").alias("data"),
    )
    names = text_names(ws, rows, block_bytes)
    repeats = rows.groupBy("key", "sha").agg(F.count("*").alias("repeats"))
    same = [F.col("r.key").eqNullSafe(F.col("n.key")), F.col("r.sha") == F.col("n.sha")]
    members = ws.write(
        repeats.alias("r").join(names.alias("n"), same).select("r.*", "n.depth", "n.name"), "members"
    )
    classes = members.groupBy("depth", "name").agg(
        F.max("key").alias("keep_id"), F.sum("repeats").alias("group_size")
    )
    joined = members.join(classes, ["depth", "name"])
    one_each = joined.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return one_each.select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


#: Up to so many dropped keys (about 100 bytes each) are sent to every executor; more are shuffled.
BROADCAST_KEYS = 500_000


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, without copies: see ``copy_classes`` for the one that stays."""
    ws = Workspace(docs.sparkSession, "drop-copies")
    gone_key, gone_sha = free(docs.columns, "_gone_key", "_gone_sha")
    classes = ws.write(copy_classes(docs.select(key, text), key, text, block_bytes), "classes")
    gone = classes.where(~F.col("kept")).groupBy(key, "text_sha256").count()
    # Rows equal in key and text: some row with this key and text is kept, others are not.
    partly = classes.groupBy(key, "text_sha256").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    partly = partly.where("stays and n > 1").select(key, "text_sha256")
    gone = ws.write(gone.join(partly, [gone[key].eqNullSafe(partly[key]), gone.text_sha256 == partly.text_sha256], "left_anti").select(
        F.col(key).alias(gone_key), F.col("text_sha256").alias(gone_sha)
    ), "gone")
    sha = F.sha2(text_or_empty(text), 256)
    small = gone.count() <= BROADCAST_KEYS
    found = [F.col(key).eqNullSafe(F.col(gone_key)), sha == F.col(gone_sha)]
    stay = docs.join(F.broadcast(gone) if small else gone, found, "left_anti")
    if partly.isEmpty():
        return stay
    twice = partly.select(F.col(key).alias(gone_key), F.col("text_sha256").alias(gone_sha))
    once = stay.join(twice, found, "left_semi").dropDuplicates([key, text])
    return stay.join(twice, found, "left_anti").unionByName(once)
