"""Repair of conversations' turn structure: faults of turns, cheapest edits, and the repaired conversations.

Turns travel without their texts (a digest stands for one) until the edits are known. They are sorted over the whole
cluster, so one conversation may take up many tasks. A task packs what it has of a conversation into a run; a run cut by
the edge of a task passes on only a 4 x 4 matrix of costs, and later the state that each state before it leads to. The
texts join the edits once, in one sorted pass that streams through each conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .edit_paths import ASSISTANT, CUT, DOOMED, END, FAR, KEEP_TARGET, NEXT, OTHER, SYSTEM, USER, costs_to_end, join_costs, least_audits, transfer

#: Fixed value: characters that do not count as text.
WHITE = " \t\n\x0b\x0c\r"
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Neighbouring initials that may follow each other.
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Letters that end the output from a state: inserts.
TRAIL = {0: "", 1: "II", 2: "I", 3: ""}
ROLE_OF = {2: "user", 3: "assistant"}
#: Runs that are worked on together.
TOGETHER = 2000
ORDER = ["conv_id", "turn", "role", "beginning", "digest"]


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ORDER]


def _keys(turns: DataFrame) -> DataFrame:
    """What a turn is known by: its conversation, turn, role and text, the text as its beginning and a digest."""
    return turns.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    ).select(
        "*",
        F.substring("text", 1, 32).alias("beginning"),
        F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("digest"),
        F.btrim("text", F.lit(WHITE)).alias("inner"),
    )


def _placed(ws, keyed: DataFrame) -> DataFrame:
    """Distinct turns with how often they occur, whether they are blank or cut, and whether they repeat an earlier one."""
    cut = ~F.substring("inner", -1, 1).isin(".", "!", "?")
    light = ws.write(
        keyed.groupBy(*ORDER, (F.col("inner") == "").alias("blank"), cut.alias("cut")).agg(F.sum("copies").alias("n")), "turns"
    )
    # Nulls first, as in the order of turns.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    group = ["conv_id", "role", "digest"]
    repeated = light.groupBy(*group).agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    firsts = ws.write(repeated.select(*[F.col(c).alias(f"its_{c}") for c in group], "first"), "repeated")
    same = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in group]
    fresh = ~F.col("blank") & (F.col("first").isNull() | (F.col("first") == place))
    placed = ws.write(light.join(firsts, same, "left").select(*ORDER, "blank", "cut", "n", fresh.alias("fresh")), "placed")
    ws.drop(light, firsts)
    return placed


def _counts(placed: DataFrame) -> DataFrame:
    """Per conversation: gaps and faults by kind."""
    n, fresh = F.col("n"), F.col("fresh").cast("long")
    turns = placed.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - fresh)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), fresh).otherwise(0)).alias("truncated"),
    )
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )


class _Run:
    """What a task holds of one conversation."""

    def __init__(self, conv, whole: bool):
        self.conv, self.whole = conv, whole
        self.codes, self.counts, self.keys = bytearray(), [], []
        self.illegal, self.first, self.last = 0, None, None

    def add(self, key: dict, n: int, fresh: bool, cut: bool) -> None:
        initial = INITIALS.get(key["role"][:1], OTHER)
        self.illegal += (n - 1) + (self.last is not None and (self.last, initial) not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        if fresh:
            self._item(initial | (CUT if cut else 0), 1, key)
        if n > fresh:
            self._item(initial | DOOMED, n - fresh, key)

    def _item(self, code: int, n: int, key: dict) -> None:
        self.codes.append(code)
        self.counts.append(n)
        self.keys.append(key)

    def row(self, part: int) -> dict:
        costs = None
        if not self.whole:
            costs = transfer(np.frombuffer(bytes(self.codes), np.uint8), np.array(self.counts)).ravel().tolist()
        return {
            "conv_id": self.conv, "part": part, "whole": self.whole, "codes": bytes(self.codes), "counts": self.counts, "keys": self.keys,
            "illegal": self.illegal, "first": self.first, "last": self.last, "costs": costs,
        }


def _runs(ws, placed: DataFrame) -> DataFrame:
    """Sorted turns, packed by task and conversation. Only the first and last run of a task may go on in another."""
    conv, turn = (placed.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    key = f"struct<turn:{turn},role:string,beginning:string,digest:binary>"
    schema = (
        f"conv_id {conv}, part int, whole boolean, codes binary, counts array<long>, keys array<{key}>, "
        "illegal long, first int, last int, costs array<long>"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, ready, types, begun = TaskContext.get().partitionId(), None, [], None, False

        def out() -> pa.RecordBatch:
            rows = [r.row(part) for r in ready]
            ready.clear()
            return pa.RecordBatch.from_pylist(rows, schema=types)

        for batch in batches:
            f = batch.schema
            types = types or pa.schema([
                ("conv_id", f.field("conv_id").type), ("part", pa.int32()), ("whole", pa.bool_()), ("codes", pa.binary()), ("counts", pa.list_(pa.int64())),
                ("keys", pa.list_(pa.struct([(c, f.field(c).type) for c in ("turn", "role", "beginning", "digest")]))),
                ("illegal", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("costs", pa.list_(pa.int64())),
            ])
            for r in batch.to_pylist():
                if run is None or r["conv_id"] != run.conv:
                    if run is not None:
                        ready.append(run)
                    run, begun = _Run(r["conv_id"], whole=begun), True
                run.add({c: r[c] for c in ("turn", "role", "beginning", "digest")}, r["n"], r["fresh"], r["cut"])
                if len(ready) >= TOGETHER:
                    yield out()
        if run is not None:
            run.whole = False
            ready.append(run)
            yield out()

    rows = placed.select(*ORDER, "n", "fresh", "cut")
    return ws.write(rows.repartitionByRange(*_order()).sortWithinPartitions(*_order()).mapInArrow(pack, schema), "runs")


def _ends(runs: DataFrame) -> DataFrame:
    """For runs that may be parts of a conversation: costs after them, and whether the conversation begins or ends there.

    A conversation has at most one such run in each task, so a group is as long as the number of tasks at most.
    """
    conv = runs.schema["conv_id"].dataType.simpleString()

    def back(own: pd.DataFrame) -> pd.DataFrame:
        own, after, ends = own.sort_values("part").reset_index(drop=True), END, []
        for costs in reversed(own["costs"].tolist()):
            ends.append(after.tolist())
            after = join_costs(np.reshape(costs, (4, 4)), after)
        pairs = zip(own["last"].shift(1, fill_value=-1), own["first"], strict=True)
        seams = [int(k > 0 and (int(a), int(b)) not in LEGAL) for k, (a, b) in enumerate(pairs)]
        place = np.arange(len(own))
        return pd.DataFrame({
            "its_conv": own["conv_id"], "its_part": own["part"], "ends": ends[::-1], "begins": place == 0, "closes": place == len(own) - 1, "seam": seams,
        })

    schema = f"its_conv {conv}, its_part int, ends array<long>, begins boolean, closes boolean, seam long"
    return runs.where(~F.col("whole")).select("conv_id", "part", "costs", "first", "last").groupBy("conv_id").applyInPandas(back, schema)


def _decided(ws, runs: DataFrame) -> DataFrame:
    """Per run: cost, illegal neighbours, and the letters spent on each of its items, for each state it may begin in."""
    same = F.col("conv_id").eqNullSafe(F.col("its_conv")) & (F.col("part") == F.col("its_part"))
    columns = ["conv_id", "part", "whole", "codes", "counts", "keys", "illegal"]
    parts = runs.where(~F.col("whole")).join(_ends(runs), same)
    known = runs.where("whole").select(
        *columns, F.array(*[F.lit(int(e)).cast("long") for e in END]).alias("ends"), F.lit(True).alias("begins"), F.lit(True).alias("closes"), F.lit(0).cast("long").alias("seam")
    ).unionByName(parts.select(*columns, "ends", "begins", "closes", "seam"))
    conv, keys = runs.schema["conv_id"].dataType.simpleString(), runs.schema["keys"].dataType.simpleString()
    schema = f"conv_id {conv}, part int, whole boolean, keys {keys}, entry int, exit int, cost long, illegal long, pieces array<string>"
    names = ["conv_id", "part", "whole", "keys", "entry", "exit", "cost", "illegal", "pieces"]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                yield decide_some(whole.slice(low, TOGETHER))

    def decide_some(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = {n: batch.column(n) for n in ("codes", "counts", "ends", "begins", "closes", "illegal", "seam")}
        codes = np.frombuffer(b"".join(column["codes"].to_pylist()), np.uint8)
        counts = column["counts"].flatten().to_numpy()
        lengths = np.diff(column["counts"].offsets.to_numpy())
        cost, places = costs_to_end(codes, counts, lengths, column["ends"].flatten().to_numpy().reshape(-1, 4))
        begins, closes = column["begins"].to_pylist(), column["closes"].to_pylist()
        entries = [[0] if b else [e for e in range(4) if cost[p, e] < FAR] for b, p in zip(begins, places, strict=True)]
        run, entry, leave, prices, faults, letters = [], [], [], [], [], []
        for k, paths in enumerate(least_audits(codes, counts, lengths, cost, entries)):
            for e, (state, pieces) in zip(entries[k], paths, strict=True):
                if closes[k]:
                    pieces[-1] += TRAIL[state]
                run.append(k)
                entry.append(e)
                leave.append(state)
                prices.append(int(cost[places[k], 0]) if begins[k] else None)
                faults.append(column["illegal"][k].as_py() + column["seam"][k].as_py())
                letters.append(pieces)
        at = pa.array(run, pa.int64())
        taken = [batch.column(n).take(at) for n in names[:4]]
        rest = [pa.array(entry, pa.int32()), pa.array(leave, pa.int32()), pa.array(prices, pa.int64()), pa.array(faults, pa.int64()), pa.array(letters, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*taken, *rest], names)

    return ws.write(known.mapInArrow(decide, schema), "decided")


def _chosen(decided: DataFrame) -> DataFrame:
    """Of each run the letters for the state in which its conversation comes to it."""
    conv = decided.schema["conv_id"].dataType.simpleString()

    def forward(own: pd.DataFrame) -> pd.DataFrame:
        state, rows = 0, []
        for part, options in own.sort_values("part").groupby("part"):
            rows.append((own["conv_id"].iloc[0], part, state))
            state = int(options.loc[options["entry"] == state, "exit"].iloc[0])
        return pd.DataFrame(rows, columns=["its_conv", "its_part", "its_entry"])

    options = decided.where(~F.col("whole"))
    states = options.select("conv_id", "part", "entry", "exit").groupBy("conv_id").applyInPandas(forward, f"its_conv {conv}, its_part int, its_entry int")
    same = F.col("conv_id").eqNullSafe(F.col("its_conv")) & (F.col("part") == F.col("its_part")) & (F.col("entry") == F.col("its_entry"))
    return decided.where("whole").unionByName(options.join(states, same, "left_semi"))


class _Writer:
    """The output of one conversation: edits in order, and texts as they come."""

    def __init__(self, conv, line):
        self.conv, self.line = conv, line
        self.state, self.audit, self.queue, self.key, self.text = 0, [], "", None, None

    def item(self, key: tuple, letters: str) -> None:
        if key != self.key:
            self.finish()
            self.key, self.text = key, None
        self.audit.append(letters)
        self.queue += letters
        self._write()

    def found(self, key: tuple, text: str) -> None:
        if key == self.key and self.text is None:
            self.text = text
            self._write()

    def _write(self) -> None:
        for at, letter in enumerate(self.queue):
            if letter in "KR" and self.text is None:
                self.queue = self.queue[at:]
                return
            if letter in "IR":
                self.state = int(NEXT[self.state])
                self.line(ROLE_OF[self.state], self.text if letter == "R" else "")
            elif letter == "K":
                role = self.key[1]
                self.state = int(KEEP_TARGET[self.state, INITIALS[role[0]]])
                self.line(role, self.text)
        self.queue = ""

    def finish(self) -> None:
        if self.queue:
            raise RuntimeError("a kept turn has no text")


def _streamed(keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edits and texts of each conversation in order: an item's letters come before the text it may keep."""
    item = F.posexplode(F.arrays_zip("keys", "pieces")).alias("at", "item")
    fields = [F.col(f"item.keys.{c}").alias(c) for c in ORDER[1:]]
    edits = chosen.select("conv_id", item).select("conv_id", *fields, F.lit(0).alias("kind"), "at", F.col("item.pieces").alias("value"))
    texts = keyed.where("inner != ''").select(*ORDER, F.lit(1).alias("kind"), F.lit(0).alias("at"), F.col("text").alias("value"))
    return edits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*_order(), "kind", "at")


def _conversations(rows: Iterator[pa.RecordBatch], line) -> Iterator[_Writer]:
    """Writers as their conversations end; ``line(conv, role, text)`` gets the repaired turns on the way."""
    writer = None
    for batch in rows:
        for r in batch.to_pylist():
            if writer is None or r["conv_id"] != writer.conv:
                if writer is not None:
                    writer.finish()
                    yield writer
                writer = _Writer(r["conv_id"], lambda role, text, conv=r["conv_id"]: line(conv, role, text))
            key = (r["turn"], r["role"], r["beginning"], r["digest"])
            if r["kind"] == 0:
                writer.item(key, r["value"])
            else:
                writer.found(key, r["value"])
    if writer is not None:
        writer.finish()
        yield writer


def _digests(streamed: DataFrame) -> DataFrame:
    """Per conversation its audit and the SHA-256 of its repaired turns; texts pass by, only a digest is held."""
    conv = streamed.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kind = {"sha": sha256(), "lines": 0}, pa.int64()

        def line(conv, role: str, text: str) -> None:
            own["sha"].update((("\n" if own["lines"] else "") + f"{role}:{text}").encode())
            own["lines"] += 1

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def out(rows: list) -> pa.RecordBatch:
            a, b, c = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, pa.string()), pa.array(c, pa.string())], ["conv_id", "audit", "repaired_sha256"])

        rows = []
        for writer in _conversations(typed(), line):
            rows.append((writer.conv, "".join(writer.audit), own["sha"].hexdigest()))
            own["sha"], own["lines"] = sha256(), 0
            if len(rows) >= TOGETHER:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)

    return streamed.mapInArrow(run, f"conv_id {conv}, audit string, repaired_sha256 string")


def _repairs(ws, turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyed turns, fault counts, and decided runs."""
    keyed = _keys(turns if "copies" in turns.columns else turns.withColumn("copies", F.lit(1)))
    placed = _placed(ws, keyed)
    counts = ws.write(_counts(placed), "counts")
    runs = _runs(ws, placed)
    ws.drop(placed)
    decided = _decided(ws, runs)
    ws.drop(runs)
    return keyed, counts, decided


def audit(ws, turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """A row for each conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has conv_id, turn, role, text and optionally ``copies`` (how often a row occurs); other columns are not
    read. ``conversations`` names further conv_ids: those without turns get zeros, an empty audit and the digest of the
    empty text. A null role or text counts as one space; a null conv_id is one conversation, null turns come first in
    theirs. Turns of equal number are ordered by role, then by the text's beginning, so equal rows stand side by side.
    An empty table gives no rows. A conversation's digest and audit are made in one stream, as they must be; nothing
    else of it need fit into one task.
    """
    keyed, counts, decided = _repairs(ws, turns)
    chosen = _chosen(decided)
    costs = chosen.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    digests = _digests(_streamed(keyed, chosen))
    ids = (conversations if conversations is not None else turns).select("conv_id")
    faults, texts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], ["audit", "repaired_sha256"]
    parts = ids.unionByName(counts, True).unionByName(costs, True).unionByName(digests, True)
    found = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in [*faults, *texts]])
    empty = {"audit": "", "repaired_sha256": sha256().hexdigest()}
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in faults], *[F.coalesce(c, F.lit(empty[c])).alias(c) for c in texts]
    )


def repaired_turns(ws, turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role and text; the same rules as in ``audit``."""
    keyed, _, decided = _repairs(ws, turns)
    streamed = _streamed(keyed, _chosen(decided))
    schema = StructType([streamed.schema["conv_id"]]).add("position", IntegerType()).add("role", StringType()).add("text", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, position, kind = [], {"conv": None, "next": 0}, []

        def line(conv, role: str, text: str) -> None:
            lines.append((conv, position["next"], role, text))
            position["next"] += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*lines, strict=True)) if lines else [(), (), (), ()]
            lines.clear()
            types = [kind[0], pa.int32(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

        def typed() -> Iterator[pa.RecordBatch]:
            for whole in batches:
                kind[:] = [whole.schema.field("conv_id").type]
                for low in range(0, whole.num_rows, TOGETHER):
                    yield whole.slice(low, TOGETHER)

        for _ in _conversations(typed(), line):
            position["next"] = 0
            if len(lines) >= TOGETHER:
                yield out()
        if kind:
            yield out()

    return streamed.mapInArrow(run, schema)
