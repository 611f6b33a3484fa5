"""Turn repair against a plain search over all edits, conversation by conversation."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from proclivity.llm import edit_paths, queries, turn_repair
from proclivity.llm.shared import Workspace

WHITE = " \t\n\x0b\x0c\r"
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
SCHEMA = "conv_id long, turn long, role string, text string, blank string, first int"


def damage(rows):
    """The contract's damage in plain Python; rows of a conversation by turn, role, text."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, [])
        show = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        found[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, t in found.items()}


def least(items):
    """(cost, audit) by backward search over (place, state), with costs and strings compared together."""
    n, best = len(items), {(len(items), 0): (0, ""), (len(items), 3): (0, "")}

    def insert(place):
        for _ in range(4):
            for q, to in AFTER.items():
                if (place, to) in best:
                    c, s = best[place, to]
                    best[place, q] = min(best.get((place, q), (10**9, "")), (c + 3, "I" + s))

    insert(n)
    for i in range(n - 1, -1, -1):
        initial, gone, cut = items[i]
        for q in range(4):
            ways = [(4, "D", q)]
            if not gone:
                extra = 3 if cut else 0
                ways += [(extra, "K", KEEP[initial, q])] if (initial, q) in KEEP else []
                ways.append((3 + extra, "R", AFTER[q]))
            best[i, q] = min((best[i + 1, to][0] + c, letter + best[i + 1, to][1]) for c, letter, to in ways if (i + 1, to) in best)
        insert(i)
    return best[0, 0]


def expected(turns):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines) of one damaged conversation."""
    numbers = {t for t, _, _ in turns if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    seen, items, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in turns:
        inner = text.strip(WHITE)
        fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        items.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    cost, audit = least(items)
    lines, state, rest = [], 0, iter(turns)
    for letter in audit:
        turn = next(rest) if letter != "I" else None
        if letter == "K":
            state = KEEP[turn[1][:1], state]
            lines.append((turn[1], turn[2]))
        elif letter in "IR":
            state = AFTER[state]
            lines.append(("user" if state == 2 else "assistant", turn[2] if turn else ""))
    return (gaps, *faults.values(), illegal, cost, audit, lines)


def digest(lines):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def compare(got, rows):
    want = {c: expected(t) for c, t in damage(rows).items()}
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        w = want[r.conv_id]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == (*w[:7], digest(w[7])), r.conv_id


def odd_rows(seed, conversations, longest):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "why", "why ", "", " \n", None, "\x1f", " ", "a. ", "Ünï?", "long " * 400 + ".", "end.\r\n"]
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            turn = rng.choice([turn, turn, turn, turn + rng.randrange(3), None])
            rows.append((rng.choice([conv] * 9 + [None]), turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "agent"]), rng.choice(texts)))
    return rows + rows[:5]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def run(spark, rows):
    table = frame(spark, rows)
    return turn_repair.audit(Workspace(spark, "t"), queries.damaged(table), table).collect()


def test_odd_conversations(spark):
    rows = odd_rows(1, 60, 14)
    compare(run(spark, rows), rows)


def test_conversations_over_many_tasks(spark, monkeypatch):
    """One conversation with most rows, another of equal rows; neighbouring tasks hold parts of them."""
    rows = odd_rows(2, 25, 9)
    rng = random.Random(5)
    rows += [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"text {t}.", "So?"])) for t in range(700)]
    rows += [(11, 3, "user", "Same.")] * 300
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = frame(spark, rows)
        _, _, decided = turn_repair._repairs(Workspace(spark, "t"), queries.damaged(table))
        assert decided.where("conv_id = 7").select("part").distinct().count() > 2
        compare(run(spark, rows), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_chunks_join(monkeypatch):
    """Paths of long runs, ranked in short chunks, and transfers of parts."""
    rng = random.Random(9)
    items = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(400)]
    codes = np.array(["suax".index(i) + (edit_paths.DOOMED if g else 0) + (edit_paths.CUT if c else 0) for i, g, c in items])
    counts, lengths = np.ones(400, int), np.array([400])
    want = least(items)
    for chunk in (1, 7, 64, 4096):
        monkeypatch.setattr(edit_paths, "CHUNK", chunk)
        cost, _ = edit_paths.costs_to_end(codes, counts, lengths, edit_paths.END[None])
        ((state, pieces),) = edit_paths.least_audits(codes, counts, lengths, cost, [[0]])[0]
        assert (cost[0, 0], "".join(pieces) + turn_repair.TRAIL[state]) == want
    after = edit_paths.END
    for part in (slice(300, 400), slice(50, 300), slice(0, 50)):
        after = edit_paths.join_costs(edit_paths.transfer(codes[part], counts[part]), after)
    assert after[0] == want[0]


def test_repaired_turns(spark):
    rows = odd_rows(3, 30, 8)
    got = turn_repair.repaired_turns(Workspace(spark, "t"), queries.damaged(frame(spark, rows))).collect()
    found = {}
    for r in sorted(got, key=lambda r: r.position):
        found.setdefault(r.conv_id, []).append((r.position, r.role, r.text))
    want = {c: [(k, *line) for k, line in enumerate(expected(t)[7])] for c, t in damage(rows).items()}
    assert found == {c: lines for c, lines in want.items() if lines}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_every_row_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (got,) = run(spark, [(conv, 0, "user", "Yes.")])
    assert tuple(got) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_query_equals_plain(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(queries.QUERIES["op11_turn_repair"](spark, sf).collect(), rows)


@pytest.mark.parametrize("items", [[], [("x", True, False)], [("s", False, False)], [("a", False, True)]])
def test_short_runs(items):
    codes = np.array(["suax".index(i) + (edit_paths.DOOMED if g else 0) + (edit_paths.CUT if c else 0) for i, g, c in items], int)
    lengths = np.array([len(items)])
    cost, _ = edit_paths.costs_to_end(codes, np.ones(len(items), int), lengths, edit_paths.END[None])
    ((state, pieces),) = edit_paths.least_audits(codes, np.ones(len(items), int), lengths, cost, [[0]])[0]
    assert (cost[0, 0], "".join(pieces) + turn_repair.TRAIL[state]) == least(items)
