"""Column names that clash, odd JSON and identifiers in tool calls, and the segment scan on many hits."""

import json
import random
import time
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from proclivity.llm import block_names, covering_simhash, mixing, piece_counts, queries, tag_paths, tool_calls, toxic_passages, word_automaton
from proclivity.llm.shared import Workspace, free

NAMES = ["_source", "_rate", "_copies", "_low", "_text", "_page", "_gone_key", "_gone_sha", "_key", "_sha", "_id", "_TEXT_"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents with columns of all names the operators use inside."""
    rows = [(i, f"one two three four five six {i % 3}", "s", *[f"{n}{i}" for n in NAMES]) for i in range(9)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in NAMES))


def untouched(df):
    assert all(r[n] == f"{n}{r.doc_id}" for r in df.collect() for n in NAMES)
    return df


def test_no_operator_trips_over_a_column_name(spark, clashing):
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    assert untouched(mixing.mix(clashing, power=0.5, seed=3)).count() > 0
    assert untouched(block_names.drop_copies(clashing)).count() == 3
    assert untouched(covering_simhash.drop_near_copies(clashing)).count() == 3
    assert untouched(toxic_passages.drop_toxic(clashing, labels, 2.0)).count() == 9
    assert untouched(piece_counts.count_tokens(clashing, public_tokenizers.path("piece_bpe_32k.model"))).count() == 9
    assert untouched(word_automaton.encode(Workspace(spark, "t"), clashing, public_tokenizers.path("word_bpe_49k.json"))).count() == 9
    assert untouched(tag_paths.extract_articles(clashing.withColumn("html", F.lit("<p>x</p>")))).count() == 9
    assert free(["_Key", "_key_"], "_key", "a") == ["_key__", "a"]


CALLS, RESULTS = tool_calls.CALL_SCHEMA, "conv_id long, call_id string, content string"
ANY = {"t": {"properties": {"q": {"type": "string"}}}}


def link(spark, calls, results, schemas=ANY):
    rows = tool_calls.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas).collect()
    return {(r.conv_id, r.call_id, r.status): r for r in rows}, rows


def test_odd_arguments(spark):
    deep = '{"q":' + "[" * 900 + "]" * 900 + "}"
    texts = ['{"q":"\\ud800","n":1}', deep, '{"q":' + "[" * 100_000, "[1]", None, '{"q":NaN}', '{"q":"\\ud83d\\ude00"}']
    got, _ = link(spark, [(1, f"c{i}", i, "t", a, []) for i, a in enumerate(texts)], [(1, "c0", "half \\ud800 pair")])
    first = got[1, "c0", "linked"]
    assert first.valid and json.loads(first.json)["arguments"] == {"q": "\ud800", "n": 1}
    assert [got[1, f"c{i}", "no result"].problem for i in (2, 5)] == ["$: not JSON"] * 2
    assert got[1, "c3", "no result"].problem == "$: not of type object" and got[1, "c4", "no result"].valid
    assert "😀" in got[1, "c6", "no result"].json
    assert got[1, "c1", "no result"].problem in ("$.q: not of type string", "$: not JSON")


def test_schema_keywords_and_enums(spark):
    with pytest.raises(ValueError, match="pattern"):
        link(spark, [], [], {"t": {"properties": {"q": {"type": "string", "pattern": "a"}}}})
    assert tool_calls.problem(1, {"enum": [True]}) and not tool_calls.problem(1.0, {"enum": [1]}) and not tool_calls.problem(None, {"enum": [None]})


def test_all_turns_are_carried_and_missing_identifiers_match_nothing(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    calls, results = queries.derived_tool_calls(table)
    assert calls.count() + results.count() == table.count()
    rows = [(None, t % 2, ("assistant", "user")[t % 2], "x") for t in range(60)]
    calls, results = queries.derived_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = tool_calls.link_calls(calls, results, queries.TOOL_SCHEMAS).collect()
    assert Counter(r.status for r in found) == {"no result": 30, "no call": 30}


def test_op2_query_equals_plain(spark, sf):
    """Links and levels of the whole query, re-computed per conversation."""
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role").collect()]
    calls = {(c, t) for c, t, role in turns if role == "assistant"}
    others = Counter((c, t - 1) for c, t, role in turns if role != "assistant")
    want = Counter()
    for c, t in calls:
        level, at = 0, t
        while at % 8 >= 2 and (c, at - 2) in calls:
            level, at = level + 1, at - 2
        want[c, f"call-{c}-{t}", "linked" if others[c, t] else "no result", level] += max(1, others[c, t])
    want.update({(c, f"call-{c}-{t}", "no call", None): n for (c, t), n in others.items() if (c, t) not in calls})
    got = Counter((r.conv_id, r.call_id, r.status, r.level) for r in queries.QUERIES["op2_tool_call_linking"](spark, sf).collect())
    assert got == want


def maximal(hits, other):
    """Maximal scoring segments by definition: split around the best segment, again on both sides."""
    values = []
    for i, (at, score) in enumerate(hits):
        gap = at - (hits[i - 1][0] if i else -1) - 1
        values += [(None, other)] * gap + [(at, score)]

    def split(part):
        best, low, run, start = None, 0.0, 0.0, 0
        for i, (_, v) in enumerate(part):
            if run <= 0:
                run, start = 0.0, i
            run += v
            if run > 0 and (best is None or run > best[0] + 1e-12):
                best = (run, start, i)
        if best is None:
            return []
        _, a, b = best
        return [*split(part[:a]), (part[a][0], part[b][0], best[0]), *split(part[b + 1 :])]

    return split(values)


def test_segments_equal_definition():
    rng = random.Random(6)
    for _ in range(300):
        spots = sorted(rng.sample(range(60), rng.randrange(1, 25)))
        hits = [(p, rng.choice([0.7, 1.3, 2.9, 4.1])) for p in spots]
        got, want = toxic_passages.segments(hits, -1.0), maximal(hits, -1.0)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want, strict=True))


def test_segment_scan_takes_time_in_proportion():
    def seconds(n):
        hits = [(i * 50, 10.0 - i * 1e-5) for i in range(n)]  # every segment begins lower than the one before
        began = time.process_time()
        toxic_passages.segments(hits, -1.0)
        return time.process_time() - began

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(8_000), 0.004)
