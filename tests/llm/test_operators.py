"""Each operator against a plain re-computation, and on nulls, empty and long texts, repeats and empty tables."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from proclivity.llm import (
    block_names,
    bottom_k,
    covering_simhash,
    mixing,
    piece_counts,
    queries,
    tag_paths,
    tool_calls,
    toxic_passages,
    url_filter,
    word_automaton,
)
from proclivity.llm.components import smallest_reachable
from proclivity.llm.shared import Workspace

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, block string"
LONG = " ".join(f"w{i % 977}é" for i in range(40_000))
ODD = [
    (1, None), (2, ""), (3, " \n "), (4, "a b c d e f g"), (5, "a b c d e f g"), (6, "A B c d e f g"), (7, LONG), (8, LONG + " end"),
    (None, "no key at all"), (None, None), (9, "one"), (9, "one"), (10, "x" * 5000), (11, "é" * 2049), (12, "é" * 2049), (13, "<|endoftext|> ▁ 日本 İ"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", None if n % 3 == 0 else f"s{n % 2}", None, "clash", "clash") for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equal_to_sql(spark, sf, name):
    import oracle_check

    message, _ = oracle_check.compare(spark, oracle_check.duck(sf), queries.QUERIES[name], queries.SQL[name], sf)
    assert message is None


def test_url_rules_on_odd_urls(spark):
    urls = [None, "", "nothing", "http://COM", "http://com/", "http://a.example.com/en/x?y#z", "http://www.example.com/en/", "x://net/es/", "http://a.net/fr", "http://a..com/?", "http://notexample.com/en/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, None, "x")], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("com", "", None, "allow") and got[4] == ("com", "/", "com/", "allow")
    assert got[5] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[6][2:] == ("www.example.com/en/", "allow") and got[7][2:] == ("net/es/", "block")
    assert got[8][2:] == (None, "allow") and got[10][2:] == ("com/", "allow")
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    ws = Workspace(spark, "t")
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("hash(key) % 7 = 0")
    cascade = url_filter.build_cascade(ws, listed, universe)
    wrong = universe.where(cascade.holds(F.col("key")) != (F.expr("hash(key) % 7 = 0")))
    assert wrong.count() == 0 and len(cascade.levels) > 1


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "search", '{"query":"q","limit":1}', []), (1, "b", 2, "search", '{"limit":0,"query":"q"}', ["a"]),
            (1, "c", 3, "nope", "{}", ["b", "unknown"]), (1, "d", 4, "search", "not json", ["e"]), (1, "e", 5, "search", None, ["d"]),
            (2, None, 1, "search", '{"query":"q","limit":1.0}', None), (None, "a", 1, "translate", '{"text":"é"}', ["a0"]),
        ],
        tool_calls.CALL_SCHEMA,
    )
    results = spark.createDataFrame([(1, "a", "r1"), (1, "a", "r2"), (3, "z", None), (None, "a", "n")], "conv_id long, call_id string, content string")
    got = tool_calls.link_calls(calls, results, queries.TOOL_SCHEMAS).collect()
    by = {(r.conv_id, r.call_id, r.turn): r for r in got}
    assert len(got) == 9
    assert [by[1, x, t].level for x, t in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5))] == [0, 1, 2, None, None]
    assert by[1, "b", 2].problem == "$.limit: out of bounds" and by[1, "c", 3].problem == "unknown tool"
    assert by[1, "d", 4].problem == "$: not JSON" and by[1, "e", 5].problem == "$.limit: missing"
    assert by[2, None, 1].valid and by[2, None, 1].status == "no result" and by[3, "z", None].status == "no call"
    assert by[None, "a", 1].json == '{"arguments":{"text":"é"},"call_id":"a","content":"n","name":"translate","status":"linked"}'
    assert tool_calls.link_calls(calls.limit(0), results.limit(0), {}).count() == 0


def test_segments_are_the_maximal_ones():
    def plain(scores):  # recursive definition: the best run, then left and right of it
        best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0, 0))
        if best[0] <= 1e-9:
            return []
        i, j = best[2], best[3]
        return plain(scores[:i]) + [(i, j - 1)] + [(a + j, b + j) for a, b in plain(scores[j:])]

    rng = random.Random(3)
    for _ in range(300):
        hits = {i: rng.uniform(0.5, 5) for i in range(40) if rng.random() < 0.3}
        scores = [hits.get(i, -0.37) for i in range(40)]
        assert [(a, b) for a, b, _ in toxic_passages.segments(sorted(hits.items()), -0.37)] == plain(scores)


def test_words_score_in_every_passage():
    class Scores(dict):
        def __missing__(self, word):
            return 0.0

    scores, other = Scores(a=3.0, b=2.5, c=3.0, d=2.0), -0.1
    scan = lambda words: [(x, y, round(z, 6)) for x, y, z in toxic_passages.scan_text(" ".join(words), scores, other)[1]]
    dense, clean = ["a", "b", "x", "c", "d"], ["x"] * 40
    assert scan([*dense, *clean, *dense]) == [(0, 4, 10.4), (45, 49, 10.4)]
    assert scan([*dense, *["x"] * 400, *dense]) == [(0, 4, 10.4), (405, 409, 10.4)]
    early = [w for hit in "abcd" for w in [hit, *clean]]
    assert scan([*early, *dense])[-1] == (164, 168, 10.4)
    assert max(z for *_, z in scan(["a", "x", "x"] * 500)) == 3.0  # one word over and over never adds up
    assert scan(["a", "a", "a", "b"]) == [(0, 3, 5.3)]


def test_toxicity_held_out_and_odd(spark, odd, empty):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("ano", "eri", "ulo", "ite")]
    rows = []
    for i in range(900):
        text = [rng.choice(words) for _ in range(60)]
        if i % 6 == 0:
            for _ in range(4):
                text.insert(rng.randrange(50), rng.choice(["vilebad", "wretchy", "vilebadly"]))
        rows.append((i, " ".join(text), "en", "s", 0, "k", "b"))
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 10_000))
    labels = spark.createDataFrame([(i, 1 if i % 6 == 0 else 0) for i in range(900)] + [(10_004, None)], "doc_id long, toxic int")
    got = toxic_passages.toxicity(docs, labels).collect()
    assert len(got) == 900 + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in got if r.doc_id is not None and r.doc_id < 900)
    assert not [r for r in got if r.score >= 0.3 and (r.doc_id is None or r.doc_id >= 10_000)]
    assert toxic_passages.drop_toxic(docs, labels).count() == 750 + len(ODD)
    assert toxic_passages.toxicity(empty, labels).count() == 0
    assert {r.score < 0.3 for r in toxic_passages.toxicity(docs, labels.limit(0)).collect()} == {True}


def test_sketches(spark, odd, empty):
    near = bottom_k.with_next(odd, [F.coalesce("text", F.lit("")).alias("text")]).collect()
    order = sorted(((i is None, -(i or 0), t or "") for i, t in ODD))
    follow = [(o[2], order[(n + 1) % len(order)][2]) for n, o in enumerate(order)]
    assert sorted((r.row.text, r.next.text) for r in near) == sorted(follow)
    assert bottom_k.with_next(empty, [F.col("text")]).count() == 0
    a, b = " ".join(f"w{i}" for i in range(2000)), " ".join(f"w{i}" for i in range(1000, 3000))
    frame = spark.createDataFrame([(a, b)], "a string, b string").select(bottom_k.sketch(F.col("a"), 512).alias("a"), bottom_k.sketch(F.col("b"), 512).alias("b"))
    r = frame.select(
        bottom_k.resemblance(F.col("a"), F.col("b"), 512).alias("j"), bottom_k.containment(F.col("a"), F.col("b"), 512).alias("c"),
        bottom_k.distinct_shingles(bottom_k.merged(F.col("a"), F.col("b"), 512), 512).alias("n"),
    ).first()
    assert abs(r.j - 996 / 2996) < 0.08 and abs(r.c - 0.5) < 0.12 and abs(r.n - 2996) < 450
    prints = bottom_k.fingerprints(odd).collect()
    assert len(prints) == len(ODD) and len({tuple(p.sketch) for p in prints if p.n_chars == 0}) == 1
    parts = spark.createDataFrame([(1, x) for x in (a, b)], "g int, t string").select("g", bottom_k.sketch(F.col("t"), 64).alias("sketch"))
    whole = frame.select(F.slice(bottom_k.merged(F.col("a"), F.col("b"), 64), 1, 64).alias("s")).first().s
    assert bottom_k.merge_groups(parts, ["g"], k=64).first().sketch == whole


def test_edited_text(spark):
    r = spark.createDataFrame([("abcde", "XY"), ("abcd", "XYZ"), ("", "q"), ("a", "")], "a string, b string")
    assert [x.e for x in r.select(bottom_k.edited(F.col("a"), F.col("b")).alias("e")).collect()] == ["abcXY", "abXY", "", "a"]


def test_every_pair_in_the_radius_shares_a_mask():
    rng = np.random.default_rng(1)
    for free, radius in (((1 << 64) - 1, 4), ((1 << 64) - 1, 6), (0xFFFF0000FFFF, 4), (0x1F, 4)):
        masks = covering_simhash.covering_masks(free, radius)
        bits = [i for i in range(64) if free >> i & 1]
        assert all(masks)
        for _ in range(500):
            flipped = sum(1 << int(i) for i in rng.choice(bits, radius, replace=False))
            assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("limit", [16, 100_000])
def test_simhash_links_equal_brute_force(spark, limit):
    rng = random.Random(2)
    marks = []
    for _ in range(12):
        base = rng.getrandbits(64)
        marks += [base ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) for _ in range(25)]
    marks = sorted(set(m % (1 << 64) for m in marks))
    frame = spark.createDataFrame([(i, m - (1 << 64) if m >> 63 else m, 0) for i, m in enumerate(marks)], "node long, mark long, other long")
    ws = Workspace(spark, "t")
    edges = covering_simhash.link_fingerprints(ws, frame, 4, bucket_limit=limit)
    roots = {r.node: r.root for r in smallest_reachable(ws, edges).collect()}
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4 and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert [roots.get(i, i) for i in range(len(marks))] == [find(i) for i in range(len(marks))]


def test_simhash_of_odd_texts(spark, odd, empty):
    def plain(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = covering_simhash.near_classes(odd).collect()
    assert sorted(r.fingerprint for r in got) == sorted(f"{plain(t):016x}" for _, t in ODD)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (4, 5, 6)} == {4}
    assert covering_simhash.near_classes(empty).count() == 0
    kept = [r.doc_id for r in covering_simhash.drop_near_copies(odd).collect()]
    assert len(kept) == len(set(kept)) and {1, 4, 7, 9, 10, 11} <= set(kept) and not {2, 3, 5, 6, 8, 12} & set(kept)
    assert covering_simhash.drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("limit", [16, 100_000])
def test_near_copies_equal_brute_force(spark, limit):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(60):  # the same words in another order
        cut = rng.randrange(80)
        texts.append(" ".join(base[cut:] + base[:cut]) if rng.random() < 0.4 else " ".join(rng.sample(base, 80)))
    for _ in range(40):  # light edits of a longer text: fingerprints that vary in few bits
        texts.append(" ".join(f"x{rng.randrange(999)}" if rng.random() < 0.004 else w for w in base * 3))
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(80)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "k", "b") for i, t in enumerate(texts)], DOCS)
    got = sorted(r.doc_id for r in covering_simhash.drop_near_copies(docs, bucket_limit=limit).collect())
    marks = [covering_simhash.fingerprint_of(t, 4) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert got == sorted(set(root)) and 20 < len(got) < len(texts)


def test_mixing(spark, odd, empty):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 < 8, "big").when(F.col("id") % 10 == 8, "small").alias("source"), F.lit(7).alias("copy")
    )
    got = mixing.mix(docs, {"big": 1, "small": 2, None: 1}, seed=4)
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(n["big"] - 1500) < 150 and abs(n["small"] - 3000) < 260 and abs(n[None] - 1500) < 200
    assert got.select("doc_id", "copy").distinct().count() == got.count() and max(r.copy for r in got.collect()) > 3
    assert mixing.mix(docs.repartition(5), {"big": 1, "small": 2, None: 1}, seed=4).count() == got.count()
    assert mixing.mix(docs, {"small": 1}).where("source = 'big'").count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mix(odd).columns == [*odd.columns, "copy", "shuffle_key"]


def test_mixing_at_any_rate(spark):
    docs = spark.range(400_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4, "rare").otherwise("big").alias("source"))
    drawn = mixing.mix(docs, {"rare": 1, "big": 9}, seed=2).where("source = 'rare'").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("copy").alias("low"), F.max("copy").alias("high"), F.countDistinct("copy").alias("d"))
    drawn = drawn.collect()  # rate 10,000: deviation 100
    assert len(drawn) == 4 and all(abs(r.n - 10_000) < 500 and r.low == 1 and r.high == r.n == r.d for r in drawn)
    many = spark.range(2000).select(mixing.poisson_draw(F.lit(1500.0), F.lit(0), F.col("id")).alias("n"))
    law = many.agg(F.avg("n").alias("mean"), F.variance("n").alias("var")).first()
    assert abs(law["mean"] - 1500) < 5 and abs(law["var"] - 1500) < 200


@pytest.mark.parametrize("size", [4, 2048])
def test_copies(odd, empty, size):
    got = block_names.copy_classes(odd, block_bytes=size).collect() if size > 4 else block_names.copy_classes(odd.where("length(text) < 100 or text is null"), block_bytes=size).collect()
    rows = [(i, t or "") for i, t in ODD if size > 4 or len(t or "") < 100]
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        taken = False
        for i in ids:
            stays = i == keep and not taken
            taken |= stays
            want.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert block_names.copy_classes(empty).count() == 0
    if size > 4:
        assert sorted(str(r.text or "") for r in block_names.drop_copies(odd).collect()) == sorted(groups)


def test_pages(spark):
    html = [
        ("<html><body><div class='menu'><a>Home</a></div><div id=content><h2>T</h2><p>Some text, here.<p>Other &amp; text<div class='comments'><p>bad, very long comment text here.</p></div></div><div class=footer>c</div></body></html>", "T\nSome text, here.\nOther & text"),
        (None, ""), ("", ""), ("<p>a<p>b", "a\nb"), ("<script>x</script", ""), ("<article>t <aside>no</aside> u<br>v</article>", "t\nu v"),
        ("<div>" * 3000 + "deep", "deep"), ("<p>" + "word, " * 50_000, ("word, " * 50_000).strip()), ("<nav>a b c</nav>", ""), ("<p>1 < 2 &#39; &lt;b&gt;", "1 < 2 ' <b>"),
    ]
    pages = spark.createDataFrame([(i, None, h, "clash") for i, (h, _) in enumerate(html)], "page_id long, url string, html string, text string")
    got = tag_paths.extract_articles(pages).orderBy("page_id").collect()
    assert [r.text for r in got] == [t for _, t in html]
    assert tag_paths.extract_articles(pages.limit(0)).count() == 0


def test_articles_of_the_table(sf):
    import html
    import re

    for page, in duckdb.sql(f"SELECT html FROM '{sf}/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        inner = re.sub(r"<[a-zA-Z/][^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\x00", inner)))
        want = [" ".join(html.unescape(b).split()) for b in inner.split("\x00")]
        assert tag_paths.main_text(page) == "\n".join(b for b in want if b)


STRANGE = [
    "", " ", "  ", "\n", "\n\n a", " a  b ", "▁", "▁▁x", "a▁b", "\t\r\n;\r\n}", "<s></s>", "日本語", "😀😀 é", "a" * 3000, "ab" * 700 + " " * 900, "\x00a b",
    "a<|endoftext|>b", "it's we'll 'S", "ÀÉ İ ΑΣ ς", "\x00a \x1cb\x85\xa0c", "ſt ŉ ĳ", "ǅ ٣",
]


def strange_texts():
    rng = random.Random(1)
    return STRANGE + ["".join(rng.choice("aeinrst thEA.,\n▁ (){}=;\r0123é日\"'ΣİÀ\u0301") for _ in range(rng.randint(1, 300))) for _ in range(800)]


def test_piece_counts(spark, odd, empty, sf):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = strange_texts()
    assert piece_counts.Counter(piece_counts.PieceTable.load(path))(texts) == [len(x) for x in model.encode(texts)]
    got = piece_counts.count_tokens(odd, path).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted((len((t or "").encode()), len(model.encode(t or ""))) for _, t in ODD)
    assert piece_counts.count_tokens(empty, path).count() == 0
    rows = queries.op9_piece_counts(spark, sf).collect()
    want = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall())
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(model.encode(t)) for i, t in want.items()}


def test_automaton(spark, odd, empty, sf):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    vocabulary = word_automaton.Vocabulary.load(path)
    words = sorted({w.encode() for w in ["the", "then", "hen", "tin", "thin", "é", "a", "it", "'s", "..."]})
    automaton = word_automaton.Automaton.compile(words, word_automaton.Merger(vocabulary)([w.decode() for w in words]))
    assert automaton.places(words).tolist() == list(range(len(words)))
    assert automaton.places([b"th", b"thinn", b"zz", b""]).tolist() == [-1, -1, -1, -1]
    assert len(automaton.final) - 1 < 1 + sum(map(len, words))  # suffixes are shared
    encoder = word_automaton.Encoder(vocabulary, word_automaton.Automaton.mapped(*automaton.packed()))

    def expected(texts):
        for e in library.encode_batch(texts, add_special_tokens=False):
            yield len(e.ids), " ".join(map(str, e.ids)), library.decode(e.ids, skip_special_tokens=False)

    texts = strange_texts()
    assert list(encoder(texts)) == list(expected(texts))
    got = word_automaton.encode(Workspace(spark, "t"), odd, path).collect()
    assert sorted((r.n_tokens, " ".join(map(str, r.ids)), r.decoded) for r in got) == sorted(expected([t or "" for _, t in ODD]))
    assert word_automaton.encode(Workspace(spark, "t"), empty, path).count() == 0
    rows = queries.op10_word_automaton(spark, sf).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {i: (n, digest(ids), digest(text)) for i, (n, ids, text) in zip(texts, expected(list(texts.values())), strict=True)}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    ws = Workspace(spark, "t")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = ws.write(stage(spark, docs, sf), "s")
        assert docs.columns == corpus_pipeline.COLUMNS
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    assert docs.select("text").distinct().count() == docs.count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, sf).where("size(ids) <> n_tokens").count() == 0
