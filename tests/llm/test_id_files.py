"""Range coded id files against the tokenizers library, and the coder alone on odd blocks."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from proclivity.llm import id_coder, id_files, queries

MODEL = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (1, None), (2, ""), (3, " \n "), (5, "a b c"), (4, "a b c"), (None, "no key"), (None, None), (9, "one"), (9, "one"), (9, "two"),
    (7, " ".join(f"w{i % 977}é" for i in range(9_000))), (13, "x<|endoftext|> y\n z"), (-1, "\0zero\n\nline  two \n"), (8, "é" * 20_000),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


def expected(rows, library):
    """(doc_id, start, n_tokens, ids_crc32), rows already in order."""
    start, found = 0, []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        found.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_blocks_come_back():
    rng = np.random.default_rng(5)
    blocks = [rng.integers(0, 50_000, 300), np.zeros(700, int), np.array([65_535]), np.zeros(0, int), np.arange(1000) % 7, rng.zipf(1.3, 500) % 65_536]
    codes = id_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(id_coder.decode_blocks(codes, list(map(len, blocks))), blocks, strict=True))
    # Each block can be read alone, and equals its code beside others.
    for block, code in zip(blocks, codes, strict=True):
        assert id_coder.encode_blocks([block]) == [code]
        assert (id_coder.decode_blocks([code], [len(block)])[0] == block).all()
    assert len(codes[1]) < 100 and len(codes[4]) < 400
    wide = id_coder.digits_for(200_000)
    assert (id_coder.decode_blocks(id_coder.encode_blocks([[199_999, 3, 131_072]], wide), [3], wide)[0] == [199_999, 3, 131_072]).all()
    with pytest.raises(ValueError):
        id_coder.encode_blocks([[70_000]])


def test_carries():
    """Long runs of sure predictions push the lower end across many words."""
    rng = np.random.default_rng(0)
    blocks = [np.repeat(rng.integers(0, 65_536, 40), rng.integers(1, 60, 40)) for _ in range(200)]
    codes = id_coder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(id_coder.decode_blocks(codes, list(map(len, blocks))), blocks, strict=True))


def test_parts_of_texts_are_encoded_as_whole_texts(library):
    rng = random.Random(3)
    alphabet = [" ", " ", "\n", "\t", "\r", "a", "B", "é", "1", ".", "'s", "'", " ", " ", "\x1c", "\x85", "́", "日", "\0", "😀", "ll", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, [6, 2, 2, *[1] * 19], k=rng.randrange(30))) for _ in range(6_000)]
    encoder = id_files.Encoder(library.to_str())
    got = encoder(texts)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want


def test_odd_documents(spark, library, tmp_path):
    docs = spark.createDataFrame([(i, t, "c") for i, t in ODD], "doc_id long, text string, key string")
    id_files.write_ids(docs, str(tmp_path / "ids"), MODEL)
    got = [tuple(r) for r in id_files.read_documents(spark, str(tmp_path / "ids")).orderBy("start").collect()]
    # Among equal keys the order is that of a hash: take theirs, check the rest.
    order = sorted(range(len(ODD)), key=lambda i: (ODD[i][0] is not None, ODD[i][0] or 0))
    assert [g[0] for g in got] == [ODD[i][0] for i in order]
    single = {r[0]: r for r in expected([ODD[i] for i in order], library) if r[0] not in (None, 9)}
    assert {g[0]: g for g in got if g[0] in single} == single
    tokens = lambda rows: sorted((str(r[0]), r[2], r[3]) for r in rows)
    assert tokens(got) == tokens(expected(ODD, library))
    ids = id_files.read_pieces(spark, str(tmp_path / "ids"), with_ids=True).where("key = 5").first().ids
    assert ids == [*library.encode("a b c").ids, 0]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    id_files.write_ids(docs, str(tmp_path / "ids"), MODEL)
    assert id_files.read_documents(spark, str(tmp_path / "ids")).count() == 0


def test_damage_is_seen(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "some words that are kept in one block")], "doc_id long, text string")
    id_files.write_ids(docs, str(tmp_path / "ids"), MODEL)
    stored = spark.read.parquet(str(tmp_path / "ids"))
    stored.withColumn("code", F.unhex(F.concat(F.lit("0F"), F.substring(F.hex("code"), 3, 10_000)))).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="damaged"):
        id_files.read_pieces(spark, str(tmp_path / "bad")).collect()


def test_query_equals_library(spark, sf, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_id_range_coder"](spark, sf).collect()), key=lambda r: r[1])
    assert got == expected(docs, library)


def test_unknown_parts_are_encoded_together(library, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcé1.'\nÄĠ日", k=rng.randrange(1, 9))).strip() or "x" for _ in range(5_000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(1_500)] + ["a  b", "x a  b c", "<|endoftext|> a b", ""]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    monkeypatch.setattr(id_files, "CACHE", 2_000)
    encoder = id_files.Encoder(library.to_str())
    parts, encode = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda some: parts.extend(some) or encode(some))
    got = [x for low in range(0, len(texts), 100) for x in encoder(texts[low : low + 100])]
    assert got == want
    # Alone go only the first part of each text, texts with special strings and parts with spaces inside.
    assert sorted(p for p in parts if p[:1] == " ") == [" a  b"] and len(parts) == len(texts) + 1
    assert len(encoder.known) <= 2_000 + len(words) and encoder.older


def test_parts_that_begin_otherwise_are_encoded_alone(library, monkeypatch):
    encoder = id_files.Encoder(library.to_str())
    want = [np.array(library.encode(" " + p, add_special_tokens=False).ids, "<u4").tobytes() for p in ("one", "two", "a  b")]
    assert encoder._encode_parts(["one", "two"]) == want[:2]
    assert encoder._ids_of(["one", "a  b", "two"]) == [want[0], want[2], want[1]]
    encoder.spaced[:] = False
    assert encoder._encode_parts(["one", "two"]) == want[:2]
    # Special strings that hold a space could arise where parts meet.
    encoder.known.clear()
    encoder.joinable = False
    monkeypatch.setattr(encoder, "_encode_parts", None)
    assert encoder._ids_of(["one", "two"]) == want[:2]
