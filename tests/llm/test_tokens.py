import base64
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import tokens
from pulsegrid.llm.tokens import boundaries, decode_ids, encode_corpus

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    path = f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(4)
    words = ["señor", "don't", "  ", "\n\n", "\t ", "12,345", "½", "…—", "猫が", "👩‍👩‍👧", "é", " ", " ", "'s", "<|endoftext|>", "x" * 30, "\x1f", "​"]
    long = [" ".join(r.choice(words) for _ in range(n)) + " " * k for n, k in ((900, 0), (2000, 7), (5000, 1))]
    return [None, "", " ", "\n", "a", "a", "café   z", "z" * 3000, " " * 3000, ("ab " * 50 + "y" * 700 + " c") * 3, *long]


def test_ids_equal_direct_encoding(spark, encoder):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, "null id", "x"), (3, "\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for chunk, overlap, spread in ((64, 16, 1), (64, 16, 10_000), (16, 4, 0), (256, 32, 4), (tokens.CHUNK, tokens.OVERLAP, tokens.SPREAD)):
        got = sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.ids)) for r in encode_corpus(docs, chunk=chunk, overlap=overlap, spread=spread).collect())
        expected = sorted((i if i is not None else -1, tuple(encoder.encode_ordinary(t) if t else [])) for i, t, _ in rows)
        assert got == expected


def test_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    back = decode_ids(encode_corpus(docs, chunk=128, overlap=32, spread=3)).join(docs.withColumnRenamed("text", "t"), "doc_id")
    assert back.filter(F.col("text") != F.coalesce("t", F.lit(""))).count() == 0 and back.count() == len(texts())


def test_boundaries_resynchronise():
    text = "one two  three's 44 — end"
    whole = boundaries(text)
    assert boundaries(text, whole[3]) == whole[3:]


def test_empty_table(spark):
    assert encode_corpus(spark.createDataFrame([], "doc_id string, text string")).count() == 0
    with pytest.raises(ValueError):
        encode_corpus(spark.createDataFrame([], "doc_id string, text string"), chunk=10, overlap=5)


def test_pieces_are_stitched_and_never_the_whole_text(encoder):
    r = random.Random(8)
    for _ in range(300):
        text = "".join(r.choice(["word", "señor", " ", "  ", "\n", "12", ",", "'s", "x" * 40, " " * 40, "-" * 30, "猫"]) for _ in range(r.randrange(400)))
        pieces = tokens._in_place(text, 64, 16)
        assert "".join(pieces) == text and [i for p in pieces for i in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)
    plain = "the harbour council repaired a steamer. " * 200
    pieces = tokens._in_place(plain, 256, 32)
    assert len(pieces) == tokens.n_chunks(len(plain), 256) and max(map(len, pieces)) <= 256 + 64
    broken = plain + "z" * 700 + plain  # one word without stitch joins its own chunks only
    assert max(map(len, tokens._in_place(broken, 256, 32))) <= 700 + 3 * 256
