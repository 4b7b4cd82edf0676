import hashlib
import random

import pytest
import sentencepiece

from quillspark.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def table():
    return pieces.table_of(pieces.default_model())


def test_random_strings(library, table):
    rnd = random.Random(3)
    vocabulary = [p for p, _, kind in table.rows if kind == "n"]
    alphabets = ["ab ", "theraonis ", "  \t\n", "aAéß▁ ", "01239.,-+/ ", "日本語かな👍🏽‍́\x00<>s/x ", "".join(chr(rnd.randrange(1, 0xD000)) for _ in range(300))]
    for turn in range(6000):
        kind = rnd.randrange(len(alphabets) + 1)
        if kind == len(alphabets):
            text = "".join(rnd.choices(vocabulary, k=rnd.randrange(1, 12)))
        else:
            text = "".join(rnd.choices(alphabets[kind], k=rnd.randrange(0, 60)))
        ids = library.encode(text)
        assert table.encode(text) == ids, repr(text)
        assert table.run(text)[2] == library.decode(ids) == table.decode(ids), repr(text)


def test_long_runs(library, table):
    for text in (" " * 1000, "a" * 20_000, "x y " * 5000, "ab" * 3000 + " " * 33 + "é" * 999, "=" * 777, "\n" * 500):
        ids = library.encode(text)
        assert table.encode(text) == ids and table.decode(ids) == library.decode(ids)


def test_prefix_table_is_used_for_space_free_cuts(table):
    rnd = random.Random(9)
    for _ in range(3000):
        cut = pieces.SPACE * rnd.randrange(2) + "".join(rnd.choices("therndaéß", k=rnd.randrange(1, 25)))
        assert [table.rows[i][0] for i in table.ids_of(cut)] == table.merge(cut)


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in pieces.encode_documents(docs).collect()}
    for r in docs.collect():
        ids = library.encode(r.text)
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a b", None)], "doc_id long, text string, ids int")
    empty = hashlib.sha256(b"").hexdigest()
    out = sorted(map(tuple, pieces.encode_documents(df, keep_ids=True).collect()), key=str)
    assert out[:2] == [(1, 0, empty, empty, [], "")] * 2 and out[2][0] is None and out[2][5] == "a b"
    assert pieces.encode_documents(df.where("false")).collect() == []
