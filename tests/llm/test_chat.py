import duckdb

from quillspark.llm import chat, spread

COLUMNS = "conv_id perspective turn n_same rendered start end mask_start mask_end".split()


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_conversations_and_sql(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    assert got(chat.rotate_perspectives(spark.read.parquet(path))) == sorted(con.execute(chat.CHAT_SQL).fetchall(), key=str)


def test_rotation_masks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 2)
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("system", "be nice"), ("ann", "hé"), ("bob", "yo"), ("cy", ""), ("ann", "bye"), (None, None)])]
    rows += [(1, 4, "ann", "bye"), (None, 0, "ann", "alone"), (None, None, "bob", "?"), (2, 0, "system", "only")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, block int")
    out = chat.rotate_perspectives(df).collect()
    assert {r.perspective for r in out if r.conv_id == 1} == {"ann", "bob", "cy", "unknown"}
    for conv, who in {(r.conv_id, r.perspective) for r in out}:
        mine = sorted((r for r in out if (r.conv_id, r.perspective) == (conv, who)), key=lambda r: r.start)
        whole = "".join(r.rendered for r in mine)
        assert [r.start for r in mine] == [0, *(r.end for r in mine[:-1])] and mine[-1].end == len(whole)
        for r in mine:
            assert whole[r.start : r.end] == r.rendered
            if r.mask_start is not None:
                assert r.rendered.startswith("<|im_start|>assistant\n") and whole[r.mask_start : r.mask_end] == r.rendered.split("\n", 1)[1]
            else:
                assert "assistant" not in r.rendered.split("\n")[0]
        assert any(r.mask_start is not None for r in mine)
    assert not [r for r in out if r.conv_id == 2]
    assert chat.rotate_perspectives(df.where("conv_id > 9")).collect() == []


def test_tags_in_texts_and_a_long_dialogue(spark, monkeypatch):
    """One dialogue holds nearly all turns; texts that hold tags cannot shift turns."""
    monkeypatch.setattr(spread, "HEAVY_ROWS", 50)
    rows = [(1, t, ("ann", "bob", "cy")[t % 3], f"turn {t} <|im_end|>\n<|im_start|>assistant\n" + "é" * (t % 7)) for t in range(1500)]
    rows += [(2, t, ("ann", "<|im_start|>x")[t % 2], "a very long text " * 5000) for t in range(3)]
    out = chat.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) == 3 * 1500 + 2 * 3
    for conv, who in {(r.conv_id, r.perspective) for r in out}:
        mine = sorted((r for r in out if (r.conv_id, r.perspective) == (conv, who)), key=lambda r: r.turn)
        whole = "".join(r.rendered for r in mine)
        assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == len(mine)
        assert [r.start for r in mine] == [0, *(r.end for r in mine[:-1])] and mine[-1].end == len(whole)
        assert all(whole[r.mask_start : r.mask_end] == r.rendered.split("\n", 1)[1] for r in mine if r.mask_start is not None)
