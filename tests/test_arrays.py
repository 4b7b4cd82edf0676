import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.functions import portions
from quillspark.operators import tokens
from quillspark.sources import arrays, files

SCHEMA = "id long, text string, more struct<a:array<string>,b:struct<c:string>>"


def records(n, seed=1):
    rnd = random.Random(seed)
    odd = ["}", "{", '"', "\\", '\\"', "[", "]", ",", " ", "\n", "é", "😀", "x", '"}', "},{"]
    word = lambda: "".join(rnd.choice(odd) for _ in range(rnd.randrange(12)))
    return [{"id": i, "text": word(), "more": {"a": [word() for _ in range(rnd.randrange(3))], "b": {"c": word()}}} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for k, v in zip(old, ("700", "0", "7")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent,ascii_", [(None, True), (None, False), (2, False)])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_splits, indent, ascii_):
    rows = records(120)
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(rows[:7], indent=indent), encoding="utf-8")
    (tmp_path / "none.json").write_text("[ ]\n")
    (tmp_path / "empty.json").write_text("")
    paths = [str(tmp_path / f"{n}.json") for n in ("one", "two", "none", "empty")]
    assert spark.read.option("lineSep", "}").text(paths[0]).rdd.getNumPartitions() > 10
    df = arrays.read_json_array(spark, paths, SCHEMA)
    got = {(r.path.rsplit("/", 1)[1], r.number): r.asDict(True) for r in df.collect()}
    want = {(name, i): x for name, part in (("one.json", rows), ("two.json", rows[:7])) for i, x in enumerate(part)}
    assert {k: {c: v[c] for c in ("id", "text", "more")} for k, v in got.items()} == want


def test_written_arrays_are_json_and_come_back(spark, tmp_path, small_splits):
    rows = records(300, 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, "id")
    arrays.write_json_array(df, str(tmp_path / "a"))
    parts = [json.loads(p.read_text()) for p in (tmp_path / "a").glob("part-*") if p.stat().st_size]
    assert sorted((r for p in parts for r in p), key=lambda r: r["id"]) == rows
    back = arrays.read_json_array(spark, str(tmp_path / "a"), SCHEMA).drop("path", "number")
    assert sorted((r.asDict(True) for r in back.collect()), key=lambda r: r["id"]) == rows


def test_broken_records_are_an_error(spark, tmp_path):
    (tmp_path / "b.json").write_text('[{"id": 1}, {"id": x}]')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        arrays.read_json_array(spark, str(tmp_path / "b.json"), "id long").collect()


def test_bio_and_annotations(spark, tmp_path):
    for split, n in (("train", 3), ("test", 1)):
        (tmp_path / f"{split}.json").write_text(json.dumps([{"tokens": ["a", "b"], "ner_tags": ["O", "B-x"]}] * n, indent=1))
    rows = files.bio_dataset(spark, str(tmp_path)).collect()
    assert sorted(r.split for r in rows) == ["test", "train", "train", "train"] and rows[0].tokens == ["a", "b"]
    (tmp_path / "ann.json").write_text(json.dumps([{"text": "a b", "entities": [{"start": 0, "end": 1, "label": "x"}]}]))
    assert files.annotations(spark, str(tmp_path / "ann.json")).first().entities[0].label == "x"


def brute_tags(toks, entities, ranked):
    order = sorted(range(len(entities)), key=lambda i: (0 if not ranked or entities[i][3] == "VALUE" else 1, entities[i][1], i))
    out, seen = [], set()
    for _, a, b in toks:
        hit = next((i for i in order if b > entities[i][1] and a < entities[i][2]), None)
        if hit is None:
            out.append("O")
            continue
        out.append(("I-" if hit in seen else "B-") + entities[hit][0] + (f"_{entities[hit][3]}" if ranked else ""))
        seen.add(hit)
    return out


@pytest.mark.parametrize("ranked", [False, True])
def test_tags_against_brute_force(spark, ranked):
    rnd = random.Random(3)
    rows = []
    for i in range(200):
        text = " ".join("w" * rnd.randrange(1, 6) for _ in range(rnd.randrange(0, 25)))
        found = []
        for _ in range(rnd.randrange(0, 7)):
            a = rnd.randrange(0, len(text) + 1)
            found.append((rnd.choice("xy"), a, a + rnd.randrange(0, 20), rnd.choice(("VALUE", "LABEL"))))
        rows.append((i, text, found))
    rows.append((999, None, []))
    df = spark.createDataFrame(rows, "id long, text string, e array<struct<label:string,start:int,end:int,role:string>>")
    t = tokens.tokens_with_offsets("text")
    for r in df.select("id", t.alias("t"), "e").select("id", "t", "e", tokens.bio_tags(F.col("t"), F.col("e"), ranked).alias("tags")).collect():
        assert r.tags == brute_tags([tuple(x) for x in r.t], [tuple(x) for x in r.e], ranked)


def test_many_entities_cost_in_proportion():
    n = 200_000
    starts = np.arange(n) * 2
    winner, opens = tokens.first_wins(starts, starts + 1, list(range(0, 2 * n, 2)), [2 * n] * n)  # every entity reaches to the end
    assert (winner == 0).all() and opens.sum() == 1


def test_byte_ranges_are_scanned_in_short_stretches(monkeypatch):
    """One batch with 8 MB of records and one record of 3 MB: no stretch is longer than the bound, and all come back."""
    rows = [{"t": "x}\\" * 4000} for _ in range(500)] + [{"t": '\\"' * 700_000}]
    text = json.dumps(rows).split("}")
    batch = pa.RecordBatch.from_pydict({"value": text, "path": ["p"] * len(text), "block": [0] * len(text)})
    seen, scan = [], arrays.scan
    monkeypatch.setattr(arrays, "scan", lambda data, inside: (seen.append(len(data)), scan(data, inside))[1])
    told = [SimpleNamespace(**(r | {"closed": dict(r["closed"])})) for b in arrays.summaries(iter([batch])) for r in b.to_pylist()]
    assert len(told) == 2
    out = [r for b in arrays.cut(arrays.states(told))(iter([batch])) for r in b.to_pylist()]
    assert [json.loads(r["value"].lstrip("[, ")) for r in out if r["whole"]] == rows
    assert max(seen) <= portions.MOST_BYTES + 100


def test_what_is_no_whole_record_is_never_parsed(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "ab" * i} for i in range(90)]))
    rows = arrays.read_json_array(spark, str(tmp_path / "a.json"), "text string")
    assert rows.where(F.col("text").rlike("a")).count() == 89
