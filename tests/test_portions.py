import numpy as np
import pyarrow as pa
import pytest

from quillspark.functions import portions
from quillspark.operators import tokens

from .test_arrays import brute_tags


def test_portions_bound_what_is_worked_on_at_once():
    sizes = np.array([5, 0, 3, 100, 1, 1, 0, 9])
    cut = list(portions.portions(sizes, 10))
    assert [a for a, _ in cut] == np.cumsum([0, *(n for _, n in cut)])[:-1].tolist() and sum(n for _, n in cut) == len(sizes)
    assert all(n == 1 or (sizes[a : a + n] + 1).sum() <= 10 for a, n in cut)


def test_tokens_are_cut_a_portion_at_a_time(monkeypatch):
    """8 MB of texts in one batch: no call sees more than the bound, and rows come back in order."""
    texts = pa.array(["ab cd " * 500] * 2600 + [None, "x"])
    seen = []
    made = []
    monkeypatch.setattr(portions.F, "arrow_udf", lambda run, kind, how: made.append(run))
    portions.in_portions(lambda t: (seen.append(t.nbytes), tokens.token_lists(t))[1], tokens.TOKENS)
    got = pa.chunked_array(list(made[0](iter([texts]))))
    assert len(got) == len(texts) and got[0].as_py() == got[2599].as_py() and [x["token"] for x in got[2601].as_py()] == ["x"]
    assert max(seen) < 2 * portions.MOST_BYTES and len(seen) > 5


@pytest.mark.parametrize("ranked", [False, True])
def test_cut_and_tagged_in_one_pass(spark, ranked):
    rows = [(1, "ab c\nde  f", [("x", 1, 5, "LABEL"), ("y", 4, 9, "VALUE")]), (2, None, []), (3, "", []), (4, "é 😀 z", [("x", 2, 3, "VALUE")])]
    df = spark.createDataFrame(rows, "id long, text string, e array<struct<label:string,start:int,end:int,role:string>>").coalesce(1)
    got = {r.id: r.t for r in df.select("id", tokens.tagged_tokens("text", "e", ranked).alias("t")).collect()}
    assert not got[2] and not got[3]
    for i, _, entities in rows:
        assert [x.tag for x in got[i]] == brute_tags([(x.token, x.start, x.end) for x in got[i]], entities, ranked)
    assert [(x.token, x.start, x.end) for x in got[4]] == [("é", 0, 1), ("😀", 2, 3), ("z", 4, 5)]
