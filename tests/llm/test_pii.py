import hashlib
import math
import random
import re
import tracemalloc

import numpy as np

from quillspark.llm import pii


PLAIN_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in PLAIN_IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", pii.CARD, 13, 19), ("phone", pii.PHONE, 9, 15)):
        for m in pattern.finditer(text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            ok = low <= len(d) <= high
            if kind == "card":
                ok = ok and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_match_the_patterns():
    rnd = random.Random(6)
    bits = ["a", "b.c", "@", "@@", ".", "-", "%", "é", " ", "x@y.z", "1", "255", "256.", "1.2.3.4", "+", "+4", "(12)", "4111 1111 1111 1111", "4111-1111-1111-1112", "0000000000000", "٣", "\n", "+1 (555) 555-0100", "9" * 14]
    for _ in range(20000):
        text = "".join(rnd.choices(bits, k=rnd.randrange(14)))
        assert pii.base_spans(text) == brute(text), repr(text)


def test_long_tokens_are_linear():
    pii.base_spans("a" * 400_000 + "@" + "b." * 100_000 + "9" * 5000)
    assert pii.regions("1 " * 100_000)
    for digits in ("7" * 1_000_000, "7." * 300_000, ("7" * 50_000 + ".") * 6):
        assert not [s for s in pii.base_spans(digits + "x") if s[0] == "ip" and "." not in digits]
    assert ("ip", 200_001, 200_008) in pii.base_spans("7" * 200_000 + " 1.2.3.4")


def test_a_long_table_of_numbers_needs_little_memory():
    """Its features are never all held: the model's part stays below 300 bytes a token."""
    text = "7 x " * 800
    tokens = pii.regions(text)[0]
    model = pii.SemiCRF(["bias"], np.array([[0.5, 0, 0, 0, 0], [0, 0, 0, 0, 0]]))
    tracemalloc.start()
    found = model.segmentation(text, tokens, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[-1][1] == len(tokens) and peak < 300 * len(tokens) + (1 << 20)


def test_forward_backward_against_enumeration():
    rnd = random.Random(2)
    text = "call 555 at 1.2.3.4"
    tokens = [m.span() for m in pii.TOKEN.finditer(text)]
    model = pii.SemiCRF()
    segments, names = model.lattice(text, tokens)
    model = pii.SemiCRF(sorted({x for f in names for x in f}))
    model.w = np.array([[rnd.uniform(-1, 1) for _ in range(5)] for _ in model.w])
    rows = model.rows(names)
    p = model.marginals(segments, rows)
    score = model.w[rows].sum(axis=1)
    by_start = {}
    for k, (i, j) in enumerate(segments):
        by_start.setdefault(i, []).extend((k, y) for y in range(0 if j == i + 1 else 1, 5))

    def paths(at):
        if at == len(tokens):
            yield ()
        for k, y in by_start.get(at, []):
            for rest in paths(segments[k][1]):
                yield ((k, y), *rest)

    every = list(paths(0))
    weight = np.array([math.exp(sum(score[e] for e in x)) for x in every])
    for block in (1, 2, 3, len(tokens), 100):  # however many tokens are held at a time
        found = model.segmentation(text, tokens, block)
        path = [(segments.index((i, j)), y) for i, j, y, _ in found]
        assert path == list(every[int(weight.argmax())])
        assert all(abs(p[k, y] - q) < 1e-9 for (k, y), (_, _, _, q) in zip(path, found))
    for k in range(len(segments)):
        for y in range(5):
            assert abs(p[k, y] - sum(w for w, x in zip(weight, every) if (k, y) in x) / weight.sum()) < 1e-9


def test_documents_and_learned_spellings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.train_model(docs)
    out = {r.doc_id: r for r in pii.personal_data(docs, model).collect()}
    added = 0
    for r in docs.collect():
        base = brute(r.text)
        g = out[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in pii.KINDS)
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert g.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(g.spans.split(","))
        added += g.n_added
    assert added <= 20
    text = "or the 1-938-555-0822 and then or ble and bosbt.42 at mail8.example.com thon"
    assert pii.find_spans(model, text)[1] == [("phone", 7, 21), ("email", 42, 71)]
    for clean in ("in 2024 there were 15 of them and 3.14 more", "chapter 12 verse 7", "room 101, floor 3"):
        assert pii.find_spans(model, clean) == ([], [])


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "mail a@b.cd", 1), (2, None, 1), (2, "", 1), (2, "", 1)], "doc_id long, text string, spans int")
    out = sorted(map(tuple, pii.personal_data(df).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    assert out[:3] == [(2, 0, 0, 0, 0, empty, "", 0)] * 3 and out[3][1] == 1 and out[3][6] == "email:5:11"
    assert pii.personal_data(df.where("false")).collect() == []
