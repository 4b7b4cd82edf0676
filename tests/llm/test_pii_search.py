"""What the model is trained on and where it looks."""

import random
from collections import Counter

import numpy as np

from quillspark.llm import pii


def test_sample_holds_base_spans_in_a_corpus_of_plain_numbers(spark, monkeypatch):
    numbers = [(i, f"room {i} floor") for i in range(3000)]
    docs = spark.createDataFrame([*numbers, *((5000 + i, f"write to ann{i}@mail{i}.example.com now") for i in range(5))], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(pii.SemiCRF, "train", lambda self, examples: seen.extend(examples))
    pii.train_model(docs, 20)
    # regions with base spans come in two spellings, every one without again with a made-up span
    assert len(seen) == 50 and sum(bool(spans) for _, spans in seen) >= 20


def test_spelt_out_signs_open_a_region(spark):
    """A model that knows the spelling gets to see it, wherever digits are."""
    names = ["mail=True", "tokens=5"]
    weights = np.zeros((3, 5))
    weights[:2, 1], weights[2, 1:], weights[2, 0] = 300, -20, 1
    model = pii.SemiCRF(names, weights)
    text = "we ask you to write to jane [at] example [dot] com about the matter"
    assert pii.find_spans(model, text) == ([], [("email", 23, 50)])
    docs = spark.createDataFrame([(1, text), (2, "nothing of the kind")], "doc_id long, text string")
    assert {r.doc_id: r.n_added for r in pii.personal_data(docs, model).collect()} == {1: 1, 2: 0}
    assert all(pii.regions(f"a {sign} b") for sign in ("at", "AT", "(at)", "[at]", "dot", "[dot]", "(dot)", "x[at]y"))
    assert not pii.regions("that dotted attic is at-tic")


def test_ordinary_words_between_signs_stay(spark):
    model = pii.train_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for clean in ("look at the dot on the map", "she was at home and at work", "AT last"):
        assert pii.regions(clean) and pii.find_spans(model, clean) == ([], [])


def test_spans_across_the_old_cut_are_found():
    """The same span at every place of a number-dense text, also where tokens 48, 96, ... end."""
    weights = np.zeros((4, 5))
    weights[:3, 4], weights[3, 1:], weights[3, 0] = 200, -20, 1
    model = pii.SemiCRF(["phone=True&True&3", "digits=10", "tokens=3"], weights)
    for before in range(120):
        text = "7 x " * (before // 2) + "y " * (before % 2) + "938 555 0822" + " 7 x" * 60
        at = text.index("938")
        assert ("phone", at, at + 12) in pii.find_spans(model, text)[1], before
    assert len(pii.regions("7 x " * 500)) == 1


def other_spellings(rnd):
    """(form, kind, span): spellings that no base pattern finds, written without a look at what the model is trained on."""
    digits = lambda n: "".join(str(rnd.randrange(10)) for _ in range(n))
    number = rnd.choice(("4", "51", "37"))
    number += digits(15 - len(number))
    number += next(c for c in "0123456789" if pii.luhn(number + c))
    fours = [number[i : i + 4] for i in range(0, 16, 4)]
    octets = [str(rnd.randrange(256)) for _ in range(4)]
    yield "0049 30 1234567", "phone", f"00{rnd.randrange(20, 99)} {rnd.randrange(10, 99)} {digits(7)}"
    yield "(030) 1234 5678", "phone", f"(0{rnd.randrange(10, 99)}) {rnd.randrange(1000, 9999)} {rnd.randrange(1000, 9999)}"
    yield "555-123-4567", "phone", f"{rnd.randrange(200, 999)}-{rnd.randrange(200, 999)}-{rnd.randrange(1000, 9999)}"
    for sign in (".", "/", "  "):
        yield f"card by {sign!r}", "card", sign.join(fours)
    yield "1[.]2[.]3[.]4", "ip", "[.]".join(octets)
    yield "1 dot 2 dot 3 dot 4", "ip", " dot ".join(octets)


def test_recall_of_other_spellings_by_kind(spark):
    model = pii.train_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rnd = random.Random(77)
    found, total, wrong = Counter(), Counter(), 0
    for _ in range(40):
        for _, kind, span in other_spellings(rnd):
            head = rnd.choice(("please see ", "| ", "kontakt: ", "under "))
            base, more = pii.find_spans(model, head + span + rnd.choice((" today", ", thanks", " | and so on")))
            if base:
                continue
            total[kind] += 1
            found[kind] += (kind, len(head), len(head) + len(span)) in more
            wrong += sum(s != (kind, len(head), len(head) + len(span)) for s in more)
    assert all(found[k] >= 0.9 * n for k, n in total.items()) and wrong <= 0.02 * sum(total.values()), (found, total, wrong)


def planted(rnd, n):
    """Sentences with one planted span each that no base pattern finds, and where it lies."""
    people, hosts, ends = ["jane", "bob.smith", "k_lee7", "info", "sales-eu", "maria.x"], ["example", "mail.acme", "web4.uni", "post"], ["com", "org", "net", "de"]
    before, after = ["please write to", "reach me via", "kontakt:", "contactez", "|", "for questions"], ["today", "before noon.", "|", "und danke", "or come by"]
    for _ in range(n):
        at, dot = rnd.choice([" at ", " [at] ", " (at) "]), rnd.choice([" dot ", " [dot] ", " (dot) "])
        mail = f"{rnd.choice(people)}{at}{rnd.choice(hosts).replace('.', dot)}{dot}{rnd.choice(ends)}"
        area, a, b = rnd.randrange(200, 999), rnd.randrange(200, 999), rnd.randrange(1000, 9999)
        phone = rnd.choice([f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"1 ({area}) {a}-{b}", f"1-{area}-{a}-{b}"])
        kind, span = rnd.choice([("email", mail), ("phone", phone)])
        head = rnd.choice(before) + " "
        yield head + span + " " + rnd.choice(after), kind, len(head), len(head) + len(span)


def test_recall_of_planted_spans_and_false_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train_model(docs)
    rnd = random.Random(21)
    found, total = Counter(), Counter()
    for text, kind, a, b in planted(rnd, 600):
        base, more = pii.find_spans(model, text)
        assert not base
        total[kind] += 1
        found[kind] += (kind, a, b) in more
    assert all(found[k] >= 0.9 * n for k, n in total.items()), (found, total)
    # over the whole corpus, whose personal data the base patterns all find
    rows = [r.n_added for r in pii.personal_data(docs, model).collect()]
    assert sum(1 for n in rows if n) <= 0.005 * len(rows), sum(1 for n in rows if n)
    # sentences with dates, times, versions, amounts and stray signs
    words = "the meeting of last year was held in a small town".split()
    false = sum(len(pii.find_spans(model, pii.with_decoys(" ".join(rnd.choices(words, k=8)), rnd))[1]) for _ in range(1000))
    assert false <= 40, false


def test_query_adds_planted_spans(spark):
    rnd = random.Random(4)
    rows = [(i, t) for i, (t, _, _, _) in enumerate(planted(rnd, 200))]
    model = pii.train_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sum(r.n_added for r in out) >= 0.9 * len(rows) and all(r.n_email + r.n_phone == 0 for r in out)


def test_long_token_and_long_number_rows():
    """Texts of one very long token, and of very many numbers, go through whole."""
    model = pii.SemiCRF()
    for text in ("a1" * 50_000, "a." * 50_000 + "com", " ".join(str(i) for i in range(3000))):
        base, more = pii.find_spans(model, text)
        assert more == []


def test_outlines_change_no_result(spark):
    """With remembered outlines every text has the spans it has with a model that remembers nothing."""
    model = pii.train_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    rnd = random.Random(17)
    words = ["at", "AT", "(at)", "[at]", "dot", "[dot]", "(dot)", "com", "de", "É", "élan", "x", "jane", "mail", "Mail.", "a-b", "_", "...", "(", "host.org", "it", "\u0663", "at,", "dot."]
    hits = 0
    for _ in range(1500):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\n"]) for _ in range(rnd.randrange(2, 14)))
        found = pii.find_spans(model, text)
        kept, model.blank = model.blank, set()
        assert pii.find_spans(model, text) == found, text
        model.blank = kept
        hits += bool(found[1])
    assert hits and model.blank
