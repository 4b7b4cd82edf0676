import random
import re
from collections import Counter
from math import comb

import numpy as np

from quillspark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def counts(df):
    return {r.doc_id: tuple(r[c] for c in (*quality.COUNTS, "base_failed")) for r in df.collect()}


def test_counts_match_brute_force(spark):
    rnd = random.Random(2)
    texts = [None, "", "\n", "\n\n", "a", "a\na", "a\n a\na \n\na", " \t\n\x0b\f\r", "é|é|é é é\n\né|é|é é é", "x" * 50_000]
    texts += ["".join(rnd.choices(["a", "b ", "\n", " ", "é#", "日本", "a b c\n", "\t"], k=rnd.randrange(200))) for _ in range(400)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "xx", 1) for d, t in rows], "doc_id long, text string, lang string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert counts(quality.judge_quality(docs, labels)) == {d: brute(t) for d, t in rows}


def test_counts_on_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.judge_quality(docs, labels)
    assert counts(out) == {r.doc_id: brute(r.text) for r in docs.collect()}
    assert all(r.kept == (not r.base_failed and not r.rejected_by) for r in out.collect())


def test_binomial_bound_is_exact():
    for n, k, p in ((10, 3, 0.2), (50, 0, 0.01), (200, 7, 0.05), (5, 5, 0.5)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_below(k, n, p) - want) < 1e-12


def chosen_by_brute_force(rows, risk, level):
    """rows: (levels, kind) per document, kind good, bad or other. The chosen setting by plain counting."""
    ladders = [len(x) for x in quality.LADDERS.values()]
    hit = lambda levels, cuts: any(x >= c for x, c in zip(levels, cuts))
    cuts, path = [n + 1 for n in ladders], []
    total = Counter(k for _, k in rows)
    while True:
        options = []
        for r in range(len(cuts)):
            for cut in range(cuts[r] - 1, 0, -1):
                new = Counter(k for x, k in rows if not hit(x, cuts) and x[r] >= cut)
                lift = new["bad"] / max(total["bad"], 1) / ((new["other"] + 1) / (total["other"] + 1))
                if new["bad"] and lift >= quality.LEAST_LIFT:
                    options.append((lift, new["bad"], -r, cut))
        if not options:
            break
        _, _, r, cut = max(options)
        cuts = [*cuts[:-r], cut, *cuts[-r + 1 :]]
        path.append(cuts)
    best, chosen = 0, None
    for cuts in path:
        out = Counter(k for x, k in rows if hit(x, cuts))
        n = total["good"]
        if not n or sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(out["good"] + 1)) > level:
            break
        if out["bad"] - quality.GOOD_COST * out["good"] > best:
            best, chosen = out["bad"] - quality.GOOD_COST * out["good"], cuts
    return chosen


def drawn(rnd, n):
    ladders = [len(x) for x in quality.LADDERS.values()]
    rows = []
    for _ in range(n):
        kind = rnd.choice(["good", "good", "bad", "other"])
        rows.append(([rnd.randrange(k + 1) if rnd.random() < (0.6 if kind == "bad" else 0.02 if kind == "good" else 0.2) else 0 for k in ladders], kind))
    return rows


def test_setting_matches_brute_force():
    rnd, some = random.Random(11), 0
    for _ in range(12):
        rows, risk, level = drawn(rnd, 150), rnd.choice([0.05, 0.2, 0.4]), rnd.choice([0.05, 0.2])
        numbers = [np.array([int(k == kind) for _, k in rows]) for kind in ("good", "bad", "other")]
        got = quality.choose_setting(np.array([x for x, _ in rows]), *numbers, risk, level)
        want = chosen_by_brute_force(rows, risk, level)
        assert (None if got is None else got.tolist()) == want
        some += want is not None
    assert some


def test_joint_risk_holds_over_draws():
    """All rules together falsely reject more than the risk in no more than delta of many holdouts."""
    rnd, risk, delta, broken = random.Random(5), 0.1, 0.1, 0
    ladders = [len(x) for x in quality.LADDERS.values()]
    draw = lambda p: [rnd.randrange(1, k + 1) if rnd.random() < p else 0 for k in ladders]
    truth = [draw(0.03) for _ in range(4000)]
    for _ in range(100):
        rows = [(rnd.choice(truth), "good") for _ in range(120)] + [(draw(0.3), "bad") for _ in range(60)] + [(draw(0.05), "other") for _ in range(100)]
        numbers = [np.array([int(k == kind) for _, k in rows]) for kind in ("good", "bad", "other")]
        cuts = quality.choose_setting(np.array([x for x, _ in rows]), *numbers, risk, delta)
        broken += cuts is not None and (np.array(truth) >= cuts).any(axis=1).mean() > risk
    assert broken <= 18  # 10 are allowed on average


def test_kept_matches_brute_force_on_documents(spark):
    """The verdicts of judge_quality, from scores, labels and strata recounted by hand."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    risk, delta = 0.1, 0.4
    out = {r.doc_id: r for r in quality.judge_quality(docs, labels, risk=risk, delta=delta).collect()}
    good = {r.doc_id: r.quality > 0 for r in labels.collect() if r.quality is not None}
    share = lambda text, some, of: sum(c in some for c in text) / max(1, of)
    strata = {}
    for r in docs.collect():
        n, chars, symbols, dup, covered, _ = brute(r.text)
        lines = sum(bool(WORD.search(x)) for x in r.text.split("\n"))
        upper, letters = sum("A" <= c <= "Z" for c in r.text), sum("a" <= c.lower() <= "z" and c.isascii() for c in r.text)
        scores = (symbols / max(n, 1), dup / max(lines, 1), covered / max(n, 1), upper / max(letters, 1), share(r.text, "!?|#*$%&<>", n), chars / max(n, 1))
        levels = [sum(x > c for c in ladder) for x, ladder in zip(scores, quality.LADDERS.values())]
        kind = {True: "good", False: "bad", None: "other"}[good.get(r.doc_id)]
        strata.setdefault(r.lang, []).append((levels, kind, r.doc_id))
    sizes = sorted((-sum(k == "good" for _, k, _ in rows) for rows in strata.values()))
    tested = max(i for i, n in enumerate(sizes, 1) if (1 - risk) ** -n <= delta / i)
    rejected = 0
    for rows in strata.values():
        cuts = chosen_by_brute_force([(x, k) for x, k, _ in rows], risk, delta / tested) if (1 - risk) ** sum(k == "good" for _, k, _ in rows) <= delta / tested else None
        for levels, _, d in rows:
            bad = cuts is not None and any(x >= c for x, c in zip(levels, cuts))
            assert out[d].kept == (not out[d].base_failed and not bad)
            rejected += bad
    assert rejected


def test_keep_good_keeps_rows_and_columns(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(None, good, "x", 1), (1, good, "x", 2), (1, good, "x", 2), (1, "short", "x", 3), (2, None, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.keep_good(docs, labels)
    assert out.schema == docs.schema and sorted(map(tuple, out.collect()), key=repr) == sorted(rows[:3], key=repr)
    assert quality.keep_good(docs.where("false"), labels).collect() == []


def test_learned_rule_rejects_bad_and_keeps_good(spark):
    good = " ".join(f"word{i}" for i in range(60))
    bad = " ".join(f"w{i}||" for i in range(60))
    rows = [(i, good if i % 4 else bad, "l" if i % 2 else None) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(bool(i % 4)), 0) for i in range(3990)] + [(None, 1, 0), (5, None, 0), (5, 1, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.judge_quality(docs, labels).collect()
    assert all(r.kept == bool(r.doc_id % 4) for r in out) and len(out) == 4000
    few = quality.judge_quality(docs, labels.where("doc_id < 200")).collect()
    assert all(r.kept for r in few)
    assert quality.judge_quality(docs.where("false"), labels).collect() == []
