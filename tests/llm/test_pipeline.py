import re

import sentencepiece

import corpus_pipeline
from quillspark.llm import pieces, quality
from tests.llm import test_mixing, test_neardup, test_quality, test_secrets


def test_each_stage_against_brute_force(spark):
    """Every stage on what its predecessor kept, and its decision carried out."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality_rules", "near_dedup", "secret_scans", "source_mixing", "sentencepiece"]
    rows = {r.doc_id: r.text for r in docs.collect()}

    out = stages["quality_rules"](spark, docs, sf)
    verdict = {r.doc_id: r.kept for r in quality.judge_quality(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert {r.doc_id for r in out.collect()} == {d for d in rows if verdict[d]} and out.columns == columns
    assert all(not test_quality.brute(rows[d])[5] for d in rows if verdict[d])
    docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = {d: t for d, t in rows.items() if verdict[d]}

    out = stages["near_dedup"](spark, docs, sf)
    keep = {d for d, _, _, kept in test_neardup.brute([*rows.items()], 5) if kept}
    assert {r.doc_id for r in out.collect()} == keep and out.columns == columns
    docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = {d: rows[d] for d in keep}

    out = stages["secret_scans"](spark, docs, sf)
    masked = {}
    for d, t in rows.items():
        spans = sorted((int(a), int(b)) for a, b in (x.split(":")[1:] for x in test_secrets.brute(t)[4].split(",") if x))
        at, text = 0, ""
        for a, b in spans:
            if a >= at:
                text += t[at:a] + "[SECRET]"
            at = max(at, b)
        masked[d] = text + t[at:]
    assert {r.doc_id: r.text for r in out.collect()} == masked and out.columns == columns
    assert all(r.n_chars == len(r.text) for r in out.collect() if masked[r.doc_id] != rows[r.doc_id])
    docs = spark.createDataFrame(out.collect(), docs.schema)

    out = stages["source_mixing"](spark, docs, sf)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, taken, source = {}, {}, {r.doc_id: r.source for r in docs.collect()}
    for d, t in masked.items():
        sizes[source[d]] = sizes.get(source[d], 0) + words(t)
    for r in out.collect():
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    for s, target in test_mixing.brute_targets(sizes).items():
        longest = max(words(t) for d, t in masked.items() if source[d] == s)
        assert target - longest <= taken.get(s, 0) <= target + 1e-6
    assert out.columns == columns
    docs = spark.createDataFrame(out.collect(), docs.schema)

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = sorted((r.doc_id, library.encode(r.text)) for r in docs.collect())
    assert sorted((r.doc_id, r.ids) for r in stages["sentencepiece"](spark, docs, sf).collect()) == want


def test_run_makes_all_stages(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
