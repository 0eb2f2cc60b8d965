"""The pipeline's stages on the smallest tables, each against what its operator should do with its input."""

from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from granero.llm.quality_rules import quality_verdicts
from granero.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


def test_names_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_copies", "packing"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, FOLDER)
    verdicts = {r["doc_id"]: r["kept"] for r in quality_verdicts(docs, "doc_id", "text", "lang").collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in verdicts.items() if v}
    civil = stages["toxicity"](spark, docs, FOLDER)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r["doc_id"] for r in civil.collect()}
    clean = [k for k, v in labels.items() if v == 0]
    assert civil.columns == docs.columns and sum(k in left for k in clean) >= 0.95 * len(clean)
    single = stages["near_copies"](spark, docs, FOLDER)
    texts = defaultdict(list)
    for r in docs.collect():
        if r["text"] and r["text"].strip():
            texts[r["text"]].append(r["doc_id"])
    stay = {r["doc_id"] for r in single.collect()}
    assert single.columns == docs.columns and all(len(stay & set(same)) <= 1 for same in texts.values())
    packed = stages["packing"](spark, single, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == stay


def test_the_pipeline_runs_and_keeps_rows_without_an_id(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(5).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    assert corpus_pipeline.near_copies(spark, docs, FOLDER).count() == docs.count()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clean_texts(spark, n):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = [r["doc_id"] for r in quality_verdicts(docs, "doc_id", "text", "lang").filter("kept and n_words between 100 and 400").select("doc_id").collect()]
    return [r["text"] for r in docs.filter(docs.doc_id.isin(ids)).orderBy("doc_id").collect()][:n]


def test_a_hot_source_of_junk_does_not_hide_itself(spark, frame):
    rng = random.Random(20)
    texts = clean_texts(spark, 40)
    for lang in ("en", None, "zz"):  # junk is a third of all rows and of their one language, or has one of its own
        junk = [" ".join("".join(rng.choices("#*$%&|<>0123456789abcXYZ", k=6)) for _ in range(400)) for _ in range(20)]
        docs = frame([(i, t, "en", "a", 0) for i, t in enumerate(texts)] + [(1000 + i, t, lang, "b", 0) for i, t in enumerate(junk)], DOCS)
        left = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, FOLDER).collect()}
        assert left == set(range(40))


def test_near_copies_of_the_pipeline_are_five_words_and_80_percent(spark, frame):
    words = [f"w{i}" for i in range(1000)]
    copies = [" ".join(words), " ".join(words + [f"x{i}" for i in range(230)])]  # 996 of 1226 shingles, 0.81
    copies.append(" ".join(f"y{i}" if i % 46 == 5 else w for i, w in enumerate(words)))  # 22 changed words
    far = " ".join(words[:700] + [f"z{i}" for i in range(300)])
    docs = frame([(i, t, "en", "a", 0) for i, t in enumerate([*copies, far])], DOCS)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect()) == [0, 3]


def test_decisions_hit_rows_and_not_ids(spark, frame):
    one, two = clean_texts(spark, 2)
    docs = frame([(None, one, "en", "a", 0), (None, "junk", "en", "a", 0), (5, two, "en", "a", 0), (5, "junk", "en", "b", 0),
                  (None, one, "en", "c", 0), (7, one, "en", "d", 0), (5, two, "en", "e", 0)], DOCS)
    kept = corpus_pipeline.quality(spark, docs, FOLDER)
    assert sorted(r["source"] for r in kept.collect()) == ["a", "a", "c", "d", "e"]
    single = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, kept, FOLDER).collect()]
    assert sorted(single) == sorted([(7, one), (5, two)])


def test_toxic_documents_go_and_clean_ones_stay(spark, frame, tmp_path):
    rng = random.Random(24)
    stock = [f"palabra{i}" for i in range(150)]
    rows, truth = [], {}
    for i in range(400):
        words = rng.choices(stock, k=rng.randrange(20, 300))
        truth[i] = i % 5 == 0
        if truth[i]:
            words[rng.randrange(len(words))] = rng.choice(["zoquete", "inútil", "patán"])
        rows.append((i, " ".join(words), "es", "a", 0))
    frame([(i, int(t)) for i, t in truth.items() if i < 300], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = corpus_pipeline.toxicity(spark, frame(rows, DOCS), str(tmp_path))
    kept = {r["doc_id"] for r in left.collect()}
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sum(i in kept for i in truth if truth[i]) <= 2 and sum(i in kept for i in truth if not truth[i]) >= 0.98 * 320
