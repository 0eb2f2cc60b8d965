"""Every text query on the smallest tables: against its SQL where there is one, else that it returns a row per document."""

from __future__ import annotations

import base64
import hashlib
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from check_oracle import compare, connect
from granero.llm.oracle import ORACLE
from granero.llm.packing import cut
from granero.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def encode():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_tokens(spark, texts, encode):
    out = QUERIES["op3_byte_bpe"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in out} == set(texts) and len(out) == len(texts)
    for r in out:
        ids = encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


def test_packing(spark, texts, encode):
    out = QUERIES["op7_bestfit_packing"](spark, FOLDER).collect()
    expect = set()
    for doc, text in texts.items():
        ids = np.array([*encode(text), 2], "<u4")
        expect |= {(doc, i, s, n, zlib.crc32(ids[s:s + n].tobytes())) for i, (s, n) in enumerate(cut(len(ids), 1024))}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out} == expect and len(out) == len(expect)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out)
    for (a, at, n), (b, start, _) in zip(places, places[1:]):
        assert start == (at + n if a == b else 0)
    assert len({p[0] for p in places}) <= -(-sum(p[2] for p in places) // 1024) + 1


def test_scores_have_a_row_per_document(spark, texts):
    toxic = QUERIES["op4_toxicity"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in toxic} == set(texts) and len(toxic) == len(texts)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in toxic)
    losses = QUERIES["op10_cross_entropy_difference"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in losses} == set(texts) and len(losses) == len(texts)


def test_notices_that_a_plain_search_finds(spark, texts):
    lines = {"mit-line": "Released under the MIT License.", "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
             "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3."}
    found = {(r["doc_id"], r["template"]) for r in QUERIES["op2_license_scan"](spark, FOLDER).collect()}
    assert {(d, n) for d, t in texts.items() for n, line in lines.items() if line in t} <= found
