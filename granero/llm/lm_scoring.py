"""Cross-entropy difference: how much better a target model predicts a text than a background model."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow, put_aside, ship_package, workspace
from granero.llm.text_blocks import expand, marks_of, squeeze, store_blocks, store_marks, unpack

TOKEN = re.compile(r"\w+")
WORD_BITS = 18  # words that the smoothing supposes at least; a larger vocabulary counts as it is
PAIR_BITS = 63  # bits of the hash that stands for a word or a pair of words
LOW_BITS = 40  # bits of it that tell the words of a share apart; there are as many shares as the input needs
SMOOTHING = 16.0  # weight of the single-word model inside the pair model
SHARE_BYTES = 16 << 20  # text for each share of the counts
MEMORY = 1 << 20  # word hashes a task remembers
WORDS, PAIRS = 0, 1


def _hashes(words: list[str], memory: dict[str, int]) -> np.ndarray:
    if len(memory) > MEMORY:
        memory.clear()
    return np.fromiter((memory[w] if w in memory else memory.setdefault(w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1)
                        for w in words), dtype=np.uint64, count=len(words))


def _pairs(own: np.ndarray) -> np.ndarray:
    mixed = (own[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (own[:-1] >> np.uint64(29))
    mixed = (mixed + own[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)


def classes(text: str | None, memory: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a text, and of every word from the second on together with the one before."""
    own = _hashes(TOKEN.findall((text or "").lower()), memory)
    return own.astype(np.int64), _pairs(own).astype(np.int64)


class _Block:
    """The words and pairs of a block of texts, each distinct one once and in order, and where they stand in the texts."""

    def __init__(self, docs: pa.StructArray, marks: pa.Scalar, memory: dict[str, int]):
        self.chosen = np.array(docs.field("_target").to_pylist(), bool) | marks_of(marks, len(docs))
        words = [_hashes(TOKEN.findall((t.as_py() or "").lower()), memory) for t in docs.field("_text")]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.doc = np.repeat(np.arange(len(words)), self.lengths)
        own = np.concatenate([np.zeros(0, np.uint64), *words])
        self.later = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1  # words with one before them in the text
        pairs = _pairs(own)[self.later - 1]
        self.found = [np.unique(h, return_inverse=True) for h in (own, pairs)]
        self.docs_of = (self.doc, self.doc[self.later])

    def counts(self, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the block with their target and background counts."""
        hashes, at = self.found[table]
        return hashes, np.bincount(at[self.chosen[self.docs_of[table]]], minlength=len(hashes)), np.bincount(at, minlength=len(hashes))

    def own_times(self, table: int) -> np.ndarray:
        """How often each word (pair) occurs in its own text."""
        hashes, at = self.found[table]
        _, back, times = np.unique(self.docs_of[table] * max(1, len(hashes)) + at, return_inverse=True, return_counts=True)
        return times[back]

    def losses(self, words: np.ndarray, pairs: np.ndarray, total: int, vocabulary: int, own: np.ndarray, weight: float = 1.0) -> np.ndarray:
        """Mean loss (nats) of every text under the interpolated model; texts in `own` are taken out of it first.

        Counts times `weight`. Single words: (count + 1) / (words + vocabulary). From the second word on, with p that
        share: (pair count + SMOOTHING * p) / (count of the word before + SMOOTHING).
        """
        c_word, c_pair = (weight * (c[self.found[k][1]] - self.times[k] * own[self.docs_of[k]]) for k, c in ((WORDS, words), (PAIRS, pairs)))
        share = (c_word + 1) / (weight * (total - self.lengths * own)[self.doc] + float(vocabulary))
        chance = share.copy()
        chance[self.later] = (c_pair + SMOOTHING * share[self.later]) / (c_word[self.later - 1] + SMOOTHING)
        return np.bincount(self.doc, -np.log(chance), minlength=len(self.lengths)) / np.maximum(self.lengths, 1)

    @property
    def times(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_times"):
            self._times = self.own_times(WORDS), self.own_times(PAIRS)
        return self._times


def _limits(shares: int) -> list[int]:
    return [(i << PAIR_BITS) // shares for i in range(shares)]


def _pack_hashes(hashes: np.ndarray, begin: int, shares: int) -> bytes:
    """The upper bits of hashes inside their share, which are in order: the first and the steps from one to the next."""
    inside = (hashes - np.uint64(begin)) >> np.uint64(max(0, ((1 << PAIR_BITS) // shares).bit_length() - 1 - LOW_BITS))
    return squeeze(np.diff(inside, prepend=np.uint64(0)))


def _unpack_hashes(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(expand(packed, n), dtype=np.uint64)


def _count(shares: int):
    """Counts of each block: a row per table and share of the hashes, the distinct hashes in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        limits = _limits(shares)
        for batch in batches:
            for name, docs, marks in zip(*batch.columns):
                block, out = _Block(unpack(docs), marks, memory), []
                for table in (WORDS, PAIRS):
                    hashes, target, background = block.counts(table)
                    ends = [*np.searchsorted(hashes, np.array(limits, np.uint64)).tolist(), len(hashes)]
                    out += [(name.as_py(), table, i, hi - lo, _pack_hashes(hashes[lo:hi], limits[i], shares), squeeze(target[lo:hi]),
                             squeeze(background[lo:hi])) for i, (lo, hi) in enumerate(zip(ends, ends[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    ["_block", "_table", "_share", "n", "hashes", "target", "background"])
    return run


def _sum(rows: pa.Table) -> pa.Table:
    """Counts of all blocks for one share of the hashes, each block's in the order of its hashes; a row without block has the totals."""
    sizes = rows.column("n").to_pylist()
    hashes = [_unpack_hashes(h.as_py(), n) for h, n in zip(rows.column("hashes"), sizes)]
    ends = np.cumsum([0, *sizes])
    known, at = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = []
    for name in ("target", "background"):
        counts = np.concatenate([expand(c.as_py(), n).astype(np.int64) for c, n in zip(rows.column(name), sizes)])
        total = np.zeros(len(known), np.int64)
        np.add.at(total, at, counts)
        sums.append(total)
    table, share = rows.column("_table")[0].as_py(), rows.column("_share")[0].as_py()
    out = [(name.as_py(), table, share, *(squeeze(s[at[lo:hi]]) for s in sums), hi - lo, 0, 0)
           for name, lo, hi in zip(rows.column("_block"), ends.tolist(), ends[1:].tolist())]
    out.append((None, table, share, b"", b"", len(known), *(int(s.sum()) for s in sums)))
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(zip(*out), (
        ("_block", pa.int64()), ("_table", pa.int32()), ("_share", pa.int32()), ("target", pa.binary()), ("background", pa.binary()),
        ("n", pa.int64()), ("n_target", pa.int64()), ("n_background", pa.int64())))})


def _scorer(n_target: int, n_background: int, vocabulary: int, key_type: pa.DataType):
    weight = min(1.0, n_target / max(1, n_background))
    schema = pa.schema([("_key", key_type), ("n_tokens", pa.int64()), *[(n, pa.float64()) for n in ("target_loss", "background_loss", "score")]])

    def score(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        docs = unpack(blocks.column("_docs")[0])
        block = _Block(docs, blocks.column("_marks")[0], {})
        rows = sorted(counts.select(["_table", "_share", "target", "background", "n"]).to_pylist(), key=lambda r: (r["_table"], r["_share"]))
        model = {name: [np.concatenate([np.zeros(0, np.int64), *(expand(r[name], r["n"]).astype(np.int64) for r in rows if r["_table"] == table)])
                        for table in (WORDS, PAIRS)] for name in ("target", "background")}
        near = block.losses(*model["target"], n_target, vocabulary, block.chosen)
        far = block.losses(*model["background"], n_background, vocabulary, np.ones(len(docs), bool), weight)
        empty = block.lengths == 0
        return pa.Table.from_arrays([docs.field("_key"), pa.array(block.lengths), *[
            pa.array(x, pa.float64(), mask=empty) for x in (near, far, near - far)]], schema=schema)
    return score


def score_against_target(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion",
                         is_target: str = "validada", targets: DataFrame | None = None) -> DataFrame:
    """Mean loss per word of every incident's `descripcion` under a model of the validated ones and one of all.

    `score` is target loss minus background loss: the lower, the more a text is like the target. Both are word-pair
    models with a count for every word and pair of words of the corpus, known by its share of the hashes and 40 further
    bits, so the model grows with the corpus. They are matched: one vocabulary, one smoothing, and background counts
    scaled to the size of the target, so that a larger background of the same kind changes no score. Texts are stored in blocks; a block sends each of its distinct words and pairs once
    to the share of the hashes it falls into, where all blocks are summed, and gets the sums back in the same order. No
    task holds more than a block or a share, and the driver sees totals only. A text's own words are taken out of a
    model it was counted into, so a target text gains nothing from itself.

    Texts without words have 0 tokens and null losses; a null `is_target` means no; null keys are scored; repeated rows
    count and are scored as often as they come; without target rows both models are even. Other columns are
    ignored; an empty table gives no rows. With `targets` (one column of keys) the rows of these keys are the target and
    no column `is_target` is read: keys and places of rows are joined then, which moves no text.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = records.schema[key].dataType
    marked = F.lit(False) if targets is not None else F.coalesce(F.col(is_target).cast("boolean"), F.lit(False))
    rows = records.select(F.col(key).alias("_key"), marked.alias("_target"), F.col(text).cast("string").alias("_text"))
    with workspace() as keep:
        stored = keep(store_blocks(rows))
        size = stored.agg(F.sum("_bytes")).first()[0] or 0
        if targets is None:
            blocks = stored.select("_block", "_docs", F.lit(None).cast("binary").alias("_marks"))
        else:
            blocks = stored.select("_block", "_docs").join(keep(store_marks(stored, targets)), "_block", "left")
        partial = map_arrow(blocks, _count(max(1, -(-size // SHARE_BYTES))),
                            "_block long, _table int, _share int, n long, hashes binary, target binary, background binary")
        counts = keep(put_aside(partial.groupBy("_table", "_share").applyInArrow(
            lambda t: _sum(t), "_block long, _table int, _share int, target binary, background binary, n long, n_target long, n_background long"),
            "counts"))
        del partial
    totals = {r["_table"]: r for r in counts.filter("_block is null").groupBy("_table").agg(
        F.sum("n").alias("n"), F.sum("n_target").alias("n_target"), F.sum("n_background").alias("n_background")).collect()}
    words = totals.get(WORDS, {"n": 0, "n_target": 0, "n_background": 0})
    schema = T.StructType([T.StructField("_key", kind), T.StructField("n_tokens", T.LongType())] + [
        T.StructField(n, T.DoubleType()) for n in ("target_loss", "background_loss", "score")])
    ship_package(records.sparkSession)
    score = _scorer(words["n_target"], words["n_background"], max(1 << WORD_BITS, words["n"]), to_arrow_type(kind))
    return blocks.groupBy("_block").cogroup(counts.filter("_block is not null").groupBy("_block")).applyInArrow(
        score, schema).withColumnRenamed("_key", key)
