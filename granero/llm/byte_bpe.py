"""Byte-level BPE: texts to token ids and back, with recursive queries of an in-process SQL engine per partition."""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow

WORDS_AT_ONCE = 40_000  # distinct words one recursive query contracts
REMEMBERED = 1_200_000  # encoded words a worker keeps between batches and tasks; some 250 MB
TEXT_AT_ONCE = 2 << 20  # characters encoded and decoded together; a longer text goes alone
STATE_ROWS = 8_000_000  # rows one recursive query may pile up; a longer contraction goes on in another query
PLACE_BITS = 22  # a word has at most 2**22 bytes
LENGTH_BITS = 10  # a token has fewer than 2**10 bytes
SQL_MEMORY = "300MB"

# Every step contracts, in each word that is not finished, the leftmost of its pairs of least rank. A row is a token:
# its word and first byte in one number (lo), the byte after it likewise (hi), its id. A merged token's id is its rank.
# A pair is one number too: rank, first byte, bytes of its first token, bytes of both; the least one is the pair to take.
_WORD, _PLACE, _LENGTH = f">> {PLACE_BITS}", f"& {(1 << PLACE_BITS) - 1}", f"& {(1 << LENGTH_BITS) - 1}"
CONTRACT = f"""
WITH RECURSIVE state(lo, hi, token, step, done) AS (
    SELECT lo, hi, token, 0, false FROM letters
    UNION ALL
    (WITH best AS (
        SELECT a.lo {_WORD} AS word, min((m.merged::BIGINT << {PLACE_BITS + 2 * LENGTH_BITS}) | ((a.lo {_PLACE}) << {2 * LENGTH_BITS})
            | ((b.lo - a.lo) << {LENGTH_BITS}) | (b.hi - a.lo)) AS pair
        FROM state a JOIN state b ON a.hi = b.lo JOIN merges m ON m.first = a.token AND m.second = b.token
        WHERE NOT a.done AND NOT b.done GROUP BY 1),
    taken AS (
        SELECT word, (word << {PLACE_BITS}) | ((pair >> {2 * LENGTH_BITS}) {_PLACE}) AS start, (pair >> {LENGTH_BITS}) {_LENGTH} AS head,
            pair {_LENGTH} AS size, (pair >> {PLACE_BITS + 2 * LENGTH_BITS})::INTEGER AS merged FROM best)
    SELECT lo, CASE WHEN lo = start THEN start + size ELSE hi END, CASE WHEN lo = start THEN merged ELSE token END, step + 1, word IS NULL
    FROM state LEFT JOIN taken ON word = lo {_WORD}
    WHERE NOT done AND step < {{steps}} AND (word IS NULL OR lo <> start + head))
)
SELECT lo, hi, token, done FROM state WHERE done OR step = {{steps}}
"""
DECODE = """
SELECT doc, string_agg(bytes, '' ORDER BY place) AS decoded
FROM tokens JOIN vocabulary ON id = token GROUP BY doc
"""


class Codec:
    """Rank file of a byte-level vocabulary as tables of an in-process database, and the words encoded so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        if max(map(len, self.ranks)) >= 1 << LENGTH_BITS:
            raise ValueError(f"a token has {max(map(len, self.ranks))} bytes")
        self.find = regex.compile(pattern).findall
        self.letter = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t))
                  if t[:i] in self.ranks and t[i:] in self.ranks]
        first, second, merged = (pa.array(c, pa.int32()) for c in zip(*merges))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": SQL_MEMORY, "temp_directory": tempfile.gettempdir()})
        self._table("merges", {"first": first, "second": second, "merged": merged})
        # one letter per byte, so that text holds any bytes
        self._table("vocabulary", {"id": pa.array(list(self.ranks.values()), pa.int32()),
                                   "bytes": [t.decode("latin-1") for t in self.ranks]})
        self.forget()

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("_given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _given")
        self.db.unregister("_given")

    def forget(self) -> None:
        """Empty the memory of words: `place` of a word, and its ids from `start[place]` to `start[place + 1]`."""
        self.place: dict[str, int] = {}
        self.start, self.ids = [np.zeros(1, np.int64)], []
        self.n_ids = 0

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids one after the other."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        begin = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(begin, lengths)
        at = (word << PLACE_BITS) | place
        token = self.letter[np.frombuffer(b"".join(words), np.uint8)]
        letters, parts = pa.table({"lo": at, "hi": at + 1, "token": token}), []
        while letters.num_rows:
            self.db.register("letters", letters)
            found = self.db.sql(CONTRACT.format(steps=max(4, STATE_ROWS // letters.num_rows))).to_arrow_table()
            self.db.unregister("letters")
            done = found.column("done")
            parts.append(found.filter(done).select(["lo", "token"]))
            letters = found.filter(pc.invert(done)).select(["lo", "hi", "token"])
        at, token = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("lo", "token"))
        order = np.argsort(at)
        return np.bincount(at >> PLACE_BITS, minlength=len(words)), token[order]

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered; one that is a token as a whole stays whole."""
        for lo in range(0, len(words), WORDS_AT_ONCE):
            raw = [w.encode("utf-8", "surrogatepass") for w in words[lo:lo + WORDS_AT_ONCE]]
            if max(map(len, raw)) >> PLACE_BITS:
                raise ValueError(f"a word of {max(map(len, raw))} bytes without a break")
            whole = [self.ranks.get(w) for w in raw]
            parts = [i for i, r in enumerate(whole) if r is None]
            counts, tokens = self._contract([raw[i] for i in parts]) if parts else (np.zeros(0, int), np.zeros(0, np.int32))
            order = [*(i for i, r in enumerate(whole) if r is not None), *parts]
            n_whole = len(raw) - len(parts)
            counts = np.concatenate([np.ones(n_whole, np.int64), counts])
            self.ids.append(np.concatenate([np.array([r for r in whole if r is not None], np.uint32), tokens.astype(np.uint32)]))
            base = len(self.place)
            for k, i in enumerate(order):
                self.place[words[lo + i]] = base + k
            self.start.append(self.n_ids + np.cumsum(counts))
            self.n_ids += int(counts.sum())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.place) > REMEMBERED:
            self.forget()
        found = [self.find(t) for t in texts]
        new = set().union(*map(set, found)) - self.place.keys() if found else set()
        if new:
            self.learn(list(new))
            self.start, self.ids = [np.concatenate(self.start)], [np.concatenate(self.ids)]
        start, ids = self.start[0], self.ids[0] if self.ids else np.zeros(0, np.uint32)
        out = []
        for words in found:
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            lengths = start[at + 1] - start[at]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            out.append(ids[np.arange(total) + np.repeat(start[at] - (ends - lengths), lengths)])
        return out

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """Bytes of every list of ids."""
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return [b""] * len(texts)
        tokens = pa.table({"doc": np.repeat(np.arange(len(texts), dtype=np.int32), sizes),
                           "place": np.arange(sizes.sum(), dtype=np.int64), "token": np.concatenate(texts).astype(np.int32)})
        self.db.register("tokens", tokens)
        found = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * len(texts)
        for doc, text in zip(found.column("doc").to_pylist(), found.column("decoded")):
            out[doc] = text.as_py().encode("latin-1")
        return out


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _blocks(keys: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    size, lo = 0, 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > TEXT_AT_ONCE:
            yield keys[lo:i], texts[lo:i]
            size, lo = 0, i
        size += len(text)
    if texts:
        yield keys[lo:], texts[lo:]


def _round_trip(path: str, pattern: str, key_type: pa.DataType, with_ids: bool):
    schema = pa.schema([("_key", key_type), ("ids", pa.list_(pa.int64())), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            for keys, texts in _blocks(batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]):
                ids = coder.encode(texts)
                decoded = coder.decode(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, key_type), pa.array([t.tolist() if with_ids else None for t in ids], pa.list_(pa.int64())),
                    pa.array([len(t) for t in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.astype("<u4").tobytes()).hexdigest() for t in ids]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded])], schema=schema)
    return run


def encode_and_decode(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion", *,
                      ranks: str | None = None, pattern: str = public_tokenizers.PATTERN, with_ids: bool = True) -> DataFrame:
    """Token ids of every incident's `descripcion`, and digests of the ids and of the bytes decoded from them.

    Columns: key, ids (null without `with_ids`), n_tokens, ids_sha256 (ids as little-endian 32-bit numbers),
    decoded_sha256. Each match of `pattern` is encoded by itself: byte rows join the merge table and the leftmost pair
    of least rank is contracted, word by word at once, until none is left; decoding joins the vocabulary and aggregates
    in order. A map-only step; a worker holds one block of texts and a bounded memory of encoded words.

    A null text is empty: no ids. Null keys and repeated rows are kept, other columns ignored; an empty table gives no
    rows. A single word of n bytes takes up to n steps over its rows, in queries that pile up `STATE_ROWS` rows at most; one of
    4 MiB or more without a break raises an error.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = records.schema[key].dataType
    schema = T.StructType([
        T.StructField("_key", kind), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    source = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return map_arrow(source, _round_trip(path, pattern, to_arrow_type(kind), with_ids), schema).withColumnRenamed("_key", key)
