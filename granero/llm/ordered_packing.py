"""Order-preserving packing: where to cut the stream of records into windows, by dynamic programming."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow
from granero.llm.tokens import ids_of, sentence_ends

CAPACITY = 1024
END = 0  # id that closes every record
SENTENCE_PENALTY = 4  # padding that a cut between two sentences of a record is worth
CUT_PENALTY = 16  # and one inside a sentence
SEGMENT = 1 << 20  # ids that are cut at a time; what their last window holds goes to the next ones
ROWS_OUT = 50_000  # rows a task hands over at once
PER_WINDOW = 1000  # costs are in thousandths, so that among equal ones fewer windows win

RECORD_END, SENTENCE_END = 2, 1  # marks of a place; 0 is inside a sentence


def candidate_cuts(marks: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end (after so many ids) and their marks, place 0 first and the last id's end last.

    These are all ends of records and sentences; inside sentences, the places one whole window after one of them, and
    further ones while no end is in reach.
    """
    ends = np.flatnonzero(marks) + 1
    total = len(marks)
    ends = np.union1d(ends, [0, total])
    inside = [ends + capacity]
    for at in np.flatnonzero(np.diff(ends) > 2 * capacity):
        inside.append(np.arange(ends[at] + 2 * capacity, ends[at + 1], capacity))
    inside = np.setdiff1d(np.concatenate(inside), ends)
    places = np.union1d(ends, inside[inside < total])
    kinds = np.zeros(len(places), np.int64)
    kinds[1:] = marks[places[1:] - 1]
    return places, kinds


def _exact_lengths(places: np.ndarray, kinds: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a power of two ids between two places, by their end: (first of each place's, starts)."""
    ends, starts = [], []
    for size in sorted({1 << k for k in range(capacity.bit_length())} | {capacity}):
        upto = np.arange(len(places)) if size == capacity else np.flatnonzero(kinds)  # inside a sentence only a full window ends
        at = np.searchsorted(places, places[upto] - size)
        hit = places[np.minimum(at, len(places) - 1)] == places[upto] - size
        ends.append(upto[hit])
        starts.append(at[hit])
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    return np.searchsorted(ends[order], np.arange(len(places) + 1)), starts[order]


def best_cuts(marks: np.ndarray, capacity: int = CAPACITY, sentence_penalty: int = SENTENCE_PENALTY,
              cut_penalty: int = CUT_PENALTY) -> np.ndarray:
    """Ends of the windows of a stream of ids with the least padding plus penalties for the records they cut.

    A window of n ids, at most `capacity`, is padded to `capacity` unless n is a power of two. The least cost of a place
    is the least over the starts within `capacity` before it of their cost plus the padding, capacity - (place - start):
    a monotone queue keeps the starts that may still be best by cost plus start. Windows of a power of two are few per
    place and compared with that. Inside a sentence only a full window ends; the last place ends one in any case.
    """
    places, kinds = candidate_cuts(marks, capacity)
    first, starts = (x.tolist() for x in _exact_lengths(places, kinds, capacity))
    fees = (np.array([cut_penalty, sentence_penalty, 0]) * PER_WINDOW + 1)[kinds].tolist()
    anywhere = (kinds > 0).tolist()
    fees[-1], anywhere[-1] = 1, True
    at, worth = places.tolist(), (places * PER_WINDOW).tolist()
    n, room, far = len(at), capacity * PER_WINDOW, 1 << 62
    cost, key, back = [0] * n, [0] * n, [0] * n  # of each place: its cost, cost plus place, start of its window
    queue, head = [0], 0  # places that may still be best starts, least key first; those before `head` are out of reach
    for j in range(1, n):
        least = far
        if anywhere[j]:
            reach = at[j] - capacity
            while at[queue[head]] < reach:
                head += 1
            start = queue[head]
            least = key[start] + room - worth[j]
        for i in starts[first[j]:first[j + 1]]:
            if cost[i] < least:
                least, start = cost[i], i
        cost[j] = least = least + fees[j]
        back[j] = start
        key[j] = mine = least + worth[j]
        while len(queue) > head and key[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    path, j = [], n - 1
    while j:
        path.append(at[j])
        j = back[j]
    return np.array(path[::-1], np.int64)


class _Stream:
    """Ids of records one after the other; whole windows leave it."""

    def __init__(self, capacity: int, sentence_penalty: int, cut_penalty: int):
        self.shape = (capacity, sentence_penalty, cut_penalty)
        self.ids, self.marks, self.records, self.held = [], [], [], 0  # records: (key, ids before, ids of the record, length held)

    def add(self, key, ids: np.ndarray, marks: np.ndarray, before: int, whole: int) -> None:
        self.ids.append(ids)
        self.marks.append(marks)
        self.records.append((key, before, whole, len(ids)))
        self.held += len(ids)

    def windows(self, last: bool) -> Iterator[tuple]:
        """Pieces (key, start, length, crc, record's ids, window, offset) of all windows, but of the last one only at the end."""
        ids, marks = np.concatenate(self.ids), np.concatenate(self.marks)
        cuts = best_cuts(marks, *self.shape)
        if not last:
            cuts = cuts[:-1]
        upto = int(cuts[-1]) if len(cuts) else 0
        ends = np.cumsum([r[3] for r in self.records])
        edges = np.union1d(cuts, ends[ends < upto])
        begins = np.concatenate([[0], edges[:-1]])
        owner, window = np.searchsorted(ends, begins, side="right"), np.searchsorted(cuts, begins, side="right")
        opened = np.concatenate([[0], cuts])[window]
        raw = memoryview(ids).cast("B")
        for lo, hi, r, w, at in zip(begins.tolist(), edges.tolist(), owner.tolist(), window.tolist(), opened.tolist()):
            key, before, whole, held = self.records[r]
            yield key, before + lo - int(ends[r]) + held, hi - lo, zlib.crc32(raw[4 * lo:4 * hi]), whole, w, lo - at
        self.count = len(cuts)
        keep = int(np.searchsorted(ends, upto, side="right"))
        rest = self.records[keep:]
        if rest:
            key, before, whole, held = rest[0]
            gone = upto - (int(ends[keep]) - held)
            rest[0] = (key, before + gone, whole, held - gone)
        self.ids, self.marks, self.records, self.held = [ids[upto:]], [marks[upto:]], rest, len(ids) - upto


def _packer(path: str, key_type: pa.DataType, capacity: int, sentence_penalty: int, cut_penalty: int, segment: int):
    schema = pa.schema([("_key", key_type), *[(n, pa.int64()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(segment, 4 * capacity)
        stream, base, rows = _Stream(capacity, sentence_penalty, cut_penalty), TaskContext.get().partitionId() << 33, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def leave(last: bool) -> None:
            nonlocal base
            rows.extend((*piece[:5], base + piece[5], piece[6]) for piece in stream.windows(last))
            base += stream.count

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                ids = ids_of(text.as_py(), path)
                marks = np.append(sentence_ends(ids, path).astype(np.int8) * SENTENCE_END, RECORD_END).astype(np.int8)
                ids = np.append(ids, END).astype("<u4")
                for at in range(0, len(ids), step):
                    stream.add(key.as_py(), ids[at:at + step], marks[at:at + step], at, len(ids))
                    if stream.held >= step:
                        leave(False)
                if len(rows) >= ROWS_OUT:
                    yield out()
        if stream.held:
            leave(True)
        if rows:
            yield out()
    return pack


def pack_in_order(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion", *,
                  tokenizer: str | None = None, capacity: int = CAPACITY, sentence_penalty: int = SENTENCE_PENALTY,
                  cut_penalty: int = CUT_PENALTY, segment: int = SEGMENT) -> DataFrame:
    """Pieces of the incidents' tokenised `descripcion` in windows that keep the order of the records.

    Columns: key, start (ids of the record before the piece), length, ids_crc32, doc_tokens (ids of the record with the
    closing one), sequence_id, offset. Each task cuts the stream of its own records (Spark's input partitions), so nothing
    is shuffled and a lost executor costs its tasks alone; a task ends with one window that may be short. Cuts are the best
    ones by `best_cuts` for `segment` ids at a time: the last window is taken back and joined to the next ids, so memory is
    bounded by a segment and the longest record, and no window is short for the segments' sake.

    A null or empty text has the closing id alone. Null keys and repeated rows are packed like all others; other columns
    are ignored; an empty table gives no rows; a record of any length is cut into as many windows as it needs. With a
    `capacity` that is no power of two, a full window still needs no padding.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = records.schema[key].dataType
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    schema = T.StructType([T.StructField("_key", kind)] + [T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    rows = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return map_arrow(rows, _packer(path, to_arrow_type(kind), capacity, sentence_penalty, cut_penalty, segment), schema).withColumnRenamed(
        "_key", key)
