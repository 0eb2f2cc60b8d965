"""Best-fit packing of token pieces into sequences of a fixed length, by bin completion over the size histogram."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow, put_aside
from granero.llm.tokens import ids_of

CAPACITY = 1024
END = 2  # id that closes every document
NODE_LIMIT = 4_000  # search nodes of one plan; beyond them the best plan found stands
FILLINGS = 4  # fillings tried per bin
ROWS_OUT = 50_000  # rows a task hands over at once

Filling = tuple[int, ...]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones, after a shorter first one if n is no multiple."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def _pieces(path: str, capacity: int, key_type: pa.DataType):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        schema = pa.schema([("_key", key_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids_crc32", pa.int64()), ("_part", pa.int32()), ("_place", pa.int64())])
        keys, rows = [], []

        def batch_out():
            out = pa.RecordBatch.from_arrays([pa.array(keys, key_type), *[
                pa.array(c, t.type) for c, t in zip(zip(*rows), list(schema)[1:])]], schema=schema)
            keys.clear()
            rows.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(ids_of(text.as_py(), path), END).astype("<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    keys.append(key.as_py())
                    rows.append((i, start, length, crc, part, seen[length]))
                    seen[length] += 1
                if len(rows) >= ROWS_OUT:
                    yield batch_out()
        if rows:
            yield batch_out()
    return tokenise


def token_pieces(records: DataFrame, path: str, key: str, text: str, capacity: int) -> DataFrame:
    """Pieces with their task (`_part`) and their place among the task's pieces of that length (`_place`). Map-only."""
    kind = records.schema[key].dataType
    source = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField("_key", kind), T.StructField("piece", T.IntegerType())] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")] + [
            T.StructField("_part", T.IntegerType()), T.StructField("_place", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type

    return map_arrow(source, _pieces(path, capacity, to_arrow_type(kind)), schema)


def best_fit(histogram: Mapping[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on counts: equal bins are filled together. The first incumbent of the search."""
    rooms: dict[int, list[list]] = defaultdict(list)  # room left -> [filling, bins]
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            room = min((r for r in rooms if r >= size and rooms[r]), default=None)
            if room is None:
                each = capacity // size
                full, rest = divmod(left, each)
                for n, bins in ((each, full), (rest, 1)):
                    if n and bins:
                        rooms[capacity - n * size].append([(size,) * n, bins])
                left = 0
            else:
                filling, bins = rooms[room].pop()
                used = min(bins, left)
                if used < bins:
                    rooms[room].append([filling, bins - used])
                rooms[room - size].append([(*filling, size), used])
                left -= used
    return [(f, n) for groups in rooms.values() for f, n in groups if n]


def _fillings(counts: list[int], room: int) -> list[Filling]:
    """Undominated fillings of `room`, least waste first, at most `FILLINGS`.

    An item that fills the room alone dominates all others, and a filling that leaves room for another item is dominated
    by the one that takes it. The sums that the sizes from each place on can reach are bit sets, so the walk, larger
    items first, only enters branches that end in a filling of the waste looked for.
    """
    if counts[room]:
        return [(room,)]
    sizes = [s for s in range(min(room, len(counts) - 1), 0, -1) if counts[s]]
    if not sizes:
        return [()]
    mask = (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)  # reach[j]: bit n is set if sizes[j:] can add up to n
    for j in range(len(sizes) - 1, -1, -1):
        sums, step = reach[j + 1], sizes[j]
        copies, part = min(counts[step], room // step), 1
        while copies:  # doubling shifts add 1, 2, 4, ... copies
            part = min(part, copies)
            sums |= sums << (step * part)
            copies -= part
            part *= 2
        reach[j] = sums & mask
    found: list[Filling] = []
    smallest = sizes[-1]
    for waste in range(room + 1):
        if not reach[0] >> (room - waste) & 1:
            continue
        stack = [(0, room - waste, ())]
        while stack and len(found) < FILLINGS:
            j, left, chosen = stack.pop()
            if not left:
                if waste < smallest or not any(s <= waste and chosen.count(s) < counts[s] for s in sizes):
                    found.append(chosen)
                continue
            while j < len(sizes) and sizes[j] > left:
                j += 1
            if j == len(sizes) or not reach[j] >> left & 1:
                continue
            size = sizes[j]
            stack.append((j + 1, left, chosen))
            if chosen.count(size) < counts[size]:
                stack.append((j, left - size, (*chosen, size)))
        if len(found) >= FILLINGS or waste >= smallest and found:
            break
    return found


def pack_histogram(histogram: Mapping[int, int], capacity: int = CAPACITY,
                   node_limit: int = NODE_LIMIT) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences take each; few sequences, and at most one new filling per search level.

    Bin completion: the largest item left gets each of its undominated fillings in turn, used as often as the counts
    allow (then half as often, down to once). A branch ends when its waste rules out a better plan than the incumbent;
    the search ends when a plan meets the bound by total size, or after `node_limit` nodes. The input has at most
    `capacity` entries whatever the corpus, so this runs anywhere.
    """
    sizes = {s: n for s, n in histogram.items() if n and s < capacity}
    whole = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    if not sizes:
        return whole
    total = sum(s * n for s, n in sizes.items())
    halves = sum(n for s, n in sizes.items() if 2 * s > capacity)
    bound = max(-(-total // capacity), halves)
    best = best_fit(sizes, capacity)
    best_bins = sum(n for _, n in best)
    counts = [sizes.get(s, 0) for s in range(capacity + 1)]

    def children(counts, plan, bins, waste) -> Iterator[tuple]:
        largest = max((s for s in range(len(counts) - 1, 0, -1) if counts[s]), default=0)
        counts = counts[:largest + 1]
        counts[largest] -= 1
        options = _fillings(counts + [0] * max(0, capacity - largest - len(counts) + 1), capacity - largest)
        counts[largest] += 1
        for filling in options:
            need = Counter((largest, *filling))
            times = min(counts[s] // k for s, k in need.items())
            spare = capacity - largest - sum(filling)
            while times:
                left = counts.copy()
                for s, k in need.items():
                    left[s] -= k * times
                yield left, (plan, (largest, *filling), times), bins + times, waste + times * spare
                times //= 2

    nodes, stack = 0, [children(counts, None, 0, 0)]
    while stack and nodes < node_limit and best_bins > bound:
        state = next(stack[-1], None)
        if state is None:
            stack.pop()
            continue
        nodes += 1
        left, plan, bins, waste = state
        if waste > (best_bins - 1) * capacity - total:
            continue
        if any(left):
            stack.append(children(*state))
        elif bins < best_bins:
            best_bins, best = bins, []
            while plan:
                plan, filling, times = plan
                best.append((filling, times))
            best.reverse()
    return whole + best


def _slots(plan: list[tuple[Filling, int]]) -> list[np.ndarray]:
    """For each slot of the plan: its size, the first of the pieces of that size it takes, first sequence, offset."""
    taken, rows, base = Counter(), [], 0
    for filling, times in plan:
        at = 0
        for size in filling:
            rows.append((size, taken[size], base, at))
            taken[size] += times
            at += size
        base += times
    rows.sort()
    return [np.array(c, dtype=np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4


def _placer(slots: list[np.ndarray]):
    sizes, firsts, bases, offsets = slots
    order = (sizes << 48) + firsts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(order, (length.astype(np.int64) << 48) + rank, side="right") - 1
            out = batch.select(["_key", "piece", "start", "length", "ids_crc32"]).columns
            yield pa.RecordBatch.from_arrays([*out, pa.array(bases[at] + rank - firsts[at]), pa.array(offsets[at])], [
                "_key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


def pack_texts(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion", *,
               tokenizer: str | None = None, capacity: int = CAPACITY, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Pieces of the incidents' tokenised `descripcion`, each with its sequence and its place there.

    Texts are tokenised once, in place; the shuffled rows hold six numbers each. What is packed is the histogram of
    piece lengths (at most `capacity` counts); pieces of one length are interchangeable, so each gets a rank (its place
    in its task plus those of the tasks before) and the rank decides the slot. No length is gathered in one task.

    Ids are those of the `tokenizers` library with the file as loaded: its added tokens are found in a text first.

    A null text is empty: one piece with the closing id alone. Null keys and repeated rows are packed like all others;
    other columns are ignored; an empty table gives no rows. Very long texts are cut, the first piece being shorter.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = put_aside(token_pieces(records, path, key, text, capacity), "pieces")
    sizes = put_aside(pieces.groupBy("_part", "length").agg(F.count("*").alias("_n")), "piece-sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = _slots(pack_histogram(histogram, capacity, node_limit))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(put_aside(offsets, "piece-offsets"), ["_part", "length"]).select(
        "_key", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_place")).alias("_rank"))
    schema = T.StructType([T.StructField("_key", records.schema[key].dataType), T.StructField("piece", T.IntegerType())] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")])
    return map_arrow(ranked, _placer(slots), schema).withColumnRenamed("_key", key)
