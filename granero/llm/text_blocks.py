"""Texts stored once in compressed blocks, whose rows are marked by key where they lie, so that no join moves a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow, put_aside, ship_package

BLOCK_BYTES = 8 << 20  # text of a block
ROWS_AT_ONCE = 1024  # marked rows handed on together


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up: the planes of their bytes, each compressed unless that makes it longer, without the empty ones."""
    used = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:used])
    parts = []
    for plane in planes:
        raw = plane.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True)
        parts.append(small if len(small) < len(raw) else raw)
    return np.array([used, *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def expand(packed: bytes, n: int) -> np.ndarray:
    """The n numbers of `squeeze`."""
    out = np.zeros((8, n), np.uint8)
    used = int(np.frombuffer(packed, "<u4", 1)[0])
    at = 4 * (used + 1)
    for plane, size in zip(out, np.frombuffer(packed, "<u4", used, 4).tolist()):
        part = packed[at:at + size]
        plane[:] = np.frombuffer(part if size == n else pa.decompress(part, n, "zstd", asbytes=True), np.uint8)
        at += size
    return np.ascontiguousarray(out.T).view("<u8").reshape(n)


def _pack(rows: pa.StructArray) -> bytes:
    """Rows of a block as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_struct_array(rows)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(packed: pa.Scalar) -> pa.StructArray:
    return pa.ipc.open_stream(packed.as_buffer()).read_next_batch().to_struct_array()


def marks_of(marks: pa.Scalar, n: int) -> np.ndarray:
    """Which of a block's n rows are marked."""
    out = np.zeros(n, bool)
    if marks.is_valid:
        bits = np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), bitorder="little")[:n]
        out[:len(bits)] = bits
    return out


def _blocks(docs: pa.DataType):
    key = docs[0].type
    schema = pa.schema([("_block", pa.int64()), ("_bytes", pa.int64()), ("_keys", pa.list_(key)), ("_docs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size, n = TaskContext.get().partitionId() << 32, [], 0, 0

        def block() -> pa.RecordBatch:
            rows = pa.concat_arrays(held)
            keys = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.field(0))
            return pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), pa.array([size], pa.int64()), keys, pa.array(
                [_pack(rows)], pa.binary())], schema=schema)

        for batch in batches:
            rows = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, docs)], fields=list(docs))
            lengths = np.array([len(t.as_py() or "") + 16 for t in batch.columns[-1]], np.int64)
            begin = 0
            for i, more in enumerate(lengths.tolist()):
                size += more
                if size >= BLOCK_BYTES:
                    held.append(rows[begin:i + 1])
                    yield block()
                    held, size, n, begin = [], 0, n + 1, i + 1
            if begin < len(rows):
                held.append(rows[begin:])
        if held:
            yield block()
    return run


def store_blocks(rows: DataFrame) -> DataFrame:
    """Rows (key first, text last) in stored blocks: `_block`, `_bytes` of text, `_keys` in the order of the rows, `_docs`."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = pa.struct([(f.name, to_arrow_type(f.dataType)) for f in rows.schema])
    return put_aside(map_arrow(rows, _blocks(docs), T.StructType([
        T.StructField("_block", T.LongType()), T.StructField("_bytes", T.LongType()),
        T.StructField("_keys", T.ArrayType(rows.schema[0].dataType)), T.StructField("_docs", T.BinaryType())])), "blocks")


def _bits(group: pa.Table) -> pa.Table:
    at = group.column("_at").to_numpy()
    marks = np.zeros(int(at.max()) + 1, bool)
    marks[at] = True
    return pa.table({"_block": group.column("_block").slice(0, 1), "_marks": pa.array(
        [np.packbits(marks, bitorder="little").tobytes()], pa.binary())})


def store_marks(blocks: DataFrame, keys: DataFrame) -> DataFrame:
    """`_marks` of the blocks with a row whose key is in `keys` (one column): a bit for every row, stored.

    Keys and places travel, a text does not. The marks are small, so Spark as a rule sends them to the blocks.
    """
    places = blocks.select("_block", F.posexplode("_keys").alias("_at", "_k")).join(keys.toDF("_k"), "_k", "left_semi")
    ship_package(blocks.sparkSession)
    return put_aside(places.select("_block", "_at").groupBy("_block").applyInArrow(lambda t: _bits(t), "_block long, _marks binary"), "marks")


def marked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marked rows of blocks (`_docs`, `_marks`), some at a time."""
    for batch in batches:
        for packed, marks in zip(batch.column(0), batch.column(1)):
            docs = unpack(packed)
            chosen = np.flatnonzero(marks_of(marks, len(docs)))
            for at in range(0, len(chosen), ROWS_AT_ONCE):
                yield pa.RecordBatch.from_struct_array(docs.take(pa.array(chosen[at:at + ROWS_AT_ONCE])))
