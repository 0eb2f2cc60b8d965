"""Exact top-k search over whole-number series, pruned by segment means and deviations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import bucket_of, put_aside, ship_package

CANDIDATE_BLOCK = 8192  # series a task holds as candidates
QUERY_BLOCK = 2048  # queries a task holds
COARSEST = 4  # segments of the first resolution; each further one doubles them
SLICE = 64  # queries bounded at once


def segment_statistics(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, means and deviations of each row's segments."""
    edges = np.linspace(0, rows.shape[1], segments + 1).astype(int)
    lengths = np.diff(edges)
    used = lengths > 0
    edges, lengths = np.append(edges[:-1][used], rows.shape[1]), lengths[used]
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    means = sums / lengths
    return lengths, means, np.sqrt(np.maximum(squares / lengths - means * means, 0))


def _weighted(stats) -> np.ndarray:
    lengths, means, deviations = stats
    return np.hstack([means, deviations]) * np.sqrt(np.hstack([lengths, lengths]))


def _resolutions(width: int) -> list[int]:
    found, n = [], COARSEST
    while n < width:
        found.append(n)
        n *= 2
    return found or [1]


def _upper(q_stats: np.ndarray, c_stats: np.ndarray, q_norm: np.ndarray, c_norm: np.ndarray) -> np.ndarray:
    """Largest inner product that the segment statistics of each pair allow."""
    # (|q|^2 + |c|^2 - |difference of the weighted statistics|^2) / 2, with the square written out as a product
    return ((q_norm - (q_stats * q_stats).sum(1))[:, None] + (c_norm - (c_stats * c_stats).sum(1))) / 2 + q_stats @ c_stats.T


def search_block(queries: np.ndarray, query_keys: np.ndarray, series: np.ndarray, keys: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, candidate, score) of the k largest inner products of each query, ties to the smaller key.

    With segment lengths l, means m and deviations s, the squared distance is at least the sum of
    l * ((m - m')^2 + (s - s')^2), so the inner product is at most (|q|^2 + |c|^2 - that) / 2. The coarsest resolution
    bounds all pairs of a slice of queries; the k best bounds are scored exactly and give each query's first limit.
    Finer resolutions then thin out the pairs whose bound reaches the limit, over the candidates that any query of the
    slice has left, and the survivors are scored exactly in whole numbers.
    """
    levels = _resolutions(series.shape[1])
    q, c = queries.astype(np.float64), series.astype(np.float64)
    q_norm, c_norm = (q * q).sum(1), (c * c).sum(1)
    q_stats, c_stats = ([_weighted(segment_statistics(x, n)) for n in levels] for x in (q, c))
    for lo in range(0, len(q), SLICE):
        at = slice(lo, min(lo + SLICE, len(q)))
        slack = (0.5 + 1e-9 * (q_norm[at] + c_norm.max()))[:, None]  # scores are whole numbers; room for rounding
        open_pairs = query_keys[at][:, None] != keys[None, :]
        bounds = np.where(open_pairs, _upper(q_stats[0][at], c_stats[0], q_norm[at], c_norm), -np.inf)
        limits = np.full((len(bounds), 1), -np.inf)
        if k < len(keys):
            for i, first in enumerate(np.argpartition(-bounds, k - 1, axis=1)[:, :k]):
                first = first[open_pairs[i, first]]
                if len(first) == k:
                    limits[i] = (series[first] @ queries[lo + i]).min()
        open_pairs &= bounds + slack >= limits
        columns = np.flatnonzero(open_pairs.any(axis=0))
        open_pairs = open_pairs[:, columns]
        for level in range(1, len(levels)):
            finer = _upper(q_stats[level][at], c_stats[level][columns], q_norm[at], c_norm[columns])
            open_pairs &= finer + slack >= limits
            kept = open_pairs.any(axis=0)
            columns, open_pairs = columns[kept], open_pairs[:, kept]
        for i in range(len(open_pairs)):
            left = columns[open_pairs[i]]
            scores = series[left] @ queries[lo + i]
            order = np.lexsort((keys[left], -scores))[:k]
            yield from zip([query_keys[lo + i]] * len(order), keys[left][order].tolist(), scores[order].tolist())


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _block_search(k: int, key_type: pa.DataType):
    schema = pa.schema([("query", key_type), ("neighbour", key_type), ("score", pa.int64())])

    def search(block: pa.Table) -> pa.Table:
        asks = np.asarray(block.column("_ask").to_pylist(), dtype=bool)
        lists = block.column("_series").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        lengths = np.diff(lists.offsets.to_numpy())
        width = int(lengths.max(initial=0)) or 1
        if len(set(lengths.tolist())) == 1 and lengths[0]:
            matrix = lists.flatten().to_numpy().reshape(len(lists), width)
        else:
            matrix = _matrix(lists.to_pylist(), width)
        raw = block.column("_key").to_pylist()
        keys = np.array(raw) if not raw or isinstance(raw[0], int) else np.array(raw, dtype=object)
        candidates = ~asks
        rows = list(search_block(matrix[asks], keys[asks], matrix[candidates], keys[candidates], k)) if asks.any() and candidates.any() else []
        columns = list(zip(*rows)) or [[], [], []]
        return pa.Table.from_arrays([pa.array([getattr(v, "item", lambda v=v: v)() for v in columns[0]], key_type),
                                     pa.array(columns[1], key_type), pa.array(columns[2], pa.int64())], schema=schema)
    return search


def nearest_series(series: DataFrame, is_query: str = "es_consulta", key: str = "id_ceda_agricultura",
                   values: str = "serie", *, k: int = 20, candidate_block: int = CANDIDATE_BLOCK,
                   query_block: int = QUERY_BLOCK) -> DataFrame:
    """For every centre marked in `is_query`, the k other centres whose daily series have the largest inner product.

    Columns: query, rank, neighbour, score; whole numbers, ties to the smaller key. Candidates and queries are dealt
    into blocks of fixed size by a hash of the key and each pair of blocks is one task, which prunes by segment
    statistics, coarse to fine, before it scores exactly; only k rows per query leave a block.

    Rows whose key or series is null, or whose series holds a null, take no part. Shorter series count as ending in
    zeros. A repeated key is several candidates; rows of the query's own key never match it. An empty table, or one
    without queries, gives no rows. Other columns are ignored. Scores must fit a long.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = series.schema[key].dataType
    rows = series.filter(F.col(key).isNotNull() & F.col(values).isNotNull() & ~F.exists(values, F.isnull)).select(
        F.col(key).alias("_key"), F.col(values).cast("array<bigint>").alias("_series"),
        F.coalesce(F.col(is_query), F.lit(False)).alias("_ask"))
    rows = put_aside(rows, "series")
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("_ask"), 1))).first()
    across, down = max(1, -(-n // candidate_block)), max(1, -(-asked // query_block))
    own = bucket_of(F.col("_key"), 1 << 30)
    asks = rows.filter("_ask").dropDuplicates(["_key", "_series"]).select(
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("_across"), F.pmod(own, F.lit(down)).alias("_down"),
        "_key", "_series", "_ask")
    candidates = rows.select(
        F.pmod(own, F.lit(across)).alias("_across"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("_down"),
        "_key", "_series", F.lit(False).alias("_ask"))
    ship_package(series.sparkSession)
    found = asks.unionByName(candidates).groupBy("_across", "_down").applyInArrow(
        _block_search(k, to_arrow_type(kind)), T.StructType([
            T.StructField("query", kind), T.StructField("neighbour", kind), T.StructField("score", T.LongType())]))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "neighbour")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query", "rank", "neighbour", "score")
