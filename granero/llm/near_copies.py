"""N-gram Jaccard join by T-occurrence search: groups of records whose shingle sets nearly agree."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import WORD, bucket_of, map_arrow, put_aside, release, ship_package, workspace
from granero.llm.components import components
from granero.llm.text_blocks import marked_rows, store_blocks, store_marks

SHINGLE = 4
PERCENT = 85  # links: 100 * intersection >= PERCENT * union
SPARE = 5  # percent of a set looked at beyond the shortest prefix, see `shared_enough`
GROUP_ROWS = 512  # sets a task joins with each other
SHORT = 64  # longest list the heap merges; longer ones are probed
PROBES = 32  # long lists probed between two looks at which candidates can still make it
MEMORY = 1 << 19  # word hashes a task remembers
MIX, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})  # A-Z only


def shingles(text: str | None, memory: dict[str, int], k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of k words; a shorter text is one shingle, one without words none."""
    words = WORD.findall((text or "").translate(CAPITALS))
    if not words:
        return np.zeros(0, np.uint64)
    if len(memory) > MEMORY:
        memory.clear()
    own = np.fromiter((memory[w] if w in memory else memory.setdefault(w, xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")))
                       for w in words), np.uint64, len(words))
    run = min(k, len(words))
    n = len(words) - run + 1
    out = np.full(n, run, np.uint64)
    for j in range(run):
        out = (out ^ own[j:j + n]) * MIX
        out ^= out >> FOLD
    return np.unique(out)


def required(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of n with any set it links to."""
    return -(-percent * n // 100)


def prefix_size(n: int, spare: int, percent: int = PERCENT) -> int:
    return min(n, n - required(n, percent) + 1 + spare)


def spare_of(n: int) -> int:
    return n * SPARE // 100


def _as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _prefixes(key_type: pa.DataType, k: int, percent: int):
    schema = pa.schema([("_key", key_type), ("n", pa.int64()), ("digest", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = shingles(text.as_py(), memory, k)
                n = len(found)
                rows.append((n, _digest(found), _as_signed(found[:prefix_size(n, spare_of(n), percent)]) if n else []))
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]],
                                             schema=schema)
    return run


def _digest(found: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None


def _sets(key_type: pa.DataType, k: int, by_class: bool = False):
    schema = pa.schema([("rep", pa.int64() if by_class else key_type), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        for batch in marked_rows(batches):
            found = [_as_signed(shingles(t.as_py(), memory, k)) for t in batch.column(1)]
            reps = pa.array([_digest(f) for f in found], pa.int64()) if by_class else batch.column(0)
            yield pa.RecordBatch.from_arrays([reps, pa.array([len(f) for f in found], pa.int64()),
                                              pa.array(found, pa.list_(pa.int64()))], schema=schema)
    return run


def _stored_sets(rows: DataFrame, keys: DataFrame, k: int, by_class: bool = False) -> DataFrame:
    """Sets of the rows (`_key`, `_text`) with one of these keys. The texts stay where they lie; their marks come to them."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["_key"].dataType
    blocks = store_blocks(rows)
    marks = store_marks(blocks, keys)
    sets = put_aside(map_arrow(blocks.select("_block", "_docs").join(marks, "_block").select("_docs", "_marks"),
                               _sets(to_arrow_type(kind), k, by_class), T.StructType([
        T.StructField("rep", T.LongType() if by_class else kind), T.StructField("n", T.LongType()),
        T.StructField("shingles", T.ArrayType(T.LongType()))])), "sets")
    release(blocks, marks)
    return sets


def _can_link(prefixes: DataFrame, percent: int) -> DataFrame:
    """Classes (`digest`, `rep`, `n`) that may have a link: enough of their prefix occurs in another class's prefix.

    Two linked sets agree in required(n) shingles, so of the prefix_size(n, spare) least hashes of each at least
    1 + spare lie in the other: the least common ones. With the smallest partner allowed, required(n), that is
    1 + spare_of(required(n)). Every hash is grouped by its least and greatest class, combined before the shuffle; where
    they agree it belongs to one class only. No list of a hash's records is built, so frequent passages cost nothing.
    """
    classes = prefixes.filter("n > 0").groupBy("digest").agg(F.min("_key").alias("rep"), F.min("n").alias("n"))
    hashes = prefixes.filter("n > 0").select("digest", F.explode("prefix").alias("hash"))
    singles = hashes.groupBy("hash").agg(F.min("digest").alias("digest"), F.max("digest").alias("other")).filter(
        "digest = other").groupBy("digest").agg(F.count("*").alias("singles"))
    n = F.col("n")
    least = F.ceil(n * percent / 100)
    prefix = F.least(n, n - least + 1 + F.floor(n * SPARE / 100))
    shared = prefix - F.coalesce("singles", F.lit(0))
    return classes.join(singles, "digest", "left").filter(shared >= 1 + F.floor(least * SPARE / 100)).select("digest", "rep", "n")


def _rare_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (rep, hash): of each set the prefix by frequency, rarest first, less the hashes no other set has."""
    each = sets.select("rep", "n", F.explode("shingles").alias("hash"))
    common = put_aside(each.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1"), "common")
    held = each.join(common, "hash").groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "hash"))).alias("held"))  # at most the record's own shingles
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("held"))
    return held.filter(room > 0).select("rep", F.explode(F.slice("held", 1, room.cast("int"))).alias("_h")).select("rep", "_h.hash")


class _Labels:
    """Components inside a task; the smaller one takes the other's label."""

    def __init__(self, n: int):
        self.of, self.members = np.arange(n), [[i] for i in range(n)]

    def join(self, a: int, b: int) -> None:
        a, b = self.of[a], self.of[b]
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.of[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []


def divide_skip_links(sizes: np.ndarray, flat: np.ndarray, side: np.ndarray, percent: int = PERCENT,
                      every: bool = False) -> Iterator[tuple[int, int]]:
    """Links among sets (`flat` holds their hashes one set after the other, smaller sets first): those that join components, or `every` one.

    For each set x in turn, over the inverted lists of the sets before it: a partner is in at least T = required(|x|)
    of the k lists that are not empty. The lists are divided by length. The k - T + 1 shortest must hold every partner:
    short ones are merged on a heap, counting. The T - 1 longest are probed by binary search for the candidates only,
    which drop out as soon as the lists left cannot bring them to their exact overlap. Candidates that already share a
    component with x are not looked at again, unless every link is asked for. With two sides, only pairs across them count.
    """
    n = len(sizes)
    ends = np.cumsum(sizes)
    lists, found = np.unique(flat, return_inverse=True)
    lengths = np.bincount(found, minlength=len(lists))
    order = np.argsort(found, kind="stable")
    owner = np.repeat(np.arange(n), sizes)
    posted, begin = owner[order], np.cumsum(lengths) - lengths
    keys = found[order].astype(np.int64) * n + posted  # sorted by list, then set
    place = np.empty(len(flat), np.int64)
    place[order] = np.arange(len(flat)) - begin[found[order]]
    labels, both = _Labels(n), bool(side.any())
    for x in range(n):
        lo, hi = ends[x] - sizes[x], ends[x]
        before, mine = place[lo:hi], found[lo:hi]
        used = np.flatnonzero(before)
        need_at_least = required(int(sizes[x]), percent)
        if len(used) < need_at_least:
            continue
        used = used[np.argsort(before[used], kind="stable")]
        head, tail = used[:len(used) - need_at_least + 1], used[len(used) - need_at_least + 1:]
        slices = [posted[begin[mine[i]]:begin[mine[i]] + before[i]] for i in head]
        short = [s.tolist() for s in slices if len(s) <= SHORT]
        counts = np.zeros(x, np.int64)
        for y, same in groupby(heapq.merge(*short)):
            counts[y] += sum(1 for _ in same)
        for longer in slices[len(short):]:
            counts[longer] += 1
        candidates = np.flatnonzero(counts)
        fits = 100 * sizes[candidates] >= percent * sizes[x]
        if not every:
            fits &= labels.of[candidates] != labels.of[x]
        if both:
            fits &= side[candidates] != side[x]
        candidates = candidates[fits]
        candidates = candidates[np.argsort(-counts[candidates], kind="stable")]
        for part in (candidates[:8], candidates[8:]):
            left = part if every else part[labels.of[part] != labels.of[x]]
            seen = counts[left]
            wanted = -(-percent * (sizes[left] + sizes[x]) // (100 + percent))
            for at in range(0, len(tail), PROBES):
                able = seen + len(tail) - at >= wanted
                left, seen, wanted = left[able], seen[able], wanted[able]
                if not len(left):
                    break
                probe = mine[tail[at:at + PROBES]].astype(np.int64)[:, None] * n + left[None, :]
                hit = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
                seen = seen + (keys[hit] == probe).sum(axis=0)
            for y in left[seen >= wanted].tolist():
                if every:
                    yield x, y
                elif labels.of[y] != labels.of[x]:
                    labels.join(x, y)
                    yield x, y


def _links_in(rep_type: pa.DataType, percent: int, every: bool):
    def run(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_numpy()
        order = np.argsort(sizes, kind="stable")
        lists = group.column("shingles").combine_chunks()
        lists = lists.take(pa.array(order))
        side, reps = group.column("_side").to_numpy()[order], group.column("rep").take(pa.array(order))
        pairs = list(divide_skip_links(sizes[order].astype(np.int64), lists.flatten().to_numpy(), side, percent, every))
        u, v = (pa.array(c, pa.int64()) for c in zip(*pairs)) if pairs else (pa.array([], pa.int64()),) * 2
        return pa.table({"u": reps.take(u).cast(rep_type), "v": reps.take(v).cast(rep_type)})
    return run


def set_links(sets: DataFrame, group_rows: int = GROUP_ROWS, percent: int = PERCENT, every: bool = False) -> DataFrame:
    """Links (u, v) between sets (rep, n, shingles); enough of them to connect what any link connects, or `every` one, once.

    Sets that share a hash of their rare prefixes may link, so components of that relation are joined on their own.
    Small components travel together in groups of about `group_rows` sets; one that is larger is dealt into blocks of
    that size, and each pair of its blocks is a task.
    """
    kind = sets.schema["rep"].dataType
    prefixes = put_aside(_rare_prefixes(sets, percent), "rare-prefixes")
    leaders = put_aside(prefixes.groupBy("hash").agg(F.min("rep").alias("v"), F.max("rep").alias("_w")).filter("v <> _w").drop("_w"),
                        "leaders")
    near = components(prefixes.join(leaders, "hash").select(F.col("rep").alias("u"), "v"))
    near = put_aside(near, "near")
    totals = put_aside(near.groupBy("component").agg(F.count("*").alias("_size")), "near-sizes")
    rows = put_aside(sets.join(near.join(totals, "component"), F.col("rep") == F.col("node")).select(
        "rep", "n", "shingles", "component", "_size"), "near-sets")
    buckets = max(1, -(-rows.count() // group_rows))
    blocks = F.ceil(F.col("_size") / group_rows).cast("int")
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    small = rows.filter(F.col("_size") <= group_rows).select(
        bucket_of(F.col("component"), buckets).cast("long").alias("_g"), F.lit(-1).alias("_i"), F.lit(-1).alias("_j"),
        F.lit(0).alias("_side"), "rep", "n", "shingles")
    large = rows.filter(F.col("_size") > group_rows).withColumn("_b", block).withColumn(
        "_o", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        F.xxhash64("component").alias("_g"), F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"),
        (F.col("_o") < F.col("_b")).cast("int").alias("_side"), "rep", "n", "shingles")
    ship_package(sets.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    return small.unionByName(large).groupBy("_g", "_i", "_j").applyInArrow(
        _links_in(to_arrow_type(kind), percent, every), T.StructType([T.StructField("u", kind), T.StructField("v", kind)]))


def near_copy_groups(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion",
                     group_rows: int = GROUP_ROWS, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Groups of incidents whose `descripcion` are near copies: key, n_shingles, component_id.

    A set is the distinct shingles (of `shingle` words) of the whole text, A-Z in lower case; two sets link when
    100 * intersection >= percent * union, and `component_id` is the least key that links lead to. Equal sets are one class;
    classes that cannot have a partner are ruled out by hash prefixes, the sets of the others are joined by
    T-occurrence search (`divide_skip_links`). Every link between different sets counts; links inside what is
    connected already are not searched again. Sets hold 64-bit hashes of shingles.

    A text of fewer words than a shingle is one; null, empty and blank texts have none and link with nothing. Rows
    with a null key link with nothing and have a null component. Repeated rows come back as often as they are given; rows of one
    key are one record, whose links are those of all its rows. Other columns are ignored; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = records.schema[key].dataType
    rows = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField("_key", kind), T.StructField("n", T.LongType()), T.StructField("digest", T.LongType()),
                           T.StructField("prefix", T.ArrayType(T.LongType()))])
    with workspace() as keep:
        prefixes = put_aside(map_arrow(rows, _prefixes(to_arrow_type(kind), shingle, percent), schema), "prefixes")
        sizes = keep(put_aside(prefixes.select("_key", "n"), "set-sizes"))
        named = prefixes.filter("_key is not null")
        # equal sets: only classes of more than one key need the join
        several = named.filter("n > 0").groupBy("digest").agg(F.min("_key").alias("rep"), F.max("_key").alias("_last")).filter(
            "rep <> _last").drop("_last")
        equal = put_aside(named.select("_key", "digest").join(several, "digest").select(F.col("_key").alias("u"), F.col("rep").alias("v")), "equal")
        able = put_aside(_can_link(named, percent), "able")
        release(prefixes)
        sets = _stored_sets(rows, able.select("rep"), shingle)
        links = set_links(sets, group_rows, percent)
        found = keep(put_aside(components(links.unionByName(equal.filter("u <> v"))), "found")).withColumnRenamed("node", "_node")
    return sizes.join(found, F.col("_key") == F.col("_node"), "left").select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "_key").alias("component_id"))


def near_copy_links(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion",
                    group_rows: int = GROUP_ROWS, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every link of `near_copy_groups`: rows (key, n_shingles, class_id, n_links, component_id), and links (u, v).

    A class holds the records of one set; `class_id` is a hash of the set, null without words or key. The second table has
    each pair of different classes that link once, by class. `n_links` counts the other records a record links to: the
    rest of its class and the sizes of all classes that its class links to. A key whose rows have several texts is a
    member of each of their classes and counts in each; its rows have their own classes and counts and one component.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = records.schema[key].dataType
    rows = records.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField("_key", kind), T.StructField("n", T.LongType()), T.StructField("digest", T.LongType()),
                           T.StructField("prefix", T.ArrayType(T.LongType()))])
    prefixes = put_aside(map_arrow(rows, _prefixes(to_arrow_type(kind), shingle, percent), schema), "prefixes")
    named = prefixes.filter("_key is not null")
    able = put_aside(_can_link(named, percent), "able")
    found = _stored_sets(rows, able.select("rep"), shingle, True)
    sets = put_aside(found.join(able.select(F.col("digest").alias("rep")), "rep", "left_semi").dropDuplicates(["rep"]), "class-sets")
    links = put_aside(set_links(sets, group_rows, percent, True), "class-links")
    classes = put_aside(named.filter("n > 0").select("digest", "_key").distinct().groupBy("digest").agg(
        F.count("*").alias("size"), F.min("_key").alias("first")), "classes")
    ways = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    more = ways.join(classes.select(F.col("digest").alias("v"), "size"), "v").groupBy(F.col("u").alias("digest")).agg(
        F.sum("size").alias("_more"))
    counts = put_aside(classes.join(more, "digest", "left").select(
        "digest", "first", (F.col("size") - 1 + F.coalesce("_more", F.lit(0))).alias("n_links")), "link-counts")
    ends = counts.select("digest", "first")
    between = links.join(ends.toDF("u", "_u"), "u").join(ends.toDF("v", "_v"), "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    inside = named.join(ends, "digest").select(F.col("_key").alias("u"), F.col("first").alias("v"))
    groups = put_aside(components(between.unionByName(inside.filter("u <> v"))), "found").withColumnRenamed("node", "_node")
    counted = prefixes.withColumn("digest", F.when(F.col("_key").isNotNull(), F.col("digest"))).select("_key", "n", "digest").join(
        counts.select("digest", "n_links"), "digest", "left")
    return counted.join(groups, F.col("_key") == F.col("_node"), "left").select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.col("digest").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "_key").alias("component_id")), links
