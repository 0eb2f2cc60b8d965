"""Phrase collocations: frequent runs of two to four words, counted in tiles of frequency-ranked ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.common import map_arrow, put_aside, release, ship_package

LONGEST = 4  # words of a phrase
MIN_COUNT = 30
PER_GROUP = 2000
INSIDE_PERCENT = 80  # a phrase goes when a longer one around it has that share of its occurrences
SCALE = 2_000_000
BLOCK_BYTES = 4 << 20  # text of a block
SLICE_BYTES = 1 << 20  # of a text that is split into words at a time
TILE_MASS = 2_000_000  # occurrences of the ids of a strip of tiles
DENSE_CELLS = 1 << 22  # cells of the largest tile that is counted by address
CORNER = 1024  # the most frequent ids of a block are counted by address in a square of that side
SPREAD = 64  # parts that ids of one frequency are ranked in

# A-Z in lower case, tab as blank, and the bytes that end a piece as 0xFF, which no UTF-8 text has.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _ENDS, bytes(range(97, 123)) + b" " + b"\xff" * len(_ENDS))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text and 0xFF for every end of a piece, in lists that never cut a word."""
    plain, at = text.translate(_PLAIN), 0
    while at < len(plain):
        cuts = [c for c in (plain.find(b" ", at + SLICE_BYTES), plain.find(b"\xff", at + SLICE_BYTES)) if c >= 0]
        upto = min(cuts, default=len(plain))
        yield plain[at:upto].replace(b"\xff", b" \xff ").split()
        at = upto


class _Codes(dict):
    """Number of each word in its block, from 1 in order of appearance; ends of pieces are 0."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class _Block:
    def __init__(self):
        self.codes, self.runs, self.size = _Codes(), [], 0

    def add(self, text: bytes) -> None:
        for words in words_of(text):
            self.runs.append(np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words)))
        self.runs.append(np.zeros(1, np.uint32))
        self.size += len(text) + 16

    def row(self, group: str, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.runs)
        times = np.bincount(codes, minlength=len(self.codes))[1:]
        words = list(self.codes)[1:]
        return pa.RecordBatch.from_arrays([
            pa.array([group]), pa.array([number], pa.int64()), pa.array([_closed(codes).tobytes()], pa.binary()),
            pa.array([words], pa.list_(pa.binary())), pa.array([times], pa.list_(pa.int64())), pa.array([int(times.sum())], pa.int64())],
            ["grp", "block", "ids", "words", "times", "n_words"])


def _closed(ids: np.ndarray) -> np.ndarray:
    """One 0 for each run of zeros."""
    kept = ids != 0
    kept[1:] |= ids[:-1] != 0
    return ids[kept]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each group's texts; the largest leaves when it is full or all together are twice as large."""
    open_blocks: dict[str, _Block] = {}
    held, number = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            block = open_blocks.setdefault(group, _Block())
            before = block.size
            block.add(text.as_py() or b"")
            held += block.size - before
            while held >= 2 * BLOCK_BYTES or block.size >= BLOCK_BYTES:
                largest = max(open_blocks, key=lambda g: open_blocks[g].size)
                block = open_blocks.pop(largest)
                yield block.row(largest, number)
                held, number, block = held - block.size, number + 1, _Block()
    for group, block in open_blocks.items():
        yield block.row(group, number)
        number += 1


# ---- ranks and the plan of tiles

def _ranked(units: DataFrame, key: list[str], tile_mass: int) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """Units (grp, key.., f, others) with `id`, their rank by frequency from 1 in their group; and each group's tile bounds.

    Ranks come from counts per frequency, so no group is sorted in one task. Bound k of a group is the rank at which
    the frequencies added up reach k times `tile_mass`: there are as many bounds as the words divided by `tile_mass`.
    """
    units = put_aside(units.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(SPREAD))), "units")
    sizes = units.groupBy("grp", "f", "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("grp").orderBy(F.desc("f"), "_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = put_aside(sizes.select("grp", "f", "_b", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rank"),
                                   F.coalesce(F.sum(F.col("f") * F.col("_n")).over(before), F.lit(0)).alias("_mass")), "unit-sizes")
    place = F.row_number().over(Window.partitionBy("grp", "f", "_b").orderBy(*key))
    ranked = put_aside(units.withColumn("_place", place).join(sizes.select("grp", "f", "_b", "_rank"), ["grp", "f", "_b"]).select(
        *[c for c in units.columns if c != "_b"], (F.col("_rank") + F.col("_place")).alias("id")), "ranked")
    first = F.floor(F.col("_mass") / tile_mass) + 1
    last = F.floor((F.col("_mass") + F.col("f") * F.col("_n")) / tile_mass)
    rank = F.col("_rank") + F.ceil((F.col("_k") * tile_mass - F.col("_mass")) / F.col("f"))
    rows = sizes.filter(last >= first).withColumn("_k", F.explode(F.sequence(first, last))).select("grp", rank.alias("rank")).collect()
    bounds: dict[str, list[int]] = {}
    for row in rows:
        bounds.setdefault(row["grp"], []).append(row["rank"])
    return ranked, {g: np.sort(np.array(b, np.int64)) for g, b in bounds.items()}


def tiles_of(first: np.ndarray, second: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strip and part of the tile of each pair of ids.

    A strip holds the ids between two bounds. Where an id alone passes several bounds, its strip is dealt into as many
    parts by the second id, between bounds spread evenly over the whole mass.
    """
    strip = np.searchsorted(bounds, first, side="left")
    if not len(bounds):
        return strip, strip
    many = np.append(np.searchsorted(bounds, bounds, side="right") - np.searchsorted(bounds, bounds, side="left"), 1)
    return strip, np.searchsorted(bounds, second, side="left") * many[strip] // (len(bounds) + 1)


def pair_keys(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the neighbours that are both above 0, and their keys: first id in the high half, second in the low one."""
    at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
    return at, ids[at].astype(np.uint64) << np.uint64(32) | ids[at + 1].astype(np.uint64)


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def count_keys(keys: np.ndarray, corner: int = CORNER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts: of the most frequent ids by address, of all others by sorting."""
    first, second = _halves(keys)
    near = (first < corner) & (second < corner)
    dense = np.bincount(first[near] * corner + second[near], minlength=1)
    cells = np.flatnonzero(dense)
    sparse, times = np.unique(keys[~near], return_counts=True)
    found = np.concatenate([(cells // corner).astype(np.uint64) << np.uint64(32) | (cells % corner).astype(np.uint64), sparse])
    order = np.argsort(found, kind="stable")
    return found[order], np.concatenate([dense[cells], times])[order]


def sum_cells(keys: np.ndarray, counts: np.ndarray, dense_cells: int = DENSE_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a tile in order and the sums of their counts, by address if the tile is small, else by sorting."""
    first, second = _halves(keys)
    low, least = int(first.min()), int(second.min())
    width, height = int(second.max()) - least + 1, int(first.max()) - low + 1
    if width * height <= dense_cells:
        cell, total = (first - low) * width + second - least, np.zeros(width * height, np.int64)
        np.add.at(total, cell, counts)
        cells = np.flatnonzero(total)
        return (cells // width + low).astype(np.uint64) << np.uint64(32) | (cells % width + least).astype(np.uint64), total[cells]
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts, starts)


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, each as wide as the largest needs; their number must be known to read them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(packed: bytes | pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _count_tiles(bounds: dict[str, np.ndarray]):
    """Counts of every block: a row per tile, its keys as rows of the tile (first ids, how many each) and second ids."""
    none = np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, block, ids in zip(*batch.columns):
                group = name.as_py()
                keys, counts = count_keys(pair_keys(np.frombuffer(ids.as_buffer(), np.uint32))[1])
                if not len(keys):
                    continue
                first, second = _halves(keys)
                strip, part = tiles_of(first, second, bounds.get(group, none))
                starts = np.flatnonzero(np.append(True, (strip[1:] != strip[:-1]) | (part[1:] != part[:-1])))
                out = []
                for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                    rows, lengths = np.unique(first[lo:hi], return_counts=True)
                    out.append((group, int(strip[lo]), int(part[lo]), block.as_py(), hi - lo, len(rows), _narrow(rows), _narrow(lengths),
                                _narrow(second[lo:hi]), _narrow(counts[lo:hi])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4))],
                    ["grp", "strip", "part", "block", "n", "n_rows", "rows", "lengths", "seconds", "counts"])
    return run


_TILE = ("grp", "strip", "part")
_TILE_COUNTS = ("grp string, strip int, part int, block long, n int, n_rows int, rows binary, lengths binary, seconds binary, "
                "counts binary")
_TILE_SUMS = "grp string, strip int, part int, block long, hits binary, n int, keys binary, totals binary"


def _sum_tile(min_count: int, with_hits: bool):
    """Frequent keys of a tile and their counts (the row without block); for each block, which of them it holds."""
    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n").to_pylist()
        ends = np.cumsum([0, *sizes]).tolist()
        every, counts = np.empty(ends[-1], np.uint64), np.empty(ends[-1], np.int64)
        for lo, hi, n_rows, *packed in zip(ends, ends[1:], rows.column("n_rows").to_pylist(), *(
                rows.column(c) for c in ("rows", "lengths", "seconds", "counts"))):
            first, lengths, second, times = (p.as_buffer() for p in packed)
            every[lo:hi] = np.repeat(_wide(first, n_rows), _wide(lengths, n_rows)).astype(np.uint64) << np.uint64(32)
            every[lo:hi] |= _wide(second, hi - lo).astype(np.uint64)
            counts[lo:hi] = _wide(times, hi - lo)
        found, total = sum_cells(every, counts)
        found, total = found[total >= min_count], total[total >= min_count]
        tile, out = tuple(rows.column(c)[0].as_py() for c in _TILE), []
        if len(found):
            out.append((*tile, None, None, len(found), found.tobytes(), total.astype(np.int64).tobytes()))
            for block, lo, hi in zip(rows.column("block").to_pylist(), ends, ends[1:]) if with_hits else ():
                own = every[lo:hi]
                at = np.minimum(np.searchsorted(found, own), len(found) - 1)
                hits = at[found[at] == own]
                if len(hits):
                    out.append((*tile, block, _narrow(hits), len(hits), None, None))
        names = [f.split()[0] for f in _TILE_SUMS.split(", ")]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({name: pa.array(c, t) for name, c, t in zip(names, zip(*out) if out else [[]] * len(names), kinds)})
    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each frequent pair of a tile."""
    for batch in batches:
        for group, strip, part, keys, totals in zip(*(c.to_pylist() for c in batch.columns)):
            first, second = _halves(np.frombuffer(keys, np.uint64))
            n = len(first)
            yield pa.RecordBatch.from_arrays([
                pa.array([group] * n), pa.array([strip] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(np.arange(n), pa.int64()),
                pa.array(first), pa.array(second), pa.array(np.frombuffer(totals, np.int64))],
                ["grp", "strip", "part", "place", "x", "y", "f"])


def _name_hits(blocks: pa.Table, ranks: pa.Table) -> pa.Table:
    """Keys and ranks of the frequent pairs of a tile that each block holds."""
    n = ranks.num_rows
    places, ids = ranks.column("place").to_numpy(), ranks.column("id").to_numpy()
    keys = ranks.column("x").to_numpy().astype(np.uint64) << np.uint64(32) | ranks.column("y").to_numpy().astype(np.uint64)
    of = np.zeros(n, np.int64)
    of[places] = np.arange(n)
    out = []
    for r in blocks.select(["block", "hits", "n"]).to_pylist():
        at = of[_wide(r["hits"], r["n"])]
        out.append((r["block"], keys[at].tobytes(), ids[at].astype(np.uint32).tobytes()))
    return pa.table({name: pa.array(c, t) for name, c, t in zip(("block", "keys", "names"), zip(*out) if out else [[]] * 3, (
        pa.int64(), pa.binary(), pa.binary()))})


_STREAM = "grp string, block long, ids binary"


def _stream(blocks: pa.Table, ids: np.ndarray) -> pa.Table:
    return pa.table({"grp": blocks.column("grp"), "block": blocks.column("block"), "ids": pa.array([_closed(ids).tobytes()], pa.binary())})


def _rename_words(blocks: pa.Table, names: pa.Table) -> pa.Table:
    """A block's words by rank; those without one end a piece."""
    if not blocks.num_rows:
        return blocks
    codes = np.frombuffer(blocks.column("ids")[0].as_buffer(), np.uint32)
    rank = np.zeros(int(codes.max(initial=0)) + 1, np.uint32)
    rank[names.column("code").to_numpy()] = names.column("id").to_numpy()
    return _stream(blocks, rank[codes])


def _rename_pairs(blocks: pa.Table, names: pa.Table) -> pa.Table:
    """For each place of a block the rank of the pair that begins there, 0 for one that is not frequent."""
    if not blocks.num_rows:
        return blocks
    ids = np.frombuffer(blocks.column("ids")[0].as_buffer(), np.uint32)
    out = np.zeros(len(ids), np.uint32)
    if names.num_rows:
        keys = np.concatenate([np.frombuffer(k.as_py(), np.uint64) for k in names.column("keys")])
        ranks = np.concatenate([np.frombuffer(k.as_py(), np.uint32) for k in names.column("names")])
        order = np.argsort(keys)
        keys, ranks = keys[order], ranks[order]
        at, own = pair_keys(ids)
        found = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        out[at] = np.where(keys[found] == own, ranks[found], 0)
    return _stream(blocks, out)


def _frequent_pairs(stream: DataFrame, bounds: dict[str, np.ndarray], min_count: int, last: bool) -> tuple[DataFrame, DataFrame]:
    """Frequent pairs of neighbours (grp, strip, part, place, x, y, f), and the blocks' hits (grp, strip, part, block, ..)."""
    counts = map_arrow(stream, _count_tiles(bounds), _TILE_COUNTS)
    tiles = put_aside(counts.groupBy(*_TILE).applyInArrow(_sum_tile(min_count, not last), _TILE_SUMS), "tiles")
    pairs = map_arrow(tiles.filter("block is null").select(*_TILE, "keys", "totals"), _unpack,
                      "grp string, strip int, part int, place long, x long, y long, f long")
    return pairs, tiles.filter("block is not null").select(*_TILE, "block", "hits", "n")


# ---- phrases

def _with_score(phrases: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Adds the lowest-scoring cut: score, l and r. Scores are floors of exact quotients; of equal ones the earliest cut counts."""
    each = [f"struct((cast(f as decimal(28,0)) * {SCALE}) div (cast({left} as decimal(28,0)) + {right}) as score, {k} as k, {left} as l, {right} as r)"
            for k, (left, right) in enumerate(cuts, 1)]
    return phrases.withColumn("_cut", F.expr(f"array_min(array({', '.join(each)}))")).select("*", "_cut.score", "_cut.l", "_cut.r")


def _joined(pairs: DataFrame, units: DataFrame, first: dict[str, str], second: dict[str, str], name: str) -> DataFrame:
    """Pairs with columns of their first and their second unit, under new names."""
    left = units.select("grp", F.col("id").alias("x"), F.col("phrase").alias("_head"), *[F.col(c).alias(n) for c, n in first.items()])
    right = units.select("grp", F.col("id").alias("y"), *[F.col(c).alias(n) for c, n in second.items()])
    rows = pairs.join(left, ["grp", "x"]).join(right, ["grp", "y"])
    return put_aside(rows.withColumn("phrase", F.concat_ws(" ", "_head", "last_word")).drop("_head"), name)


def _not_inside(phrases: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Phrases that no phrase one word longer around them nearly always accompanies; a still longer one implies that one."""
    around = longer.select("grp", F.explode(F.array("x", "y")).alias("id"), "f").groupBy("grp", "id").agg(F.max("f").alias("_around"))
    return phrases.join(around, ["grp", "id"], "left").filter(F.coalesce(100 * F.col("_around") < percent * F.col("f"), F.lit(True)))


def mine_phrases(records: DataFrame, text: str = "descripcion", group: str = "tipo_incidente", *, min_count: int = MIN_COUNT,
                 per_group: int = PER_GROUP, inside_percent: int = INSIDE_PERCENT, tile_mass: int = TILE_MASS,
                 unknown: str = "und") -> DataFrame:
    """Frequent phrases of two to four words in the incidents' `descripcion`, by `tipo_incidente`, with a cohesion score.

    Columns: the group, rank (from 1), phrase, a (its occurrences), l and r (those of its two parts at the lowest-scoring
    cut), n (all words of the group), score (floor of 2000000 a / (l + r)). A phrase occurs at least `min_count` times; one
    goes when a longer phrase around it has `inside_percent` of its occurrences; each group shows `per_group` phrases by
    score, occurrences and phrase.

    Texts become blocks of word numbers. Frequent words are ranked by frequency; neighbours are counted in tiles of two
    ranges of ranks, each block sending a tile its distinct cells once: small tiles are added up by address, large ones by
    sorting. The frequent pairs of a tile are ranked in their turn and go back to the blocks that hold them, where they
    take the words' places; pairs of pairs are triples, pairs of triples runs of four. A strip of tiles holds about
    `tile_mass` occurrences, and an id with more is dealt over several tiles, so no tile grows with the corpus. Counts are
    exact: words are compared as they are and ids are never hashed.

    Words are runs of anything but blanks and tabs, A-Z in lower case, inside pieces that end at `.,;:!?` and line ends. A
    null text is empty; a null group is `unknown`; repeated rows count as often as they come; very long texts are split
    into words in slices and never cut in a word; an empty table gives no rows; other columns are ignored.
    """
    rows = records.select(F.coalesce(F.col(group).cast("string"), F.lit(unknown)), F.col(text).cast("string").cast("binary"))
    ship_package(records.sparkSession)
    blocks = put_aside(map_arrow(rows, _blocks, "grp string, block long, ids binary, words array<binary>, times array<long>, n_words long"),
                       "phrase-blocks")
    totals = put_aside(blocks.groupBy("grp").agg(F.sum("n_words").alias("n")), "phrase-totals")
    counted = blocks.select("grp", F.explode(F.arrays_zip("words", "times")).alias("_w")).groupBy("grp", F.col("_w.words").alias("word")).agg(
        F.sum("_w.times").alias("f"))
    words, bounds = _ranked(counted.filter(F.col("f") >= min_count), ["word"], tile_mass)
    names = blocks.select("grp", "block", F.posexplode("words").alias("code", "word")).join(words.select("grp", "word", "id"), ["grp", "word"]).select(
        F.col("block").alias("_block"), (F.col("code") + 1).alias("code"), "id")
    stream = put_aside(blocks.select("grp", "block", "ids").groupBy("block").cogroup(names.groupBy("_block")).applyInArrow(
        _rename_words, _STREAM), "phrase-stream")
    release(blocks)
    frequent = []
    for length in range(2, LONGEST + 1):
        last = length == LONGEST
        pairs, hits = _frequent_pairs(stream, bounds, min_count, last)
        if last:
            frequent.append(put_aside(pairs, "pairs"))
            break
        pairs, bounds = _ranked(pairs, ["x", "y"], tile_mass)
        named = hits.groupBy(*_TILE).cogroup(pairs.select(*_TILE, "place", "x", "y", "id").groupBy(*_TILE)).applyInArrow(
            _name_hits, "block long, keys binary, names binary")
        shorter, stream = stream, put_aside(stream.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(
            _rename_pairs, _STREAM), "phrase-stream")
        release(shorter)
        frequent.append(pairs)
    two, three, four = frequent
    words = words.select("grp", "id", F.col("word").cast("string").alias("phrase"), "f")
    two = _joined(two.select("grp", "id", "x", "y", "f"), words, {"f": "first_f"}, {"phrase": "last_word", "f": "last_f"}, "two-words")
    three = _joined(three.select("grp", "id", "x", "y", "f"), two, {"first_f": "first_f", "f": "head_f"},
                    {"last_word": "last_word", "last_f": "last_f", "f": "tail_f"}, "three-words")
    four = _joined(four.select("grp", "x", "y", "f"), three, {"first_f": "first_f", "head_f": "head_f", "f": "left_f"},
                   {"last_word": "last_word", "last_f": "last_f", "tail_f": "tail_f", "f": "right_f"}, "four-words")
    shown = ["grp", "phrase", "f", "l", "r", "score"]
    found = _not_inside(_with_score(two, [("first_f", "last_f")]), three, inside_percent).select(shown).unionByName(
        _not_inside(_with_score(three, [("first_f", "tail_f"), ("head_f", "last_f")]), four, inside_percent).select(shown)).unionByName(
        _with_score(four, [("first_f", "right_f"), ("head_f", "tail_f"), ("left_f", "last_f")]).select(shown))
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("f"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_group)
    return best.join(totals, "grp").select(F.col("grp").alias(group), "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
