"""Filter interaction audit: what every filter removes in every order, from one pass over the records."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.common import put_aside

WHITE = "[\\x20\\x09-\\x0D]+"
SPREAD = 1024  # partitions keys that rows without a key are dealt to

Failure = Callable[[Column, Column], Column]

# Failure conditions by letter, each a function of the text and its words.
TEXT_FILTERS: dict[str, Failure] = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
    "D": lambda text, words: F.rlike(text, F.lit("[#$%&*|]")),
}
COPY_FILTER = "E"  # fails a record whose text a record with a smaller key has


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Of every subset of n filters (a bit mask): the orders that reach it from none, and that lead from it to all."""
    full = (1 << n) - 1
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for state in range(1, full + 1):
        reach[state] = sum(reach[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << f] for f in range(n) if not state >> f & 1)
    return reach, leave


def edge_weights(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders whose path takes that edge) for each edge of the lattice of applied filters."""
    reach, leave = path_counts(n)
    return [(state, f, reach[state] * leave[state | 1 << f]) for state in range(1 << n) for f in range(n) if not state >> f & 1]


def order_steps(names: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before it, filter) of all orders."""
    out = []
    for order in permutations(range(len(names))):
        state, title = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order, 1):
            out.append((title, step, state, f))
            state |= 1 << f
    return out


def _constant(rows: Sequence[tuple], fields: str) -> Column:
    """A fixed list of structs as one literal."""
    names = [f.split()[0] for f in fields.split(", ")]
    kind = f"array<struct<{', '.join(f.replace(' ', ': ') for f in fields.split(', '))}>>"
    return F.from_json(F.lit(json.dumps([dict(zip(names, row)) for row in rows])), kind)


def _features(records: DataFrame, key: str, text: str, part: str, filters: Mapping[str, Failure]) -> DataFrame:
    """One small row per record: key, part, a digest of the text, and the text filters it fails as bits."""
    rows = records.select(F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
                          F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", WHITE), ""))
    fails = F.lit(0)
    for bit, failure in enumerate(filters.values()):
        fails = fails + F.when(failure(F.col("_text"), F.col("_words")), 1 << bit).otherwise(0)
    return rows.select("_key", "_part", F.unhex(F.sha2("_text", 256)).alias("_digest"), fails.alias("_fails"),
                       F.when(F.col("_key").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).otherwise(0).alias("_salt"))


def _fail_counts(rows: DataFrame, labels: DataFrame, copies: int) -> DataFrame:
    """Records, good ones and toxic ones per part and set of failed filters.

    Labels meet the records by key. Records are then counted per text, part and label before they travel on, so a text
    that a third of all records share arrives as a few rows; each has its least key, and the least of all parts' decides
    which records the copy filter spares.
    """
    joined = rows.join(labels, ["_key", "_salt"], "left").groupBy("_key", "_salt", "_digest", "_part", "_fails", "_good", "_toxic").agg(
        F.count("*").alias("_n"))
    first = F.min(F.when(F.col("_key").isNotNull(), F.struct("_key", "_n")))
    keyless = F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0))
    texts = put_aside(joined.groupBy("_digest", "_part", "_fails", "_good", "_toxic").agg(
        F.sum("_n").alias("_n"), first.alias("_first"), keyless.alias("_keyless")), "audit-texts")
    least = texts.groupBy("_digest").agg(F.min("_first._key").alias("_least"))
    spared = F.col("_keyless") + F.when(F.col("_first._key") == F.col("_least"), F.col("_first._n")).otherwise(0)
    sides = texts.join(least, "_digest").withColumn("_spared", spared).select("_part", "_good", "_toxic", F.explode(F.array(
        F.struct(F.col("_fails").alias("fails"), F.col("_spared").alias("n")),
        F.struct((F.col("_fails") + copies).alias("fails"), (F.col("_n") - F.col("_spared")).alias("n")))).alias("_s"))
    n = F.col("_s.n")
    return sides.filter(n > 0).groupBy("_part", F.col("_s.fails").alias("fails")).agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce("_good", F.lit(0))).alias("good"), F.sum(n * F.coalesce("_toxic", F.lit(0))).alias("toxic"))


def audit_filters(records: DataFrame, labels: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion",
                  part: str = "responsable_cdf", good: str = "validada", toxic: str = "toxica",
                  filters: Mapping[str, Failure] | None = None) -> DataFrame:
    """What each filter does to the incidents' `descripcion`, in every order of the filters and for every `responsable_cdf`.

    Columns: part, filter_order, step (1 on; its filter is that letter of the order), kept (after the step), removed (by
    it), redundant (failing its filter, removed before), unique_fails (failing its filter alone), good_lost and toxic_lost
    (removed by it, labelled so), shapley (what its filter removes, summed over all orders). `filters` are failure
    conditions by letter; the copy filter `COPY_FILTER` comes last.

    Applied filters are a state in the lattice of subsets, and an order is a path through it. Records are counted once per
    part and set of failed filters (at most 32 rows a part); what is left in a state is the sum over the sets that avoid
    it, an edge removes the difference of its ends. The orders that reach an edge's start times those that leave its end
    weigh its removals in the Shapley sum; the steps of every order are read off the same edges.

    Defined cases: a null text is empty, and empty texts are copies of each other; a null part is the empty string; a null
    key is smaller than none, so such a record neither is a copy nor makes one; rows of one key and text are no copies of
    each other; a key labelled several times has its largest labels, other labels than 1 count as none. Parts come from
    the records; an empty table gives no rows; other columns are ignored.
    """
    filters = TEXT_FILTERS if filters is None else filters
    names = [*filters, COPY_FILTER]
    copies, full = 1 << len(filters), (1 << len(names)) - 1
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max((F.col(good) == 1).cast("int")).alias("_good"), F.max((F.col(toxic) == 1).cast("int")).alias("_toxic")).withColumn(
        "_salt", F.lit(0).cast("bigint"))
    counts = _fail_counts(_features(records, key, text, part, filters), marks, copies)
    lists = counts.groupBy("_part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("_sets"))  # at most one per set

    def left_in(measure: str) -> Column:
        """What is left in each state: all sets that avoid it."""
        return F.transform(F.sequence(F.lit(0), F.lit(full)), lambda state: F.aggregate(
            F.filter("_sets", lambda s: s["fails"].bitwiseAND(state) == 0), F.lit(0).cast("bigint"), lambda a, s: a + s[measure]))

    states = lists.select("_part", *[left_in(m).alias(m) for m in ("n", "good", "toxic")])
    edges = _constant(edge_weights(len(names)), "state int, f int, weight bigint")
    steps = _constant(order_steps(names), "filter_order string, step int, state int, f int")

    def removed(measure: str, state: Column, then: Column) -> Column:
        return F.get(measure, state) - F.get(measure, then)

    def bit_of(f: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), f)

    shares = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda f: F.aggregate(
        F.filter(edges, lambda e: e["f"] == f), F.lit(0).cast("bigint"),
        lambda a, e: a + e["weight"] * removed("n", e["state"], e["state"] + bit_of(e["f"]))))
    rows = states.withColumn("_shares", shares).select("*", F.explode(steps).alias("_e"))
    state, bit = F.col("_e.state"), bit_of(F.col("_e.f"))
    then = state + bit
    return rows.select(
        F.col("_part").alias("part"), F.col("_e.filter_order"), F.col("_e.step"),
        F.get("n", then).alias("kept"), removed("n", state, then).alias("removed"),
        (removed("n", F.lit(0), bit) - removed("n", state, then)).alias("redundant"),
        removed("n", full - bit, F.lit(full)).alias("unique_fails"),
        removed("good", state, then).alias("good_lost"), removed("toxic", state, then).alias("toxic_lost"),
        F.get("_shares", F.col("_e.f")).alias("shapley"))
