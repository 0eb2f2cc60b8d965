"""Daily stock kept up from one day to the next: what changed movements touch is read and written, the rest stays as it is.

Under one folder: `dias` (V26, partitioned by month and by a bucket of the centre), `cierres` (stock of every centre at the
end of each month, partitioned alike), `forma` (first day and number of buckets), `cambios` (rows of a change set on their
way in) and `aplicados` (finished ones).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granero.functions.numbers import TONS
from granero.operators.dedupe import first_per_key
from granero.plans.freight import centre_context
from granero.plans.inventory import FLOWS, daily_flows, daily_stock
from granero.sources.sinks import balanced, drop_stored, overwrite_table, replace_partitions, stored_exists

CENTRE, DATE, MONTH, BUCKET = "id_ceda_agricultura", "fecha", "mes", "cubeta"
STOCKS = ("dap_ton_inventario_acumulado", "urea_ton_inventario_acumulado")
NET = {"dap_ton_inventario_acumulado": ("dap_ton_total_entrada", "dap_ton_total_salida"),
       "urea_ton_inventario_acumulado": ("urea_ton_total_entrada", "urea_ton_total_salida")}


# ---- change sets

def changed_rows(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `old` that are gone or were corrected, and rows of `new` that are new or corrections, NULL equal to NULL.

    Equal rows of both versions cancel out in one aggregate, repeated rows as often as they come.
    """
    both = old.select(*new.columns, F.lit(-1).alias("_s")).unionByName(new.withColumn("_s", F.lit(1)))
    net = both.groupBy(*new.columns).agg(F.sum("_s").alias("_s")).filter("_s <> 0")
    rows = net.withColumn("_s", F.explode(F.array_repeat(F.signum("_s").cast("int"), F.abs("_s").cast("int"))))
    return rows.filter("_s < 0").drop("_s"), rows.filter("_s > 0").drop("_s")


def flow_changes(removed: DataFrame, added: DataFrame) -> DataFrame:
    """One change set out of the flows of the removed rows (taken back) and of the added ones."""
    return removed.withColumns({c: -F.col(c) for c in FLOWS}).unionByName(added)


# ---- storage

def _placed(days: DataFrame, buckets: int) -> DataFrame:
    return days.withColumns({MONTH: F.year(DATE) * 100 + F.month(DATE), BUCKET: F.pmod(F.xxhash64(CENTRE), F.lit(buckets)).cast("int")})


def _month(day: dt.date) -> int:
    return day.year * 100 + day.month


def _closings(days: DataFrame, end: dt.date) -> DataFrame:
    """The last day of every centre and month, of days that reach to `end`: every centre has all of them."""
    return days.filter((F.col(DATE) == F.last_day(DATE)) | (F.col(DATE) == F.lit(end))).drop(*FLOWS)


def _listed(centres: DataFrame) -> DataFrame:
    return first_per_key(centre_context(centres, "nombre_cedas"), [CENTRE])


def build_stock(flows: DataFrame, centres: DataFrame, path: str, start: dt.date, end: dt.date, buckets: int = 16) -> None:
    """V26 from the whole history, stored for upkeep; replaces what is at `path`."""
    spark = flows.sparkSession
    drop_stored(spark, path)
    overwrite_table(_placed(daily_stock(flows, centres, start, end), buckets), f"{path}/dias", [MONTH, BUCKET])
    overwrite_table(_closings(spark.read.parquet(f"{path}/dias"), end), f"{path}/cierres", [MONTH, BUCKET])
    spark.createDataFrame([(buckets, start)], "cubetas int, inicio date").write.parquet(f"{path}/forma")


def stored_stock(spark: SparkSession, path: str) -> DataFrame:
    """V26 as stored."""
    return spark.read.parquet(f"{path}/dias").drop(MONTH, BUCKET)


def stock_on(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    """Stock of every centre at the end of a day; reads one month."""
    return spark.read.parquet(f"{path}/dias").filter((F.col(MONTH) == _month(day)) & (F.col(DATE) == F.lit(day))).drop(MONTH, BUCKET, *FLOWS)


def touched_days(spark: SparkSession, path: str, first_months: dict[int, int]) -> DataFrame:
    """Stored days of each bucket from its first touched month on; the condition is on partition columns alone."""
    touched: Column = F.lit(False)
    for bucket, month in sorted(first_months.items()):
        touched = touched | ((F.col(BUCKET) == bucket) & (F.col(MONTH) >= month))
    return spark.read.parquet(f"{path}/dias").filter(touched)


# ---- upkeep

def _moved(days: DataFrame, changes: DataFrame, names: DataFrame) -> DataFrame:
    """Placed `days` with the changed sums of each centre and day added to its flows, and from that day on to its stock.

    `changes` (`_changes_from`) and `names`, the other columns of a centre (`_names_from`), run along the days of their month
    as rows of their own, one at least for each month they hold in: they are neither spread over the calendar nor joined.
    Days without names are dropped. A month's rows of a bucket meet in one task in the order in which they are stored, so
    one shuffle and one sort serve the sums and the writing.
    """
    parts = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        names.withColumn("_o", F.lit(0)), changes.withColumn("_o", F.lit(1)), days.withColumn("_o", F.lit(2))])
    upto = Window.partitionBy(MONTH, BUCKET, CENTRE).orderBy(DATE, "_o").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.repartition(parts, MONTH, BUCKET).withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("_n", "_c")}).filter("_o = 2 AND _n IS NOT NULL")
    zero, today = F.lit(0).cast(TONS), F.col("_c.dia") == F.col(DATE)
    added = {c: F.when(today, F.col(f"_c.{c}")).otherwise(zero) for c in FLOWS} | {c: F.coalesce(f"_c.{c}", zero) for c in STOCKS}
    return rows.select(CENTRE, "_n.*", DATE, *[(F.col(c) + v).cast(TONS).alias(c) for c, v in added.items()], MONTH, BUCKET)


def _changes_from(daily: DataFrame, end: dt.date) -> DataFrame:
    """Changed sums of a centre and day and what they add up to, on each changed day and on the first of each later month."""
    days = Window.partitionBy(CENTRE).orderBy(DATE)
    total = {c: F.sum(F.col(i) - F.col(o)).over(days.rowsBetween(Window.unboundedPreceding, 0)).cast(TONS) for c, (i, o) in NET.items()}
    until = F.coalesce(F.date_sub(F.lead(DATE).over(days), 1), F.lit(end))
    rows = daily.select(CENTRE, DATE, F.add_months(F.trunc(DATE, "MM"), 1).alias("_m"), until.alias("_u"), F.struct(
        F.col(DATE).alias("dia"), *[F.col(f"_{c}").alias(c) for c in FLOWS], *[v.alias(c) for c, v in total.items()]).alias("_c"))
    firsts = F.when(F.col("_m") <= F.col("_u"), F.sequence("_m", "_u", F.expr("INTERVAL '1' MONTH"))).otherwise(F.array().cast("array<date>"))
    return rows.select(CENTRE, "_c", F.explode(F.concat(F.array(DATE), firsts)).alias(DATE))


def _names_from(last: DataFrame, touched: dict[int, int], end: dt.date) -> DataFrame:
    """The other columns of every centre in a touched bucket, on the first of each month from the bucket's first touched one on."""
    since = F.coalesce(F.lit(None).cast("date"), *[F.when(F.col(BUCKET) == b, F.lit(dt.date(m // 100, m % 100, 1))) for b, m in sorted(touched.items())])
    others = [c for c in last.columns if c not in (CENTRE, DATE, MONTH, BUCKET, *STOCKS)]
    return last.select(CENTRE, F.struct(*others).alias("_n"), F.explode(F.sequence(since, F.lit(end.replace(day=1)), F.expr("INTERVAL '1' MONTH"))).alias(DATE))


def _changes_by_day(changes: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Changed sums per centre and day; what lies before the first day counts as opening stock there, without flows."""
    daily = daily_flows(changes.filter(F.col(DATE) <= F.lit(end))).filter(" OR ".join(f"{c} <> 0" for c in FLOWS))
    inside = F.col(DATE) >= F.lit(start)
    rows = daily.select(CENTRE, F.greatest(F.col(DATE), F.lit(start)).alias(DATE), *[F.when(inside, F.col(c)).otherwise(0).cast(TONS).alias(f"_{c}") for c in FLOWS], *FLOWS)
    return rows.groupBy(CENTRE, DATE).agg(*[F.sum(c).cast(TONS).alias(c) for c in (*FLOWS, *[f"_{c}" for c in FLOWS])])


def update_stock(spark: SparkSession, path: str, change_id: str, changes: DataFrame, centres: DataFrame, flows: DataFrame | None = None,
                 end: dt.date | None = None) -> list[int]:
    """Bring the stored stock up to date; returns the buckets that were written (none if `change_id` is in already).

    `changes` are flows to add, negative ones to take back (`flow_changes`), of any day. With a later `end` the days up
    to it are appended; `flows` then gives the movements after the old end. Centres that are new or whose names changed
    are built from `flows`, centres no longer listed leave. A centre changes from its first changed day on: only its
    bucket's partitions from that month on are read, and only they are written.

    The new rows are complete under `cambios` before any stored one is replaced, so a run that broke off is taken up where
    it was: a finished change set is never applied twice, an unfinished one is written again from the same rows.
    """
    staged, done = f"{path}/cambios/{change_id}", f"{path}/aplicados/{change_id}"
    if stored_exists(spark, done):
        return []
    if not stored_exists(spark, f"{staged}/partes/_SUCCESS"):
        _stage(spark, path, staged, changes, centres, flows, end)
    parts = spark.read.parquet(f"{staged}/partes").collect()  # one row per bucket and month
    for row in parts:
        if not row["filas"]:
            for table in ("dias", "cierres"):
                drop_stored(spark, f"{path}/{table}/{MONTH}={row[MONTH]}/{BUCKET}={row[BUCKET]}")
    full = [row for row in parts if row["filas"]]
    if full:
        replace_partitions(spark, f"{staged}/dias", f"{path}/dias", [f"{MONTH}={row[MONTH]}/{BUCKET}={row[BUCKET]}" for row in full])
        firsts = {row[BUCKET]: row[MONTH] for row in sorted(full, key=lambda row: -row[MONTH])}
        overwrite_table(_closings(touched_days(spark, path, firsts), full[0]["fin"]), f"{path}/cierres", [MONTH, BUCKET])
    spark.createDataFrame([(change_id,)], "cambio string").write.mode("overwrite").parquet(done)
    drop_stored(spark, staged)
    return sorted({row[BUCKET] for row in parts})


def _stage(spark: SparkSession, path: str, staged: str, changes: DataFrame, centres: DataFrame, flows: DataFrame | None, end: dt.date | None) -> None:
    """Write the rows of all touched partitions, and how many rows each has."""
    buckets, start = spark.read.parquet(f"{path}/forma").first()
    stored = spark.read.parquet(f"{path}/cierres")
    last_month, old_end = stored.agg(F.max(MONTH), F.max(DATE)).first()
    new_end = max(end or old_end, old_end)
    last = stored.filter((F.col(MONTH) == last_month) & (F.col(DATE) == F.lit(old_end)))
    names = [c for c in last.columns if c not in (DATE, MONTH, BUCKET, *STOCKS)]
    listed = _listed(centres).select(names)
    for name, rows in (("salen", last.select(names).subtract(listed)), ("entran", listed.subtract(last.select(names)))):
        rows.write.mode("overwrite").parquet(f"{staged}/{name}")  # read several times below
    gone, fresh = spark.read.parquet(f"{staged}/salen"), spark.read.parquet(f"{staged}/entran")
    if (new_end > old_end or not fresh.isEmpty()) and flows is None:
        raise ValueError("later days and new centres need the movements")
    moved = changes.filter(F.col(DATE) <= F.lit(old_end))
    if new_end > old_end:
        moved = moved.unionByName(flows.filter((F.col(DATE) > F.lit(old_end)) & (F.col(DATE) <= F.lit(new_end))))
    kept = last.join(gone.select(CENTRE), CENTRE, "left_anti")
    daily = _changes_by_day(moved, start, new_end).join(kept.select(CENTRE), CENTRE, "left_semi")
    daily.write.mode("overwrite").parquet(f"{staged}/diario")
    daily = spark.read.parquet(f"{staged}/diario")
    firsts = _placed(daily.select(CENTRE, DATE), buckets).groupBy(BUCKET).agg(F.min(MONTH).alias(MONTH))
    whole = _placed(gone.select(CENTRE).unionByName(fresh.select(CENTRE)).withColumn(DATE, F.lit(start)), buckets).select(BUCKET, MONTH).distinct()
    touched: dict[int, int] = {}
    for row in [*firsts.collect(), *whole.collect()]:  # at most two rows per bucket
        touched[row[BUCKET]] = min(row[MONTH], touched.get(row[BUCKET], row[MONTH]))
    if new_end > old_end:
        after = _month(old_end + dt.timedelta(days=1))
        touched = {b: min(touched.get(b, after), after) for b in range(buckets)}
    before = touched_days(spark, path, touched)
    days = before.select(CENTRE, DATE, *FLOWS, *STOCKS)
    if new_end > old_end:
        later = F.explode(F.sequence(F.lit(old_end + dt.timedelta(days=1)), F.lit(new_end)))
        days = days.unionByName(kept.select(CENTRE, later.alias(DATE), *[F.lit(0).cast(TONS).alias(c) for c in FLOWS], *STOCKS))
    rows = _moved(*[_placed(r, buckets) for r in (days, _changes_from(daily, new_end), _names_from(kept, touched, new_end))])
    rows.write.mode("overwrite").partitionBy(MONTH, BUCKET).parquet(f"{staged}/dias")
    if not fresh.isEmpty():
        built = _placed(daily_stock(flows, centres.join(fresh.select(CENTRE), CENTRE, "left_semi"), start, new_end), buckets)
        balanced(built, MONTH, BUCKET).write.mode("append").partitionBy(MONTH, BUCKET).parquet(f"{staged}/dias")
    held = before.select(MONTH, BUCKET).distinct().withColumn("filas", F.lit(0).cast("bigint"))
    now = spark.read.schema(before.schema).parquet(f"{staged}/dias").groupBy(MONTH, BUCKET).agg(F.count("*").alias("filas"))
    held.unionByName(now).groupBy(MONTH, BUCKET).agg(F.max("filas").alias("filas"), F.lit(new_end).alias("fin")).coalesce(1).write.mode("overwrite").parquet(f"{staged}/partes")
