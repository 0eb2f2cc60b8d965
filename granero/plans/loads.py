"""Loads of the programme's tables from text extracts.

Every load reads text, normalises headers, types the columns by the declared layout, takes out removed rows, brings in
corrected ones, and returns a frame; writing it is the caller's step, after `require_not_null` where the load demands it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero import schemas
from granero.functions.classify import assign_centre, assign_centre_move
from granero.functions.dates import parse_date, parse_date_iso_first, parse_timestamp
from granero.functions.numbers import fill_zero_numeric, round3, to_int, to_number
from granero.functions.text import MOVE_NULL_TOKENS, NULL_TOKENS, normalize_headers, null_tokens
from granero.operators.dedupe import corrections_win, require_not_null, rows_absent
from granero.operators.filters import only_authorised
from granero.operators.positions import number_rows
from granero.sources.sinks import align_to_schema, rejects

# Header synonyms of the moves and delivery extracts, after normalising.
MOVE_ALIASES = {
    "folio_de_la_transferencia": "folio_transferencia", "abreviacion": "abreviacion_producto",
    "toneladas_en_destino": "toneladas_en_el_destino", "bultos_en_destino": "bultos_en_el_destino",
}


# how the moves are read: header synonyms and further null tokens
MOVE_TEXT = {"aliases": MOVE_ALIASES, "tokens": NULL_TOKENS + MOVE_NULL_TOKENS}


def _cells(raw: DataFrame, schema: T.StructType, style: str, aliases: dict[str, str] | None, tokens: tuple[str, ...],
           dates, times) -> tuple[DataFrame, list[tuple[T.StructField, Column]]]:
    """The input as trimmed text under the names of `schema`, and each column's typed value over that text."""
    named = normalize_headers(raw, style).withColumnsRenamed(aliases or {})
    have = set(named.columns)
    texts = named.select(*[
        (null_tokens(F.col(f"`{f.name}`"), tokens) if f.name in have else F.lit(None).cast("string")).alias(f.name)
        for f in schema.fields])
    cells = []
    for f in schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "decimal":
            c = (round3(to_number(c)) if f.dataType.scale == 3 else to_number(c)).try_cast(f.dataType)
        elif kind in ("integer", "long"):
            c = to_int(F.replace(c, F.lit(","), F.lit(""))).cast(f.dataType)
        elif kind == "date":
            c = dates(c)
        elif kind == "timestamp_ntz":
            c = times(c)
        elif schemas.text_limit(f):
            c = F.when(F.trim(c) != "", F.trim(c))
        cells.append((f, c.cast(f.dataType)))
    return texts, cells


def typed(raw: DataFrame, schema: T.StructType, style: str = "plain", aliases: dict[str, str] | None = None,
          tokens: tuple[str, ...] = NULL_TOKENS, dates=parse_date, times=parse_timestamp) -> DataFrame:
    """Text columns to the kinds of `schema`: one projection over the input. Text is kept whole, whatever its length."""
    texts, cells = _cells(raw, schema, style, aliases, tokens, dates, times)
    return texts.select(*[c.alias(f.name) for f, c in cells])


def load_rejects(raw: DataFrame, schema: T.StructType, key: str, style: str = "plain", aliases: dict[str, str] | None = None,
                 tokens: tuple[str, ...] = NULL_TOKENS, dates=parse_date, times=parse_timestamp) -> DataFrame:
    """K11 for every load: one row per value that `typed` had to empty, or that is longer than its column was declared.

    Built from the same cells as the load, in one scan. Long text is reported and stays whole, keys as well; empty
    values, null tokens and zero dates are not losses.
    """
    texts, cells = _cells(raw, schema, style, aliases, tokens, dates, times)
    checks = []
    for f, value in cells:
        text, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        lost = (F.trim(text) != "") & value.isNull()
        if kind == "decimal":
            reason = F.when(lost, F.when(to_number(text).isNull(), F.lit("no_convertible")).otherwise(
                F.lit(f"overflow_{f.dataType.precision}_{f.dataType.scale}")))
        elif kind in ("integer", "long"):
            reason = F.when(lost, F.lit("no_entero"))
        elif kind in ("date", "timestamp_ntz"):
            reason = F.when(lost & ~F.contains(text, F.lit("0000-")), F.lit("fecha_no_valida"))
        elif schemas.text_limit(f):
            reason = F.when(F.length(value) > schemas.text_limit(f), F.lit(f"excede_varchar_{schemas.text_limit(f)}"))
        else:
            continue
        checks.append((kind, f.name, reason))
    return rejects(texts, key, checks)


def load_freight(raw: DataFrame, corrected: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Freight: corrected rows are added, removed folios taken out, the centre follows the status."""
    key = "folio_del_flete"
    rows = typed(raw, schemas.FREIGHT)
    if removed is not None:
        rows = rows_absent(rows, removed, key)
    if corrected is not None:
        rows = rows.unionByName(typed(corrected, schemas.FREIGHT))
    return rows.withColumn("id_ceda_agricultura", assign_centre(
        F.col("estatus"), F.col("cdf_destino_original"), F.col("cdf_destino_final")))


def load_moves(raw: DataFrame, corrected: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Transfers or carry-over: corrected rows replace, and a row without a departure date refuses the load."""
    key, tokens = "folio_transferencia", NULL_TOKENS + MOVE_NULL_TOKENS
    rows = typed(raw, schemas.MOVES, aliases=MOVE_ALIASES, tokens=tokens)
    if removed is not None:
        rows = rows_absent(rows, removed, key)
    if corrected is not None:
        rows = corrections_win(rows, typed(corrected, schemas.MOVES, aliases=MOVE_ALIASES, tokens=tokens), key)
    rows = rows.withColumn("id_ceda_agricultura", assign_centre_move(
        F.col("estatus"), F.col("cdf_destino_original"), F.col("cdf_destino_final")))
    require_not_null(rows, ["fecha_de_salida"])
    return rows


def load_incidents(raw: DataFrame) -> DataFrame:
    """Stock losses."""
    return typed(raw, schemas.INCIDENTS)


def load_centres(raw: DataFrame) -> DataFrame:
    """The distribution network."""
    return typed(raw, schemas.CENTRES)


def load_order_lines(raw: DataFrame, order: str, removed_centres: DataFrame | None = None) -> DataFrame:
    """Order lines: numbered in file order before anything is filtered, then only authorised ones stay."""
    numbered = number_rows(normalize_headers(raw, "strict"), [order], "id_pedido").withColumn(
        "id_pedido", F.col("id_pedido").cast("string"))
    rows = only_authorised(typed(numbered, schemas.ORDER_LINES, "strict"))
    return rows if removed_centres is None else rows_absent(rows, removed_centres, "folio_cdf", "id_ceda_agricultura")


def load_order_summary(raw: DataFrame) -> DataFrame:
    """Order totals per centre."""
    return typed(raw, schemas.ORDER_SUMMARY, "strict")


def load_field_reports(raw: DataFrame) -> DataFrame:
    """Daily reports of the centres."""
    return typed(raw, schemas.FIELD_REPORTS)


def load_deliveries(raw: DataFrame, corrected: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Deliveries: bag counts and surface without a value count 0, so do tons."""
    rows = typed(raw, schemas.DELIVERIES, dates=parse_date_iso_first)
    if removed is not None:
        rows = rows_absent(rows, removed, "acuse_estatal")
    if corrected is not None:
        rows = rows.unionByName(typed(corrected, schemas.DELIVERIES, dates=parse_date_iso_first))
    zero = ("dap_anio_actual", "urea_anio_actual", "dap_remanente", "urea_remanente", "superficie_apoyada")
    return rows.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
        **{c: fill_zero_numeric(F.col(c)).cast("decimal(18,3)") for c in ("ton_dap_entregada", "ton_urea_entregada")}})


def load_projection(raw: DataFrame) -> DataFrame:
    """Planned supply per state and day."""
    return align_to_schema(typed(raw, schemas.PROJECTION, dates=parse_date_iso_first), schemas.PROJECTION)
