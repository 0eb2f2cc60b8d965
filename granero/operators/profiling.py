"""Column profiles and type suggestions, computed as aggregates over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import DATE_FORMATS, parse_date

# The shapes that the type checks look for.
INTEGER = r"^\d+$"
DECIMAL = r"^\d+\.\d+$"
SIGNED_INTEGER = r"^[+-]?\d+$"
SIGNED_NUMBER = r"^[+-]?\d+(\.\d+)?$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"
DATE = r"^\d{4}-\d{2}-\d{2}$"


def as_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per cell as (columna, valor text). A map-only step."""
    names = list(columns or df.columns)
    cells = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").cast("string").alias("valor"))
                      for c in names])
    return df.select(F.explode(cells).alias("c")).select("c.columna", "c.valor")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column the filled cells, longest text, number shape, digits and a suggested precision and scale.

    One row per column comes out of partial aggregates, whatever the table size.
    """
    v = F.trim("valor")
    filled = F.col("valor").isNotNull() & (v != "")
    digits = F.regexp_extract(v, r"^[+-]?(\d+)", 1)
    scale = F.regexp_extract(v, r"\.(\d+)$", 1)
    ent = F.max(F.when(filled & v.rlike(SIGNED_NUMBER), F.length(digits)))
    dec = F.max(F.when(filled & v.rlike(SIGNED_NUMBER), F.length(scale)))
    is_num = F.coalesce(F.bool_and(F.when(filled, v.rlike(SIGNED_NUMBER))), F.lit(False))
    out = as_long(df, columns).groupBy("columna").agg(
        F.count_if(filled).alias("no_nulos"),
        F.max(F.when(filled, F.length(v))).alias("longitud_maxima"),
        F.coalesce(F.bool_and(F.when(filled, v.rlike(SIGNED_INTEGER))), F.lit(False)).alias("es_entero"),
        is_num.alias("es_numerico"),
        ent.alias("digitos_enteros"), dec.alias("digitos_decimales"))
    precision = F.when(F.col("es_numerico"), F.col("digitos_enteros") + F.col("digitos_decimales"))
    return out.withColumns({"precision_sugerida": precision,
                            "escala_sugerida": F.when(F.col("es_numerico"), F.col("digitos_decimales"))})


def infer_types_date_first(df: DataFrame, share: float = 0.9, formats: Sequence[str] = DATE_FORMATS,
                           columns: Sequence[str] | None = None) -> DataFrame:
    """Date when at least `share` of the filled cells parse, then integer, numeric, text. Whole columns."""
    v = F.trim("valor")
    filled = as_long(df, columns).filter(F.col("valor").isNotNull() & (v != ""))
    stats = filled.groupBy("columna").agg(
        F.count("*").alias("celdas"),
        F.count_if(parse_date(v, formats).isNotNull()).alias("fechas"),
        F.bool_and(v.rlike(SIGNED_INTEGER)).alias("enteros"), F.bool_and(v.rlike(SIGNED_NUMBER)).alias("numeros"))
    kind = (F.when(F.col("fechas") >= F.col("celdas") * share, "date").when(F.col("enteros"), "integer")
            .when(F.col("numeros"), "numeric").otherwise("text"))
    return stats.select("columna", "celdas", "fechas", kind.alias("tipo"))


def infer_types_regex(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """SQL type by text shape, with NULL and distinct counts.

    Cells are first counted per distinct value (combined before the shuffle), so repeated values cost nothing more.
    """
    values = as_long(df, columns).groupBy("columna", "valor").agg(F.count("*").alias("n"))
    v = F.col("valor")

    def every(pattern: str):
        return F.coalesce(F.bool_and(F.when(v.isNotNull(), v.rlike(pattern))), F.lit(False))

    return values.groupBy("columna").agg(
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("nulos"),
        F.count_if(v.isNotNull()).alias("distintos"),
        F.when(every(INTEGER), "INTEGER").when(every(DECIMAL), "NUMERIC(10,2)").when(every(TIMESTAMP), "TIMESTAMP")
        .when(every(DATE), "DATE").otherwise("TEXT").alias("tipo"))


# Parts of a column's name that make it text or a key, whatever its values.
TEXT_NAMES = ("nombre", "apellido", "estado", "municipio", "localidad", "sexo", "cultivo", "estatus", "regimen", "etapa",
              "cader", "ddr", "cuadernillo")
KEY_NAMES = ("clave", "cdf_entrega", "acuse")


def suggest_schema(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column type suggestion. Names of texts and keys come first (keys keep their zeros), then the values: all ISO
    dates, any letter, whole numbers, numbers. One aggregate over the cells."""
    v = F.trim("valor")
    stats = as_long(df, columns).groupBy("columna").agg(
        F.max(F.length(v)).alias("largo"), F.bool_and(v.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("fechas"),
        F.bool_or(v.rlike("[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]")).alias("letras"), F.count(v.try_cast("double")).alias("numeros"),
        F.bool_and(v.try_cast("double") % 1 == 0).alias("enteros"))
    name, size = F.lower("columna"), F.coalesce("largo", F.lit(1))

    def named(parts: Sequence[str]):
        found = F.lit(False)
        for part in parts:
            found = found | name.contains(part)
        return found

    def varchar(length):
        return F.concat(F.lit("VARCHAR("), length.cast("string"), F.lit(")"))

    kind = (F.when(named(TEXT_NAMES), varchar(F.greatest(size, F.lit(10)))).when(name.contains("curp"), F.lit("VARCHAR(18)"))
            .when(named(KEY_NAMES), varchar(F.greatest(size, F.lit(10)))).when(F.col("fechas"), F.lit("DATE"))
            .when(F.col("letras"), varchar(size)).when((F.col("numeros") > 0) & F.col("enteros"), F.lit("INTEGER"))
            .when(F.col("numeros") > 0, F.lit("FLOAT")).otherwise(varchar(size)))
    return stats.select("columna", kind.alias("tipo_sugerido"))


def inventory(df: DataFrame, name: str) -> DataFrame:
    """P5: row count and column names."""
    return df.agg(F.count("*").alias("registros")).select(
        F.lit(name).alias("tabla"), "registros", F.lit(len(df.columns)).alias("num_columnas"),
        F.lit(",".join(df.columns)).alias("columnas"))


def format_survey(df: DataFrame, column: str) -> DataFrame:
    """How often each text layout occurs, digits shown as 9; NULL is a layout of its own."""
    return df.groupBy(F.regexp_replace(F.col(column), r"\d", "9").alias("formato")).agg(F.count("*").alias("filas"))
