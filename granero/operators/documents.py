"""Keyword rules over document text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keywords per document class; the earlier class wins a tie.
CLASS_KEYWORDS: dict[str, tuple[str, ...]] = {
    "ACTA DE NACIMIENTO": ("registro civil", "acta de nacimiento", "oficialía", "libro"),
    "CURP": ("clave única de registro", "curp", "gobierno de méxico"),
    "INE": ("instituto nacional electoral", "credencial para votar", "vigencia", "electoral"),
    "RFC": ("registro federal de contribuyentes", "sat"),
    "CONSTANCIA SITUACIÓN FISCAL": ("situación fiscal", "régimen fiscal", "código postal", "sat"),
    "COMPROBANTE DE DOMICILIO": ("recibo", "cfe", "luz", "agua", "gas", "servicio", "importe"),
    "CONSTANCIA DE NO INHABILITACIÓN": ("función pública", "no se encuentra inhabilitado", "inhabilitación"),
    "ESTADO DE CUENTA": (
        "estado de cuenta", "saldo", "clabe", "cuenta", "movimientos", "banamex", "bbva", "santander", "banorte",
        "scotiabank", "número de cuenta", "gastos", "detalle de movimientos", "banco", "pago de nómina"),
    "CV": (
        "curriculum vitae", "currículum", "datos personales", "experiencia laboral", "formación académica",
        "educación", "perfil profesional", "objetivo", "referencias", "escolaridad", "periodo laboral"),
    "COMPROBANTE DE ESTUDIOS": (
        "título", "certificado", "licenciatura", "ingeniería", "universidad", "bachillerato", "cédula"),
    "CARTILLA SMN": ("servicio militar nacional", "cartilla", "defensa nacional"),
    "HOJAS ÚNICAS DE SERVICIO": ("hoja única de servicio", "fecha de ingreso", "plaza", "nómina"),
}
# Words that mark a document of a person's file, in its text or its file name.
CHECKLIST_KEYWORDS: dict[str, tuple[str, ...]] = {
    "CURP": ("curp",),
    "INE": ("ine", "identificacion", "credencial"),
    "RFC": ("rfc", "situacion", "fiscal"),
    "CV": ("cv", "curriculum"),
    "COMPROBANTE DE DOMICILIO": ("domicilio", "recibo"),
    "CONSTANCIA SITUACIÓN FISCAL": ("situación fiscal", "régimen fiscal", "sat"),
    "ACTA DE NACIMIENTO": ("nacimiento", "registro civil"),
    "ESTADO DE CUENTA": ("estado de cuenta", "clabe", "banco", "banamex", "bbva", "santander"),
    "CONSTANCIA DE NO INHABILITACIÓN": ("inhabilitacion", "función pública"),
    "COMPROBANTE DE ESTUDIOS": ("estudios", "titulo", "cedula"),
    "HOJA ÚNICA DE SERVICIO": ("hoja única", "servicio"),
    "CARTILLA SMN": ("cartilla", "smn"),
}
UNKNOWN_CLASS = "NO IDENTIFICADO"
BY_CONTENT, BY_NAME, MISSING = "✔️ OCR", "✔️ nombre", "❌"


def _hits(text: Column, words: Sequence[str]) -> Column:
    return sum((F.contains(text, F.lit(w)).cast("int") for w in words[1:]), F.contains(text, F.lit(words[0])).cast("int"))


def classify_documents(df: DataFrame, text: str, keywords: Mapping[str, Sequence[str]] = CLASS_KEYWORDS) -> DataFrame:
    """Class with the most keywords in the lower-case text, and that number.

    A map-only step. Scores go into an array in class order, so the first highest position is the winner.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    names = F.array(*[F.lit(n) for n in keywords])
    scored = df.withColumn("_scores", F.array(*[_hits(low, words) for words in keywords.values()]))
    top = F.array_max("_scores")
    return scored.select(
        *df.columns,
        F.when(top > 0, names[F.array_position("_scores", top).cast("int") - 1]).otherwise(UNKNOWN_CLASS).alias("tipo"),
        top.alias("coincidencias"))


def document_checklist(df: DataFrame, group: str, person: str, file: str, text: str,
                       keywords: Mapping[str, Sequence[str]] = CHECKLIST_KEYWORDS) -> DataFrame:
    """Per person and document type, found by content, else by file name, else missing.

    The finds are flags combined before the shuffle; no person's texts are gathered.
    """
    low, name = F.lower(F.coalesce(F.col(text), F.lit(""))), F.lower(F.coalesce(F.col(file), F.lit("")))
    found = df.select(group, person, *[
        F.when(_hits(low, words) > 0, 2).when(_hits(name, words) > 0, 1).otherwise(0).alias(kind)
        for kind, words in keywords.items()])
    best = found.groupBy(group, person).agg(*[F.max(f"`{k}`").alias(k) for k in keywords])
    return best.select(group, person, *[
        F.when(F.col(f"`{k}`") == 2, BY_CONTENT).when(F.col(f"`{k}`") == 1, BY_NAME).otherwise(MISSING).alias(k)
        for k in keywords])


def place_of(text: Column, pattern: str, unknown: str = "estado_desconocido") -> Column:
    """The place captured by the first match, words capitalised and joined by `_`."""
    place = F.trim(F.regexp_extract(text, pattern, 1))
    return F.when(F.regexp_like(text, F.lit(pattern)), F.replace(F.initcap(place), F.lit(" "), F.lit("_"))) \
        .otherwise(F.lit(unknown))


# Fixed value: the sentence that carries the place and date of a signed statement.
STATEMENT_PLACE = r"([A-ZÁÉÍÓÚÑa-záéíóúñ ]+?) a 01 de abril de 2025"
