"""Column profiles (P) and document rules (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import register
from granero.operators import documents, profiling

# ---- profiles ------------------------------------------------------------------------------------

TEXTS = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS o_orderpriority FROM orders"""
NAMES = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _texts(r):
    return r.raw("orders").selectExpr(
        "cast(o_orderkey AS string) AS o_orderkey", "cast(o_custkey AS string) AS o_custkey", "o_orderstatus",
        "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS o_totalprice", "date_format(o_orderdate, 'yyyy-MM-dd') AS o_orderdate",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS o_orderpriority")


CELLS = "(" + " UNION ALL ".join(f"SELECT '{c}' AS columna, {c} AS valor FROM ({TEXTS}) t" for c in NAMES) + ")"
_NUMBER = r"regexp_full_match(valor, '[+-]?\d+(\.\d+)?')"
PROFILE = rf"""
SELECT columna, count(*) FILTER (valor <> '') AS no_nulos, max(length(valor)) FILTER (valor <> '') AS longitud_maxima,
  coalesce(bool_and(regexp_full_match(valor, '[+-]?\d+')) FILTER (valor <> ''), FALSE) AS es_entero,
  coalesce(bool_and({_NUMBER}) FILTER (valor <> ''), FALSE) AS es_numerico,
  max(length(regexp_extract(valor, '^[+-]?(\d+)', 1))) FILTER (valor <> '' AND {_NUMBER}) AS digitos_enteros,
  max(length(regexp_extract(valor, '\.(\d+)$', 1))) FILTER (valor <> '' AND {_NUMBER}) AS digitos_decimales
FROM {CELLS} c GROUP BY columna"""
register("p1_column_profile", lambda r: profiling.column_profile(_texts(r)), "", f"""
SELECT *, CASE WHEN es_numerico THEN digitos_enteros + digitos_decimales END AS precision_sugerida,
  CASE WHEN es_numerico THEN digitos_decimales END AS escala_sugerida FROM ({PROFILE}) p""")
register("p2_infer_types_date_first", lambda r: profiling.infer_types_date_first(_texts(r)), "", rf"""
SELECT columna, n AS celdas, f AS fechas, CASE WHEN f >= n * 0.9 THEN 'date' WHEN e THEN 'integer' WHEN m THEN 'numeric' ELSE 'text' END AS tipo
FROM (SELECT columna, count(*) AS n, count(*) FILTER (columna = 'o_orderdate') AS f, bool_and(regexp_full_match(valor, '[+-]?\d+')) AS e,
  bool_and({_NUMBER}) AS m FROM {CELLS} c WHERE valor <> '' GROUP BY columna) x""")
register("p3_infer_types_regex", lambda r: profiling.infer_types_regex(_texts(r)), "", r"""
SELECT columna, count(*) FILTER (valor IS NULL) AS nulos, count(DISTINCT valor) AS distintos,
  CASE WHEN bool_and(regexp_full_match(valor, '\d+')) THEN 'INTEGER' WHEN bool_and(regexp_full_match(valor, '\d+\.\d+')) THEN 'NUMERIC(10,2)'
  WHEN bool_and(regexp_full_match(valor, '\d{4}-\d{2}-\d{2}')) THEN 'DATE' ELSE 'TEXT' END AS tipo FROM """ + CELLS + " c GROUP BY columna")
_LINE = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate").split()


def _line_texts(r):
    numbers = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return r.raw("lineitem").select(*[F.col(c).cast("decimal(18,2)").cast("string").alias(c) if c in numbers else
                                      F.date_format(c, "yyyy-MM-dd").alias(c) if c == "l_shipdate" else F.col(c).cast("string").alias(c) for c in _LINE])


_LINE_KIND = {"l_returnflag": "TEXT", "l_linestatus": "TEXT", "l_shipdate": "DATE", **dict.fromkeys(
    ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "NUMERIC(10,2)")}
register("p3_infer_types_whole_table", lambda r: profiling.infer_types_regex(_line_texts(r)), "", " UNION ALL ".join(
    f"SELECT '{c}' AS columna, 0 AS nulos, count(DISTINCT {f'CAST({c} AS DECIMAL(18,2))' if _LINE_KIND.get(c, '').startswith('NUM') else c}) AS distintos, "
    f"'{_LINE_KIND.get(c, 'INTEGER')}' AS tipo FROM lineitem" for c in _LINE), big="nulos")
register("p4_suggest_schema", lambda r: profiling.suggest_schema(_texts(r).withColumnsRenamed({
    "o_orderkey": "acuse_estatal", "o_orderpriority": "nombre_prioridad"})), "", """
SELECT 'acuse_estatal' AS columna, 'VARCHAR(' || greatest(10, max(length(CAST(o_orderkey AS VARCHAR)))) || ')' AS tipo_sugerido FROM orders
UNION ALL SELECT 'o_custkey', 'INTEGER' UNION ALL SELECT 'o_orderstatus', 'VARCHAR(1)'
UNION ALL SELECT 'o_totalprice', CASE WHEN bool_and(CAST(o_totalprice AS DECIMAL(18,2)) % 1 = 0) THEN 'INTEGER' ELSE 'FLOAT' END FROM orders
UNION ALL SELECT 'o_orderdate', 'DATE'
UNION ALL SELECT 'nombre_prioridad', 'VARCHAR(' || greatest(10, max(length(o_orderpriority))) || ')' FROM orders WHERE o_orderstatus <> 'P'""")
register("p5_inventory", lambda r: profiling.inventory(r.raw("lineitem"), "lineitem"), "", """
SELECT 'lineitem' AS tabla, count(*) AS registros, 11 AS num_columnas,
  'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate' AS columnas FROM lineitem""")
register("p6_format_survey", lambda r: profiling.format_survey(r.raw("orders").selectExpr("""CASE o_orderstatus
    WHEN 'F' THEN date_format(o_orderdate, 'd/M/yyyy') WHEN 'O' THEN date_format(o_orderdate, 'yyyy-MM-dd') END AS fecha"""), "fecha"), "", """
SELECT CASE o_orderstatus WHEN 'F' THEN repeat('9', length(CAST(day(o_orderdate) AS VARCHAR))) || '/' || repeat('9', length(CAST(month(o_orderdate) AS VARCHAR))) || '/9999'
  WHEN 'O' THEN '9999-99-99' END AS formato, count(*) AS filas FROM orders GROUP BY 1""")

# ---- documents -----------------------------------------------------------------------------------


def _score(words, text: str) -> str:
    return " + ".join("CAST(contains({}, '{}') AS INTEGER)".format(text, w.replace("'", "''")) for w in words)


# keywords that occur in the test texts, beside the fixed ones
LOCAL_KEYWORDS = {"UNO": ("heed", "the", "qui"), "DOS": ("nicht", "le ", "und"), "TRES": ("http", "@", "0"), "CUATRO": ("xyzzy",)}


def _classifier_sql(table: str, key: str, text: str, classes) -> str:
    scores = ", ".join(f"{_score(w, f'lower({text})')} AS s{i}" for i, w in enumerate(classes.values()))
    best = f"greatest({', '.join(f's{i}' for i in range(len(classes)))})"
    arms = " ".join(f"WHEN s{i} = {best} THEN '{n}'" for i, n in enumerate(classes))
    return (f"SELECT {key}, CASE WHEN {best} = 0 THEN 'NO IDENTIFICADO' {arms} END AS tipo, {best} AS coincidencias "
            f"FROM (SELECT {key}, {scores} FROM {table}) s")


register("x1_classify_documents", lambda r: documents.classify_documents(r.raw("documents").select("doc_id", "text"), "text").drop("text"), "",
         _classifier_sql("documents", "doc_id", "text", documents.CLASS_KEYWORDS))
register("x1_classify_local_keywords", lambda r: documents.classify_documents(
    r.raw("documents").select("doc_id", "text"), "text", LOCAL_KEYWORDS).drop("text"), "",
         _classifier_sql("documents", "doc_id", "text", LOCAL_KEYWORDS))


def _checklist(r):
    pages = r.raw("pages").select(F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("grupo"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("persona"),
                                  F.col("url").alias("archivo"), F.col("html").alias("texto"))
    return documents.document_checklist(pages, "grupo", "persona", "archivo", "texto")


register("x2_document_checklist", _checklist, "", "SELECT regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS grupo, regexp_extract(url, '^https?://([^/]+)', 1) AS persona, " + ", ".join(
    f"CASE WHEN max(CAST({_score(w, 'lower(html)')} > 0 AS INTEGER)) = 1 THEN '✔️ OCR' WHEN max(CAST({_score(w, 'lower(url)')} > 0 AS INTEGER)) = 1 "
    f"THEN '✔️ nombre' ELSE '❌' END AS \"{k}\"" for k, w in documents.CHECKLIST_KEYWORDS.items()) + " FROM pages GROUP BY 1, 2")
PLACE = r"([A-Za-z]+ [A-Za-z]+) the "
register("x3_pages_by_place", lambda r: r.raw("documents").groupBy(documents.place_of(F.col("text"), PLACE).alias("lugar")).agg(F.count("*").alias("paginas")), "", rf"""
SELECT CASE WHEN regexp_matches(text, '{PLACE}') THEN upper(a[1]) || lower(substr(a, 2)) || '_' || upper(b[1]) || lower(substr(b, 2)) ELSE 'estado_desconocido' END AS lugar,
  count(*) AS paginas
FROM (SELECT text, split_part(regexp_extract(text, '{PLACE}', 1), ' ', 1) AS a, split_part(regexp_extract(text, '{PLACE}', 1), ' ', 2) AS b FROM documents) d GROUP BY 1""")
