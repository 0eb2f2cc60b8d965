from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from granero.operators import dedupe, documents, profiling, series
from granero.plans import directory, orders

d = dt.date


def daily(frame, *pairs):
    return frame([(a, D(str(b)) if b is not None else None) for a, b in pairs], "fecha date, v decimal(18,3)")


def test_cumulative_skips_days_without_a_value(frame, rows):
    df = daily(frame, (d(2025, 1, 1), 2), (d(2025, 1, 2), 0), (d(2025, 1, 3), None), (d(2025, 1, 4), 3))
    assert rows(series.cumulative(df, "v", "a")) == [(d(2025, 1, 1), 2), (d(2025, 1, 4), 5)]


def test_gaps_without_any_day_are_zero(frame):
    one = daily(frame, (d(2025, 1, 1), 2), (d(2025, 1, 9), 5))
    none = daily(frame, (d(2025, 1, 9), 5))
    r = series.gaps_as_of({"proyectado": (one, "v"), "abasto": (one, "v"), "entregado": (none, "v"), "pedido": (none, "v")}, d(2025, 1, 9)).first()
    assert (r.proyectado, r.entregado, r.pedidos_por_atender, r.inventario_mas_transito) == (2, 0, -2, 2)


def test_weekly_peak_takes_the_first_of_a_tie(frame, rows):
    df = daily(frame, (d(2024, 12, 30), 5), (d(2024, 12, 31), 5), (d(2025, 1, 3), 9), (d(2025, 1, 4), 9), (d(2025, 1, 6), 1))
    assert rows(series.weekly_peak_days(df, ["v"])) == [(2025, 1, d(2024, 12, 30), 5), (2025, 2, d(2025, 1, 6), 1)]


def test_penultimate_needs_two_days(frame):
    assert series.penultimate_date(daily(frame, (d(2025, 1, 1), 1))).count() == 0
    assert series.penultimate_date(daily(frame, (d(2025, 1, 1), 1), (d(2025, 1, 5), 1))).first()[0] == d(2025, 1, 1)


def test_label_days(frame):
    df = daily(frame, (d(2025, 1, 3), 1), (d(2025, 1, 6), 2), (d(2025, 1, 7), 3), (d(2025, 1, 8), 10), (d(2025, 1, 10), 1), (d(2025, 1, 13), 1), (d(2025, 1, 14), 1))
    keep = {r.fecha.day for r in series.label_days(df, ["v"]).collect()}
    drop = {r.fecha.day for r in series.label_days(df, ["v"], drop_last_friday=True).collect()}
    assert keep == {3, 7, 8, 10, 13} and drop == {3, 7, 8, 13}
    assert series.quantile_of(frame([(1,), (2,), (3,), (10,)], "v int"), "v", 0.75).first()[0] == 4.75


def test_gap_weeks_stay_empty(frame, rows):
    df = daily(frame, (d(2025, 1, 4), 1), (d(2025, 1, 5), 2), (d(2025, 1, 25), 4))
    assert rows(series.saturday_week_sums(df, ["v"])) == [
        (d(2025, 1, 4), 1, 1), (d(2025, 1, 11), 2, 2), (d(2025, 1, 18), 3, None), (d(2025, 1, 25), 4, 4)]


def test_outer_join_by_date(frame, rows):
    a = frame([(d(2025, 1, 1), 1)], "fecha date, a int")
    b = frame([(d(2025, 1, 2), 2)], "fecha date, b int")
    assert rows(dedupe.full_outer_by_date(a, b)) == [(d(2025, 1, 1), 1, 0), (d(2025, 1, 2), 0, 2)]


def test_update_never_multiplies_rows(frame, rows):
    df = frame([("a", "1"), ("b", "2"), (None, "3"), ("c", None)], "k string, v string")
    src = frame([(" A ", "9"), ("a", "7"), ("B", None), ("b", "2"), ("c", "5"), (None, "8")], "k string, v string")
    up = F.upper(F.trim("k"))
    got = dedupe.update_from(df, src, up, up, "v", F.col("v"))
    assert rows(got) == [(None, "3"), ("a", "7"), ("b", "2"), ("c", "5")]


def test_updates_of_several_columns_come_from_one_row(frame, rows):
    df = frame([("a", "1", "1"), ("b", "2", "2"), ("z", "3", "3")], "k string, v string, w string")
    src = frame([("a", "8", "5"), ("a", "7", "6"), ("b", None, None)], "k string, v string, w string")
    key, values = F.col("k"), {"v": F.col("v"), "w": F.col("w")}
    assert rows(dedupe.update_columns(df, src, key, key, values)) == [("a", "7", "6"), ("b", "2", "2"), ("z", "3", "3")]
    assert rows(dedupe.update_columns(df, src, key, key, values, empty="set")) == [("a", "7", "6"), ("b", None, None), ("z", "3", "3")]


def test_removal_list_keeps_null_keys(frame, rows):
    df = frame([("a",), (None,), ("b",)], "k string")
    gone = frame([("a",), (None,)], "k string")
    assert rows(dedupe.rows_absent(df, gone, "k")) == [(None,), ("b",)]
    assert rows(dedupe.rows_present(df, gone, "k")) == [("a",)]


def test_difference_report_ignores_equal_nulls(frame, rows):
    a = frame([("1", None, 2), ("2", 1, None), ("3", 1, 1), ("9", 1, 1)], "k string, x int, y int")
    b = frame([("1", None, 2), ("2", 1, 3), ("3", 1, 1)], "k string, x int, y int")
    assert rows(dedupe.difference_report(a, b, "k", ["x", "y"]).select("k", "y", "y_ref")) == [("2", None, 3)]


def test_lookup_takes_the_last_value(frame, rows):
    df = frame([("a", "old"), ("z", "old")], "k string, v string")
    lookup = frame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, w string")
    assert rows(dedupe.map_lookup(df, lookup, "k", {"v": "w"}, "n")) == [("a", "y"), ("z", None)]


def test_order_totals_default(frame):
    centres = frame([("A", "E"), ("B", "E")], "id_ceda_agricultura string, estado string")
    summary = frame([("A", D("1"), None, D("2"))], "folio_cdf string, dap_solicitado decimal(18,3), urea_solicitada decimal(18,3), dap_por_suministrar decimal(18,3)")
    got = {r.id_ceda_agricultura: r for r in orders.order_summary_by_centre(centres, summary).collect()}
    assert (got["A"].dap_solicitado, got["A"].urea_solicitada, got["B"].dap_por_suministrar) == (1, 3, 3)


def test_comments_keep_silent_centres(frame):
    centres = frame([("A", "U", "E", "Z", "n"), ("B", "U", "E", "Z", "n")],
                    "id_ceda_agricultura string, coordinacion_estatal string, estado string, zona_operativa string, nombre_cedas string")
    comments = frame([(1, "A", "x", dt.datetime(2025, 1, 1)), (2, "A", "y", dt.datetime(2025, 1, 2)), (3, "Q", "z", None)],
                     "id bigint, id_ceda_agricultura string, comentario string, fecha timestamp_ntz")
    got = sorted((r.id_ceda_agricultura, r.comentario or "") for r in orders.comments_by_centre(centres, comments).collect())
    assert got == [("A", "x"), ("A", "y"), ("B", "")]


def test_directory(frame):
    schema = ("estado string, coordinacion_estatal string, zona_operativa string, id_ceda_agricultura string, responsable_cedas string, "
              "rc_correo string, rc_telefono string, coordinador_operativo string, coz_correo string, coz_telefono string")
    centres = frame([("E", "U", "Z", "A", None, None, "1", "Coord 1", "m", "2"), ("E", "U", "Z", "B", "Resp", "r", "1", "Coord 2", "m", "2"),
                     ("E", "U", "Y", "C", "Resp", "r", "1", None, None, None)], schema)
    now = dt.datetime(2025, 1, 1)
    built = directory.build_directory(centres, now)
    zone = built.filter(F.col("cargo") == directory.ZONE_ROLE).collect()
    assert [(r.id_ceda_agricultura, r.nombre_completo) for r in zone] == [("N/A", "Coord 1")]
    assert built.filter("id_ceda_agricultura = 'A'").first().nombre_completo == ""
    other = built.limit(1).withColumn("cargo", F.lit("DIRECTOR"))
    refreshed = directory.refresh_directory(built.unionByName(other), centres, now)
    assert refreshed.count() == 5 and refreshed.filter("cargo = 'DIRECTOR'").count() == 1


def test_document_classes(frame):
    texts = ["Instituto Nacional ELECTORAL", "SAT", "nada que ver", None, "recibo de luz y agua, saldo"]
    df = frame(list(enumerate(texts)), "i int, t string")
    got = [(r.tipo, r.coincidencias) for r in documents.classify_documents(df, "t").orderBy("i").collect()]
    assert got == [("INE", 2), ("RFC", 1), ("NO IDENTIFICADO", 0), ("NO IDENTIFICADO", 0), ("COMPROBANTE DE DOMICILIO", 3)]


def test_checklist_prefers_content(frame):
    df = frame([("g", "p", "CURP.pdf", "nada"), ("g", "p", "x.pdf", "la CURP"), ("g", "p", "rfc.pdf", None), ("g", "q", "x.pdf", "")],
               "grupo string, persona string, archivo string, texto string")
    got = {r.persona: r for r in documents.document_checklist(df, "grupo", "persona", "archivo", "texto").collect()}
    assert (got["p"]["CURP"], got["p"]["RFC"], got["p"]["CV"], got["q"]["CURP"]) == (documents.BY_CONTENT, documents.BY_NAME, documents.MISSING, documents.MISSING)


def test_statement_place(frame):
    df = frame([("firmado en ciudad de méxico a 01 de abril de 2025",), ("sin lugar",)], "t string")
    got = [r[0] for r in df.select(documents.place_of(F.col("t"), documents.STATEMENT_PLACE)).collect()]
    assert got == ["Firmado_En_Ciudad_De_México", "estado_desconocido"]


def test_profile(frame):
    df = frame([("12", "1.50", "2025-01-01", "a"), ("7", "10", "2025-01-02", None), (None, "", "2025-01-02", "abc")], "n string, x string, f string, t string")
    got = {r.columna: r for r in profiling.column_profile(df).collect()}
    assert (got["n"].no_nulos, got["n"].es_entero, got["x"].precision_sugerida, got["x"].escala_sugerida, got["t"].longitud_maxima) == (2, True, 4, 2, 3)
    kinds = {r.columna: r.tipo for r in profiling.infer_types_date_first(df).collect()}
    assert kinds == {"n": "integer", "x": "numeric", "f": "date", "t": "text"}
    regex = {r.columna: (r.nulos, r.distintos, r.tipo) for r in profiling.infer_types_regex(df).collect()}
    assert regex == {"n": (1, 2, "INTEGER"), "x": (0, 3, "TEXT"), "f": (0, 2, "DATE"), "t": (1, 2, "TEXT")}
    assert {r[0]: r[1] for r in profiling.suggest_schema(df).collect()} == {"n": "INTEGER", "x": "FLOAT", "f": "DATE", "t": "VARCHAR(3)"}
    keys = frame([("0012", "0007", "junk"), ("0013", "8", "2025-01-01")], "acuse_estatal string, folio string, fecha_x string")
    assert {r[0]: r[1] for r in profiling.suggest_schema(keys).collect()} == {
        "acuse_estatal": "VARCHAR(10)", "folio": "INTEGER", "fecha_x": "VARCHAR(10)"}
    assert {r.formato: r.filas for r in profiling.format_survey(df, "t").collect()} == {"a": 1, None: 1, "abc": 1}
