from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granero.functions import classify, dates, numbers, text


def column(frame, values, kind, expr):
    df = frame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


@pytest.mark.parametrize("style, expected", [
    ("plain", "dap_(ton)/año".replace("ñ", "n")), ("strict", "dap_ton_ano"), ("parens", "dap_(ton)_ano"), ("letters", "dap_tonano"),
])
def test_header_styles(style, expected):
    assert text.normalize_header(" DÁP (ton)/Año ", style) == expected


def test_bom_is_not_part_of_a_header():
    assert text.normalize_header("﻿Acuse") == "acuse"


def test_tolerant_lookup_prefers_exact():
    assert text.find_column(["Estatus pedido", "Estatus"], "estatus") == "Estatus"
    assert text.find_column(["Clave de la CEDA"], "ceda clave") == "Clave de la CEDA"
    assert text.find_column(["a"], "b") is None


def test_dates(frame):
    values = ["2025-10-10", "10/10/2025", "10/10/25", "10-10-25", "13/02/2025", "02/13/2025", "03/04/2025", "0000-00-00", "", "x", None,
              "1/2/69", "1/2/68"]
    d = dt.date
    assert column(frame, values, "string", dates.parse_date) == [
        d(2025, 10, 10), d(2025, 10, 10), d(2025, 10, 10), d(2025, 10, 10), d(2025, 2, 13), d(2025, 2, 13), d(2025, 4, 3), None, None, None, None,
        d(1969, 2, 1), d(2068, 2, 1)]


def test_dates_with_time_and_sentinel(frame):
    assert column(frame, ["2025-02-04 00:00:00", "04/02/25 0:00", "x"], "string", dates.parse_date_iso_first) == [
        dt.date(2025, 2, 4), dt.date(2025, 2, 4), None]
    assert column(frame, ["x", None, "2025-01-02"], "string", dates.parse_date_or_sentinel) == [
        dt.date(1900, 1, 1), dt.date(1900, 1, 1), dt.date(2025, 1, 2)]
    assert column(frame, ["04/02/25 0:00", "4/2/2025 13:05", "2025-02-04 00:00:00", "0000-00-00 00:00:00", "x", "1/3/96 7:30"], "string",
                  dates.parse_timestamp) == [
        dt.datetime(2025, 2, 4), dt.datetime(2025, 2, 4, 13, 5), dt.datetime(2025, 2, 4), None, None, dt.datetime(1996, 3, 1, 7, 30)]


def test_numbers(frame):
    assert column(frame, ["1,234.5", " 2.5 ", "x", "", None, "nan"], "string", numbers.to_number) == [D("1234.5"), D("2.5"), None, None, None, None]
    assert column(frame, ["1,5", "x", "nan", None], "string", lambda c: numbers.to_number_decimal_comma(c, True)) == [D("1.5"), 0, 0, 0]
    assert column(frame, ["1.0005", "12.5", "9.9995", "x", "", "1,25", "-9.9"], "string", lambda c: numbers.enforce_numeric(c, 4, 3)) == [
        D("1.001"), None, None, None, None, D("1.250"), D("-9.900")]
    assert column(frame, ["1.0005", "12.5", "9.9995", "x", "", None], "string", lambda c: numbers.numeric_reject_reason(c, 4, 3)) == [
        None, "overflow_4_3", "overflow_4_3", "no_convertible", None, None]
    assert column(frame, ["123456", "-123456", "1.005", "x"], "string", lambda c: numbers.clip_to_max(c, 6, 2)) == [
        D("9999.99"), D("-9999.99"), D("1.01"), None]
    assert column(frame, ["12.0", "7", "x", None], "string", lambda c: numbers.to_int(c, 0)) == [12, 7, 0, 0]
    assert column(frame, [3, None], "int", numbers.bags_to_tons) == [D("0.075"), None]


def test_percent_of_target(frame):
    df = frame([(150, 100), (1, 3), (5, 0), (5, None), (None, 10)], "v int, m int")
    got = [r[0] for r in df.select(numbers.percent_of_target(F.col("v"), F.col("m"))).collect()]
    assert got == [100, 33, 0, 0, 0]
    assert [r[0] for r in df.select(numbers.pending(F.col("v"), F.col("m"))).collect()] == [0, 2, 0, 0, 10]


def test_text_rules(frame):
    assert column(frame, ["N/A", " - ", "n/a", "", "NAVE"], "string", text.null_tokens) == [None, None, None, None, "NAVE"]
    assert column(frame, ["Sí", "TRUE", "no", "quizás", " ", None], "string", text.to_bool) == [True, True, False, False, None, None]
    assert column(frame, ["  abcdef ", " ", None], "string", lambda c: text.enforce_text(c, 4)) == ["abcd", None, None]
    assert column(frame, ["abc", "abcde", ""], "string", lambda c: text.enforce_key(c, 4)) == ["abc", None, None]
    assert column(frame, ["ABCD0102030", "ABCD010203h99", None, ""], "string", text.sex_from_curp) == ["0", "H", None, None]


def test_full_name(frame):
    df = frame([("Ana", "Paz", "Ruiz"), ("Ana", "Paz", " "), ("Ana", "Paz", None), (None, "Paz", "Ruiz")], "n string, a string, b string")
    got = [r[0] for r in df.select(text.full_name(F.col("n"), F.col("a"), F.col("b"))).collect()]
    assert got == ["Ana Paz Ruiz", "Ana Paz", "Ana Paz", None]


def test_row_hash_tells_null_positions_apart(frame):
    df = frame([(None, "a"), ("a", None)], "x string, y string")
    a, b = [r[0] for r in df.select(text.row_hash(["x", "y"])).collect()]
    assert a != b


def test_bands_and_gaps(frame):
    assert column(frame, [0.0, 4.9, 5.0, 19.9, 20.0, -1.0, None], "double", classify.bucket_surface) == [
        "0 a 4", "0 a 4", "5 a 9", "15 a 19", "20 o más", None, None]
    values = [D("-1"), D("-1.01"), D("-0.01"), D("0"), D("0.01"), D("1.01"), D("1"), None]
    assert column(frame, values, "decimal(10,3)", classify.stock_gap_class) == [
        "faltante_menor", "faltante_grave", "sin_diferencia", "sin_diferencia", "sin_diferencia", "excedente_grave", "excedente_menor", "sin_diferencia"]
    assert column(frame, [None, 0.0, -0.5, -1.0, -10.0, 0.5, 1.0, 10.0], "double", classify.diff_category) == [
        "—", "0.000", "< -1 ton", "< -10 ton", "> -10 ton", "< 1 ton", "< 10 ton", "> 10 ton"]


def test_compliance(frame):
    today = dt.date(2025, 3, 10)
    df = frame([(dt.date(2025, 3, 10), 5), (dt.date(2025, 3, 9), 5), (dt.date(2025, 3, 4), 5), (None, 5), (None, 0), (None, None)], "d date, s int")
    got = df.select(classify.days_late(F.col("d"), today), classify.reporting_compliance(F.col("d"), today, F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(0, True), (0, True), (6, False), (999, False), (999, True), (999, True)]


def test_centre_by_status(frame):
    df = frame([("Entregado",), ("AUTORIZADO",), ("entregado ",), ("otro",), (None,)], "s string")
    o, f = F.lit("orig"), F.lit("fin")
    assert [r[0] for r in df.select(classify.assign_centre(F.col("s"), o, f)).collect()] == ["fin", "orig", None, None, None]
    moves = frame([(" Entregada ",), ("autorizada",), (None,)], "s string")
    assert [r[0] for r in moves.select(classify.assign_centre_move(F.col("s"), o, f)).collect()] == ["fin", "orig", "orig"]


def test_list_class(frame):
    assert column(frame, ["padrón NUEVO ingreso", "otro", None], "string", classify.classify_list) == [
        "NUEVO INGRESO", "ACCESO DIRECTO", "ACCESO DIRECTO"]


def test_iso_week_at_year_end(frame):
    values = [dt.date(2024, 12, 30), dt.date(2025, 1, 5), dt.date(2025, 1, 6)]
    assert column(frame, values, "date", dates.iso_week_label) == ["2025-01", "2025-01", "2025-02"]
    assert column(frame, values, "date", dates.week_ending_saturday) == [dt.date(2025, 1, 4), dt.date(2025, 1, 11), dt.date(2025, 1, 11)]
    assert dates.date_bound("31/12/2025") == dt.date(2025, 12, 31) and dates.date_bound("31-12") is None


ODD_DATES = ["2025-1-5", "2025-13-45", "0000-00-00", "5/1/2025", "05/01/25", "1/13/2025", "31-12-99", "31-12-1999", "1/31/99", "0005/1/2025", "2025/02/30", "30/2/2025",
             "+2025-1-5", "+12025-1-5", "12025-1-5", "-2025-1-5", "2025-+1-5", "2025--1-5", "5/1/025", "5/1/2", " 5/1/2025 ", "5/1/2025 10:00", "5/1/25 9:5", "2025-1-5 24:0:0",
             "2025-1-5 7:8:9", "5/1/2025 23:59", "5/1/2025\t", "5/1/2025\n", "5.1.2025", "", None, "x", "29/2/2024", "29/2/2023", "\u0665/1/2025", "2025-1-5T00:00:00", "0/1/2025", "1/0/25"]


def test_layouts_left_out_by_shape_would_not_have_fitted(frame):
    plain = lambda fs, kind: F.coalesce(*[dates._short_year(F.try_to_timestamp(F.trim("t"), F.lit(f)), f).cast(kind) for f in fs])
    values = {"a": dates.parse_date(F.col("t")), "b": plain(dates.DATE_FORMATS, "date"), "c": dates.parse_timestamp(F.col("t")),
              "d": F.when(~F.contains(F.trim("t"), F.lit("0000-")), plain(dates.TIME_FORMATS, "timestamp_ntz"))}
    got = frame([(t,) for t in ODD_DATES], "t string").select("t", *[v.cast("string").alias(k) for k, v in values.items()]).collect()
    assert [r for r in got if (r.a, r.c) != (r.b, r.d)] == [] and sum(r.a is not None for r in got) > 8 and sum(r.c is not None for r in got) > 2
    text = frame([("x",)], "t string").select(dates.parse_date(F.col("t")))._jdf.queryExecution().analyzed().toString().lower()
    assert text.count("rlike") >= len(dates.DATE_FORMATS)  # no layout is tried on text of another shape


def test_text_without_digits_is_no_number(frame):
    words = ["NaN", "Infinity", "-inf", "doce", "", None, "1e2", "1,234.5", "12.0", ".5", " 7 ", "3x", "99999999999"]
    got = frame([(t,) for t in words], "t string").select(
        numbers.to_int(F.col("t")).alias("a"), F.col("t").try_cast("double").try_cast("int").alias("b"), numbers.to_number(F.col("t")).alias("c"),
        F.replace(F.trim("t"), F.lit(","), F.lit("")).try_cast(numbers.WIDE).alias("d")).collect()
    assert [r for r in got if (r.a, r.c) != (r.b, r.d)] == []
