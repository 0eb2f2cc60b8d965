from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from granero import schemas
from granero.operators import dedupe, positions
from granero.plans import batch, loads, registry_load
from granero.session import scratch_path, shared_folder
from granero.sources import readers, sinks
from granero.streaming import field_reports as fr


def put(folder, name, *lines, bom=False):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


def test_union_by_name_over_files(spark, tmp_path, rows):
    a = put(tmp_path, "a.csv", "acuse,estatus,zona", "001,x,n", bom=True)
    b = put(tmp_path, "b.csv", "estatus,acuse", "y,002")
    df = readers.read_many(spark, [b, a])
    assert df.columns == ["acuse", "estatus", "zona"]
    assert rows(df) == [("001", "x", "n"), ("002", "y", None)]


def test_masks_and_excluded_files(spark, tmp_path):
    for name in ("padron_1.csv", "padron_2.csv", "padron_rechazos.csv", "otro.csv"):
        put(tmp_path, name, "acuse", name)
    df = readers.read_text_csv(spark, str(tmp_path), mask="padron*.csv")
    kept = readers.tag_source_file(readers.select_files(df, ["rechazos"]))
    assert sorted(r.archivo for r in kept.collect()) == ["padron_1.csv", "padron_2.csv"]


def test_keep_first_and_last_follow_file_order(spark, tmp_path):
    put(tmp_path, "1.csv", "k,v", "a,uno", "b,uno", "a,dos")
    put(tmp_path, "2.csv", "k,v", "a,tres", "c,tres")
    df = readers.with_file_order(readers.read_text_csv(spark, str(tmp_path)))
    first = {r.k: r.v for r in dedupe.first_per_key(df, ["k"], ["orden_archivo"]).collect()}
    last = {r.k: r.v for r in dedupe.last_per_key(df, ["k"], ["orden_archivo"]).collect()}
    assert first == {"a": "uno", "b": "uno", "c": "tres"} and last == {"a": "tres", "b": "uno", "c": "tres"}


def test_registry_load(spark, tmp_path):
    long_key = "K" * 31
    put(tmp_path, "1.csv", "Acuse Estatal,Estatus,ID CEDA,DAP (ton),Urea (ton),Fecha de Publicación,Superficie,Sobra",
        "R1,primero,A,\"1,0005\",2,04/02/25 0:00,1,x", "R2,uno,A,12.5,x,2025-02-04,2,x", f"{long_key},uno,A,1,1,,3,x", " ,uno,A,1,1,,3,x",
        "R3," + "e" * 40 + ",A,1,1,ayer,3,x")
    put(tmp_path, "2.csv", "Estatus,Acuse Estatal", "segundo,R1")
    raw = readers.with_file_order(readers.read_many(spark, [str(tmp_path / "1.csv")]))
    more = readers.with_file_order(readers.read_many(spark, [str(tmp_path / "2.csv")]))
    both = raw.unionByName(more, allowMissingColumns=True)
    got = {r.acuse_estatal: r for r in registry_load.typed_registry(both, "orden_archivo").collect()}
    assert set(got) == {"R1", "R2", "R3"}
    assert got["R1"].estatus == "segundo"  # the later file wins
    assert got["R2"]["dap_(ton)"] is None and got["R2"].fecha_de_publicacion == dt.date(2025, 2, 4) and got["R2"].superficie == 2
    assert got["R3"].estatus == "e" * 29 and got["R3"].fecha_de_publicacion is None
    one = {r.acuse_estatal: r for r in registry_load.typed_registry(raw, "orden_archivo").collect()}
    assert one["R1"]["dap_(ton)"] == D("1.001") and one["R1"].fecha_de_publicacion == dt.date(2025, 2, 4)
    bad = {(r.columna, r.motivo) for r in registry_load.registry_rejects(raw, "orden_archivo").collect()}
    assert bad == {("dap_(ton)", "overflow_4_3"), ("urea_(ton)", "no_convertible"), ("acuse_estatal", "pk_excede_varchar_30"),
                   ("estatus", "truncado_varchar_29"), ("fecha_de_publicacion", "fecha_no_valida")}


def test_freight_load(spark, tmp_path):
    raw = readers.read_text_csv(spark, put(
        tmp_path, "f.csv", "Folio del flete,Estatus,Toneladas iniciales,Fecha de entrega,CDF destino original,CDF destino final",
        "F1,Entregado,\"1,234.5678\",04/02/25 0:00,A,B", "F2,Autorizado,x,0000-00-00 00:00:00,A,B", "F3,Otro,1,,A,B", "F4,Entregado,1,,A,B"))
    fixed = readers.read_text_csv(spark, put(tmp_path, "c.csv", "Folio del flete,Estatus,CDF destino original", "F5,autorizado,C"))
    gone = readers.read_text_csv(spark, put(tmp_path, "r.csv", "folio_del_flete", "F4"))
    got = {r.folio_del_flete: r for r in loads.load_freight(raw, fixed, gone).collect()}
    assert set(got) == {"F1", "F2", "F3", "F5"}
    assert got["F1"].toneladas_iniciales == D("1234.568") and got["F1"].fecha_de_entrega == dt.datetime(2025, 2, 4)
    assert [got[k].id_ceda_agricultura for k in ("F1", "F2", "F3", "F5")] == ["B", "A", None, "C"]
    assert got["F2"].toneladas_iniciales is None and got["F2"].fecha_de_entrega is None


def test_moves_load_refuses_bad_dates(spark, tmp_path):
    raw = readers.read_text_csv(spark, put(tmp_path, "t.csv", "Folio transferencia,Estatus,Fecha de salida,CDF destino original,CDF destino final",
                                           "T1,Entregada,10/10/25,A,B", "T2,,10-10-25,A,B"))
    fixed = readers.read_text_csv(spark, put(tmp_path, "tc.csv", "Folio transferencia,Estatus,Fecha de salida,CDF destino original", "T2,,1/1/2025,C", "T9,,1/1/2025,D"))
    got = {r.folio_transferencia: r for r in loads.load_moves(raw, fixed).collect()}
    assert {k: v.id_ceda_agricultura for k, v in got.items()} == {"T1": "B", "T2": "C", "T9": "D"}
    bad = readers.read_text_csv(spark, put(tmp_path, "tb.csv", "Folio transferencia,Fecha de salida", "T1,ayer"))
    with pytest.raises(ValueError, match="fecha_de_salida"):
        loads.load_moves(bad)


def test_order_lines_keep_their_file_number(spark, tmp_path):
    raw = readers.read_text_csv(spark, put(tmp_path, "p.csv", "Folio CDF,Fecha,DAP,Estatus pedido detalle", "A,2025-01-02,1.5,Pendiente", "B,2025-01-02,2,Autorizado",
                                           "A,2025-01-03,-,autorizado", "C,2025-01-03,N/A,Autorizado", "B,2025-01-04,4,Autorizado"))
    gone = spark.createDataFrame([("C",)], "id_ceda_agricultura string")
    got = loads.load_order_lines(readers.with_file_order(raw), "orden_archivo", gone).orderBy("id_pedido").collect()
    assert [(r.id_pedido, r.folio_cdf, r.dap) for r in got] == [(2, "B", D("2.000")), (5, "B", D("4.000"))]


def test_deliveries_load_fills_zero(spark, tmp_path):
    raw = readers.read_text_csv(spark, put(tmp_path, "d.csv", "Acuse estatal,Ton DAP entregada,DAP remanente,Fecha entrega", "007,x,,2025-01-02 10:00:00", "008,1.5,3.0,2/1/2025"))
    got = {r.acuse_estatal: r for r in loads.load_deliveries(raw).collect()}
    assert (got["007"].ton_dap_entregada, got["007"].dap_remanente, got["008"].dap_remanente) == (0, 0, 3)
    assert got["007"].fecha_entrega == got["008"].fecha_entrega == dt.date(2025, 1, 2)


@pytest.mark.parametrize("n, even, halves", [(0, [], []), (1, [1], [2]), (5, [1, 2, 3, 4, 5], [1, 1, 2, 2, 2]), (7, [1, 1, 2, 2, 3, 4, 5], [1, 1, 1, 2, 2, 2, 2])])
def test_splits(spark, n, even, halves):
    df = spark.range(n).select((F.lit(100) - F.col("id")).alias("k"))
    assert [r.parte for r in positions.split_even(df, ["k"], 5).orderBy("k").collect()] == even
    assert [r.parte for r in positions.split_halves(df, ["k"]).orderBy("k").collect()] == halves


def test_numbering_with_a_hot_leading_value(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")).repartition(16)
    got = positions.number_rows(df, ["a", "b"], "n").orderBy("a", "b")
    assert [r.n for r in got.collect()] == list(range(1, 20001))


@pytest.mark.parametrize("values, q, expected", [([1, 2, 3, 10], 0.75, 4.75), ([5], 0.5, 5.0), ([1, 1, 1, 9], 0.5, 1.0), ([1, 1, 1, 9], 1.0, 9.0), ([], 0.5, None),
                                                 ([None, 4, 2], 0.5, 3.0)])
def test_exact_quantile(spark, values, q, expected):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert positions.exact_quantile(df, "v", q).first()[0] == expected


def test_bom_and_alignment(spark, tmp_path):
    path = sinks.export_csv(spark.createDataFrame([("á", 1)], "estado string, n int"), str(tmp_path / "x"))
    first = next(p for p in sorted((tmp_path / "x").glob("part-*.csv"))).read_bytes()
    assert path and first.startswith(b"\xef\xbb\xbfestado,n")
    aligned = sinks.align_to_schema(spark.createDataFrame([(1,)], "n int"), schemas.layout("m text, n bigint"))
    assert aligned.collect()[0] == (None, 1)


def test_ingest_is_idempotent(spark, tmp_path, rows):
    schema = "fecha_y_hora timestamp_ntz, id_ceda_agricultura string, bultos_dap int, quien_reporta string"
    t = dt.datetime(2025, 1, 1, 8)
    first = spark.createDataFrame([(t, " a1 ", 5, "RC "), (t, "A1", 5, " rc"), (None, "a1", 5, "rc"), (t, "a1", 6, "rc")], schema)
    landing, table = str(tmp_path / "in"), scratch_path(spark, "reportes")
    first.write.parquet(landing)

    def run(control):
        stream = spark.readStream.schema(first.schema).parquet(landing)
        fr.start_ingest(stream, table, control).awaitTermination()
        return rows(fr.read_reports(first, table).select("fecha_y_hora", "id_ceda_agricultura", "bultos_dap", "quien_reporta"))

    control = scratch_path(spark, "control")
    expected = [(t, "A1", 5, "rc"), (t, "A1", 6, "rc")]
    assert run(control) == expected
    assert run(control) == expected  # nothing new
    assert run(scratch_path(spark, "control")) == expected  # everything read again
    first.withColumn("fecha_y_hora", F.lit(t + dt.timedelta(days=3)).cast("timestamp_ntz")).write.mode("append").parquet(landing)
    assert len(run(control)) == 4


def test_year_overwrite_leaves_other_years(spark):
    path = scratch_path(spark, "anios")
    sinks.overwrite_table(spark.createDataFrame([(2025, "a"), (2026, "b")], "anio int, v string"), path, ["anio"])
    sinks.overwrite_table(spark.createDataFrame([(2026, "c")], "anio int, v string"), path, ["anio"])
    stored = spark.read.parquet(path)
    assert sorted((r.anio, r.v) for r in stored.collect()) == [(2025, "a"), (2026, "c")]
    plan = readers.table_for_year(stored, 2025)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan


def test_batch_reports_failures(spark):
    df = spark.range(3)

    def broken(_):
        raise RuntimeError("sin datos")

    steps = [batch.Step("a", ("x",), lambda t: t["x"]), batch.Step("b", ("x",), broken), batch.Step("c", ("b",), lambda t: t["b"]),
             batch.Step("d", ("a",), lambda t: t["a"].filter("id > 0"), export=True)]
    out = batch.run_daily(spark, {"x": df}, scratch_path(spark, "lote"), steps)
    assert [(o.name, o.status, o.rows) for o in out] == [("a", "ok", 3), ("b", "error", None), ("c", "omitida", None), ("d", "ok", 2)]
    assert "sin datos" in out[1].error and batch.report(spark, out).count() == 4


def test_batch_runs_twice_into_one_folder(spark):
    df, out = spark.range(3), scratch_path(spark, "lote")
    good = [batch.Step("a", ("x",), lambda t: t["x"], export=True), batch.Step("b", ("a",), lambda t: t["a"], export=True)]
    first = batch.run_daily(spark, {"x": df}, out, good)
    assert first == batch.run_daily(spark, {"x": df}, out, good) and {o.status for o in first} == {"ok"}

    def broken(_):
        raise RuntimeError("x" * 2000)

    last = batch.run_daily(spark, {"x": df}, out, [batch.Step("a", ("x",), broken), good[1]])
    assert [o.status for o in last] == ["error", "omitida"] and len(last[0].error) >= 2000
    assert not sinks.stored_exists(spark, f"{out}/a") and not sinks.stored_exists(spark, f"{out}/b")
    assert not sinks.stored_exists(spark, f"{out}/csv/b")


def test_load_steps_store_tables_and_rejects(spark, frame):
    long_folio = "F" * 28
    texts = frame([(long_folio + "1", "12345678.5"), (long_folio + "2", "3")], "`Folio del flete` string, `Toneladas iniciales` string")
    steps = [s for s in batch.load_steps() if s.name.startswith("freight")]
    out = scratch_path(spark, "cargas")
    assert [o.status for o in batch.run_daily(spark, {"freight_texto": texts}, out, steps)] == ["ok", "ok"]
    stored = {r.folio_del_flete: r.toneladas_iniciales for r in spark.read.parquet(f"{out}/freight").collect()}
    assert stored == {long_folio + "1": None, long_folio + "2": D("3.000")}
    lost = sorted((r.columna, r.clave[-1], r.motivo) for r in spark.read.parquet(f"{out}/freight_rechazos").collect())
    assert lost == [("folio_del_flete", "1", "excede_varchar_28"), ("folio_del_flete", "2", "excede_varchar_28"),
                    ("toneladas_iniciales", "1", "overflow_10_3")]


def test_strict_alignment_refuses(frame):
    with pytest.raises(ValueError, match="fecha"):
        sinks.align_to_schema(frame([("a",)], "estado string"), schemas.PROJECTION, strict=True)


def test_merge_touches_only_its_buckets(spark, frame):
    path = scratch_path(spark, "padron")
    sinks.merge_into(frame([(f"k{i}", 1) for i in range(50)], "k string, v int"), path, "k", 8)
    before = {f for f in spark.read.parquet(path).inputFiles()}
    sinks.merge_into(frame([("k1", 2), ("n", 2)], "k string, v int"), path, "k", 8)
    after = {f for f in spark.read.parquet(path).inputFiles()}
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {f"k{i}": 1 for i in range(50)} | {"k1": 2, "n": 2}
    assert 0 < len({f.rsplit("/", 2)[-2] for f in before - after}) <= 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
