"""Declared layouts of the programme's tables. Names and lengths are those of the landed extracts."""

from __future__ import annotations

from pyspark.sql import types as T

# How a column is written down below.
_KINDS = {
    "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType(), "ts": T.TimestampNTZType(),
    "bool": T.BooleanType(), "ton": T.DecimalType(10, 3), "dec": T.DecimalType(18, 3), "text": T.StringType(),
}


def layout(spec: str) -> T.StructType:
    """Columns as `name kind`; a number is text of that length, `p.s` a decimal."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        if kind.isdigit():
            fields.append(T.StructField(name, T.StringType(), True, {"max_len": int(kind)}))
        elif kind in _KINDS:
            fields.append(T.StructField(name, _KINDS[kind]))
        else:
            precision, scale = kind.split(".")
            fields.append(T.StructField(name, T.DecimalType(int(precision), int(scale))))
    return T.StructType(fields)


def text_limit(field: T.StructField) -> int | None:
    """Longest text a column takes, when it has a limit."""
    return field.metadata.get("max_len")


# Column names, lengths and precisions of the tables.
CENTRES = layout(
    "anio int, id_ceda_agricultura 60, coordinacion_estatal 25, estado 20, zona_operativa 40, municipio 80,"
    "localidad_cedas 80, nombre_cedas 50, bodega_concentradora 5, municipio_adicional 2600, meta_derechohabientes int,"
    "meta_superficie_ha int, meta_dap_ton dec, meta_urea_ton dec, meta_total_ton dec, largo_m dec, ancho_m dec,"
    "alto_m dec, altura_estiba_m dec, tonelaje_alm_dap dec, tonelaje_alm_urea dec, tonelaje_alm_total dec, latitud 12.8,"
    "longitud 12.8, direccion_postal 250, descripcion_ubicacion 310, tipo_espacio 80, traspaleo 5,"
    "traspaleo_latitud 12.8, traspaleo_longitud 12.8, lugar_traspaleo 600, prioridad int, tipo_vehiculo 270,"
    "en_condiciones 5, capacidad_descarga int, coordinador_operativo 40, coz_correo 50, coz_telefono 15,"
    "responsable_cedas 40, rc_correo 50, rc_telefono 15, comentarios 1050")
DELIVERIES = layout(
    "acuse_estatal 50, clave_estado_predio_capturada int, estado_predio_capturada 50,"
    "clave_municipio_predio_capturada int, municipio_predio_capturada 100, clave_localidad_predio_capturada int,"
    "localidad_predio_capturada 100, id_nu_solicitud int, cdf_entrega 100, id_cdf_entrega int, curp_solicitud 20,"
    "curp_renapo 20, curp_historica 20, sn_primer_apellido 50, sn_segundo_apellido 50, ln_nombre 50, es_pob_indigena 10,"
    "cultivo 50, ton_dap_entregada dec, ton_urea_entregada dec, fecha_entrega date, folio_persona int, cuadernillo 50,"
    "nombre_ddr 50, clave_ddr int, nombre_cader_ventanilla 50, clave_cader_ventanilla int, dap_anio_actual int,"
    "urea_anio_actual int, dap_remanente int, urea_remanente int, superficie_apoyada int")
FREIGHT = layout(
    "folio_del_flete 28, estatus 10, producto 18, abreviacion_producto 3, toneladas_iniciales ton, bultos_iniciales int,"
    "bultos_en_destino int, ticket_bascula text, estado_procedencia 50, toneladas_en_el_destino ton,"
    "fecha_de_salida date, cdf_destino_original 100, cdf_destino_final 100, fecha_de_llegada ts, fecha_de_entrega ts,"
    "toneladas_con_incidentes ton, estatus_de_recepcion_incidente 13, descripcion 250, destino_final 150,"
    "nombre_operador 50, telefono_operador 15, placas_transporte 10, tipo_transporte 50, estado_llegada 50,"
    "bultos_por_anio int, id_ceda_agricultura 100")
MOVES = layout(  # transfers and carry-over share one layout
    "folio_transferencia text, cdf_origen text, estatus text, producto text, abreviacion_producto text,"
    "toneladas_iniciales ton, toneladas_en_el_destino ton, fecha_de_salida date, cdf_destino_original text,"
    "cdf_destino_final text, fecha_de_llegada date, estatus_de_recepcion text, descripcion text, destino_final text,"
    "nombre_operador text, telefono_operador text, placas_transporte text, tipo_transporte text, bultos_iniciales int,"
    "numero_ticket_bascula text, bultos_en_el_destino int, id_ceda_agricultura text")
INCIDENTS = layout(
    "ln_folio_incidencia 22, tipo_incidente 20, cdf_incidente 34, producto 18, clave_producto 3, ton_incidencia dec,"
    "bultos_incidencia int, fecha_incidente date, responsable_cdf 32, usuario_cdf text, persona_valida 31,"
    "descripcion 300")
ORDER_LINES = layout(
    "id_pedido int, entidad text, folio_cdf text, municipio text, localidad text, prioridad int, folio_suministro text,"
    "fecha date, dap dec, urea dec, observacion text, estatus_suministro text, estatus_pedido_detalle text")
ORDER_SUMMARY = layout(
    "id_cdf int, entidad text, folio_cdf text, municipio text, dap_solicitado dec, urea_solicitada dec,"
    "dap_suministrado dec, urea_suministrada dec, dap_por_suministrar dec, urea_por_suministrar dec, catr_dap dec,"
    "itr_dap dec, catr_urea dec, itr_urea dec")
PROJECTION = layout("estado text, fecha date, toneladas_programadas dec")
TARGETS = layout("estado text, derechohabientes int, superficie_ha int, dap_ton dec, urea_ton dec, total_ton dec")
FIELD_REPORTS = layout(
    "fecha_y_hora ts, correo_electronico text, fecha_registro date, estado text, id_ceda_agricultura text,"
    "bultos_dap int, bultos_urea int, quien_reporta text, nombre_de_coz text, nombre_del_rc text, nombre_del_ce text,"
    "observaciones text, otra_persona text, personal_direccion text, hash_respuesta text")
COMMENTS = layout("id_ceda_agricultura 50, comentario text, fecha ts")
REGISTRY = layout(
    "acuse_estatal 30, curp_solicitud 18, curp_renapo 18, curp_historica 18, id_persona 11.0, estatus 29,"
    "primer_apellido 100, segundo_apellido 100, nombre 100, nombre_completo 150, cultivo 50,"
    "clave_estado_predio_inegi 2, estado_predio_inegi 50, clave_municipio_predio_inegi 3, municipio_predio_inegi 100,"
    "clave_localidad_predio 4, localidad_predio 150, regimen_hidrico 3, hect_predio 10.5, hect_solicita_fert 25,"
    "cuadernillo 20, nombre_del_ceda 100, id_ceda_agricultura 100, superficie bigint, dap_(ton) 4.3, urea_(ton) 4.3,"
    "fecha_de_publicacion date, fecha_de_primer_llamado date, direccion text, nota_adicional text")
# Header synonyms seen in registry extracts, after normalising.
REGISTRY_ALIASES = {
    "id_ceda": "id_ceda_agricultura", "id_ceda_agric": "id_ceda_agricultura", "publicacion_fecha": "fecha_de_publicacion",
    "dap_ton_": "dap_(ton)", "urea_ton_": "urea_(ton)",
}
KEYS = {
    "centres": "id_ceda_agricultura", "deliveries": "acuse_estatal", "registry": "acuse_estatal",
    "freight": "folio_del_flete", "transfers": "folio_transferencia", "remnants": "folio_transferencia",
    "incidents": "ln_folio_incidencia", "order_lines": "id_pedido", "order_summary": "id_cdf", "targets": "estado",
    "field_reports": "hash_respuesta",
}
