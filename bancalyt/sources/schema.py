"""Declared schemas of the eight logical tables.

Every loader returns DataFrames with exactly these column names and types so
that the query plans never depend on what a source happens to infer
(booleans stored as 0/1 integers, money as floating point, ...).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)

SCHEMAS: dict[str, T.StructType] = {
    "Clientes": T.StructType([
        T.StructField("id_cliente", T.LongType(), False),
        T.StructField("nombre", T.StringType()),
        T.StructField("apellidos", T.StringType()),
        T.StructField("segmento", T.StringType()),
        T.StructField("id_sucursal", T.LongType()),
        T.StructField("id_provincia", T.LongType()),
        T.StructField("activo", T.BooleanType()),
        T.StructField("fecha_nacimiento", T.DateType()),
    ]),
    "Cuentas": T.StructType([
        T.StructField("id_cuenta", T.LongType(), False),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("tipo_cuenta", T.StringType()),
        T.StructField("saldo", MONEY),
        T.StructField("activa", T.BooleanType()),
    ]),
    "Prestamos": T.StructType([
        T.StructField("id_prestamo", T.LongType(), False),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("estado", T.StringType()),
    ]),
    "ScoreCliente": T.StructType([
        T.StructField("id_cliente", T.LongType(), False),
        T.StructField("score_credito", T.IntegerType()),
        T.StructField("riesgo", T.StringType()),
        T.StructField("propension_ahorro", T.BooleanType()),
        T.StructField("propension_inversion", T.BooleanType()),
        T.StructField("propension_seguro", T.BooleanType()),
    ]),
    "Sucursales": T.StructType([
        T.StructField("id_sucursal", T.LongType(), False),
        T.StructField("nombre", T.StringType()),
        T.StructField("id_provincia", T.LongType()),
    ]),
    "Provincias": T.StructType([
        T.StructField("id_provincia", T.LongType(), False),
        T.StructField("nombre", T.StringType()),
    ]),
    "Productos": T.StructType([
        T.StructField("id_producto", T.LongType(), False),
        T.StructField("categoria", T.StringType()),
    ]),
    "ClienteProductos": T.StructType([
        T.StructField("id_contrato", T.LongType()),
        T.StructField("id_cliente", T.LongType()),
        T.StructField("id_producto", T.LongType()),
        T.StructField("estado", T.StringType()),
    ]),
}

# Primary key of each table; used as the partition column of JDBC reads.
PRIMARY_KEYS: dict[str, str] = {
    "Clientes": "id_cliente",
    "Cuentas": "id_cuenta",
    "Prestamos": "id_prestamo",
    "ScoreCliente": "id_cliente",
    "Sucursales": "id_sucursal",
    "Provincias": "id_provincia",
    "Productos": "id_producto",
    "ClienteProductos": "id_contrato",
}

TABLE_NAMES: tuple[str, ...] = tuple(SCHEMAS)
