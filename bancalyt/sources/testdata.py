"""Map the driver's TPC-H-style test tables onto the banking model.

Rules (see FIXTURES.md section 3):

* customer (+ nation for the province) -> Clientes and ScoreCliente
* orders                               -> Cuentas
* events                               -> Prestamos
* nation / region / part               -> Sucursales / Provincias / Productos
* lineitem joined to orders            -> ClienteProductos

Everything stays lazy: each logical table is a projection (and, for
Clientes and ClienteProductos, a join) over the parquet scans, so column
pruning and filter pushdown of a query reach the physical files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bancalyt.sources.tables import BankTables

# --- fixed values of the mapping ---------------------------------------
# loan status per event type
EVENT_STATUS = {
    "purchase": "Activo",
    "error": "Moroso",
    "signup": "Pendiente",
    "view": "Pagado",
    "click": "Cancelado",
}
# risk level by credit score, first match wins: (lower bound, label)
RISK_LADDER = [(750, "Bajo"), (500, "Medio"), (250, "Alto")]
RISK_DEFAULT = "Muy Alto"
DEPOSIT_PART_TYPE = "PROMO"
DEPOSIT_CATEGORY = "Depósito"
BIRTH_EPOCH = "1950-01-01"
# ------------------------------------------------------------------------


# Columns of the test tables that the mapping reads, with their parquet
# types.  Declaring them skips footer-based schema inference on the driver
# (the larger part of planning time on small inputs) and fails fast if a
# file's types drift.
_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
SOURCE_COLUMNS: dict[str, list[tuple[str, T.DataType]]] = {
    "customer": [("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                 ("c_mktsegment", _S)],
    "orders": [("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
               ("o_totalprice", _D), ("o_orderpriority", _S)],
    "nation": [("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)],
    "region": [("r_regionkey", _I), ("r_name", _S)],
    "part": [("p_partkey", _L), ("p_type", _S)],
    "lineitem": [("l_orderkey", _L), ("l_partkey", _L), ("l_linenumber", _I),
                 ("l_returnflag", _S)],
    "events": [("event_id", _L), ("user_id", _L), ("event_type", _S)],
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, t) for c, t in SOURCE_COLUMNS[name]])
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _lit(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _risk_sql(score: str) -> str:
    whens = " ".join(f"WHEN {score} >= {bound} THEN {_lit(label)}" for bound, label in RISK_LADDER)
    return f"CASE {whens} ELSE {_lit(RISK_DEFAULT)} END"


def _event_status_sql(event_type: str) -> str:
    whens = " ".join(f"WHEN {event_type} = {_lit(ev)} THEN {_lit(st)}"
                     for ev, st in EVENT_STATUS.items())
    return f"CASE {whens} END"


class _Sources:
    """Lazily opened scans of the test tables (one per name)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._dfs = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = _read(self.spark, self.sf_dir, name)
        return self._dfs[name]


# Each table is one projection written as SQL expressions: a single call
# into the JVM per table instead of one per column expression.
def _clientes(src: _Sources) -> DataFrame:
    customer = src["customer"]
    # Declaring nation's key unique lets the optimizer drop this outer join
    # from queries that do not read id_provincia.
    nation = src["nation"].select("n_nationkey", "n_regionkey").dropDuplicates(["n_nationkey"])
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .selectExpr(
            "c_custkey AS id_cliente",
            "split_part(c_name, '#', 1) AS nombre",
            "split_part(c_name, '#', 2) AS apellidos",
            "c_mktsegment AS segmento",
            "CAST(c_nationkey AS BIGINT) AS id_sucursal",
            "CAST(n_regionkey AS BIGINT) AS id_provincia",
            "c_acctbal >= 0 AS activo",
            f"date_add(DATE {_lit(BIRTH_EPOCH)}, CAST((c_custkey * 37) % 18000 AS INT))"
            " AS fecha_nacimiento",
        )
    )


def _cuentas(src: _Sources) -> DataFrame:
    return src["orders"].selectExpr(
        "o_orderkey AS id_cuenta",
        "o_custkey AS id_cliente",
        "o_orderpriority AS tipo_cuenta",
        "CAST(round(o_totalprice / 5, 2) AS DECIMAL(14,2)) AS saldo",
        "o_orderstatus != 'F' AS activa",
    )


def _prestamos(src: _Sources) -> DataFrame:
    return src["events"].selectExpr(
        "event_id AS id_prestamo",
        "user_id AS id_cliente",
        f"{_event_status_sql('event_type')} AS estado",
    )


def _score(src: _Sources) -> DataFrame:
    score = "CAST(floor((c_acctbal + 1000) / 11) AS INT)"
    return src["customer"].selectExpr(
        "c_custkey AS id_cliente",
        f"{score} AS score_credito",
        f"{_risk_sql(score)} AS riesgo",
        "c_custkey % 2 = 0 AS propension_ahorro",
        "c_custkey % 3 = 0 AS propension_inversion",
        "c_nationkey % 2 = 0 AS propension_seguro",
    )


def _sucursales(src: _Sources) -> DataFrame:
    return src["nation"].selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id_sucursal",
        "n_name AS nombre",
        "CAST(n_regionkey AS BIGINT) AS id_provincia",
    )


def _provincias(src: _Sources) -> DataFrame:
    return src["region"].selectExpr(
        "CAST(r_regionkey AS BIGINT) AS id_provincia",
        "r_name AS nombre",
    )


def _productos(src: _Sources) -> DataFrame:
    return src["part"].selectExpr(
        "p_partkey AS id_producto",
        f"CASE WHEN p_type = {_lit(DEPOSIT_PART_TYPE)} THEN {_lit(DEPOSIT_CATEGORY)}"
        " ELSE p_type END AS categoria",
    )


def _cliente_productos(src: _Sources) -> DataFrame:
    lineitem, orders = src["lineitem"], src["orders"]
    return (
        lineitem.join(orders.select("o_orderkey", "o_custkey"),
                      lineitem.l_orderkey == orders.o_orderkey)
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS id_contrato",
            "o_custkey AS id_cliente",
            "l_partkey AS id_producto",
            "CASE WHEN l_returnflag = 'N' THEN 'Activo' ELSE 'Cancelado' END AS estado",
        )
    )


_BUILDERS = {
    "Clientes": _clientes,
    "Cuentas": _cuentas,
    "Prestamos": _prestamos,
    "ScoreCliente": _score,
    "Sucursales": _sucursales,
    "Provincias": _provincias,
    "Productos": _productos,
    "ClienteProductos": _cliente_productos,
}


def raw_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight logical tables as DataFrames (planned eagerly)."""
    src = _Sources(spark, sf_dir)
    return {name: build(src) for name, build in _BUILDERS.items()}


def from_testdata(spark: SparkSession, sf_dir: str) -> BankTables:
    """Logical tables over ``/root/testdata/sf*/`` style directories.

    The mapping emits the declared types itself, so no conforming
    projection is stacked on top; each table is planned on first use.
    """
    src = _Sources(spark, sf_dir)
    return BankTables.from_mapping(
        {name: (lambda b=build: b(src)) for name, build in _BUILDERS.items()}, conformed=True)
