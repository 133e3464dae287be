"""Partitioned JDBC source.

A JDBC read without partitioning options runs in a single task; on a
large table that task reads every row through one connection.  Here each
table is read with predicates on its primary key, cut at quantiles (or into
equal widths), so the scan is split across executors.  Connection settings (url, user,
password, driver) always come from the caller; nothing is stored in code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bancalyt.sources.schema import PRIMARY_KEYS, SCHEMAS
from bancalyt.sources.tables import BankTables


def jdbc_url(host: str, port: int, database: str, vendor: str = "mysql", use_ssl: bool = False,
             server_timezone: str = "UTC", allow_public_key_retrieval: bool = True) -> str:
    """URL of a MySQL/MariaDB-style database with the connection flags the
    catalogue's deployments set (SSL, server time zone, public-key
    retrieval)."""
    flags = (f"useSSL={str(use_ssl).lower()}&serverTimezone={server_timezone}"
             f"&allowPublicKeyRetrieval={str(allow_public_key_retrieval).lower()}")
    return f"jdbc:{vendor}://{host}:{port}/{database}?{flags}"


def jdbc_properties(user: str, password: str, driver: str | None = None) -> dict[str, str]:
    """Reader properties; credentials are always passed in by the caller."""
    props = {"user": user, "password": password}
    if driver:
        props["driver"] = driver
    return props


@dataclass(frozen=True)
class KeyRange:
    """Inclusive bounds of a table's primary key and the split count."""

    lower: int
    upper: int
    partitions: int


def jdbc_read_options(table: str, key_range: KeyRange | None, fetchsize: int = 10_000) -> dict[str, str]:
    """Reader options for one table; partitioned on its primary key when a
    range is given (Spark turns them into ``numPartitions`` WHERE clauses)."""
    opts = {"dbtable": table, "fetchsize": str(fetchsize)}
    if key_range is not None and key_range.partitions > 1:
        opts.update({
            "partitionColumn": PRIMARY_KEYS[table],
            "lowerBound": str(key_range.lower),
            "upperBound": str(key_range.upper + 1),
            "numPartitions": str(key_range.partitions),
        })
    return opts


#: tables that grow with the bank, never read by one task
LARGE_TABLES = ("Clientes", "Cuentas", "Prestamos", "ScoreCliente", "ClienteProductos")


def key_range(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              rows_per_partition: int = 1_000_000) -> KeyRange:
    """Ask the database for min/max/count of the key (one pushed-down query
    returning a single row) and size the split count from it."""
    pk = PRIMARY_KEYS[table]
    bounds = (spark.read.format("jdbc")
              .options(**properties)
              .option("url", url)
              .option("query", f"SELECT MIN({pk}) AS lo, MAX({pk}) AS hi, COUNT(*) AS n FROM {table}")
              .load()
              .first())
    if bounds is None or bounds["lo"] is None:
        return KeyRange(0, 0, 1)
    parts = max(1, -(-int(bounds["n"]) // rows_per_partition))
    return KeyRange(int(bounds["lo"]), int(bounds["hi"]), parts)


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                    key: KeyRange | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").options(**properties).option("url", url)
    return reader.options(**jdbc_read_options(table, key)).load()


def cuts_query(table: str, rows_per_partition: int = 1_000_000) -> str:
    """SQL for the database: the smallest key of every ``rows_per_partition`` rows in
    key order (an index scan there, one row per partition back)."""
    pk = PRIMARY_KEYS[table]
    return (f"SELECT MIN(k) AS cut FROM (SELECT {pk} AS k, FLOOR((ROW_NUMBER() OVER (ORDER BY {pk}) - 1) / {int(rows_per_partition)}) AS g "
            f"FROM {table} WHERE {pk} IS NOT NULL) q GROUP BY g")


def jdbc_predicates(table: str, cuts: Sequence[int]) -> list[str]:
    """One WHERE clause per partition, between neighbouring ``cuts`` of the key: every
    row, with or without a key, meets exactly one of them.  Cuts at quantiles give
    equal partitions however sparse the keys are."""
    pk = PRIMARY_KEYS[table]
    inner = sorted(set(cuts))[1:]
    if not inner:
        return ["1 = 1"]
    return [f"{pk} < {inner[0]} OR {pk} IS NULL",
            *(f"{pk} >= {a} AND {pk} < {b}" for a, b in zip(inner, inner[1:], strict=False)), f"{pk} >= {inner[-1]}"]


def key_cuts(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
             rows_per_partition: int = 1_000_000) -> list[int]:
    """The cuts of :func:`cuts_query`, fetched from the database: as many as partitions."""
    rows = (spark.read.format("jdbc").options(**properties).option("url", url)
            .option("query", cuts_query(table, rows_per_partition)).load().collect())
    return sorted(int(r["cut"]) for r in rows)


def read_jdbc_cuts(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], cuts: Sequence[int],
                   fetchsize: int = 10_000) -> DataFrame:
    """``table`` read by one task per predicate of :func:`jdbc_predicates`."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(table, cuts),
                           properties={**properties, "fetchsize": str(fetchsize)})


def jdbc_catalog_conf(name: str, url: str, properties: Mapping[str, str]) -> dict[str, str]:
    """Session settings that make the database a catalog ``name`` whose scans push
    filters, aggregates, limits and top-k down to it."""
    base = f"spark.sql.catalog.{name}"
    pushed = {f"{base}.pushDown{what}": "true" for what in ("Predicate", "Aggregate", "Limit", "Offset", "TableSample")}
    return {base: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog", f"{base}.url": url,
            **{f"{base}.{k}": v for k, v in properties.items()}, **pushed}


def load_jdbc(spark: SparkSession, url: str, properties: Mapping[str, str],
              ranges: Mapping[str, KeyRange] | None = None,
              discover: bool = True, split: str = "quantiles") -> BankTables:
    """Read the eight tables over JDBC, each when a query first touches it.

    ``ranges`` gives the key range per table.  The others are split where the
    database says: at quantiles of the key (:func:`key_cuts`), or with
    ``split="range"`` into equal widths between its smallest and largest
    (:func:`key_range`, one row, for dense keys).  With ``discover=False`` the
    large tables must have a range; the small dimensions are then read in one
    partition.
    """
    if split not in ("quantiles", "range"):
        raise ValueError(f"unknown split {split!r}")
    given = dict(ranges or {})
    if not discover and (missing := [n for n in LARGE_TABLES if n not in given]):
        raise ValueError(f"no key range for {', '.join(missing)}: one task would read each whole table")

    def read(name: str) -> DataFrame:
        rng = given.get(name)
        if rng is None and discover:
            if split == "quantiles":
                return read_jdbc_cuts(spark, url, name, properties, key_cuts(spark, url, name, properties))
            rng = key_range(spark, url, name, properties)
        return read_jdbc_table(spark, url, name, properties, rng)

    return BankTables.from_mapping({name: (lambda n=name: read(n)) for name in SCHEMAS})
