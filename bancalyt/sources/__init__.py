"""Sources and sinks: every loader returns :class:`BankTables` with the
declared schemas of :mod:`bancalyt.sources.schema`."""

from bancalyt.sources.catalog import load_catalog, save_bucketed
from bancalyt.sources.jdbc import KeyRange, jdbc_catalog_conf, jdbc_predicates, jdbc_properties, jdbc_read_options, jdbc_url, load_jdbc
from bancalyt.sources.parquet import load_parquet, write_parquet
from bancalyt.sources.profile import schema_report, source_profile
from bancalyt.sources.schema import MONEY, PRIMARY_KEYS, SCHEMAS, TABLE_NAMES
from bancalyt.sources.sinks import to_json_lines, write_json, write_report, write_table
from bancalyt.sources.tables import BankTables, conform
from bancalyt.sources.testdata import from_testdata

__all__ = [
    "BankTables", "KeyRange", "jdbc_catalog_conf", "jdbc_predicates", "MONEY", "PRIMARY_KEYS", "SCHEMAS", "TABLE_NAMES",
    "conform", "from_testdata", "jdbc_properties", "jdbc_read_options", "jdbc_url", "load_catalog", "load_jdbc", "load_parquet",
    "save_bucketed", "schema_report", "source_profile", "to_json_lines", "write_json", "write_parquet",
    "write_report",
    "write_table",
]
