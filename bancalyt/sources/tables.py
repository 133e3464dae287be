"""The container of the eight logical tables and the schema conformer."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.sources.schema import SCHEMAS


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the declared schema of ``table``.

    Columns are selected by name and cast to the declared type, so a source
    that stores flags as 0/1 or money as double yields the same plan input
    as a typed parquet file.  Extra source columns are pruned here, which
    also keeps them out of the scan's ReadSchema.
    """
    schema = SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class BankTables:
    """Lazy DataFrames of the logical model, one attribute per table.

    Each table is defined by a zero-argument factory and only planned when
    a query first touches it, so a query over two tables does not pay for
    analysing the other six.
    """

    # attribute name -> logical table name
    NAMES = {
        "clientes": "Clientes",
        "cuentas": "Cuentas",
        "prestamos": "Prestamos",
        "score": "ScoreCliente",
        "sucursales": "Sucursales",
        "provincias": "Provincias",
        "productos": "Productos",
        "cliente_productos": "ClienteProductos",
    }
    clientes: DataFrame
    cuentas: DataFrame
    prestamos: DataFrame
    score: DataFrame
    sucursales: DataFrame
    provincias: DataFrame
    productos: DataFrame
    cliente_productos: DataFrame

    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]):
        missing = set(self.NAMES.values()) - set(factories)
        if missing:
            raise ValueError(f"missing tables: {sorted(missing)}")
        self._factories = dict(factories)
        self._frames: dict[str, DataFrame] = {}
        #: per-customer roll-up of the active accounts that the queries of a block
        #: share, where one was written (``plans.queries.with_rollup``)
        self.rollup: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """The DataFrame of a logical table, by its name (``Clientes``...)."""
        if name not in self._frames:
            self._frames[name] = self._factories[name]()
        return self._frames[name]

    def sharing(self, rollup: DataFrame) -> "BankTables":
        """These tables with a roll-up that queries may read in place of accounts."""
        other = BankTables(self._factories)
        other._frames, other.rollup = self._frames, rollup
        return other

    def __getattr__(self, attr: str) -> DataFrame:
        names = type(self).NAMES
        if attr in names:
            return self.table(names[attr])
        raise AttributeError(attr)

    @classmethod
    def from_mapping(cls, frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                     conformed: bool = False) -> "BankTables":
        """Build from ``{logical table name: DataFrame or factory}``.

        Frames are projected onto the declared schemas unless the source
        already produces them (``conformed=True``).
        """
        def factory(name, src):
            def make():
                df = src() if callable(src) else src
                return df if conformed else conform(df, name)
            return make
        return cls({name: factory(name, src) for name, src in frames.items()})

    def items(self) -> list[tuple[str, DataFrame]]:
        """``(logical table name, DataFrame)`` pairs in declaration order."""
        return [(name, self.table(name)) for name in self.NAMES.values()]
