"""Registry of the catalogue: id -> metadata + plan builder.

``run`` / ``run_block`` / ``run_all`` return lazy DataFrames; the caller
chooses the action (``show``, ``write``, ``collect`` of a small report).
``catalog_df`` lists the registry itself as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from inspect import getdoc, signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bancalyt.plans import queries as q
from bancalyt.plans.oracle import ORACLE_SQL
from bancalyt.sources.profile import source_profile
from bancalyt.sources.tables import BankTables
from bancalyt.sources.testdata import from_testdata

Builder = Callable[..., DataFrame]


@dataclass(frozen=True)
class QueryDef:
    key: str
    title: str
    block: str
    tables: tuple[str, ...]
    build: Builder = field(repr=False)

    @property
    def explanation(self) -> str | None:
        """What the query computes and how: the text of its builder."""
        return getdoc(self.build.func if isinstance(self.build, partial) else self.build)

    @property
    def oracle_sql(self) -> str | None:
        return ORACLE_SQL.get(self.key)


CL, CU, PR, SC, SU, PV, PD, CP = ("Clientes", "Cuentas", "Prestamos", "ScoreCliente",
                                  "Sucursales", "Provincias", "Productos", "ClienteProductos")

_DEFS = [
    QueryDef("a1_card_offer", "Card offer by balance", "classification", (CL, CU), q.a1_card_offer),
    QueryDef("a2_multi_product", "Card, fund and insurance recommendation", "classification",
             (CL, CU, SC), partial(q.a2_multi_product, as_of=q.PINNED_AS_OF)),
    QueryDef("a2_multi_product_days365", "A2 with age as floor(days / 365)", "classification",
             (CL, CU, SC), partial(q.a2_multi_product, as_of=q.PINNED_AS_OF, age_mode="days365")),
    QueryDef("b1_rank_compare", "RANK vs DENSE_RANK vs ROW_NUMBER per branch", "windows",
             (CL, CU), q.b1_rank_compare),
    QueryDef("b2_top3_province", "Top-3 balances per province", "windows", (CL, CU, PV),
             q.b2_top3_province),
    QueryDef("b3_lag_diff", "Difference to the previous balance (LAG)", "windows", (CL, CU),
             q.b3_lag_diff),
    QueryDef("b3_lag_default", "LAG with a default value", "windows", (CL, CU), q.b3_lag_default),
    QueryDef("b3_lead_diff", "Difference to the next balance (LEAD)", "windows", (CL, CU),
             q.b3_lead_diff),
    QueryDef("c1_no_active_loan", "Customers without an active loan", "joins", (CL, CU, PR),
             q.c1_no_active_loan),
    QueryDef("c2_branch_metrics", "Branch metrics (catalogue figures)", "joins",
             (SU, PV, CL, CU, PR), q.c2_branch_metrics),
    QueryDef("c2_branch_metrics_exact", "Branch metrics, each fact counted once", "joins",
             (SU, PV, CL, CU, PR), q.c2_branch_metrics_exact),
    QueryDef("d1_above_segment_mean", "Balances above the segment mean", "subqueries", (CL, CU),
             q.d1_above_segment_mean),
    QueryDef("d1_correlated_sql", "Balances above the segment mean (correlated SQL)",
             "subqueries", (CL, CU), q.d1_correlated_sql),
    QueryDef("e1_top_customers", "Top customers by total balance with score", "ctes",
             (CL, CU, SC), q.e1_top_customers),
    QueryDef("e2_risk_share", "Balance distribution by risk level", "ctes", (SC, CU),
             q.e2_risk_share),
    QueryDef("f1_where_count", "High balances per branch (WHERE)", "where_having", (CL, CU),
             q.f1_where_count),
    QueryDef("f1_having_count", "Accounts per branch (HAVING)", "where_having", (CL, CU),
             q.f1_having_count),
    QueryDef("g1_deposit_candidates", "Deposit candidates", "recommendation",
             (CL, CU, SC, CP, PD), q.g1_deposit_candidates),
    QueryDef("g1_deposit_not_in", "Deposit candidates (NOT IN)", "recommendation",
             (CL, CU, SC, CP, PD), q.g1_deposit_not_in),
    QueryDef("g2_score_360", "360 scoring: propensities and active products", "recommendation",
             (CL, CU, SC, CP), partial(q.g2_score_360, as_of=q.PINNED_AS_OF)),
    QueryDef("g2_score_360_days365", "G2 with age as floor(days / 365)", "recommendation",
             (CL, CU, SC, CP), partial(q.g2_score_360, as_of=q.PINNED_AS_OF, age_mode="days365")),
    QueryDef("h1_offer_counts", "Accounts per offer tier", "charts", (CL, CU), q.h1_offer_counts),
    QueryDef("h2_branch_balance", "Top branches by balance", "charts", (SU, CL, CU),
             q.h2_branch_balance),
    QueryDef("h3_risk_share", "Balance share per risk level", "charts", (SC, CU), q.h3_risk_share),
    QueryDef("h4_segment_size", "Customers and mean balance per segment", "charts", (CL, CU),
             q.h4_segment_size),
    QueryDef("h5_segment_score", "Credit score per segment", "charts", (CL, SC), q.h5_segment_score),
    QueryDef("h6_segment_propensity", "Propensities per segment", "charts", (CL, SC),
             q.h6_segment_propensity),
    QueryDef("h7_province_balance", "Top provinces by balance", "charts", (CL, CU, PV),
             q.h7_province_balance),
    QueryDef("h8_loan_status", "Loans per branch and status", "charts", (SU, CL, PR),
             q.h8_loan_status),
    QueryDef("j1_offer_share", "Share of each offer tier", "dashboard", (CL, CU), q.j1_offer_share),
    QueryDef("j2_loan_pivot", "Branch x loan status matrix", "dashboard", (SU, CL, PR),
             q.j2_loan_pivot),
    QueryDef("j3_kpi_customers", "KPI: customers", "dashboard", (CL, CU), q.j3_kpi_customers),
    QueryDef("j4_kpi_balance", "KPI: total balance", "dashboard", (SU, CL, CU), q.j4_kpi_balance),
    QueryDef("j5_kpi_score", "KPI: credit score", "dashboard", (CL, SC), q.j5_kpi_score),
    QueryDef("j6_kpi_overdue", "KPI: overdue loans", "dashboard", (SU, CL, PR), q.j6_kpi_overdue),
    QueryDef("k1_distinct_holders", "Customers with accounts, by mergeable sketches", "sketches",
             (CL, CU), q.k1_distinct_holders),
    QueryDef("source_profile", "Rows per source table", "sources",
             (CL, CU, PR, SC, SU, PV, PD, CP), source_profile),
]

REGISTRY: dict[str, QueryDef] = {d.key: d for d in _DEFS}
BLOCKS: tuple[str, ...] = tuple(dict.fromkeys(d.block for d in _DEFS))


def _tables(spark: SparkSession, source: BankTables | str) -> BankTables:
    return source if isinstance(source, BankTables) else from_testdata(spark, source)


def _build(d: QueryDef, tables: BankTables, params: dict) -> DataFrame:
    known = [n for n in list(signature(d.build).parameters)[1:] if n != "params"]
    unknown = sorted(set(params) - set(known))
    if unknown:
        raise ValueError(f"{d.key} has no parameter {', '.join(unknown)}; it has: {', '.join(known) or 'none'}")
    return d.build(tables, **params)


def run(spark: SparkSession, key: str, source: BankTables | str, **params) -> DataFrame:
    """Plan one query; ``source`` is a :class:`BankTables` or a test-data dir.

    ``params`` are the query's own keyword parameters (``k``, thresholds,
    ``as_of``; the registry pins ``as_of``, None asks for the current date)."""
    if key not in REGISTRY:
        raise ValueError(f"unknown query {key!r}")
    return _build(REGISTRY[key], _tables(spark, source), params)


#: blocks whose queries share a per-customer roll-up of the accounts
SHARING = ("charts",)


def run_block(spark: SparkSession, block: str, source: BankTables | str, share: bool = True,
              **params) -> dict[str, DataFrame]:
    """Plan every query of a block; each takes those of ``params`` that it has.

    The chart queries share one roll-up of the accounts, which this call writes
    (the accounts are scanned once); ``share=False`` plans them lazily, each over
    the accounts themselves."""
    if block not in BLOCKS:
        raise ValueError(f"unknown block {block!r}")
    tables = _tables(spark, source)
    if share and block in SHARING:
        tables = q.with_rollup(tables)
    return _run_some(spark, [d for d in _DEFS if d.block == block], tables, params)


def run_all(spark: SparkSession, source: BankTables | str, **params) -> dict[str, DataFrame]:
    """Plan every query; each takes those of ``params`` that it has."""
    return _run_some(spark, _DEFS, source, params)


def _run_some(spark, defs, source, params) -> dict[str, DataFrame]:
    tables = _tables(spark, source)
    return {d.key: _build(d, tables, {n: v for n, v in params.items() if n in signature(d.build).parameters})
            for d in defs}


def catalog_df(spark: SparkSession) -> DataFrame:
    """The registry as rows: key, title, block, tables, oracle SQL, explanation."""
    schema = T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("sql", T.StringType()),
        T.StructField("explanation", T.StringType()),
    ])
    rows = [(d.key, d.title, d.block, list(d.tables), d.oracle_sql, d.explanation) for d in _DEFS]
    return spark.createDataFrame(rows, schema)
