"""Hand fixture: ties, nulls, tier bounds, fan-out, NOT IN, empty branches.

Each test types the few rows it needs (FIXTURES.md section 4)."""

from __future__ import annotations

from bancalyt.functions import age_years
from bancalyt.plans import queries as q
from conftest import D, collect, d, make_tables

BRANCHES = [(10, "Centro", 1), (11, "Norte", 1), (12, "Sin clientes", 2),
            (13, "Inactivos", 2), (14, "Centro", 2)]
PROVINCES = [(1, "Madrid"), (2, "Sevilla")]


def cust(i, branch=10, prov=1, active=True, seg="Particular", last="Apellido",
         born="1980-01-01"):
    return (i, f"N{i}", last, seg, branch, prov, active, d(born))


def acct(i, client, saldo, active=True, kind="1-URGENT"):
    return (i, client, kind, D(saldo), active)


def score(i, s=800, risk="Bajo", ah=True, inv=True, seg_=True):
    return (i, s, risk, ah, inv, seg_)


# ------------------------------------------------------------------ tiers
def test_offer_tier_bounds_inclusive_and_exclusive(spark):
    saldos = [10000, 10000.01, 50000, 50000.01, 20000, 5000, 30000, None]
    t = make_tables(
        spark,
        Clientes=[cust(1)],
        Cuentas=[acct(100 + i, 1, s) for i, s in enumerate(saldos)],
        ScoreCliente=[score(1)],
    )
    a1 = dict(collect(q.a1_card_offer(t, k=None), "id_cuenta", "oferta_recomendada"))
    assert a1 == {
        100: "Tarjeta Oro", 101: "Tarjeta Oro", 102: "Tarjeta Oro", 103: "Tarjeta Premium",
        104: "Tarjeta Oro", 105: "Tarjeta Estándar", 106: "Tarjeta Oro",
        107: "Tarjeta Estándar",  # null balance falls to ELSE
    }
    a2 = collect(q.a2_multi_product(t, k=100), "saldo", "tarjeta")
    by_saldo = {s: c for s, c in a2}
    assert by_saldo[10000.0] == "Tarjeta Estándar"   # A2 uses > 10000
    assert by_saldo[10000.01] == "Tarjeta Oro"
    assert by_saldo[50000.0] == "Tarjeta Oro"
    assert by_saldo[50000.01] == "Tarjeta Premium"
    # desc sort puts the null balance last
    assert a2[-1][0] is None

    h1 = dict(collect(q.h1_offer_counts(t), "oferta", "total"))
    assert h1 == {"Oro": 5, "Premium": 1, "Estándar": 2}


def test_deposit_ladder(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1)],
        Cuentas=[acct(1, 1, 20000), acct(2, 1, 19999.99), acct(3, 1, 10000), acct(4, 1, 5000.01),
                 acct(5, 1, 5000)],
        ScoreCliente=[score(1)],
    )
    got = dict(collect(q.g1_deposit_candidates(t, k=None), "saldo", "deposito_sugerido"))
    assert got == {20000.0: "Depósito 24M — 3,80%", 19999.99: "Depósito 12M — 3,20%",
                   10000.0: "Depósito 12M — 3,20%", 5000.01: "Depósito  6M — 2,50%"}


# ------------------------------------------------------------------ windows
def test_rank_dense_rank_row_number_under_ties(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1), cust(2), cust(3)],
        Cuentas=[acct(7, 1, 500), acct(5, 2, 500), acct(6, 3, 300)],
    )
    got = collect(q.b1_rank_compare(t).orderBy("row_num"), "saldo", "rnk", "dense_rnk", "row_num")
    assert got == [(500.0, 1, 1, 1), (500.0, 1, 1, 2), (300.0, 3, 2, 3)]
    # row_number ties are broken by id_cuenta: account 5 comes first
    ids = collect(q.b1_rank_compare(t).orderBy("row_num"), "id_cliente", "row_num")
    assert ids[0] == (2, 1)


def test_top3_keeps_ties_beyond_three(spark):
    t = make_tables(
        spark,
        Clientes=[cust(i, branch=10 + (i % 2), prov=1) for i in range(1, 7)],
        Cuentas=[acct(i, i, 900 if i <= 4 else 100 * i) for i in range(1, 7)],
        Provincias=PROVINCES,
    )
    rows = collect(q.b2_top3_province(t), "provincia", "ranking")
    assert rows == [("Madrid", 1)] * 4
    rn = collect(q.b2_top3_province(t, method="row_number"), "ranking")
    assert rn == [(1,), (2,), (3,)]
    dense = collect(q.b2_top3_province(t, method="dense_rank"), "saldo", "ranking")
    assert dense == [(900.0, 1)] * 4 + [(600.0, 2), (500.0, 3)]


def test_lag_lead_and_default(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1, branch=10), cust(2, branch=10), cust(3, branch=11)],
        Cuentas=[acct(1, 1, 300), acct(2, 2, 300), acct(3, 1, 100), acct(4, 3, 50)],
    )
    def rows(df, *cols):
        return sorted(collect(df, *cols), key=repr)

    lag = rows(q.b3_lag_diff(t), "id_sucursal", "saldo", "saldo_anterior", "diferencia")
    assert lag == [(10, 100.0, 300.0, -200.0), (10, 300.0, 300.0, 0.0), (10, 300.0, None, None),
                   (11, 50.0, None, None)]
    lag0 = rows(q.b3_lag_default(t), "saldo", "saldo_anterior", "diferencia")
    assert (300.0, 0.0, 300.0) in lag0 and (50.0, 0.0, 50.0) in lag0
    lead = rows(q.b3_lead_diff(t), "saldo", "saldo_siguiente", "diferencia")
    assert lead == [(100.0, None, None), (300.0, 100.0, 200.0), (300.0, 300.0, 0.0),
                    (50.0, None, None)]
    # the lead of the last reported row comes from the row after the cut
    cut = collect(q.b3_lead_diff(t, k=2), "saldo_siguiente")
    assert cut == [(300.0,), (100.0,)]


# ------------------------------------------------------------------ joins
def test_c1_excludes_only_active_loans(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1), cust(2), cust(3, active=False)],
        Cuentas=[acct(1, 1, 100), acct(2, 2, 200), acct(3, 3, 300)],
        Prestamos=[(1, 1, "Activo"), (2, 2, "Cancelado"), (3, None, "Activo")],
    )
    assert collect(q.c1_no_active_loan(t), "id_cliente") == [(2,)]


def test_c2_fan_out_parity_vs_exact(spark):
    t = make_tables(
        spark,
        Sucursales=BRANCHES, Provincias=PROVINCES,
        Clientes=[cust(1, branch=10), cust(2, branch=10), cust(3, branch=13, active=False),
                  cust(4, branch=11)],
        Cuentas=[acct(1, 1, 1000), acct(2, 1, 2000), acct(3, 2, 600), acct(4, 3, 999),
                 acct(5, 4, 50, active=False)],
        Prestamos=[(1, 1, "Activo"), (2, 1, "Activo"), (3, 1, "Activo"), (4, 2, "Moroso")],
    )
    cols = ("id_sucursal", "num_clientes", "saldo_medio", "saldo_total", "prestamos_activos")
    parity = {r[0]: r for r in collect(q.c2_branch_metrics(t), *cols)}
    exact = {r[0]: r for r in collect(q.c2_branch_metrics_exact(t), *cols)}
    # customer 1: (1000 + 2000) x 3 loans, customer 2: 600 x 1
    # parity mean divides by the 7 fanned-out rows: 9600 / 7
    assert parity[10] == (10, 2, 1371.43, 9600.0, 3)
    assert exact[10] == (10, 2, 1200.0, 3600.0, 3)
    # branch 11: an active customer without active accounts
    assert exact[11] == (11, 1, None, None, 0)
    # branch without customers, and branch whose customers are all inactive
    assert exact[12] == (12, 0, None, None, 0)
    assert exact[13] == (13, 0, None, None, 0)
    assert parity[12] == exact[12] and parity[13] == exact[13]
    assert len(parity) == 5


def test_h2_h8_group_by_branch_id_not_name(spark):
    t = make_tables(
        spark,
        Sucursales=BRANCHES, Provincias=PROVINCES,
        Clientes=[cust(1, branch=10), cust(2, branch=14)],
        Cuentas=[acct(1, 1, 100), acct(2, 2, 200)],
        Prestamos=[(1, 1, "Moroso"), (2, 2, "Moroso"), (3, 2, None)],
    )
    h8 = collect(q.h8_loan_status(t), "id_sucursal", "sucursal", "estado", "total")
    assert h8 == [(10, "Centro", "Moroso", 1), (14, "Centro", "Moroso", 1)]
    h2 = collect(q.h2_branch_balance(t), "id_sucursal", "saldo_total", "num_clientes")
    assert h2[:2] == [(14, 200.0, 1), (10, 100.0, 1)]
    assert (12, None, 0) in h2
    pivot = collect(q.j2_loan_pivot(t), "id_sucursal", "Activo", "Moroso", "Pendiente")
    assert pivot == [(10, 0, 1, 0), (14, 0, 1, 0)]
    assert collect(q.j6_kpi_overdue(t)) == [(2, 2)]


# ------------------------------------------------------------------ subqueries
def test_d1_mean_over_all_customers_and_null_segment(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1, seg="A"), cust(2, seg="A", active=False), cust(3, seg=None),
                  cust(4, seg="B")],
        Cuentas=[acct(1, 1, 100), acct(2, 1, 400), acct(3, 2, 700, active=False),
                 acct(4, 3, 10000), acct(5, 4, 10)],
    )
    # mean of segment A over all its accounts = (100 + 400 + 700) / 3 = 400
    rows = collect(q.d1_above_segment_mean(t), "id_cliente", "saldo", "media_segmento")
    assert rows == []
    t2 = make_tables(
        spark,
        Clientes=[cust(1, seg="A"), cust(2, seg="A", active=False), cust(3, seg=None)],
        Cuentas=[acct(1, 1, 100), acct(2, 1, 500.01), acct(3, 2, 600), acct(4, 3, 10000)],
    )
    rows = collect(q.d1_above_segment_mean(t2), "id_cliente", "saldo", "media_segmento")
    assert rows == [(1, 500.01, 400.0)]
    assert collect(q.d1_correlated_sql(t2), "id_cliente", "saldo", "media_segmento") == rows


# ------------------------------------------------------------------ exclusion
def _deposit_tables(spark, holder_ids):
    return make_tables(
        spark,
        Clientes=[cust(1), cust(2), cust(3)],
        Cuentas=[acct(1, 1, 9000), acct(2, 2, 8000), acct(3, 3, 7000)],
        ScoreCliente=[score(1), score(2), score(3)],
        Productos=[(1, "Depósito"), (2, "Tarjeta")],
        ClienteProductos=[(i, c, 1, "Activo") for i, c in enumerate(holder_ids)]
        + [(90, 3, 1, "Cancelado"), (91, 3, 2, "Activo")],
    )


def test_anti_join_vs_null_aware_not_in(spark):
    t = _deposit_tables(spark, [1])
    assert collect(q.g1_deposit_candidates(t), "id_cliente") == [(2,), (3,)]
    assert collect(q.g1_deposit_not_in(t), "id_cliente") == [(2,), (3,)]
    with_null = _deposit_tables(spark, [1, None])
    # NOT EXISTS ignores the null; NOT IN with a null in the set keeps nothing
    assert collect(q.g1_deposit_candidates(with_null), "id_cliente") == [(2,), (3,)]
    assert collect(q.g1_deposit_not_in(with_null), "id_cliente") == []
    empty = _deposit_tables(spark, [])
    assert collect(q.g1_deposit_not_in(empty), "id_cliente") == [(1,), (2,), (3,)]


# ------------------------------------------------------------------ G2 / nulls
def test_g2_products_propensities_and_nulls(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1, last=None), cust(2), cust(3), cust(4)],
        Cuentas=[acct(1, 1, 500), acct(2, 1, 500), acct(3, 2, 400), acct(4, 3, 300),
                 acct(5, 4, 200)],
        ScoreCliente=[score(1), score(2, ah=False), score(3, ah=None), score(4, ah=False,
                                                                           inv=False)],
        ClienteProductos=[(1, 1, 5, "Activo"), (2, 1, 6, "Activo"), (3, 2, 5, "Cancelado")],
    )
    rows = collect(q.g2_score_360(t), "id_cliente", "cliente", "total_propensiones",
                   "productos_activos")
    # customer 1: two equal-balance accounts keep a row each, 2 active products;
    # customer 2: only a cancelled product -> 0; customer 3: null flag -> dropped;
    # customer 4: one propensity -> dropped
    assert rows == [(1, None, 3, 2), (1, None, 3, 2), (2, "N2 Apellido", 2, 0)]


def test_h4_keeps_null_segment_group(spark):
    t = make_tables(
        spark,
        Clientes=[cust(1, seg=None), cust(2, seg="A")],
        Cuentas=[acct(1, 1, 100), acct(2, 1, 300), acct(3, 2, 50)],
    )
    got = collect(q.h4_segment_size(t), "segmento", "num_clientes", "saldo_medio")
    assert sorted(got, key=repr) == sorted([(None, 1, 200.0), ("A", 1, 50.0)], key=repr)
    assert collect(q.j3_kpi_customers(t)) == [(2,)]


def test_age_calendar_vs_days365(spark):
    df = spark.createDataFrame([(d("1960-06-15"),), (d("2020-02-29"),)], "dob date")
    cal = collect(df.select(age_years("dob", "2024-06-05").alias("a")))
    approx = collect(df.select(age_years("dob", "2024-06-05", mode="days365").alias("a")))
    assert cal == [(63,), (4,)]
    assert approx == [(64,), (4,)]
    leap = collect(df.select(age_years("dob", "2021-02-28").alias("a")))
    assert leap[1] == (0,)


def test_share_of_total_zero_total_is_null(spark):
    from bancalyt.operators import share_of_total
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v long")
    assert collect(share_of_total(df, "v"), "pct") == [(None,), (None,)]
    df2 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    assert sorted(collect(share_of_total(df2, "v"), "pct")) == [(33.3,), (66.7,)]


def test_empty_tables_give_empty_or_zero_results(spark):
    t = make_tables(spark)
    assert q.a1_card_offer(t).count() == 0
    assert collect(q.j3_kpi_customers(t)) == [(0,)]
    assert q.e2_risk_share(t).count() == 0
    assert collect(q.j6_kpi_overdue(t)) == [(0, 0)]


def test_a_status_of_its_own_has_its_own_column(spark):
    from bancalyt.sources.testdata import from_testdata
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    t = from_testdata(spark, SF_SMALL)
    loans = t.prestamos.withColumn("estado", F.when(F.col("id_prestamo") % 11 == 0, "Sexto").otherwise(F.col("estado")))
    changed = type(t).from_mapping({**dict(t.items()), "Prestamos": loans})
    wide = q.j2_loan_pivot(changed, statuses=None)
    states = [c for c in wide.columns if c not in ("id_sucursal", "sucursal")]
    assert "Sexto" in states
    sums = {r["id_sucursal"]: sum(r[c] for c in states) for r in wide.collect()}
    want = {}
    for r in q.h8_loan_status(changed).collect():
        want[r["id_sucursal"]] = want.get(r["id_sucursal"], 0) + r["total"]
    assert sums == want
