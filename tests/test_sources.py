"""Sources, schema conformance, registry."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from bancalyt.plans.registry import BLOCKS, REGISTRY, catalog_df, run, run_all, run_block
from bancalyt.sources import (
    SCHEMAS,
    KeyRange,
    jdbc_read_options,
    load_parquet,
    schema_report,
    source_profile,
    write_parquet,
)
from bancalyt.sources.tables import BankTables, conform
from bancalyt.sources.testdata import from_testdata
from conftest import SF_SMALL, collect


def test_testdata_mapping_emits_declared_schema(spark):
    t = from_testdata(spark, SF_SMALL)
    for name, df in t.items():
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in SCHEMAS[name].fields]
        assert got == want, name


def test_conform_casts_flags_and_money(spark):
    df = spark.createDataFrame([(1, 7, "x", 12.345, 1, "extra")],
                               "id_cuenta long, id_cliente long, tipo_cuenta string, "
                               "saldo double, activa int, other string")
    out = conform(df, "Cuentas")
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "bigint", "bigint", "string", "decimal(14,2)", "boolean"]
    assert collect(out)[0][4] is True


def test_parquet_roundtrip(spark, tmp_path):
    t = from_testdata(spark, SF_SMALL)
    base = str(tmp_path / "bank")
    write_parquet(t, base)
    back = load_parquet(spark, base)
    a = collect(run(spark, "h7_province_balance", t))
    b = collect(run(spark, "h7_province_balance", back))
    assert a == b
    assert sorted(collect(source_profile(back))) == sorted(collect(source_profile(t)))


def test_parquet_of_other_types(spark, tmp_path):
    # what an export of a database gives: money as double, flags and ids as int
    base = str(tmp_path / "bank")
    write_parquet(from_testdata(spark, SF_SMALL), base)
    spark.createDataFrame([(1, 7, "x", 12.345, 1), (2, 8, "y", 5.0, 0)],
                          "id_cuenta int, id_cliente int, tipo_cuenta string, saldo double, activa int"
                          ).write.mode("overwrite").parquet(f"{base}/Cuentas")
    back = load_parquet(spark, base)
    assert [(r.id_cuenta, str(r.saldo), r.activa) for r in back.cuentas.orderBy("id_cuenta").collect()] == [
        (1, "12.35", True), (2, "5.00", False)]
    assert run(spark, "a1_card_offer", back).count() >= 0


def test_profile_of_a_broken_table_leaves_the_others(spark, tmp_path):
    t = from_testdata(spark, SF_SMALL)
    base = str(tmp_path / "bank")
    write_parquet(t, base)
    back = load_parquet(spark, base)
    shutil.move(f"{base}/Productos", f"{base}/elsewhere")
    rows = {r.tabla: r for r in source_profile(back).collect()}
    assert rows["Productos"].filas is None and rows["Productos"].error
    assert rows["Clientes"].filas == t.clientes.count() and rows["Clientes"].error is None


def test_new_files_are_seen(spark, tmp_path):
    import __spark_entry__ as entry
    folder = tmp_path / "sf"
    folder.mkdir()
    for file in os.listdir(SF_SMALL):  # contents only: the originals may be read-only
        shutil.copyfile(f"{SF_SMALL}/{file}", folder / file)
    before = {r.tabla: r.filas for r in entry.queries()["source_profile"](spark, str(folder)).collect()}
    table = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    table.limit(2).toPandas().to_parquet(folder / "region.parquet")
    after = {r.tabla: r.filas for r in entry.queries()["source_profile"](spark, str(folder)).collect()}
    assert before["Provincias"] == 5 and after["Provincias"] == 2


def test_configure_leaves_the_time_zone_alone():
    from bancalyt.session import DEFAULTS
    assert "spark.sql.session.timeZone" not in DEFAULTS


def test_ages_are_as_of_today_unless_pinned(spark):
    from inspect import signature

    from bancalyt.plans import queries as q
    for fn in (q.a2_multi_product, q.g2_score_360):
        assert signature(fn).parameters["as_of"].default is None
    t = from_testdata(spark, SF_SMALL)
    pinned = [r.edad for r in run(spark, "a2_multi_product", t).collect()]
    later = [r.edad for r in run(spark, "a2_multi_product", t, as_of="2034-06-30").collect()]
    assert [x + 10 for x in pinned] == later
    assert "current_date" in run(spark, "a2_multi_product", t, as_of=None)._jdf.queryExecution().analyzed().toString()


def test_parameters_reach_every_query(spark):
    t = from_testdata(spark, SF_SMALL)
    assert run(spark, "a2_multi_product_days365", t, k=3).count() == 3
    assert run(spark, "g2_score_360_days365", t, k=2).count() == 2
    for key in ("source_profile", "c2_branch_metrics_exact"):
        with pytest.raises(ValueError, match="has no parameter k"):
            run(spark, key, t, k=None)
    assert run_block(spark, "recommendation", t, k=1)["g1_deposit_not_in"].count() == 1


def test_jdbc_needs_ranges_for_large_tables(spark, monkeypatch):
    from bancalyt.sources import jdbc
    with pytest.raises(ValueError, match="Cuentas"):
        jdbc.load_jdbc(spark, "jdbc:x", {}, discover=False)
    asked, read = [], []
    monkeypatch.setattr(jdbc, "key_range", lambda s, u, name, p: asked.append(name) or KeyRange(1, 9, 3))
    monkeypatch.setattr(jdbc, "read_jdbc_table", lambda s, u, name, p, key=None: read.append((name, key)) or
                        s.createDataFrame([], SCHEMAS[name]))
    t = jdbc.load_jdbc(spark, "jdbc:x", {"user": "u"}, ranges={"Cuentas": KeyRange(1, 5, 2)}, split="range")
    assert asked == [] and t.cuentas.count() == 0 and t.clientes.count() == 0
    assert asked == ["Clientes"] and read == [("Cuentas", KeyRange(1, 5, 2)), ("Clientes", KeyRange(1, 9, 3))]


def test_command_line_values():
    from bancalyt.__main__ import _params
    assert _params(["k=None", "above=1000", "as_of=2024-06-30"]) == {"k": None, "above": 1000, "as_of": "2024-06-30"}
    with pytest.raises(SystemExit):
        _params(["k"])


def test_source_profile_counts(spark):
    t = from_testdata(spark, SF_SMALL)
    prof = {r.tabla: r.filas for r in source_profile(t).collect()}
    assert prof["Clientes"] == t.clientes.count()
    assert prof["Sucursales"] == 25 and prof["Provincias"] == 5
    assert set(prof) == set(SCHEMAS)


def test_schema_report(spark):
    t = from_testdata(spark, SF_SMALL)
    rep = schema_report(spark, t)
    assert rep.count() == sum(len(s.fields) for s in SCHEMAS.values())


def test_jdbc_options_partition_on_primary_key():
    opts = jdbc_read_options("Cuentas", KeyRange(1, 1000, 4))
    assert opts["partitionColumn"] == "id_cuenta"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("1", "1001", "4")
    assert "partitionColumn" not in jdbc_read_options("Provincias", None)
    assert "partitionColumn" not in jdbc_read_options("Provincias", KeyRange(1, 20, 1))


def test_jdbc_url_and_properties():
    from bancalyt.sources import jdbc_properties, jdbc_url
    url = jdbc_url("db", 3306, "banco")
    assert url == ("jdbc:mysql://db:3306/banco?useSSL=false&serverTimezone=UTC"
                   "&allowPublicKeyRetrieval=true")
    assert jdbc_properties("u", "p", "org.mariadb.jdbc.Driver")["driver"] == "org.mariadb.jdbc.Driver"


def test_registry(spark):
    with pytest.raises(ValueError):
        run(spark, "zz", SF_SMALL)
    with pytest.raises(ValueError):
        run_block(spark, "nope", SF_SMALL)
    assert set(run_all(spark, SF_SMALL)) == set(REGISTRY)
    windows = run_block(spark, "windows", SF_SMALL)
    assert "b2_top3_province" in windows
    assert catalog_df(spark).count() == len(REGISTRY)
    assert BLOCKS[0] == "classification"


def test_lazy_tables_only_plan_what_is_used(spark):
    calls = []

    def factory(name):
        def make():
            calls.append(name)
            return spark.createDataFrame([], SCHEMAS[name])
        return make

    t = BankTables.from_mapping({n: factory(n) for n in SCHEMAS})
    t.clientes
    t.clientes
    assert calls == ["Clientes"]


def test_bucketed_catalog_joins_without_fact_shuffles(spark, tmp_path):
    from bancalyt.plans import queries as q
    from bancalyt.sources import load_catalog, save_bucketed

    t = from_testdata(spark, SF_SMALL)
    save_bucketed(t, "bank_bucketed", buckets=4, path=str(tmp_path / "wh"))
    b = load_catalog(spark, "bank_bucketed")
    assert sorted(collect(q.h4_segment_size(b))) == sorted(collect(q.h4_segment_size(t)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q.h4_segment_size(b)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p
        # only the final per-segment rollup shuffles; customers and accounts
        # meet bucket to bucket
        assert "hashpartitioning(id_cliente" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_command_line_runs_and_writes(spark, tmp_path, capsys):
    from bancalyt.__main__ import main

    assert main(["list"]) == 0
    assert "b2_top3_province" in capsys.readouterr().out
    out = str(tmp_path / "b2")
    assert main(["run", "b2_top3_province", "--testdata", SF_SMALL, "--out", out,
                 "--format", "json"]) == 0
    back = spark.read.json(out)
    assert back.count() == run(spark, "b2_top3_province", SF_SMALL).count()
    blk = str(tmp_path / "charts")
    assert main(["run-block", "charts", "--testdata", SF_SMALL, "--out", blk]) == 0
    assert spark.read.parquet(f"{blk}/h8_loan_status").count() > 0


def test_jdbc_predicates_split_sparse_keys_evenly(spark, monkeypatch):
    """No database here: the cuts that the database would give are taken from a
    frame, and the predicates are tried on it."""
    from bancalyt.sources import jdbc, jdbc_predicates
    keys = [1, 2, 3, 10**15, 10**15 + 1, *range(10**17, 10**17 + 7), None]
    frame = spark.createDataFrame([(k,) for k in keys], "id_cuenta long")
    cuts = [k for i, k in enumerate(sorted(k for k in keys if k is not None)) if i % 4 == 0]
    parts = jdbc_predicates("Cuentas", cuts)
    sizes = [frame.where(p).count() for p in parts]
    assert sum(sizes) == len(keys) and sizes == [5, 4, 4]
    assert jdbc_predicates("Cuentas", []) == jdbc_predicates("Cuentas", [7]) == ["1 = 1"]
    sql = jdbc.cuts_query("Cuentas", 4)
    assert "MIN(k)" in sql and "ORDER BY id_cuenta" in sql and "FROM Cuentas" in sql and "/ 4)" in sql
    read = []
    monkeypatch.setattr(jdbc, "key_cuts", lambda s, u, name, p: cuts)
    monkeypatch.setattr(jdbc, "read_jdbc_cuts", lambda s, u, name, p, c: read.append((name, c)) or s.createDataFrame([], SCHEMAS[name]))
    assert jdbc.load_jdbc(spark, "jdbc:x", {}).cuentas.count() == 0 and read == [("Cuentas", cuts)]
    conf = jdbc.jdbc_catalog_conf("bank", "jdbc:x", {"user": "u"})
    assert conf["spark.sql.catalog.bank.pushDownAggregate"] == conf["spark.sql.catalog.bank.pushDownLimit"] == "true"
    assert conf["spark.sql.catalog.bank.user"] == "u"


def test_profile_runs_nothing_before_it_is_used(spark, tmp_path):
    t = from_testdata(spark, SF_SMALL)
    write_parquet(t, str(tmp_path / "bank"))
    back = load_parquet(spark, str(tmp_path / "bank"))
    for name in SCHEMAS:
        back.table(name)  # Parquet schemas are looked up here
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("profile", "profile")
    df = source_profile(back)
    assert list(tracker.getJobIdsForGroup("profile")) == []
    p = df._jdf.queryExecution().executedPlan().toString()
    spark.sparkContext.setJobGroup("other", "other")
    assert p.count("ReadSchema: struct<>") == len(SCHEMAS)  # footers only


def test_report_has_records_and_metadata_from_one_job(spark, tmp_path):
    import json

    from bancalyt.sources import write_report
    df = spark.range(100).where("id % 3 = 0").withColumn("título", F.lit("ñ"))
    path = str(tmp_path / "out")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "report")
    found = write_report(df, path, {"id": "x1", "title": "Año"})
    assert len(tracker.getJobIdsForGroup("report")) == 1
    spark.sparkContext.setJobGroup("other", "other")
    assert found == {"id": "x1", "title": "Año", "columns": ["id", "título"], "total": 34}
    assert json.load(open(f"{path}/_metadata.json", encoding="utf-8")) == found
    assert spark.read.json(path).count() == 34


def test_listing_explains_every_query(spark):
    rows = catalog_df(spark).collect()
    assert all(r.explanation and r.explanation[0].isupper() or r.explanation.startswith(("`", ":", "(")) for r in rows)
