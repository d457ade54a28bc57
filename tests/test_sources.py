"""Readers, layer files, contracts."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.plans import medallion
from tidemark.session import work_folder
from tidemark.sources import contracts, layers
from tidemark.sources.tables import read_source, tickets


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_source(spark, str(tmp_path / "none"))


def test_csv_keeps_corrupt_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("numero,aberto\n1,2024-01-01\nx,2024-01-02\n")
    got = read_source(spark, str(tmp_path / "t.csv"), fmt="csv", schema="numero bigint, aberto string")
    rows = got.orderBy("aberto").collect()
    assert rows[0]["_corrupt_record"] is None and rows[1]["_corrupt_record"] == "x,2024-01-02"


def test_json_source(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"numero": 1, "status": "a"}\n{broken\n')
    got = read_source(spark, str(tmp_path / "t.json"), fmt="json", schema="numero bigint, status string")
    assert {r["_corrupt_record"] for r in got.collect()} == {None, "{broken"}


def test_file_hashes(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_bytes(name.encode() * 1000)
    got = {r["path"][-1]: r["sha256"] for r in layers.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256(n.encode() * 1000).hexdigest() for n in "ab"}
    assert len(layers.file_fingerprint(spark, str(tmp_path)).first()["fingerprint"]) == 64


def test_fingerprint_ignores_order_and_sees_changes(spark, sf_dir):
    rows = tickets(spark, sf_dir).select("numero", "status")
    base = layers.content_fingerprint(rows).first()
    assert layers.content_fingerprint(rows.repartition(5).orderBy(F.desc("numero"))).first() == base
    assert layers.content_fingerprint(rows.where("numero > 0")).first() != base


def test_layer_round_trip(spark, sf_dir):
    rows = tickets(spark, sf_dir)
    path = work_folder(spark, "layer")
    written = layers.write_layer(rows, path, layer="silver", source_hash="f" * 64)
    back = layers.read_layer(spark, path)
    assert written == rows.count() == back.count()
    assert [c for c in back.columns if c.startswith("_")] == ["_ingested_at", "_source_layer", "_source_hash"]
    assert back.select("_source_hash").distinct().collect() == [("f" * 16,)]
    assert back.select("_ingested_at").distinct().count() == 1
    verdict = layers.check_layer(
        spark, path, rows_written=written, contract=contracts.TICKET_CONTRACT, time="aberto"
    ).first()
    assert verdict["ok"]


def test_work_folder_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared)


def test_contract_errors(spark, sf_dir):
    rows = tickets(spark, sf_dir)
    assert contracts.require_columns(rows.withColumn("lote", F.lit(1)), contracts.TICKET_CONTRACT) == ["lote"]
    with pytest.raises(contracts.ContractError, match="solucao"):
        contracts.require_columns(rows.drop("solucao", "status"), contracts.TICKET_CONTRACT)
    with pytest.raises(contracts.ContractError):
        contracts.require_no_leakage(rows, contracts.LEAKAGE_COLUMNS, "numero")
    contracts.require_no_leakage(rows.drop(*contracts.LEAKAGE_COLUMNS), contracts.LEAKAGE_COLUMNS, "numero")


def test_type_contract(spark, sf_dir):
    with pytest.raises(contracts.ContractError, match="duracao"):
        contracts.require_types(tickets(spark, sf_dir).withColumn("duracao", F.lit("1")), contracts.TICKET_TYPES)
    contracts.require_types(tickets(spark, sf_dir), contracts.TICKET_TYPES)


def test_known_domains_hold(spark, sf_dir):
    assert contracts.domain_violations(tickets(spark, sf_dir), contracts.TICKET_DOMAINS).count() == 0


def test_audit_of_an_empty_input(spark):
    audit = contracts.RowAudit()
    empty = audit.watch(spark.createDataFrame([], "a int"), "source")
    audit.watch(empty.where("a > 1"), "filter").write.format("noop").mode("overwrite").save()
    assert audit.table(spark).collect() == [("filter", 0, 0, 0, 0.0)]


def test_bronze_types_text_times(spark, sf_dir):
    rows = tickets(spark, sf_dir).withColumns(
        {c: F.col(c).cast("string") for c in medallion.TIME_COLUMNS}
    )
    got = medallion.bronze(rows, contracts.TICKET_CONTRACT, text_times=True)
    assert dict(got.dtypes)["aberto"] == "timestamp_ntz"
    assert got.exceptAll(tickets(spark, sf_dir)).count() == 0


def test_approximate_profile(spark, sf_dir):
    from tidemark.operators.profile import profile

    rows = tickets(spark, sf_dir).select("numero", "produto")
    exact = {r["column_name"]: r for r in profile(rows).collect()}
    near = {r["column_name"]: r for r in profile(rows, approximate=True).collect()}
    assert near["produto"]["n_null"] == exact["produto"]["n_null"]
    assert abs(near["numero"]["n_distinct"] - exact["numero"]["n_distinct"]) < 0.1 * exact["numero"]["n_distinct"]


def test_risk_table_has_no_leakage(spark, sf_dir):
    clean = medallion.silver(tickets(spark, sf_dir), year=2024)
    contracts.require_no_leakage(medallion.gold_risk(clean), contracts.LEAKAGE_COLUMNS, "numero")
