"""The whole layer run and the stream versions of its first steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import risk
from tidemark.plans import medallion
from tidemark.plans.run import build_layers
from tidemark.session import work_folder
from tidemark.sources import contracts, layers
from tidemark.sources.tables import tickets
from tidemark.streaming import tickets as stream


def test_build_layers(spark, sf_dir):
    raw = tickets(spark, sf_dir)
    old = raw.limit(7).withColumns(
        {"numero": F.col("numero") + 10_000_000, "aberto": F.expr("aberto - INTERVAL 400 DAYS")}
    )
    doubled = raw.unionByName(old).unionByName(raw.where("numero % 10 = 0"))
    run = build_layers(doubled, work_folder(spark, "run"), year=2024, minimum_group=50)
    n = raw.count()
    copies = raw.where("numero % 10 = 0").count()
    steps = {r["step"]: (r["n_before"], r["n_after"]) for r in run.audit.collect()}
    assert steps == {"ano": (n + copies + 7, n + copies), "primeiro_por_numero": (n + copies, n)}
    assert run.rows["bronze"] == n + copies + 7 and run.rows["silver"] == run.rows["chamados_risco"] == n
    assert run.rows["volume_diario"] == 30
    assert run.new_values.count() == 0
    risk_rows = layers.read_layer(spark, run.paths["chamados_risco"])
    assert [c for c in risk_rows.columns if not c.startswith("_")] == medallion.RISK_COLUMNS
    assert risk_rows.select("_source_layer", "_source_hash").distinct().collect() == [
        ("gold", run.source_hash[:16])
    ]
    # The capped branch equals a direct silver table.
    silver = layers.read_layer(spark, run.paths["silver"])
    direct = medallion.silver(raw, year=2024)
    same = ["numero", "duracao_capped_p99", "descricao_limpa", "_flag_resolvido_apos_encerrado"]
    assert silver.select(same).exceptAll(direct.select(same)).count() == 0


def _drain(query) -> None:
    query.awaitTermination(120)
    assert query.exception() is None


def test_streams(spark, sf_dir, tmp_path):
    raw = tickets(spark, sf_dir)
    source = work_folder(spark, "incoming")
    raw.repartition(3).write.parquet(source)
    raw.where("numero < 50").write.mode("append").parquet(source)
    incoming = stream.read_tickets(spark, source, raw.schema)
    bronze = work_folder(spark, "bronze")
    rows = stream.bronze_stream(incoming, contracts.TICKET_CONTRACT, lateness="60 days")
    _drain(stream.start_append(rows, bronze, str(tmp_path / "mark-bronze")).trigger(availableNow=True).start())
    got = spark.read.parquet(bronze)
    assert got.count() == got.select("numero").distinct().count() == raw.count()

    volume = work_folder(spark, "volume")
    counts = stream.volume_stream(incoming, lateness="1 day")
    _drain(stream.start_append(counts, volume, str(tmp_path / "mark-volume")).trigger(availableNow=True).start())
    closed = {str(r["inicio"])[:10]: r["total"] for r in spark.read.parquet(volume).collect()}
    days = incoming_days(spark, source)
    assert closed and all(days[d] == n for d, n in closed.items())


def incoming_days(spark, source):
    rows = spark.read.parquet(source).groupBy(F.to_date("aberto").cast("string").alias("d")).count()
    return {r["d"]: r["count"] for r in rows.collect()}


def test_stream_scoring(spark, sf_dir):
    clean = medallion.silver(tickets(spark, sf_dir), year=2024)
    rows = medallion.gold_risk(clean).withColumn("target", (F.hash("numero") % 5 == 0).cast("int"))
    stored = work_folder(spark, "gold")
    rows.write.parquet(stored)
    gold = spark.read.parquet(stored)
    model = risk.fit_logistic(gold, "target", max_iter=5).model
    out = work_folder(spark, "scores")
    write = stream.score_batches(model, lambda m, b: risk.score_rows(m, b, "numero", []), out)
    query = (
        spark.readStream.schema(gold.schema).parquet(stored).writeStream.foreachBatch(write)
        .option("checkpointLocation", work_folder(spark, "stream")).trigger(availableNow=True).start()
    )
    _drain(query)
    assert spark.read.parquet(out).count() == gold.count()


def test_wanted_rows_have_the_same_history(spark):
    """Rows that are not asked for still count as history, but do not reach the join by number."""
    from datetime import datetime, timedelta

    start = datetime(2024, 3, 1)
    raw = spark.createDataFrame(
        [(i, start + timedelta(minutes=20 * (i // 2)), f"P{i % 2}", f"ic{i % 3}", [None, "T1", "T2"][i % 3], f"texto {i % 4}",
          "INC1" if i % 5 == 0 else None, ["SIM", "NAO", None][i % 3 if i % 7 else 2]) for i in range(60)],
        "numero long, aberto timestamp_ntz, prioridade string, item_configuracao string, grupo_designado string, descricao_limpa string, incidente_pai string, entrou_kpi string",
    ).selectExpr(
        "*", *[f"cast(null as string) {c}" for c in ("produto", "categoria", "subcategoria", "aberto_por", "kpi_violado")],
        "false flag_categorizado",
    )
    assert set(raw.columns) == set(medallion.RISK_INPUTS)
    wanted = F.col("entrou_kpi") == "SIM"
    part, whole = medallion.gold_risk(raw, 25, wanted=wanted), medallion.gold_risk(raw, 25)
    got = sorted(map(str, part.collect()))
    assert got and got == sorted(map(str, whole.where(wanted).collect()))
    history = medallion.ticket_history(raw, wanted=wanted)
    assert history.count() == len(got) and history.columns == medallion.ticket_history(raw).columns
