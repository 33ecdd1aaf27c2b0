import pytest
from pyspark.sql import functions as F

from mercadal.plans.pipeline import PipelineConfig, run_pipeline
from mercadal.schemas import CATEGORIES


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("medallion"))
    return run_pipeline(spark, PipelineConfig(root=root, as_of="2026-06-01 00:00:00")), root


def test_zone_rows_and_bands(run):
    result, _ = run
    assert result.bronze["transacciones"].count() == 5000
    assert result.bronze["eventos"].count() == 8000
    assert abs(result.silver["transacciones"].count() - 4591) < 100
    assert abs(result.silver["eventos"].count() - 7316) < 120
    assert 432 <= result.gold["ventas_categoria_mes"].count() <= 504
    assert result.gold["conversion_funnel"].count() == 5
    violations = {(r.dataset, r.rule): r.violations for r in result.report.collect()}
    assert violations[("transacciones", "R01")] == 0
    assert 30 < violations[("transacciones", "R02")] < 90
    assert violations[("transacciones", "R08")] == 0
    assert 90 < violations[("eventos", "R06")] < 240
    assert violations[("eventos", "R04b")] == 0


def test_gold_totals_equal_silver(run):
    result, _ = run
    silver = result.silver["transacciones"].agg(F.sum("amount"), F.count("*")).first()
    gold = result.gold["ventas_categoria_mes"].agg(
        F.sum("total_ingresos"), F.sum("num_transacciones")
    ).first()
    assert gold[0] == pytest.approx(silver[0]) and gold[1] == silver[1]
    assert set(result.silver["transacciones"].columns) >= {
        "year", "month", "_ingested_at", "_source_file",
    }
    assert "_row_id" not in result.silver["transacciones"].columns


def test_queries(run):
    result, _ = run
    top = result.results["top_categorias"].collect()
    assert {r.category for r in top} == set(CATEGORIES)
    series = result.results["serie_temporal"].collect()
    assert [r.periodo for r in series][:2] == ["2024-01", "2024-02"]
    assert series[-1].ingresos_acum == pytest.approx(sum(r.ingresos_mes for r in series))
    assert sum(r.pct_ingresos for r in result.results["geo"].collect()) == pytest.approx(100, abs=0.1)
    segments = result.results["rfm_segmentos"].collect()
    users = result.gold["perfil_usuarios"].count()
    assert sum(r.num_usuarios for r in segments) == users
    assert len(result.results["dispositivos"].collect()) == 12


def test_lineage_and_files(spark, run):
    result, root = run
    log = {(r.transformacion, r.origen): r for r in result.lineage.collect()}
    assert len(log) == 7
    for row in log.values():
        assert row.filas_eliminadas == max(0, row.filas_entrada - row.filas_salida)
        assert row.segundos > 0
    for name in ("top_categorias", "serie_temporal", "rfm_segmentos", "geo"):
        assert spark.read.parquet(f"{root}/metrics/query_{name}.parquet").count() > 0
    assert spark.read.json(f"{root}/metadata/catalogo").count() == 1
    assert spark.read.json(f"{root}/metrics/reporte_calidad/eventos").count() == 1


def test_second_run_appends_lineage_only(spark, run):
    result, root = run
    before = result.silver["transacciones"].count()
    again = run_pipeline(spark, PipelineConfig(root=root, as_of="2026-06-01 00:00:00"))
    assert again.silver["transacciones"].count() == before
    assert again.lineage.count() == 14
