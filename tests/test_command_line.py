from mercadal.__main__ import main, parser


def test_arguments():
    args = parser().parse_args(["medallion", "--root", "/x", "--transacciones", "10"])
    assert (args.job, args.transacciones, args.eventos, args.seed) == ("medallion", 10, 8000, 42)


def test_sales_job(spark, tmp_path, capsys):
    main(["ventas", "--root", str(tmp_path), "--transacciones", "200"])
    out = capsys.readouterr().out
    assert "Resumen General" in out and "Top 5 Productos" in out
    lines = [r.value for r in spark.read.text(str(tmp_path / "reporte")).collect()]
    assert any(line.startswith("1. Resumen General | {") for line in lines)
    assert spark.read.parquet(str(tmp_path / "reporte_diario")).count() > 0
