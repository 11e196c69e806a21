from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallystone.operators import models
from tallystone.plans.analysis import analyze
from tallystone.plans.catalog.modelling import LOAN_ANALYSIS
from tallystone.plans.catalog.registry import loan
from tallystone.plans.prepare import fit_preparation, loan_settings
from tallystone.session import materialize
from tallystone.sources.report import significant_findings, write_report
from tallystone.sources.tables import LOAN_SCHEMA, save_results
from tallystone.streaming.score import prepare_stream, read_stream, score_stream, write_stream


def test_analysis_gives_every_result(spark, sf, tmp_path):
    df = materialize(loan(spark, sf))
    out = analyze(df, replace(LOAN_ANALYSIS, plots=True, correction="bonferroni"))
    for name, table in out.items():
        assert table.columns, name
        if name != "missing":
            assert table.count() > 0, name
    assert out["missing"].count() == 0
    lines = [r["line"] for r in out["summary"].collect()]
    assert lines[0] == f"Rows: {df.count()}, columns: 13" and lines[1] == "Missing values: None"
    assert any(line.startswith("Chi-square tests: ") for line in lines)
    write_report(out["summary"], str(tmp_path / "report"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()] == lines
    save_results(out, str(tmp_path / "results"), "run1")
    assert spark.read.parquet(str(tmp_path / "results/chi_square")).count() == 5
    assert significant_findings(out["group_tests"], out["chi_square"]).columns[0] == "test"


def test_stream_gives_what_batch_gives(spark, sf, tmp_path):
    settings = replace(loan_settings(), keep_key=True)
    df = loan(spark, sf)
    fitted = fit_preparation(df, settings)
    batch = fitted.apply(df)
    names = [c for c in batch.columns if c not in ("Customer_ID", "Loan_Status")]
    trained = models.train("RandomForest", models.assemble(batch, names, "Loan_Status"), {"n_estimators": 3})
    scorer = models.scoring_pipeline(names, trained.model)
    folder = str(tmp_path / "in")
    df.repartition(3).write.parquet(folder)

    def scored(frame):
        return score_stream(frame, scorer).select("Customer_ID", "prediction", models.probability().alias("p"))

    stream = scored(prepare_stream(read_stream(spark, folder, LOAN_SCHEMA), fitted))
    assert stream.isStreaming
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    write_stream(stream, out, mark).awaitTermination()
    want = {tuple(r) for r in scored(batch).collect()}
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == want
    # files already seen are not read again, new ones are
    late = df.limit(1).withColumn("Customer_ID", F.lit(-1).cast("long"))
    late.write.mode("append").parquet(folder)
    stream = scored(prepare_stream(read_stream(spark, folder, LOAN_SCHEMA), fitted))
    write_stream(stream, out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == len(want) + 1


def test_a_stream_cannot_look_at_whole_columns(spark, sf):
    settings = replace(loan_settings(), outlier_method="iqr", outlier_action="transform", outlier_columns=["Loan_Amount"])
    fitted = fit_preparation(loan(spark, sf), settings)
    with pytest.raises(ValueError):
        prepare_stream(loan(spark, sf), fitted)
