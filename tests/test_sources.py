from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trustgauge.operators import errors
from trustgauge.plans import experiment
from trustgauge.sources import labelled, sinks, workspace


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_labelled_csv(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        'id,keyword,location,text,target\n1,a%20b,NA,"two\nlines, ""quoted""",1\n2,,X,,0.9\n',
    )
    rows = labelled.load_labelled_csv(spark, path).orderBy("id").collect()
    assert rows[0].asDict() == {
        "id": 1, "keyword": "a%20b", "location": None, "text": 'two\nlines, "quoted"', "target": 1,
    }
    assert (rows[1]["text"], rows[1]["keyword"], rows[1]["target"]) == ("", None, 0)


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        labelled.load_labelled_csv(spark, str(tmp_path / "none.csv"))
    path = write(tmp_path / "b.csv", "id,keyword\n1,a\n")
    with pytest.raises(ValueError, match=r"\['target', 'text'\]"):
        labelled.load_labelled_csv(spark, path)


def test_missing_target_fails(spark, tmp_path):
    path = write(tmp_path / "c.csv", "id,text,target\n1,a,\n")
    with pytest.raises(Exception, match="missing target"):
        labelled.load_labelled_csv(spark, path).collect()


def test_derived_ids_tell_copies_apart(spark, monkeypatch):
    monkeypatch.setattr(labelled, "COPY_RUN", 3)
    df = spark.createDataFrame([("a", 1)] * 10 + [("b", 0), (None, 0)], "text string, target int")
    ids = [r["id"] for r in labelled.with_row_ids(df.repartition(3)).collect()]
    again = [r["id"] for r in labelled.with_row_ids(df.repartition(1)).collect()]
    assert len(set(ids)) == 12 and set(ids) == set(again)


def test_parquet_source(spark, tmp_path):
    spark.createDataFrame([(None, 1)], "text string, target int").write.parquet(str(tmp_path / "p"))
    row = labelled.load_labelled_parquet(spark, str(tmp_path / "p")).first()
    assert row["text"] == "" and row["target"] == 1 and row["id"]
    with pytest.raises(FileNotFoundError):
        labelled.load_labelled_parquet(spark, str(tmp_path / "none"))


def test_saved_errors_are_categorised_again(spark, tmp_path):
    path = write(
        tmp_path / "errors.csv",
        "model,text,true_label,predicted_label,confidence,prob_yes\n"
        "a/raw,a movie,0,1,0.97,0.97\na/raw,flood,1,0,0.91,0.09\n",
    )
    written = experiment.recategorize_saved(spark, path, str(tmp_path / "out"))
    assert len(written) == 4
    rows = spark.read.csv(written[0], header=True).orderBy("text").collect()
    assert [r["category"] for r in rows] == ["fiction_entertainment", "short_or_low_context_real_disaster"]
    assert all(r["is_high_confidence"] == "true" and not r["keyword"] for r in rows)
    empty = write(tmp_path / "empty.csv", "model,text,true_label,predicted_label,confidence\n")
    with pytest.raises(ValueError, match="empty"):
        labelled.load_saved_errors(spark, empty)


def test_recategorize_keeps_a_keyword_column(spark):
    saved = spark.createDataFrame([("x", 0, 1, "k")], "text string, true_label int, predicted_label int, keyword string")
    assert errors.recategorize(saved).first()["keyword"] == "k"


def test_tables_keep_their_column_order(spark, tmp_path):
    df = spark.createDataFrame([(1, "m", 0.5, 2, 3, None)], "answered long, model string, threshold double, coverage int, rejected long, selective_accuracy double")
    path = sinks.write_table(df, str(tmp_path), "rejection_curves", "csv")
    assert spark.read.csv(path, header=True).columns == sinks.RESULT_COLUMNS["rejection_curves"]
    by_family = sinks.write_by_family(df.withColumn("base_model", F.lit("f")), str(tmp_path), "x")
    assert spark.read.parquet(by_family).first()["base_model"] == "f"


def test_settled_tables_live_in_the_shared_folder(spark):
    table = workspace.settle(spark.range(5), partition_by=())
    assert table.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in table.inputFiles())


def test_intermediate_tables_can_be_swept(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from trustgauge.sources import workspace

    before = list(workspace._handed_out)
    workspace._handed_out.clear()
    workspace.settle(spark.range(3))
    path = Path(urlparse(workspace._handed_out[0]).path)
    assert path.exists()
    assert workspace.sweep(spark) == 1 and not path.exists()
    workspace._handed_out.extend(before)


def test_text_ids_stay_and_repeated_ids_are_replaced(spark, tmp_path):
    rows = [("a1", " x ", 1), ("b2", "y\n", 0)]
    spark.createDataFrame(rows, "id string, text string, target int").write.parquet(f"{tmp_path}/t")
    assert {r["id"] for r in labelled.load_labelled_parquet(spark, f"{tmp_path}/t").collect()} == {"a1", "b2"}
    again = [(1, "x", 1), (1, "y", 0), (None, "y", 0)]
    spark.createDataFrame(again, "id long, text string, target int").write.parquet(f"{tmp_path}/u")
    got = labelled.load_labelled_parquet(spark, f"{tmp_path}/u").collect()
    assert len({r["id"] for r in got}) == 3 and None not in {r["id"] for r in got}
