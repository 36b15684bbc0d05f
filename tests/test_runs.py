import pytest

from facetforge.operators.runs import PhaseTimer, compare_times, write_report
from facetforge.plans.compare import compare_logs, compare_metrics
from facetforge.sources.logs import read_run_log, run_metrics

SLOW = """\
12:00:01 INFO Data loading and preparation completed in 2500 ms
12:00:02 INFO Model training completed in 12000 ms
12:00:02 INFO Prediction completed in 3000 ms
12:00:02 INFO Model Accuracy: 0.9985
12:00:02 INFO Vector storage completed in 900 ms
12:00:03 INFO Processing completed successfully in 18000 ms
12:00:03 INFO Processing mode: plain
"""
FAST = """\
12:00:01 INFO Data loading and preparation completed in 0 ms
12:00:02 INFO Model training completed in 1500 ms
12:00:02 INFO Model Accuracy: 0.9980
12:00:03 INFO Processing completed successfully in 5300 ms
"""


@pytest.fixture
def logs(tmp_path):
    (tmp_path / "slow.log").write_text(SLOW)
    (tmp_path / "fast.log").write_text(FAST)
    return tmp_path


def test_log_pair(spark, logs):
    times, accuracies = compare_logs(
        spark, [str(logs / "slow.log"), str(logs / "fast.log")], "slow", "fast", str(logs / "report")
    )
    assert {tuple(r) for r in times.collect()} == {
        ("prepare", 2500, 0, None),
        ("train", 12000, 1500, 8.0),
        ("predict", 3000, None, None),
        ("sink", 900, None, None),
        ("total", 18000, 5300, 3.39),
    }
    row = accuracies.first()
    assert (row["first_value"], row["second_value"]) == (0.9985, 0.9980)
    assert row["difference"] == pytest.approx(0.0005)
    text = [r["value"] for r in spark.read.text(str(logs / "report" / "text")).collect()]
    assert text[:2] == ["| Phase | slow (ms) | fast (ms) | Speedup |", "| --- | --- | --- | --- |"]
    assert "| predict | 3000 | N/A | N/A |" in text and len(text) == 10
    assert text[-1] == "| accuracy | 0.9985 | 0.9980 | 0.0005 |"
    assert spark.read.parquet(str(logs / "report" / "table")).count() == 5


def test_only_metric_lines_are_kept(spark, logs):
    metrics = run_metrics(read_run_log(spark, str(logs / "slow.log")))
    assert metrics.count() == 6 and metrics.select("run").distinct().first()["run"] == "slow"


def test_missing_run(spark, logs):
    metrics = run_metrics(read_run_log(spark, str(logs / "slow.log")))
    times, _ = compare_metrics(metrics, "slow", "absent")
    assert {r["speedup"] for r in times.collect()} == {None}


def test_timer_table(spark, tmp_path):
    for run in ("a", "b"):
        timer = PhaseTimer(run)
        with timer.phase("train"):
            pass
        with pytest.raises(KeyError), timer.phase("predict"):
            raise KeyError
        timer.finish()
        timer.append_to(spark, str(tmp_path / "metrics"))
    metrics = spark.read.parquet(str(tmp_path / "metrics"))
    assert metrics.count() == 6
    times = compare_times(metrics, "a", "b")
    assert {r["phase"] for r in times.collect()} == {"train", "predict", "total"}
    write_report(times, str(tmp_path / "report"), "a", "b")


def test_own_log_lines_can_be_mined(spark, tmp_path, caplog):
    caplog.set_level("INFO", logger="facetforge")
    timer = PhaseTimer("own")
    recorded = {"prepare": 12, "train": 30, "predict": 5, "evaluate": 8, "sink": 6}
    recorded |= {"accuracy": 0.75, "auc": 0.5, "total": 99}
    for metric, value in recorded.items():
        timer.record(metric, value)
    (tmp_path / "own.log").write_text("\n".join(caplog.messages))
    metrics = run_metrics(read_run_log(spark, str(tmp_path / "own.log")))
    assert sorted(map(tuple, metrics.collect())) == sorted(timer.rows)


def test_phases_keep_their_own_names(spark):
    lines = [
        ("INFO Post-processing completed in 5 ms", "post-processing"),
        ("2024-01-01 INFO a.B: Model training completed successfully in 5 ms", "train"),
        ("[main] GPU prediction completed in 5 ms", "predict"),
        ("Vector storage completed in 5 ms", "sink"),
    ]
    frame = spark.createDataFrame([(n, x) for x, n in lines], "run string, value string")
    found = run_metrics(frame).collect()
    assert len(found) == 4 and all(r["run"] == r["metric"] and r["value"] == 5 for r in found)
