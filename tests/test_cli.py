import json

import numpy as np
import pandas as pd

from cyclewise import cli

from .conftest import make_telemetry


def test_train_command_end_to_end(spark, tmp_path, capsys):
    pdf = make_telemetry(units=12, cycles=40, setting_scale=0.1)
    d = tmp_path / "data"
    d.mkdir()
    lines = [" ".join(str(int(v)) if i < 2 else f"{v:.4f}" for i, v in enumerate(row)) + "  " for row in pdf.to_numpy()]
    (d / "train_FD001.txt").write_text("\n".join(lines) + "\n")
    (d / "test_FD001.txt").write_text("\n".join(lines[:200]) + "\n")
    (d / "RUL_FD001.txt").write_text("\n".join(str(v) for v in [50, 60, 40, 55, 45, 30]) + "\n")
    out = tmp_path / "run"
    rc = cli.main(["train", "--data-dir", str(d), "--out", str(out), "--trees", "5", "--depth", "4", "--val-share", "0.4"])
    assert rc == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["best_model"] in ("forest", "boosted") and res["rmse"] >= 0
    assert (out / "best_model" / "model").exists() and (out / "pipeline" / "scaler").exists()


def test_drift_command(spark, tmp_path):
    rng = np.random.default_rng(1)
    ref = pd.DataFrame({f"feature_{i}": rng.normal(0, 1, 300) for i in range(3)})
    cur = pd.DataFrame({f"feature_{i}": rng.normal(0.5 if i == 0 else 0, 1, 200) for i in range(3)})
    spark.createDataFrame(ref).write.parquet(str(tmp_path / "ref"))
    spark.createDataFrame(cur).write.parquet(str(tmp_path / "cur"))
    assert cli.main(["drift", "--reference", str(tmp_path / "ref"), "--current", str(tmp_path / "cur"), "--out", str(tmp_path / "d")]) == 0
    s = spark.read.json(str(tmp_path / "d" / "summary")).first()
    assert s["total_features"] == 3 and "feature_0" in s["drifted_features"]


def test_list_and_run_commands(spark, tmp_path, capsys):
    from .conftest import SF_SMALL

    assert cli.main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "l1_w1_w6_feature_build" in names and len(names) >= 100
    out = tmp_path / "p6"
    assert cli.main(["run", "p6_dataset_info", "--sf", SF_SMALL, "--out", str(out)]) == 0
    assert spark.read.parquet(str(out)).count() == 1
