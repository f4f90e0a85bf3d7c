from __future__ import annotations

from argparse import Namespace

import pytest

from scoreloom.__main__ import run

DEFAULTS = dict.fromkeys(
    ["train", "test", "template", "submission", "target", "ledger", "model", "ensemble_type", "cv_score", "file", "notes",
     "out"]
) | {"scores": [], "n": 2, "strict": False, "single_file": False}


def call(spark, **given):
    return run(spark, Namespace(**{**DEFAULTS, **given}))


@pytest.fixture
def files(tmp_path):
    rows = [f"{i},{i % 13 / 3},{'ab'[i % 2]},{int(i % 4 < 2)}" for i in range(80)]
    (tmp_path / "train.csv").write_text("id,v,c,target\n" + "\n".join(rows) + "\n")
    (tmp_path / "test.csv").write_text("id,v,c\n100,1.5,a\n101,,b\n")
    (tmp_path / "sample.csv").write_text("id,target\n101,0.5\n100,0.5\n")
    return tmp_path


def test_reports(spark, files):
    assert call(spark, job="explore", train=f"{files}/train.csv", test=f"{files}/test.csv", out=f"{files}/e") == 0
    assert call(spark, job="profile", train=f"{files}/train.csv", out=f"{files}/p") == 0
    assert spark.read.json(f"{files}/e/types").count() == 3


def test_job_then_validation(spark, files, monkeypatch):
    from scoreloom import __main__ as cli
    from scoreloom.plans import scoring
    from scoreloom.suite.models import SMALL

    monkeypatch.setitem(cli.JOBS, "safety", lambda *t: scoring.safety(*t, SMALL["lgb"]))
    paths = {"train": f"{files}/train.csv", "test": f"{files}/test.csv", "template": f"{files}/sample.csv"}
    assert call(spark, job="safety", out=f"{files}/o", single_file=True, **paths) == 0
    written = next((files / "o" / "predictions").glob("*.csv"))
    assert [line.split(",")[0] for line in written.read_text().split()] == ["id", "101", "100"]
    check = {"job": "validate", "submission": str(written), "template": f"{files}/sample.csv"}
    assert call(spark, **check) == 0
    bad = files / "bad.csv"
    bad.write_text("id,target\n101,0.5\n")
    assert call(spark, **{**check, "submission": str(bad)}) == 1


def test_ledger_commands(spark, tmp_path, capsys):
    path = f"{tmp_path}/runs"
    for score in (0.7, 0.9):
        call(spark, job="ledger-add", ledger=path, model="m", cv_score=score, file="f")
    call(spark, job="ledger-update", ledger=path, scores=[0.6, 0.8], out=f"{tmp_path}/new")
    assert call(spark, job="ledger-best", ledger=path, out=f"{tmp_path}/best") == 0
    assert call(spark, job="ledger-select", ledger=f"{tmp_path}/new", n=1, out=f"{tmp_path}/final") == 0
    top = spark.read.json(f"{tmp_path}/final").first()
    assert (top["submission_id"], top["score"], top["score_type"]) == (1, 0.8, "public_score")
