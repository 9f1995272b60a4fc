import json

from conftest import SF_SMALL
from tidemark.__main__ import main
from tidemark.session import new_work_dir


def test_cli_runs_pipeline_and_skips_when_nothing_new(spark, capsys):
    root = new_work_dir(spark, "cli")
    main(["load-landing", "--root", root, "--sf-dir", SF_SMALL])
    main(["run", "--root", root, "--as-of", "2001-12-31", "--fixture-tiers", "--bronze-by-month"])
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r["status"] for r in first] == ["ok"] * 5
    main(["run", "--root", root, "--as-of", "2001-12-31", "--fixture-tiers", "--bronze-by-month"])
    again = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    by = {r["stage"]: r["status"] for r in again}
    assert by["bronze"] == by["silver"] == by["gold"] == by["history"] == "skipped"
