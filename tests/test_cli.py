"""Command line: list / build (DQ gate exit code) / query."""

from __future__ import annotations

import os
import subprocess
import sys

from trolley.__main__ import main

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_list_prints_every_key():
    out = subprocess.run([sys.executable, "-m", "trolley", "list"], cwd=ROOT, capture_output=True, text=True,
                         timeout=300)
    keys = set(out.stdout.split())
    assert out.returncode == 0 and {"department_counts", "product_pairs", "dq_gate"} <= keys


def test_build_reports_gate(spark, capsys):
    # the driver data has ids equal to 0, which the positive-id rule flags: the gate must fail (exit 1)
    code = main(["build", "--driver", "/root/testdata/sf0.001", "--threads", "4"])
    out = capsys.readouterr().out
    assert code == 1 and "failed checks: 2" in out and "positive_ids_orders" in out


def test_query_to_parquet(spark, tmp_path):
    target = str(tmp_path / "dept")
    assert main(["query", "department_counts", "--driver", "/root/testdata/sf0.001", "--out", target]) == 0
    assert spark.read.parquet(target).count() == 6
    assert main(["query", "no_such_query", "--driver", "/root/testdata/sf0.001"]) == 2
