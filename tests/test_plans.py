"""The annual plan, and independence of everything from the llm subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from datetime import date
from pathlib import Path

from ledgerspark.plans import annual


def test_annual_plan(spark):
    d = date
    rows = [
        ("t", "IS", "Sales", 2020, d(2020, 1, 1), d(2020, 12, 31), 100.0, d(2021, 2, 1)),
        ("t", "IS", "Revenue", 2020, d(2020, 1, 1), d(2020, 12, 31), 110.0, d(2021, 2, 1)),
        ("t", "IS", "Revenue", 2021, d(2020, 1, 1), d(2020, 12, 31), 111.0, d(2022, 2, 1)),
        ("t", "IS", "Revenue", 2020, d(2020, 10, 1), d(2020, 12, 31), 30.0, d(2021, 2, 1)),
        ("t", "IS", "net_income", 2020, d(2020, 1, 1), d(2020, 12, 31), 11.0, d(2021, 2, 1)),
    ]
    facts = spark.createDataFrame(rows, "ticker string, stmt string, concept string, fiscal_year int, period_start date, period_end date, value double, filed date")
    clean = annual.clean_annual(facts, {"Sales": "revenue", "Revenue": "revenue"}, {"Revenue": 1, "Sales": 2})
    items = ["revenue", "net_income", "market_cap", "equity"]
    got = sorted(map(tuple, annual.annual_metrics(clean, items, ["net_margin", "pb"]).collect()))
    assert got == [("t", 2020, "net_margin", 10.0)]


def test_rest_works_without_llm(tmp_path):
    """The library, its entry file and tests still work where both llm folders and the pipeline are gone."""
    root = Path(__file__).resolve().parent.parent
    for part in ("ledgerspark", "tests"):
        shutil.copytree(root / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) > 90"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
    few = "test_query_equals_oracle and (latest_growth or asof_price or upsert_state) or test_every_query"
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", "tests/test_oracles.py", "-k", few], cwd=tmp_path, env=env, check=True, timeout=300)
