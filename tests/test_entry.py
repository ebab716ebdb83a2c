import os
import re

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(re.fullmatch(r"[a-z]+\d*_\w+", n) for n in queries)
    assert {"p1_found", "p4_found"} <= set(queries)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_flagship_and_general_problems(spark):
    assert entry.entry(spark).count() > 0
    for name in ("p1_values", "p4_found", "r17_rule_counts", "k13_report"):
        assert entry.queries()[name](spark, DATA).count() > 0


def test_nothing_else_imports_the_text_package():
    for folder, _, files in os.walk(os.path.join(os.path.dirname(entry.__file__), "kvarto")):
        for file in files:
            if file.endswith(".py") and os.sep + "llm" not in folder:
                with open(os.path.join(folder, file), encoding="utf-8") as f:
                    assert not re.search(r"kvarto\.llm|from\s+\.+\s*(kvarto\.)?llm|import\s+llm|from\s+\.+\s+import\s+.*\bllm\b", f.read()), file
