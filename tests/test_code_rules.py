"""Static checks that keep the library on Spark's distributed, built-in path.

* no Python UDFs, RDD code, cross joins or local checkpoints;
* results reach the driver only as single rows of global aggregates (the
  places are listed here, so a new one has to be looked at).
"""

from __future__ import annotations

import ast
import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parent.parent / "tallyframe"
# The optional subpackage has rules of its own.
OPTIONAL = "llm"
SOURCES = {
    p.relative_to(ROOT).as_posix(): p.read_text()
    for p in ROOT.rglob("*.py") if p.relative_to(ROOT).parts[0] != OPTIONAL
}

FORBIDDEN = [r"\budf\(", r"pandas_udf", r"\.rdd\b", r"crossJoin", r"localCheckpoint", r"toPandas", r"\.collect\(", r"\.take\("]

# Each returns exactly one row: a global aggregate or a one-row SQL query.
ONE_ROW_FIRST = {
    "plans/streams.py": 1,      # min/max of the event time
    "sources/inference.py": 1,  # counts of all cells by type
    "operators/joins.py": 1,    # rows and bytes of a dimension
    "sources/jdbc.py": 1,       # MIN/MAX bounds query
    "sinks/jdbc.py": 1,         # COUNT(*) of the staging table
}


def test_no_forbidden_calls():
    hits = [(name, pat) for name, src in SOURCES.items() for pat in FORBIDDEN if re.search(pat, src)]
    assert hits == []


def test_driver_side_rows_are_single_aggregate_rows():
    found = {name: len(re.findall(r"\.first\(\)", src)) for name, src in SOURCES.items()}
    assert {k: v for k, v in found.items() if v} == ONE_ROW_FIRST


def test_no_row_loops_over_results():
    for name, src in SOURCES.items():
        for node in ast.walk(ast.parse(src)):
            if isinstance(node, ast.For) and isinstance(node.iter, ast.Call):
                func = node.iter.func
                assert not (isinstance(func, ast.Attribute) and func.attr in {"collect", "toLocalIterator"}), name


def test_the_library_does_not_import_the_optional_subpackage():
    assert [name for name, src in SOURCES.items() if re.search(rf"tallyframe\.{OPTIONAL}|from tallyframe import.*{OPTIONAL}", src)] == []
