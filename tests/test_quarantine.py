"""Malformed CSV lines: each kind, none lost, the job's own path, and what a side without lines reads as."""

from __future__ import annotations

import random

import pytest

from tallyframe.jobs.sales_report import run_sales_report
from tallyframe.sources.quarantine import checked_lines, kept_rows, load_with_quarantine, rejected_lines

LINES = [
    ("id,note,amount", None),
    ("1,plain,2.5", None),
    ('2,"a, quoted",3', None),
    ('3,"say \\"hi\\", please",4', None),
    ('4,"",5', None),
    ("5,,", None),
    ('6,5" disk,7', None),            # a quote inside a bare cell is a character
    ('7,"two","8"', None),
    ('8,"tail \\\\",9', None),         # an escaped backslash, then the closing quote
    ("9,short", "short"),
    ("10", "short"),
    ("11,long,1,2", "long"),
    ("12,,,", "long"),
    ('13,"open,14', "open_quote"),
    ('14,"closed" not,1', "open_quote"),
    ('15,x,"open', "open_quote"),
    ("16,text,n/a", "type"),
    ("x17,text,1", "type"),
    ("   ", None),
    ("", None),
    ("id,note,amount", None),          # files put together
]
SCHEMA = "amount DOUBLE, id INT, note STRING"


@pytest.fixture()
def folder(tmp_path):
    half = len(LINES) // 2
    for name, part in (("a.csv", LINES[:half]), ("b.csv", [LINES[0], *LINES[half:]])):
        (tmp_path / name).write_text("\n".join(line for line, _ in part) + "\n")
    return f"file://{tmp_path}"


def test_every_kind_and_nothing_lost(spark, folder, scratch):
    done = load_with_quarantine(spark, folder, scratch(), SCHEMA, reject_types=True)
    want = {(reason, line) for line, reason in LINES if reason}
    rejected = done.rejected.collect()
    assert {(r["reason"], r["line"]) for r in rejected} == want and len(rejected) == len(want)
    assert {r["file"].rsplit("/", 1)[1] for r in rejected} == {"a.csv", "b.csv"}
    assert sorted(map(tuple, done.rows.collect()), key=lambda r: r[1]) == [
        (2.5, 1, "plain"), (3.0, 2, "a, quoted"), (4.0, 3, 'say "hi", please'), (5.0, 4, None), (None, 5, None),
        (7.0, 6, '5" disk'), (8.0, 7, "two"), (9.0, 8, "tail \\")]
    assert {(r["reason"], r["n_files"], r["n_lines"]) for r in done.counts().collect()} == {
        ("open_quote", 1, 3), ("short", 2, 2), ("long", 1, 2), ("type", 1, 2)}


def test_cells_that_do_not_parse_are_null_unless_asked(spark, folder):
    lines = checked_lines(spark, folder, SCHEMA)
    assert rejected_lines(lines).where("reason = 'type'").count() == 0
    assert {(r["id"], r["amount"]) for r in kept_rows(lines).where("note = 'text'").collect()} == {(16, None), (None, 1.0)}


def test_kept_rows_equal_the_plain_reader_on_clean_files(spark, scratch):
    """Random texts with commas, quotes, backslashes and blanks, as Spark writes them."""
    rng = random.Random(7)
    text = lambda: "".join(rng.choice('ab ,"\\;x') for _ in range(rng.randrange(1, 9)))
    rows = [(i, "t" + text() + "t", rng.choice([None, "z" + text() + "z"]), i / 4) for i in range(400)]
    path = scratch()
    spark.createDataFrame(rows, "id int, a string, b string, v double").repartition(3).write.option("header", True).csv(path)
    plain = spark.read.option("header", True).csv(path)
    lines = checked_lines(spark, path)
    assert rejected_lines(lines).count() == 0
    assert sorted(map(str, kept_rows(lines).collect())) == sorted(map(str, plain.collect()))


def test_clean_and_empty_inputs_have_both_sides(spark, tmp_path, scratch):
    (tmp_path / "a.csv").write_text("id,corrupt\n1,x\n")
    done = load_with_quarantine(spark, f"file://{tmp_path}", scratch())
    assert [tuple(r) for r in done.rows.collect()] == [("1", "x")] and done.rows.columns == ["id", "corrupt"]
    assert done.rejected.count() == 0 and done.rejected.columns == ["reason", "file", "line"]
    only = tmp_path / "only"
    only.mkdir()
    (only / "a.csv").write_text("id,b\n")
    done = load_with_quarantine(spark, f"file://{only}", scratch(), "b INT")
    assert done.rows.count() == 0 and done.rows.dtypes == [("b", "int")] and done.rejected.count() == 0
    with pytest.raises(ValueError, match="no column c"):
        checked_lines(spark, f"file://{only}", "c INT")


def test_a_very_long_cell(spark, tmp_path):
    long = "word, " * 200_000
    (tmp_path / "a.csv").write_text(f'id,t\n1,"{long}"\n2,"{long}\n3,{"q" * 500_000}\n')
    lines = checked_lines(spark, f"file://{tmp_path}", "id INT, t STRING")
    assert [(r["id"], len(r["t"])) for r in kept_rows(lines).orderBy("id").collect()] == [(1, len(long)), (3, 500_000)]
    assert [r["reason"] for r in rejected_lines(lines).collect()] == ["open_quote"]


def test_one_pass_over_the_input(spark, folder):
    plan = checked_lines(spark, folder, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_sales_report_puts_lines_aside(spark, tmp_path, scratch):
    (tmp_path / "in.csv").write_text("ProductID,Amount,Quantity\n1,2.50,1\n1,1.50,2\n2,9,1,9\n2,4,1\n2,x,1\n")
    aside = scratch()
    got = run_sales_report(
        spark, f"file://{tmp_path}/in.csv", fmt="csv", product="ProductID", amount="Amount", quantity="Quantity",
        schema="ProductID INT, Amount DOUBLE, Quantity DOUBLE", quarantine_path=aside,
    )
    assert [(r["ProductID"], r["total_sales_amount"]) for r in got.orderBy("ProductID").collect()] == [(1, 4.0), (2, 4.0)]
    put = spark.read.parquet(aside).where("kept = 'no'")
    assert {(r["reason"], r["line"]) for r in put.collect()} == {("long", "2,9,1,9"), ("type", "2,x,1")}
