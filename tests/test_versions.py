"""Replacing a table without a gap: readers, writers and failures in between."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tallyframe.sinks.fs import children
from tallyframe.sinks.versions import VersionConflict, current_version, read_current, replace_version
from tests.conftest import rows


def _rows(spark, value, n=40):
    return spark.range(n).select("id", F.lit(value).alias("v")).repartition(3)


def test_a_reader_never_fails_nor_mixes_versions(spark, scratch):
    path, stop, seen, errors = scratch("versions"), threading.Event(), [], []
    replace_version(_rows(spark, -1), path)

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(read_current(spark, path).agg(F.count("id"), F.min("v"), F.max("v")).first()))
            except Exception as error:  # any failure is a gap
                errors.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for value in range(10):
        replace_version(_rows(spark, value), path)
    stop.set()
    reader.join()
    assert errors == []
    assert seen and all(n == 40 and low == high for n, low, high in seen)
    assert [v for _, v, _ in seen] == sorted(v for _, v, _ in seen)
    assert rows(read_current(spark, path).select("v").distinct()) == [(9,)]
    assert len(children(spark, f"{path}/current")) == 3


def test_a_frame_read_before_a_replacement_keeps_its_rows(spark, scratch):
    path = scratch("versions")
    replace_version(_rows(spark, 1), path)
    before = read_current(spark, path)
    replace_version(_rows(spark, 2), path)
    assert before.agg(F.max("v")).first()[0] == 1 and read_current(spark, path).agg(F.min("v")).first()[0] == 2


def test_only_the_given_partitions_are_replaced(spark, scratch):
    path = scratch("versions")
    table = lambda *data: spark.createDataFrame(list(data), "id bigint, v string, day string, hour int")
    by = ["day", "hour"]
    replace_version(table((1, "a", "mo", 1), (2, "a", "mo", 2), (3, "a", "tu", 1)), path, by)
    replace_version(table((4, "b", "mo", 2), (5, "b", "we", 1)), path, by, partitions_only=True)
    got = rows(read_current(spark, path).select("id", "v", "day", "hour"))
    assert got == [(1, "a", "mo", 1), (3, "a", "tu", 1), (4, "b", "mo", 2), (5, "b", "we", 1)]
    for i in range(5):  # folders whose rows still count stay, however old
        replace_version(table((10 + i, "c", "th", 1)), path, by, partitions_only=True)
    assert rows(read_current(spark, path).select("id")) == [(1,), (3,), (4,), (5,), (14,)]
    replace_version(table((9, "d", "mo", 1)), path, by)
    assert rows(read_current(spark, path).select("id")) == [(9,)]


def test_a_failed_job_and_a_lost_race_change_nothing(spark, scratch):
    path = scratch("versions")
    first = replace_version(_rows(spark, 1), path)
    with pytest.raises(Exception):
        replace_version(_rows(spark, 2).select("id", F.raise_error(F.lit("boom")).alias("v")), path)
    assert current_version(spark, path) == first and read_current(spark, path).count() == 40
    second = replace_version(_rows(spark, 3), path, expected=first)
    with pytest.raises(VersionConflict):
        replace_version(_rows(spark, 4), path, expected=first)
    assert current_version(spark, path) == second
    assert sorted(children(spark, f"{path}/versions")) == sorted(
        [x for v in (first, second) for x in (v.folder, f"{v.folder}.parts")])


def test_writers_at_once_all_get_numbers_of_their_own(spark, scratch):
    path, made = scratch("versions"), []
    threads = [threading.Thread(target=lambda i=i: made.append(replace_version(_rows(spark, i), path, keep=10))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v.number for v in made) == [0, 1, 2, 3]
    last = max(made, key=lambda v: v.number)
    assert current_version(spark, path) == last


def test_a_table_that_was_never_written(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_current(spark, scratch("versions"))
    with pytest.raises(ValueError):
        replace_version(_rows(spark, 1), scratch("versions"), partitions_only=True)
