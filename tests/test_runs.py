"""The data source of staged runs: splits, choice of files, streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plotwise.sources import runs
from plotwise.sources.staged import CORRUPT


def staged(base, run, portal, kind, lines):
    path = f"{base}/run_{run}/staged/{portal}_{kind}.jsonl"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write("\n".join(lines).encode() if isinstance(lines, list) else lines)
    return path


def urls(*names):
    return [json.dumps({"url": n}) for n in names]


@pytest.fixture
def base(tmp_path):
    staged(tmp_path, "20240101_000000", "a", "urls", urls("a1", "a2", "a1"))
    staged(tmp_path, "20240102_000000", "a", "urls", urls("a3") + ["[1]", "no json", '{"url":""}', "  "])
    staged(tmp_path, "20240101_000000", "b", "urls", urls("b1"))
    staged(tmp_path, "20240101_000000", "b", "listings", urls("not a staged url"))
    staged(tmp_path, "20240103_000000", "c", "urls", [])
    staged(tmp_path, "notes", "d", "urls", urls("d1"))
    os.makedirs(tmp_path / "other" / "staged")
    return str(tmp_path)


def test_files_by_run_and_portal(base):
    assert [(f.run, f.portal) for f in runs.listed(base, "urls")] == [
        ("20240101_000000", "a"), ("20240101_000000", "b"), ("20240102_000000", "a"), ("20240103_000000", "c"), ("notes", "d"),
    ]
    assert [f.portal for f in runs.listed(base, "urls", {"20240101_000000"}, {"b"})] == ["b"]
    assert runs.listed(base + "/nowhere", "urls") == []


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"\n\na\n\n", b"ab\ncd\r\nef", b"x" * 50 + b"\n" + b"y" * 3, "é\nü\n".encode()])
def test_every_line_is_one_splits(tmp_path, monkeypatch, text):
    path = staged(tmp_path, "r", "p", "urls", text)
    whole = list(runs.lines_of(str(tmp_path), runs.Split("r", "p", path, 0, len(text)))) if text else []
    want, at = [], 0
    for line in text.split(b"\n"):
        want.append((at, line))
        at += len(line) + 1
    assert whole == [w for w in want if w[0] < len(text)]
    for most in (1, 2, 3, 7, 60):
        for held in (1, 3, 4 << 20):
            monkeypatch.setattr(runs, "READ_BYTES", held)
            parts = runs.splits(runs.listed(str(tmp_path), "urls"), most)
            assert [line for p in parts for line in runs.lines_of(str(tmp_path), p)] == whole


def test_own_run_else_all(spark, base):
    got = sorted((r.portal, r.run[:8], r.url) for r in runs.run_urls(spark, base, "20240102_000000").collect())
    assert got == [("a", "20240102", "a3"), ("b", "20240101", "b1"), ("d", "notes", "d1")]
    got = sorted(r.url for r in runs.run_urls(spark, base, "20240109_000000", ["a"]).collect())
    assert got == ["a1", "a1", "a2", "a3"]
    # a filter on the run afterwards does not change what the choice sees
    chosen = runs.run_urls(spark, base, "20240102_000000").where("run = '20240101_000000'")
    assert [r.url for r in chosen.collect()] == ["b1"]


def test_lines_that_are_no_objects_are_kept(spark, base):
    rows = runs.records(runs.read_lines(spark, base, "urls"), "urls").where("portal = 'a' AND run LIKE '20240102%'")
    assert {(r.url, r[CORRUPT]) for r in rows.collect()} == {("a3", None), (None, "[1]"), (None, "no json"), ("", None)}


def test_filters_choose_files(spark, base):
    """A pushed filter leaves the files of other runs and portals unplanned."""
    lines = runs.read_lines(spark, base, "urls")
    assert lines.rdd.getNumPartitions() == 4  # one file is empty
    assert lines.where("run = '20240101_000000'").rdd.getNumPartitions() == 2
    assert lines.where(F.col("portal").isin("a", "b") & (F.col("run") == "20240102_000000")).rdd.getNumPartitions() == 1
    assert lines.where("portal = 'nobody'").collect() == []
    assert runs.read_lines(spark, base, "urls", split_bytes="10").where("portal = 'b'").rdd.getNumPartitions() == 2


def test_stream_takes_each_file_once(spark, base, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = runs.stream_lines(spark, base, "urls").select("run", "portal", "at", "value")
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted((r.portal, r.value) for r in spark.read.parquet(out).collect())

    first = run()
    assert len(first) == 9 and run() == first
    staged(base, "20240104_000000", "e", "urls", urls("e1"))
    assert run() == [*first, ("e", '{"url": "e1"}')]
