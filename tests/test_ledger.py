"""The table's commit ledger, and the plans of upserts over a bucketed base."""

import os
import re

import pytest
from pyspark.sql import functions as F

from pointferry.operators import sizing, upsert as up
from pointferry.sinks import ledger
from pointferry.sinks.ledger import CommitLedger, LedgerState
from pointferry.sinks.point_table import PointTable
from tests.test_table import content, writes


def _written(path, text="x"):
    os.makedirs(path)
    with open(f"{path}/data", "w") as f:
        f.write(text)


def _commit(book, writer, batch):
    folder = book.new_folder()
    _written(folder)
    return book.claim(folder, writer, batch)


def test_runs_of_batches_stay_one_entry():
    state = LedgerState()
    for n in range(10_000):
        state.note("stream", n, n + 1)
    assert state.seen == {"stream": [[0, 9999, 1]]} and state.find("stream", 77) == 78
    state.note("other", 5, 10_001)
    state.note("stream", 20_000, 10_002)
    state.note("stream", 15_000, 10_003)
    assert [state.find("stream", b) for b in (15_000, 20_000, 10_000, -1)] == [10_003, 10_002, None, None]
    assert state.find("nobody", 0) is None and state.find("other", 5) == 10_001


def test_an_append_reads_no_more_the_longer_the_history(spark, tmp_path, monkeypatch):
    book = CommitLedger(spark, str(tmp_path))
    reads = []
    read = CommitLedger.read_json
    monkeypatch.setattr(CommitLedger, "read_json", lambda self, name: reads.append(name) or read(self, name))
    costs = []
    for n in range(150):
        del reads[:]
        assert _commit(book, "stream", n).endswith(f"/commit-{n + 1}")
        costs.append(len(reads))
    assert max(costs) <= ledger.COMPACT_EVERY + 2 and max(costs[100:]) <= max(costs[:64])
    assert len(os.listdir(tmp_path / "ledger")) <= 2 * ledger.KEPT_LEDGERS  # with checksum files
    fresh = CommitLedger(spark, str(tmp_path)).load()
    assert fresh.last == 150 and fresh.find("stream", 3) == 4


def test_of_two_writers_one_wins_and_the_other_takes_the_next_number(spark, tmp_path, monkeypatch):
    a, b = CommitLedger(spark, str(tmp_path)), CommitLedger(spark, str(tmp_path))
    stale = b.load()
    assert _commit(a, "a", 0).endswith("commit-1")
    load, first = CommitLedger.load, [stale]
    monkeypatch.setattr(b, "load", lambda: first.pop() if first else load(b))
    assert _commit(b, "b", 0).endswith("commit-2")
    # Both with the same batch: the later one's data is dropped.
    stale = b.load()
    assert _commit(a, "c", 7).endswith("commit-3")
    first.append(stale)
    assert _commit(b, "c", 7).endswith("commit-3")
    assert sorted(os.listdir(tmp_path / "commits")) == ["commit-1", "commit-2", "commit-3"]


def test_remains_of_a_broken_rename_are_cleared(spark, tmp_path):
    book = CommitLedger(spark, str(tmp_path))
    _written(str(tmp_path / "commits" / "commit-1"), "half")
    folder = _commit(book, "w", 0)
    assert folder.endswith("commit-1") and open(f"{folder}/data").read() == "x"


def test_a_failing_batch_leaves_nothing_to_see(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(1, "a", 0)]), "w", 0)
    bad = writes(spark, [(2, "b", 0)]).withColumn("id", F.lit(None).cast("struct<num:decimal(20,0),uuid:string>"))
    with pytest.raises(Exception, match="has no id"):
        table.append(bad, "w", 1)
    assert content(table.read()) == {1: "a"} and table.ledger.load().last == 1
    table.compact()
    assert table.vacuum() > 0 and content(table.read()) == {1: "a"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _above_base(plan):
    """The operators between the base's scan and the join over it."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan parquet spark_catalog.default.pointferry_" in line)
    depth = lambda line: len(re.match(r"[\s:|+\-]*", line).group(0))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line.strip(" :+-"))
            level = depth(line)
            if "Join" in line:
                break
    return lines[at], above


def test_a_large_upsert_does_not_shuffle_the_base(spark, tmp_path, monkeypatch):
    table = PointTable(spark, str(tmp_path / "t"), buckets=6)
    table.append(writes(spark, [(n, f"t{n}", 0) for n in range(400)]), "w", 0)
    table.compact()
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.append(writes(spark, [(n, "late", 0) for n in range(0, 600, 2)] + [(n, "later", 1) for n in range(0, 600, 4)]), "w", 1)
        got = table.read()
        scan, above = _above_base(_plan(got))
        assert "Bucketed: true" in scan and above and "SortMergeJoin" in above[-1] and not any("Exchange" in a for a in above)
        want = {**{n: f"t{n}" for n in range(400)}, **{n: "late" for n in range(0, 600, 2)}, **{n: "later" for n in range(0, 600, 4)}}
        assert content(got) == want
        table.compact()
        assert content(table.read()) == want
        files = [f for _, _, names in os.walk(tmp_path / "t" / "base" / "upto=2") for f in names if f.endswith(".parquet")]
        assert len({re.search(r"_(\d{5})\.c000", f).group(1) for f in files}) <= 6 and len(files) <= 2 * 2 * 6
        wider = PointTable(spark, str(tmp_path / "t"), buckets=9)
        wider.append(writes(spark, [(1, "again", 0)]), "w", 2)
        wider.compact()
        assert content(PointTable(spark, str(tmp_path / "t")).read()) == {**want, 1: "again"} and wider._base_buckets(3) == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_writes_move_no_vectors_to_find_winners(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 1)
    monkeypatch.setattr(up, "HOT_IDS", 4)
    table = PointTable(spark, str(tmp_path / "t"))
    rows = [(7, f"h{i}", i) for i in range(500)] + [(n, "a", 0) for n in range(100, 200)] + [(n, "b", 1) for n in range(100, 200)]
    table.append(writes(spark, rows).repartition(5), "w", 0)
    got = table.read()
    assert content(got) == {7: "h499", **{n: "b" for n in range(100, 200)}}
    plan = _plan(got)
    assert "max_by" not in plan and "Aggregate" not in plan


def test_equal_order_numbers_give_one_point(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"))
    table.append(writes(spark, [(1, "a", 5), (1, "b", 5), (1, "c", 5), (2, "d", 0)]).repartition(3), "w")
    first = content(table.read())
    assert first[1] in "abc" and content(table.read()) == first
    table.compact()
    assert content(table.read()) == first
