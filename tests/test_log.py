"""Scans, batches and fetches on literal logs."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ferrylog.operators import batching, log as log_ops

OFFSETS = [off for off in range(400) if off % 7]


@pytest.fixture
def log(make_log):
    return make_log([("t", 0, off) for off in OFFSETS] + [("t", 1, 0), ("u", 0, 9)])


def test_drop_old_reads_unnamed_partitions_whole(make, log):
    positions = make([("t", 0, 395)], "topic STRING, part INT, committed BIGINT")
    kept = rows_of(log_ops.drop_old(log, positions).select("topic", "part", "off"))
    assert kept == [("t", 0, 395), ("t", 0, 396), ("t", 0, 397), ("t", 0, 398), ("t", 1, 0), ("u", 0, 9)]


@pytest.mark.parametrize("span", [4, 64, 1 << 14])
@pytest.mark.parametrize("limit", [1, 5, 20])
def test_bounded_read_is_exact(log, span, limit):
    got = {}
    for row in log_ops.bounded_read(log, limit, span=span).collect():
        got.setdefault((row.topic, row.part), []).append(row.off)
    assert {key: sorted(offs) for key, offs in got.items()} == {
        ("t", 0): OFFSETS[:limit],
        ("t", 1): [0],
        ("u", 0): [9],
    }


def test_sequence_key_starts_over_after_a_full_batch(log):
    got = log_ops.rekey_sequence(log, cycle=100, span=16).where("topic = 't' AND part = 0").orderBy("off")
    assert [row.new_key for row in got.collect()] == [str(n % 100 + 1) for n in range(len(OFFSETS))]


def test_retopic_by_name_expression_and_table(make, log):
    assert {row.topic for row in log_ops.retopic(log, "copy").collect()} == {"copy"}
    named = log_ops.retopic(log, F.concat(F.lit("x_"), F.col("topic")), source_name="src")
    assert {(row.src, row.topic) for row in named.collect()} == {("t", "x_t"), ("u", "x_u")}
    mapped = log_ops.retopic(log, make([("t", "tt")], "topic STRING, target STRING"))
    assert {row.topic for row in mapped.collect()} == {"tt", "u"}
    assert mapped.count() == log.count()


def test_partitioner_can_be_replaced(make):
    rows = make([("a",), ("bb",)], "key STRING")
    got = log_ops.with_target_partition(rows, 4, partition_by=lambda key: F.length(key))
    assert {(row.key, row.target_part) for row in got.collect()} == {("a", 1), ("bb", 2)}


def test_decode_adds_text(log):
    assert log_ops.decode(log).where("topic = 'u'").first().text == "v9"


@pytest.mark.parametrize("span", [4, 64, 1 << 14])
def test_batches_rebuild_the_log_in_order(log, span):
    batches = [row for row in batching.summarize_batches(log, 100, span=span).collect() if (row.topic, row.part) == ("t", 0)]
    batches.sort(key=lambda row: row.batch_id)
    cut = [OFFSETS[at : at + 100] for at in range(0, len(OFFSETS), 100)]
    assert [(b.n, b.first_off, b.last_off) for b in batches] == [(len(c), c[0], c[-1]) for c in cut]
    assert [b.bytes for b in batches] == [sum(len(f"v{off}") for off in c) for c in cut]


def test_send_progress_counts_rows_from_the_start(make, log):
    starts = make([("t", 0, 50), ("t", 1, 0), ("u", 0, 9)], "topic STRING, part INT, start_off BIGINT")
    got = batching.send_progress(log_ops.scan_from(log, starts), starts, 100, span=32)
    sent = len([off for off in OFFSETS if off >= 50])
    assert sorted(row.sent_to for row in got.collect() if (row.topic, row.part) == ("t", 0)) == [150, 250, 50 + sent]


@pytest.mark.parametrize("span", [2, 1 << 14])
def test_fetches(make_log, span):
    sizes = [10, 30, 70, 5, 200, 1]
    log = make_log([("t", 0, off, b"x" * size) for off, size in enumerate(sizes)])
    rows = batching.fetch_budget(log, 100, span=span).orderBy("off").collect()
    assert [row.cum_bytes for row in rows] == [10, 40, 110, 115, 315, 316]
    assert [row.fetch_id for row in rows] == [0, 0, 0, 1, 1, 3]
    assert [row.off for row in batching.first_fetch(log, 100, span=span).orderBy("off").collect()] == [0, 1]


def test_first_fetch_takes_one_oversized_row(make_log):
    log = make_log([("t", 0, 5, b"x" * 500), ("t", 0, 6, b"y")])
    assert [row.off for row in batching.first_fetch(log, 100, span=2).collect()] == [5]
