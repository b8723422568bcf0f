import datetime as dt

import pytest
from conftest import DATA, plan_of, rows_of
from pyspark.sql import functions as F

from ferrylog.operators import log as log_ops, replay, segments
from ferrylog.plans import mirror
from ferrylog.plans.inputs import Inputs
from ferrylog.settings import MirrorSettings
from ferrylog.sources import generate, kafka, table
from ferrylog.sources.checkpoints import CheckpointStore
from ferrylog.staging import drop_staged, new_folder, shared_root, stage

LOG_SCHEMA = "off BIGINT, value BINARY, topic STRING, part INT"


@pytest.fixture
def log(make_log):
    rows = [("t", 0, off) for off in range(3, 300) if off % 5] + [("t", 1, 7)]
    return make_log(rows + [("t", 1, 8, None), ("t", 1, 9, b"a\xffb")])


@pytest.fixture
def saved(make):
    return make([("t", 0, 50)], "topic STRING, part INT, committed BIGINT")


@pytest.fixture
def nothing_saved(make):
    return make([], "topic STRING, part INT, committed BIGINT")


def test_mirror_copies_bytes_and_null_payloads_unchanged(log, nothing_saved):
    copied = mirror.mirror_batch(log, nothing_saved, target="copy")
    assert rows_of(copied.select("part", "off", "value")) == rows_of(log.select("part", "off", "value"))
    assert {row.topic for row in copied.select("topic").distinct().collect()} == {"copy"}


def test_mirror_as_text_replaces_malformed_bytes(log, nothing_saved):
    texts = mirror.mirror_batch(log, nothing_saved, target="copy", as_text=True).where("part = 1")
    assert [row.value for row in texts.orderBy("off").collect()] == ["v7", None, "a�b"]


def test_mirror_resumes_and_batches(log, saved):
    rows = mirror.mirror_batch(log, saved, target="sync_", key="sequence", span=16).where("part = 0").orderBy("off").collect()
    expected = [off for off in range(50, 300) if off % 5]
    assert [row.off for row in rows] == expected
    assert [(row.batch_id, row.key) for row in rows] == [(n // 100, str(n % 100 + 1)) for n in range(len(expected))]
    assert {row.topic for row in rows} == {"sync_t"}


def test_mirror_of_a_mirror_is_the_mirror(log, nothing_saved, folder):
    once = mirror.mirror_batch(log, nothing_saved, target="t").select("topic", "part", "off", "value")
    stored = mirror.write_and_read_back(once, folder)
    twice = mirror.mirror_batch(stored, nothing_saved, target="t").select("topic", "part", "off", "value")
    assert rows_of(once) == rows_of(twice)
    assert mirror.audit(log, stored).isEmpty()


@pytest.mark.parametrize("policy, rows", [("keep", 0), ("latest", 0), ("earliest", 3)])
def test_a_position_past_the_end_is_repaired_on_request(make, log, policy, rows):
    saved = make([("t", 1, 99)], "topic STRING, part INT, committed BIGINT")
    copied = mirror.mirror_batch(log.where("part = 1"), saved, target="t", out_of_range=policy)
    assert copied.count() == rows


def test_a_position_past_the_end_can_fail_the_mirror(make, log):
    saved = make([("t", 1, 99)], "topic STRING, part INT, committed BIGINT")
    with pytest.raises(Exception, match="out of range"):
        mirror.mirror_batch(log, saved, target="t", out_of_range="fail")


def test_mirror_by_settings(make, make_log):
    log = make_log([("a", 0, 1), ("a", 0, 2), ("b", 0, 1)])
    saved = make([("a", 0, 99)], "topic STRING, part INT, committed BIGINT")
    copied = mirror.mirror_job(log, saved, MirrorSettings(source="a", target="copy", batch_rows=1))
    assert rows_of(copied.select("topic", "off", "batch_id")) == [("copy", 1, 0), ("copy", 2, 1)]
    with pytest.raises(Exception, match="out of range"):
        mirror.mirror_job(log, saved, MirrorSettings(source="a", target="copy", on_out_of_range="fail"))
    with pytest.raises(ValueError):
        mirror.mirror_job(log, saved, MirrorSettings(source="a"))


@pytest.mark.parametrize(
    "starting, force, offs",
    [
        ("earliest", False, [12, 13]),
        ("earliest", True, [10, 11, 12, 13]),
        ("latest", True, []),
        ("2024-01-01 00:03:00", True, [13]),
        ("2024-01-02 00:00:00", True, []),
    ],
)
def test_where_a_mirror_starts(make, starting, force, offs):
    rows = [("t", 0, 10 + n, dt.datetime(2024, 1, 1, 0, n)) for n in range(4)]
    log = make(rows, "topic STRING, part INT, off BIGINT, ts TIMESTAMP_NTZ")
    saved = make([("t", 0, 12)], "topic STRING, part INT, committed BIGINT")
    got = mirror.resume(log, saved, starting=starting, force=force, out_of_range="fail")
    assert sorted(row.off for row in got.collect()) == offs


def test_checkpoint_snapshots(spark, make, folder):
    commits = "topic STRING, part INT, seq BIGINT, off BIGINT"
    store = CheckpointStore(folder)
    assert store.latest(spark) == -1 and rows_of(store.read(spark, -1)) == []
    store.save(make([("t", 0, 1, 50), ("t", 0, 2, 40), ("t", 1, 1, 7)], commits), 0, job_id="a")
    for _ in range(2):
        store.save(make([("t", 0, 1, 10), ("u", 0, 1, 3)], commits), 1, job_id="b")
    assert store.latest(spark) == 1
    assert rows_of(store.read(spark, 0)) == [("t", 0, "a", 40), ("t", 1, "a", 7)]
    assert rows_of(store.read(spark, 1)) == [("t", 0, "b", 10), ("t", 1, "a", 7), ("u", 0, "b", 3)]


def test_audit_sees_both_sides(make_log):
    left, right = make_log([("t", 0, 1), ("t", 0, 2)]), make_log([("t", 0, 2), ("t", 0, 3)])
    assert rows_of(mirror.audit(left, right)) == [("t", 0, 1, "missing"), ("t", 0, 3, "extra")]


def test_key_mode_is_checked(log, nothing_saved):
    with pytest.raises(ValueError):
        mirror.mirror_batch(log, nothing_saved, target="x", key="random")


def test_stored_log_is_pruned_and_filtered_at_the_scan(spark, log, folder):
    table.write_log(log, folder)
    read = table.read_log(spark, folder, LOG_SCHEMA)
    plan = plan_of(read.where("topic = 't' AND part = 1 AND off >= 8").select("off"))
    assert "PushedFilters: [IsNotNull(off), GreaterThanOrEqual(off,8)]" in plan
    assert "ReadSchema: struct<off:bigint>" in plan
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_start_facts_do_not_shuffle_the_log(spark, log, saved, folder):
    table.write_log(log, folder)
    read = table.read_log(spark, folder, LOG_SCHEMA)
    plan = plan_of(mirror.resume(read, saved))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_start_facts_above_the_threshold_are_joined_by_shuffle(spark, log, saved, folder):
    table.write_log(log, folder)
    read = table.read_log(spark, folder, LOG_SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        resumed = mirror.resume(read, saved)
        assert "SortMergeJoin" in plan_of(resumed)
        assert resumed.count() == log.where("part = 1 OR off >= 50").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rewriting_a_batch_replaces_it(spark, make_log, folder):
    table.write_batch(make_log([("t", 0, 1), ("t", 0, 2)]), folder, 0)
    table.write_batch(make_log([("t", 0, 3)]), folder, 1)
    table.write_batch(make_log([("t", 0, 1), ("t", 0, 2)]), folder, 0)
    got = table.read_batches(spark, folder).select("batch_id", "off")
    assert rows_of(got) == [(0, 1), (0, 2), (1, 3)]


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(f"{shared_root(spark)}/ferrylog-{spark.sparkContext.applicationId}/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_staged_rows_read_back(make):
    frame = make([(1, "a"), (2, None)], "n INT, s STRING")
    assert rows_of(stage(frame, "facts")) == rows_of(frame)


def test_generated_messages(spark):
    got = generate.gen_messages(spark).collect()
    assert [row.id for row in got] == list(range(1, 10))
    assert len({row.value for row in got}) == 9 and all(len(row.value) == 36 for row in got)
    seeded = [rows_of(generate.gen_messages(spark, 5, seed="s")) for _ in range(2)]
    assert seeded[0] == seeded[1]
    assert generate.message_stream(spark, seed="s").isStreaming


def test_kafka_options():
    settings = MirrorSettings(source="a", target="b", starting="2024-01-01T00:00:00", on_out_of_range="fail")
    options = kafka.read_options(settings, "h:9092", rows_per_trigger=10, min_partitions=64)
    assert options["subscribe"] == "a"
    assert options["startingTimestamp"] == "1704067200000"
    assert options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "10" and options["minPartitions"] == "64"
    assert options["kafka.client.id"] == "Client_sync"
    assert kafka.write_options(settings, "h:9092") == {"kafka.bootstrap.servers": "h:9092", "kafka.acks": "1", "topic": "b"}

    chosen = kafka.read_options(MirrorSettings(), "h:9092", assign={"t": [0]}, starts=[("t", 0, 5), ("t", 1, kafka.EARLIEST)])
    assert chosen["assign"] == '{"t": [0]}' and "subscribe" not in chosen
    assert chosen["startingOffsets"] == '{"t": {"0": 5, "1": -2}}'
    assert kafka.read_options(MirrorSettings(), "h:9092")["startingOffsets"] == "earliest"
    assert kafka.read_options(MirrorSettings(), "h:9092")["failOnDataLoss"] == "false"


def test_kafka_columns(make):
    source = make([(None, b"v", "t", 3, 9, None, 0)], "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT")
    assert kafka.as_log(source).columns == ["key", "value", "topic", "part", "off", "ts"]
    records = kafka.as_records(kafka.as_log(source), encode=F.base64, partition="part")
    assert [tuple(row) for row in records.collect()] == [("t", None, "dg==", 3)]


def test_settings_are_checked():
    assert MirrorSettings().idle_limit_seconds == 1200
    with pytest.raises(ValueError):
        MirrorSettings(on_out_of_range="guess")
    with pytest.raises(ValueError):
        MirrorSettings(max_bytes=0)


def test_input_log_is_stored_again_after_a_clean_up(spark):
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test data")
    stored = Inputs(spark, str(folder)).log_folder()
    rows = Inputs(spark, str(folder)).log().count()
    assert Inputs(spark, str(folder)).log_folder() == stored
    assert drop_staged(spark)
    again = Inputs(spark, str(folder))
    assert again.log().count() == rows and again.log_folder() != stored


@pytest.mark.parametrize("starting, expected", [("latest", [50, 100]), ("2024-01-01 01:30:00", [50, 90]), ("earliest", [50, 0])])
def test_a_configured_start_leaves_valid_saved_offsets_alone(make, starting, expected):
    """Part 0 has a valid saved offset, part 1 has none."""
    begin = dt.datetime(2024, 1, 1)
    rows = [("t", part, off, begin + dt.timedelta(minutes=off)) for part in (0, 1) for off in range(100)]
    log = make(rows, "topic STRING, part INT, off BIGINT, ts TIMESTAMP_NTZ")
    saved = make([("t", 0, 50)], "topic STRING, part INT, committed BIGINT")
    starts = mirror.start_positions(log, saved, starting=starting)
    assert [row.start_off for row in starts.orderBy("part").collect()] == expected
    assert mirror.resume(log, saved, starting=starting).count() == 200 - sum(expected)


def files_read(frame):
    """Files that the scans of an executed plan opened for rows, by the plan's own counts."""
    frame.collect()
    plan, found, todo = frame._jdf.queryExecution().executedPlan(), [], []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and "payload" in node.schema().simpleString():
            found.append(node.metrics().apply("numFiles").value())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found)


def test_scans_open_only_segments_that_can_matter(spark, make, folder):
    """Forty segments of two partitions; a resume at the end, a head and a replay need a few of them."""
    rows = [("t", part, seg * segments.LAYOUT_SPAN + off, f"p{off}") for part in (0, 1) for seg in range(20) for off in range(3)]
    table.write_log(make(rows, "topic STRING, part INT, off BIGINT, payload STRING"), folder, segments=True)
    log = table.read_log(spark, folder, "off BIGINT, payload STRING, topic STRING, part INT, seg STRING")
    assert files_read(log.select("payload")) == 40
    last = 19 * segments.LAYOUT_SPAN
    starts = stage(make([("t", 0, last + 1), ("t", 1, last - 10)], "topic STRING, part INT, start_off BIGINT"), "starts")
    resumed = log_ops.scan_from(log, starts)
    assert files_read(resumed) == 3 and resumed.count() == 5
    kept = log_ops.drop_old(log, starts.where("part = 0"), position="start_off")
    assert files_read(kept) == 21 and kept.count() == 62
    head = log_ops.bounded_read(log, 3)
    assert files_read(head) == 2 and head.count() == 6
    failed = make([("t", 0, last + 2), ("t", 1, 1)], "topic STRING, part INT, off BIGINT")
    again = replay.rows_at(log, stage(failed, "failed"))
    assert files_read(again) == 2 and again.count() == 2
    # without a broadcast the scan reads all, with the same result
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert log_ops.scan_from(log, starts).count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
