"""Leaders, assignments, checkpoints and endpoints on literal rows."""

import pytest
from conftest import rows_of

from ferrylog.operators import metadata


@pytest.fixture
def states(make):
    rows = [
        (0, "t", 0, [0, 1], 0), (0, "t", 1, [1, 2], 1), (0, "t", 2, [2], 2),
        (1, "t", 0, [1], None), (1, "t", 1, [1, 2], 1), (1, "t", 2, [1], 1),
        (2, "t", 0, [1, 0], 0), (2, "t", 1, [1, 2], 1), (2, "t", 2, [1], 1),
    ]
    return make([(snap, topic, part, leader, isr) for snap, topic, part, isr, leader in rows],
                "snap INT, topic STRING, part INT, leader INT, isr ARRAY<INT>")


@pytest.fixture
def brokers(make):
    rows = [(0, "n0.example", 9092), (1, "n1.example", 9093), (10, "n1.example", 9092)]
    return make(rows, "broker_id INT, host STRING, port INT")


def test_leaders_without_a_broker_node_are_left_out(states, brokers):
    got = metadata.partition_leaders(states.where("snap = 0"), brokers)
    assert rows_of(got) == [("t", 0, 0, "n0.example", 9092), ("t", 1, 1, "n1.example", 9093)]


def test_order_of_brokers_is_host_then_port(make):
    leaders = make([("t", 1, "b", 1), ("t", 0, "b", 2), ("t", 2, "a", 9)], "topic STRING, part INT, host STRING, port INT")
    assert [tuple(row) for row in metadata.ordered_partitions(leaders).collect()] == [
        ("t", 0, "b", 2, 3), ("t", 1, "b", 1, 2), ("t", 2, "a", 9, 1)
    ]


def test_replica_hosts_keep_replica_order(states, brokers):
    got = metadata.replica_hosts(states.where("snap = 2"), brokers)
    assert rows_of(got) == [("t", 0, "n1.example,n0.example"), ("t", 1, "n1.example"), ("t", 2, "n1.example")]


def test_leader_changes(states):
    assert rows_of(metadata.leader_changes(states)) == [
        ("t", 0, 1, 0, None, "no_leader"), ("t", 0, 2, None, 0, "elected"), ("t", 2, 1, 2, 1, "moved")
    ]


def test_registry_follows_the_changes(states):
    events = metadata.registrations(states)
    assert rows_of(metadata.broker_partitions(events)) == [(0, "t", "0"), (1, "t", "1,2")]


def test_a_broker_that_loses_everything_is_not_listed(make):
    events = make([(7, "t", 0, 1, "register"), (7, "t", 0, 2, "unregister"), (8, "t", 0, 3, "register")],
                  "broker_id INT, topic STRING, part INT, seq INT, action STRING")
    assert rows_of(metadata.broker_partitions(events)) == [(8, "t", "0")]


def test_assignment_changes_between_two_snapshots(states):
    old, new = (metadata.assignments(states.where(f"snap = {n}")) for n in (0, 1))
    diff = metadata.assignment_diff(old, new)
    assert rows_of(diff) == [(0, "t", 0, "removed"), (1, "t", 1, "kept"), (1, "t", 2, "added"), (2, "t", 2, "removed")]
    assert dict(rows_of(metadata.assignment_changed(diff))) == {0: True, 1: True, 2: True}
    assert dict(rows_of(metadata.assignment_changed(metadata.assignment_diff(old, old)))) == {0: False, 1: False, 2: False}


def test_counts_and_led_partitions(states):
    assert rows_of(metadata.partition_count(states)) == [("t", 3)]
    now = states.where("snap = 1")
    assert rows_of(metadata.partitions_led_by(now)) == [(1, "t", 2, "1,2")]
    assert rows_of(metadata.partitions_led_by(now, broker_id=0)) == []


def test_host_prefix_ties_go_to_the_highest_id(brokers):
    assert rows_of(metadata.broker_id_for_host(brokers, "n1")) == [("n1", 10)]
    assert rows_of(metadata.broker_id_for_host(brokers, "zz")) == [("zz", None)]


@pytest.mark.parametrize(
    "tries, accepted",
    [
        ([(0, "OLD"), (1, "old")], "old"),
        ([(0, "new"), (1, "old")], "new"),
        ([(0, None), (1, None), (2, "old")], "old"),
        ([(0, "old"), (1, None), (2, None)], None),
        ([(0, None), (1, None), (2, None), (3, "new")], None),
    ],
)
def test_old_leader_is_taken_only_from_the_second_try(make, tries, accepted):
    rows = make([("t", 0, n, "old", host) for n, host in tries], "topic STRING, part INT, try_no INT, old_host STRING, host STRING")
    assert rows_of(metadata.accept_leader(rows)) == [("t", 0, accepted)]


def test_checkpoint_nodes_round_trip(make):
    saved = make([("t", 0, "j", 12), ("t", 1, "k", 0)], "topic STRING, part INT, job_id STRING, committed BIGINT")
    assert rows_of(metadata.checkpoint_read(metadata.checkpoint_nodes(saved))) == [("t", 0, 12), ("t", 1, 0)]
    nodes = metadata.checkpoint_job_nodes(saved)
    assert rows_of(nodes)[0] == ("/consumers/demo/offsets/t/0", '{"topology":{"id":"j"},"offset":12}')
    assert rows_of(metadata.checkpoint_job_read(nodes)) == [("t", 0, "j", 12), ("t", 1, "k", 0)]


def test_unreadable_nodes_give_null(make):
    nodes = make(
        [("/consumers/demo/offsets/t/0", "twelve"), ("/brokers/ids/3", "not json"),
         ("/brokers/topics/t/partitions/1/state", '{"leader":null,"isr":[]}'), ("/elsewhere", None)],
        "path STRING, data STRING",
    )
    assert rows_of(metadata.checkpoint_read(nodes)) == [("t", 0, None)]
    assert {row[1:] for row in rows_of(metadata.node_json(nodes))} == {(None, None, None)}
    assert rows_of(metadata.checkpoint_job_read(nodes)) == [("t", 0, None, None)]


def test_last_write_wins_even_when_it_goes_back(make):
    commits = make([("t", 0, 1, 50), ("t", 0, 3, 20), ("t", 0, 2, 90)], "topic STRING, part INT, seq BIGINT, off BIGINT")
    assert rows_of(metadata.checkpoint_upsert(commits)) == [("t", 0, 20, 3)]


def test_endpoints(make):
    lists = make([("h,h:,h:1,h:1:2,h:x",), ("h:9092,,",), ("",)], "endpoints STRING")
    assert rows_of(metadata.endpoint_parse(lists)) == sorted(
        [("h", 9092, "h:9092", True), ("h", 1, "h:1", True), (None, None, "h:1:2", False), (None, None, "h:x", False), (None, None, "", False)],
        key=lambda row: tuple(map(str, row)),
    )


def test_node_bodies(make):
    from pyspark.sql import functions as F

    state = make([(None, [1, 2])], "leader INT, isr ARRAY<INT>").select(metadata.state_json(F.col("leader"), F.col("isr")).alias("j"))
    assert state.first().j == '{"controller_epoch":1,"isr":[1,2],"leader":null,"leader_epoch":0,"version":1}'
    row = make([("h", 1)], "host STRING, port INT").select(metadata.broker_json(F.col("host"), F.col("port")).alias("j"))
    assert row.first().j == '{"host":"h","jmx_port":9999,"port":1,"version":1}'
