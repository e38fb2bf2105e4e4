"""Registered queries over whole tables, against what their operators mean, row by row in Python."""

import datetime
import hashlib
import random
from collections import defaultdict

import pytest

from chronogrid.plans import registry

EPOCH = datetime.datetime(2024, 1, 1)
KINDS = ["click", "error", "purchase", "signup", "view"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Few users with tracks of unlike length, values on both sides of every threshold, keys of every remainder."""
    rng = random.Random(3)
    d = str(tmp_path_factory.mktemp("tables"))
    users = [1] * 90 + [2] * 44 + [3] * 2 + [4] * 64
    rng.shuffle(users)
    events = [(k, u, rng.choice(KINDS), rng.uniform(1, 500), EPOCH + datetime.timedelta(minutes=rng.randrange(9000))) for k, u in enumerate(users)]
    orders = [(k, rng.randrange(1, 13)) for k in [*range(1, 121), *range(4990, 5410)]]
    customers = [(k,) for k in range(1, 16)]
    for name, rows, schema in (
        ("events", events, "event_id long, user_id long, event_type string, value double, ts timestamp_ntz"),
        ("orders", orders, "o_orderkey long, o_custkey long"),
        ("customer", customers, "c_custkey long"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d, events, orders, customers


def rows_of(spark, d, name, *columns):
    return sorted(tuple(r) for r in registry.queries()[name](spark, d).select(*columns).collect())


def tracks_of(events):
    tracks = defaultdict(list)
    for e in sorted(events, key=lambda e: (e[4], e[0])):
        tracks[e[1]].append(e)
    return tracks


def test_translate_labels_keeps_every_frame_of_long_tracks(spark, tables):
    d, events, *_ = tables
    want = []
    for user, track in tracks_of(events).items():
        for k, (i, _, _, value, _) in enumerate(track):
            voiced = value > 150
            if k >= 3:
                want.append((user, k - 3, voiced, voiced and (i % 3 == 0 or k == 3)))
    assert rows_of(spark, d, "translate_labels", "user_id", "frame", "voiced", "onset") == sorted(want)


def test_loader_batches_place_every_event(spark, tables):
    d, events, *_ = tables
    groups = defaultdict(list)
    for e in events:
        groups[e[2]].append(e[0])
    want = []
    for kind, ids in groups.items():
        ids.sort(key=lambda i: (hashlib.md5(f"2:{i}".encode()).hexdigest(), i))
        want += [(kind, a // 32, len(ids[a : a + 32]), min(ids[a : a + 32])) for a in range(0, len(ids), 32)]
    got = rows_of(spark, d, "loader_batches", "event_type", "batch", "n", "least")
    assert got == sorted(want) and sum(r[2] for r in got) == len(events)


def test_mirror_check_holds_every_customer_against_every_order(spark, tables):
    d, _, orders, customers = tables
    cached = {c for _, c in orders}
    assert rows_of(spark, d, "mirror_check", "o_custkey") == [c for c in customers if c[0] not in cached]


def test_every_order_is_a_tempo_change(spark, tables):
    d, _, orders, _ = tables
    want = []
    for customer in {c for _, c in orders}:
        tick = second = 0
        bpm = 120
        for key in sorted(k for k, c in orders if c == customer):
            second += (key * 10 - tick) * 60 / (bpm * 960)
            tick, bpm = key * 10, key % 180 + 40
            want.append((customer, tick, second))
    got = rows_of(spark, d, "tempo_sections", "o_custkey", "tick", "seconds")
    assert [r[:2] for r in got] == [r[:2] for r in sorted(want)]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in sorted(want)], abs=1e-6)


def test_index_to_item_reaches_every_track(spark, tables):
    d, events, orders, _ = tables
    frames = [(user, k) for user, track in sorted(tracks_of(events).items()) for k in range(len(track))]
    got = rows_of(spark, d, "index_to_item", "o_orderkey", "user_id", "frame")
    assert got == sorted((k, *frames[k % len(frames)]) for k, _ in orders)
    assert {r[1:] for r in got} == set(frames)
