"""Sliding sums kept by adding and retracting, against a recomputation."""

import datetime as dt
import random

import pytest

from salescompass.streaming import refresh, sliding

SCHEMA = "advisor_id string, event_type string, event_timestamp timestamp_ntz"
DAY0 = dt.datetime(2024, 1, 1)


def batch(spark, rows):
    return spark.createDataFrame([(a, k, None if at is None else DAY0 + dt.timedelta(hours=at)) for a, k, at in rows], SCHEMA)


def plain(rows, hours):
    """Counts per advisor in the window that ends with the newest row, and the newest row's hour."""
    known = [r for r in rows if r[2] is not None]
    now = max(r[2] for r in known)
    kinds = ("CALL", "MEETING", "EMAIL")
    return {
        a: (*[sum(r[0] == a and r[1] == k and now - hours <= r[2] <= now for r in known) for k in kinds], max(r[2] for r in known if r[0] == a))
        for a in {r[0] for r in known}
    }


def mine(spark, state):
    return {
        r["advisor_id"]: (r["call_count_30d"], r["meeting_count_30d"], r["email_count_30d"], int((r["last"] - DAY0).total_seconds() // 3600))
        for r in sliding.current(spark, state).collect()
    }


def files(spark, state):
    return {b: sorted(spark.read.parquet(p).inputFiles()) for b, p in sliding._bucket_paths(spark, state, 2**62).items()}


def test_equals_recomputation_after_every_batch(spark, tmp_path):
    rng, state = random.Random(4), str(tmp_path)
    window = sliding.activity_window(days=3, buckets=4)
    rows = []
    for version, (low, high) in enumerate([(0, 60), (40, 100), (20, 90), (100, 101), (300, 310)]):
        new = [(f"A{rng.randrange(12)}", rng.choice(["CALL", "MEETING", "EMAIL", "AUM_UPDATE", None]), rng.randrange(low, high)) for _ in range(60)]
        new += [("A1", "CALL", low)] * 30 + [(None, "CALL", low), ("A2", "CALL", None)]  # a hot key, no key, no instant
        rows += new
        sliding.advance(batch(spark, new), version, state, window)
        assert mine(spark, state) == plain(rows, 72), version
        if version == 1:  # the batch again, from the state before it
            sliding.advance(batch(spark, new), version, state, window)
            assert mine(spark, state) == plain(rows, 72)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    state, window = str(tmp_path), sliding.activity_window(days=3, buckets=8)
    sliding.advance(batch(spark, [(f"A{i}", "CALL", 50) for i in range(40)]), 0, state, window)
    before = files(spark, state)
    sliding.advance(batch(spark, [("A7", "EMAIL", 51)]), 1, state, window)
    after = files(spark, state)
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    # 72 hours on, rows of the first batch leave the window: now all change
    sliding.advance(batch(spark, [("A7", "EMAIL", 50 + 73)]), 2, state, window)
    assert all(after[b] != f for b, f in files(spark, state).items())
    assert sum(sum(v[:3]) for v in mine(spark, state).values()) == 2


def test_a_broken_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    state, window = str(tmp_path), sliding.activity_window(days=3, buckets=2)
    rows = [("A1", "CALL", 5), ("A2", "CALL", 6)]
    sliding.advance(batch(spark, rows), 0, state, window)
    more = [("A1", "MEETING", 90)]
    with monkeypatch.context() as broken:
        broken.setattr(sliding, "_bucket_paths", lambda *a: (_ for _ in ()).throw(OSError))
        with pytest.raises(OSError):
            sliding.advance(batch(spark, more), 1, state, window)
    assert mine(spark, state) == plain(rows, 72)
    sliding.advance(batch(spark, more), 1, state, window)
    assert mine(spark, state) == plain(rows + more, 72)


def test_empty_batches(spark, tmp_path):
    state, window = str(tmp_path), sliding.activity_window(buckets=2)
    sliding.advance(batch(spark, []), 0, state, window)
    with pytest.raises(ValueError, match="no row has come"):
        sliding.current(spark, state)
    sliding.advance(batch(spark, [("A1", "CALL", 5)]), 1, state, window)
    sliding.advance(batch(spark, []), 2, state, window)
    assert mine(spark, state) == {"A1": (1, 0, 0, 5)}


def test_old_days_are_deleted(spark, tmp_path):
    state, window = str(tmp_path), sliding.activity_window(days=2, buckets=2)
    for version in range(6):
        sliding.advance(batch(spark, [("A1", "CALL", 24 * version)]), version, state, window)
    days = {d for v in refresh._folders(spark, f"{state}/parts", "version").values() for d in refresh._folders(spark, v, "unit")}
    assert min(days) == "2024-01-03"  # two days before the end of the version before
    assert mine(spark, state) == {"A1": (3, 0, 0, 120)}
