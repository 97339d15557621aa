"""The bucketed state against the winning changes of the whole feed."""

import os
import random

import pytest

from paperloom.operators import bucketed_state
from paperloom.operators.bucketed_state import BucketedState
from paperloom.operators.changelog import last_changes

SCHEMA = "pmid long, file_name string, is_delete int, pos long, value string"


@pytest.fixture(scope="module")
def feed():
    rng = random.Random(8)
    return [(rng.randrange(60) if k % 3 else 7, f"f{k // 50:02d}", int(rng.random() < 0.2), k, str(k)) for k in range(400)]


def _files(folder, paths):
    return {f"{p}/{f}": open(f"{folder}/{p}/{f}", "rb").read() for p in paths for f in os.listdir(f"{folder}/{p}") if f.endswith(".parquet")}


def test_state_is_that_of_the_feed(spark, feed, tmp_path):
    frame = spark.createDataFrame(feed, SCHEMA)
    want = sorted(map(tuple, last_changes(frame).collect()))
    for k, order in enumerate([range(8), [5, 0, 7, 3, 3, 1, 2, 6, 4]]):
        state = BucketedState(spark, f"{tmp_path}/s{k}", frame.schema, buckets=8, files_per_bucket=2)
        for i in order:
            state.upsert(frame.filter(f"file_name = 'f{i:02d}'"))
        assert sorted(map(tuple, state.rows().select(frame.columns).collect())) == want


def test_only_touched_buckets_are_rewritten(spark, feed, tmp_path):
    frame = spark.createDataFrame(feed, SCHEMA)
    state = BucketedState(spark, str(tmp_path), frame.schema, buckets=16)
    assert state.rows().count() == 0 and state.version() == 0
    state.upsert(frame)
    before, held = state.paths(), _files(tmp_path, state.paths().values())
    touched = state.upsert(spark.createDataFrame([(7, "f99", 0, 1, "new"), (1007, "f99", 1, 2, None)], SCHEMA))
    after = state.paths()
    same = [b for b in before if b not in touched]
    assert 1 <= len(touched) <= 2 and all(after[b] == before[b] for b in same)
    assert _files(tmp_path, [before[b] for b in same]) == {f: x for f, x in held.items() if any(f.startswith(before[b] + "/") for b in same)}
    assert sorted(state.unused()) == sorted(before[b] for b in touched if b in before)
    assert {r.pmid: r.value for r in state.rows().collect()}[7] == "new"
    assert state.upsert(frame.limit(0)) == [] and state.version() == 2
    with pytest.raises(ValueError, match="16 buckets"):
        BucketedState(spark, str(tmp_path), frame.schema, buckets=4).rows()


def test_a_lost_upsert_leaves_the_old_state(spark, feed, tmp_path, monkeypatch):
    frame = spark.createDataFrame(feed, SCHEMA)
    state = BucketedState(spark, str(tmp_path), frame.schema, buckets=4)
    state.upsert(frame)
    want = sorted(map(tuple, state.rows().collect()))
    more = spark.createDataFrame([(7, "f99", 0, 1, "new")], SCHEMA)

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(bucketed_state, "publish_file", lost)
    with pytest.raises(RuntimeError):
        state.upsert(more)
    assert sorted(map(tuple, state.rows().collect())) == want and state.version() == 1
    monkeypatch.undo()
    state.upsert(more)
    assert {r.pmid: r.value for r in state.rows().collect()}[7] == "new" and state.version() == 2
    with pytest.raises(FileExistsError):
        bucketed_state.publish_file(spark, f"{tmp_path}/manifests/2.json", "{}")
