"""The stateful screening run: restarts, retries, staleness, flushes, run identity."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from sieveline.session import shared_dir
from sieveline.streaming import screening as Z

SHARDS = 3
START = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def model():
    """A function of no module, so that workers needn't import the tests."""

    def outcome(payload, attempt):
        if payload == "bad":
            return None, "source_mismatch"
        if payload.startswith("slow") and attempt <= int(payload[4:]):
            return None, "screen_failed"
        return f"{payload}@{attempt}", ""

    return outcome


outcome = model()


def manifest(spark, rows):
    df = spark.createDataFrame(rows, "id string, digest string, ts timestamp, n long, payload string, note string")
    return Z.screening_rows(df, F.col("id"), F.col("digest"), F.col("ts"), F.col("n"), F.col("payload"), F.col("note"), SHARDS)


def replayed(rows, delay, retries):
    """The same run, one plain loop over each identity's rows."""
    found = {}
    for name in sorted({r[0] for r in rows}):
        status, reason, result, digest, note, attempts, skipped = "failed", "", None, None, None, 0, 0
        tries, payload, due = 0, None, None

        def attempt(at):
            nonlocal status, reason, result, attempts, tries, due
            result, why = outcome(payload, tries + 1)
            attempts, tries = attempts + 1, tries + 1
            status, reason = ("completed", "") if result is not None else ("failed", why)
            due = at + delay if result is None and why != "source_mismatch" and tries <= retries else None

        for _, mark, ts, _, its, text in sorted((r for r in rows if r[0] == name), key=lambda r: (r[2], r[3])):
            while due is not None and due <= ts:
                attempt(due)
            digest, note = mark if digest is None else digest, text
            if status == "stale" or mark != digest:
                status, reason, due, skipped = "stale", "stale_checkpoint", None, skipped + 1
            elif status == "completed":
                skipped += 1
            else:
                payload, tries = its, 0
                attempt(ts)
        while due is not None:
            attempt(due)
        found[name] = (status, reason, result, digest, note, attempts, skipped)
    return found


def answered(df):
    return {r.identity: (r.status, r.reason_code, r.result, r.digest, r.context, r.attempts, r.skipped) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    names, kinds = [f"i{k}" for k in range(40)], ["bad", "ok", "slow1", "slow2", "slow9"]
    return [(r.choice(names), "x" if r.random() < 0.97 else "y", START + dt.timedelta(minutes=37 * n + r.randrange(30)), n, r.choice(kinds), f"n{n}") for n in range(240)]


def test_three_starts_are_one_run_and_the_plain_loop(spark, rows):
    root = f"{shared_dir(spark)}/screen-{uuid.uuid4().hex}"
    settings = {"delay_seconds": 3 * 3600, "retries": 2, "flush_every": 5}
    handed = []
    for k in range(3):
        part = manifest(spark, rows[80 * k : 80 * k + 80])
        (part.unionByName(Z.closing_rows(spark, SHARDS)) if k == 2 else part).write.mode("append").parquet(f"{root}/in")
        found = Z.run_screening(spark, f"{root}/in", f"{root}/out", outcome, {"model": "m"}, **settings)
        handed.append(spark.read.parquet(f"{root}/out/records").count())
        assert k == 2 or handed[-1] % 5 == 0
    assert 0 < handed[0] < handed[1] < handed[2]
    want = replayed(rows, dt.timedelta(hours=3), 2)
    assert answered(found) == want
    assert {v[0] for v in want.values()} == {"stale", "failed", "completed"}
    batch = Z.latest(Z.screened(manifest(spark, rows).unionByName(Z.closing_rows(spark, SHARDS)), outcome, **settings))
    assert answered(batch) == want
    with pytest.raises(ValueError, match="model"):
        Z.run_screening(spark, f"{root}/in", f"{root}/out", outcome, {"model": "other"}, **settings)


def test_a_timer_retries_what_no_later_row_meets(spark):
    """The watermark passes the retry of one identity while only others have rows."""
    root = f"{shared_dir(spark)}/screen-{uuid.uuid4().hex}"
    for k in range(3):
        names = ["waits", "other"] if k == 0 else ["other"]
        manifest(spark, [(n, "x", START + dt.timedelta(days=k), k, "slow1" if n == "waits" else "ok", "c") for n in names]).write.mode("append").parquet(f"{root}/in")
        found = Z.run_screening(spark, f"{root}/in", f"{root}/out", outcome, {}, flush_every=1)
        assert (k == 2) <= (answered(found)["waits"][0] == "completed")
    assert answered(found)["waits"][:3] == ("completed", "", "slow1@2") and answered(found)["waits"][5] == 2


def test_empty_input_blank_columns_and_repeated_rows(spark):
    assert Z.screened(manifest(spark, []), outcome).collect() == []
    odd = [("a", None, None, None, "ok", None), ("a", None, None, None, "ok", None), ("", "d", START, 1, "bad", "z" * 100_000)]
    found = answered(Z.latest(Z.screened(manifest(spark, odd).unionByName(Z.closing_rows(spark, SHARDS)), outcome)))
    assert found["a"] == ("completed", "", "ok@1", None, None, 1, 1)
    assert found[""] == ("failed", "source_mismatch", None, "d", "z" * 100_000, 1, 0)


def test_state_is_read_and_stored_by_buckets():
    """A shard's trigger of 5,000 identities: messages to the state follow the buckets, frames the rows handed on."""
    import pandas as pd

    class Held(dict):
        def __init__(self):
            self.messages = 0

        def getValue(self, key):
            self.messages += 1
            return self.get(key)

        def updateValue(self, key, value):
            self.messages += 1
            self[key] = value

        def containsKey(self, key):
            self.messages += 1
            return key in self

        removeKey, exists, iterator = dict.pop, dict.__len__, dict.items

    class Handle(dict):
        def getMapState(self, name, *_):
            return self.setdefault(name, Held())

        def getListState(self, *_):
            return type("Empty", (), {"exists": lambda s: False, "put": lambda s, x: None, "clear": lambda s: None})()

    handle, processor = Handle(), Z.Screening(outcome, 1, 1, (), 7)
    processor.timed = False
    processor.init(handle)
    names, kinds = [f"i{k}" for k in range(5000)], ["ok", "slow1", "bad"]
    for turn in range(2):
        rows = pd.DataFrame({"identity": names, "digest": "x", "us": turn, "sequence": turn, "payload": [kinds[k % 3] for k in range(5000)], "context": "c"})
        found = list(processor.handleInputRows((0,), iter([rows[:1700], rows[1700:]]), None))
        assert sum(map(len, found)) == 5000 - 5000 % 7 and len(found) <= 5
        assert set(pd.concat(found)["version"]) == {turn + 1}
    assert sum(h.messages for h in handle.values()) <= 2 * 3 * Z.BUCKETS


def test_a_run_opens_few_state_stores(spark):
    root = f"{shared_dir(spark)}/screen-{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = manifest(spark, [(f"i{k}", "x", START, k, "ok", "c") for k in range(30)])
    rows.unionByName(Z.closing_rows(spark, SHARDS)).write.parquet(f"{root}/in")
    assert Z.run_screening(spark, f"{root}/in", f"{root}/out", outcome, {}, stores=2).count() == 30
    stores = [p for p in os.listdir(f"{root}/out/checkpoint/state/0".removeprefix("file://")) if p.isdigit()]
    assert sorted(stores) == ["0", "1"] and spark.conf.get("spark.sql.shuffle.partitions") == before
