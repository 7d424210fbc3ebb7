"""A screening run as one stateful stream.

Every identity has a record in keyed state. What is completed is skipped, what failed is
screened again with the identity's next row or after a delay, context is refreshed, and a
shard hands its changed records on when ``flush_every`` of them are held. Spark keeps the
state in the stream's checkpoint, so a run that is stopped goes on where it was.
"""

from __future__ import annotations

import itertools
import json
import pickle
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING, NamedTuple

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from sieveline.sources.readers import path_exists
from sieveline.streaming.incremental import same_run

if TYPE_CHECKING:
    import pandas as pd

#: Result (null: failed) and reason code of one attempt at a row's payload.
Detect = Callable[[str, int], tuple[str | None, str]]
INPUT = "identity string, digest string, stamp timestamp, sequence long, payload string, context string, shard int"
OUTPUT = "identity string, status string, reason_code string, result string, digest string, context string, attempts long, skipped long, version long"
#: Closing rows come after all others.
LAST = (1 << 63) - 1
#: Parts of a shard's records that are read and stored at once, and rows that a shard hands on in one frame, about.
BUCKETS, FRAME_ROWS = 32, 10_000


class Record(NamedTuple):
    """What is known of an identity. ``due`` (microseconds) is when its failed payload is
    tried again, null for never; ``tries`` are those of that payload."""

    status: str
    reason_code: str
    result: str | None
    digest: str | None
    context: str | None
    attempts: int = 0
    skipped: int = 0
    version: int = 0
    tries: int = 0
    due: int | None = None
    payload: str | None = None


class Row(NamedTuple):
    """What a manifest row says of its identity; ``us`` is its stamp in microseconds."""

    digest: str | None
    us: int
    payload: str | None
    context: str | None


class Screening(StatefulProcessor):
    """The state of one shard: buckets of records, each bucket's first due time, and changed records to hand on.

    A trigger's rows of a shard are sorted in memory; the trigger's size and the number of
    shards bound them. Records stay in the state store and are read and stored a bucket at a time, once
    a trigger: each access is a message to Spark, which costs more than many records do.
    """

    def __init__(self, detect: Detect, delay: int, retries: int, permanent: tuple[str, ...], flush_every: int):
        self.detect, self.delay, self.retries, self.permanent, self.flush_every = detect, delay, retries, permanent, flush_every

    def init(self, handle) -> None:
        self.handle = handle
        self.records = handle.getMapState("records", "bucket int", "held binary")
        self.waiting = handle.getMapState("waiting", "bucket int", "due long")
        self.pending = handle.getListState("pending", OUTPUT)

    def opened(self, bucket: int) -> dict[str, Record]:
        """A bucket's records by identity."""
        found = self.records.getValue((bucket,))
        return {i: Record(*r) for i, r in pickle.loads(found[0]).items()} if found is not None else {}

    def closed(self, bucket: int, held: dict[str, Record]) -> None:
        """Store a bucket and when its first retry is due."""
        self.records.updateValue((bucket,), (pickle.dumps({i: tuple(r) for i, r in held.items()}, pickle.HIGHEST_PROTOCOL),))
        due = min((r.due for r in held.values() if r.due is not None), default=None)
        if due is not None:
            self.waiting.updateValue((bucket,), (due,))
        elif self.waiting.containsKey((bucket,)):
            self.waiting.removeKey((bucket,))

    def attempted(self, record: Record, at: int) -> Record:
        """The record after its payload was screened once more."""
        result, reason = self.detect(record.payload, record.tries + 1)
        record = record._replace(attempts=record.attempts + 1, tries=record.tries + 1, result=result, reason_code="" if result is not None else reason)
        if result is not None:
            return record._replace(status="completed", due=None, payload=None)
        again = reason not in self.permanent and record.tries <= self.retries
        return record._replace(status="failed", due=at + self.delay if again else None)

    def retried(self, record: Record, until: int) -> Record:
        """The record after the retries that fall due by then."""
        while record.due is not None and record.due <= until:
            record = self.attempted(record, record.due)
        return record

    def met(self, record: Record | None, row: Row) -> Record:
        """The record after a row of its identity."""
        if record is None:
            record = Record("failed", "", None, row.digest, row.context)
        record = self.retried(record, row.us)._replace(context=row.context)
        if record.status == "stale" or record.digest != row.digest:
            return record._replace(status="stale", reason_code="stale_checkpoint", due=None, payload=None, skipped=record.skipped + 1)
        if record.status == "completed":
            return record._replace(skipped=record.skipped + 1)
        return self.attempted(record._replace(payload=row.payload, tries=0), row.us)

    @staticmethod
    def kept(held: dict[str, Record], identity: str, new: Record) -> tuple:
        """Put a changed record into its bucket; its row for the output."""
        held[identity] = new = new._replace(version=new.version + 1)
        return (identity, *new[:8])

    def due_by(self, until: int) -> list[tuple]:
        """Retry all that is due by then."""
        found = [key[0] for key, value in self.waiting.iterator() if value[0] <= until] if self.waiting.exists() else []
        rows = []
        for bucket in found:
            held = self.opened(bucket)
            for identity, old in [(i, r) for i, r in held.items() if r.due is not None and r.due <= until]:
                rows.append(self.kept(held, identity, self.retried(old, until)))
            self.closed(bucket, held)
        return rows

    def flushed(self, changed: list[tuple], last: bool) -> Iterator[pd.DataFrame]:
        """Full flushes, or all of it at the end; what is left waits in the state."""
        import pandas as pd

        names = [c.split()[0] for c in OUTPUT.split(", ")]
        held = ([tuple(r) for r in self.pending.get()] if self.pending.exists() else []) + changed
        cut = len(held) if last else len(held) - len(held) % self.flush_every
        step = max(1, FRAME_ROWS // self.flush_every) * self.flush_every
        for i in range(0, cut, step):
            yield pd.DataFrame(held[i : min(i + step, cut)], columns=names, dtype=object).astype({"attempts": "int64", "skipped": "int64", "version": "int64"})
        if held[cut:]:
            self.pending.put(held[cut:])
        elif held:
            self.pending.clear()

    def set_timer(self) -> None:
        """A timer for the first retry; it fires once the watermark has passed it."""
        due = [value[0] for value in self.waiting.values()] if self.waiting.exists() else []
        if due:
            at = -(-min(due) // 1000)
            if at not in set(self.handle.listTimers()):
                self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        import pandas as pd

        held = pd.concat(list(rows), ignore_index=True)
        closing = held["identity"].isna().any()
        held = held[held["identity"].notna()]
        held = held.astype(object).where(held.notna(), None)
        names, us, sequence, payload, digest, context = (held[c].tolist() for c in ("identity", "us", "sequence", "payload", "digest", "context"))
        buckets = [zlib.crc32(n.encode()) % BUCKETS for n in names]
        changed = []
        # blanks come last
        keys = [(b, n, at, s is None, s or 0, p is None, p or "") for b, n, at, s, p in zip(buckets, names, us, sequence, payload, strict=True)]
        ordered = sorted(range(len(keys)), key=keys.__getitem__)
        del held, keys
        for bucket, its in itertools.groupby(ordered, buckets.__getitem__):
            records = self.opened(bucket)
            for identity, places in itertools.groupby(its, names.__getitem__):
                record = records.get(identity)
                for i in places:
                    record = self.met(record, Row(digest[i], us[i], payload[i], context[i]))
                changed.append(self.kept(records, identity, record))
            self.closed(bucket, records)
        if closing:
            changed += self.due_by(LAST)
        yield from self.flushed(changed, closing)
        if not closing and self.timed:
            self.set_timer()

    #: A batch has no watermark and no timers.
    timed = True

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.flushed(self.due_by(timerValues.getCurrentWatermarkInMs() * 1000), False)
        self.set_timer()

    def close(self) -> None:
        pass


def screening_rows(rows: DataFrame, identity: Column, digest: Column, stamp: Column, sequence: Column, payload: Column, context: Column, shards: int = 64) -> DataFrame:
    """Manifest rows in the form that ``screened`` takes. A shard takes all rows of its identities."""
    named = {"identity": identity.cast("string"), "digest": digest.cast("string"), "stamp": stamp.cast("timestamp"), "sequence": sequence.cast("long"), "payload": payload.cast("string"), "context": context.cast("string")}
    shard = F.pmod(F.xxhash64(named["identity"]), F.lit(shards)).cast("int")
    return rows.select(*[c.alias(n) for n, c in named.items()], shard.alias("shard"))


def closing_rows(spark: SparkSession, shards: int = 64) -> DataFrame:
    """One row a shard that ends a run: waiting retries are made, held records handed on."""
    null = F.lit(None)
    return spark.range(shards).select(null.cast("string").alias("identity"), null.cast("string").alias("digest"), null.cast("timestamp").alias("stamp"), null.cast("long").alias("sequence"), null.cast("string").alias("payload"), null.cast("string").alias("context"), F.col("id").cast("int").alias("shard"))


def screened(rows: DataFrame, detect: Detect, *, delay_seconds: int = 3600, retries: int = 1, permanent: tuple[str, ...] = ("source_mismatch",), flush_every: int = 1000, late: str = "1 hour") -> DataFrame:
    """Changed records, each with a version that grows: of an identity the greatest counts.

    An identity's rows are taken by stamp and sequence within a trigger; over triggers they
    must come in that order. A row of an identity with another digest makes its record stale. A
    failed payload is tried again ``retries`` times, ``delay_seconds`` of the rows' own time
    apart, unless its reason is permanent or the identity's next row came first. Null identities are
    closing rows; rows without a stamp count as the first. An empty input gives no rows.
    """
    streaming = rows.isStreaming
    source = rows.withWatermark("stamp", late) if streaming else rows
    source = source.withColumn("us", F.coalesce(F.unix_micros("stamp"), F.lit(0)))
    processor = Screening(detect, delay_seconds * 1_000_000, retries, permanent, flush_every)
    processor.timed = streaming
    # Spark also asks a worker beside the driver for the state's schema, and that worker hasn't the
    # files given to executors: what it needs travels in the pickle.
    modules = [sys.modules[m] for m in {__name__, detect.__module__} - set(cloudpickle.list_registry_pickle_by_value())]
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    try:
        return source.groupBy("shard").transformWithStateInPandas(processor, OUTPUT, "append", "eventTime" if streaming else "none")
    finally:
        for m in modules:
            cloudpickle.unregister_pickle_by_value(m)


def run_screening(spark: SparkSession, inbox: str, root: str, detect: Detect, run: dict, *, stores: int = 64, **settings) -> DataFrame:
    """Screen what came into ``inbox`` (parquet of ``screening_rows``) since the last start and
    give every record handed on so far, latest versions only.

    ``run`` names the run (inputs, model, floor); a start under another name is refused. Stopping
    and starting gives the records of one start, once closing rows have come. Shards are dealt to
    ``stores`` state stores at most (never more than the session's shuffle partitions); each is opened and committed in every trigger, also an empty one.
    """
    named = json.dumps(run, sort_keys=True)
    if path_exists(spark, f"{root}/run"):
        same_run(json.loads(spark.read.text(f"{root}/run").first()[0]), run)
    else:
        spark.createDataFrame([(named,)], "value string").coalesce(1).write.text(f"{root}/run")
    partitions = "spark.sql.shuffle.partitions"
    conf = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", partitions: str(min(stores, int(spark.conf.get(partitions))))}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(INPUT).parquet(inbox)
        changed = screened(stream, detect, **settings)
        changed.writeStream.format("parquet").option("path", f"{root}/records").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return latest(spark.read.schema(OUTPUT).parquet(f"{root}/records"))


def latest(records: DataFrame) -> DataFrame:
    """Each identity's record of the greatest version: partial maxima, one row an identity."""
    rest = [c for c in records.columns if c != "identity"]
    return records.groupBy("identity").agg(F.max_by(F.struct(*rest), "version").alias("r")).select("identity", *[F.col(f"r.{c}").alias(c) for c in rest])
