"""Change log to snapshot, continuously.

The query's checkpoint remembers which part of the log is done, so a refresh
reads only new records.  Each micro-batch is compacted, added to the touched buckets
of the snapshot and committed under the batch's number: a batch that is
repeated after a failure changes nothing the second time.  Errors stop the query
and are seen; only records that cannot be decoded are set aside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.decode import keyed_events, parse_envelopes, unkeyed_records, without_keyed_text
from tallyline.sinks.bucketed import BucketedState
from tallyline.sinks.snapshot import Snapshot
from tallyline.streaming.derived import FollowUp


@dataclass
class Refresh:
    """What one micro-batch does.

    ``snapshot`` may be a :class:`BucketedState` too, as long as no follow-up asks for buckets.
    ``keep_deletes_ms`` bounds how long delete markers wait for late events,
    ``keep_versions`` how many versions of the snapshot and of the tables that follow it
    stay readable.
    ``name`` tells the commits of one query from another's; :func:`run_refresh`
    sets it to the checkpoint, which is what numbers the batches.
    ``after`` receives the snapshot and its new version after each commit, for
    outputs that are functions of the whole state (indicators, averages).
    """

    snapshot: Snapshot | BucketedState
    row: T.StructType
    keys: Sequence[str]
    mode: str = "replace"
    dead_letter_path: str | None = None
    keep_deletes_ms: int | None = None
    keep_versions: int | None = None
    name: str = "refresh"
    after: list[Callable[[Snapshot, int], None]] = field(default_factory=list)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        parsed = parse_envelopes(changes, self.row, self.keys)
        if self.dead_letter_path:
            # Two outputs read the batch: keep it parsed between them.
            parsed = without_keyed_text(parsed, self.keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.dead_letter_path:
                # A folder per batch: a repeated batch replaces its own letters.
                letters = unkeyed_records(parsed, self.keys)
                letters.write.mode("overwrite").parquet(f"{self.dead_letter_path}/batch={batch_id}")
            events = keyed_events(parsed, self.row, self.keys)
            version = self.snapshot.apply(
                events, self.mode, f"{self.name}#{batch_id}", self.keep_deletes_ms
            )
            for step in self.after:
                step(self.snapshot, version)
            if self.keep_versions:
                self.snapshot.expire(self.keep_versions)
                for step in self.after:
                    if isinstance(step, FollowUp):
                        step.table.expire(self.keep_versions)
        finally:
            if self.dead_letter_path:
                parsed.unpersist()


def run_refresh(
    changes: DataFrame,
    refresh: Refresh,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Starts the query.

    ``every`` (``"5 seconds"``) keeps it running; without it the query works off
    what the log holds now and stops; the reader's ``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger`` bounds its batches.
    """
    refresh.name = checkpoint
    writer = changes.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
