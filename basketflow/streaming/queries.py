"""The four outputs of the behaviour stream."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..operators.windows import (
    DIMENSION_WIDTH, GLOBAL_WIDTH, brand_windows, category_windows, global_windows,
)
from ..schema import DETAIL, REALTIME_BRAND, REALTIME_CATEGORY, REALTIME_GLOBAL
from .sinks import generation_of, versioned_sink

WATERMARK = "30 seconds"
CADENCE = "5 seconds"


def with_event_time(events: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Rows more than ``delay`` behind the newest event may be dropped.

    The watermark is the maximum over the whole input. Rows of ``one_of_many`` have theirs already.
    """
    return events.withWatermark("event_time", delay)


def one_of_many(*sources: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Several sources as one, each with a watermark of its own.

    Under the policy of ``STREAMING_SETTINGS`` the furthest of them counts, as if all had come
    through one source: an idle source does not hold windows open, and rows of a slow one may be late.
    """
    marked = [with_event_time(source, delay) for source in sources]
    rows = marked[0]
    for other in marked[1:]:
        rows = rows.unionByName(other)
    return rows


def windowed_outputs(events: DataFrame, global_width: str = GLOBAL_WIDTH,
                     dimension_width: str = DIMENSION_WIDTH, exact_uv: bool = True,
                     delay: str | None = WATERMARK) -> dict[str, DataFrame]:
    """Global, category and brand metrics. Three aggregations because distinct users do not add;
    each reads and parses the source itself. Without a ``delay`` the rows are marked already."""
    marked = with_event_time(events, delay) if delay else events
    return {
        REALTIME_GLOBAL.name: global_windows(marked, global_width, exact_uv=exact_uv),
        REALTIME_CATEGORY.name: category_windows(marked, dimension_width, exact_uv=exact_uv),
        REALTIME_BRAND.name: brand_windows(marked, dimension_width, exact_uv=exact_uv),
    }


def start_windows(stats: DataFrame, name: str, path: str, checkpoint: str,
                  trigger: dict) -> StreamingQuery:
    generation = generation_of(stats.sparkSession, path, checkpoint)
    writer = (stats.writeStream.outputMode("append").queryName(name)
              .option("checkpointLocation", checkpoint)
              .foreachBatch(versioned_sink(path, generation)))
    return _start(writer, trigger)


def start_detail(events: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Cleaned events, appended exactly once to day folders."""
    writer = (DETAIL.conform(events).writeStream.outputMode("append").format("parquet")
              .queryName(DETAIL.name).partitionBy("event_date")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _start(writer, trigger)


def _start(writer: DataStreamWriter, trigger: dict) -> StreamingQuery:
    return writer.trigger(**trigger).start()


def start_all(events: DataFrame, out: str, checkpoints: str, trigger: dict | None = None,
              **options: str) -> dict[str, StreamingQuery]:
    """One stream into four independent queries, each with its own checkpoint and progress."""
    trigger = trigger or {"processingTime": CADENCE}
    running = {DETAIL.name: start_detail(
        events, f"{out}/{DETAIL.name}", f"{checkpoints}/{DETAIL.name}", trigger)}
    for name, stats in windowed_outputs(events, **options).items():
        running[name] = start_windows(
            stats, name, f"{out}/{name}", f"{checkpoints}/{name}", trigger)
    return running


def await_all(running: dict[str, StreamingQuery]) -> None:
    """Wait until every query has ended; if one fails, stop the others and raise its error."""
    open_ = dict(running)
    while open_:
        for name, query in list(open_.items()):
            try:
                ended = query.awaitTermination(1)
            except Exception:
                for other in running.values():
                    other.stop()
                raise
            if ended:
                del open_[name]


class LateRows(StreamingQueryListener):
    """Rows dropped for lateness per query id, added up over all batches since it was attached."""

    def __init__(self):
        self.dropped: Counter[str] = Counter()

    def attach(self, spark: SparkSession) -> LateRows:
        spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        self.dropped[str(progress.id)] += sum(
            op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped[str(query.id)]
