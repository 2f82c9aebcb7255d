"""One micro-batch, several typed projections, several sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ferryline.operators.typed import Route, typed_select
from ferryline.sinks.tables import TableSink

STAGE_SLOTS = 2


def fan_out(
    routes: Sequence[tuple[Route, TableSink]],
    persist: bool = True,
    stage_dir: str | None = None,
):
    """``foreachBatch`` handler writing each route to its sink.

    The batch is first narrowed to the fields the routes use (so the JSON
    parse upstream is pruned to them). With more than one route it is then
    shared, so the source is read and parsed once rather than once per sink;
    where the routes agree on every field's type, each is cast once, too:

    * ``stage_dir`` given (a folder under the shared root): the narrowed
      batch is written there once as Parquet and every route reads that
      copy. This cuts the lineage back to the topic, so executors lost
      mid-batch cost a re-read of shared files, never a re-read of topic
      offsets that retention may already have dropped. Two slots are used
      in turn (batch id mod 2): staging holds at most two batches, and a
      replayed batch overwrites its own slot.
    * otherwise, with ``persist``: the narrowed batch is persisted
      (MEMORY_AND_DISK) and unpersisted after the last sink. The batch
      size, and so the cache, is bounded by the source's rate limit; a
      lost cached block is recomputed from the batch's fixed offsets.
    """
    needed: list[str] = []
    for route, _ in routes:
        needed += [f for f in route.fields if f not in needed]
    shared = len(routes) > 1
    typed = list(dict.fromkeys(column for route, _ in routes for column in route.columns))
    cast_once = shared and bool(stage_dir or persist) and len(typed) == len(needed)
    cache = persist and shared and not stage_dir

    def handle(batch: DataFrame, batch_id: int) -> None:
        narrowed = typed_select(batch, typed) if cast_once else batch.select(*needed)
        if stage_dir and shared:
            slot = f"{stage_dir}/slot={batch_id % STAGE_SLOTS}"
            narrowed.write.mode("overwrite").parquet(slot)
            # known schema: no footer reads to infer it, and an empty slot reads as empty
            narrowed = batch.sparkSession.read.schema(narrowed.schema).parquet(slot)
        elif cache:
            narrowed = narrowed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for route, sink in routes:
                sink.write(narrowed.select(*route.fields) if cast_once else route.apply(narrowed), batch_id)
        finally:
            if cache:
                narrowed.unpersist()

    return handle


def single_sink(sink: TableSink):
    """``foreachBatch`` handler writing the batch as it is."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)

    return handle
