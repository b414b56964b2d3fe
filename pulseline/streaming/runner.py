"""Runs a job's flows over batch tables or streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .sinks import Sink
from .stages import append_once

# Turns a batch of a flow into the rows of one product.
Output = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class Flow:
    """One frame that several products are made from, so that its lines are read and decoded once.

    With `stage`, a stream's rows are also left in that folder, for flows that stand after it and read them from there.
    """

    name: str
    frame: DataFrame
    outputs: dict[str, Output]
    output_mode: str = "append"
    stage: str | None = None
    stage_files: int | None = None

    def wanted(self, sinks: dict[str, Sink]) -> bool:
        return not self.outputs or bool(self.outputs.keys() & sinks.keys())

    def put(self, batch: DataFrame, batch_id: int) -> None:
        append_once(batch, batch_id, self.stage, self.stage_files)


def write_outputs(
    batch: DataFrame, batch_id: int, outputs: dict[str, Output], sinks: dict[str, Sink], *, streamed: bool = False,
    stage: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """A micro-batch is held while it is worked on: an output may use it twice, and its lines are read once.

    One that is only staged is used once.
    """
    wanted = {name: output for name, output in outputs.items() if name in sinks}
    shared = bool(wanted) and (streamed or len(wanted) > 1)
    if shared:
        batch.persist()
    try:
        if stage:
            stage(batch, batch_id)
        for name, output in wanted.items():
            sinks[name](output(batch, batch_id), batch_id, name)
    finally:
        if shared:
            batch.unpersist()


def run_job(
    flows: list[Flow], sinks: dict[str, Sink], *, checkpoint: str | None = None, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Write every product that has a sink. Streams start one query per flow; a batch frame is written at once.

    Sinks get the batch id and replace what the same batch wrote before, so a restarted query repeats its last
    batch without an effect.
    """
    queries = []
    trigger = trigger or {"processingTime": "3 seconds"}
    staged = any(flow.wanted(sinks) for flow in flows if flow.stage is None)
    for flow in flows:
        if not flow.wanted(sinks) and not (flow.stage and staged):
            continue
        if not flow.frame.isStreaming:
            write_outputs(flow.frame, 0, flow.outputs, sinks)
            continue
        if checkpoint is None:
            raise ValueError("a stream needs a checkpoint folder")

        def write(batch: DataFrame, batch_id: int, flow: Flow = flow) -> None:
            stage = flow.put if flow.stage and staged else None
            write_outputs(batch, batch_id, flow.outputs, sinks, streamed=True, stage=stage)

        writer = flow.frame.writeStream.outputMode(flow.output_mode).queryName(flow.name).foreachBatch(write)
        query = writer.option("checkpointLocation", f"{checkpoint}/{flow.name}").trigger(**trigger).start()
        queries.append(query)
        if flow.stage and "processingTime" not in trigger:
            query.awaitTermination()  # flows that end by themselves find all of its rows
    return queries
