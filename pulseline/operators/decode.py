"""Lines to typed rows, with a quarantine for malformed lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text

SHORT, BAD_NUMBER, BAD_TIME = "short", "bad_number", "bad_time"
REASON_OF_TYPE = {"long": BAD_NUMBER, "int": BAD_NUMBER, "money": BAD_NUMBER, "double": BAD_NUMBER, "time": BAD_TIME}


class Decoded(NamedTuple):
    """Valid rows, (value, arrival, arrival_ts, reason) of the lines that are not, and both as one frame."""

    rows: DataFrame
    rejects: DataFrame
    labelled: DataFrame


def rows_of(labelled: DataFrame) -> DataFrame:
    return labelled.where("reason IS NULL").drop("value", "reason")


def rejects_of(labelled: DataFrame) -> DataFrame:
    return labelled.where("reason IS NOT NULL").select("value", "arrival", "arrival_ts", "reason")


def decode_orders(lines: DataFrame, **options) -> Decoded:
    """Order lines; `date_only=True` keeps only the day of the two times."""
    return decode(lines, codes.ORDER_LINE, **options)


def decode_order_details(lines: DataFrame, **options) -> Decoded:
    return decode(lines, codes.DETAIL_LINE, **options)


def decode_produce(lines: DataFrame, **options) -> Decoded:
    """Produce lines; `on_bad="fail"` is the strict variant."""
    return decode(lines, codes.PRODUCE_LINE, **options)


def decode_changes(lines: DataFrame, with_time: bool = False, **options) -> Decoded:
    """Machine state changes; the start time has to be valid only `with_time`."""
    layout = [f for f in codes.CHANGE_LINE if with_time or f[0] != "start_time"]
    return decode(lines, layout, **options)


def decode_environment(lines: DataFrame, **options) -> Decoded:
    return decode(lines, codes.ENVIRONMENT_LINE, **options)


def decode(
    lines: DataFrame,
    layout,
    *,
    required: tuple[str, ...] | None = None,
    on_bad: str = "quarantine",
    date_only: bool = False,
) -> Decoded:
    """Decode lines by a layout of (name, position, type).

    A line is malformed when one of the `required` fields (default: all) is missing or not of its type; other
    fields are NULL then. `on_bad="fail"` makes the job fail on the first malformed line.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    required = tuple(name for name, _, _ in layout) if required is None else required
    line = ["value", "arrival", "arrival_ts"]
    fields = text.compute_once(lines.select(*line), line, {"_fields": text.SPLIT_FIELDS})
    furthest = max([position for name, position, _ in layout if name in required] + [0])
    typed = {name: text.parse(text.field("_fields", position), kind, date_only) for name, position, kind in layout}
    parsed = text.compute_once(fields, line, {**typed, "_short": f"size(_fields) <= {furthest}"})
    reason = _reason([(name, kind) for name, _, kind in layout if name in required])
    if on_bad == "fail":
        reason = f"CASE WHEN {reason} IS NOT NULL THEN CAST(raise_error(concat('malformed line: ', value)) AS string) END"
    rows = parsed.where(f"{reason} IS NULL").select(*typed, "arrival", "arrival_ts")
    rejects = parsed.select(*line, F.expr(reason).alias("reason")).where("reason IS NOT NULL")
    line_of_reject = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    labelled = parsed.withColumn("reason", F.expr(reason)).select(line_of_reject, *typed, "arrival", "arrival_ts", "reason")
    return Decoded(rows, rejects, labelled)


def _reason(fields: list[tuple[str, str]]) -> str:
    cases = [f"WHEN _short THEN '{SHORT}'"]
    for reason in (BAD_NUMBER, BAD_TIME):
        bad = [f"{name} IS NULL" for name, kind in fields if REASON_OF_TYPE.get(kind) == reason]
        if bad:
            cases.append(f"WHEN {' OR '.join(bad)} THEN '{reason}'")
    return f"(CASE {' '.join(cases)} END)"


def reject_counts(*decoded: Decoded) -> DataFrame:
    """Malformed lines per reason."""
    rejects = decoded[0].rejects
    for other in decoded[1:]:
        rejects = rejects.unionByName(other.rejects)
    return rejects.groupBy("reason").agg(F.count("*").alias("lines"))


def with_event_time(orders: DataFrame) -> DataFrame:
    """Event time of an order: the later of its two times."""
    return orders.withColumn("event_time", F.greatest("create_time", "operation_time"))
