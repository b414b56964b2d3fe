"""Lines and helpers the tests share."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

TESTDATA = Path("/root/testdata")
LINE = "value string, arrival bigint, arrival_ts timestamp"


def at(second: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)


def order_line(id=1, amount="10.00", status="1001", user="7", consignee="ann", created="2020-4-25 18:47:14", **other):
    operated = other.get("operated", created)
    return (
        f"{id},{consignee},tel,{amount},{status},{user},addr,note,trade,body,{created},{operated},29,5"
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
