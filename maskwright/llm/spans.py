"""Digest columns of spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(found: Column, order: str) -> Column:
    """Comma-joined kind:start:end of structs (start, end, rank, kind), by rank then start or by start then rank."""
    first, second = ("rank", "start") if order == "kind" else ("start", "rank")
    rows = F.array_sort(F.transform(found, lambda s: F.struct(s[first].alias("a"), s[second].alias("b"), s["end"].alias("end"), s["start"].alias("start"), s["kind"].alias("kind"))))
    return F.concat_ws(",", F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def counted(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
