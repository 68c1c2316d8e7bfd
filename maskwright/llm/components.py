"""Connected components by alternating star contraction; all state stays in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, few_files, stored


def _star(edges: DataFrame, large: bool, most: int) -> DataFrame:
    """Point every neighbour of a node (larger ones, or itself and the smaller ones) at its least neighbour.

    The least neighbours are stored, so that the join has plain exchanges on both sides and a hub can be split. No table
    here has more than `most` rows; only what is dealt out anew after the join goes to few files."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = stored(few_files(low, most), "least")
        out = around.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = stored(few_files(edges.groupBy("u").agg(F.min("v").alias("m")), most), "least")
        out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
    out = stored(few_files(out.filter("u > v").distinct(), most), "edges")
    dropped(low)
    return out


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v) long pairs to (node, component); the component is the least node that can be reached.

    Nodes without an edge to another node are not returned. Null ends, loops and repeated pairs are ignored.
    Raises if `rounds` contractions do not suffice (they halve the depth each time)."""
    now = stored(
        edges.filter("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(now)
    if not seen[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        # of n edges the first half makes one for each of at most 2 n directed ones, the second at most two for each of these
        half = _star(now, True, 2 * seen[0])
        new = _star(half, False, 4 * seen[0])
        dropped(half)
        dropped(now)
        now, was, seen = new, seen, mark(new)
        if was == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"no fixed point after {rounds} rounds")
