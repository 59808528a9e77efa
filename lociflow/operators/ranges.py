"""Range joins by bins and the collapse of neighbouring variants to loci."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOCUS = ["g", "c", "locus_start", "lead_position", "lead_p", "lead_label", "n_positions"]


def range_join(points: DataFrame, intervals: DataFrame, key: str, point: str, start: str, end: str, width: int) -> DataFrame:
    """Pairs with equal ``key`` and start <= point <= end, as an equi-join over bins of ``width``.

    Each interval is repeated for the bins it touches (width should be near the usual length), each
    point is in one bin, so no pair comes out twice and no nested loop is planned. Null ends or
    points match nothing. Columns other than the key must differ between the sides.
    """
    bin_of = lambda c: F.floor(F.col(c) / width)
    wide = intervals.where(F.col(start) <= F.col(end)).withColumn("__bin", F.explode(F.sequence(bin_of(start), bin_of(end))))
    near = points.where(F.col(point).isNotNull()).withColumn("__bin", bin_of(point)).join(wide, [key, "__bin"])
    return near.where(F.col(point).between(F.col(start), F.col(end))).drop("__bin")


def collapse_loci(hits: DataFrame, group: str, chromosome: str, position: str, p: str, window: int, label: str) -> DataFrame:
    """(group, chromosome, locus_start, lead_position, lead_p, lead_label, n_positions): loci of neighbouring hits.

    Hits are scanned by position; a hit further than ``window`` from the present locus' best opens
    a new locus, a better one takes the lead. A gap above ``window`` between two neighbours always
    opens a locus, so the scan is split there first; only positions, the best p of each, are
    scanned, in tasks of one unbroken run. Null positions or p values are left out; equal p: the first.
    """
    best = hits.where(F.col(position).isNotNull() & F.col(p).isNotNull() & ~F.isnan(p)).groupBy(group, chromosome, position).agg(F.min(F.struct(p, label)).alias("b"))
    order = Window.partitionBy(group, chromosome).orderBy(position)
    gap = F.coalesce(F.col(position) - F.lag(position).over(order) > window, F.lit(True))
    runs = best.withColumn("__new", gap.cast("int")).withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    columns = runs.select(F.col(group).cast("string").alias("g"), F.col(chromosome).cast("int").alias("c"), "__run", F.col(position).cast("long").alias("pos"), F.col(f"b.{p}").alias("p"), F.col(f"b.{label}").cast("string").alias("name"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, locus = None, None
        for batch in batches:
            closed = []
            for g, c, run, pos, value, name in batch.itertuples(index=False, name=None):
                if locus is None or (g, c, run) != key or pos - locus[3] > window:
                    if locus is not None:
                        closed.append(locus)
                    key, locus = (g, c, run), [g, c, pos, pos, value, name, 1]
                    continue
                locus[6] += 1
                if value < locus[4]:
                    locus[3:6] = [pos, value, name]
            yield pd.DataFrame(closed, columns=LOCUS)
        yield pd.DataFrame([locus] if locus is not None else [], columns=LOCUS)

    # one stream of sorted positions a task: only the present locus is held
    ordered = columns.repartition("g", "c", "__run").sortWithinPartitions("g", "c", "__run", "pos")
    found = ordered.mapInPandas(scan, "g string, c int, locus_start long, lead_position long, lead_p double, lead_label string, n_positions int")
    return found.withColumnsRenamed({"g": group, "c": chromosome})
