"""Order-dependent computations without a single-partition window (W1 helpers).

A running sum over a global order is usually written as
``sum(x).over(Window.orderBy(k))``, which moves every row into ONE task.  Here
the rows are dealt by ranges of (group, order key, tie-break), so every
partition holds a stretch of the order; each stretch computes its local running
sum, the totals of the stretches (one row per group and partition) become
offsets, and these are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creatorlens.session import materialize


def running_sums(df: DataFrame, key: str, cols: Sequence[str], *, descending: bool = False,
                 partition_by: Sequence[str] = (), tiebreak: Sequence[str] = (),
                 prefix: str = "cum_") -> DataFrame:
    """Adds ``prefix + c`` = inclusive running sum of ``c`` ordered by ``key``
    (then ``tiebreak``), restarting for every ``partition_by`` group.

    The ranges are cut by Spark from a sample of the rows; a group or a key that
    holds a third of the data is spread over many of them as far as the
    tie-break tells its rows apart.  Rows that tie on ``key`` and ``tiebreak``
    are summed in an arbitrary but consistent order.  The dealt rows are written
    once, so the stretch of a row is the same in both uses.
    """
    direction = F.desc if descending else F.asc
    order = [direction(key), *[direction(t) for t in tiebreak]]
    groups = list(partition_by)
    b = materialize(df.repartitionByRange(*groups, *order).withColumn("_stretch", F.spark_partition_id()))
    w_local = (Window.partitionBy(*groups, "_stretch").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(w_local).alias(f"_lc_{c}") for c in cols])
    totals = b.groupBy(*groups, "_stretch").agg(*[F.sum(c).alias(f"_pt_{c}") for c in cols])
    w_prev = Window.partitionBy(*groups).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_stretch", *[F.coalesce(F.sum(f"_pt_{c}").over(w_prev), F.lit(0))
                                                   .alias(f"_off_{c}") for c in cols])
    joined = local.join(offsets, [*groups, "_stretch"])
    return joined.select(*df.columns, *[(F.col(f"_lc_{c}") + F.col(f"_off_{c}")).alias(prefix + c) for c in cols])
