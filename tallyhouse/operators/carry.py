"""Last known value before a position, for groups of any size.

A running `last` over one window would hold a whole group in one task. Here a
group is cut into chunks along its order. Each chunk finds its own answer, and
only one row per chunk travels to tell the next chunks what came before.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def carry_last(
    points: DataFrame,
    keys: list[str],
    chunk: str,
    at: str,
    value: str,
    out: str,
    backward: bool = False,
) -> DataFrame:
    """Add `out`: the last non-null `value` at a smaller `at` of the same keys.

    `points` has one row per keys and `at`; `chunk` must never fall as `at`
    rises, and its width bounds the rows one task has to order. `backward`
    reads from the far end: the nearest value at a larger `at`.
    """

    def earlier(keyed: list[str], order: str) -> WindowSpec:
        by = F.col(order).desc() if backward else F.col(order).asc()
        return (
            Window.partitionBy(*keyed).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        )

    nearest = F.min_by if backward else F.max_by
    known = F.when(F.col(value).isNotNull(), F.col(at))
    tails = (
        points.groupBy(*keys, chunk)
        .agg(nearest(F.col(value), known).alias("_tail"))
        .withColumn("_before", F.last("_tail", ignorenulls=True).over(earlier(keys, chunk)))
        .drop("_tail")
    )
    inside = F.last(value, ignorenulls=True).over(earlier([*keys, chunk], at))
    return (
        points.withColumn("_inside", inside)
        .join(tails, [*keys, chunk], "left")
        .withColumn(out, F.coalesce("_inside", "_before"))
        .drop("_inside", "_before")
    )
