"""Total order over a table of any size, without a one-task window.

A window with no ``partitionBy`` sends the whole table to one task, and one
partitioned by a hot key sends that key's rows to one task.  The functions here
sort by range instead, number the rows from the stored sort, and hand out
fixed-size chunks of consecutive rows, so every later window works on one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.session import materialize

POS = "_pos"
CHUNK = "_chunk"
OWN = "_own"
_KEY = "_key"
FRAME_CHUNK = 8_192
PREFIX_CHUNK = 65_536


def _stored_order(df: DataFrame) -> DataFrame:
    """``df`` in the order it has, stored with (part, offset) of each row.

    ``monotonically_increasing_id`` holds the partition number in its upper bits
    and the row number inside the partition in its lower 33.
    """
    tagged = materialize(df.withColumn("_id", F.monotonically_increasing_id()))
    return tagged.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_offset", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_id")


def _with_base(stored: DataFrame, weight: Column) -> DataFrame:
    """Add ``_base``: the sum of ``weight`` over all earlier sort partitions.

    The table of bases has one row per sort partition, at most
    ``spark.sql.shuffle.partitions`` rows whatever the data size; that bound is
    what makes its window and its broadcast safe.
    """
    sizes = stored.groupBy("_part").agg(F.sum(weight).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return stored.join(F.broadcast(bases), "_part")


def with_positions(df: DataFrame, order: Sequence[Column], pos: str = POS) -> DataFrame:
    """Add the 0-based position of each row in a total order.

    ``order`` must end in a unique tie-breaker, else equal rows may swap.
    """
    return sorted_positions(df.orderBy(*order), pos)


def sorted_positions(df: DataFrame, pos: str = POS) -> DataFrame:
    """Add the 0-based position of each row of a sorted table, in the order the sort gave it.

    Unlike ``monotonically_increasing_id`` it does not depend on where the sort
    cut its partitions, so positions from two sorts can be compared.
    """
    based = _with_base(_stored_order(df), F.lit(1))
    return based.withColumn(pos, F.col("_base") + F.col("_offset")).drop("_part", "_offset", "_base")


def with_running_total(df: DataFrame, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows *before* each row in a total order."""
    based = _with_base(_stored_order(df.orderBy(*order)), F.col(value))
    inside = Window.partitionBy("_part").orderBy("_offset").rowsBetween(Window.unboundedPreceding, -1)
    return based.withColumn(
        out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    ).drop("_part", "_offset", "_base")


def framed(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    back: int = 0,
    ahead: int = 0,
    chunk_rows: int = FRAME_CHUNK,
) -> tuple[DataFrame, Window, DataFrame]:
    """Rows cut into chunks that also hold the neighbours a frame needs.

    Returns the rows, the window to use on them, and the stored positions.

    Each row sits in the chunk of its position, and rows near a border are
    copied to the next chunk, so a frame of ``back`` rows before and ``ahead``
    rows after never leaves its chunk.  Keep only rows where ``_own`` is true
    after the window.  The repartition is explicit: without it Spark would reuse
    a partitioning on ``partition`` alone and a hot key would be one task again.
    """
    size = max(chunk_rows, back + 1, ahead + 1)
    rows = with_positions(df, [F.col(c) for c in partition] + list(order))
    home = F.floor(F.col(POS) / size).cast("long")
    inside = F.pmod(F.col(POS), F.lit(size))
    homes = F.array(
        home,
        F.when(inside >= size - back, home + 1),
        F.when(inside < ahead, home - 1),
    )
    spread = rows.withColumn(CHUNK, F.explode(F.filter(homes, lambda c: c.isNotNull()))).withColumn(
        OWN, F.col(CHUNK) == home
    )
    spread = spread.repartition(*partition, CHUNK)
    return spread, Window.partitionBy(*partition, CHUNK).orderBy(POS), rows


def prefixed(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    specs: dict[str, tuple[str, Column, str]],
    chunk_rows: int = PREFIX_CHUNK,
) -> DataFrame:
    """Running minimum or maximum over an ordered table, chunk by chunk.

    ``specs`` maps an output name to (``min`` or ``max``, value, reach) with
    reach one of ``before`` (rows strictly before), ``upto`` (with this row) or
    ``from`` (this row and later ones).  Each chunk is reduced to one row, the
    reduced rows are carried along each partition, and the carry is combined
    with the window inside the chunk.
    """
    rows = with_positions(df, [F.col(c) for c in partition] + list(order))
    # As one struct the partition columns compare NULL with NULL as equal, so the
    # join and the windows below share a single shuffle of the rows.
    rows = rows.withColumns(
        {_KEY: F.struct(F.lit(0), *partition), CHUNK: F.floor(F.col(POS) / chunk_rows).cast("long")}
    )
    for name, (_, value, _) in specs.items():
        rows = rows.withColumn(f"_in_{name}", value)
    fold = {"min": F.min, "max": F.max}
    # Rows are stored in order, so each task folds its chunks before the shuffle.
    reduced = rows.groupBy(_KEY, CHUNK).agg(
        *[fold[kind](f"_in_{name}").alias(f"_red_{name}") for name, (kind, _, _) in specs.items()]
    )
    # A frame that reaches forward without bound is recomputed for every row, so
    # "this row and later" runs backwards over the reversed order instead.
    start = Window.unboundedPreceding
    along = Window.partitionBy(_KEY)
    earlier = along.orderBy(CHUNK).rowsBetween(start, -1)
    later = along.orderBy(F.desc(CHUNK)).rowsBetween(start, -1)
    carried = reduced.select(
        _KEY,
        CHUNK,
        *[
            fold[kind](f"_red_{name}").over(later if reach == "from" else earlier).alias(f"_carry_{name}")
            for name, (kind, _, reach) in specs.items()
        ],
    )
    joined = rows.repartition(_KEY, CHUNK).join(carried, [_KEY, CHUNK], "left")
    inside = Window.partitionBy(_KEY, CHUNK)
    frames = {
        "before": inside.orderBy(POS).rowsBetween(start, -1),
        "upto": inside.orderBy(POS).rowsBetween(start, 0),
        "from": inside.orderBy(F.desc(POS)).rowsBetween(start, 0),
    }
    pick = {"min": F.least, "max": F.greatest}
    for name, (kind, _, reach) in specs.items():
        own = fold[kind](f"_in_{name}").over(frames[reach])
        joined = joined.withColumn(name, pick[kind](own, F.col(f"_carry_{name}")))
    extra = [c for c in joined.columns if c.startswith(("_in_", "_carry_"))]
    return joined.drop(*extra, _KEY, CHUNK, POS)
