"""Joins: aggregate-and-join-back, radius, distance, nearest, calendar.

Distance conditions become equi-joins on grid cells; keys that would pair too
many rows in one task are split first.  Ordinary equi-joins carry no broadcast
hint: the side's size decides, at plan time from file sizes or at run time under
adaptive execution, which also splits a skewed partition of the larger side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecast.operators.ordering import with_positions
from sitecast.session import materialize

DEGREE_KM = 111.0
PAIRS_PER_TASK = 5_000_000
ROWS_PER_TASK = 500_000
MOST_TASKS = 20_000


def group_mean_join_back(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Mean of ``col`` per group on each row; a NULL key has no group and gets NULL.

    A window over the keys would sort every row of a hot group in one task.  The
    grouped mean is combined before its shuffle, and the join back splits a hot
    group under adaptive execution.
    """
    means = df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.avg(col).alias(out))
    return df.join(means, list(keys), "left").select(*df.columns, out)


def join_location_sources(
    poi: DataFrame, dist: DataFrame, census: DataFrame, comp: DataFrame, key: str = "location_id"
) -> DataFrame:
    """Left joins on the location; a source without the key is skipped; NULL numbers become 0.

    A location that comes several times in the sources gives every combination.
    """
    sources = [s for s in (dist, census, comp) if key in s.columns]
    return spread_left_joins(poi, sources, key).na.fill(0)


def spread_left_joins(left: DataFrame, rights: Sequence[DataFrame], key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left joins of all ``rights`` on ``key``, in tasks of about ``rows_per_task`` rows of output.

    A key that repeats in several tables gives the product of its repeats, so a
    few bytes of input can be most of the output, which neither file sizes nor
    byte-based skew handling show.  The output of each key is known from the
    counts.  A small output is joined plainly.  Else the left rows of a key are
    dealt to as many parts as its output needs, each part meets all right rows of
    the key, and the parts are spread over tasks in proportion to the output, up
    to ``MOST_TASKS``.  The output of one left row stays in one task.  The left
    side is read for the counts and then stored.
    """
    rights = list(rights)
    plain = reduce(lambda a, b: a.join(b, key, "left"), rights, left)
    if len({dict(s.dtypes)[key] for s in (left, *rights)}) > 1:
        return plain
    counted = left.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("_out"))
    for s in rights:
        matches = s.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("_n"))
        counted = counted.join(matches, key, "left").select(key, (F.col("_out") * F.coalesce("_n", F.lit(1.0))).alias("_out"))
    total = counted.agg(F.sum("_out")).first()[0] or 0.0
    if total <= rows_per_task:
        return plain
    tasks = min(math.ceil(total / rows_per_task), MOST_TASKS)
    share = max(total / tasks, rows_per_task)
    hot = materialize(counted.filter((F.col("_out") > share) & F.col(key).isNotNull()).select(key, F.ceil(F.col("_out") / share).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    # Left rows without a key meet nothing and can lie anywhere.
    own = F.when(F.col(key).isNull(), F.lit(tasks).cast("long")).otherwise(parts)
    stored = materialize(left.withColumn("_row", F.monotonically_increasing_id()))
    out = (
        stored.join(hot, key, "left")
        .withColumn("_cell", F.struct(F.col(key).alias("key"), F.pmod(F.xxhash64("_row"), own).alias("part")))
        .select("_cell", *left.columns)
        .repartition(tasks, "_cell")
    )
    for s in rights:
        dealt = (
            s.filter(F.col(key).isNotNull())
            .join(hot, key, "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            .withColumn("_cell", F.struct(F.col(key).alias("key"), F.col("_part").alias("part")))
            .select("_cell", *[c for c in s.columns if c != key])
        )
        out = out.join(dealt, "_cell", "left")
    return out.select(*plain.columns)


def spread_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in so many partitions that a task holds about ``rows_per_task`` rows; a small one stays as it is.

    For steps that make much more of a row than its stored bytes, which decide
    the partitions of a scan.
    """
    tasks = min(math.ceil(df.count() / rows_per_task), MOST_TASKS)
    return df if tasks <= 1 else df.repartition(tasks)


def split_hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Inner join on ``keys`` in which no key pairs more than about ``pairs_per_task`` rows per task.

    Byte-based skew handling misses a key whose rows are few but whose pairs are
    many.  Here the pairs of a key are known from two counts.  A key above the
    limit has its left rows dealt to ``a`` parts and its right rows to ``b``
    parts, and every part of one side meets every part of the other, so each
    pair is still met exactly once and each task holds about the square root of
    the limit in rows of either side.  Both sides are read again for the counts,
    so give stored tables or cheap steps over them.
    """
    keys = list(keys)
    side = math.sqrt(pairs_per_task)
    loads = (
        left.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_l"))
        .join(right.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_r")), keys)
        .filter(F.col("_l") * F.col("_r") > pairs_per_task)
        .withColumn("_nb", F.ceil(F.col("_r") / side))
        .select(*keys, F.ceil(F.col("_l") * F.col("_r") / F.col("_nb") / pairs_per_task).alias("_na"), "_nb")
    )
    if loads.isEmpty():
        return left.join(right, keys)
    loads = materialize(loads)
    na, nb = F.coalesce("_na", F.lit(1)), F.coalesce("_nb", F.lit(1))

    def dealt(rows: DataFrame, mine: str, parts: Column, other: str, copies: Column) -> DataFrame:
        return (
            rows.join(loads, keys, "left")
            .withColumn(mine, F.pmod(F.xxhash64(*rows.columns), parts))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
            .drop("_na", "_nb")
        )

    met = dealt(left, "_a", na, "_b_part", nb).join(dealt(right, "_b_part", nb, "_a", na), [*keys, "_a", "_b_part"])
    return met.drop("_a", "_b_part")


def _points(lat: str, lon: str, prefix: str) -> tuple[Column, Column]:
    return F.col(lat).alias(f"{prefix}y"), F.col(lon).alias(f"{prefix}x")


def poi_counts_long(
    sites: DataFrame,
    pois: DataFrame,
    radius_km: float = 1.0,
    lat: str = "latitude",
    lon: str = "longitude",
    amenity: str = "amenity",
    units_per_degree: float = 1.0,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Rows ``(lat, lon, amenity, n)``: points of each kind around each distinct site position.

    Copies are merged on both sides first, and the merged sides stored: sites to
    distinct positions, points to one row per (position, kind) with a count.  The grid cell is one radius
    wide, so a site meets only its own cell and the eight around it.  The
    circle is closed: a point exactly at the radius counts.
    """
    r = radius_km / DEGREE_KM * units_per_degree
    spots = pois.filter(F.col(amenity).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
    spots = (
        materialize(
            spots.groupBy(F.col(amenity).alias("amenity"), *_points(lat, lon, "p")).agg(F.count(F.lit(1)).alias("copies"))
        )
        .withColumns({"cy": F.floor(F.col("py") / r), "cx": F.floor(F.col("px") / r)})
    )
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    places = (
        materialize(sites.select(*_points(lat, lon, "s")).na.drop().distinct())
        .withColumn("dy", F.explode(around))
        .withColumn("dx", F.explode(around))
        .withColumns({"cy": F.floor(F.col("sy") / r) + F.col("dy"), "cx": F.floor(F.col("sx") / r) + F.col("dx")})
        .drop("dy", "dx")
    )
    met = split_hot_join(spots, places, ["cy", "cx"], pairs_per_task)
    north, east = F.col("py") - F.col("sy"), F.col("px") - F.col("sx")
    return (
        met.filter(north * north + east * east <= r * r)
        .groupBy(F.col("sy").alias(lat), F.col("sx").alias(lon), "amenity")
        .agg(F.sum("copies").alias("n"))
    )


def count_pois_within(
    sites: DataFrame,
    pois: DataFrame,
    radius_km: float = 1.0,
    amenities: Sequence[str] | None = None,
    lat: str = "latitude",
    lon: str = "longitude",
    amenity: str = "amenity",
    units_per_degree: float = 1.0,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Columns ``poi_{amenity}_count`` on each site; no point within reach is 0.

    One degree is taken as 111 km in both directions.  A column per kind needs the
    list of ``amenities``; without it each site gets one map column ``poi_counts``
    from kind to count, however many kinds there are.
    """
    long = poi_counts_long(sites, pois, radius_km, lat, lon, amenity, units_per_degree, pairs_per_task)
    if amenities is None:
        # One entry for each kind around one position.
        maps = long.groupBy(lat, lon).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("amenity", "n")))).alias("poi_counts"))
        out = sites.join(maps, [lat, lon], "left")
        empty = F.create_map().cast("map<string,bigint>")
        return out.select(*sites.columns, F.coalesce("poi_counts", empty).alias("poi_counts"))
    wide = long.groupBy(lat, lon).agg(
        *[F.sum(F.when(F.col("amenity") == a, F.col("n"))).alias(f"poi_{a}_count") for a in amenities]
    )
    names = [f"poi_{a}_count" for a in amenities]
    return sites.join(wide, [lat, lon], "left").select(*sites.columns, *names).na.fill(0, subset=names)


def one_row_per_node(df: DataFrame, node: str, value: str) -> DataFrame:
    """``(node, value)`` with an error at run time when a node comes twice."""
    return df.groupBy(node).agg(F.min(value).alias(value), F.count(F.lit(1)).alias("_rows")).select(
        node,
        F.when(F.col("_rows") > 1, F.raise_error(F.concat(F.lit("node given twice: "), F.col(node).cast("string"))).cast("double"))
        .otherwise(F.col(value).cast("double"))
        .alias(value),
    )


def distance_edges(
    df: DataFrame,
    node: str,
    dist: str,
    threshold: float,
    weighted: bool = True,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Edges ``(src, dst, weight)`` between different nodes at most ``threshold`` apart.

    Nodes fall into buckets one threshold wide; a node meets its own bucket and
    the two beside it, and a crowded bucket is split.  A complete graph is not
    written out: ``graph.complete_propagate`` gives its aggregation without edges.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    nodes = materialize(one_row_per_node(df, node, dist).filter(F.col(dist).isNotNull()))
    bucket = F.floor(F.col(dist) / threshold)
    left = nodes.select(F.col(node).alias("src"), F.col(dist).alias("_da"), bucket.alias("_b"))
    right = nodes.select(
        F.col(node).alias("dst"),
        F.col(dist).alias("_db"),
        F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_b"),
    )
    return (
        split_hot_join(left, right, ["_b"], pairs_per_task)
        .filter((_gap() <= threshold) & (F.col("src") != F.col("dst")))
        .select("src", "dst", _distance_weight(weighted).alias("weight"))
    )


def _gap() -> Column:
    return F.abs(F.col("_da") - F.col("_db"))


def _distance_weight(weighted: bool) -> Column:
    return F.lit(1.0) / (_gap() + 1e-6) if weighted else F.lit(1.0)


def nearest(
    base: DataFrame, query: dict[str, float], k: int = 5, base_key: str = "base_id"
) -> DataFrame:
    """The ``k`` base rows nearest to one query: ``(base_key, distance, rank)``, ties by key.

    ``query`` maps each feature to its value.  A base row that lacks a feature has
    no distance and is left out; a query that lacks one is refused.
    """
    missing = [f for f, v in query.items() if v is None or math.isnan(v)]
    if not query or missing:
        raise ValueError(f"the query lacks {missing or 'all features'}")
    gaps = [F.col(f).cast("double") - F.lit(float(v)) for f, v in query.items()]
    square = reduce(lambda a, b: a + b, [g * g for g in gaps])
    far = base.na.drop(subset=list(query)).select(base_key, F.sqrt(square).alias("distance"))
    near = far.filter(~F.isnan("distance")).orderBy("distance", base_key).limit(k)
    # At most k rows from here on.
    return near.withColumn("rank", F.row_number().over(Window.orderBy("distance", base_key)))


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return df.join(keys, on, "left_semi")


def dense_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based index of the value among the sorted distinct values; NULL has none."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    index = with_positions(values, [F.col(col)], out)
    return df.join(index, col, "left").select(*df.columns, out)


def join_calendar(
    df: DataFrame, weather: DataFrame, holidays: DataFrame, date_col: str = "date"
) -> DataFrame:
    """Weather and holiday columns by date; a day not listed is no holiday."""
    days = holidays.groupBy(F.col("date").alias(date_col)).agg(F.bool_or("is_holiday").alias("is_holiday"))
    out = df.join(weather.withColumnRenamed("date", date_col), date_col, "left").join(days, date_col, "left")
    return out.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))


def _widen(steps: Column):
    """For a partial cell: one cell per value of ``steps`` in the next dimension."""
    return lambda o: F.transform(steps, lambda s: F.concat(o, F.array(s)))


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    features: Sequence[str],
    k: int,
    query_key: str = "query_id",
    base_key: str = "base_id",
    per_cell: int = 32,
) -> DataFrame:
    """The ``k`` base rows nearest to every query row: ``(query_key, base_key, distance, rank)``.

    Exact, by Euclidean distance over ``features``, ties by ``base_key``.  Base
    rows are dealt into grid cells whose side is set so that a cell holds about
    ``per_cell`` rows on average.  Each query looks at the block of cells within
    ``r`` of its own, clipped to the base cells, starting with the least r that
    reaches a base cell and going on to 2r + 1: it is done once it has k rows no
    farther than the distance from the query to the block's nearest outer face
    (nothing outside can be nearer), or when the block covers every base cell.
    Queries not done widen their block in the next round; each round is stored.
    Cell keys that would pair too many rows in one task are split.

    A row lacking a feature (NULL or NaN) takes no part: such a base row is never
    a neighbour, such a query gets no rows.  With fewer than k base rows a query
    gets them all.  Equal query keys are one query each row; key columns must not
    share names with the features.
    """
    if k < 1 or not features:
        raise ValueError("need k >= 1 and at least one feature")
    names = list(features)
    good = lambda df: reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in names])
    b = base.where(good(base)).select(F.col(base_key).alias("_b"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(names)])
    q = queries.where(good(queries)).select(F.col(query_key).alias("_q"), *[F.col(f).cast("double").alias(f"_y{i}") for i, f in enumerate(names)])
    q = q.withColumn("_qi", F.monotonically_increasing_id())
    q = materialize(q)
    d = len(names)
    box = b.agg(F.count(F.lit(1)).alias("n"), *[F.min(f"_x{i}").alias(f"lo{i}") for i in range(d)], *[F.max(f"_x{i}").alias(f"hi{i}") for i in range(d)]).first()
    if box["n"] == 0:
        return queries.sparkSession.createDataFrame([], f"{query_key} {q.schema['_q'].dataType.simpleString()}, {base_key} {b.schema['_b'].dataType.simpleString()}, distance double, rank int")
    spans = [max(box[f"hi{i}"] - box[f"lo{i}"], 0.0) for i in range(d)]
    volume = math.prod(s for s in spans if s > 0) if any(s > 0 for s in spans) else 1.0
    dims = max(sum(1 for s in spans if s > 0), 1)
    # All base rows in one place: one cell of unit side.
    side = (volume * per_cell / box["n"]) ** (1.0 / dims) if max(spans) > 0 else 1.0
    side = max(side, max(spans) / 1e6)
    cell = lambda c, i: F.floor((F.col(c) - F.lit(box[f"lo{i}"])) / F.lit(side)).cast("long")
    far = [int(math.floor(spans[i] / side)) for i in range(d)]
    bc = materialize(b.select("_b", *[f"_x{i}" for i in range(d)], F.array(*[cell(f"_x{i}", i) for i in range(d)]).alias("_cell")))
    pending = q.select("*", F.array(*[cell(f"_y{i}", i) for i in range(d)]).alias("_home"))
    # A query starts at the ring that reaches the nearest base cell, and its block is clipped to the base cells.
    reach = [F.greatest(-F.col("_home")[i], F.col("_home")[i] - F.lit(far[i]), F.lit(0)) for i in range(d)]
    pending = pending.withColumn("_r", F.greatest(*reach, F.lit(0)) if d > 1 else F.greatest(reach[0], F.lit(0)))
    found = []
    while True:
        cells = F.array(F.array().cast("array<long>"))
        for i in range(d):
            cells = F.flatten(F.transform(cells, _widen(F.sequence(F.greatest(F.col("_home")[i] - F.col("_r"), F.lit(0)), F.least(F.col("_home")[i] + F.col("_r"), F.lit(far[i]))))))
        ask = pending.select("_qi", F.explode(cells).alias("_cell"))
        pairs = split_hot_join(ask, bc, ["_cell"])
        dist = F.sqrt(reduce(lambda a, c: a + c, [(F.col(f"_x{i}") - F.col(f"_y{i}")) ** 2 for i in range(d)]))
        met = pairs.join(pending.select("_qi", *[f"_y{i}" for i in range(d)]), "_qi").select("_qi", "_b", dist.alias("distance"))
        top = met.withColumn("rank", F.row_number().over(Window.partitionBy("_qi").orderBy("distance", "_b"))).where(F.col("rank") <= k)
        # Distance from the query to the nearest outer face of its block, and whether the block covers all cells.
        faces = [
            F.least(
                F.col(f"_y{i}") - (F.lit(box[f"lo{i}"]) + (F.col("_home")[i] - F.col("_r")) * side),
                F.lit(box[f"lo{i}"]) + (F.col("_home")[i] + F.col("_r") + 1) * side - F.col(f"_y{i}"),
            )
            for i in range(d)
        ]
        covers = reduce(lambda a, c: a & c, [(F.col("_home")[i] - F.col("_r") <= 0) & (F.col("_home")[i] + F.col("_r") >= far[i]) for i in range(d)])
        state = pending.select("_qi", (F.least(*faces) if d > 1 else faces[0]).alias("_safe"), covers.alias("_all"))
        kth = top.groupBy("_qi").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_kth"))
        done = F.col("_all") | F.coalesce((F.col("_n") >= k) & (F.col("_kth") <= F.col("_safe")), F.lit(False))
        state = materialize(state.join(kth, "_qi", "left").select("_qi", done.alias("_done")))
        found.append(materialize(top.join(state.where("_done"), "_qi", "left_semi")))
        pending = materialize(pending.join(state.where(~F.col("_done")), "_qi", "left_semi").withColumn("_r", 2 * F.col("_r") + 1))
        if pending.isEmpty():
            break
    out = reduce(lambda a, c: a.unionByName(c), found)
    return out.join(q.select("_qi", "_q"), "_qi").select(
        F.col("_q").alias(query_key), F.col("_b").alias(base_key), "distance", F.col("rank").cast("int").alias("rank")
    )
