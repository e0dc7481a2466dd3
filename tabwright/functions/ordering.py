"""Order statistics without a single-task sort.

A window without a partition key, and ``percentile`` over many distinct values,
both end in one task. Here rows are first cut into ordered buckets by mergeable
quantile sketches; running totals are taken inside the buckets and shifted by
the totals of the buckets before. A value frequent enough to be a sketch edge
gets a bucket of its own, so that a hot value never shares its bucket, and a
unique ``tie`` column cuts such a bucket further.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..session import cut_lineage
from .columns import null_safe_join

# 2**8 - 1 sketch edges make up to 511 ordered buckets.
EDGE_BITS = 8
SKETCH_ACCURACY = 10_000
# Up to this many rows the built-in exact percentile (one hash map of distinct
# values in memory) is the cheaper plan; beyond it the bucketed one is used.
IN_MEMORY_ROWS = 2_000_000
# Up to this many quantiles are bracketed one by one.
MAX_BRACKETS = 25
# Up to this many rows a bucket one level of edges is enough.
BUCKET_ROWS = 200_000
# Rows per chunk of a row-window.
CHUNK_ROWS = 200_000


def _edges(value: str) -> Column:
    cuts = [i / 2**EDGE_BITS for i in range(1, 2**EDGE_BITS)]
    return F.percentile_approx(value, cuts, SKETCH_ACCURACY)


def _slot(edges: Column, value: Column) -> Column:
    """Ordered bucket number: odd when the value is itself an edge."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(EDGE_BITS))])
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at),
    )
    is_edge = F.transform(F.array(below), lambda at: at * 2 + F.coalesce((F.get(edges, at) == value).cast("int"), F.lit(0)))
    return F.get(is_edge, F.lit(0))


def with_bucket(df: DataFrame, value: str, edge_keys: Sequence[str] = (), tie: str | None = None, levels: int | None = None) -> DataFrame:
    """Add ``__bucket``: an integer that orders rows coarsely by ``value`` (then ``tie``); rows without a value come first, in buckets of their own.

    One level of edges makes up to 511 buckets. With two, every bucket has edges of its own, found in one more pass, and there are up
    to 261,121; a value with a bucket of its own is cut by ``tie`` there. ``levels`` of None takes
    two where 511 buckets would hold over ``BUCKET_ROWS`` rows each, counted by the pass that finds the edges.
    ``edge_keys`` must have few distinct values (feature names, sources): the
    table of edges is broadcast and holds one array (with two levels 512) for each of them.
    """
    out, levels = _cut(df, value, edge_keys, tie, levels)
    return out


def _cut(df: DataFrame, value: str, edge_keys: Sequence[str], tie: str | None, levels: int | None) -> tuple[DataFrame, int]:
    found = cut_lineage(df.groupBy(*edge_keys).agg(_edges(value).alias("__edges"), F.count(F.lit(1)).alias("__rows")))
    if levels is None:
        many = 2 ** (EDGE_BITS + 1) - 1
        levels = 2 if (found.agg(F.max("__rows")).first()[0] or 0) > many * BUCKET_ROWS else 1
    edges = found.drop("__rows")
    out = null_safe_join(df, F.broadcast(edges), edge_keys) if edge_keys else df.withColumn("__edges", edges.scalar())
    slot = F.when(F.col(value).isNull(), -1).otherwise(_slot(F.col("__edges"), F.col(value)))
    if levels == 1 and tie is None:
        return out.withColumn("__bucket", slot.cast("long")).drop("__edges"), 1
    out = out.withColumn("__slot", slot).drop("__edges")
    alone = (F.col("__slot") % 2 == 1) | F.col(value).isNull()
    if levels == 1:
        out = out.withColumn("__ties", df.agg(_edges(tie)).scalar())
        inner = F.when(alone, _slot(F.col("__ties"), F.col(tie))).otherwise(0)
        return out.withColumn("__bucket", (F.col("__slot") * 1024 + inner).cast("long")).drop("__slot", "__ties"), 1
    place = [*edge_keys, "__slot"]
    finer = out.groupBy(*place).agg(_edges(value).alias("__finer"), *([_edges(tie).alias("__ties")] if tie else []))
    out = null_safe_join(out, F.broadcast(cut_lineage(finer)), place)
    inner = F.when(alone, _slot(F.col("__ties"), F.col(tie)) if tie else F.lit(0)).otherwise(_slot(F.col("__finer"), F.col(value)))
    return out.withColumn("__bucket", (F.col("__slot") * 1024 + inner).cast("long")).drop("__slot", "__finer", "__ties"), 2


def running(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    keys: Sequence[str] = (),
    edge_keys: Sequence[str] = (),
    tie: str | None = None,
    levels: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``value`` order inside each key group.

    Rows tied on ``value`` are told apart by ``tie``; without it the values must
    be distinct inside a group. ``<name>__all`` holds the group total.
    """
    cut, levels = _cut(df, value, edge_keys, tie, levels)
    cut = cut.withColumns({f"__m_{n}": c.cast("double") for n, c in sums.items()})
    totals = cut.groupBy(*keys, "__bucket").agg(*[F.sum(f"__m_{n}").alias(f"__t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0.0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(whole).alias(f"{n}__all") for n in sums],
    )
    if levels == 1 and set(keys) <= set(edge_keys):
        offsets = F.broadcast(offsets)
    joined = null_safe_join(cut, offsets, [*keys, "__bucket"])
    order = [F.col(value)] + ([F.col(tie)] if tie else [])
    upto = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumns({n: F.col(f"__o_{n}") + F.sum(f"__m_{n}").over(upto) for n in sums}).drop(
        *[f"__m_{n}" for n in sums], *[f"__o_{n}" for n in sums], "__bucket"
    )


def row_index(df: DataFrame, order: str, tie: str | None, keys: Sequence[str] = (), name: str = "__rn", levels: int | None = None) -> DataFrame:
    """1-based position in ``order`` (ties by the unique ``tie``), and ``<name>__all`` rows per group."""
    out = running(df, order, {name: F.lit(1)}, keys, tie=tie, levels=levels)
    return out.withColumns({name: F.col(name).cast("long"), f"{name}__all": F.col(f"{name}__all").cast("long")})


def value_counts(df: DataFrame, value: str, keys: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Distinct values with ``__n`` rows each: the map-side combine before any ordering."""
    n = F.sum(weight) if weight is not None else F.count(F.lit(1))
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.cast("double").alias("__n"))


def cumulative_counts(df: DataFrame, value: str, keys: Sequence[str] = (), edge_keys: Sequence[str] = (), levels: int | None = None) -> DataFrame:
    """``(keys..., value, __n, __cum, __cum__all)``: counts up to and including each value."""
    counted = cut_lineage(value_counts(df, value, keys))  # read by the edges, the buckets and their totals
    return running(counted, value, {"__cum": F.col("__n")}, keys, edge_keys, levels=levels)


def average_rank(df: DataFrame, value: str, keys: Sequence[str] = (), edge_keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., value, __n, __rank, __cum__all)`` with the mean rank of tied values."""
    cum = cumulative_counts(df, value, keys, edge_keys)
    return cum.withColumn("__rank", F.col("__cum") - (F.col("__n") - 1) / 2).drop("__cum")


def number_array(values: Sequence[float]) -> Column:
    """A long constant array from one text literal, which folds to a single constant."""
    return F.split(F.lit(",".join("Infinity" if v == math.inf else repr(float(v)) for v in values)), ",").cast("array<double>")


def _targets(qs: Column, n: Column) -> Column:
    """0-based lower and upper positions of each linear-interpolated quantile."""

    def both(q: Column, i: Column) -> Column:
        pos = q * (n - 1)
        low = F.struct((2 * i).alias("slot"), F.floor(pos).cast("double").alias("at"))
        high = F.struct((2 * i + 1).alias("slot"), F.ceil(pos).cast("double").alias("at"))
        return F.array(low, high)

    return F.flatten(F.transform(qs, both))


def quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    keys: Sequence[str] = (),
    edge_keys: Sequence[str] = (),
    method: str = "auto",
) -> DataFrame:
    """Exact linear-interpolated quantiles as ``(keys..., q array<double>)``.

    ``memory``: the built-in aggregate, for inputs whose counted rows fit one
    buffer. ``brackets``: a mergeable sketch brackets every wanted position; one
    pass counts rows between the brackets and keeps values only inside them.
    ``buckets``: for many quantiles, ordered buckets of which only those holding
    a wanted position are sorted.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    if method == "auto":
        if len(qs) > MAX_BRACKETS:
            method = "buckets"
        else:
            # The built-in aggregate walks all its values once per wanted quantile.
            method = "memory" if data.count() <= IN_MEMORY_ROWS else "brackets"
    if method == "memory":
        exact = F.percentile("__v", number_array(qs))
        return data.groupBy(*keys).agg(exact.alias("q")) if keys else data.agg(exact.alias("q"))
    if method == "brackets":
        return _bracketed(data, qs, keys, edge_keys)
    return _bucketed(data, qs, keys, edge_keys)


def _bracketed(data: DataFrame, qs: Sequence[float], keys: Sequence[str], edge_keys: Sequence[str]) -> DataFrame:
    order = sorted(set(float(q) for q in qs))
    slack = 3.0 / SKETCH_ACCURACY
    ends = [min(max(q + d, 0.0), 1.0) for q in order for d in (-slack, slack)]
    marks = data.groupBy(*keys).agg(F.percentile_approx("__v", ends, SKETCH_ACCURACY).alias("__e"), F.count(F.lit(1)).cast("double").alias("__all"))
    # The ends of the data belong to the outer brackets whatever the sketch says.
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    edge = [low if q <= 0.0 else high if q >= 1.0 else F.get("__e", F.lit(i)) for i, q in enumerate(ends)]
    # In a small group the slack is less than one position: keep all its values.
    small = F.col("__all") < 20 * SKETCH_ACCURACY
    edge = [F.when(small, low if i % 2 == 0 else high).otherwise(e) for i, e in enumerate(edge)]
    marks = marks.select(*keys, "__all", *[e.alias(f"__e{i}") for i, e in enumerate(edge)])
    if not keys or set(keys) <= set(edge_keys):
        marks = F.broadcast(marks)
    one = F.lit(1)
    joined = null_safe_join(data, marks, keys) if keys else data.withColumn("__k", one).join(marks.withColumn("__k", one), "__k").drop("__k")
    v = F.col("__v")
    inside = F.lit(False)
    for i in range(len(order)):
        inside = inside | ((v >= F.col(f"__e{2 * i}")) & (v <= F.col(f"__e{2 * i + 1}")))
    # Rows outside every bracket only count, one group per gap; a gap's smallest value places it in order.
    gap = sum(((v > F.col(f"__e{i}")).cast("int") for i in range(1, 2 * len(order))), (v > F.col("__e0")).cast("int"))
    slim = joined.select(*keys, "__all", gap.alias("__gap"), F.when(inside, v).alias("__in"), v)
    counts = slim.groupBy(*keys, "__gap", "__in").agg(F.count(one).cast("double").alias("__n"), F.min("__v").alias("__at"), F.max("__all").alias("__all"))
    # Gaps are few and in value order, so a group is ranked gap by gap, shifted by the totals of the gaps before.
    before = Window.partitionBy(*keys).orderBy("__gap").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(*keys, "__gap").agg(F.sum("__n").alias("__t"))
    shift = totals.select(*keys, "__gap", F.coalesce(F.sum("__t").over(before), F.lit(0.0)).alias("__off"))
    upto = Window.partitionBy(*keys, "__gap").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(counts, shift, [*keys, "__gap"]).withColumn("__cum", F.col("__off") + F.sum("__n").over(upto)).filter(F.col("__in").isNotNull())
    share = number_array(order)
    hits = F.filter(_targets(share, F.col("__all")), lambda t: (t["at"] >= F.col("__cum") - F.col("__n")) & (t["at"] < F.col("__cum")))
    found = ranked.select(*keys, F.col("__in").alias("__v"), "__all", F.explode(hits).alias("__t"))
    return _interpolated(found, order, qs, keys)


def _interpolated(found: DataFrame, order: Sequence[float], qs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles in the order of ``qs`` from values found at lower and upper positions of ``order``."""
    last = found.groupBy(*keys).agg(F.max("__all").alias("__all"), F.map_from_entries(F.collect_list(F.struct("__t.slot", "__v"))).alias("__m"))

    def at(q: Column, i: Column) -> Column:
        pos = q * (F.col("__all") - 1)
        low, high = F.element_at("__m", 2 * i), F.element_at("__m", 2 * i + 1)
        return low + (high - low) * (pos - F.floor(pos))

    out = last.select(*keys, F.transform(number_array(order), at).alias("q"))
    if list(order) == [float(q) for q in qs]:
        return out
    return out.select(*keys, F.array(*[F.get("q", F.lit(list(order).index(float(q)))) for q in qs]).alias("q"))


def _bucketed(data: DataFrame, qs: Sequence[float], keys: Sequence[str], edge_keys: Sequence[str]) -> DataFrame:
    share = number_array(qs)
    cut = with_bucket(data, "__v", edge_keys)
    counts = cut.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).cast("double").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        *keys,
        "__bucket",
        F.coalesce(F.sum("__n").over(before), F.lit(0.0)).alias("__off"),
        "__n",
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__all"),
    )
    wanted = placed.withColumn(
        "__hits",
        F.filter(_targets(share, F.col("__all")), lambda t: (t["at"] >= F.col("__off")) & (t["at"] < F.col("__off") + F.col("__n"))),
    ).filter(F.size("__hits") > 0).select(*keys, "__bucket", "__off", "__all", "__hits")
    if set(keys) <= set(edge_keys):
        wanted = F.broadcast(wanted)
    sure = null_safe_join(cut, wanted.select(*keys, "__bucket"), [*keys, "__bucket"])
    dist = sure.groupBy(*keys, "__bucket", "__v").agg(F.count(F.lit(1)).cast("double").alias("__n"))
    upto = Window.partitionBy(*keys, "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(dist.withColumn("__cum", F.sum("__n").over(upto)), wanted, [*keys, "__bucket"])
    found = ranked.select(
        *keys,
        "__v",
        "__all",
        F.explode(
            F.filter(
                "__hits",
                lambda t: (t["at"] >= F.col("__off") + F.col("__cum") - F.col("__n")) & (t["at"] < F.col("__off") + F.col("__cum")),
            )
        ).alias("__t"),
    )
    return _interpolated(found, [float(q) for q in qs], qs, keys)


def row_window(
    df: DataFrame,
    order: str,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    back: int = 0,
    ahead: int = 0,
    keys: Sequence[str] = (),
    tie: str | None = None,
) -> DataFrame:
    """Columns over a window of at most ``back`` rows before and ``ahead`` rows after.

    Rows are numbered, cut into chunks, and each chunk also receives the border
    rows it needs, so a long (or hot) group is spread over many tasks. ``build``
    gets the ordered, unframed window.
    """
    size = max(CHUNK_ROWS, back, ahead)
    numbered = row_index(df, order, tie, keys)
    at = F.col("__rn") - 1
    chunk = F.floor(at / size)
    inside = at - chunk * size
    homes = [F.struct(chunk.alias("c"), F.lit(False).alias("halo"))]
    if back:
        homes.append(F.when(inside >= size - back, F.struct((chunk + 1).alias("c"), F.lit(True).alias("halo"))))
    if ahead:
        homes.append(F.when(inside < ahead, F.struct((chunk - 1).alias("c"), F.lit(True).alias("halo"))))
    spread = numbered.withColumn("__home", F.explode(F.array_compact(F.array(*homes))))
    w = Window.partitionBy(*keys, F.col("__home.c")).orderBy("__rn")
    return spread.withColumns(dict(build(w))).filter(~F.col("__home.halo")).drop("__home", "__rn__all")


def carry(
    df: DataFrame,
    value: str,
    order: str,
    out: str,
    keys: Sequence[str] = (),
    tie: str | None = None,
    forward: bool = True,
    levels: int | None = None,
) -> DataFrame:
    """Nearest non-null value at or before (``forward``) or at or after each row."""
    cut = with_bucket(df, order, tie=tie, levels=levels)
    cols = [F.col(order)] + ([F.col(tie)] if tie else [])
    if not forward:
        cols = [c.desc() for c in cols]
    step = F.col("__bucket") if forward else F.col("__bucket").desc()
    local = Window.partitionBy(*keys, "__bucket").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    near = cut.withColumn("__near", F.last(value, ignorenulls=True).over(local))
    place = F.struct(*[F.col(c) for c in ([order, tie] if tie else [order])])
    pick = F.max_by if forward else F.min_by
    ends = cut.groupBy(*keys, "__bucket").agg(pick(value, F.when(F.col(value).isNotNull(), place)).alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "__bucket", F.last("__end", ignorenulls=True).over(earlier).alias("__far"))
    return (
        null_safe_join(near, ends, [*keys, "__bucket"])
        .withColumn(out, F.coalesce("__near", "__far"))
        .drop("__near", "__far", "__bucket")
    )


def dense_index(levels: DataFrame, column: str, name: str = "__ix") -> DataFrame:
    """0-based position of each distinct value in sorted order, for any orderable type.

    The values are range-partitioned and sorted once into a checkpoint, whose
    partitions then stay put, so a position is the partition offset plus the
    place inside the partition.
    """
    placed = cut_lineage(levels.select(column).repartitionByRange(column).sortWithinPartitions(column))
    marked = placed.select(column, F.monotonically_increasing_id().alias("__id"))
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    marked = marked.withColumn("__part", part)
    sizes = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return marked.join(F.broadcast(offsets), "__part").select(column, (F.col("__off") + place).alias(name))
