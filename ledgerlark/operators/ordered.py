"""Row numbers, running totals, ranks and quantiles over a whole frame.

``Window.orderBy`` without a partition moves every row to one task, and a window per
key does so for a hot key.  Here the sort order is cut into ranges by a few cut points
taken from a sample.  The window runs inside each range, and every range is shifted by
what the ranges before it hold.  The frame is shuffled once, by range.

Sort keys are SQL expressions in ascending order: ``["-Revenue", "Description"]`` is
largest revenue first, then by name.  They must end in one that is unique (within a
partition), so equal values can be cut apart and the order is total.

The frame is read a few times (count, sample, totals, rows): pass a table or a settled
frame, not one that is expensive to compute again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, IntegralType

from ledgerlark.operators.settle import settle

RANGE = "_range"
ROWS_PER_RANGE = 200_000
SAMPLE_PER_RANGE = 60
# The cut points travel in the plan.  Beyond 4e9 rows ranges grow instead; no row is lost.
MOST_RANGES = 20_000
_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_JSON_TIMES = {"timestampFormat": _STAMP, "timestampNTZFormat": _STAMP}

# Running aggregates: (aggregate, how the part before a range joins the part inside).
_RUNNING = {
    "sum": (F.sum, lambda before, inside: before + inside),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "product": (F.product, lambda before, inside: before * inside),
}


def spread_in_order(
    frame: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add the number of the range of the sort order that each row falls into.

    The cut points only split the work, they never decide a result.  The driver sees
    nothing but them: at most ``MOST_RANGES``, as one JSON text.
    """
    names = [*partition_by, *order_by]
    key = F.struct(*[F.expr(e).alias(f"k{i}") for i, e in enumerate(names)])
    keys = frame.select(key.alias("_key"))
    rows = keys.count()
    if ranges is None:
        ranges = min(rows // ROWS_PER_RANGE, MOST_RANGES)
    ranges = max(ranges, 2)
    fraction = min(1.0, ranges * SAMPLE_PER_RANGE / max(rows, 1))
    cut_points = keys.sample(fraction, seed=1).agg(
        F.sort_array(F.collect_list("_key")).alias("seen")
    ).select(
        F.to_json(
            F.expr(
                f"array_distinct(transform(sequence(1, {ranges - 1}), "
                f"i -> get(seen, int(floor(i * size(seen) / {ranges})))))"
            ),
            _JSON_TIMES,
        )
    )
    cuts = F.from_json(
        F.lit(cut_points.first()[0]), ArrayType(keys.schema["_key"].dataType), _JSON_TIMES
    )
    # How many cut points lie at or below the row's key, by halving steps.
    halves = [F.lit(1 << bit) for bit in reversed(range(ranges.bit_length()))]
    below = F.aggregate(
        F.array(*halves),
        F.lit(0),
        lambda at, step: at + F.when(F.get(cuts, at + step - 1) <= key, step).otherwise(F.lit(0)),
    )
    return frame.withColumn(RANGE, below)


def running_over(
    placed: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    running: Mapping[str, tuple[str, str]] | None = None,
    number: str = "row_no",
    exact: DataType | None = None,
    whole: Mapping[str, str] | None = None,
    sorted_rows: bool = False,
) -> DataFrame:
    """Add a 1-based row number and running aggregates to a frame spread in order.

    ``running`` maps an output name to ``(kind, column)``, kind being ``sum``, ``max``,
    ``min`` or ``product``.  Doubles are added as doubles; with a decimal type in ``exact``
    they are added as such, which does not depend on the order of tasks but cuts what the
    type cannot hold.  ``whole`` maps a name to a running sum whose total over the row's
    partition it shall be.  ``sorted_rows`` keeps the ranges in their order.
    """
    running = dict(running or {})
    kinds = {name: kind for name, (kind, _) in running.items()}
    types = {f.name: f.dataType for f in placed.schema.fields}
    inputs = {
        name: F.col(column).cast(exact)
        if exact is not None and kind == "sum" and isinstance(types[column], (DoubleType, FloatType))
        else F.col(column)
        for name, (kind, column) in running.items()
    }
    parts = list(partition_by)

    # What each range adds per partition.
    added = placed.groupBy(RANGE, *parts).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_RUNNING[kinds[n]][0](inputs[n]).alias(f"_add_{n}") for n in running],
    )
    # What lies before each range.  Only the first partition of a range can have begun
    # in an earlier one, so at most one row per range is left and goes to every task.
    # Without partitions there is one row per range, so one task orders all ranges: a
    # global window by intent, over MOST_RANGES rows at most.
    earlier = (
        Window.partitionBy(*(parts or [F.col(RANGE) < 0]))
        .orderBy(RANGE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = added.select(
        F.col(RANGE).alias("_r"),
        *[F.col(p).alias(f"_p{i}") for i, p in enumerate(parts)],
        F.sum("_rows").over(earlier).alias("_rows_before"),
        *[_RUNNING[kinds[n]][0](f"_add_{n}").over(earlier).alias(f"_before_{n}") for n in running],
    ).filter("_rows_before > 0")

    inside = Window.partitionBy(RANGE, *parts).orderBy(*[F.expr(e) for e in order_by])
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (placed.repartitionByRange(RANGE) if sorted_rows else placed).select(
        "*",
        F.row_number().over(inside).alias("_no"),
        *[_RUNNING[kinds[n]][0](inputs[n]).over(so_far).alias(f"_in_{n}") for n in running],
    )
    same = F.col(RANGE) == F.col("_r")
    for i, part in enumerate(parts):
        same = same & F.col(part).eqNullSafe(F.col(f"_p{i}"))
    shifted = numbered.join(F.broadcast(before), same, "left")
    outputs = [
        (F.coalesce(F.col("_rows_before"), F.lit(0)) + F.col("_no")).cast("bigint").alias(number)
    ]
    for name, (kind, column) in running.items():
        inner, outer = F.col(f"_in_{name}"), F.col(f"_before_{name}")
        value = F.coalesce(_RUNNING[kind][1](outer, inner), inner, outer)
        if kind == "sum" and isinstance(types[column], (DoubleType, FloatType)):
            value = value.cast("double")
        elif kind == "sum" and isinstance(types[column], IntegralType):
            value = value.cast("bigint")
        outputs.append(value.alias(name))
    if whole:
        # Joined by range and partition, so that a hot partition stays spread.
        everything = Window.partitionBy(*(parts or [F.col(RANGE) < 0]))
        totals = added.select(
            F.col(RANGE).alias("_tr"), *[F.col(p).alias(f"_tp{i}") for i, p in enumerate(parts)],
            *[F.sum(f"_add_{n}").over(everything).alias(f"_all_{name}") for name, n in whole.items()],
        )
        same = F.col(RANGE) == F.col("_tr")
        for i, part in enumerate(parts):
            same = same & F.col(part).eqNullSafe(F.col(f"_tp{i}"))
        shifted = shifted.join(totals, same)
        outputs += [F.col(f"_all_{name}").alias(name) for name in whole]
    kept = [c for c in placed.columns if c != RANGE]
    return shifted.select(*kept, *outputs)


def in_order(
    frame: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    running: Mapping[str, tuple[str, str]] | None = None,
    number: str = "row_no",
    ranges: int | None = None,
    exact: DataType | None = None,
) -> DataFrame:
    """:func:`spread_in_order` followed by :func:`running_over`."""
    placed = spread_in_order(frame, order_by, partition_by, ranges)
    return running_over(placed, order_by, partition_by, running, number, exact)


def in_global_order(
    frame: DataFrame, order_by: Sequence[str], number: str = "place", ranges: int | None = None
) -> DataFrame:
    """The rows in order, range-partitioned, each with its 1-based place.

    Partition after partition, and row after row, the result is sorted; written files are.
    """
    placed = spread_in_order(frame, order_by, ranges=ranges)
    return running_over(placed, order_by, number=number, sorted_rows=True)


def top_in_place(frame: DataFrame, order_by: Sequence[str], number: str = "place") -> DataFrame:
    """The rows of a short list (top n) in order, each with its 1-based place.

    The list becomes one row and back, so its size must be bounded by the caller.
    """
    key = F.struct(*[F.expr(e).alias(f"k{i}") for i, e in enumerate(order_by)])
    row = F.struct(*frame.columns)
    listed = frame.agg(F.sort_array(F.collect_list(F.struct(key.alias("key"), row.alias("row")))).alias("rows"))
    return listed.select(F.posexplode("rows").alias("_at", "_r")).select(
        "_r.row.*", (F.col("_at") + 1).cast("bigint").alias(number)
    )


def tied_ranks(
    frame: DataFrame,
    order_by: Sequence[str],
    then_by: Sequence[str],
    rank: str = "rank",
    ranges: int | None = None,
) -> DataFrame:
    """Add the rank of each row by ``order_by``; equal rows share the lowest rank.

    ``then_by`` makes the order total, so that rows of one rank can lie in many ranges.
    What a range takes over from those before it is their number of rows and the rank at
    which the value begins that goes on in it.  Nothing is joined on the ranked value.
    """
    placed = spread_in_order(frame, [*order_by, *then_by], ranges=ranges)
    tie = F.struct(*[F.expr(e).alias(f"k{i}") for i, e in enumerate(order_by)])
    copies = placed.groupBy(RANGE, tie.alias("_tie")).agg(F.count(F.lit(1)).alias("_n"))
    ends = copies.groupBy(RANGE).agg(
        F.sum("_n").alias("_rows"), F.min("_tie").alias("_first"), F.max(F.struct("_tie", "_n")).alias("_end")
    )
    # One row per range: a global window by intent.
    by_range = Window.partitionBy(F.col(RANGE) < 0).orderBy(RANGE)
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag("_end._tie").over(by_range).eqNullSafe(F.col("_first")), F.lit(False))
    carried = ends.select(
        "*", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), goes_on.alias("_goes_on")
    ).withColumn(
        "_begins",
        F.when(
            ~(F.col("_goes_on") & (F.col("_first") == F.col("_end._tie"))),
            F.col("_before") + F.col("_rows") - F.col("_end._n") + 1,
        ),
    ).select(
        F.col(RANGE).alias("_r"), "_before",
        F.when(F.col("_goes_on"), F.last("_begins", ignorenulls=True).over(earlier)).alias("_rank"),
    )
    inner = F.rank().over(Window.partitionBy(RANGE).orderBy(*[F.expr(e) for e in order_by]))
    ranked = placed.withColumn("_inner", inner).join(F.broadcast(carried), F.col(RANGE) == F.col("_r"))
    taken = F.when((F.col("_inner") == 1) & F.col("_rank").isNotNull(), F.col("_rank"))
    return ranked.select(
        *[c for c in placed.columns if c != RANGE],
        F.coalesce(taken, F.col("_before") + F.col("_inner")).cast("bigint").alias(rank),
    )


def runs_in_order(
    frame: DataFrame, order_by: Sequence[str], partition_by: Sequence[str], value: str, ranges: int | None = None
) -> DataFrame:
    """Adjacent equal values per partition: ``(*partition_by, value, first_position, length)``.

    Runs are found inside each range.  A range takes over the last value of the one before
    it, so a run over several ranges gets the name of the range it began in, and its parts
    are added up.  The rows are shuffled once, by range; after that only runs move.
    """
    placed = spread_in_order(frame, order_by, partition_by, ranges)
    parts = list(partition_by)
    turn = [f"_o{i}" for i in range(len(order_by))]
    inside = Window.partitionBy(RANGE, *parts)
    in_turn = inside.orderBy(*turn)
    upto = in_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.row_number().over(in_turn)
    begins = (number == 1) | ~F.lag(value).over(in_turn).eqNullSafe(F.col(value))
    runs = (
        placed.select(RANGE, *parts, value, *[F.expr(e).alias(c) for c, e in zip(turn, order_by, strict=True)])
        .select("*", number.alias("_no"), begins.cast("int").alias("_begins"))
        .withColumn("_run", F.sum("_begins").over(upto))
        .withColumn("_last_run", F.max("_run").over(inside))
        .groupBy(RANGE, *parts, value, "_run", "_last_run")
        .agg(F.min("_no").alias("_no"), F.count(F.lit(1)).alias("_n"))
    )
    # What each range holds of a partition; the rows' shuffle is used again for it.
    held = F.struct(F.col(value).alias("v"))
    ends = runs.groupBy(RANGE, *parts).agg(
        F.sum("_n").alias("_rows"), (F.max("_run") == 1).alias("_single"),
        F.min_by(held, "_run").alias("_first"), F.max_by(held, "_run").alias("_last"),
    )
    by_range = Window.partitionBy(*(parts or [F.col(RANGE) < 0])).orderBy(RANGE)
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    # Only the first partition of a range can have begun in an earlier one, so at most one
    # row per range is left and goes to every task.
    before = ends.select(
        RANGE, *parts, "_single",
        F.sum("_rows").over(earlier).alias("_before"),
        F.coalesce(F.lag("_last").over(by_range) == F.col("_first"), F.lit(False)).alias("_goes_on"),
    ).withColumn(
        "_origin", F.last(F.when(~(F.col("_goes_on") & F.col("_single")), F.col(RANGE)), ignorenulls=True).over(earlier)
    ).filter("_before > 0").select(
        F.col(RANGE).alias("_r"), *[F.col(p).alias(f"_p{i}") for i, p in enumerate(parts)],
        "_before", F.when(F.col("_goes_on"), F.col("_origin")).alias("_origin"),
    )
    same = F.col(RANGE) == F.col("_r")
    for i, part in enumerate(parts):
        same = same & F.col(part).eqNullSafe(F.col(f"_p{i}"))
    taken = (F.col("_run") == 1) & F.col("_origin").isNotNull()
    named = runs.join(F.broadcast(before), same, "left").select(
        *parts, value, "_n",
        (F.coalesce("_before", F.lit(0)) + F.col("_no")).alias("_no"),
        F.when(taken, F.col("_origin")).otherwise(F.col(RANGE)).alias("_origin"),
        # 0 is the last run of its range, the one that can go on.
        F.when(taken | (F.col("_run") == F.col("_last_run")), 0).otherwise(F.col("_run")).alias("_run"),
    )
    return named.groupBy(*parts, value, "_origin", "_run").agg(
        F.min("_no").alias("first_position"), F.sum("_n").alias("length")
    ).drop("_origin", "_run")


def folded_values(frame: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values (per group) with their number of copies, settled."""
    return settle(
        frame.filter(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )


def ordered_values(frame: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """``(value, copies, upto)``: the distinct non-null values of a column, settled.

    ``upto`` counts the copies of all values up to and including this one.  The values are
    put in order once; quantiles, ends, bins and fences of the column, or of the part below
    a cut, are then read from this frame.
    """
    copies = folded_values(frame, column)
    upto = in_order(copies, ["_value"], running={"upto": ("sum", "_copies")}, ranges=ranges)
    return settle(upto.select(F.col("_value").alias("value"), F.col("_copies").alias("copies"), "upto"))


def quantiles_of_ordered(values: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """One row of exact quantiles of :func:`ordered_values`, or of those up to a cut.

    The two values around each position are picked by their running counts, so a part of
    the values needs no new order.
    """
    n = values.agg(F.max("upto")).scalar()
    counted = values.withColumn("_n", n)
    return _picked(counted, [], probabilities, "value", "upto")


def _picked(upto: DataFrame, groups: list[str], probabilities: Mapping[str, float], value: str, count: str) -> DataFrame:
    """The values around each position, mixed by how near it is to them."""
    edges, values = [], groups[:]
    for name, p in probabilities.items():
        at = f"(_n - 1) * {float(p)!r}D"
        edges += [
            F.expr(f"min(IF({count} > floor({at}), {value}, NULL))").alias(f"{name}_lo"),
            F.expr(f"min(IF({count} > ceil({at}), {value}, NULL))").alias(f"{name}_hi"),
            F.expr(f"max({at} - floor({at}))").alias(f"{name}_part"),
        ]
        values.append(f"double({name}_lo + ({name}_hi - {name}_lo) * {name}_part) AS {name}")
    return upto.groupBy(*groups).agg(*edges).selectExpr(*values)


def quantiles_of_folded(
    copies: DataFrame,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles of :func:`folded_values`.

    The values are put in order with a running count of copies, and the two values
    around each position are picked.  No task holds a whole distribution.
    """
    groups, order = list(by), ["_value"]
    placed = spread_in_order(copies, order, groups, ranges)
    upto = running_over(
        placed, order, groups, running={"_upto": ("sum", "_copies")}, whole={"_n": "_upto"}
    )
    return _picked(upto, groups, probabilities, "_value", "_upto")


def exact_quantiles(
    frame: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per name.

    One row, or one row per group of the ``by`` columns.
    """
    return quantiles_of_folded(folded_values(frame, column, by), probabilities, by, ranges)


def long_form(frame: DataFrame, columns: Sequence[str], as_type: str = "double") -> DataFrame:
    """One row (Column, Value) per listed column and value; nulls and NaN are none."""
    value = "nanvl(double(`{0}`), NULL)" if as_type == "double" else as_type + "(`{0}`)"
    pairs = ", ".join(f"'{c}', {value.format(c)}" for c in columns)
    return frame.selectExpr(f"stack({len(columns)}, {pairs}) AS (Column, Value)").filter(
        "Value IS NOT NULL"
    )


def medians_of(frame: DataFrame, *columns: str, ranges: int | None = None) -> list[Column]:
    """Exact medians of columns, found together, as one-value columns."""
    found = settle(
        exact_quantiles(
            long_form(frame, columns), "Value", {"median": 0.5}, by=["Column"], ranges=ranges
        )
    )
    return [found.filter(F.col("Column") == c).select("median").scalar() for c in columns]


def overlapping_blocks(
    frame: DataFrame,
    position: str,
    ahead: int,
    block_rows: int = 10_000,
    block: str = "block",
    home: str = "at_home",
) -> DataFrame:
    """Cut numbered rows into blocks that also hold the next ``ahead`` rows.

    A window over (key, block) then sees every neighbour it needs while no task gets
    more than ``block_rows + ahead`` rows of one key.  Borrowed rows carry
    ``at_home = false``.
    """
    if ahead > block_rows:
        raise ValueError("a block must be at least as long as the look-ahead")
    own = F.floor((F.col(position) - 1) / block_rows)
    offset = F.col(position) - 1 - own * block_rows
    blocks = F.when((offset < ahead) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    return frame.withColumn(block, F.explode(blocks)).withColumn(home, F.col(block) == own)
