"""Global row numbers and ntile without a single-task window (W4, serves W1).

``Window.orderBy(...)`` with no PARTITION BY moves every row into one task.
Instead the rows are range-partitioned on the ordering (Spark samples the
bounds), sorted inside each partition and numbered there; a partition's
offset is the number of rows in the partitions before it. The offsets table
has one row per partition, so it is bounded by the partition count and is
broadcast. The numbered data is checkpointed (reliable, in
``spark.checkpoint.dir``) so the counts and the numbers come from the same
partitioning even if an executor is lost and work is recomputed.

The ordering must be total (append a unique key) for the result to be
deterministic; callers always do.

Range partitioning samples its input in a separate pass before the shuffle,
so an expensive input (an aggregate over all facts) would be computed twice.
``checkpoint_input`` materializes it once first; inputs that are cheap to
recompute (a plain scan, a previous ranking) skip that.

Tiles alone need no row numbers: a tile ends at one row, so NTILE(5) of a
metric is four cut rows. ``ntile_keys`` finds them by counting. Each cut is
held between two rows whose positions are counted exactly; a hash sample of
the rows between them gives two nearer ones, until few rows are left, which
are sorted. A round reads a sample and one aggregate of counts, for all cuts of
all metrics at once, and leaves about a sixteenth of the rows between; nothing
is shuffled, sorted or stored, and the tiles are a projection that compares
each row with the cuts. The driver sees at most about ``_SAMPLE`` rows a cut,
whatever the size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import int_div
from ..session import checkpoint_dir, shuffle_partitions


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "_rn",
                      partitions: int | None = None, checkpoint_input: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order``, and ``_n`` =
    total row count."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or shuffle_partitions(spark)
    if checkpoint_input:
        df = df.checkpoint(eager=True)
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    by_part = Window.orderBy("_part")  # over at most ``n`` rows
    offsets = sizes.select(
        "_part", "_first",
        F.coalesce(F.sum("_cnt").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"),
        F.sum("_cnt").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_n"),
    )
    numbered = ranged.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_pos") - F.col("_first") + 1).drop(
        "_part", "_pos", "_first", "_before")


def ntile_of(rank: Column, total: Column, buckets: int) -> Column:
    """Spark/SQL NTILE for a 1-based rank among ``total`` rows: the first
    ``total % buckets`` tiles hold one extra row."""
    k = F.lit(buckets).cast("bigint")
    size = int_div(total, k)
    rem = F.pmod(total, k)
    big = rem * (size + 1)
    return (F.when(rank <= big, int_div(rank - 1, size + 1) + 1)
            .otherwise(int_div(rank - 1 - big, F.greatest(size, F.lit(1))) + rem + 1)).cast("int")


# Rows sampled between the two bounds of a cut, and left there to be sorted.
_SAMPLE = 4096
# Rounds leave about a sixteenth each: this many serve any count of different rows.
_ROUNDS = 24


@dataclass
class _Cut:
    """The row at ``position`` of a metric's ordering lies above ``low`` (which
    ``below`` rows do not exceed) and at or below ``high`` (``upto`` rows)."""
    metric: int
    position: int
    below: int
    upto: int
    low: tuple | None = None
    high: tuple | None = None

    @property
    def between(self) -> int:
        return self.upto - self.below

    def narrow(self, row: tuple, upto: int) -> None:
        """``upto`` rows do not exceed ``row``."""
        if self.position <= upto <= self.upto:
            self.high, self.upto = row, upto
        elif self.below <= upto < self.position:
            self.low, self.below = row, upto


def _spark_order(row: tuple) -> tuple:
    """Sort key of a collected row: NULL first, NaN last, as Spark orders them."""
    return tuple((0, 0) if v is None else (2, 0) if isinstance(v, float) and math.isnan(v) else (1, v) for v in row)


def ntile_keys(df: DataFrame, keys: Sequence[str], buckets: int, metrics: dict[str, Column], *,
               sample: int = _SAMPLE) -> DataFrame:
    """``df`` with one NTILE column per entry of ``metrics`` (name -> ordering
    of a metric, ascending, NULL first; ties by the keys, which must be unique).
    ``df`` is read a few times: store it first if it is dear or may change."""
    ranks = [F.struct(order.alias("_metric"), *[F.col(k) for k in keys]) for order in metrics.values()]
    flat = df.select(*[rank.alias(f"_r{i}") for i, rank in enumerate(ranks)])
    total = flat.count()
    size, rest = divmod(total, buckets)
    cuts = [_Cut(i, j * size + min(j, rest), 0, total) for i in range(len(ranks)) for j in range(1, buckets)]
    if total:
        _narrow(flat, cuts, sample)
    types = [f.dataType for f in flat.schema.fields]

    def tile(i: int) -> Column:
        ends = [_literal(cut.high, types[i]) for cut in cuts if cut.metric == i and cut.high is not None]
        return sum([(ranks[i] > end).cast("int") for end in ends], F.lit(1))

    return df.select("*", *[tile(i).alias(name) for i, name in enumerate(metrics)])


def _literal(row: tuple, rank) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, rank.fields)])


def _narrow(flat: DataFrame, cuts: list[_Cut], sample: int) -> None:
    """Bring ``high`` of every cut to the row at its position."""
    types = [f.dataType for f in flat.schema.fields]

    @cache
    def not_above(metric: int, row: tuple) -> Column:
        return F.col(f"_r{metric}") <= _literal(row, types[metric])

    def upto(cut: _Cut, row: tuple) -> Column:
        return not_above(cut.metric, row)

    def inside(cut: _Cut) -> Column:
        found = F.lit(True) if cut.high is None else upto(cut, cut.high)
        return found if cut.low is None else found & ~upto(cut, cut.low)

    def rows_of(open_cuts: list[_Cut], chosen: list[Column]) -> list[list[tuple]]:
        """Per cut the rows its condition chooses, in order."""
        marks = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in enumerate(chosen)]), lambda m: m.isNotNull())
        found: list[list[tuple]] = [[] for _ in open_cuts]
        table = flat.withColumn("_cuts", marks).where(F.size("_cuts") > 0).toArrow()
        ranked = [[tuple(rank.values()) for rank in table[f"_r{i}"].to_pylist()] for i in range(len(types))]
        for place, marked in enumerate(table["_cuts"].to_pylist()):
            for n in marked:
                found[n].append(ranked[open_cuts[n].metric][place])
        return [sorted(rows, key=_spark_order) for rows in found]

    for turn in range(_ROUNDS):
        wide = [cut for cut in cuts if cut.between > sample]
        if not wide:
            break
        draw = [inside(cut) & (F.pmod(F.xxhash64(f"_r{cut.metric}", F.lit(turn)), F.lit(-(-cut.between // sample))) == 0)
                for cut in wide]
        tried = []
        for cut, rows in zip(wide, rows_of(wide, draw)):
            if rows:
                # Where the position falls in the sample, give or take four standard errors.
                place = (cut.position - cut.below) * len(rows) / cut.between
                slack = 2 * math.sqrt(len(rows)) + 1
                near = {max(0, int(place - slack)), min(len(rows) - 1, int(place + slack))}
                tried += [(cut, rows[n]) for n in sorted(near)]
        if tried:
            counts = flat.agg(*[F.count_if(upto(cut, row)).alias(f"_{n}") for n, (cut, row) in enumerate(tried)]).first()
            for (cut, row), count in zip(tried, counts):
                cut.narrow(row, count)
    else:
        raise ValueError("rows do not get fewer: the keys are not unique")
    for cut, rows in zip(cuts, rows_of(cuts, [inside(cut) for cut in cuts])):
        cut.high = rows[cut.position - cut.below - 1]


def ntile(df: DataFrame, buckets: int, order: Sequence[Column], out: str,
          partitions: int | None = None, checkpoint_input: bool = False) -> DataFrame:
    ranked = global_row_number(df, order, "_rn", partitions, checkpoint_input)
    return ranked.withColumn(out, ntile_of(F.col("_rn"), F.col("_n"), buckets)).drop("_rn", "_n")
