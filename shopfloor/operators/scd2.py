"""SCD type 2 history from an out-of-order change feed (T4, SURVEY 2.11).

Per key, ordered by the sequence column:

1. one row per (key, sequence): the smallest row by the remaining columns,
   NULLs first (replays and duplicate sequences are absorbed);
2. ``ignore_null_updates``: every column is filled with its last non-NULL
   value so far, so a NULL never opens a version or erases a value;
3. a row opens a version when it is the key's first row or a tracked column
   differs (NULL-safe) from the previous row;
4. a version starts at its first row (``__START_AT``), ends where the next
   version starts (``__END_AT``, NULL = current) and carries the filled values
   of its last row (untracked columns are overwritten in place).

The result depends only on the set of rows, never on arrival order.

Scale: a per-key window would put a key's whole history in one task. Every
key with more than ``hot_rows`` rows, however many such keys there are, is cut
into chunks of about ``hot_rows`` sequence values, so the number of chunks
grows with the key. Every step runs per (key, chunk); what crosses a chunk
boundary (last value so far, next version start) comes from per-chunk
summaries. Cold keys are chunk 0 and take no summary; chunks of hot keys
count from 1.

The chunk bounds are values of a hash sample of the key's own sequence
numbers, of their own type (any type that sorts): they depend on the set of rows only, not on how the rows are dealt
out. They are checkpointed once and every branch reads that one table.

The change log of cold keys is shuffled once, on the key: the de-duplication
and every window run on that partitioning and on its one sort by (key,
sequence). With hot keys it is shuffled on the key to meet the bounds, then
once on (key, chunk): the de-duplication, the summaries, the windows and the
join with the summaries all run on that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

START, END = "__START_AT", "__END_AT"
_CHUNK = "_chunk"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dedupe_sequence(changes: DataFrame, keys: Sequence[str], seq: str, cols: Sequence[str]) -> DataFrame:
    """One row per (key, seq); ties resolved by the smallest row (NULLs first)."""
    picked = F.min(F.struct(*[F.col(c) for c in cols])).alias("_row")
    return (changes.where(F.col(seq).isNotNull())
            .groupBy(*keys, seq).agg(picked)
            .select(*keys, seq, *[F.col(f"_row.{c}").alias(c) for c in cols]))


# Sampled sequence numbers per chunk: a chunk is within about an eighth of its size.
_SAMPLED = 64
# Every so many bounds there is a coarse one: a row finds its chunk in two short scans.
_STRIDE = 64


def chunk_bounds(rows: DataFrame, keys: list[str], seq: str, hot_rows: int) -> DataFrame | None:
    """Per key with more than ``hot_rows`` rows its sorted chunk bounds
    (``_bounds``) and every ``_STRIDE``-th of them (``_coarse``), checkpointed;
    None if there is no such key. The sample of a key holds about ``_SAMPLED``
    sequence numbers for every ``hot_rows`` rows."""
    checkpoint_dir(rows.sparkSession)
    hot = rows.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys).checkpoint(eager=True)
    if hot.isEmpty():
        return None
    step = max(1, hot_rows // _SAMPLED)
    per_chunk = max(1, hot_rows // step)
    spot = F.pmod(F.xxhash64(*keys, seq, F.lit("chunk")), F.lit(step))
    sample = (rows.join(hot, keys, "left_semi").where(spot == 0)
              .select(*keys, F.col(seq).alias("_num")).distinct())
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_num"))
    cuts = (sample.withColumn("_place", place).where(F.col("_place") % per_chunk == 0)
            .groupBy(*keys).agg(F.sort_array(F.collect_list("_num")).alias("_bounds")))
    none = F.array().cast(cuts.schema["_bounds"].dataType)
    bounds = hot.join(cuts, keys, "left").withColumn("_bounds", F.coalesce("_bounds", none))
    coarse = F.filter("_bounds", lambda b, i: (i + 1) % _STRIDE == 0)
    return bounds.withColumn("_coarse", coarse).checkpoint(eager=True)


def _assign_chunks(rows: DataFrame, keys: list[str], seq: str, bounds: DataFrame) -> DataFrame:
    """Add ``_chunk``: 0 for cold keys, 1 + the bounds at or below the sequence
    number for hot keys. The join is left to the planner: a hot key's rows are
    the skewed side, which adaptive execution splits."""
    num = F.col(seq)
    whole = F.size(F.filter("_coarse", lambda b: b <= num)) * _STRIDE
    rest = F.size(F.filter(F.slice("_bounds", whole + 1, _STRIDE), lambda b: b <= num))
    chunk = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(1 + whole + rest)
    return rows.join(bounds, keys, "left").withColumn(_CHUNK, chunk).drop("_bounds", "_coarse")


def _across_chunks(scanned: DataFrame, keys: list[str], seq: str, cols: list[str], tracked: list[str],
                   ignore_nulls: bool) -> DataFrame:
    """Per chunk of a hot key, what its rows need of the other chunks: the
    values left by the chunks before (``_carry_``) and by the whole key
    (``_final_``), the next version start in a later chunk (``_next_chunk``) and
    the values left just before it (``_ncp_``). The change log is read once.

    Only few rows of a chunk can be its first version start: its first row, the
    first one that differs from a value of its own chunk, and the first non-NULL
    one of each tracked column. They are kept with the values before them, and
    which of them opens a version is decided once the carried values are known."""
    q = _quote
    part = [*keys, _CHUNK]

    def before(c):
        return q("_plf_" + c)

    def met(c):
        return f"({before(c)} IS NULL AND {q('_lf_' + c)} IS NOT NULL)"

    if ignore_nulls:
        changed = " OR ".join(f"({before(c)} IS NOT NULL AND NOT ({q('_lf_' + c)} <=> {before(c)}))" for c in tracked)
    else:
        changed = " OR ".join(f"NOT ({q('_lf_' + c)} <=> {before(c)})" for c in tracked)
    spot = ", ".join([f"{q(seq)} AS at", *[f"{q('_lf_' + c)} AS {q('v_' + c)}" for c in cols], *[f"{before(c)} AS {q('p_' + c)}" for c in cols]])
    kinds = {"_c_first": "_first", "_c_own": f"NOT _first AND ({changed or 'false'})"}
    if ignore_nulls:
        kinds |= {f"_c_met_{c}": met(c) for c in tracked}
    # Key and chunk come back as aggregates: a filter on them stays above the
    # grouping, so that both readers of the change log share its one shuffle.
    chunks = scanned.groupBy(*[F.col(q(c)).alias(f"_g{i}") for i, c in enumerate(part)]).agg(
        *[F.max(q(c)).alias(c) for c in part],
        *[F.expr(f"min_by(struct({spot}), {q(seq)}) FILTER (WHERE {when})").alias(name) for name, when in kinds.items()],
        *[F.expr(f"max_by({q('_lf_' + c)}, {q(seq)})").alias(f"_x_{c}") for c in cols]).where(F.col(_CHUNK) > 0)

    over = "(PARTITION BY " + ", ".join(q(k) for k in keys) + f" ORDER BY {q(_CHUNK)}"
    out = [q(c) for c in [*part, *kinds]] + [f"lag({q(_CHUNK)}) OVER {over}) IS NOT NULL AS _has_prior"]
    for c in cols:
        x = q("_x_" + c)
        carry = f"last({x}, true) OVER {over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" if ignore_nulls else f"lag({x}) OVER {over})"
        out += [f"{carry} AS {q('_carry_' + c)}",
                f"last({x}, {str(ignore_nulls).lower()}) OVER {over} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {q('_final_' + c)}"]
    carried = chunks.selectExpr(*out)

    def start(name, opens):
        """The kept row ``name``, if it opens a version, with the values left before it."""
        def left(c):
            own, carry = f"{q(name)}.{q('p_' + c)}", q("_carry_" + c)
            if ignore_nulls:
                return f"coalesce({own}, {carry})"
            return carry if name == "_c_first" else own
        fields = ", ".join([f"{q(name)}.at AS at", *[f"{left(c)} AS {q('p_' + c)}" for c in cols]])
        return f"CASE WHEN {q(name)} IS NOT NULL AND ({opens}) THEN struct({fields}) END"

    def moved(name, columns):
        return " OR ".join(f"NOT ({q(name)}.{q('v_' + c)} <=> {q('_carry_' + c)})" for c in columns) or "false"

    starts = [start("_c_own", "true")]
    starts.append(start("_c_first", "NOT _has_prior OR " + ("false" if ignore_nulls else moved("_c_first", tracked))))
    if ignore_nulls:
        starts += [start(f"_c_met_{c}", moved(f"_c_met_{c}", [c])) for c in tracked]
    earliest = f"array_min(filter(array({', '.join(starts)}), s -> s IS NOT NULL))"
    opened = carried.selectExpr(*[q(c) for c in [*part, "_has_prior"]], *[q(f"_{k}_{c}") for k in ("carry", "final") for c in cols],
                                f"{earliest} AS _start")
    back = over + " DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    told = opened.selectExpr("*", f"last(_start, true) OVER {back} AS _following")
    return told.selectExpr(
        *[q(c) for c in [*part, "_has_prior"]], "true AS _hot", *[q(f"_{k}_{c}") for k in ("carry", "final") for c in cols],
        "_following.at AS _next_chunk", *[f"_following.{q('p_' + c)} AS {q('_ncp_' + c)}" for c in cols])


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    except_cols: Sequence[str] = (),
    ignore_null_updates: bool = True,
    *,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    keys = list(keys)
    seq = sequence_by
    skip = set(keys) | {seq} | set(except_cols)
    cols = [c for c in changes.columns if c not in skip]
    tracked = [c for c in (track or cols) if c in cols]

    base = changes.where(F.col(seq).isNotNull())
    bounds = chunk_bounds(base, keys, seq, hot_rows)
    hot = bounds is not None
    if not hot:
        # One shuffle serves everything: the grouping and the windows share
        # the key. No literal chunk in it: it would break the ordering reuse.
        part = list(keys)
        rows = (dedupe_sequence(base.repartition(*part), keys, seq, cols)
                .withColumn(_CHUNK, F.lit(0)))
    else:
        # This shuffle is the last of the change log: whatever follows is on (key, chunk).
        part = [*keys, _CHUNK]
        chunked = _assign_chunks(base, keys, seq, bounds).select(*part, seq, *cols)
        rows = dedupe_sequence(chunked.repartition(*part), part, seq, cols)

    q = _quote
    kp = ", ".join(q(c) for c in part)
    ks = ", ".join(q(c) for c in keys)
    w = f"(PARTITION BY {kp} ORDER BY {q(seq)}"
    upto = f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    whole = f"(PARTITION BY {kp})"
    nn = "CASE WHEN {c} IS NOT NULL THEN " + q(seq) + " END"
    local = [q(c) for c in [*keys, seq, _CHUNK]]
    for c in cols:
        if ignore_null_updates:
            local += [f"last({q(c)}, true) OVER {upto} AS {q('_lf_' + c)}",
                      f"last({q(c)}, true) OVER {before} AS {q('_plf_' + c)}",
                      f"max_by({q(c)}, {nn.format(c=q(c))}) OVER {whole} AS {q('_end_' + c)}"]
        else:
            local += [f"{q(c)} AS {q('_lf_' + c)}",
                      f"lag({q(c)}) OVER {w}) AS {q('_plf_' + c)}",
                      f"max_by({q(c)}, {q(seq)}) OVER {whole} AS {q('_end_' + c)}"]
    local.append(f"row_number() OVER {w}) = 1 AS _first")
    scanned = rows.selectExpr(*local)

    if hot:
        scanned = scanned.join(_across_chunks(scanned, keys, seq, cols, tracked, ignore_null_updates), part, "left")

        def filled(c):
            return (f"coalesce({q('_lf_' + c)}, {q('_carry_' + c)})" if ignore_null_updates
                    else q("_lf_" + c))

        def previous(c):
            return (f"coalesce({q('_plf_' + c)}, {q('_carry_' + c)})" if ignore_null_updates
                    else f"CASE WHEN _first THEN {q('_carry_' + c)} ELSE {q('_plf_' + c)} END")

        def final(c):
            return f"CASE WHEN _hot THEN {q('_final_' + c)} ELSE {q('_end_' + c)} END"

        has_prev = "(NOT _first OR coalesce(_has_prior, false))"
    else:
        def filled(c):
            return q("_lf_" + c)

        def previous(c):
            return q("_plf_" + c)

        def final(c):
            return q("_end_" + c)

        has_prev = "(NOT _first)"

    differs = " OR ".join(f"NOT ({filled(c)} <=> {previous(c)})" for c in tracked) or "false"
    starts = scanned.selectExpr(
        *[q(c) for c in [*keys, seq, _CHUNK]],
        *[f"{filled(c)} AS {q('_f_' + c)}" for c in cols],
        *[f"{previous(c)} AS {q('_p_' + c)}" for c in cols],
        *[f"{final(c)} AS {q('_k_' + c)}" for c in cols],
        f"NOT {has_prev} OR {differs} AS _open",
        *(["_next_chunk", *[q("_ncp_" + c) for c in cols]] if hot else []),
    ).where("_open")

    versions = starts.selectExpr(
        "*", f"lead({q(seq)}) OVER {w}) AS _next_local",
        *[f"lead({q('_p_' + c)}) OVER {w}) AS {q('_np_' + c)}" for c in cols])
    def untracked(c):
        if not hot:
            return f"CASE WHEN _next_local IS NOT NULL THEN {q('_np_' + c)} ELSE {q('_k_' + c)} END"
        return (f"CASE WHEN _next_local IS NOT NULL THEN {q('_np_' + c)} "
                f"WHEN _next_chunk IS NOT NULL THEN {q('_ncp_' + c)} ELSE {q('_k_' + c)} END")

    end = "_next_local" if not hot else "coalesce(_next_local, _next_chunk)"
    return versions.selectExpr(
        *[q(k) for k in keys],
        *[f"{q('_f_' + c) if c in tracked else untracked(c)} AS {q(c)}" for c in cols],
        f"{q(seq)} AS {START}", f"{end} AS {END}")


def current(history: DataFrame) -> DataFrame:
    """Current rows of an SCD2 table."""
    return history.where(F.col(END).isNull())
