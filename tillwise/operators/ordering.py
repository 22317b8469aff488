"""Total orders over large tables without a one-task window.

A window without PARTITION BY pulls every row into one task. The functions here use
Spark's range-partitioned sort instead: each row gets (partition, position) from the
sort, one small row per partition carries the offset, and only counts travel.
The sorted rows are written once (see `materialize`), so positions never change.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SLOT_BITS = 33


def _slots(df: DataFrame, order_by: Sequence[Column | str], label: str) -> DataFrame:
    """Sort, then remember the sort partition `_part` and the position `_pos` inside it."""
    placed = materialize(
        df.orderBy(*order_by).withColumn("_slot", F.monotonically_increasing_id()), label
    )
    return placed.withColumns(
        {
            "_part": F.shiftright("_slot", _SLOT_BITS),
            "_pos": F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)),
        }
    ).drop("_slot")


def global_row_index(df: DataFrame, order_by: Sequence[Column | str], name: str = "row_index") -> DataFrame:
    """0-based position of every row in a total order.

    The broadcast side has one row per sort partition, whatever the size of `df`.
    """
    placed = _slots(df, order_by, "ordered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


@dataclass
class _Span:
    """Rows of a metric from low to high, both included, with a number of rows before them and the positions looked for."""

    metric: str
    low: float
    high: float
    before: int
    rows: int
    wanted: list[int]


#: Bins of one refinement, per span.
BINS = 512


def _bin(value: Column, low: float, high: float) -> Column:
    """The bin of a value in [low, high]: equal widths, or classes where a border is not finite."""
    if math.isfinite(low) and math.isfinite(high) and math.isfinite(high - low):
        scaled = F.floor((value - F.lit(low)) / F.lit((high - low) or 1.0) * BINS)
        return F.least(F.greatest(scaled, F.lit(0)), F.lit(BINS - 1)).cast("int")
    signs = F.when(value == float("-inf"), 0).when(value < 0, 1)
    return signs.when(F.isnan(value), 4).when(value == float("inf"), 3).otherwise(2)


def _in_span(value: Column, span: _Span) -> Column:
    # Spark orders NaN above every number, here as in a sort
    return (value >= F.lit(span.low)) & (value <= F.lit(span.high))


def _select(df: DataFrame, columns: dict[str, Column], wanted: Callable[[str, int], Sequence[int]]):
    """{metric: (rows, {position: (value, first position of that value)})} at 0-based positions of each column's order.

    Selection by refined histograms: every round counts, in one pass and without a sort, the rows per bin of the spans
    that still hold a wanted position, and goes on with the bins that do. A round ends with a few numbers per
    bin on the driver; the spans narrow to single values, however the values are spread.
    """
    numbers = {name: column.cast("double") for name, column in columns.items()}
    if not numbers:
        return {}
    first = df.agg(
        *[f(c).alias(f"{name}_{i}") for name, c in numbers.items() for i, f in enumerate((F.count, F.min, F.max))]
    ).first()
    found = {name: (first[f"{name}_0"], {}) for name in columns}
    open_spans = []
    for name, (n, _) in found.items():
        positions = sorted({p for p in wanted(name, n) if 0 <= p < n})
        if positions:
            open_spans.append(_Span(name, first[f"{name}_1"], first[f"{name}_2"], 0, n, positions))
    while open_spans:
        rest = []
        for span in open_spans:
            if span.low == span.high or math.isnan(span.low):
                found[span.metric][1].update({p: (span.low, span.before) for p in span.wanted})
            else:
                rest.append(span)
        open_spans = rest
        if not open_spans:
            break
        entries = []
        for name in dict.fromkeys(s.metric for s in open_spans):
            v, entry = numbers[name], None
            for i, span in enumerate(open_spans):
                if span.metric == name:
                    place = F.struct(F.lit(i).alias("span"), _bin(v, span.low, span.high).alias("bin"), v.alias("value"))
                    entry = F.when(_in_span(v, span), place) if entry is None else entry.when(_in_span(v, span), place)
            entries.append(entry)
        counts = (
            df.select(F.explode(F.array(*entries)).alias("_e"))
            .where(F.col("_e").isNotNull())
            .groupBy("_e.span", "_e.bin")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_e.value").alias("low"), F.max("_e.value").alias("high"))
            .collect()  # BINS rows a span at most
        )
        narrowed = []
        for i, span in enumerate(open_spans):
            before = span.before
            for row in sorted((r for r in counts if r["span"] == i), key=lambda r: r["bin"]):
                inside = [p for p in span.wanted if before <= p < before + row["n"]]
                if inside:
                    narrowed.append(_Span(span.metric, row["low"], row["high"], before, row["n"], inside))
                before += row["n"]
        open_spans = narrowed
    return found


def _nth_text(rows: DataFrame, column: str, positions: Sequence[int]) -> dict[int, str]:
    """The texts at 0-based positions of their order, by counting the next two characters, then the next two, and so on."""
    spans, found = [("", 0, sorted(set(positions)))], {}
    while spans:
        text, following = F.col(column), []
        entry = None
        for i, (prefix, _, _) in enumerate(spans):
            place = F.struct(F.lit(i).alias("span"), F.substring(text, 1, len(prefix) + 2).alias("head"), text.alias("text"))
            entry = F.when(text.startswith(prefix), place) if entry is None else entry.when(text.startswith(prefix), place)
        counts = (
            rows.select(entry.alias("_e")).where(F.col("_e").isNotNull()).groupBy("_e.span", "_e.head")
            .agg(F.count(F.lit(1)).alias("n"), F.min("_e.text").alias("low"), F.max("_e.text").alias("high"))
            .collect()  # two more characters a span
        )
        for i, (_, before, wanted) in enumerate(spans):
            for row in sorted((r for r in counts if r["span"] == i), key=lambda r: r["head"].encode()):
                inside = [p for p in wanted if before <= p < before + row["n"]]
                if inside and row["low"] == row["high"]:
                    found.update({p: row["low"] for p in inside})
                elif inside:
                    following.append((row["head"], before, inside))
                before += row["n"]
        spans = following
    return found


def _nth_ids(df: DataFrame, id_column: str, ties: dict[str, tuple[Column, list[int]]]) -> dict[str, dict]:
    """For each tie, (which rows, positions): the ids at 0-based positions among these rows. All ties are counted together."""
    kind = df.schema[id_column].dataType.simpleString()
    if kind == "string":
        return {name: _nth_text(df.where(rows).select(id_column), id_column, at) for name, (rows, at) in ties.items()}
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"ids of type {kind} have no order here")
    # a double holds the halves of a number exactly, which come one after the other: the high one, and the low one of its rows
    number = F.col(id_column).cast("bigint")
    high = F.shiftright(number, 31)
    halves = _select(df, {name: F.when(rows, high) for name, (rows, _) in ties.items()}, lambda name, _: ties[name][1])
    parts, places = {}, {}
    for name, (rows, _) in ties.items():
        for position, (half, start) in halves[name][1].items():
            part = f"{name}h{int(half)}".replace("-", "m")
            parts[part] = F.when(rows & (high == F.lit(int(half))), number.bitwiseAND(F.lit(2**31 - 1)))
            places.setdefault(part, []).append((name, position, position - start, int(half)))
    lows = _select(df, parts, lambda part, _: [q for *_, q, _ in places[part]])
    out: dict[str, dict] = {name: {} for name in ties}
    for part, wanted in places.items():
        for name, position, q, half in wanted:
            out[name][position] = half * 2**31 + int(lows[part][1][q][0])
    return out


def exact_quantiles(
    df: DataFrame,
    probabilities: dict[str, Sequence[float]],
    clip_upper: dict[str, float] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, without a sort (see `_select`).

    With clip_upper={"c": p} the quantiles of c are those of the column clipped at its own p-quantile.
    """
    clip_upper = clip_upper or {}

    def wanted(name: str, n: int) -> list[int]:
        levels = {*probabilities[name], *([clip_upper[name]] if name in clip_upper else [])}
        return [f((n - 1) * p) for p in levels for f in (math.floor, math.ceil)]

    picked = _select(df, {name: F.col(name) for name in probabilities}, wanted)
    result: dict[str, list[float | None]] = {}
    for name, ps in probabilities.items():
        n, rows = picked.get(name, (0, {}))
        if n == 0:
            result[name] = [None] * len(ps)
            continue

        def at(p: float, top: float = math.inf) -> float:
            place = (n - 1) * p
            low = min(rows[math.floor(place)][0], top)
            high = min(rows[math.ceil(place)][0], top)
            return low + (high - low) * (place - math.floor(place))

        top = at(clip_upper[name]) if name in clip_upper else math.inf
        result[name] = [at(p, top) for p in ps]
    return result


def with_tiles(
    df: DataFrame, tiles: int, id_column: str, columns: dict[str, Column]
) -> DataFrame:
    """NTILE(tiles) over the whole set for several orders at once, ties broken by id.

    Only the last row of each tile is looked up, by histograms of the values and then of the ids of its value; the tile of
    any row then follows from comparing (value, id) with those few rows, so nothing is sorted. df is read once a round:
    pass a written table.
    """

    def last_rows(n: int) -> list[int]:
        base, extra = divmod(n, tiles)
        ends, upto = [], 0
        for tile in range(tiles - 1):
            upto += base + (1 if tile < extra else 0)
            if upto > 0:
                ends.append(upto - 1)
        return ends

    picked = _select(df, columns, lambda _, n: last_rows(n))
    borders = {name: sorted(set(found.values())) for name, (_, found) in picked.items()}
    ties = {}
    for name, (_, found) in picked.items():
        for i, (border, start) in enumerate(borders[name]):
            positions = [p - start for p, (v, _) in found.items() if v == border]
            ties[f"{name}_{i}"] = (columns[name].cast("double").eqNullSafe(F.lit(border)), positions)
    ids = _nth_ids(df, id_column, ties) if ties else {}
    scored = {}
    for name, value in columns.items():
        tile, number = F.lit(1), value.cast("double")
        for i, (border, _) in enumerate(borders[name]):
            for last in ids[f"{name}_{i}"].values():
                beyond = (number > F.lit(border)) | ((number == F.lit(border)) & (F.col(id_column) > F.lit(last)))
                tile = tile + beyond.cast("int")
        scored[name] = tile.cast("bigint")
    return df.withColumns(scored)


def score_by_edges(value: Column, edges: Sequence[float | None]) -> Column:
    """1 + number of inner edges strictly below the value (right-closed bins, ties collapse)."""
    score = F.lit(1)
    for edge in (e for e in edges if e is not None):
        score = score + (value.cast("double") > F.lit(edge)).cast("int")
    return score.cast("bigint")


def ranks_among(df: DataFrame, targets: dict[str, Sequence[float]]) -> dict[str, list[dict]]:
    """For each target value: how many rows are greater, smaller, or NULL in that column.

    One pass: every row is reduced to its place among the (few) targets, and only the
    counts per place are exchanged. Meant for a short list of targets (a top-k report).
    """
    ladders = {name: sorted(set(values)) for name, values in targets.items()}
    places = []
    for name, ladder in ladders.items():
        number, steps = F.col(name).cast("double"), F.array(*[F.lit(float(v)) for v in ladder])
        places.append(
            F.struct(
                F.lit(name).alias("metric"),
                number.isNull().alias("missing"),
                F.size(F.filter(steps, lambda t: t < number)).alias("above"),  # noqa: B023
                F.size(F.filter(steps, lambda t: t <= number)).alias("reached"),  # noqa: B023
            )
        )
    counts = (
        df.select(F.explode(F.array(*places)).alias("_p"))
        .groupBy("_p")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_p.*", "n")
        .collect()
    )
    result: dict[str, list[dict]] = {}
    for name, values in targets.items():
        rows = [r for r in counts if r["metric"] == name]
        known = [r for r in rows if not r["missing"]]
        result[name] = []
        for value in values:
            step = ladders[name].index(value)
            result[name].append(
                {
                    "greater": sum(r["n"] for r in known if r["above"] > step),
                    "smaller": sum(r["n"] for r in known if r["reached"] <= step),
                    "nulls": sum(r["n"] for r in rows if r["missing"]),
                    "all": sum(r["n"] for r in rows),
                }
            )
    return result


def framed_over_rows(
    indexed: DataFrame,
    preceding: int,
    aggregates: Callable[[Window], dict[str, Column]],
    partition_by: Sequence[str] = (),
    index: str = "row_index",
    include_current: bool = True,
    chunk_rows: int = 500_000,
) -> DataFrame:
    """Aggregates over the last rows of a total order, in groups of bounded size.

    The order is cut into chunks of `chunk_rows`; each chunk also receives the last
    `preceding` rows of the chunk before. No group exceeds chunk_rows + preceding rows,
    however the keys are distributed. For keyed frames the total order must start with
    the keys: the rows of a key are then neighbours and the carried rows are all it needs.
    """
    if preceding > chunk_rows:
        raise ValueError("a frame may not be longer than a chunk, which only gets rows of the chunk before")
    chunk = F.floor(F.col(index) / F.lit(chunk_rows)).cast("bigint")
    carries = (F.col(index) % chunk_rows) >= (chunk_rows - preceding)
    copies = F.when(carries, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = indexed.withColumn("_home", chunk).withColumn("_chunk", F.explode(copies))
    frame = (
        Window.partitionBy("_chunk", *partition_by)
        .orderBy(index)
        .rowsBetween(-preceding, 0 if include_current else -1)
    )
    return (
        spread.withColumns(aggregates(frame)).where(F.col("_chunk") == F.col("_home"))
        .drop("_chunk", "_home")
    )
