"""Near-duplicate documents from bottom-k sketches of word shingles.

Method: every document's shingles are hashed once; its k smallest hashes are its sketch. Inverted lists
of the retained hashes give pairs that overlap, the sketch of a pair's union estimates the similarity
and drops pairs far below the limit, and the full sets decide.

Long lists are not expanded into all pairs. A document most of whose retained hashes lie in long lists
(a member of a large group of copies) is looked up under other keys instead: a set that its sketch holds whole under as
many of its rarest shingles as a similar set cannot lack (a prefix filter, which loses no pair), a larger one
under several combinations of shingles, each the smallest of its whole set under an order of its own;
in a large group with one key every member is first compared with the group's smallest member. After the
components of those links are known, members outside a group's largest component are compared with a few of its
members, and those that stay outside with every other member that the counts of their common shingles
allow (a document cannot reach the similarity with shingles that no other member has), block by block of bounded size,
each pair of blocks by itself and as a product of matrices, which puts out the links alone. So every pair that shares a
short list or a key is compared, already connected, or too far apart by its counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import as_bytes, small_batches
from tillwise.llm.components import connected_components
from tillwise.llm.word_hashes import word_hashes
from tillwise.session import discard, materialize

SHINGLE = 5
PERCENT = 75
#: Hashes kept of a document, and how many of them open inverted lists.
RETAINED, LISTED = 64, 24
#: A list of up to this many documents is expanded into pairs.
SHORT = 24
#: A document with more long lists than this is looked up by other keys: at most a third of its lists, so that
#: the others meet for a pair at the limit but for one in ten million.
LONG_LISTS = 8
#: Combinations of shingles: so many, of so many hashes. 0.75^4 each, so 5 in a million pairs are missed.
COMBINATIONS, COMBINED = 32, 4
#: A pair goes on if this share of its union's sketch is common: five deviations below the limit.
SKETCH_SHARE = 0.48
#: Members of a large component that the others of its groups are compared with, in turns.
LEADERS = 24
#: Members of a block on average at most, and their shingles; columns of a matrix of members and shingles.
BLOCK_SETS, BLOCK_SHINGLES, COLUMNS = 512, 1 << 17, 4096

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words, one for all; none without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = word_hashes(words)
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
        out = _mixed(out)
    return np.unique(out.view(np.int64))


def _node(values: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(values.tobytes())


def sketches(docs: DataFrame, width: int = SHINGLE, retained: int = RETAINED) -> DataFrame:
    """(doc_id, n_shingles, node, sketch) of every row; equal sets have the same node, empty ones a null node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            sets = [shingle_set(t, width) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:retained] for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "node", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, node binary, sketch array<long>"
    )


def combination_keys(values: np.ndarray) -> np.ndarray:
    """Keys of the smallest of a whole set's shingles under COMBINATIONS orders."""
    v, out = values.view(np.uint64), []
    seeds = _mixed(np.arange(1, COMBINATIONS + 1, dtype=np.uint64))
    at_once = max(1, (1 << 16) // max(1, len(v)))
    with np.errstate(over="ignore"):
        for i in range(0, COMBINATIONS, at_once):
            seed = seeds[i : i + at_once]
            order = _mixed(v[None, :] ^ seed[:, None])
            if len(v) > COMBINED:
                order = np.partition(order, COMBINED - 1, axis=1)[:, :COMBINED]
            key = seed
            for column in np.sort(order, axis=1).T:
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
            out.append(key)
    return np.concatenate(out).view(np.int64)


def _of_sets(docs: DataFrame, nodes: DataFrame, width: int, column: str, of_set) -> DataFrame:
    """(node, column) for the nodes (doc_id, node): the texts of these documents are read once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            sets = [shingle_set(t, width) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_node, sets), pa.binary()), pa.array(map(of_set, sets), pa.list_(pa.int64()))], ["node", column]
            )

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        nodes.select("doc_id").distinct(), "doc_id", "left_semi"
    )
    found = wanted.select("text").mapInArrow(run, f"node binary, {column} array<long>")
    return found.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first(column).alias(column))


def full_sets(docs: DataFrame, nodes: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(node, shingles) for the nodes (doc_id, node)."""
    return _of_sets(docs, nodes, width, "shingles", lambda s: s)


def _fits(a: Column | str, b: Column | str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pairs_within(members: DataFrame, key: str, percent: int) -> DataFrame:
    """All ordered pairs of nodes under one key; only for keys with few members."""
    grouped = members.groupBy(key).agg(F.collect_list(F.struct("node", "n")).alias("m")).where("size(m) > 1")
    first = grouped.select(F.posexplode("m").alias("i", "x"), "m")
    second = first.select("x", F.explode(F.expr("slice(m, i + 2, size(m))")).alias("y"))
    return second.where(_fits(F.col("x.n"), F.col("y.n"), percent)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    )


def _prefix_keys(whole: DataFrame, percent: int) -> DataFrame:
    """(node, n, key): of whole sets (node, n, sketch) the rarest shingles, one more than a similar set may lack."""
    values = whole.select("node", "n", F.explode("sketch").alias("value"))
    holders = values.groupBy("value").agg(F.count("*").alias("holders"))
    ranked = values.join(holders, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("rarest")
    )
    taken = (F.col("n") - F.ceil(percent * F.col("n") / 100) + 1).cast("int")
    keys = ranked.select("node", "n", F.explode(F.slice("rarest", F.lit(1), taken)).alias("r")).where("r.holders > 1")
    return keys.select("node", "n", F.xxhash64(F.lit("prefix"), "r.value").alias("key"))


def _keyed(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, n, key) of nodes (node, doc_id, n, sketch): exact keys of sets no larger than a sketch, combinations of those above.

    A set that is similar to a larger one than a sketch has combinations as well.
    """
    larger = members.where(100 * F.col("n") > percent * RETAINED).select("node", "doc_id", "n")
    combined = _of_sets(docs, larger, width, "keys", combination_keys).join(larger.select("node", "n"), "node")
    return _prefix_keys(members.where(F.col("n") <= RETAINED), percent).union(combined.select("node", "n", F.explode("keys").alias("key")))


def _verified(pairs: DataFrame, reps: DataFrame, percent: int, sets: DataFrame | None, docs: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) of nodes whose full sets reach the similarity; without sets (node, shingles) those needed are read."""
    small = reps.select("node", "sketch")
    left = small.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = small.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, RETAINED)
    common = F.size(F.array_intersect("sa", "sb"))
    shared = F.when(common == 0, 0).otherwise(F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))))
    likely = pairs.join(left, "a").join(right, "b").where(shared >= SKETCH_SHARE * F.size(union)).select("a", "b")
    likely = materialize(likely, "near-likely")
    own_sets = sets is None
    if own_sets:
        nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = materialize(full_sets(docs, nodes.join(reps.select("node", "doc_id"), "node"), width), "near-sets")
    both = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    inter = F.size(F.array_intersect("sa", "sb"))
    linked = both.where(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter))
    links = materialize(linked.select("a", "b"), "near-links")
    discard(likely, *([sets] if own_sets else []))
    return links


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, short: int = SHORT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text, any more columns).

    Null and empty texts have no shingles and a component of their own. Rows with the same set share a
    component, also rows repeated with one doc_id. Rows without a doc_id are linked with equal sets only, are
    never a component's smallest id (component_id is null if all of its rows lack one) and are never kept.
    """
    rows = materialize(sketches(docs, width), "near-sketches")
    reps = materialize(
        rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
        ),
        "near-nodes",
    )
    entries = reps.select("node", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    lists = entries.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    short_pairs = _pairs_within(entries.join(lists.where(F.col("size") <= short), "value"), "value", percent)

    crowded = (
        entries.join(lists.where(F.col("size") > short), "value")
        .groupBy("node").agg(F.count("*").alias("long"), F.first("n").alias("n"))
        .where(F.col("long") > F.least(F.lit(LONG_LISTS), F.floor(F.col("n") / 3)))
    )
    members = materialize(reps.join(crowded.select("node"), "node"), "near-crowded")
    keyed = materialize(_keyed(docs, members, width, percent), "near-keys")
    groups = keyed.groupBy("key").agg(
        F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("lead")
    ).where("size > 1")
    few_pairs = _pairs_within(keyed.join(groups.where(F.col("size") <= short).select("key"), "key"), "key", percent)
    large = materialize(keyed.join(groups.where(F.col("size") > short), "key"), "near-large")
    stars = large.where(F.col("node") != F.col("lead.node")).where(_fits(F.col("n"), F.col("lead.n"), percent)).select(
        F.col("lead.node").alias("a"), F.col("node").alias("b")
    )
    pairs = materialize(short_pairs.union(few_pairs).union(stars).distinct(), "near-pairs")
    discard(members, keyed)
    links = _verified(pairs, reps, percent, None, docs, width)
    discard(pairs)
    found = connected_components(links, "near-components")

    members = materialize(_open_members(large.select("key", "node", "n"), found), "near-open")
    discard(large)
    if members.limit(1).count():
        nodes = members.select("node").distinct().join(reps.select("node", "doc_id"), "node")
        sets = materialize(full_sets(docs, nodes, width), "near-open-sets")
        able = members.join(_common_counts(sets), "node").where(100 * F.col("common") >= percent * F.col("n"))
        able = materialize(able, "near-able")
        pairs = materialize(_to_leaders(able, percent), "near-pairs")
        led = _verified(pairs, reps, percent, sets, docs, width)
        rest = materialize(_outside_links(_still_outside(able, led, found), sets, percent), "near-links")
        discard(sets, able, pairs)
        found = connected_components(links.union(led).union(rest), "near-components")

    ids = reps.join(found.withColumnRenamed("component", "root"), "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root")
    )
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = ids.join(least, "root").select("node", "component_id")
    joined = rows.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def _open_members(large: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, n, component, main) of the members of groups with several components; main is the largest."""
    members = large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = parts.groupBy("key").agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
    return members.join(main.where("parts > 1").select("key", F.col("main.component").alias("main")), "key")


def _common_counts(sets: DataFrame) -> DataFrame:
    """(node, common): how many of a set's shingles any other set holds."""
    values = sets.select("node", F.explode("shingles").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    return values.join(shared.select("value"), "value", "left_semi").groupBy("node").agg(F.count("*").alias("common"))


def _to_leaders(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members outside their group's largest component with a few members of it."""
    x = members.where("component <> main").select("node", "n", "main").distinct()
    inside = members.where("component = main").select("main", "node", "n").distinct()
    drawn = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("o"), "node", "n")).alias(f"l{i}") for i in range(LEADERS)]
    leaders = inside.groupBy("main").agg(*drawn).select("main", F.explode(F.array(*(f"l{i}" for i in range(LEADERS)))).alias("lead"))
    return x.join(leaders, "main").where(_fits(F.col("n"), F.col("lead.n"), percent)).select(
        F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")
    ).distinct()


def _still_outside(members: DataFrame, led: DataFrame, found: DataFrame) -> DataFrame:
    """Members with outside: neither in their group's largest component nor linked with a leader of it."""
    ends = led.select("a", "b").union(led.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = ends.join(found.select(F.col("node").alias("b"), "component"), "b", "left")
    joined = ends.select(F.col("a").alias("node"), F.coalesce("component", "b").alias("main"), F.lit(True).alias("joined")).distinct()
    inside = (F.col("component") == F.col("main")) | F.coalesce("joined", F.lit(False))
    return members.join(joined, ["node", "main"], "left").withColumn("outside", ~inside)


def _intersections(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many values each set of x shares with each of y; sets are given by their lengths and values, one after another.

    The sets are rows of ones and zeros, with columns for the values that both sides hold, some of these at a time.
    """
    both = np.intersect1d(x[1], y[1])
    out = np.zeros((len(x[0]), len(y[0])), np.float32)
    entries = []
    for lengths, values in (x, y):
        at = np.searchsorted(both, values)
        there = np.flatnonzero(both[np.minimum(at, len(both) - 1)] == values) if len(both) else at[:0]
        there = there[np.argsort(at[there], kind="stable")]
        entries.append((np.repeat(np.arange(len(lengths)), lengths)[there], at[there]))
    for first in range(0, len(both), COLUMNS):
        width, sides = min(COLUMNS, len(both) - first), []
        for (row, column), n in zip(entries, out.shape, strict=True):
            i, j = np.searchsorted(column, [first, first + width])
            sides.append(np.zeros((n, width), np.float32))
            sides[-1][row[i:j], column[i:j] - first] = 1
        out += sides[0] @ sides[1].T
    return out


def _linked_in_blocks(percent: int):
    """Links (a, b) of a block of members outside (first) with a block of any members; each pair of outside ones once."""

    def run(rows: pa.Table) -> pa.Table:
        x, y = (rows.filter(rows["first"] if first else pc.invert(rows["first"])).combine_chunks() for first in (True, False))
        links = []
        if x.num_rows and y.num_rows:
            lists = [t["shingles"].combine_chunks() for t in (x, y)]
            (nx, ax), (ny, ay) = ((s.value_lengths().to_numpy().astype(np.int64), s.flatten().to_numpy()) for s in lists)
            inter = _intersections((nx, ax), (ny, ay)).astype(np.int64)
            linked = 100 * inter >= percent * (nx[:, None] + ny - inter)
            (of_x, in_x), (of_y, in_y) = ([t[c].to_pylist() for c in ("node", "component")] for t in (x, y))
            outside = y["outside"].to_pylist()
            for i, j in np.argwhere(linked).tolist():
                if in_x[i] != in_y[j] and (not outside[j] or of_x[i] < of_y[j]):
                    links.append((min(of_x[i], of_y[j]), max(of_x[i], of_y[j])))
        return pa.table({k: pa.array([link[i] for link in links], pa.binary()) for i, k in enumerate("ab")})

    return run


def _outside_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members outside a group's largest component and any others of the groups with that component.

    Both are dealt to blocks of bounded size, and every pair of blocks is a group of its own. Members whose counts of
    common shingles allow no link with any other are left out.
    """
    rows = members.groupBy("main", "node").agg(
        *(F.first(c).alias(c) for c in ("n", "component")), F.max("outside").alias("outside")
    )
    # of either kind as many blocks as its members or their shingles need
    parts = lambda rows, n: F.greatest(F.lit(1), F.ceil(F.greatest(rows / BLOCK_SETS, n / BLOCK_SHINGLES))).cast("int")
    out, n = F.col("outside").cast("long"), F.col("n")
    blocks = rows.groupBy("main").agg(
        F.sum(out).alias("some"), parts(F.sum(out), F.sum(out * n)).alias("xs"), parts(F.count("*"), F.sum(n)).alias("ys")
    ).where("some > 0").drop("some")
    block = lambda count: f"CAST(pmod(xxhash64(node), {count}) AS INT)"
    pairs = F.expr(f"""concat(
        transform(sequence(0, ys - 1), k -> named_struct('i', {block('xs')}, 'j', k, 'first', true)),
        transform(sequence(0, xs - 1), k -> named_struct('i', k, 'j', {block('ys')}, 'first', false)))""")
    dealt = rows.join(blocks, "main").select("main", "node", "component", "outside", F.explode(pairs).alias("at"))
    dealt = dealt.where("outside OR NOT at.first").select("main", "at.*", "node", "component", "outside")
    found = dealt.join(sets, "node").groupBy("main", "i", "j").applyInArrow(_linked_in_blocks(percent), "a binary, b binary")
    return found.distinct()


def keep(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that are kept, with all their columns: of each group the row with the smallest id.

    Of rows repeated with that id one stays. Rows without an id are kept, as no other row can stand for them.
    """
    found = near_duplicates(docs, width, percent).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.where("doc_id is not null")
    kept = named.join(found, named["doc_id"].cast("long") == found["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))
