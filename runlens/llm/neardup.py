"""Near duplicates by a chosen-path similarity join over sets of 5-word shingles.

Equal sets form a class first. Every class has a signature of minwise tokens. In each of several trees a
class follows the tokens at a few chosen coordinates of its signature, on average 1 + EXTRA branches per
node, so a pair at the threshold keeps meeting while unlike pairs part; `miss_chance` tells how often one never
does, and the number of trees follows from it. Nodes of few classes are compared exhaustively. In a larger node
all classes are compared with two leaders, one drawn and one with the least share of shingles of its own. If it still
holds more than one component, whatever is outside its main component is compared with the whole node, each pair
in the first node that both are in; beyond REST classes the node branches on instead, by several coordinates at a
time, until the last level. Classes of one component are never paired again.
Two bounds of the overlap from above leave out pairs without loss: shingles that no other class of a large node has
cannot be shared, and of the shingles in a hash bucket no more can be than the lesser set has there. Candidates pass a lower bound on equal signature coordinates, five
standard deviations below what the threshold gives, and links are confirmed on the full sets.

Defined results: text that is null, empty or only white space has an empty set and is linked with nothing.
Rows of the same doc_id are one document that has all links of its texts. Rows without a doc_id are left
out. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.components import components
from runlens.llm.shared import SMALL_BATCH, broadcast_if_small, map_arrow, stored
from runlens.llm.shingles import mix, shingles_of_rows

COORDINATES = 64
LEAF = 12
# Buckets of the sketches that bound the overlap of two sets.
BUCKETS = 128
# Classes of a node up to which what its leaders left apart is compared at once; larger nodes branch on.
REST = 4096
# Shingles that a worker sums up at a time, and those that a task meets at a time.
SUMMED = 1 << 16
MET = 250_000
# Branches of a node beyond the first, on average, and the chance to miss a pair at the threshold that sets the trees.
EXTRA = 0.45
MISS = 5e-5
# Coordinates that each level below the first adds to a path.
STEPS = (3, 4)

_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_XOR, _ODD = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | _U(1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, sets in shingles_of_rows(batch.column("text")):
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            filled = np.flatnonzero(sizes)
            signature = np.zeros((len(sets), COORDINATES), dtype="<u4")
            first, second = np.zeros(len(sets), dtype=_U), np.zeros(len(sets), dtype=_U)
            if len(filled):
                values = np.concatenate([sets[i] for i in filled])
                begins = np.cumsum(sizes[filled]) - sizes[filled]
                for j in range(COORDINATES):
                    lowest = np.minimum.reduceat((values ^ _XOR[j]) * _ODD[j], begins)
                    signature[filled, j] = lowest >> _U(32)
                first[filled] = np.add.reduceat(mix(values), begins)
                second[filled] = np.add.reduceat(mix(values + _ODD[0]), begins)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, end - start),
                    pa.array(sizes),
                    pa.array(first.view(np.int64)),
                    pa.array(second.view(np.int64)),
                    pa.array([row.tobytes() for row in signature], pa.binary()),
                ],
                names=["doc_id", "n", "d1", "d2", "signature"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, sets in shingles_of_rows(batch.column("text")):
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, _U), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(start, end - start), pa.ListArray.from_arrays(offsets, pa.array(values))],
                names=["id", "shingles"],
            )


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of each set lie in each hash bucket."""
    for batch in batches:
        sets = batch.column("shingles")
        owner = np.repeat(np.arange(len(sets)), np.asarray(sets.value_lengths()))
        bucket = np.asarray(sets.flatten()) & (BUCKETS - 1)
        counts = np.bincount(owner * BUCKETS + bucket, minlength=len(sets) * BUCKETS).astype(np.int32)
        lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BUCKETS, pa.array(counts))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "sketch"])


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, id, holders): how many of some sets hold a shingle, and the id of one of those."""
    for batch in batches:
        ids, sets = np.asarray(batch.column("id")), batch.column("shingles")
        ends = np.cumsum(np.asarray(sets.value_lengths()))
        start = 0
        while start < len(sets):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + SUMMED, side="right")))
            part = sets.slice(start, end - start)
            values, at, holders = np.unique(np.asarray(part.flatten()), return_index=True, return_counts=True)
            one = ids[start + np.searchsorted(ends[start:end] - before, at, side="right")]
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(one), pa.array(holders)], names=["shingle", "id", "holders"])
            start = end


def _agreeing(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, COORDINATES) for c in ("sa", "sb")
            )
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(axis=1) >= least))

    return run


def _token(signature: str, coordinate: Column) -> Column:
    return F.substr(F.col(signature), coordinate * 4 + 1, F.lit(4))


def miss_chance(similarity: float, trees: int) -> float:
    """Chance that a pair meets in no node of the last level of any tree, whatever the sizes of the nodes.

    The pair agrees at some of the coordinates; roots have coordinates of their own, and below each agreeing root
    the nodes that hold both are a branching process. A pair that is compared at an earlier level is not missed.
    """
    roots, generations, missed = _root_count(trees), sum(STEPS), 0.0
    for equal in range(COORDINATES + 1):
        share, over = equal / COORDINATES, 0.0
        for _ in range(generations):
            over = (1 - share + share * over) * (1 - EXTRA * share + EXTRA * share * over)
        drawn = range(max(0, roots - (COORDINATES - equal)), min(equal, roots) + 1)
        none = sum(math.comb(equal, k) * math.comb(COORDINATES - equal, roots - k) * over**k for k in drawn)
        missed += math.comb(COORDINATES, equal) * similarity**equal * (1 - similarity) ** (COORDINATES - equal) * none
    return missed / math.comb(COORDINATES, roots)


def _root_count(trees: int) -> int:
    return min(COORDINATES, trees + math.ceil(trees * EXTRA))


def trees_for(threshold: float) -> int:
    """The least number of trees that misses pairs at the threshold no more often than MISS."""
    return next((t for t in range(1, COORDINATES + 1) if miss_chance(threshold, t) <= MISS), COORDINATES)


def _roots(classes: DataFrame, trees: int) -> DataFrame:
    """First level of every tree, each with coordinates of its own; every class is a component so far."""
    chosen = [(c % trees, c) for c in range(_root_count(trees))]
    nodes = [F.xxhash64(F.lit(tree), F.lit(c), _token("signature", F.lit(c))) for tree, c in chosen]
    return classes.select(F.explode(F.array(*nodes)).alias("node"), "id", F.col("id").alias("root"))


def _branches(members: DataFrame, classes: DataFrame, steps: int) -> DataFrame:
    """Descendants of nodes, `steps` generations down.

    In each generation a node goes on with one chosen coordinate, and a share of the nodes with a second.
    """
    rows = members.select("node", "id", "root").join(classes.select("id", "signature"), "id")
    nodes = F.array("node")
    for _ in range(steps):
        nodes = F.flatten(F.transform(nodes, _children))
    return rows.select(F.explode(nodes).alias("node"), "id", "root")


def _children(node: Column) -> Column:
    one = F.pmod(F.xxhash64(node, F.lit("one")), F.lit(COORDINATES)).cast("int")
    two = F.pmod(F.xxhash64(node, F.lit("two")), F.lit(COORDINATES)).cast("int")
    more = F.pmod(F.xxhash64(node, F.lit("more")), F.lit(1_000_000)) < int(EXTRA * 1_000_000)
    chosen = F.array_distinct(F.when(more, F.array(one, two)).otherwise(F.array(one)))
    return F.transform(chosen, lambda c: F.xxhash64(node, c, _token("signature", c)))


def _members(nodes: DataFrame) -> DataFrame:
    """Rows of nodes that hold more than one component, with the node's size."""
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size"), (F.min("root") < F.max("root")).alias("mixed"))
    return stored(nodes.join(sizes.where("mixed").drop("mixed"), "node"), "nodes")


def _small_pairs(members: DataFrame) -> DataFrame:
    """All pairs of different components in the nodes that hold LEAF classes at most."""
    small = members.where(F.col("size") <= LEAF).groupBy("node").agg(F.collect_list(F.struct("id", "root")).alias("held"))
    pairs = small.select("held", F.explode("held").alias("one"))
    others = F.filter("held", lambda b: (b["id"] > F.col("one.id")) & (b["root"] != F.col("one.root")))
    return pairs.select(F.col("one.id").alias("a"), F.explode(F.transform(others, lambda b: b["id"])).alias("b")).distinct()


def _led_pairs(members: DataFrame, common: DataFrame, join: _Join) -> DataFrame:
    """Every class of a larger node with the node's leaders, where bounds allow a link.

    One leader has the least hash of all, so that nodes of the same classes mostly have the same one; the other has
    the greatest share of common shingles.
    """
    large = members.where(F.col("size") > LEAF).join(common, "id")
    one = F.struct("id", "root", "n", "common")
    leaders = large.groupBy("node").agg(
        F.min_by(one, F.xxhash64("id")).alias("first"), F.max_by(one, F.struct(F.col("common") / F.col("n"), F.xxhash64("id"))).alias("central")
    )
    led = large.join(leaders, "node")
    led = led.select("id", "root", "n", "common", F.col("first").alias("leader")).union(led.select("id", "root", "n", "common", F.col("central").alias("leader")))
    allowed = join.overlap_allows("common", "leader.common", "n", "leader.n") & join.sizes_allow("n", "leader.n")
    led = led.where((F.col("root") != F.col("leader.root")) & allowed)
    return led.select(F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b")).distinct()


class _Join:
    """Confirms candidate pairs; only classes with a close candidate get their full sets, once per level."""

    def __init__(self, docs: DataFrame, classes: DataFrame, percent: int):
        self.docs, self.classes, self.percent = docs, classes, percent
        threshold = percent / 100
        spread = math.sqrt(threshold * (1 - threshold) / COORDINATES)
        self.least = max(1, math.floor(COORDINATES * (threshold - 5 * spread)))

    def sets(self, ids: DataFrame, rows: int) -> DataFrame:
        texts = self.docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        texts = texts.join(broadcast_if_small(ids, rows), "id")
        return stored(map_arrow(texts, _sets, "id long, shingles array<bigint>", SMALL_BATCH), "sets")

    def common(self, members: DataFrame) -> DataFrame:
        """(id, n, common): for classes of larger nodes, how many shingles some other of them has too."""
        ids = stored(members.where(F.col("size") > LEAF).select("id").distinct(), "ids")
        n_ids = ids.count()
        sets = self.sets(ids, n_ids)
        self.large_sets = sets
        n_shingles = self.classes.join(broadcast_if_small(ids, n_ids), "id").agg(F.sum("n")).first()[0]
        own = self.held_alone(sets, n_shingles or 0).groupBy("id").agg(F.count(F.lit(1)).alias("own"))
        # Rows of one id count together: its least set with all their common shingles is a bound for each.
        sizes = sets.groupBy("id").agg(F.min(F.size("shingles")).alias("n"), F.sum(F.size("shingles")).alias("all"))
        joined = sizes.join(own, "id", "left")
        return stored(joined.select("id", "n", (F.col("all") - F.coalesce("own", F.lit(0))).alias("common")), "common")

    def held_alone(self, sets: DataFrame, n_shingles: int) -> DataFrame:
        """(shingle, id, holders) of the shingles that one set alone has.

        Nearly all shingles are of one set, so a table of them in every task that reads sets would hold what it reads
        without making it less. Workers sum up a part of the sets, and then tasks meet a bounded share of the shingles.
        """
        rows = map_arrow(sets, _holders, "shingle long, id long, holders long", SMALL_BATCH)
        rows = rows.repartition(max(1, math.ceil(n_shingles / MET)), "shingle")
        return rows.groupBy("shingle").agg(F.min("id").alias("id"), F.sum("holders").alias("holders")).where("holders = 1")

    def overlap_allows(self, common_a, common_b, n_a, n_b) -> Column:
        """Whether a pair that shares all its common shingles would reach the threshold."""
        most = F.least(F.col(common_a), F.col(common_b)) * (100 + self.percent)
        return most >= (F.col(n_a) + F.col(n_b)) * self.percent

    def sketches(self) -> DataFrame:
        """(id, sketch) of the classes of larger nodes; of an id with several texts the greatest counts."""
        each = map_arrow(self.large_sets, _sketches, "id long, sketch array<int>", SMALL_BATCH).groupBy("id").agg(F.collect_list("sketch").alias("all"))
        most = lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y))
        return each.select("id", F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(F.reduce("all", F.get("all", F.lit(0)), most)).alias("sketch"))

    def sketches_allow(self, sketch_a, sketch_b, n_a, n_b) -> Column:
        most = F.reduce(F.zip_with(sketch_a, sketch_b, lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
        return most * (100 + self.percent) >= (F.col(n_a) + F.col(n_b)) * self.percent

    def sizes_allow(self, n_a, n_b) -> Column:
        return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * self.percent

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and signatures allow."""
        held = self.classes.select("id", "n", "signature")
        for side in "ab":
            held_side = held.toDF(side, f"n{side}", f"s{side}")
            pairs = pairs.join(held_side, side)
        pairs = pairs.where(self.sizes_allow("na", "nb")).select("a", "b", "sa", "sb")
        return stored(map_arrow(pairs, _agreeing(self.least), "a long, b long", SMALL_BATCH), "close")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b) among candidate pairs, by their full sets."""
        close = self.close(pairs.distinct())
        ids = close.select(F.col("a").alias("id")).distinct().union(close.select("b").distinct()).distinct()
        sets = self.sets(ids, 2 * close.count())
        both = close.select("a", "b").join(sets.toDF("b", "right"), "b").join(sets.toDF("a", "left"), "a")
        shared = F.size(F.array_intersect("left", "right"))
        union = F.size("left") + F.size("right") - F.col("shared")
        found = both.select("a", "b", "left", "right", shared.alias("shared"))
        return stored(found.where(F.col("shared") * 100 >= union * self.percent).select("a", "b"), "confirmed")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: they join the components so far, as a graph of those."""
    if links.isEmpty():
        return roots
    for side in "ab":
        links = links.join(roots.toDF(side, f"root_{side}"), side, "left")
        links = links.withColumn(side, F.coalesce(f"root_{side}", side)).drop(f"root_{side}")
    over = components(links).toDF("over", "top")
    old = roots.join(over, roots["root"] == over["over"], "left").select("id", F.coalesce("top", "root").alias("root"))
    new = over.join(roots, over["over"] == roots["id"], "left_anti").select(F.col("over").alias("id"), F.col("top").alias("root"))
    return stored(old.union(new), "roots")


def _mixed(members: DataFrame, roots: DataFrame, common: DataFrame, join: _Join) -> DataFrame:
    """Classes of larger nodes that hold more than one component, with the component and the size left.

    Classes whose common shingles are too few for any partner in the node are left out.
    """
    large = members.where(F.col("size") > LEAF).select("node", "id").join(common, "id").join(roots, "id", "left")
    large = large.select("node", "id", "n", "common", F.coalesce("root", "id").alias("root"))
    least = large.groupBy("node").agg(F.min("n").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("n") * join.percent / 100))
    able = F.col("common") * (100 + join.percent) >= (F.col("n") + partner) * join.percent
    large = large.join(least, "node").where(able).drop("least")
    several = large.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size")).where("low <> high")
    return stored(large.join(several.select("node", "size"), "node"), "mixed")


def _rest(mixed: DataFrame, join: _Join) -> DataFrame:
    """Pairs of everything outside a node's main component with the node's other classes, by overlap bound.

    Two classes that share several nodes are paired in the first of those.
    """
    counts = mixed.groupBy("node", "root").agg(F.count(F.lit(1)).alias("rows"))
    main = counts.groupBy("node").agg(F.max_by("root", F.struct("rows", "root")).alias("main"))
    rows = mixed.join(main, "node")
    # Only outside the main component of one of its nodes is a class paired; those nodes are listed.
    listed = rows.groupBy("id").agg(F.collect_set("node").alias("nodes"), F.collect_set(F.when(F.col("root") != F.col("main"), F.col("node"))).alias("outer"))
    rows = stored(rows.join(listed, "id").join(join.sketches(), "id"), "rest")
    columns = ("id", "root", "n", "common", "nodes", "outer", "sketch")
    outside = rows.where("root <> main").select("node", *[F.col(c).alias(f"{c}_a") for c in columns])
    others = rows.select(F.col("node").alias("node_b"), "main", *[F.col(c).alias(f"{c}_b") for c in columns])
    meets = (F.col("node") == F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    # Of two classes outside the main component one side is enough.
    once = (F.col("root_b") == F.col("main")) | (F.col("id_a") < F.col("id_b"))
    both = F.array_union(F.array_intersect("outer_a", "nodes_b"), F.array_intersect("outer_b", "nodes_a"))
    first = F.array_min(both) == F.col("node")
    allowed = join.overlap_allows("common_a", "common_b", "n_a", "n_b") & join.sizes_allow("n_a", "n_b")
    pairs = outside.join(others, meets & once & allowed & first & join.sketches_allow("sketch_a", "sketch_b", "n_a", "n_b"))
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; sets link at `percent` similarity."""
    threshold = percent / 100
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    signed = stored(map_arrow(rows, _sign, "doc_id long, n long, d1 long, d2 long, signature binary", SMALL_BATCH), "signed")
    classes = signed.where("n > 0").groupBy("n", "d1", "d2")
    classes = stored(classes.agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")), "classes")
    join = _Join(docs, classes, percent)
    roots = docs.sparkSession.createDataFrame([], "id long, root long")
    nodes, common = _roots(classes, trees_for(threshold)), None
    for steps in (*STEPS, 0):
        members = _members(nodes)
        large = not members.where(F.col("size") > LEAF).isEmpty()
        pairs = _small_pairs(members)
        if large:
            common = join.common(members) if common is None else common
            pairs = pairs.union(_led_pairs(members, common, join))
        roots = _joined(roots, join.confirmed(pairs))
        if not large:
            break
        mixed = _mixed(members, roots, common, join)
        now = mixed.where(F.col("size") <= REST) if steps else mixed
        roots = _joined(roots, join.confirmed(_rest(now, join)))
        larger = mixed.where(F.col("size") > REST)
        if not steps or larger.isEmpty():
            break
        nodes = _branches(larger, classes, steps)
    named = classes.drop("signature").join(roots, "id", "left")
    named = named.select("n", "d1", "d2", F.coalesce("root", "id").alias("root"))
    placed = signed.drop("signature").join(named, ["n", "d1", "d2"], "left")
    found = placed.groupBy("doc_id").agg(
        F.max("n").alias("n_shingles"), F.min(F.coalesce("root", "doc_id")).alias("component_id")
    )
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def one_of_each(docs: DataFrame, percent: int) -> DataFrame:
    """The rows of `docs` without all but the first document of each component, with all columns.

    Rows without a doc_id stay. Of rows that share a doc_id the one with the least text stays.
    """
    gone = stored(near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias("gone_id")), "gone")
    gone = broadcast_if_small(gone, gone.count())
    rows = docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
    ids = docs.select(F.col("doc_id").cast("long").alias("again_id")).where("again_id IS NOT NULL")
    again = stored(ids.groupBy("again_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("again_id"), "again")
    if again.isEmpty():
        return rows
    single = rows.join(again, rows["doc_id"].cast("long") == again["again_id"], "left_anti")
    several = rows.join(again, rows["doc_id"].cast("long") == again["again_id"], "left_semi")
    place = "place"
    while place in (c.lower() for c in docs.columns):
        place += "_"
    first = F.row_number().over(Window.partitionBy(F.col("doc_id").cast("long")).orderBy("text"))
    return single.union(several.withColumn(place, first).where(F.col(place) == 1).drop(place))
