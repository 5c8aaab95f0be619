"""Dependencies as edges: closures, owners of internal objects, and depth by foreign keys.

Everything is an iteration over frames: from the given objects outwards, one step a round while rounds are few, then by
paths that double in length, so that a chain of n edges takes about log2(n) rounds. No path is ever listed.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.plans.frames import checkpointed

#: Rounds of single steps before paths are doubled; foreign keys that one machine may order.
NEAR, MOST_KEYS = 6, 2_000_000


def _shortest(pairs: DataFrame, *keys: str) -> DataFrame:
    return checkpointed(pairs.groupBy(*keys).agg(F.min("depth").alias("depth")))


def _joined(reached: DataFrame, hops: DataFrame) -> DataFrame:
    h = hops.select(F.col("src").alias("obj"), F.col("dst").alias("_to"), F.col("depth").alias("_more"))
    return reached.join(h, "obj").select("root", F.col("_to").alias("obj"), (F.col("depth") + F.col("_more")).cast("int").alias("depth"))


def _size(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum("depth")).first())


def closure(edges: DataFrame, starts: DataFrame | None = None, near: int = NEAR) -> DataFrame:
    """(root, obj, depth): what is reached from each start (obj; else each src) of edges (src, dst), at its least depth; itself at 0."""
    hops = checkpointed(edges.select("src", "dst").distinct().withColumn("depth", F.lit(1)))
    first = (hops.select(F.col("src").alias("obj")) if starts is None else starts.select("obj")).distinct()
    known = new = checkpointed(first.select(F.col("obj").alias("root"), "obj", F.lit(0).alias("depth")))
    for _ in range(near):
        new = checkpointed(_joined(new, hops).distinct().join(known.select("root", "obj"), ["root", "obj"], "left_anti"))
        if new.isEmpty():
            return known
        known = checkpointed(known.unionByName(new))
    size = _size(known)
    while True:
        known = _shortest(known.unionByName(_joined(known, hops)), "root", "obj")
        before, size = size, _size(known)
        if size == before:  # nothing nearer or further by any hop, edges among them
            return known
        longer = _joined(hops.select(F.col("src").alias("root"), F.col("dst").alias("obj"), "depth"), hops)
        hops = _shortest(hops.unionByName(longer.select(F.col("root").alias("src"), F.col("obj").alias("dst"), "depth")), "src", "dst")


def internal_roots(edges: DataFrame) -> DataFrame:
    """Objects that have internal ones and are internal to none (edges: src, dst, deptype)."""
    inside = edges.where("deptype = 'i'")
    return inside.join(inside.select(F.col("dst").alias("src")), "src", "left_anti").select(F.col("src").alias("obj")).distinct()


def outer_objects(edges: DataFrame) -> DataFrame:
    """Objects at either end of normal and automatic edges, but for those that own internal ones."""
    ends = edges.where(F.col("deptype").isin("n", "a")).select(F.explode(F.array("src", "dst")).alias("obj"))
    return ends.subtract(internal_roots(edges))


def owners(edges: DataFrame) -> DataFrame:
    """(obj, owner): what each object is internal to in the end, if anything."""
    return closure(edges.where("deptype = 'i'"), internal_roots(edges)).select("obj", F.col("root").alias("owner"))


def remapped(edges: DataFrame) -> DataFrame:
    """Normal and automatic edges (src, dst, deptype) between owners: an end with several owners is each of them."""
    plain = edges.where(F.col("deptype").isin("n", "a")).select("src", "dst", "deptype").distinct()
    ends = plain.select("*", F.posexplode(F.array("src", "dst")).alias("side", "obj")).join(owners(edges), "obj", "left")
    name = F.coalesce("owner", "obj")
    sides = ends.groupBy("src", "dst", "deptype").agg(*[F.collect_set(F.when(F.col("side") == k, name)).alias(f"_{k}") for k in (0, 1)])
    pairs = sides.select("deptype", "_1", F.explode("_0").alias("src")).select("src", F.explode("_1").alias("dst"), "deptype")
    return pairs.where("src <> dst").distinct()


def foreign_key_depth(constraints: DataFrame) -> DataFrame:
    """(relid, depth): the longest chain of foreign keys (conrelid, confrelid) from tables that refer to none.

    Tables are placed once all that they refer to are. Where a cycle leaves none, the least table that refers to a placed
    one comes next; cycles that refer to nothing outside have no depth. The constraints of a catalog are ordered on the
    driver, which a count allows first.
    """
    keys = constraints.where("conrelid <> confrelid").select("conrelid", "confrelid").distinct()
    if keys.count() > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} foreign keys in a catalog")
    refers, referred = defaultdict(set), defaultdict(set)
    for r in keys.collect():
        refers[r.conrelid].add(r.confrelid)
        referred[r.confrelid].add(r.conrelid)
    left = {t: len(to) for t, to in refers.items()}
    depth, ready, touched = {}, [t for t in referred if t not in refers], set()
    near = dict.fromkeys(ready, 0)
    while ready or touched:
        if not ready:
            ready = [min(touched)]
        t = ready.pop()
        if t in depth:
            continue
        touched.discard(t)
        depth[t] = near[t]
        for u in referred[t]:
            if u in depth:
                continue
            near[u] = max(near.get(u, 0), depth[t] + 1)
            left[u] -= 1
            if left[u]:
                touched.add(u)
            else:
                touched.discard(u)
                ready.append(u)
    kind = dict(constraints.dtypes)["conrelid"]
    return constraints.sparkSession.createDataFrame(list(depth.items()), f"relid {kind}, depth int")


def dependents_of(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """Everything that depends on the given objects (obj), themselves included: what a filter also leaves out."""
    return closure(edges, objects).select("obj").distinct()
