"""Sharding: block transfers by minimum-cost flow that move the fewest bytes from old shards to new ones.

Documents lie in old shards. New shards have capacities in bytes. A flow network (source, old shards, new shards,
sink) with cost 0 for bytes that stay in their shard and 1 for each byte that moves gives how many bytes go from
where to where. Each old shard consists of blocks (rows by a hash of their place in the input's files, so that neither
null nor repeated ids make a block large); whole blocks are dealt to the new shards along the flow, the largest first,
and a local search evens out what the blocks' sizes leave over. Then the affected shards are written, in one shuffle
of their rows, to a folder of a new version: each file holds consecutive slots of one shard, and nothing that lies in
the old folder is touched.

The driver sees only the sizes of blocks: at most ``blocks`` rows, however large the table is.

Nulls: a null text has no bytes, a null id is an id like any other. Repeated rows and equal ids are rows of their own.
An empty table gives no rows. All columns of the input are written; the columns of the place (shard, slot) get a leading
underscore, or more, if the input has columns of these names.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeshift.llm.common import checkpointed, documents, row_place, shared_dir

ROW_BYTES, FILE_BYTES = 16, 128 << 20


def capacities(total: int, shards: int) -> list[int]:
    """Equal capacities that add up to the total."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def min_cost_flow(supply: list[int], demand: list[int]) -> dict[tuple[int, int], int]:
    """Bytes for each (old, new) shard, at the least number of bytes moved; supplies and demands have the same sum.

    Successive shortest paths with node potentials (Dijkstra on reduced costs) over the residual network.
    """
    n, m = len(supply), len(demand)
    source, sink = n + m, n + m + 1
    arcs: list[list] = []  # head, capacity left, cost
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(tail: int, head: int, most: int, cost: int) -> None:
        out[tail].append(len(arcs))
        arcs.append([head, most, cost])
        out[head].append(len(arcs))
        arcs.append([tail, 0, -cost])

    for i, s in enumerate(supply):
        arc(source, i, s, 0)
        for j in range(m):
            arc(i, n + j, s, int(i != j))
    for j, d in enumerate(demand):
        arc(n + j, sink, d, 0)
    potential = [0] * (n + m + 2)
    while True:
        far = [float("inf")] * (n + m + 2)
        via, far[source], queue = [-1] * (n + m + 2), 0, [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for k in out[u]:
                v, left, cost = arcs[k]
                if left and (to := d + cost + potential[u] - potential[v]) < far[v]:
                    far[v], via[v] = to, k
                    heapq.heappush(queue, (to, v))
        if far[sink] == float("inf"):
            break
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, far, strict=True)]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
    return {(i, arcs[k][0] - n): arcs[k ^ 1][1] for i in range(n) for k in out[i] if n <= arcs[k][0] < n + m and not k & 1 and arcs[k ^ 1][1]}


def deal_blocks(blocks: list[tuple[int, int, int]], flow: dict[tuple[int, int], int], want: list[int]) -> dict[tuple[int, int], int]:
    """(old, block) to new shard. blocks: (old, block, bytes). Along the flow, then a local search towards ``want``."""
    left = dict(flow)
    targets: dict[int, list[int]] = {}
    for i, j in flow:
        targets.setdefault(i, []).append(j)
    to, total = {}, [0] * len(want)
    held: list[dict[tuple[int, int], int]] = [{} for _ in want]
    for old, block, size in sorted(blocks, key=lambda b: (b[0], -b[2], b[1])):
        j = max(targets.get(old, [old % len(want)]), key=lambda j: (left.get((old, j), 0), j == old, -j))
        left[old, j] = left.get((old, j), 0) - size
        total[j] += size
        to[old, block] = j
        held[j][old, block] = size
    for _ in range(20 * len(want) + 200):
        over = max(range(len(want)), key=lambda j: total[j] - want[j])
        under = min(range(len(want)), key=lambda j: total[j] - want[j])
        gap = (total[over] - want[over]) - (total[under] - want[under])
        # blocks that have left their shard first: they cost nothing more
        best = min(((k[0] == over, abs(gap / 2 - s), k) for k, s in held[over].items() if 0 < s < gap), default=None)
        if best is not None:
            key = best[2]
            give, take = held[over].pop(key), 0
            held[under][key] = give
            to[key] = under
        else:  # no single block helps: exchange two whose sizes differ by less than the gap
            mine = sorted((s, k) for k, s in held[over].items())
            others = sorted((s, k) for k, s in held[under].items())
            found, at = None, 0
            for s, k in mine:
                while at < len(others) and others[at][0] < s - gap / 2:
                    at += 1
                for t, o in others[max(0, at - 1) : at + 1]:
                    if 0 < s - t < gap and (found is None or abs(gap / 2 - (s - t)) < found[0]):
                        found = (abs(gap / 2 - (s - t)), k, o, s, t)
            if found is None:
                break
            _, key, other, give, take = found
            del held[over][key], held[under][other]
            held[under][key], held[over][other] = give, take
            to[key], to[other] = under, over
        total[over] += take - give
        total[under] += give - take
    return to


def free_name(name: str, taken: list[str]) -> str:
    """The name, with as many underscores before it as no column has."""
    while name.lower() in {c.lower() for c in taken}:
        name = "_" + name
    return name


def with_places(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a hash of each row's place, the same whenever it is read: its file and its number in it.

    Rows that don't come straight from files are written to the checkpoint folder first.
    """
    name, place = free_name("_place", docs.columns), row_place(docs)
    if place is not None:
        return docs.withColumn(name, place), name
    return checkpointed(docs.withColumn(name, F.xxhash64(F.monotonically_increasing_id()))), name


@dataclass
class Plan:
    """Where each row goes: rows holds docs with the row's old shard and block, place the block's new shard and first slot."""

    rows: DataFrame
    place: DataFrame
    columns: list[str]
    old: str
    block: str
    row: str
    bytes_of: list[int]
    changed: list[int]
    moved: int

    @property
    def shard(self) -> str:
        return free_name("shard", self.columns)

    @property
    def slot(self) -> str:
        return free_name("slot", self.columns)

    def placed(self, file_bytes: int = FILE_BYTES) -> DataFrame:
        """docs with their old shard (_old_shard), shard and slot; rows of a shard lie together, in pieces of about a file."""
        return slotted(self, self.rows, file_bytes)


def slotted(plan: Plan, rows: DataFrame, file_bytes: int) -> DataFrame:
    place = F.broadcast(plan.place)  # at most `blocks` rows
    x = rows.join(place, [plan.old, plan.block])
    # as many parts as files of about that size; a block lies in one part
    x = x.withColumn("_part", F.floor(F.col("_bytes_before") / file_bytes))
    parts = max(1, min(sum(b // file_bytes + 1 for b in plan.bytes_of), 100_000))
    by = ["_new_shard", "_part"]
    order = Window.partitionBy(*by, plan.old, plan.block).orderBy(plan.row)
    x = x.repartition(parts, *by).withColumn("_in_block", F.row_number().over(order))
    return x.select(*plan.columns, F.col(plan.old).alias("_old_shard"), F.col("_new_shard").alias(plan.shard), (F.col("_before") + F.col("_in_block") - 1).alias(plan.slot))


def plan_transfers(docs: DataFrame, old_shard: Column, shards: int, blocks: int = 16384, text_col: str = "text") -> Plan:
    """The transfers that move the fewest bytes and leave shards of equal bytes; blocks: a bound of what the driver sees."""
    spark, columns = docs.sparkSession, docs.columns
    rows, row = with_places(docs)
    old, block, size = (free_name(n, rows.columns) for n in ("_old", "_block", "_size"))
    rows = rows.withColumn(old, old_shard.cast("int"))
    size_of = (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")
    olds = (rows.agg(F.max(old)).first()[0] or 0) + 1
    rows = rows.withColumn(block, F.pmod(F.col(row), F.lit(max(1, blocks // olds))).cast("int"))
    sizes = rows.groupBy(F.col(old).alias("old"), F.col(block).alias("block")).agg(F.sum(size_of).alias("bytes"), F.count("*").alias("n")).collect()
    supply = [0] * olds
    for r in sizes:
        supply[r.old] += r.bytes
    want = capacities(sum(supply), shards)
    to = deal_blocks([(r.old, r.block, r.bytes) for r in sizes], min_cost_flow(supply, want), want)
    taken, filled, places = [0] * shards, [0] * shards, []
    for r in sorted(sizes, key=lambda r: (r.old, r.block)):
        j = to[r.old, r.block]
        places.append((r.old, r.block, j, taken[j], filled[j]))
        taken[j] += r.n
        filled[j] += r.bytes
    schema = T.StructType([T.StructField(c, t) for c, t in ((old, T.IntegerType()), (block, T.IntegerType()), ("_new_shard", T.IntegerType()), ("_before", T.LongType()), ("_bytes_before", T.LongType()))])
    leaving = [r for r in sizes if to[r.old, r.block] != r.old]
    changed = sorted({k for r in leaving for k in (r.old, to[r.old, r.block])})
    return Plan(rows, spark.createDataFrame(places, schema), columns, old, block, row, filled, changed, sum(r.bytes for r in leaving))


def rewrite(plan: Plan, out: str, file_bytes: int = FILE_BYTES) -> list[int]:
    """Writes the shards whose rows change as Parquet below ``out`` (shard=N/), which must not exist yet; returns them.

    Shards that aren't in the list keep their files where they are.
    """
    affected = plan.place.where(F.col("_new_shard").isin(plan.changed))
    some = Plan(plan.rows, affected, plan.columns, plan.old, plan.block, plan.row, [b if k in set(plan.changed) else 0 for k, b in enumerate(plan.bytes_of)], plan.changed, plan.moved)
    slotted(some, some.rows, file_bytes).write.partitionBy(plan.shard).parquet(out)
    return plan.changed


#: The layout before: documents by a checksum of their id in so many shards.
OLD_SHARDS, NEW_SHARDS = 32, 40


def op7_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from 32 shards (crc32 of the id) into 40 of equal bytes; slots are gapless in each shard.

    The affected shards are written to a new folder beside the checkpoints, and what comes back is read from there; rows
    of shards that stay as they are (if any) come from the plan.
    """
    docs = documents(spark, sf_dir)
    old = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    plan = plan_transfers(docs.select("doc_id", "text"), old, NEW_SHARDS)
    out = f"{shared_dir(spark)}/reshard-{uuid.uuid4().hex}"
    changed = rewrite(plan, out)
    kept = plan.placed() if len(changed) < NEW_SHARDS else None
    rows = spark.read.schema("doc_id long, text string, _old_shard int, slot long, shard int").parquet(out) if changed else None
    if kept is not None:
        stay = kept.where(~F.col("shard").isin(changed))
        rows = stay if rows is None else rows.unionByName(stay)
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("_old_shard").alias("old_shard"),
    )
