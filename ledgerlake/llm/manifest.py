"""A Merkle manifest of a data set, whose leaves find their places by ranks in bitmaps.

Every row is a leaf: the digest of its columns. Leaves of one group (a language, say) ascend by id; ARITY of them at a time become a
node, level by level, down to the group's root; the groups' roots, in order of the groups, likewise become the root of all.

No leaf is sorted. Ids are split into a high part and 16 low bits. The low parts of each (group, high part) are gathered as a compressed
bitmap: a sorted list while that is smaller, else 8 KB of bits. Tasks make bitmaps of what they read, which are merged. Their popcounts
are summed upwards over shorter and shorter prefixes of the id, and a directory gives each bitmap the number of leaves
before it; siblings under one prefix are 65,536 at most, so no step sees more than that at once. A rank query, the directory's number
plus the popcount of the bitmap's bits before the id, is the leaf's place. Places are then keys: BLOCK consecutive leaves are one array of slots, which a task
reduces to one node while it remembers nothing else; nodes are reduced likewise until one is left in each group. What stands beside a leaf's
path is found in its own block and, for all above, once for each block.

Defined results: a null column is `-`, a text its byte count, a colon and itself, a number its decimal digits in that form; rows that share
group and id ascend by leaf, equal rows (equal leaves) are leaves of their own, next to each other; rows without id come before the others of
their group; the null group comes before the others, which ascend by their UTF-8 bytes; a lone leaf is its group's root, and a lone
group's root is the root of all; an empty table has no rows; further columns take no part, whatever their names. Rows that share an
id with different leaves, and numbers of equal rows, are placed by ranges of (group, id, leaf), so a hot id is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.storage import prepare, stored

#: Nodes that become one, and levels that a block of slots spans.
ARITY, LEVELS = 2, 10
#: Equal rows that one task spreads out.
COPIES = 1 << 16
#: Bits of a bitmap; ids in it up to which a sorted list is smaller.
BITS = 1 << 16
FEW = BITS // 16
#: Ids that a task holds before it passes its bitmaps on.
HELD = 1 << 20


def digest(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(column: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value; whole numbers as decimal digits."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


# Bitmaps ---------------------------------------------------------------------------------------------------------------


def packed(low: np.ndarray) -> bytes:
    """Distinct sorted low parts as a list of 16-bit numbers, or as bits where that is smaller."""
    if len(low) < FEW:
        return low.astype(np.uint16).tobytes()
    bits = np.zeros(BITS, np.uint8)
    bits[low] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < BITS // 8:
        return np.frombuffer(data, np.uint16).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def ranks(data: bytes, low: np.ndarray) -> np.ndarray:
    """How many of the bitmap's ids are below each low part: a lookup in popcounts of 64-bit words, and one in the word."""
    if len(data) < BITS // 8:
        return np.searchsorted(np.frombuffer(data, np.uint16), low.astype(np.uint16), "left")
    words = np.frombuffer(data, np.uint64)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    inside = words[low >> 6] & ((np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1))
    return before[low >> 6] + np.bitwise_count(inside).astype(np.int64)


_LONGS = pa.list_(pa.int64())
#: n: leaves; again, times: low parts of ids that several leaves share, and how many do.
_MAP = pa.schema([("tree", pa.int64()), ("high", pa.int64()), ("n", pa.int64()), ("map", pa.binary()), ("again", _LONGS), ("times", _LONGS)])
_MAP_DDL = "tree long, high long, n long, map binary, again array<long>, times array<long>"


def _map_row(tree: int, high: int, low: np.ndarray, times: np.ndarray) -> tuple:
    several = np.flatnonzero(times > 1)
    return tree, high, int(times.sum()), packed(low), low[several].tolist(), times[several].tolist()


def _map_rows(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(_MAP), _MAP, strict=True)]


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of the (tree, id) that a task reads."""
    held: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        tree, ids = np.concatenate(held, axis=1)
        held.clear()
        order = np.lexsort((ids, tree))
        tree, ids = tree[order], ids[order]
        new = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (ids[1:] != ids[:-1])))
        times, tree, ids = np.diff(np.append(new, len(ids))), tree[new], ids[new]
        high = ids >> 16
        first = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (high[1:] != high[:-1])))
        ends = np.append(first[1:], len(ids))
        return pa.RecordBatch.from_arrays(_map_rows([_map_row(int(tree[a]), int(high[a]), ids[a:b] & 0xFFFF, times[a:b]) for a, b in zip(first, ends, strict=True)]), schema=_MAP)

    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([batch.column("tree").to_numpy(), batch.column("id").to_numpy()]))
        if sum(h.shape[1] for h in held) > HELD:
            yield out()
    if held:
        yield out()


def _by_key(rows: pa.Table) -> dict[tuple[int, int], list[int]]:
    out: dict[tuple[int, int], list[int]] = {}
    for k, key in enumerate(zip(rows["tree"].to_pylist(), rows["high"].to_pylist(), strict=True)):
        out.setdefault(key, []).append(k)
    return out


def _merged(rows: pa.Table) -> pa.Table:
    """One bitmap of all that tasks made of each (tree, high)."""
    maps, again, times = (rows[c].to_pylist() for c in ("map", "again", "times"))
    out = []
    for (tree, high), places in _by_key(rows).items():
        counts = np.zeros(BITS, np.int64) if len(places) > 1 else None
        for k in places:
            low = unpacked(maps[k])
            own = np.ones(len(low), np.int64)
            own[np.searchsorted(low, again[k])] = times[k]
            if counts is not None:
                counts[low] += own
        if counts is not None:
            low = np.flatnonzero(counts)
            own = counts[low]
        out.append(_map_row(tree, high, low, own))
    return pa.Table.from_arrays(_map_rows(out), schema=_MAP)


_RANKED = pa.schema([("tree", pa.int64()), ("id", pa.int64()), ("leaf", pa.string()), ("other", pa.string()), ("start", pa.int64())])


def _ranked(ids: pa.Table, maps: pa.Table) -> pa.Table:
    """The ids of some (tree, high) with the number of leaves before; every id is in its bitmap."""
    start = np.zeros(ids.num_rows, np.int64)
    of = {key: places[0] for key, places in _by_key(maps).items()}
    data, again, times, before = (maps[c].to_pylist() for c in ("map", "again", "times", "before"))
    own = ids["id"].to_numpy()
    for key, places in _by_key(ids).items():
        k, low = of[key], own[places] & 0xFFFF
        more = np.concatenate([[0], np.cumsum(np.array(times[k], np.int64) - 1)])
        start[places] = before[k] + ranks(data[k], low) + more[np.searchsorted(np.array(again[k], np.int64), low)]
    return pa.Table.from_arrays([*(ids[c] for c in ("tree", "id", "leaf", "other")), pa.array(start)], schema=_RANKED)


def directory(maps: DataFrame, without: DataFrame) -> DataFrame:
    """maps (tree, high, n, ...): with `before`, the leaves of the tree below the bitmap; `without` (tree, without) stand before all.

    Counts are summed for ever shorter prefixes of the id; at each length a running sum over the siblings under the next shorter
    prefix, 65,536 at most, is added to what stands before that prefix.
    """
    level = maps.select("tree", F.col("high").alias("p0"), "n")
    levels = []
    for k in range(3):  # the 48 high bits, 16 at a time
        order = Window.partitionBy("tree", f"p{k + 1}").orderBy(f"p{k}").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn(f"p{k + 1}", F.shiftright(f"p{k}", 16))
        levels.append(level.select("tree", f"p{k}", f"p{k + 1}", F.coalesce(F.sum("n").over(order), F.lit(0)).alias(f"b{k}")))
        level = level.groupBy("tree", f"p{k + 1}").agg(F.sum("n").alias("n"))
    # What is left of an id is 0 or -1: ids from zero on, and those below it.
    order = Window.partitionBy("tree").orderBy("p3").rowsBetween(Window.unboundedPreceding, -1)
    out = level.select("tree", "p3", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("b3"))
    out = out.join(without, "tree").select("tree", "p3", (F.col("b3") + F.col("without")).alias("before"))
    for k in (2, 1, 0):
        out = levels[k].join(out, ["tree", f"p{k + 1}"]).select("tree", f"p{k}", (F.col("before") + F.col(f"b{k}")).alias("before"))
    return maps.join(out.withColumnRenamed("p0", "high"), ["tree", "high"])


# Places ----------------------------------------------------------------------------------------------------------------


def _running(rows: DataFrame, order: list[str], count: str) -> DataFrame:
    """`total`: the sum of `count` over all rows before, in that order: sums of range partitions first, then within each."""
    parts = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part").agg(F.sum(count).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))  # a row a partition
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.join(F.broadcast(sums), "part").withColumn("total", F.col("begin") + F.coalesce(F.sum(count).over(inside), F.lit(0))).drop("part", "begin")


def placed(leaves: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """leaves (tree, none, id, leaf, other; none: without id) -> tree, none, id, leaf, other, place in the tree from 0."""
    bucket = F.pmod(F.xxhash64("tree", "high"), F.lit(-(-total // BITS)))  # some 65,536 ids each, however the ids lie
    maps = leaves.filter("not none").select("tree", "id").mapInArrow(_bitmaps, _MAP_DDL)
    maps = stored(maps.groupBy(bucket.alias("bucket")).applyInArrow(_merged, _MAP_DDL), "bitmaps")
    several = stored(maps.filter(F.size("again") > 0).select("tree", "high", F.explode(F.arrays_zip("again", "times")).alias("x")), "several")
    several = several.select("tree", F.lit(False).alias("none"), F.shiftleft("high", 16).bitwiseOR(F.col("x.again")).alias("id"))
    several = several.unionByName(sizes.filter("without > 0").select("tree", F.lit(True).alias("none"), F.lit(0).cast("long").alias("id")))
    exist = not several.isEmpty()
    asked = leaves.join(several, ["tree", "none", "id"], "left_anti") if exist else leaves
    text = F.lit(None).cast("string")
    asked = asked.select("tree", "id", "leaf", "other")
    if exist:
        asked = asked.unionByName(several.filter("not none").select("tree", "id", text.alias("leaf"), text.alias("other")))
    asked = asked.withColumn("high", F.shiftright("id", 16)).withColumn("bucket", bucket)
    at = directory(maps, sizes.select("tree", "without")).withColumn("bucket", bucket)
    found = asked.groupBy("bucket").cogroup(at.groupBy("bucket")).applyInArrow(_ranked, "tree long, id long, leaf string, other string, start long")
    if not exist:
        return found.select("tree", F.lit(False).alias("none"), "id", "leaf", "other", F.col("start").alias("place"))
    found = stored(found, "ranks")
    single = found.filter("leaf is not null").select("tree", F.lit(False).alias("none"), "id", "leaf", "other", F.col("start").alias("place"))
    first = found.filter("leaf is null").select("tree", F.lit(False).alias("none"), "id", "start")
    first = first.unionByName(several.filter("none").select("tree", "none", "id", F.lit(0).cast("long").alias("start")))
    # Leaves under one id: equal ones are one row, reduced before the shuffle; different ones in order, ranges of them side by side.
    kinds = leaves.join(several, ["tree", "none", "id"], "left_semi").groupBy("tree", "none", "id", "leaf", "other").agg(F.count("*").alias("n"))
    kinds = stored(_running(kinds, ["tree", "none", "id", "leaf"], "n"), "kinds")
    origin = kinds.groupBy("tree", "none", "id").agg(F.min("total").alias("origin")).join(first, ["tree", "none", "id"])
    kinds = kinds.join(origin, ["tree", "none", "id"]).withColumn("start", F.col("start") + F.col("total") - F.col("origin"))
    # Equal rows are spread out in two steps, so that very many of them do not come out of one task.
    many = F.lit(COPIES).cast("long")
    some = kinds.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, many))).repartition("tree", "start", "at")
    spread = some.withColumn("k", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + many, "n") - 1)))
    return single.unionByName(spread.select("tree", "none", "id", "leaf", "other", (F.col("start") + F.col("k")).alias("place")))


# Levels ----------------------------------------------------------------------------------------------------------------

SLOTS = ARITY**LEVELS


def height(size: int) -> int:
    """Levels above `size` nodes."""
    out = 0
    while size > 1:
        size, out = -(-size // ARITY), out + 1
    return out


def levels(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes and n levels above them; the last run of a level may be short."""
    out = [nodes]
    for _ in range(n):
        nodes = [digest(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
        out.append(nodes)
    return out


def beside(all_levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """Of a slot's path: what stands to the left and to the right of it, level by level."""
    out = []
    for nodes in all_levels[:-1]:
        begin = slot - slot % ARITY
        out.append(("".join(nodes[begin:slot]), "".join(nodes[slot + 1 : begin + ARITY])))
        slot //= ARITY
    return out


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = digest([left, leaf, right])
    return leaf


_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_PATH_DDL = "array<struct<left: string, right: string>>"


def _slots(nodes: DataFrame) -> DataFrame:
    """tree, block, size and an array of slots: what stands at SLOTS places that follow each other."""
    own = F.struct(F.pmod("place", F.lit(SLOTS)).alias("slot"), *(c for c in nodes.columns if c not in ("tree", "place", "size")))
    return nodes.groupBy("tree", F.expr(f"place div {SLOTS}").alias("block"), "size").agg(F.sort_array(F.collect_list(own)).alias("slots"))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node above each block."""
    for batch in batches:
        size = batch.column("size").to_pylist()
        top = [levels(nodes, min(LEVELS, height(n)))[-1][0] for nodes, n in zip(batch.column("nodes").to_pylist(), size, strict=True)]
        above = [max(1, -(-n // SLOTS)) for n in size]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(above, pa.int64()), pa.array(top, pa.string())], names=["tree", "place", "size", "node"])


def _above(blocks: DataFrame, name: str) -> DataFrame:
    rows = blocks.select("tree", "block", "size", F.col(f"slots.{name}").alias("nodes"))
    return stored(rows.mapInArrow(_roots, "tree long, place long, size long, node string"), "nodes")


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every node of the blocks: its path in the block and on."""
    for batch in batches:
        for row in batch.to_pylist():
            own = levels(row["nodes"], min(LEVELS, height(row["size"])))
            n, on = len(row["nodes"]), [(p["left"], p["right"]) for p in row["path"]]
            path = [[dict(zip(("left", "right"), p, strict=True)) for p in beside(own, k) + on] for k in range(n)]
            columns = [pa.array([row["tree"]] * n, pa.int64()), pa.array(range(row["block"] * SLOTS, row["block"] * SLOTS + n), pa.int64()), pa.array(path, _PATH), pa.array([row["top"]] * n, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "place", "path", "top"])


def paths(nodes: DataFrame) -> DataFrame:
    """nodes (tree, place, size, node; size: nodes of the tree) -> tree, place, path to the tree's top, top."""
    if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
        return nodes.select("tree", "place", F.array().cast(_PATH_DDL).alias("path"), F.col("node").alias("top"))
    blocks = stored(_slots(nodes), "blocks", long_rows=True)
    on = paths(_above(blocks, "node")).withColumnRenamed("place", "block")
    rows = blocks.select("tree", "block", "size", F.col("slots.node").alias("nodes")).join(on, ["tree", "block"])
    return stored(rows.mapInArrow(_paths, f"tree long, place long, path {_PATH_DDL}, top string"), "paths")


_PROOF = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            slots, on = row["slots"], [(p["left"], p["right"]) for p in row["path"]]
            own = levels([s["leaf"] for s in slots], min(LEVELS, height(row["size"])))
            out = []
            for k, s in enumerate(slots):
                path = beside(own, k) + on
                siblings = digest([x for p in path for x in p])
                out.append((None if s["none"] else s["id"], s["leaf"], row["subroot"], row["root"], siblings, folded(s["other"] or s["leaf"], path)))
            kinds = [pa.int64()] + [pa.string()] * 5
            names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def manifest(rows: DataFrame, id: Column, group: Column, columns: list[Column], tampered: list[Column] | None = None, where: Column | None = None) -> DataFrame:
    """A row for each of rows: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    `columns` make the leaf. Where `where` holds, the root is recomputed from a leaf of the columns `tampered` instead; the siblings stay.
    """
    spark = rows.sparkSession
    prepare(spark)
    other = F.when(where, leaf_of(tampered)) if tampered is not None and where is not None else F.lit(None).cast("string")
    leaves = rows.select(group.cast("string").alias("group"), id.isNull().alias("none"), F.coalesce(id.cast("long"), F.lit(0)).alias("id"), leaf_of(columns).alias("leaf"), other.alias("other"))
    leaves = stored(leaves, "leaves")
    counts = leaves.groupBy("group").agg(F.count("*").alias("size"), F.count_if("none").alias("without"))
    trees = stored(_running(counts.withColumn("one", F.lit(1)), ["group"], "one").withColumnRenamed("total", "tree"), "trees")  # null comes first
    n_trees, total = trees.agg(F.count("*"), F.sum("size")).first()
    if not n_trees:
        return spark.createDataFrame([], f"{_PROOF}, verified boolean")
    known = trees.select(F.col("group").alias("g"), "tree")
    leaves = leaves.join(known, F.col("group").eqNullSafe(F.col("g"))).select("tree", "none", "id", "leaf", "other")
    sizes = trees.select("tree", "size")
    blocks = placed(leaves, trees.select("tree", "without"), total).join(sizes, "tree")
    blocks = stored(_slots(blocks), "leaf_blocks", long_rows=True)
    on = paths(_above(blocks, "leaf"))
    tops = on.select("tree", "top").distinct()
    up = paths(stored(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n_trees).cast("long").alias("size"), F.col("top").alias("node")), "subroots"))
    up = up.select(F.col("place").alias("tree"), F.col("path").alias("further"), F.col("top").alias("root"))
    on = on.join(up, "tree").select("tree", F.col("place").alias("block"), F.concat("path", "further").alias("path"), F.col("top").alias("subroot"), "root")
    proofs = blocks.join(on, ["tree", "block"]).mapInArrow(_proofs, _PROOF)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
