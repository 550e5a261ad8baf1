"""Near-duplicate vectors by an epsilon grid order join (operator 12).

Vectors of cosine ``LEAST`` or more lie, scaled to length one, within ``epsilon = sqrt(2 - 2 LEAST)``.

1. Exact copies are grouped first, so a group of copies is one vector with a weight.
2. Principal directions come from the covariance of all vectors, added up by Spark. Vectors are
   sorted by their grid cells of width epsilon on the leading ``DIRECTIONS`` of them (the order of
   the sequence), and cut into blocks of at most ``BLOCK``. A block is a file in the shared folder
   and one row: its bounding box on those directions, its centre and its radius.
3. Blocks are leaves of a tree of sequence intervals, ``FAN`` children each. Starting with the root
   paired with itself, a pair of intervals is split into the pairs of their children, level by
   level, as joins. A pair whose boxes or balls are more than epsilon apart is dropped. A pair
   whose balls together lie within epsilon is linked as a whole and not split further, so a dense
   group costs about its number of blocks and not the square of its vectors.
4. The pairs of blocks that are left are compared with array code: single precision first, then
   double precision for what is near the limit. Each pair returns one row for each vector with
   links in it (their number, and the least vector reachable within the pair), never the links.
5. The numbers are added up; the classes are joined by alternating stars (``components``).

Where vectors fill many directions evenly, few blocks are provably distant and step 4 compares
most of them: the cost then grows with the square of the number of different vectors outside dense
groups, spread evenly over tasks.

A vector that is null, zero, of another length than most (of equally frequent lengths the greatest
counts), or that holds a null or non-finite component links with nothing. Repeated rows are vectors
each and link with each other. A null ``vec_id`` is never the least; a class of null ids has a null
component and is kept. Other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, files
from civicstream.llm.components import components

#: Least cosine of linked vectors.
LEAST = 0.95
#: Leading principal directions of the grid and of the boxes.
DIRECTIONS = 8
#: Vectors of a block, and children of an interval (powers of two).
BLOCK, FAN = 2048, 16
FAN_BITS = FAN.bit_length() - 1
#: Distances closer than this to epsilon are decided by comparing the vectors.
SLACK = 1e-6
#: Blocks that a task keeps in memory.
CACHED = 8
#: Copies of the row of a class, so that the members of a large class are dealt over tasks.
SALTS = 16


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; large and small ones without overflow."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _width(sized: DataFrame) -> int:
    top = (sized.groupBy("_size").agg(F.count(F.lit(1)).alias("_c"))
           .orderBy(F.desc("_c"), F.desc("_size")).limit(1).collect())
    return top[0]["_size"] if top else 0


def _prepared(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """id, v, h1, h2 (null where the vector links with nothing), and the number of components."""
    sized = vectors.select(F.col(key).alias("id"), F.col(column).alias("v"), F.size(column).alias("_size"))
    width = _width(sized.where("_size > 0"))
    proper = ((F.col("_size") == width) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
              & F.exists("v", lambda x: x != 0))
    out = sized.withColumn("v", F.when(proper, F.col("v")))
    return out.select("id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("h1"),
                      F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(12), "v")).alias("h2")), width


def _directions(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Leading principal directions of the unit vectors (columns), and the number of vectors."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(0), width))
                x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
                total += x.T @ x
        if total[-1, -1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)),
                                              pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": rows["i"].iloc[:1], "row": [np.sum(np.stack(rows["row"]), axis=0)]})

    schema = "i int, row array<double>"
    got = vectors.select("v").mapInArrow(part, schema).groupBy("i").applyInPandas(add, schema).collect()
    if not got:
        return np.zeros((width, 0)), 0
    total = np.array([r.row for r in sorted(got, key=lambda r: r.i)])
    n = total[-1, -1]
    mean = total[-1, :-1] / n
    values, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return axes[:, np.argsort(-values, kind="stable")[:DIRECTIONS]], int(n)


BLOCKS = ("pid int, i int, pos int, id long, n long, h1 long, h2 long, file string, "
          "lo array<double>, hi array<double>, centre array<double>, radius double")


def _blocks(groups: DataFrame, width: int, axes: np.ndarray, epsilon: float, parts: int) -> DataFrame:
    """One row per group of copies, in the order of the sequence; the first row of a block
    describes the block, whose vectors and weights are files."""
    spark = groups.sparkSession
    folder = common.shared_folder(spark, "vectors")
    cells = [f"c{k}" for k in range(axes.shape[1])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = np.floor(_unit(_matrix(batch.column("v"), width)) @ axes / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cell.T)],
                                                 [*batch.schema.names, *cells])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, i = [], 0, 0
        pid = TaskContext.get().partitionId()
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK), pid, i)
                held = table.slice(BLOCK).combine_chunks().to_batches()
                size, i = size - BLOCK, i + 1
        if size:
            yield block(pa.Table.from_batches(held), pid, i)

    def block(rows: pa.Table, pid: int, i: int) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        raw = _matrix(rows.column("v").chunk(0), width)
        unit = _unit(raw)
        on = unit @ axes
        centre = unit.mean(axis=0)
        name = files.attempt_name(f"{pid:06d}-{i:06d}")
        files.write(f"{folder}/{name}.vectors", raw.tobytes())
        files.write(f"{folder}/{name}.weights", rows.column("n").to_numpy().astype("<i8").tobytes())
        radius = float(np.sqrt(((unit - centre) ** 2).sum(axis=1).max()))
        n = rows.num_rows
        first = lambda value, kind: pa.array([value, *[None] * (n - 1)], kind)
        doubles = pa.list_(pa.float64())
        column = lambda name: rows.column(name).chunk(0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, i, np.int32)),
             pa.array(np.arange(n, dtype=np.int32)), column("id"), column("n"), column("h1"), column("h2"),
             first(f"{folder}/{name}", pa.string()), first(on.min(axis=0).tolist(), doubles),
             first(on.max(axis=0).tolist(), doubles), first(centre.tolist(), doubles), first(radius, pa.float64())],
            [x.split()[0] for x in BLOCKS.split(", ")])

    groups = groups.select("id", "n", "h1", "h2", "v")
    placed = groups.mapInArrow(place, common.schema_of(groups, groups.columns, ", ".join(f"{c} int" for c in cells)))
    ordered = placed.repartitionByRange(parts, *cells, "h1", "h2").sortWithinPartitions(*cells, "h1", "h2")
    return common.stored(ordered.select("id", "n", "h1", "h2", "v").mapInArrow(pack, BLOCKS), "vector-blocks")


def _squared(a: str, b: str) -> str:
    """SQL of the squared distance of two points."""
    return f"aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"


#: SQL of the distance of the boxes, and of the centres, of the intervals a and b.
BOX_GAP = ("sqrt(aggregate(zip_with(zip_with(a_lo, b_hi, (x, y) -> x - y), zip_with(b_lo, a_hi, (x, y) -> x - y), "
           "(x, y) -> greatest(x, y, 0D)), 0D, (s, x) -> s + x * x))")
CENTRES = f"sqrt({_squared('a_centre', 'b_centre')})"


def _joined_children(rows: pd.DataFrame) -> pd.DataFrame:
    """One interval from its children (``FAN`` at most)."""
    centres, n = np.stack(rows["centre"]), rows["n"].to_numpy(np.float64)
    centre = (centres * n[:, None]).sum(axis=0) / n.sum()
    radius = (np.sqrt(((centres - centre) ** 2).sum(axis=1)) + rows["radius"].to_numpy()).max()
    return pd.DataFrame({"node": rows["parent"].iloc[:1].to_numpy(), "lo": [np.min(np.stack(rows["lo"]), axis=0)],
                         "hi": [np.max(np.stack(rows["hi"]), axis=0)], "centre": [centre], "radius": [radius],
                         "n": [int(rows["n"].sum())], "first": [rows["first"].min()]})


def _interval_pairs(leaves: DataFrame, bits: int, epsilon: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of blocks a <= b to compare; pairs of intervals (level, a, b) that are linked as a
    whole). ``bits`` are those of a block's number."""
    tree = [leaves]
    for _ in range(max(1, -(-bits // FAN_BITS))):
        schema = tree[-1].schema
        tree.append(common.stored(
            tree[-1].withColumn("parent", F.shiftright("node", FAN_BITS)).groupBy("parent")
            .applyInPandas(_joined_children, schema), "intervals"))
    pairs = tree[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))       # the root, node 0
    whole = []
    for level in range(len(tree) - 2, -1, -1):
        side = tree[level].withColumn("parent", F.shiftright("node", FAN_BITS))

        def named(x: str) -> DataFrame:
            return side.select(F.col("parent").alias(f"{x}_parent"), F.col("node").alias(f"{x}_node"),
                               *(F.col(c).alias(f"{x}_{c}") for c in ("lo", "hi", "centre", "radius")))

        split = (pairs.select(F.col("a").alias("a_parent"), F.col("b").alias("b_parent"))
                 .join(named("a"), "a_parent").join(named("b"), "b_parent").where("a_node <= b_node"))
        apart = F.expr(CENTRES)
        measured = split.select(
            F.col("a_node").alias("a"), F.col("b_node").alias("b"),
            (apart + F.col("a_radius") + F.col("b_radius") <= epsilon - SLACK).alias("near"),
            ((F.expr(BOX_GAP) > epsilon + SLACK)
             | (apart - F.col("a_radius") - F.col("b_radius") > epsilon + SLACK)).alias("distant"))
        kept = common.stored(measured.where("not distant").drop("distant"), "interval-pairs")
        whole.append(kept.where("near").select(F.lit(level).alias("level"), "a", "b"))
        pairs = kept.where("not near").select("a", "b")
    together = whole[0]
    for more in whole[1:]:
        together = together.unionByName(more)
    return pairs, together


class _Block:
    """The vectors of a block as they are compared."""

    def __init__(self, file: str, n: int, kind: str):
        self.unit = _unit(np.frombuffer(files.read(f"{file}.vectors"), kind).reshape(n, -1))
        self.single = self.unit.astype(np.float32)
        self.weight = np.frombuffer(files.read(f"{file}.weights"), "<i8").astype(np.float64)


def _links(a: _Block, b: _Block, same: bool, least: float) -> np.ndarray:
    """Which vectors of a and b are linked."""
    rough = a.single @ b.single.T
    error = max(1e-5, 4e-7 * a.unit.shape[1])
    linked = rough >= least - error
    i, j = np.nonzero(linked & (rough <= least + error))
    if len(i):
        linked[i, j] = np.einsum("ij,ij->i", a.unit[i], b.unit[j]) >= least
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _classes(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns that have links, and the number of the class of each."""
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    part = linked[np.ix_(rows, columns)]
    of_row, of_column = np.full(len(rows), -1), np.full(len(columns), -1)
    for start in range(len(rows)):
        if of_row[start] >= 0:
            continue
        of_row[start] = start
        front = np.array([start])
        while len(front):
            reached = np.flatnonzero(part[front].any(axis=0) & (of_column < 0))
            of_column[reached] = start
            front = np.flatnonzero(part[:, reached].any(axis=1) & (of_row < 0))
            of_row[front] = start
    return rows, columns, of_row, of_column


FOUND = "node long, links long, root long"


def _compared(pairs: DataFrame, least: float, kind: str) -> DataFrame:
    """node, links, root for every vector with links in a pair of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: OrderedDict[int, _Block] = OrderedDict()

        def block(number: int, file: str, n: int) -> _Block:
            if number not in cache:
                if len(cache) >= CACHED:
                    cache.popitem(last=False)
                cache[number] = _Block(file, n, kind)
            cache.move_to_end(number)
            return cache[number]

        for batch in batches:
            for r in batch.to_pylist():
                a, b = block(r["a"], r["a_file"], r["a_n"]), block(r["b"], r["b_file"], r["b_n"])
                linked = _links(a, b, r["a"] == r["b"], least)
                rows, columns, of_row, of_column = _classes(linked)
                if not len(rows):
                    continue
                node = np.concatenate([rows + r["a"] * BLOCK, columns + r["b"] * BLOCK])
                of = np.concatenate([of_row, of_column])
                links = np.concatenate([linked[rows] @ b.weight, a.weight @ linked[:, columns]])
                root = np.full(len(rows), np.iinfo(np.int64).max)
                np.minimum.at(root, of, node)
                n = len(rows) if r["a"] == r["b"] else len(node)     # both sides of one block are the same
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[:n]), pa.array(links[:n].astype(np.int64)), pa.array(root[of][:n])],
                    ["node", "links", "root"])
        common.release()

    return pairs.mapInArrow(run, FOUND)


def _linked_whole(nodes: DataFrame, intervals: DataFrame, whole: DataFrame, levels: list[int]) -> DataFrame:
    """node, links, root for the vectors of intervals that are linked as a whole."""
    out = []
    for level in levels:
        up = F.shiftright("node", int(math.log2(BLOCK)) + FAN_BITS * level)
        at = (nodes.groupBy(up.alias("interval")).agg(F.sum("n").alias("weight"), F.min("node").alias("first")))
        pairs = whole.where(F.col("level") == level).select("a", "b")
        both = pairs.unionByName(pairs.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        other = both.join(at, F.col("b") == F.col("interval")).select("a", "b", "weight", "first")
        out.append(nodes.withColumn("a", up).join(other, "a").select(
            "node", (F.col("weight") - F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(F.lit(0))).alias("links"),
            F.least("first", "node").alias("root")))
    return out


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", least: float = LEAST) -> DataFrame:
    """One row per vector: ``key``, n_links, component_id, kept."""
    common.require(vectors, key, column)
    spark = common.prepare(vectors.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    epsilon = math.sqrt(2 - 2 * least)
    rows, width = _prepared(vectors, key, column)
    proper = rows.where("v is not null")
    axes, count = _directions(proper, width)
    if not count:
        return _result(rows.withColumn("links", F.lit(0)).withColumn("least", F.col("id")), key)
    kind = "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"
    proper = proper if kind == "<f4" else proper.withColumn("v", F.col("v").cast("array<double>"))
    groups = proper.groupBy("h1", "h2").agg(F.min("id").cast("long").alias("id"), F.count(F.lit(1)).alias("n"),
                                            F.first("v").alias("v"))
    parts = max(1, min(-(-count // (4 * BLOCK)), 8 * common.partitions(spark)))
    listed = _blocks(groups, width, axes, epsilon, parts)
    most = listed.agg(F.max("i"), F.max("pid")).head()
    inner = int(most[0]).bit_length()
    bits = inner + int(most[1]).bit_length()
    listed = listed.withColumn("block", F.shiftleft(F.col("pid").cast("long"), inner) + F.col("i"))
    nodes = listed.select((F.col("block") * BLOCK + F.col("pos")).alias("node"), "id", "n", "h1", "h2")
    leaves = (listed.where("pos = 0").select(F.col("block").alias("node"), "lo", "hi", "centre", "radius",
                                             F.lit(1).cast("long").alias("n"), (F.col("block") * BLOCK).alias("first")))
    pairs, whole = _interval_pairs(leaves, bits, epsilon)
    file = listed.groupBy("block").agg(F.max("file").alias("file"), F.count(F.lit(1)).cast("int").alias("size"))
    side = lambda x: file.select(F.col("block").alias(x), F.col("file").alias(f"{x}_file"), F.col("size").alias(f"{x}_n"))
    n_pairs = pairs.count()
    tasks = max(1, min(n_pairs, common.partitions(spark) * max(1, n_pairs // (64 * common.partitions(spark)))))
    ready = pairs.join(side("a"), "a").join(side("b"), "b").repartitionByRange(tasks, "a", "b").sortWithinPartitions("a", "b")
    levels = [r.level for r in whole.select("level").distinct().collect()]             # levels of the tree
    found = _compared(ready, least, kind)
    for more in _linked_whole(nodes, leaves, whole, levels):
        found = found.unionByName(more)
    found = common.stored(found, "vector-links")
    return _result(_classified(rows, nodes, found), key)


def _classified(rows: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """id, links, least of every row."""
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b"))
    classed = (nodes.join(links, "node", "left").join(classes, "node", "left")
               .select("node", "id", "n", "h1", "h2", F.coalesce("links", F.lit(0)).alias("links"),
                       F.coalesce("root", "node").alias("root"), F.col("links").isNotNull().alias("some")))
    some = classed.where("some")
    salt = F.array([F.lit(s) for s in range(SALTS)])
    least = some.groupBy("root").agg(F.min("id").alias("least")).select("root", "least", F.explode(salt).alias("salt"))
    named = (some.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(least, ["root", "salt"])
             .select("h1", "h2", "n", "links", "least"))
    alone = classed.where("not some").select("h1", "h2", "n", "links", F.col("id").alias("least"))
    named = named.unionByName(alone).select("h1", "h2", (F.col("links") + F.col("n") - 1).alias("links"), "least",
                                            F.lit(True).alias("proper"))
    return rows.select("id", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "id", F.coalesce("links", F.lit(0)).alias("links"),
        F.when(F.col("proper"), F.col("least")).otherwise(F.col("id")).alias("least"))


def _result(rows: DataFrame, key: str) -> DataFrame:
    same: Column = F.col("id").eqNullSafe(F.col("least"))
    return rows.select(F.col("id").alias(key), F.col("links").cast("long").alias("n_links"),
                       F.col("least").cast("long").alias("component_id"), same.alias("kept"))
