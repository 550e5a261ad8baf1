"""Near-duplicate documents by SetSketch registers (operator 10).

A document is the set of its distinct 4-word shingles; two documents are linked when their
intersection is at least ``threshold`` of their union. Every register is a truncated logarithm
of the minimum of exponential variables over the set (base ``B``), so registers of parts merge
by maximum and agree in two sets about as often as the sets are similar.

1. Registers of every document; documents of equal sets become one class.
2. Bands of registers name buckets. In each bucket the member that shares most buckets with
   others is compared with the rest (a star, never all pairs of a bucket).
3. Pairs whose registers make the threshold implausible (likelihood over the register
   comparisons, given the set sizes) go; the others are verified on their full sets.
4. Members of a bucket outside of its largest component so far are compared with all members of
   other components, block by block: first by how many shingles each shares with anyone at all
   (an exact bound that clears most copies with many changes of their own), then on a finer
   sketch; the plausible pairs are verified in the same task on their full sets, the likeliest
   first. Sets are memory-mapped files in the shared folder, so they are not shipped with every
   bucket. A pair that is connected already, directly or through others, is not compared, and a
   task returns a link for each two components that it joins, never all pairs.

A pair of similarity 0.8 misses all 21 bands of 3 registers with a probability of 3e-7.

Null text and text without words: empty set, linked with nothing. Fewer than four words: the
whole sequence is the one shingle. Repeated rows are copies of each other. The component id is
the smallest non-null document id of the component, null if there is none. Empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, files, hashstore, textscan
from civicstream.llm.components import components

SHINGLE = 4
BANDS, ROWS = 21, 3
REGISTERS = BANDS * ROWS
#: Parameters of the registers: base, rate of the exponential variables, largest register.
B, RATE, TOP = 1.001, 20.0, 2**16 - 1
#: Log-likelihood that a pair may fall short of the best similarity and still be verified; a true
#: link falls short by more with a probability of about 3e-5.
SLACK = 8.0
#: Members of a bucket whose registers are compared with those of another block at once.
BLOCK = 256

#: Further registers, of one byte each, of the documents that share a bucket with others.
FINE = 512

_rng = np.random.Generator(np.random.PCG64(11))
_XOR = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE = _rng.integers(0, 2**63, FINE, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct shingle hashes of each text, one text after another; counts)."""
    buf, offsets = common.text_buffer(column)
    buf = textscan.LOWER[buf]
    start, end, owner = textscan.spans(buf, offsets, textscan.NOT_SPACE)
    h = textscan.span_hash(textscan.prefix_sums(buf), start, end)
    n = len(column)
    words = textscan.counts_of(owner, n)
    begin = np.cumsum(words) - words
    parts = []
    g, first = textscan.grams(h, owner, size)
    edges = np.searchsorted(owner[first], np.arange(n + 1))
    short: dict[int, np.uint64] = {}
    for k in range(1, size):
        gk, fk = textscan.grams(h, owner, k)
        mine = (words[owner[fk]] == k) & (fk == begin[owner[fk]])
        short |= dict(zip(owner[fk[mine]].tolist(), textscan.mix(gk[mine] + np.uint64(k))))
    for i in range(n):
        own = np.sort(g[edges[i]:edges[i + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif not len(own) and i in short:
            own = np.array([short[i]], np.uint64)
        parts.append(own)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64),
            np.array([len(p) for p in parts], np.int64))


def registers(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Registers (uint16) of non-empty sets that follow one another."""
    start = np.cumsum(counts) - counts
    least = np.empty((len(counts), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        v = shingles ^ _XOR[i]
        v *= _ODD[i]
        v ^= v >> np.uint64(32)
        v *= _ODD[-1 - i]
        least[:, i] = np.minimum.reduceat(v, start)
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(B)), 0, TOP).astype(np.uint16)


def sketches(docs: DataFrame, keep: list[str], text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """_k (hash of the kept columns and the text), the kept columns, n_shingles, _h1 and _h2
    (hashes of the set, null if it is empty), _regs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                sets, counts = shingle_sets(rows.column("_text"), size)
                full = np.flatnonzero(counts)
                h1, h2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
                regs = [None] * len(counts)
                if len(full):
                    start = (np.cumsum(counts) - counts)[full]
                    h1[full] = np.add.reduceat(sets, start)
                    h2[full] = np.add.reduceat(textscan.mix(sets ^ _XOR[0]), start)
                    for i, r in zip(full.tolist(), registers(sets, counts[full])):
                        regs[i] = r.tobytes()
                none = counts == 0
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ["_k", *keep]), pa.array(counts),
                     pa.array(h1.view(np.int64), mask=none), pa.array(h2.view(np.int64), mask=none),
                     pa.array(regs, pa.binary())], ["_k", *keep, "n_shingles", "_h1", "_h2", "_regs"])

    source = _keyed(docs, keep, text_col)
    schema = common.schema_of(source, keep, "n_shingles long, _h1 long, _h2 long, _regs binary")
    return source.mapInArrow(run, f"_k long, {schema}")


def _keyed(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    return docs.select(F.xxhash64(*keep, text_col).alias("_k"), *keep,
                       common.utf8_text(text_col).alias("_text"))


def _sets(docs: DataFrame, wanted: hashstore.Store, keep: list[str], text_col: str, size: int) -> DataFrame:
    """_k, _set (ascending hashes) of the wanted documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = wanted.has(batch.column("_k").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(hit))
            for rows in common.slices(batch, "_text"):
                sets, counts = shingle_sets(rows.column("_text"), size)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_k"), common.binary_column(sets, np.concatenate([[0], np.cumsum(counts)]) * 8)],
                    ["_k", "_set"])

    return _keyed(docs, keep, text_col).select("_k", "_text").mapInArrow(run, "_k long, _set binary")


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the registers (rows of two matrices) of sets of these sizes leave a similarity of
    ``threshold`` plausible, by the joint likelihood of how many registers are larger, equal and
    smaller."""
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - larger - smaller
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)

    def p(x):
        return np.clip(-np.log1p(-x * (B - 1) / B) / np.log(B), 1e-12, 1)

    def log_likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))

    best, enough = np.full(len(u), -np.inf), np.full(len(u), -np.inf)
    for j in np.linspace(0, 1, 101):
        value = log_likelihood(np.minimum(j, most))
        best = np.maximum(best, value)
        enough = np.where(np.minimum(j, most) >= threshold - 1e-9, np.maximum(enough, value), enough)
    return enough >= best - SLACK


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are links, by their full sets."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("sa", "sb"))
            linked = [_linked(x, y, percent) for x, y in zip(sa, sb)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return (pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a").select("a", "b", "sa", "sb")
            .mapInArrow(verify, "a long, b long"))


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """_k, _id, n_shingles, root (of the component, null without shingles), component_id of every
    row of ``docs`` (_id, _t)."""
    common.prepare(docs.sparkSession)
    signed = common.stored(sketches(docs, ["_id"], "_t", size), "sketches")
    classes = common.stored(
        signed.where("_h1 is not null").groupBy("_h1", "_h2")
        .agg(F.min("_id").alias("least_id"), F.min("_k").alias("_k"), F.first("n_shingles").alias("n"),
             F.first("_regs").alias("_regs"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    roots = components(_links(docs, classes, size, percent))
    rooted = classes.join(roots, classes.cid == roots.node, "left").select(
        "_h1", "_h2", "least_id", F.coalesce("root", "cid").alias("root"))
    component = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(component, "root").select("_h1", "_h2", "root", "component_id")
    return signed.join(named, ["_h1", "_h2"], "left").select(
        "_k", "_id", "n_shingles", "root",
        F.when(F.col("_h1").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = 80) -> DataFrame:
    """``id_col``, n_shingles, component_id, kept (whether the document's id is the component's)
    of every document. ``id_col`` must be an integer."""
    common.require(docs, id_col, text_col)
    out = _grouped(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), size, percent)
    return out.select(F.col("_id").alias(id_col), "n_shingles", "component_id",
                      F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 percent: int = 80) -> DataFrame:
    """One row of each component, that of the smallest document id (of several rows with that id,
    the one of the smallest hash), with all its columns; rows without shingles stay."""
    common.require(docs, id_col, text_col)
    rows = common.stored(_grouped(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), size, percent)
                         .where("root is not null").select("_k", "_id", "root"), "grouped")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_k")).alias("m"))
    # a row is told by its id and a hash of id and text together
    mine = (F.col("_k") == F.col("m._k")) & F.col("_id").eqNullSafe(F.col("m._id"))
    judged = rows.join(first, "root").groupBy("_k", "_id").agg(
        F.max(mine).alias("first"), F.count(F.lit(1)).alias("times"))
    judged = common.stored(judged.where("not first or times > 1"), "judged").alias("j")
    keyed = docs.withColumn("_k", F.xxhash64(id_col, text_col)).alias("d")
    same = (F.col("d._k") == F.col("j._k")) & F.col(f"d.{id_col}").eqNullSafe(F.col("j._id"))
    kept = keyed.join(judged.where("not first"), same, "left_anti")
    repeated = judged.where("first")
    if not repeated.isEmpty():
        kept = (kept.join(repeated, same, "left_anti").unionByName(
            kept.join(repeated, same, "left_semi").dropDuplicates(["_k", id_col])))
    return kept.select(*docs.columns)


def _links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    width = 2 * ROWS
    bands = classes.select("cid", F.posexplode(F.expr(
        f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(_regs, i * {width} + 1, {width})))"
    )).alias("band", "bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = common.stored(bands.join(shared, "bucket"), "members")
    score = members.groupBy("cid").agg(F.sum("size").alias("score"))
    wanted = hashstore.build(classes.join(score, "cid", "left_semi"), "_k", "wanted")
    sets = common.stored(
        _sets(docs, wanted, ["_id"], "_t", size).join(classes.select("cid", "_k"), "_k")
        .select("cid", "_set").dropDuplicates(["cid"]), "sets")

    # the member of a bucket that shares most buckets with others against the rest
    scored = members.select("bucket", "cid").join(score, "cid")
    centre = (scored.groupBy("bucket").agg(F.max(F.struct("score", -F.col("cid"))).alias("c"))
              .select("bucket", (-F.col("c.col2")).alias("centre")))
    pairs = (members.select("bucket", "cid").join(centre, "bucket").where("cid != centre")
             .select(F.least("cid", "centre").alias("a"), F.greatest("cid", "centre").alias("b")).distinct())
    sketch = classes.select("cid", "n", "_regs")
    likely = (pairs.join(sketch.toDF("a", "na", "ra"), "a").join(sketch.toDF("b", "nb", "rb"), "b")
              .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
              .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(percent), "a long, b long"))
    links = common.stored(_verified(likely, sets, percent), "links")

    # members of a bucket outside of its largest component against all that are not in their own
    roots = components(links)
    apart = common.stored(members.join(roots, members.cid == roots.node, "left").select(
        "bucket", "band", "size", "cid", F.coalesce("root", "cid").alias("root")), "apart")
    largest = (apart.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
               .groupBy("bucket").agg(F.max(F.struct("k", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
               .where("roots > 1").select("bucket", F.col("m.root").alias("main")))
    place, where = _filed(sets)
    mixed = (apart.join(largest, "bucket").join(sketch, "cid").join(_finer(sets), "cid").join(place, "cid")
             .withColumn("block", F.expr(f"pmod(xxhash64(cid), cast(ceil(size / {BLOCK}) as long))")))
    member = "struct(cid, root, n, shared, _regs, fine, part, at, length)"
    blocks = common.stored(mixed.groupBy("bucket", "band", "main", "block").agg(
        F.expr(f"collect_list({member})").alias("all"),
        F.expr(f"collect_list({member}) filter (where root != main)").alias("odd")), "blocks")
    compared = (blocks.where("size(odd) > 0").select("bucket", "band", "main", "odd")
                .join(blocks.select("bucket", "all"), "bucket")
                .select("band", "main", "odd", "all").mapInArrow(_compare(percent, where), "a long, b long"))
    return links.union(compared)


def _filed(sets: DataFrame) -> tuple[DataFrame, dict[int, tuple[str, int]]]:
    """Sets as files: cid, part, at, length of each set, and the file and its number of hashes of
    each part (one per task)."""
    spark = sets.sparkSession
    folder = common.shared_folder(spark, "set-files")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, at, rows = f"{folder}/{files.attempt_name(f'{part:06d}')}", 0, []

        def parts():
            nonlocal at
            for batch in batches:
                buf, offsets = common.text_buffer(batch.column("_set"))
                rows.append((batch.column("cid"), at + offsets[:-1] // 8, np.diff(offsets) // 8))
                at += len(buf) // 8
                yield buf.tobytes()

        files.write(name, parts())
        for cid, start, length in rows:
            n = len(cid)
            yield pa.RecordBatch.from_arrays(
                [cid, pa.array(np.full(n, part, np.int32)), pa.array(start), pa.array(length),
                 pa.array([name] * n)], ["cid", "part", "at", "length", "name"])

    placed = common.stored(sets.select("cid", "_set").mapInArrow(
        save, "cid long, part int, at long, length long, name string"), "set-places")
    named = placed.groupBy("part", "name").agg(F.max(F.col("at") + F.col("length")).alias("n")).collect()
    return placed.drop("name"), {r.part: (r.name, r.n) for r in named}


def _finer(sets: DataFrame) -> DataFrame:
    """cid, shared (how many shingles of a set occur in another of the sets), fine (one byte of
    each of FINE further registers)."""
    spark = sets.sparkSession
    bits, folder = hashstore.shard_bits(spark), common.shared_folder(spark, "shingles")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hashstore.Counter(bits)
        for batch in batches:
            yield from counter.add(np.frombuffer(common.text_buffer(batch.column(0))[0].tobytes(), np.uint64))
        yield from counter.flush()

    def keep(shard: int, k: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield hashstore.save(folder, shard, k[counts > 1])

    listed = common.stored(hashstore.shards(sets.select("_set").mapInArrow(count, hashstore.PACKED), keep,
                                            hashstore.LISTED), "shingles")
    several = hashstore.opened(spark, folder, listed)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_set"):
                buf, offsets = common.text_buffer(rows.column("_set"))
                shingles, start = np.frombuffer(buf.tobytes(), np.uint64), offsets // 8
                hit = np.concatenate([[0], np.cumsum(several.has(shingles))])
                fine = np.stack([textscan.mix(np.minimum.reduceat(textscan.mix(shingles ^ x), start[:-1]))
                                 for x in _FINE], 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("cid"), pa.array(np.diff(hit[start])),
                     common.binary_column(fine, np.arange(len(fine) + 1) * FINE)], ["cid", "shared", "fine"])

    return common.stored(sets.mapInArrow(shared, "cid long, shared long, fine binary"), "finer")


def _likely(percent: int):
    """Pairs with their sizes and registers -> the pairs that may be links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = [_matrix(batch.column(c)) for c in ("ra", "rb")]
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            yield batch.select(["a", "b"]).filter(pa.array(plausible(*regs, na, nb, percent / 100)))
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(common.text_buffer(column)[0].tobytes(), np.uint16).reshape(len(column), REGISTERS)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets (ascending hashes) are similar enough."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compare(percent: int, where: dict[int, tuple[str, int]]):
    """Two blocks of a bucket -> links that join different components. A pair is compared in the
    first band that it shares, and once if both members are outside of the largest component."""
    # registers that agree, by chance too, in a pair at the threshold, less than which about three
    # in 10^5 such pairs have
    share = percent / 100 + (1 - percent / 100) / 256
    fewest = FINE * share - 4.0 * (FINE * share * (1 - share)) ** 0.5

    def blocks(odd: pa.StructArray, other: pa.StructArray, band: int, main: int, maps: dict[int, np.ndarray]
               ) -> Iterator[tuple[int, int]]:
        ids, roots, sizes, shared = ([x.field(c).to_numpy() for x in (odd, other)]
                                     for c in ("cid", "root", "n", "shared"))
        regs = [_matrix(x.field("_regs")).reshape(-1, BANDS, ROWS) for x in (odd, other)]
        fine = [common.text_buffer(x.field("fine"))[0].reshape(-1, FINE) for x in (odd, other)]
        places = [list(zip(*(x.field(c).to_pylist() for c in ("part", "at", "length")))) for x in (odd, other)]
        joined: dict[int, int] = {}                      # components that the links of this task join

        def full(place: tuple[int, int, int]) -> np.ndarray:
            part, at, length = place
            if part not in maps:
                maps[part] = files.mapped(*where[part])
            return maps[part][at:at + length]

        def top(root: int) -> int:
            while root in joined:
                root = joined[root]
            return root

        for k in range(len(ids[0])):
            # both sets cannot have more in common than what either shares with anyone
            most = np.minimum(shared[1], shared[0][k])
            pick = np.flatnonzero((roots[1] != roots[0][k])
                                  & (100 * most >= percent * (sizes[1] + sizes[0][k] - most))
                                  & ((roots[1] == main) | (ids[1] > ids[0][k])))
            if not len(pick):
                continue
            agree = (fine[1][pick] == fine[0][k]).sum(1)
            pick = pick[np.argsort(-agree, kind="stable")[:int((agree >= fewest).sum())]]
            pick = pick[(regs[1][pick] == regs[0][k]).all(2).argmax(1) == band]
            for j in pick.tolist():
                a, b = top(int(roots[0][k])), top(int(roots[1][j]))
                if a != b and _linked(full(places[0][k]), full(places[1][j]), percent):
                    joined[a] = b
                    yield int(ids[0][k]), int(ids[1][j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(blocks(batch.column("odd")[i].values, batch.column("all")[i].values,
                                    batch.column("band")[i].as_py(), batch.column("main")[i].as_py(), maps))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([min(p) for p in found]), pa.array([max(p) for p in found])], ["a", "b"])
    return run
