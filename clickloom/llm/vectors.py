"""Embedding near-dedup: an exact metric range join on pivots.

Vectors are scaled to length one in double precision, where cosine >= c is the same as a distance of at most
sqrt(2 - 2 c). Equal vectors are one class, told apart by 128 bits of digest. A bounded number of vectors serve as pivots; each class
belongs to the cell of its nearest pivot, and a cell knows its radius. By the triangle inequality a class can only have partners in
another cell if its distance to that pivot is at most the cell's radius plus the range, and if it is no farther than the range from
the plane midway between both pivots, behind which the other cell lies: (d(x, q)^2 - d(x, p)^2) / (2 d(p, q)). Pivots are taken far
apart from a bounded number of candidates, as planes between close pivots cut off little.

Cells are packed into blocks of bounded size, a row each, and only there the vectors are moved: once in a shuffle and once to the
shared folder. Blocks whose cells can reach one another meet in a nested loop over the packed rows, which writes no copies of them,
however many blocks a block meets. A task gives back link counts for each block and a spanning forest of its links, never the links
themselves. Products are screened in single precision; those within its error of the threshold are made again in double.

The number of cells bounds what is sent to every task, not what a task holds: blocks do that. Vectors without any structure are near
the boundary of every cell in high dimensions; then every pair of blocks is compared, which is exact and quadratic in time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .components import components
from .tables import pack, shared_path, stored, unpack

# Packed vectors in bytes that a task of the nested loop holds of each side.
SIDE_BYTES = 16 * 1024 * 1024
# Later pivots are preferred by up to this much of a product, so that vectors equally near to many have one cell.
LEAN = 1e-7
# Pivots are at least so far apart.
CLOSE = 1e-3
# Pairs of packed rows go to Python in batches of this size, which worker and executor both hold.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
# Values of vectors do not compress. A page has few rows, as a reader holds a page as it is and as it was packed.
BLOCK_FILES = {"compression": "none", "parquet.page.row.count.limit": "4"}


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.9
    per_cell: int = 4096
    max_cells: int = 1024  # pivots are broadcast: 1,024 of them are half a megabyte at 64 dimensions
    block: int = 2048
    candidates: int = 8  # vectors collected for each pivot that is chosen among them

    @property
    def range(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine)) + 1e-7


def _scaled(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the rows in length one as doubles, which of them can link)"""
    values = np.ascontiguousarray(values, np.float64)
    largest = np.abs(values).max(axis=1)
    good = np.isfinite(largest) & (largest > 0)
    if not good.all():
        values, largest = values[good], largest[good]
    values = values / largest[:, None]
    return values / np.sqrt((values * values).sum(axis=1))[:, None] + 0.0, good


def _by_width(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(width, rows, their values as given, their unit vectors) of the vectors that can link."""
    if not len(column):
        return
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values.fill_null(np.nan))
    sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    for width in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == width)
        given = values[offsets[rows][:, None] + np.arange(width)]
        units, good = _scaled(given)
        if good.any():
            yield width, rows[good], given[good], units


def _digests(units: np.ndarray) -> np.ndarray:
    found = b"".join([hashlib.blake2b(u, digest_size=16).digest() for u in units])
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def _apart(digests: np.ndarray) -> np.ndarray:
    """The first row of each digest."""
    return np.unique(digests, axis=0, return_index=True)[1]


def _smallest(most: int):
    """(width, h1, h2): the ``most`` smallest digests of a task; digests are evenly spread, so these are a sample of the classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                batch = batch.filter(batch.column(0).is_valid())
            for width, _, _, units in _by_width(batch.column(1)):
                both = np.concatenate([held.get(width, np.empty((0, 2), np.int64)), _digests(units)])
                held[width] = np.unique(both, axis=0)[:most]
        for width, found in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), width, np.int32)), pa.array(found[:, 0]), pa.array(found[:, 1])],
                names=["width", "h1", "h2"])

    return run, "width int, h1 long, h2 long"


def _chosen(wanted: set[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, _, _, units in _by_width(batch.column(1)):
                digests = _digests(units)
                at = np.array([i for i, h in enumerate(map(tuple, digests.tolist())) if h in wanted], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), width, np.int32)), pa.array(digests[at, 0]), pa.array(digests[at, 1]),
                    pa.array([u.tobytes() for u in units[at]], pa.binary()),
                ], names=["width", "h1", "h2", "unit"])

    return run, "width int, h1 long, h2 long, unit binary"


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (rows @ pivots.T)))


def _far_apart(candidates: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` of the candidates, each as far as possible from those before it."""
    chosen, nearest = [0], _distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < count and nearest.max() > CLOSE:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def _pivots(wanted: DataFrame, settings: Settings) -> dict[int, tuple[int, np.ndarray]]:
    """{width: (number of its first cell, pivots)}"""
    most = settings.max_cells * settings.candidates
    smallest, schema = _smallest(most)
    order = Window.partitionBy("width").orderBy("h1", "h2")
    sample = wanted.mapInArrow(smallest, schema).distinct().withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= most)
    by_width: dict[int, list[tuple[int, int]]] = {}
    for row in sample.collect():
        by_width.setdefault(row["width"], []).append((row["h1"], row["h2"]))
    counts = {}
    for width, found in by_width.items():
        found.sort()
        classes = len(found) if len(found) < most else (most - 1) * 2**64 // (found[-1][0] + 2**63 + 1)
        counts[width] = max(1, min(settings.max_cells, -(-classes // settings.per_cell), len(found)))
        del found[counts[width] * settings.candidates:]
    fetch, schema = _chosen({h for found in by_width.values() for h in found})
    units: dict[int, list[tuple]] = {}
    for row in wanted.mapInArrow(fetch, schema).dropDuplicates(["h1", "h2"]).collect():
        units.setdefault(row["width"], []).append((row["h1"], row["h2"], row["unit"]))
    out, used = {}, 0
    for width in sorted(units):
        candidates = np.stack([np.frombuffer(u, np.float64) for _, _, u in sorted(units[width])])
        out[width] = used, _far_apart(candidates, counts[width])
        used += len(out[width][1])
    return out


def _nearness(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot with the most is the home of a vector."""
    return units @ pivots.T + np.arange(len(pivots)) * (LEAN / len(pivots))


def _tie(width: int) -> float:
    """More than two values of nearness can differ when they are found anew, among other rows or by another machine."""
    return (width + 8) * 2.0**-49


def _keyed(pivots: dict[int, tuple[int, np.ndarray]]):
    """A row for each row, with digest, cell and distance to its pivot if the vector can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, home = np.zeros((batch.num_rows, 2), np.int64), np.full(batch.num_rows, -1, np.int32)
            distance = np.zeros(batch.num_rows)
            for width, rows, _, units in _by_width(batch.column(1)):
                if width not in pivots:  # no row of this width has an id
                    continue
                first, found = pivots[width]
                best = np.concatenate([
                    _nearness(units[at:at + 1024], found).argmax(axis=1) for at in range(0, len(units), 1024)])
                digests[rows], home[rows] = _digests(units), first + best
                distance[rows] = np.sqrt(np.maximum(0, 2 - 2 * (units * found[best]).sum(axis=1)))
            none = home < 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(digests[:, 0], mask=none), pa.array(digests[:, 1], mask=none),
                pa.array(home, mask=none), pa.array(distance, mask=none),
            ], names=["vec_id", "h1", "h2", "home", "distance"])

    return run, "vec_id long, h1 long, h2 long, home int, distance double"


def _vectors(pivots: dict[int, tuple[int, np.ndarray]], parts: list[int]):
    """(home, part, h1, h2, data): the values of each class, once for a batch; to all of its cells if several are equally near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch = batch.filter(batch.column(0).is_valid())
            for width, _, given, units in _by_width(batch.column(1)):
                digests = _digests(units)
                once = _apart(digests)
                first, found = pivots[width]
                for at in range(0, len(once), 1024):
                    near = _nearness(units[once[at:at + 1024]], found)
                    rows, cells = np.nonzero(near >= near.max(axis=1)[:, None] - _tie(width))
                    rows, cells = once[at + rows], cells + first
                    part = np.mod(digests[rows, 1], np.array(parts, np.int64)[cells])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cells.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(digests[rows, 0]),
                        pa.array(digests[rows, 1]), pa.array([given[i].tobytes() for i in rows], pa.binary()),
                    ], names=["home", "part", "h1", "h2", "data"])

    return run, "home int, part int, h1 long, h2 long, data binary"


def _joined(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node connected to it) of the nodes of these edges, without the least ones."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    least = np.arange(len(nodes))
    while True:
        lower, last = np.minimum(least[a], least[b]), least.copy()
        np.minimum.at(least, last[a], lower)
        np.minimum.at(least, last[b], lower)
        while not np.array_equal(least, further := least[least]):
            least = further
        if np.array_equal(least, last):
            other = least != np.arange(len(nodes))
            return nodes[other], nodes[least[other]]


def _relabelled(labels: np.ndarray, nodes: np.ndarray, least: np.ndarray) -> np.ndarray:
    if not len(nodes):
        return labels
    at = np.minimum(np.searchsorted(nodes, labels), len(nodes) - 1)
    return np.where(nodes[at] == labels, least[at], labels)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the labels of rows and columns as the links do; few more than there are labels."""
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    rows, columns = left, right
    linked = linked & (rows[:, None] != columns[None, :])
    while True:
        some, others = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if not len(some):
            return u, v
        more = linked[some].argmax(axis=1), linked[:, others].argmax(axis=0)
        u, v = _joined(np.concatenate([u, left[some], left[more[1]]]), np.concatenate([v, right[more[0]], right[others]]))
        rows, columns = _relabelled(left, u, v), _relabelled(right, u, v)
        linked &= rows[:, None] != columns[None, :]


class _Block:
    """Vectors of one cell in single precision, and what is exact where it is asked for."""

    def __init__(self, home: int, data: memoryview, kind: type, roots: np.ndarray, copies: np.ndarray):
        self.home, self.data, self.kind, self.roots, self.copies = home, data, kind, roots, copies.astype(np.float64)
        self.single = self.exact(slice(None)).astype(np.float32)
        self.width = self.single.shape[1]

    def exact(self, rows: np.ndarray | slice) -> np.ndarray:
        return _scaled(np.frombuffer(self.data, self.kind).reshape(len(self.roots), -1)[rows])[0]


class _Cells:
    """Which cells a vector's links may reach."""

    def __init__(self, pivots: dict[int, tuple[int, np.ndarray]], radius: np.ndarray, reach: float):
        self.pivots, self.radius, self.reach = pivots, radius, reach

    def reached(self, block: _Block, cells: np.ndarray) -> np.ndarray:
        """A row for each vector of the block and a column for each of the cells, which have the block's width."""
        first, pivots = self.pivots[block.width]
        own, found, slack = pivots[block.home - first], pivots[cells - first], 2 * _error(block.width) + 1e-6
        to_own, to_found = block.single @ own.astype(np.float32), block.single @ found.astype(np.float32).T
        between = np.sqrt(((found - own) ** 2).sum(axis=1))
        farthest = self.radius[cells] + self.reach
        near = to_own[:, None] - to_found <= self.reach * between + slack
        return near & (2 - 2 * to_found <= farthest**2 + slack) & (self.radius[cells] >= 0)


def _error(width: int) -> float:
    """More than the product of two unit vectors in single precision can be off."""
    return (width + 8) * 2.0**-23


def _links(a: _Block, b: _Block, cosine: float, rows: np.ndarray, columns: np.ndarray) -> Iterator[tuple]:
    """(rows, columns, link matrix of those) wherever rows and columns of the two blocks link; a row comes once."""
    error = _error(a.width)
    if not len(columns):
        return
    right = b.single if len(columns) == len(b.single) else b.single[columns]
    for start in range(0, len(rows), 512):
        part = rows[start:start + 512]
        product = a.single[part] @ right.T
        if product.max() < cosine - error:
            continue
        some = np.flatnonzero(product.max(axis=1) >= cosine - error)
        others = np.flatnonzero(product[some].max(axis=0) >= cosine - error)
        product = product[np.ix_(some, others)]
        some, others = part[some], columns[others]
        linked = product >= cosine - error
        i, j = np.nonzero(linked & (product < cosine + error))
        for at in range(0, len(i), 4096):
            x, y = i[at:at + 4096], j[at:at + 4096]
            linked[x, y] = (a.exact(some[x]) * b.exact(others[y])).sum(axis=1) >= cosine
        yield some, others, linked


def _packed(cells: _Cells, cosine: float, kind: type, count: int):
    """The block of a cell's part as a row, with the links inside it counted and its classes joined."""
    names = ["block", "home", "keys", "nodes", "copies", "roots", "links", "data", "reached"]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        if rows["data"].null_count:
            raise RuntimeError("a class has no vector: the input changed while it was read")
        keys = np.stack([np.asarray(rows[name]) for name in ("h1", "h2")], axis=1)
        nodes, copies, home = np.asarray(rows["node"]), np.asarray(rows["copies"]), key[0].as_py()
        data = b"".join(rows["data"].to_pylist())
        block = _Block(home, data, kind, nodes, copies)
        links, u, v, every = np.zeros(len(nodes)), [], [], np.arange(len(nodes))
        for some, others, linked in _links(block, block, cosine, every, every):
            linked &= some[:, None] != others[None, :]
            links[some] += linked @ block.copies[others]
            for out, part in zip((u, v), _forest(linked, nodes[some], nodes[others]), strict=True):
                out.append(part)
        roots = _relabelled(nodes, *_joined(np.concatenate(u), np.concatenate(v))) if u else nodes
        reached = np.zeros(count, bool)
        first, pivots = cells.pivots[block.width]
        reached[first:first + len(pivots)] = cells.reached(block, first + np.arange(len(pivots))).any(axis=0)
        values = [
            (home << 32) + key[1].as_py(), home, keys.tobytes(), pack(nodes), pack(copies), pack(roots),
            pack(links.astype(np.int64)), data, reached.tolist()]
        return pa.table({name: pa.array([x], kind) for name, kind, x in zip(names, kinds, values, strict=True)})

    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.list_(pa.bool_())]
    return run, ("block long, home int, keys binary, nodes binary, copies binary, roots binary, links binary, data binary, "
                 "reached array<boolean>")


def _met(cells: _Cells, cosine: float, kind: type):
    """Of pairs of blocks: (block, links) counts of a task for each block, and edges (u, v) between the roots that links connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Block] = {}
        links: dict[int, np.ndarray] = {}
        u, v, waiting = [], [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                blocks = []
                for at in (0, 5):
                    number, home, roots, copies, data = (batch.column(at + i)[row] for i in range(5))
                    number = number.as_py()
                    data = memoryview(data.as_buffer())
                    if number in held:
                        held[number].data = data
                    else:
                        if sum(b.single.nbytes for b in held.values()) > 4 * SIDE_BYTES:
                            held.clear()
                        held[number] = _Block(
                            home.as_py(), data, kind, unpack(roots.as_py(), np.int64), unpack(copies.as_py(), np.int64))
                    blocks.append((number, held[number]))
                (first, a), (second, b) = blocks
                rows = np.flatnonzero(cells.reached(a, np.array([b.home]))[:, 0])
                columns = np.flatnonzero(cells.reached(b, np.array([a.home]))[:, 0])
                for some, others, linked in _links(a, b, cosine, rows, columns):
                    links.setdefault(first, np.zeros(len(a.roots)))[some] += linked @ b.copies[others]
                    links.setdefault(second, np.zeros(len(b.roots)))[others] += a.copies[some] @ linked
                    found = _forest(linked, a.roots[some], b.roots[others])
                    u.append(found[0])
                    v.append(found[1])
                    waiting += len(found[0])
                a.data = b.data = None  # else it holds the whole batch
                if waiting > 1_000_000:
                    found = _joined(np.concatenate(u), np.concatenate(v))
                    u, v, waiting = [found[0]], [found[1]], 0
        for number, count in links.items():
            if count.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([pack(count.astype(np.int64))], pa.binary()),
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=["block", "links", "u", "v"])
        if u:
            found = _joined(np.concatenate(u), np.concatenate(v))
            for start in range(0, len(found[0]), 65536):
                ends = [pa.array(x[start:start + 65536]) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(ends[0]), pa.int64()), pa.nulls(len(ends[0]), pa.binary()), *ends],
                    names=["block", "links", "u", "v"])

    return run, "block long, links binary, u long, v long"


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    name, value = BATCH
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _totals(rows: pa.Table) -> pa.Table:
    """A row for each class of a block, with the link counts of all tasks."""
    own = int(np.flatnonzero(np.asarray(rows["nodes"].is_valid()))[0])
    keys = np.frombuffer(rows["keys"][own].as_py(), np.int64).reshape(-1, 2)
    nodes, copies, roots, links = (unpack(rows[name][own].as_py(), np.int64) for name in ("nodes", "copies", "roots", "links"))
    for found in rows["met"].drop_null():
        links = links + unpack(found.as_py(), np.int64)
    return pa.table({
        "h1": pa.array(keys[:, 0]), "h2": pa.array(keys[:, 1]), "node": pa.array(nodes), "copies": pa.array(copies),
        "root": pa.array(roots), "links": pa.array(links)})


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings = Settings(),
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row, by cosine >= ``settings.cosine`` in double precision.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and neither do rows without an id (their
    component is null, they are kept) or vectors of different lengths with each other. Repeated rows of one id and vector count
    once. Other columns are dropped. Runs jobs when called, reads its input four times and writes keys, blocks and links to the shared
    folder.
    """
    spark = vectors.sparkSession
    single = isinstance(getattr(vectors.schema[embedding].dataType, "elementType", None), FloatType)
    kind = np.float32 if single else np.float64
    wanted = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<float>" if single else "array<double>").alias("embedding"))
    pivots = _pivots(wanted, settings)
    keyed, schema = _keyed(pivots)
    keys = stored(wanted.mapInArrow(keyed, schema), "keys")
    linked = keys.where("home is not null and vec_id is not null")
    classes = linked.dropDuplicates(["vec_id", "h1", "h2"]).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("home").alias("home"),
        F.max("distance").alias("distance"))
    classes = stored(classes, "classes")

    count = sum(len(found) for _, found in pivots.values())
    parts, radius, size = [1] * max(1, count), np.full(max(1, count), -1.0), 0
    width = {first + i: width for width, (first, found) in pivots.items() for i in range(len(found))}
    for row in classes.groupBy("home").agg(F.count(F.lit(1)).alias("count"), F.max("distance").alias("far")).collect():
        parts[row["home"]], radius[row["home"]] = -(-row["count"] // settings.block), row["far"] + 1e-6
        size += row["count"] * width[row["home"]] * np.dtype(kind).itemsize
    cells = _Cells(pivots, radius, settings.range)

    # A class and its vector meet in the block: the vector is shuffled once, and nothing else that is as wide.
    given, schema = _vectors(pivots, parts)
    # The nested loop has a task for each two files.
    files = max(math.isqrt(16 * spark.sparkContext.defaultParallelism) + 1, -(-size // SIDE_BYTES))
    given = wanted.mapInArrow(given, schema).select("home", "part", "h1", "h2", F.lit(None).cast("long").alias("node"),
                                                    F.lit(None).cast("long").alias("copies"), "data")
    named = classes.select(
        "home", F.pmod("h2", F.lit(parts)[F.col("home")].cast("long")).cast("int").alias("part"), "h1", "h2", "node", "copies",
        F.lit(None).cast("binary").alias("data"))
    packed, schema = _packed(cells, settings.cosine, kind, max(1, count))
    # Copies of a vector leave in the same task, so a block holds its classes only.
    members = given.union(named).repartition(files, "home", "part").groupBy("home", "part", "h1", "h2").agg(
        F.max("node").alias("node"), F.max("copies").alias("copies"), F.first("data", ignorenulls=True).alias("data"))
    blocks = members.where("node is not null").groupBy("home", "part").applyInArrow(packed, schema)
    path = shared_path(spark, "blocks")
    blocks.write.options(**BLOCK_FILES).parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)

    # Each pair of blocks once, with its order by turns so that all tasks have some. No key is equal, so packed rows are not shuffled.
    names = ["block", "home", "roots", "copies", "data"]
    sides = blocks.select(*names, "reached").coalesce(files)
    others = sides.select(*[F.col(name).alias(f"other_{name}") for name in [*names, "reached"]])
    turn = (F.hash("block") + F.hash("other_block").cast("long")) % 2 == 0
    pairs = sides.join(
        others, (F.col("block") != F.col("other_block")) & ((F.col("block") < F.col("other_block")) == turn)
        & F.col("reached")[F.col("other_home")] & F.col("other_reached")[F.col("home")])
    met, schema = _met(cells, settings.cosine, kind)
    with _small_batches(spark):
        found = stored(pairs.select(*names, *[f"other_{name}" for name in names]).mapInArrow(met, schema), "links")

    own = ["keys", "nodes", "copies", "roots", "links"]
    counts = found.where("block is not null").select(
        "block", *[F.lit(None).cast("binary").alias(name) for name in own], F.col("links").alias("met"))
    totals = stored(
        blocks.select("block", *own, F.lit(None).cast("binary").alias("met")).union(counts).groupBy("block").applyInArrow(
            _totals, "h1 long, h2 long, node long, copies long, root long, links long"), "totals")
    # One id may stand for several classes, if it has several vectors: these share links and component.
    of_node = totals.groupBy("node").agg(F.sum("links").alias("all_links"), F.count(F.lit(1)).alias("classes"))
    totals = totals.join(of_node, "node")
    joined = components(
        found.where("u is not null").select("u", "v").union(totals.where("classes > 1").select("node", "root")), "u", "v")
    result = totals.join(joined.withColumnRenamed("node", "root"), "root", "left").select(
        "h1", "h2", (F.col("all_links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "root").alias("component_id"))
    near = linked.join(result, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = keys.where("home is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return near.union(alone).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)))
