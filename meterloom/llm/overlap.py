"""Documents linked by n-gram Jaccard similarity, as blocks of a sparse product.

The incidence matrix has a row per distinct shingle set and a column per shingle. Its
product with itself counts the overlaps of all pairs. Two bounds keep almost all of it
from being computed, without losing a link:

* The columns are dealt into some more parts by their hash than those in which a pair over the
  threshold can differ, so the pair is the same in one part at least. Rows meet where they have
  the same shingles of a part, some 8 of them: texts that have nothing but
  single shingles or a passage in common, of which there are more the larger the table, don't meet.
  The number of parts goes with the size; a row that may be linked with rows of the next class of sizes
  is dealt into the parts of both. Parts of few shingles don't count, and a row that has more
  of these than there are parts to spare meets others like it in single columns.
* Single columns are ordered from rare to common. A pair over the threshold shares ``k`` of the
  first ``size - least overlap + k`` columns of both rows; the rest stays out. Under a threshold
  of PARTS_FROM, where parts would be of few shingles, rows meet in these alone. There ``k`` is a
  share of the size, so rows that meet others in fewer columns leave too.
* A pair whose sizes differ by more than the threshold allows is left out.

Below, a column is what rows meet in, in the product itself it is a shingle. Only columns with two
rows or more count. Every such column first multiplies its rows
with one row of its own, the hub; rows that turn out linked are one component and need
no product with each other. What is left are rows of different components that share
a column. They are dealt into tiles of some hundred rows, alike ones together, and the product is
taken block by block: a task gets the whole sets of the rows that two tiles have to
multiply, accumulates the overlaps of all their pairs in a matrix, drops those below the
bound, and puts out a spanning forest of the links. No pair is ever a row of a table: what
crosses the network is rows by tiles, so a group of ``g`` alike rows sends g * g / tile rows. As
overlaps are of whole sets, the result does not depend on hashing order, parts, hubs, tiles or
the column order.

Rows of equal sets are collapsed before and expanded after, so copies cost nothing.

Defined cases: null and empty texts have no shingles and link with nothing; a document
with fewer words than ``n`` has one shingle, its word sequence; a null id takes no part in
links and has a null component; rows that share an id link each for itself; an empty table gives
an empty result; other columns are ignored. Shingles are compared by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.arrays import BASE, flat, lists, mixed, shingles
from meterloom.llm.common import fresh, kept, mapped, released, small_batches

#: Columns that every task can tell as common: 16 bytes each, the most frequent ones.
#: Which columns these are changes the order, hence the work, and never the links.
COMMON = 1 << 18
#: A column in fewer documents is never named as common.
COMMON_FROM = 8
#: Percent from which rows meet in parts of their columns.
PARTS_FROM = 90
#: The largest size of each class of sizes, over all that a text can have.
TOPS = [8]
while TOPS[-1] < 1 << 31:
    TOPS.append(TOPS[-1] * 3 // 2)
#: Parts of fewer shingles don't count; so many can be spared: one and one in ... of those that can differ.
THICK, SPARED = 3, 8
#: One in so many single columns of a set is a spare one, beyond those that a pair cannot avoid.
SPARE = 20
#: Rounds in which rows with too few shared single columns leave.
PEELS = 2
#: Hubs that a column tries before its remaining rows are dealt into tiles.
HUBS = 4
#: Rows of a tile, and shingles of all its rows, on average.
TILE_ROWS, TILE_CELLS = 512, 1 << 20
#: Columns of a block that are in one dense matrix.
DENSE = 4096

Rows = Iterator[pa.RecordBatch]


def _body(text: str) -> Column:
    return F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))


def set_hash(values: np.ndarray) -> tuple[int, int]:
    a = int(mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    b = int(mixed(values * np.uint64(3) + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def common_columns(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The COMMON most frequent shingles, sorted, and about how many documents hold each.

    Lossy counting over all documents: of every batch a task sends the shingles
    that two or more of its documents hold, with their counts, and these are summed. What is never
    twice in a batch of thousands of documents is rare, and most shingles are.
    """

    def count(batches: Rows) -> Rows:
        for batch in batches:
            values = [shingles(body.as_py(), n) for body in batch.column(1)]
            column, seen = np.unique(np.concatenate(values) if values else np.zeros(0, np.uint64), return_counts=True)
            column, seen = column[seen > 1], seen[seen > 1]
            yield pa.RecordBatch.from_arrays([flat([column]), pa.array(seen.astype(np.int64))], ["shingle", "seen"])

    counts = mapped(docs, count, "shingle bigint, seen bigint").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    top = (
        counts.where(F.col("seen") >= COMMON_FROM)
        .orderBy(F.desc("seen"), "shingle")
        .limit(COMMON)
        .toArrow()
    )
    column = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(column)
    return column[order], top.column("seen").to_numpy()[order]


def first_columns(values: np.ndarray, length: int, column: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The first ``length`` of sorted ``values`` in the order of rarity, then of hash."""
    if not len(column) or not len(values):
        return values[:length]
    at = np.minimum(np.searchsorted(column, values), len(column) - 1)
    rank = np.where(column[at] == values, seen[at], 0)
    rare = values[rank == 0]
    return rare[:length] if len(rare) >= length else values[np.argsort(rank, kind="stable")[:length]]


def least(size: int, percent: int) -> int:
    """Overlap below which no partner of any size can reach the threshold."""
    return -(-percent * size // 100)


def front(values: np.ndarray, percent: int, column: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The columns in which a row of sorted ``values`` meets every row that it can be linked with."""
    size, need = len(values), least(len(values), percent)
    if not size:
        return values
    if percent < PARTS_FROM:
        return first_columns(values, size - need + spare(size), column, seen)
    columns, whole = part_columns(values, percent)
    if whole:
        return columns
    return np.concatenate((columns, first_columns(values, size - need + 1, column, seen)))


@functools.cache
def parts(k: int, percent: int) -> tuple[np.ndarray, int]:
    """Where the parts of the hashes begin, but for the first, for rows up to class ``k``; how many can be spared."""
    differ = 2 * TOPS[k] * (100 - percent) // (100 + percent)
    spared = differ // SPARED + 1
    count = differ + 1 + spared
    return np.arange(1, count, dtype=np.uint64) * np.uint64((1 << 64) // count), spared


def part_columns(values: np.ndarray, percent: int) -> tuple[np.ndarray, bool]:
    """A column for each part of sorted ``values``, for all classes of rows that are no smaller
    and can be linked; whether there is one among them for each of these rows."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(values), dtype=np.uint64)))
    out, whole = [], True
    size = len(values)
    for k in range(bisect.bisect_left(TOPS, size), bisect.bisect_left(TOPS, 100 * size // percent) + 1):
        edges, spared = parts(k, percent)
        at = np.concatenate(([0], np.searchsorted(values, edges), [size]))
        number = np.flatnonzero(np.diff(at) >= THICK)
        whole &= len(at) - 1 - len(number) <= spared
        part = mixed(number.astype(np.uint64) * np.uint64(BASE) + np.uint64(k))
        out.append(mixed(sums[at[number + 1]] - sums[at[number]] + part))
    return np.concatenate(out), whole


def marked_rows(docs: DataFrame, n: int, percent: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, size, hash (a, b) and first columns of each document's shingle set."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def mark(batches: Rows) -> Rows:
        column, seen = shared.value
        for batch in batches:
            sizes, hashes, first = [], [], []
            for body in batch.column(1):
                values = shingles(body.as_py(), n)
                first.append(front(values, percent, column, seen))
                sizes.append(len(values))
                hashes.append(set_hash(values))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([h[0] for h in hashes], pa.int64()),
                    pa.array([h[1] for h in hashes], pa.int64()),
                    lists(first),
                ],
                ["doc_id", "size", "a", "b", "first"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs, mark, f"doc_id {kind}, size bigint, a bigint, b bigint, first array<bigint>")


def spare(size: int) -> int:
    """Columns that a set of this size and a linked one of no smaller size share at the front."""
    return max(1, size // SPARE)


def met(cells: DataFrame) -> DataFrame:
    """The cells of columns with two rows or more. They are dealt once: a join with the counts would deal all twice."""
    column = Window.partitionBy("shingle")
    ends = cells.select("*", F.min("node").over(column).alias("low"), F.max("node").over(column).alias("high"))
    return ends.where("low < high").drop("low", "high")


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    def whole(batches: Rows) -> Rows:
        for batch in batches:
            values = [shingles(body.as_py(), n).tobytes() for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["node", "row"])

    return mapped(docs, whole, f"node {docs.schema['doc_id'].dataType.simpleString()}, row binary")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (x, y) of ``pairs`` whose overlap reaches the threshold."""
    left = sets.select(F.col("node").alias("x"), F.col("row").alias("row_x"))
    right = sets.select(F.col("node").alias("y"), F.col("row").alias("row_y"))
    both = pairs.join(left, "x").join(right, "y").select("x", "y", "row_x", "row_y")

    def multiply(batches: Rows) -> Rows:
        for batch in batches:
            hits = []
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column(2)[i].as_py(), np.uint64)
                b = np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                overlap = len(a) + len(b) - len(np.union1d(a, b))
                if 100 * overlap >= percent * (len(a) + len(b) - overlap):
                    hits.append(i)
            yield batch.select([0, 1]).take(pa.array(hits, pa.int64()))

    kind = pairs.schema["x"].dataType.simpleString()
    return mapped(both, multiply, f"x {kind}, y {kind}")


def tile_visits(cells: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """low, high, node, component: the rows that each pair of tiles has to multiply; and the
    table that this is computed from.

    Of ``cells`` (shingle, node, size, component), a row's tile is a share of the rows whose most
    crowded column is the same. A row visits the tiles that hold, in one of its columns, a
    row of another component and of a size that could be linked.
    """
    crowds = cells.groupBy("shingle").agg(F.count("*").alias("met"))
    homes = (
        cells.join(crowds, "shingle")
        .groupBy("node", "size")
        .agg(F.max(F.struct("met", "shingle")).alias("crowd"))
        .select("node", "size", F.col("crowd.shingle").alias("crowd"))
    )
    parts = homes.groupBy("crowd").agg(
        F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("size") / TILE_CELLS)).alias("parts")
    )
    tile = F.xxhash64("crowd", F.pmod(F.xxhash64("node"), "parts"))
    placed = kept(cells.join(homes.join(parts, "crowd").select("node", tile.alias("tile")), "node"), "overlap-placed")
    held = placed.groupBy("shingle", F.col("tile").alias("other")).agg(
        F.min("size").alias("least"),
        F.max("size").alias("most"),
        F.min("component").alias("first"),
        F.max("component").alias("last"),
    )
    visits = placed.join(held, "shingle").where(
        ((F.col("first") != F.col("component")) | (F.col("last") != F.col("component")))
        & (100 * F.col("most") >= percent * F.col("size"))
        & (100 * F.col("size") >= percent * F.col("least"))
    )
    ends = (F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    return visits.select(*ends, "node", "component").distinct(), placed


def block_links(rows: list[np.ndarray], components: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs among ``rows``, sets that are sorted, of a block."""
    n, size = len(rows), np.array([len(row) for row in rows], np.int64)
    _, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    # A column of one row adds nothing to the product.
    number = np.cumsum(times > 1) - 1
    use = times[column] > 1
    row, column = row[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    overlap = np.zeros((n, n), np.float64)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, DENSE):
        low, high = np.searchsorted(column, [at, at + DENSE])
        part = np.zeros((n, min(DENSE, width - at)), np.float32)
        part[row[low:high], column[low:high] - at] = 1
        overlap += part @ part.T
    linked = 100 * overlap >= percent * (size[:, None] + size - overlap)
    linked &= components[:, None] != components
    forest, seen = [], np.zeros(n, bool)
    for start in np.flatnonzero(linked.any(1)).tolist():
        stack = [] if seen[start] else [start]
        seen[start] = True
        while stack:
            x = stack.pop()
            new = np.flatnonzero(linked[x] & ~seen).tolist()
            seen[new] = True
            forest += [(x, y) for y in new]
            stack += new
    return forest


def block_products(visits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) that connect what the linked pairs of all blocks connect."""
    rows = visits.join(sets, "node").select("low", "high", "node", "component", "row")
    rows = rows.repartition("low", "high").sortWithinPartitions("low", "high")

    def multiply(batches: Rows) -> Rows:
        nodes: list = []
        components: list = []
        values: list[np.ndarray] = []
        block, kind = None, None

        def out() -> pa.RecordBatch:
            _, component = np.unique(np.array(components, dtype=object), return_inverse=True)
            pairs = block_links(values, component, percent) if len(values) > 1 else []
            ends = [pa.array([nodes[pair[k]] for pair in pairs], kind) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, ["x", "y"])

        for batch in batches:
            kind = batch.schema.field(2).type
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for key, node, component, row in zip(keys, *(batch.column(k) for k in (2, 3, 4)), strict=True):
                if key != block:
                    if len(nodes) > 1:
                        yield out()
                    nodes, components, values, block = [], [], [], key
                nodes.append(node.as_py())
                components.append(component.as_py())
                values.append(np.frombuffer(row.as_py(), np.uint64))
        if len(nodes) > 1:
            yield out()

    kind = visits.schema["node"].dataType.simpleString()
    return mapped(rows, multiply, f"x {kind}, y {kind}")


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """node, component (the smallest node that links reach), for nodes with a link.

    Every round takes the smallest label among neighbours and then the label's own
    label, so labels run ahead by doubling distances; a round that changes nothing ends it.
    """
    edges = kept(
        links.select("x", "y").union(links.select("y", "x")).toDF("node", "other").distinct(), purpose
    )
    labels = kept(
        edges.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")),
        purpose,
    )
    while True:
        near = (
            edges.join(labels.toDF("other", "far"), "other").groupBy("node").agg(F.min("far").alias("far"))
        )
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "far").alias("next"))
        stepped = kept(stepped, purpose)
        jump = stepped.select(F.col("node").alias("next"), F.col("next").alias("ahead"))
        moved = kept(
            stepped.join(jump, "next").select("node", "label", F.least("next", "ahead").alias("next")), purpose
        )
        labels = moved.select("node", F.col("next").alias("label"))
        if not moved.where(F.col("label") != F.col("next")).limit(1).count():
            return labels.withColumnRenamed("label", "component")


def near_components(
    docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id. ``percent`` is the least
    100 * intersection / union of a link."""
    if percent * SPARE < 100:
        raise ValueError(f"percent must be at least {-(-100 // SPARE)}, not {percent}")
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), _body(text).alias("body"))
    marked = kept(marked_rows(docs, n, percent, common_columns(docs, n)), "overlap-marked")
    signed = marked.select("doc_id", "size", "a", "b")
    rows = kept(
        signed.where((F.col("size") > 0) & F.col("doc_id").isNotNull())
        .groupBy("size", "a", "b")
        .agg(F.min("doc_id").alias("node")),
        "overlap-rows",
    )
    chosen = rows.withColumnRenamed("node", "doc_id")
    cells = marked.join(chosen, ["doc_id", "size", "a", "b"], "left_semi").select(
        F.explode("first").alias("shingle"), F.col("doc_id").alias("node"), "size"
    )
    peeled: list[DataFrame] = []
    if percent >= PARTS_FROM:
        cells = kept(met(cells), "overlap-cells")
    else:
        # The smallest linked set of a row has ``least`` of its size.
        smallest = F.ceil(F.col("size") * percent / 100)
        shared = F.greatest(F.lit(1), F.floor(smallest / SPARE))
        for _ in range(PEELS):
            cells = kept(met(cells), "overlap-cells")
            peeled.append(cells)
            full = cells.groupBy("node", "size").agg(F.count("*").alias("met")).where(F.col("met") >= shared)
            cells = cells.join(full.select("node", "size"), ["node", "size"], "left_semi").select("shingle", "node", "size")
        cells = kept(cells, "overlap-cells")
    signed = kept(signed, "overlap-signed")
    released(marked, *peeled)
    wanted = cells.select("node").distinct()
    sets = kept(full_sets(docs.join(wanted, docs["doc_id"] == wanted["node"], "left_semi"), n), "overlap-sets")

    close = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    found: list[DataFrame] = []
    tried: list[DataFrame] = []
    opened: list[DataFrame] = []
    labels: DataFrame | None = None

    def labelled() -> DataFrame:
        if labels is None:
            return cells.withColumn("component", F.col("node"))
        return cells.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def untried(pairs: DataFrame) -> DataFrame:
        return reduce(lambda rest, done: rest.join(done, ["x", "y"], "left_anti"), tried, pairs)

    def test(pairs: DataFrame) -> int:
        nonlocal labels
        pairs = kept(untried(pairs.distinct()), "overlap-pairs")
        tried.append(pairs)
        links = kept(linked(pairs, sets, percent), "overlap-links")
        found.append(links)
        new = links.limit(1).count()
        if new:
            labels = components(reduce(DataFrame.union, found), "overlap-components")
        return new

    for k in range(HUBS):
        open_cells = kept(labelled(), "overlap-open")
        opened.append(open_cells)
        rank = F.struct(F.xxhash64("node", F.lit(k)) if k else F.lit(0).cast("long"), "node", "size", "component")
        hubs = (
            open_cells.groupBy("shingle")
            .agg(F.min(rank).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low < high")
            .select("shingle", "hub")
        )
        pairs = (
            open_cells.join(hubs, "shingle")
            .where(F.col("component") != F.col("hub.component"))
            .where(close(F.col("size"), F.col("hub.size")))
            .select(F.least("node", "hub.node").alias("x"), F.greatest("node", "hub.node").alias("y"))
        )
        if not test(pairs):
            break
    open_cells = labelled()
    split = open_cells.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = kept(open_cells.join(split.select("shingle"), "shingle"), "overlap-open")
    released(cells, *tried, *opened)
    visits, placed = tile_visits(rest, percent)
    links = kept(block_products(visits, sets, percent), "overlap-links")
    released(rest, placed, sets)
    if links.limit(1).count():
        found.append(links)
        labels = components(reduce(DataFrame.union, found), "overlap-components")
    named = rows.select("size", "a", "b", "node")
    if labels is not None:
        named = named.join(labels, "node", "left")
    else:
        named = named.withColumn("component", F.col("node"))
    named = named.select("size", "a", "b", F.coalesce("component", "node").alias("component"))
    # Rows of one id are one document: the smaller of their components names it.
    return signed.join(named, ["size", "a", "b"], "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without near copies: of every component one row stays, that of the smallest id.

    Where ids are missing or occur twice, rows are told apart by a number of their own, so
    copies under one id or none leave all the same, and no row goes for another one's
    id; a row without id stays only where its component has no other.
    """
    count = docs.agg(F.count("*").alias("rows"), F.count_distinct(doc_id).alias("ids")).first()
    if count["rows"] == count["ids"]:
        groups = near_components(docs, n, percent, doc_id, text)
        name = fresh(docs, "overlap_id")
        losers = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(name))
        return docs.join(losers, docs[doc_id] == losers[name], "left_anti")
    name = fresh(docs, "overlap_row")
    rows = kept(docs.withColumn(name, F.monotonically_increasing_id()), "overlap-numbered")
    groups = near_components(rows, n, percent, name, text).select(F.col("doc_id").alias("number"), "component_id")
    named = rows.select(F.col(name).alias("number"), F.col(doc_id).alias("of")).join(groups, "number")
    rank = F.struct(F.col("of").isNull().alias("none"), "of", "number")
    stay = named.groupBy("component_id").agg(F.min(rank)["number"].alias(name)).select(name)
    return rows.join(stay, name, "left_semi").select(*docs.columns)
