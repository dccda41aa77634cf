"""The trie of conversation prefixes from sorted sequences and their common prefixes.

Conversations are sorted by their turns. Every prefix that a sequence is the first to have
is a node; how far it reaches to either side is found by binary search over a sparse table
of minima of the common prefixes (LCPs) of neighbours, each side for itself. Ranges of the
sorted order are searched on their own. The few nodes that cross a border between ranges
are searched once more over the ranges, in the same way, and their parts added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import batches, ship_package, stored

#: Conversations of one block share the start of its first one.
BLOCK = 5
#: Lengths of the shared start: 0 to 8 turns.
STARTS = 9
#: Characters of a turn in a sequence's key.
CELL = 32
#: Characters of keys in a range of the sorted order, and ranges at least.
RANGE_CHARS, LEAST_RANGES = 32 << 20, 8
#: Nodes across borders up to which they are sent to every task.
FEW_OPEN = 1 << 20


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): each conversation after its shared start.

    ``key`` has CELL characters for every turn, equal for equal role and text, ``sizes``
    the UTF-8 bytes of every text. Turns are ordered by ``turn``, null first, and by the
    digest of role and text among equal ones; a null role or text is empty. Rows without
    conv_id take no part. A conversation is one row: some 40 bytes for a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            F.md5(F.concat_ws(":", F.octet_length(role), role, text)).alias("cell"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("step"),
    )
    steps = F.sort_array(F.collect_list("step"))
    own = stored(rows.groupBy("conv_id").agg(steps.alias("steps")), "conversations")
    start = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % STARTS).cast("int")
    first = (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("first_id")
    heads = own.select(
        F.col("conv_id").alias("first_id"), F.slice("steps", 1, STARTS - 1).alias("head")
    )
    joined = own.select("conv_id", first, "steps", start.alias("start")).join(heads, "first_id", "left")
    left = F.greatest(F.size("steps") - F.col("start"), F.lit(0))
    head = F.when(F.col("head").isNull(), F.slice("steps", 1, 0)).otherwise(
        F.slice("head", F.lit(1), F.col("start"))
    )
    whole = joined.select(
        "conv_id", F.concat(head, F.slice("steps", F.col("start") + 1, left)).alias("steps")
    )
    return whole.select(
        "conv_id", F.array_join("steps.cell", "").alias("key"), F.col("steps.size").alias("sizes")
    )


def common_cells(a: str, b: str) -> int:
    """Cells that two keys have in common from the start."""
    low, high = 0, min(len(a), len(b)) // CELL
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * CELL] == b[: middle * CELL]:
            low = middle
        else:
            high = middle - 1
    return low


class SparseMinima:
    """Minima of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        while 2 << len(self.levels) - 1 <= len(values):
            last, step = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of values[first..last], both included."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.levels[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << int(k)) + 1])
        return out

    def reach_right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Largest end such that values[start + 1..end] are all at least ``bound``."""
        end = start.copy()
        for k in reversed(range(len(self.levels))):
            row = self.levels[k]
            at = end + 1
            fits = at < len(row)
            fits &= row[np.minimum(at, len(row) - 1)] >= bound
            end[fits] += 1 << k
        return end

    def reach_left(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Smallest begin such that values[begin + 1..start] are all at least ``bound``."""
        begin = start.copy()
        for k in reversed(range(len(self.levels))):
            row, step = self.levels[k], 1 << k
            at = begin - step + 1
            fits = (at >= 0) & (row[np.maximum(at, 0)] >= bound)
            begin[fits] -= step
        return begin


class Borders:
    """What the ranges have in common: with the range before, and from first to last.

    ``shared[q]`` is the LCP of range q's first sequence and the one before it, -1 for
    the first range; ``inside[q]`` that of its first and last.
    """

    def __init__(self, shared: np.ndarray, inside: np.ndarray):
        self.shared = np.append(shared, -1)
        # Leaving range q to the right takes inside[q] and shared[q + 1].
        self._right = SparseMinima(np.minimum(inside, self.shared[1:]))
        self._left = SparseMinima(np.minimum(inside, shared))

    def last_range(self, at: int, depths: np.ndarray) -> np.ndarray:
        """The last range that prefixes of range ``at``'s last sequence reach."""
        # Range at + 1 is reached; from there on every range must be crossed whole.
        crossed = self._right.reach_right(np.full(len(depths), at), depths)
        return crossed + 1

    def first_range(self, at: int, depths: np.ndarray) -> np.ndarray:
        """The range where prefixes shared with what lies before range ``at`` begin."""
        return self._left.reach_left(np.full(len(depths), at - 1), depths)


NODES = (
    "owner int, last int, depth long, conv_id long, parent_conv_id long, parent_owner int, "
    "n_convs long, n_children long, n_leaves long, saved long, size long, end_id long, n_ends long"
)


def range_nodes(
    at: int, borders: Borders, keys: list[str], convs: np.ndarray, firsts: np.ndarray, sizes: list
) -> dict[str, np.ndarray]:
    """The nodes of one range of distinct sorted sequences, as columns of NODES.

    ``convs`` counts the conversations of a sequence, ``firsts`` is the smallest of them.
    A node inside the range is finished (``owner`` -1), except for a parent that crosses
    a border, named by ``parent_owner``. A node that crosses a border has the range where
    it begins as ``owner``, the last range it reaches, and this range's part of its sums.
    """
    n = len(keys)
    before, after = int(borders.shared[at]), int(borders.shared[at + 1])
    lengths = np.array([len(k) // CELL for k in keys], np.int64)
    lcp = np.array([-1, *map(common_cells, keys, keys[1:])], np.int64)
    minima, smallest = SparseMinima(lcp), SparseMinima(firsts)
    # Candidates: the prefixes that a sequence has and the one before it has not. The
    # first sequence stands for all of its own, those shared with the range before too.
    fresh = lengths - lcp
    place = np.cumsum(fresh) - fresh
    who = np.repeat(np.arange(n), fresh)
    depth = np.arange(len(who)) - place[who] + lcp[who] + 1
    right = minima.reach_right(who, depth)
    left = who
    open_left = (who == 0) & (depth <= before)
    open_right = (right == n - 1) & (depth <= after)
    crossing = open_left | open_right

    # The parent of a sequence's first new prefix begins at an earlier sequence.
    above = np.arange(len(who)) - 1
    branch = place[1:]
    begin = minima.reach_left(np.arange(1, n), lcp[1:])
    above[branch] = place[begin] + lcp[1:] - lcp[begin] - 1
    counted = np.flatnonzero((above >= 0) & ~open_left)
    children = np.bincount(above[counted], minlength=len(who))

    total = np.concatenate([[0], np.cumsum(convs)])
    members = total[right + 1] - total[left]
    following = np.append(lcp[1:], after)
    leaves = np.concatenate([[0], np.cumsum(following < lengths)])
    size = np.fromiter((s[d - 1] if d else 0 for s, d in zip(map(sizes.__getitem__, who), depth)), np.int64, len(who))
    own = np.where(crossing, 0, (members - 1) * size)
    # Candidates are in order of sequence, then depth: what lies below one follows it.
    running = np.concatenate([[0], np.cumsum(own)])
    last_below = (place + fresh)[right]
    saved = running[last_below] - running[np.arange(len(who))]

    conv = smallest.least(left, right)
    owner = np.where(crossing, at, -1)
    shared = np.flatnonzero(open_left)
    owner[shared] = borders.first_range(at, depth[shared])
    last = np.full(len(who), -1)
    begun = np.flatnonzero(open_right & ~open_left)
    last[begun] = borders.last_range(at, depth[begun])
    ends = (lengths[who] == depth) & ~open_left
    return {
        "owner": owner,
        "last": last,
        "depth": depth,
        "conv_id": conv,
        "parent_conv_id": np.where(above >= 0, conv[above], -1),
        "parent_owner": np.where(above >= 0, owner[above], -1),
        "n_convs": members,
        "n_children": children,
        "n_leaves": leaves[right + 1] - leaves[left],
        "saved": saved,
        "size": size,
        "end_id": np.where(ends, firsts[who], 0),
        "n_ends": np.where(ends, convs[who], 0),
    }


def _ranges(sequences: DataFrame) -> DataFrame:
    """(range, key, n, first, sizes): distinct sequences, cut into ranges of their order."""
    classes = stored(
        sequences.groupBy("key").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("sizes").alias("sizes")
        ),
        "sequences",
    )
    chars = classes.agg(F.sum(F.length("key"))).first()[0] or 0
    parts = max(LEAST_RANGES, -(-chars // RANGE_CHARS))
    dealt = classes.repartitionByRange(parts, "key").withColumn("range", F.spark_partition_id())
    return stored(dealt, "sequence-ranges")


def _borders(ranges: DataFrame) -> list[tuple[int, int, int]]:
    """(range, shared, inside) in order: three numbers for a range, whatever it holds."""
    ends = ranges.groupBy("range").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    before = F.lag("high").over(Window.orderBy("range")).alias("before")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            columns = (batch.column(c).to_pylist() for c in ("before", "low", "high"))
            rows = [(-1 if p is None else common_cells(p, a), common_cells(a, b)) for p, a, b in zip(*columns)]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": batch.column("range"),
                    "shared": pa.array([r[0] for r in rows], pa.int64()),
                    "inside": pa.array([r[1] for r in rows], pa.int64()),
                }
            )

    found = ends.select("range", before, "low", "high").mapInArrow(compare, "range int, shared long, inside long")
    return sorted(tuple(r) for r in found.collect())


def _ends(sequences: DataFrame) -> DataFrame:
    """(end_id, ends_sha256) of the sequences that several conversations have.

    Ids are hashed in order as they come out of the sort: no list of them is held. One
    digest is sequential, so a sequence's ids, eight bytes each, pass through one task.
    """
    rows = sequences.select(F.md5("key").alias("sequence"), "conv_id")
    rows = rows.repartition("sequence").sortWithinPartitions("sequence", "conv_id")
    schema = pa.schema([("end_id", pa.int64()), ("ends_sha256", pa.string())])

    def digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            now, first, count, digest = None, 0, 0, None
            for batch in parts:
                names = batch.column("sequence").to_pylist()
                ids = batch.column("conv_id").to_pylist()
                for name, conv in zip(names, ids, strict=True):
                    if name == now:
                        digest.update(b",%d" % conv)
                        count += 1
                        continue
                    if count > 1:
                        yield first, digest.hexdigest()
                    now, first, count, digest = name, conv, 1, hashlib.sha256(b"%d" % conv)
            if count > 1:
                yield first, digest.hexdigest()

        return batches(found(), schema)

    return rows.mapInArrow(digests, "end_id long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the root included.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves (childless nodes in the subtree, itself included), saved_tokens
    (over the subtree, members but one times bytes of a node's last text) and
    ends_sha256 (of the ids of members that end here, ascending, joined by commas).

    An empty table gives no rows, not even a root. Rows without conv_id take no part;
    repeated rows are turns of their own; other columns are ignored, whatever their names.
    """
    ship_package(conversations.sparkSession)
    sequences = stored(rebuild(conversations), "rebuilt")
    ranges = _ranges(sequences)
    known = _borders(ranges)
    numbers = {number: at for at, (number, _, _) in enumerate(known)}
    shared, inside = (np.array([b[i] for b in known], np.int64) for i in (1, 2))

    def nodes(table: pa.Table) -> pa.Table:
        at = numbers[table.column("range")[0].as_py()]
        table = table.sort_by("key")
        counts, firsts = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "first"))
        keys, sizes = table.column("key").to_pylist(), table.column("sizes").to_pylist()
        found = range_nodes(at, Borders(shared, inside), keys, counts, firsts, sizes)
        kinds = {"owner": np.int32, "last": np.int32, "parent_owner": np.int32}
        return pa.table({c: v.astype(kinds.get(c, np.int64)) for c, v in found.items()})

    rows = stored(ranges.groupBy("range").applyInArrow(nodes, NODES), "trie-nodes")
    crossing = _across_borders(rows, len(known))
    result = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "end_id", "n_ends"]
    parents = crossing.select(
        F.col("owner").alias("parent_owner"),
        (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("above_id"),
    )
    if (shared + 1).sum() <= FEW_OPEN:
        parents = F.broadcast(parents)
    inner = rows.where("owner < 0")
    done = inner.where("parent_owner < 0").select(
        *result, F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    )
    below = inner.where("parent_owner >= 0").select(*result, "parent_owner")
    below = below.unionByName(crossing.where("depth > 0").select(*result, "parent_owner"))
    below = below.join(parents, ["parent_owner", "depth"]).select(*result, F.col("above_id").alias("parent_conv_id"))
    root = crossing.where("depth = 0").select(*result, F.lit(None).cast("long").alias("parent_conv_id"))
    every = done.unionByName(below).unionByName(root)
    return _with_ends(every, _ends(sequences))


def _across_borders(rows: DataFrame, ranges: int) -> DataFrame:
    """Nodes that cross borders, their parts added up."""
    spark = rows.sparkSession
    parts = rows.where("owner >= 0").groupBy("owner", "depth")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "end_id", "n_ends")]
    most = [F.max(c).alias(c) for c in ("size", "last", "parent_owner")]
    whole = parts.agg(F.min("conv_id").alias("conv_id"), *sums, *most)
    whole = stored(whole.withColumn("own", (F.col("n_convs") - 1) * F.col("size")), "crossing-nodes")
    # Below a node lie the deeper ones that begin in its range, and all that begin in the
    # ranges between that one and the last it reaches.
    deeper = Window.partitionBy("owner").orderBy(F.desc("depth"))
    totals = spark.range(ranges).select(F.col("id").cast("int").alias("owner")).join(
        whole.groupBy("owner").agg(F.sum("own").alias("own")), "owner", "left"
    )
    until = F.sum(F.coalesce("own", F.lit(0))).over(Window.orderBy("owner"))
    until = stored(totals.select("owner", until.alias("until")), "range-totals")
    here = until.withColumnRenamed("until", "here")
    there = until.select((F.col("owner") + 1).alias("last"), F.col("until").alias("there"))
    summed = whole.withColumn("deeper", F.sum("own").over(deeper)).join(here, "owner").join(there, "last")
    saved = F.col("saved") + F.col("deeper") + F.col("there") - F.col("here")
    return stored(summed.withColumn("saved", saved).drop("deeper", "here", "there", "own"), "crossing")


def _with_ends(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
    ]
    one = F.when(F.col("n_ends") == 1, F.col("end_id").cast("string")).otherwise("")
    few = nodes.where("n_ends < 2").select(*columns, F.sha2(one, 256).alias("ends_sha256"))
    many = nodes.where("n_ends > 1").join(ends, "end_id").select(*columns, "ends_sha256")
    return few.unionByName(many)
