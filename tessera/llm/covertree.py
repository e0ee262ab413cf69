"""Exact top-k search by inner product with a dual-tree pass over cover trees.

Vectors are quantised to integers. The top level of the index is a set of centres, spread by farthest-first choice over a
bounded sample; every vector belongs to its nearest centre, and a node's covering radius is taken over all its members.
Large nodes are dealt into blocks. Queries form groups in the same way.

Two passes follow. The first searches each group in its own node, which gives every group its worst k-th score so
far. The second visits those other nodes whose bound can still reach it. A task holds one block of data, builds its cover
tree once and lets the groups of queries stream past; each group becomes a cover tree too, and pairs of tree nodes are
pruned by their covering radii against the worst k-th score of the query node. A level of a tree covers its points by at
most FAN balls around points that farthest-first choice takes, which keeps them as far apart as the level's radius. Scores
are exact integers; at the end the partial lists of a query, at most k rows a block, are merged. Nothing is sampled but
the centres, which affect speed only.

Pruning needs data with structure: where vectors lie in random directions of many dimensions, hardly a ball of several
is bounded below a query's k-th score, and a good part of the pairs is scored, in blocked products (figures in the README).

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of different
lengths do not meet; rows stay apart by a row id, so a query excludes its own row only; fewer candidates than k
give shorter lists; products are exact while they fit a long and are held at its limits beyond; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import map_column, prepare, staged, table
from tessera.llm.vectors import numbered, valid_vectors

EVERY, TOP, SCALE = 50, 5, 256
#: Rows of a block of data: a share of the table between these bounds, and bytes of its vectors at most.
LEAST_BLOCK, MOST_BLOCK, SHARES, BLOCK_BYTES = 2048, 1 << 16, 32, 1 << 25
#: Rows of a group of queries, about, and of all the groups that pass one copy of a block.
GROUP, STREAM = 1024, 1 << 18
#: Rows that centres are chosen from, and centres at most.
SAMPLE, CENTRES = 4096, 256
#: Points of a leaf of data and of queries; balls of a level at most, the shrinking of radii they aim at, and levels at most.
LEAF, ASKED_LEAF, FAN, SHRINK, DEPTH = 8, 1, 16, 0.5, 40
#: Points whose scores are made at a time, at first and at most.
FIRST, STEP = 128, 4096
#: Stands for no score.
NONE = -(2**63 - 1)


def quantised(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64))


def packed(x: np.ndarray) -> bytes:
    """A quantised vector in bytes, with the width of its numbers first."""
    return b"\2" + x.astype("<i2").tobytes() if np.abs(x).max(initial=0) < 1 << 15 else b"\x08" + x.astype("<f8").tobytes()


def unpacked(vectors: list[bytes]) -> np.ndarray:
    """(rows, length) of packed vectors of one length."""
    if all(v[0] == 2 for v in vectors):
        return np.frombuffer(b"".join(v[1:] for v in vectors), "<i2").reshape(len(vectors), -1).astype(np.float64)
    return np.asarray([np.frombuffer(v[1:], "<i2" if v[0] == 2 else "<f8") for v in vectors], np.float64)


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products; floats while all sums are exact, whole numbers of any size beyond."""
    most = np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * queries.shape[1]
    if most < 2.0**53:
        return (queries @ data.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in data]
    limit = 2**63 - 1
    return np.asarray([[max(-limit, min(limit, sum(int(a) * b for a, b in zip(q, d, strict=True)))) for d in whole] for q in queries], np.int64)


@dataclass
class Tree:
    """A cover tree in breadth-first order: balls around points, the children of a node and its points as ranges."""

    order: np.ndarray  # positions of the points, so that those of any node are a range
    centre: np.ndarray  # (nodes, length)
    radius: np.ndarray
    norm: np.ndarray  # of the centres
    longest: np.ndarray  # greatest norm of a point
    points: np.ndarray  # (nodes, 2): range in order
    children: np.ndarray  # (nodes, 2): range of nodes, empty for a leaf


def _level(x: np.ndarray, far: np.ndarray, reach: float) -> np.ndarray:
    """The nearest of at most FAN balls for each point, by farthest-first choice until all lie within reach.

    The point in the middle, from which `far` is measured, is no centre: it would be nearest to most.
    """
    least = np.sqrt(((x - x[far.argmax()]) ** 2).sum(1))
    nearest, count = np.zeros(len(x), int), 1
    while count < FAN and least.max() > reach:
        d = np.sqrt(((x - x[least.argmax()]) ** 2).sum(1))
        closer = d < least
        nearest[closer], least = count, np.minimum(least, d)
        count += 1
    return nearest


def tree(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """Each level covers a node by balls around points of its own; leaves have `leaf` points at most, or one place."""
    order, size = np.arange(len(x)), np.sqrt((x**2).sum(1))
    centre, radius, longest, points, children = [], [], [], [], []
    level = [(0, len(x))] if len(x) else []
    depth = 0
    while level:
        below: list[tuple[int, int]] = []
        first = len(centre) + len(level)
        for low, high in level:
            own = order[low:high]
            at = x[own]
            # the first point of a ball is its centre
            far = np.sqrt(((at - at[0]) ** 2).sum(1))
            centre.append(at[0])
            radius.append(float(far.max()))
            longest.append(float(size[own].max()))
            points.append((low, high))
            start = first + len(below)
            if high - low > leaf and radius[-1] > 0 and depth < DEPTH:
                nearest = _level(at, far, SHRINK * radius[-1])
                by = np.argsort(nearest, kind="stable")
                order[low:high] = own[by]
                cuts = [0, *(np.flatnonzero(np.diff(nearest[by])) + 1).tolist(), high - low]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    # put the point nearest to the middle first
                    part = order[low + a : low + b]
                    middle = int(((x[part] - x[part].mean(0)) ** 2).sum(1).argmin())
                    part[[0, middle]] = part[[middle, 0]]
                    below.append((low + a, low + b))
            children.append((start, first + len(below)))
        level, depth = below, depth + 1
    centre = np.asarray(centre).reshape(len(centre), x.shape[1])
    ranges = [np.asarray(r, np.int64).reshape(-1, 2) for r in (points, children)]
    return Tree(order, centre, np.asarray(radius), np.sqrt((centre**2).sum(1)), np.asarray(longest), *ranges)


def _ranges(first: np.ndarray, upto: np.ndarray) -> np.ndarray | slice:
    """The numbers of all ranges in order; a slice where they are one range."""
    if (first[1:] == upto[:-1]).all():
        return slice(int(first[0]), int(upto[-1]))
    count = upto - first
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def bounds(q: Tree, i: int, d: Tree, nodes: np.ndarray) -> np.ndarray:
    """The most that a query of node i can score in each of the nodes, by the covering radii."""
    product = d.centre[_ranges(nodes, nodes + 1)] @ q.centre[i]
    r, s = q.radius[i], d.radius[nodes]
    linear = product + q.norm[i] * s + d.norm[nodes] * r + r * s
    # points that are far apart score little for their norms
    apart = np.sqrt(np.maximum(q.norm[i] ** 2 + d.norm[nodes] ** 2 - 2 * product, 0)) - r - s
    most = np.minimum(linear, (q.longest[i] ** 2 + d.longest[nodes] ** 2 - np.maximum(apart, 0) ** 2) / 2)
    return most + 1e-9 * (np.abs(most) + q.longest[i] ** 2 + d.longest[nodes] ** 2) + 1  # above any rounding


def dual_search(queries: np.ndarray, query_rows: np.ndarray, data: np.ndarray, index: Tree, rows: np.ndarray, ids: np.ndarray, k: int, known: np.ndarray):
    """The k best (score, position) of every query over the data but its own row, and how many pairs were scored.

    index is the tree of the data; ids orders ties; known are scores to reach, from before. Positions index data; lists
    are padded by -1.
    """
    score = np.full((len(queries), k), NONE, np.int64)
    at = np.full((len(queries), k), -1, np.int64)
    worst, worst_place = known.copy(), np.full(len(queries), len(data))
    place = np.argsort(np.argsort(ids, kind="stable"), kind="stable")  # of each row among ties
    in_order, order_rows, order_place = data[index.order], rows[index.order], place[index.order]
    scored = 0

    def base(own: np.ndarray, part: np.ndarray | slice) -> None:
        s = products(queries[own], in_order[part])
        least = worst[own][:, None]
        useful = (s > least) | ((s == least) & (order_place[part][None, :] < worst_place[own][:, None]))
        useful &= query_rows[own][:, None] != order_rows[part][None, :]
        positions = index.order[part]
        for i in np.flatnonzero(useful.any(1)).tolist():
            one = own[i]
            new = np.flatnonzero(useful[i])
            if len(new) > 4 * k:  # all ties with the k-th best stay
                new = new[s[i, new] >= -np.partition(-s[i, new], k - 1)[k - 1]]
            all_s, all_at = np.concatenate([score[one], s[i, new]]), np.concatenate([at[one], positions[new]])
            best = np.lexsort((np.where(all_at < 0, len(place), place[all_at]), -all_s, all_at < 0))[:k]
            score[one], at[one] = all_s[best], all_at[best]
            if at[one, -1] >= 0 and score[one, -1] >= worst[one]:
                worst[one], worst_place[one] = score[one, -1], place[at[one, -1]]

    def expanded(nodes: np.ndarray) -> np.ndarray:
        """The children of inner nodes, and leaves as they are."""
        if not len(nodes):
            return nodes
        first, upto = index.children[nodes].T
        inner = upto > first
        found = _ranges(np.where(inner, first, nodes), np.where(inner, upto, nodes + 1))
        return np.arange(found.start, found.stop) if isinstance(found, slice) else found

    def search(own: np.ndarray, leaves: np.ndarray, reach: np.ndarray) -> None:
        """Leaves that still reach the k-th scores, as they lie; without such scores the likeliest few first, to set them."""
        nonlocal scored
        size = index.points[leaves, 1] - index.points[leaves, 0]
        rest = np.ones(len(leaves), bool)
        step = STEP
        if worst[own].min() == NONE:
            step = FIRST
            best = np.argsort(-reach, kind="stable")
            todo = best[: int(np.searchsorted(np.cumsum(size[best]), FIRST)) + 1]
        else:
            lying = np.argsort(index.points[leaves, 0])
            todo = lying[: int(np.searchsorted(np.cumsum(size[lying]), STEP)) + 1]
        while len(todo):
            rest[todo] = False
            low, high = index.points[leaves[todo]].T
            part = _ranges(low, high)
            if isinstance(part, slice):
                for a in range(part.start, part.stop, STEP):
                    base(own, slice(a, min(part.stop, a + STEP)))
            else:
                for a in range(0, len(part), STEP):
                    base(own, part[a : a + STEP])
            scored += int(size[todo].sum()) * len(own)
            left = np.flatnonzero(rest & (reach >= worst[own].min())) if rest.any() else rest[:0]
            left = left[np.argsort(index.points[leaves[left], 0])] if len(left) else np.zeros(0, np.int64)
            step = min(STEP, 4 * step)
            todo = left[: int(np.searchsorted(np.cumsum(size[left]), step)) + 1]

    def visit(i: int, nodes: np.ndarray) -> None:
        own = asked.order[slice(*asked.points[i])]
        first, upto = asked.children[i]
        leaves: list[tuple[np.ndarray, np.ndarray]] = []
        while len(nodes):
            reach = bounds(asked, i, index, nodes)
            live = reach >= worst[own].min()
            nodes, reach = nodes[live], reach[live]
            if upto > first:
                break
            leaf = index.children[nodes, 1] == index.children[nodes, 0]
            leaves.append((nodes[leaf], reach[leaf]))
            nodes = expanded(nodes[~leaf])
        if upto == first:
            return search(own, *map(np.concatenate, zip(*leaves, strict=True)))
        if len(nodes):
            below = expanded(nodes)
            for child in range(first, upto):
                visit(child, below)

    if len(queries) and len(data):
        asked = tree(queries, ASKED_LEAF)
        visit(0, np.zeros(1, np.int64))
    return score, at, scored


def centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first centres, starting with the first vector."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _assigned(rows: DataFrame, middle: np.ndarray) -> DataFrame:
    """(row, vec_id, asked, node, far, vector): packed vectors with their nearest centre and the distance to it.

    Vectors of another length than the centres form one node a length, numbered below 0, around the origin.
    """
    square = (middle**2).sum(1)

    def make():
        def work(vectors: list[list[float]]) -> list[list]:
            node, far, out = [0] * len(vectors), [0.0] * len(vectors), [b""] * len(vectors)
            of: dict[int, list[int]] = {}
            for k, v in enumerate(vectors):
                of.setdefault(len(v), []).append(k)
            for length, members in of.items():
                x = quantised(np.asarray([vectors[k] for k in members], np.float64))
                if length == middle.shape[1]:
                    near = (square[None, :] - 2 * x @ middle.T).argmin(1)
                    away = np.sqrt(((x - middle[near]) ** 2).sum(1))
                else:
                    near, away = np.full(len(x), -length), np.sqrt((x**2).sum(1))
                for k, n, d, v in zip(members, near.tolist(), away.tolist(), x, strict=True):
                    node[k], far[k], out[k] = n, d, packed(v)
            return [node, far, out]

        return work

    return map_column(rows, ["row", "vec_id", "asked"], "embedding", make, "node int, far double, vector binary")


_FOUND = "query long, row long, vec_id long, score long"
_CELL = ["to_node", "to_part", "stream"]


def _searched(both: DataFrame, k: int) -> DataFrame:
    """Partial lists from rows (to_node, to_part, stream, query, node, part, row, vec_id, vector, known).

    Rows of a cell arrive with the data first, then the groups of queries one after another: a task holds one block with
    its tree and one group.
    """
    import pyarrow as pa

    names = ["query", "row", "vec_id", "score"]
    array = lambda part, column: np.asarray([g[column] for g in part], np.int64)

    def run(batches):
        cell, data, index, rows, ids, shown, group = None, [], None, None, None, None, []

        def done() -> list[tuple[int, int, int | None, int]]:
            """Search of the group at hand in the block at hand."""
            nonlocal index, rows, ids, shown, data, x
            if not group or (index is None and not data):
                return []
            if index is None:
                x, rows, shown = unpacked([g[8] for g in data]), array(data, 6), [g[7] for g in data]
                ids, index, data = np.asarray([2**63 - 1 if v is None else v for v in shown], np.int64), tree(x), []
            score, at, _ = dual_search(unpacked([g[8] for g in group]), array(group, 6), x, index, rows, ids, k, array(group, 9))
            return [(group[q][6], int(rows[at[q, j]]), shown[at[q, j]], int(score[q, j])) for q, j in np.argwhere(at >= 0).tolist()]

        x = None
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != cell:
                    found += done()
                    cell, data, index, group = row[:3], [], None, []
                elif group and row[4:6] != group[0][4:6]:
                    found += done()
                    group = []
                (group if row[3] else data).append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)
        if found := done():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    dealt = both.repartition(*_CELL).sortWithinPartitions(*_CELL, "query", "node", "part", "row")
    return dealt.mapInArrow(run, _FOUND)


def top_k(vectors: DataFrame, is_query, k: int = TOP, block: int | None = None, group: int = GROUP, stream: int = STREAM) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows for each row that is_query (a column) marks."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = numbered(vectors.where(valid_vectors(vectors)).select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asked")))
    common = rows.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not common:
        return empty
    total, length = common[0]["rows"], common[0]["n"]
    block = block or max(1, min(max(LEAST_BLOCK, min(MOST_BLOCK, total // SHARES)), BLOCK_BYTES // (8 * length)))
    drawn = rows.where(F.size("embedding") == length).orderBy(F.xxhash64("row"), "row").select("embedding").limit(SAMPLE).collect()
    middle = centres(quantised(np.asarray([r["embedding"] for r in drawn], np.float64)), max(1, min(CENTRES, -(-total // block))))
    placed = staged(_assigned(rows, middle), "placed")
    stats = placed.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.count_if("asked").alias("asked"), F.max(F.when(F.col("asked"), F.col("far"))).alias("asked_far")
    ).collect()  # a row a centre, and one for each other length
    size = {s["node"]: s for s in stats}
    blocks = {n: -(-s["n"] // block) for n, s in size.items()}
    groups = {n: -(-s["asked"] // group) for n, s in size.items()}
    of_nodes = spark.createDataFrame([(n, blocks[n], max(1, groups[n])) for n in size], "at_node int, blocks int, groups int")
    deal = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "row"), F.col(count)).cast("int")
    dealt = placed.join(of_nodes, F.col("node") == F.col("at_node"))  # as few rows as stats; Spark broadcasts them by their size
    data = dealt.select("node", deal(1, "blocks").alias("to_part"), "row", "vec_id", "vector")
    asked = dealt.where("asked").select("node", deal(2, "groups").alias("part"), "row", "vec_id", "vector")

    def search(asked: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        """Groups of queries of node a against all blocks of node b, for the node pairs (a, b), of which there are CENTRES squared at most."""
        visitors: dict[int, int] = {}
        for a, b in pairs:
            visitors[b] = visitors.get(b, 0) + size[a]["asked"]
        streams = {b: -(-n // stream) for b, n in visitors.items()}
        to = spark.createDataFrame([(a, b, blocks[b], streams[b]) for a, b in pairs], "of_node int, to_node int, blocks int, streams int")
        copies = spark.createDataFrame(list(streams.items()), "to_node int, streams int")
        ours = asked.join(to, F.col("node") == F.col("of_node")).withColumn("to_part", F.explode(F.expr("sequence(0, blocks - 1)")))
        own = F.pmod(F.xxhash64("node", "part"), F.col("streams")).cast("int").alias("stream")
        ours = ours.select("to_node", "to_part", own, F.lit(True).alias("query"), "node", "part", "row", "vec_id", "vector", "known")
        theirs = data.join(copies, F.col("node") == F.col("to_node")).withColumn("stream", F.explode(F.expr("sequence(0, streams - 1)")))
        zero = [F.lit(0).alias("part"), "row", "vec_id", "vector", F.lit(0).cast("long").alias("known")]
        theirs = theirs.select("to_node", "to_part", "stream", F.lit(False).alias("query"), "node", *zero)
        return _searched(theirs.unionByName(ours), k)

    asking = [n for n, s in size.items() if s["asked"]]
    if not asking:
        return empty
    least = F.lit(NONE).cast("long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    home = staged(search(asked.withColumn("known", least), [(n, n) for n in asking]), "home")
    kth = home.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == k).select(F.col("query").alias("of_query"), F.col("score").alias("kth"))
    asked = staged(asked.join(kth, F.col("row") == F.col("of_query"), "left").withColumn("known", F.coalesce("kth", least)).drop("of_query", "kth"), "asked")
    worst = {r["node"]: r["worst"] for r in asked.groupBy("node").agg(F.min("known").alias("worst")).collect()}
    norm = np.sqrt((middle**2).sum(1))
    pairs = []
    for a in asking:  # the nodes number CENTRES at most
        for b, s in size.items():
            if a == b or min(a, b) < 0:
                continue
            r, far, product = size[a]["asked_far"], s["far"], float(middle[a] @ middle[b])
            most = product + norm[a] * far + norm[b] * r + r * far
            apart = max(0.0, float(np.sqrt(((middle[a] - middle[b]) ** 2).sum())) - r - far)
            most = min(most, ((norm[a] + r) ** 2 + (norm[b] + far) ** 2 - apart**2) / 2)
            if most + 1e-9 * ((norm[a] + r) ** 2 + (norm[b] + far) ** 2) + 1 >= worst[a]:
                pairs.append((a, b))
    found = home.unionByName(search(asked, pairs)) if pairs else home
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = placed.where("asked").select(F.col("row").alias("of_query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, F.col("query") == F.col("of_query")).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = f"""
with own as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
  from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.row, q.vec_id as query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint as score,
    row_number() over (partition by q.row order by list_inner_product(q.v, d.v) desc, d.vec_id, d.row) as nth
  from own q join own d on q.vec_id % {EVERY} = 0 and q.row <> d.row and len(q.v) = len(d.v))
select query_id, nth::integer as rank, vec_id, score from scored where nth <= {TOP}
"""
