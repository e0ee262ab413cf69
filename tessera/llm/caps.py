"""Near-duplicate vectors by spherical-cap filters.

Filters are the directions of a structured random product code: a vector is rotated and cut into blocks, each block has
a codebook of random directions, and a filter is one codeword a block. A vector's list holds all filters whose direction
it exceeds a threshold with; list decoding finds them by combining the blocks' sorted scores, without visiting the other
filters. The size of the code follows the number of vectors, so that a filter holds about one of them by chance; the
threshold is set on random directions for lists of LIST filters, and a vector with too few (least_list) takes its best ones.

Vectors of one label with a common filter meet in a bucket. Equal vectors form one class beforehand. Buckets are verified
in blocks of about BLOCK members with all pairs of blocks, in double precision; a pair counts only in the least filter
that both lists hold, so each link counts once. A task returns sums and a spanning forest, never pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link
with nothing; vectors of different lengths do not link; rows are the nodes, so rows with equal ids stay apart; a null
id never is the smallest unless no other is there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_column, prepare, staged, table
from tessera.llm.components import components
from tessera.llm.vectors import by_group, numbered, valid_vectors

COSINE = 0.98
#: Filters of a vector on average, and at least; the least list doubles for every DOUBLES doublings of the table beyond 2**FULL.
LIST, LEAST, FULL, DOUBLES = 48, 16, 17, 4.5
#: Members of a block of a bucket, about.
BLOCK = 512
#: Codes of more filters than this are made of four blocks instead of two.
TWO_BLOCKS = 1 << 25


def _pairs(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], least: float, width: int):
    """All sums of two score lists of at least `least`, with the ids first * width + second."""
    (s, i), (t, j) = one, other
    if not len(s) or not len(t):
        return np.zeros(0), np.zeros(0, np.int64)
    s_order, t_order = np.argsort(-s, kind="stable"), np.argsort(-t, kind="stable")
    s, i, t, j = s[s_order], i[s_order], t[t_order], j[t_order]
    counts = np.searchsorted(-t, s - least, side="right")
    first = np.repeat(np.arange(len(s)), counts)
    second = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
    return s[first] + t[second], i[first] * width + j[second]


@dataclass
class Code:
    """A product code over vectors of one length."""

    rotation: np.ndarray
    books: np.ndarray  # (blocks, words, block length)
    least: float

    @property
    def words(self) -> int:
        return self.books.shape[1]

    def scores(self, unit: np.ndarray) -> np.ndarray:
        """(rows, blocks, words) inner products."""
        blocks, _, length = self.books.shape
        turned = unit @ self.rotation
        return np.einsum("rbl,bwl->rbw", turned.reshape(len(unit), blocks, length), self.books, optimize=True)

    def decode(self, scores: np.ndarray, least: float, fewest: int) -> np.ndarray:
        """The filters of one vector, from its scores (blocks, words); falls back to lower thresholds for `fewest`."""
        while True:
            tops = scores.max(1).tolist()
            total, width = sum(tops), self.words
            useful = [np.flatnonzero(s >= least - (total - top)) for s, top in zip(scores, tops, strict=True)]
            lists = [(s[u], u) for s, u in zip(scores, useful, strict=True)]
            while len(lists) > 1:  # neighbours merge; the rest can add no more than its best scores
                both = [tops[k] + tops[k + 1] for k in range(0, len(tops), 2)]
                lists = [_pairs(lists[2 * k], lists[2 * k + 1], least - (total - top), width) for k, top in enumerate(both)]
                tops, width = both, width * width
            found, ids = lists[0]
            if len(ids) >= fewest or len(ids) == self.words ** len(scores):
                if len(ids) > fewest and least < self.least:
                    ids = ids[np.lexsort((ids, -found))[:fewest]]
                return np.sort(ids)
            least -= 0.02


@lru_cache(maxsize=4)
def code(length: int, count: int, size: int = LIST, seed: int = 5) -> Code:
    """The code for `count` vectors of `length` components, with lists of `size` filters on average."""
    blocks = 2 if count * size <= TWO_BLOCKS else 4
    words = max(4, int(np.ceil((max(1, count) * size) ** (1 / blocks))))
    rng = np.random.default_rng([seed, length, words])
    wide = -(-length // blocks) * blocks
    turn, _ = np.linalg.qr(rng.standard_normal((wide, wide)))
    books = rng.standard_normal((blocks, words, wide // blocks))
    books /= np.linalg.norm(books, axis=2, keepdims=True) * np.sqrt(blocks)
    made = Code(turn[:length], books, 0.0)
    probe = rng.standard_normal((200, length))
    probe /= np.linalg.norm(probe, axis=1, keepdims=True)
    scores, low, high = made.scores(probe), 0.0, 1.0
    for _ in range(30):
        middle = (low + high) / 2
        mean = np.mean([len(made.decode(s, middle, 0)) if s.max(1).sum() >= middle else 0 for s in scores]) if middle > 0.2 else np.inf
        low, high = (middle, high) if mean > size else (low, middle)
    made.least = low
    return made


def least_list(count: int) -> int:
    """Filters that every vector has at least: LEAST, and more in large tables, whose longer codes hit a pair less often."""
    return LEAST << max(0, int(np.ceil((np.log2(max(1, count)) - FULL) / DOUBLES)))


def filters(classes: DataFrame, count: int, size: int, wide: bool, exact: bool) -> DataFrame:
    """(class, label, n, vector in bytes, list of filters) of (class, label, n, embedding); exact gives all one filter."""
    least = least_list(count)

    def make():
        def work(vectors: list[list[float]]) -> list[list]:
            out: list = [[0]] * len(vectors)
            of: dict[int, list[int]] = {}
            for k, v in enumerate(vectors if not exact else ()):
                of.setdefault(len(v), []).append(k)
            for length, rows in of.items():
                own = code(length, count, size)
                for at in range(0, len(rows), 256):
                    part = rows[at : at + 256]
                    x = np.asarray([vectors[k] for k in part], np.float64)
                    x = x / np.abs(x).max(1, keepdims=True)
                    scores = own.scores(x / np.linalg.norm(x, axis=1, keepdims=True))
                    for k, s in zip(part, scores, strict=True):
                        out[k] = own.decode(s, own.least, least)
            return [[np.asarray(v, _dtype(wide)).tobytes() for v in vectors], out]

        return work

    return map_column(classes, ["class", "label", "n"], "embedding", make, "vector binary, filters array<long>")


def _dtype(wide: bool) -> str:
    return "<f8" if wide else "<f4"


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    reached, out = np.zeros(len(links), bool), []
    for first in np.flatnonzero(links.any(1)).tolist():
        if reached[first]:
            continue
        reached[first], queue = True, [first]
        while queue:
            i = queue.pop()
            new = np.flatnonzero(links[i] & ~reached)
            reached[new] = True
            queue += new.tolist()
            out += [(i, j) for j in new.tolist()]
    return out


def verify(group: list[tuple], cosine: float, wide: bool = True) -> list[tuple[int, int | None, int]]:
    """Links of a block or of a pair of blocks of the bucket of one filter: (class, null, links) and (class, class, 0)."""
    one, other = group[0][2:4]
    lengths = [len(g[7]) for g in group]
    if len(set(lengths)) > 1:  # vectors of different lengths do not meet
        return [x for n in sorted(set(lengths)) for x in verify([g for g in group if len(g[7]) == n], cosine, wide)]
    x = np.frombuffer(b"".join(g[7] for g in group), _dtype(wide)).reshape(len(group), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    norm = np.sqrt((x * x).sum(1))
    links = (x @ x.T) / (norm[:, None] * norm[None, :]) >= cosine
    np.fill_diagonal(links, False)
    if one != other:
        side = np.asarray([g[4] for g in group])
        links &= side[:, None] != side[None, :]
    near = np.flatnonzero(links.any(1))
    if not len(near):
        return []
    # a pair counts in the least filter that both lists hold
    before = [group[k][8] for k in near]
    names = {f: i for i, f in enumerate(sorted({f for fs in before for f in fs}))}
    if names:
        held = np.zeros((len(near), len(names)), np.float32)
        for k, fs in enumerate(before):
            held[k, [names[f] for f in fs]] = 1
        links[np.ix_(near, near)] &= held @ held.T == 0
    size = np.asarray([g[6] for g in group], np.int64)
    total = links @ size
    out: list[tuple[int, int | None, int]] = [(group[k][5], None, int(total[k])) for k in np.flatnonzero(total).tolist()]
    return out + [(group[i][5], group[j][5], 0) for i, j in _forest(links)]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, size: int = LIST, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    exact compares all vectors of a label by blocks instead of those that share a filter: no link is missed, at a price
    that grows with the square of a label's distinct vectors.
    """
    spark = vectors.sparkSession
    prepare(spark)
    good = valid_vectors(vectors) & F.col("label").isNotNull() & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    mark = lambda seed: F.when(F.col("good"), F.xxhash64(F.lit(seed), "embedding"))
    rows = vectors.select("vec_id", "embedding", "label").withColumn("good", good)
    rows = numbered(rows.withColumn("h1", mark(1)).withColumn("h2", mark(2)))
    same = ["label", "h1", "h2"]
    classes = rows.where("good").groupBy(*same).agg(
        F.min("row").alias("class"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"), F.first("embedding").alias("embedding")
    )
    classes = staged(classes, "vector-classes")
    wide = vectors.schema["embedding"].dataType.elementType.typeName() != "float"
    listed = staged(filters(classes.select("class", "label", "n", "embedding"), classes.count(), size, wide, exact), "filters")
    entries = listed.select("class", "label", F.explode("filters").alias("filter"))
    seen = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "class"))
    buckets = entries.groupBy("label", "filter").agg(F.count(F.lit(1)).alias("members"), seen(1).alias("x"), seen(2).alias("y")).where("members > 1")
    # of buckets with the same members the one of the least filter stays, which is where their pairs count
    buckets = buckets.groupBy("label", "members", "x", "y").agg(F.min("filter").alias("of_filter"))
    buckets = staged(buckets.select(F.col("label").alias("of_label"), "of_filter", F.ceil(F.col("members") / block).cast("int").alias("blocks")), "cap-buckets")
    met = entries.join(buckets, (F.col("label") == F.col("of_label")) & (F.col("filter") == F.col("of_filter")))
    mine = F.pmod(F.xxhash64(F.lit(3), "class"), F.col("blocks")).cast("int")
    met = met.withColumn("mine", mine).withColumn("beside", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.select("label", "filter", F.least("mine", "beside").alias("one"), F.greatest("mine", "beside").alias("other"), F.col("mine").alias("side"), F.col("class").alias("member"))
    whole = listed.select("class", "n", "vector", "filters")
    met = met.join(whole, F.col("member") == F.col("class")).drop("class")
    # the lists are sorted: the part before this filter tells whether a pair met in a lesser one
    before = F.slice("filters", F.lit(1), (F.array_position("filters", F.col("filter")) - 1).cast("int"))
    met = met.select("label", "filter", "one", "other", "side", "member", "n", "vector", before.alias("before"))
    found = staged(by_group(met, ["label", "filter", "one", "other"], lambda g: verify(g, cosine, wide), "a long, b long, links long"), "vector-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    labels = components(found.where("b is not null").select("a", "b"), found.count())
    named = labels.join(classes.select("class", "rep"), F.col("node") == F.col("class")).select("node", "root", "rep")
    least = staged(named.groupBy("root").agg(F.min("rep").alias("component")).select(F.col("root").alias("of_root"), "component"), "vector-roots")
    named = named.join(least, F.col("root") == F.col("of_root")).select("node", "component")
    judged = classes.join(links, F.col("class") == F.col("a"), "left").join(named, F.col("class") == F.col("node"), "left")
    judged = staged(judged.select(
        *(F.col(k).alias(f"of_{k}") for k in same), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    ), "vectors-judged")
    alike = (F.col("label") == F.col("of_label")) & (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))
    out = rows.select("vec_id", "good", *same).join(judged, alike, "left")
    component = F.when(F.col("good"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op3_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
with recursive good as (
  select row_number() over () as row, vec_id, label, embedding::double[] as v,
    embedding is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok
  from embeddings),
links as (
  select a.row as a, b.row as b from good a join good b on a.label = b.label and a.row <> b.row and a.ok and b.ok and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach as (select row as a, row as b from good union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select reach.a as row, min(good.vec_id) as component_id from reach join good on reach.b = good.row group by reach.a),
counted as (select a as row, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id is not distinct from component_id as kept
from good join least using (row) left join counted using (row)
"""
