"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

1. Each whole text becomes its set of distinct word shingles, a digest of that set, and the band keys of its sketch.
   Texts with equal sets form one class, so thousands of copies count once from here on.
2. Classes that share a band key form a bucket; buckets with the same members count once. At 64 coordinates in bands of
   four (three where the threshold is 0.8), a pair at the threshold shares no bucket with probability below 1e-5.
3. Buckets are verified in blocks: members are dealt into blocks of about BLOCK, every pair of blocks goes to one task
   together with the full sets, and the task returns only a spanning forest of the links it confirms. No pair of a
   bucket is left out, however large the bucket, and no list of pairs is ever made.
4. Connected components over the confirmed links give each class, and so each row, the smallest id it can reach.

Defined cases: a null text, or one without words, has an empty set and links with nothing; a text of fewer than five words
is one shingle; rows are the nodes, so rows with equal ids and different texts may lie in different components; a null
id never is the smallest unless no other is there, and then the component's id is null; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import TEXTS_A_PART, map_column, prepare, sized, staged, table
from tessera.llm.components import components
from tessera.llm.shingles import WIDTH, shingle_sets
from tessera.llm.sketch import bands, rows_for, sketches

#: Link where 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Members of a block of a bucket, about.
BLOCK = 256
#: Groups up to this many members are compared pair by pair.
SMALL = 12
_COLUMNS = 4096
#: Tells texts of equal ids apart; 42, the seed, for a null text.
TEXT_KEY = "xxhash64(text)"


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def prefix(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The least hashes of a set, so many that two sets that link have one of them in common."""
    least = -(-percent * len(shingles) // 100)  # shared shingles that a link needs at least
    return shingles[: len(shingles) - least + 1].view(np.int64)


def sketch_documents(docs: DataFrame, percent: int, exact: bool = False) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, bands; digest and bands are null where there is no word.

    With exact, the bands are the prefix of the set instead: no link is missed, for as many keys as shingles may differ.
    """
    rows = rows_for(percent / 100)

    def make():
        def work(texts: list[str | None]) -> list[list]:
            sets = shingle_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            digests, keys = [None] * len(sets), [None] * len(sets)
            if exact:
                found = [prefix(sets[i], percent) for i in full]
            else:
                found = bands(sketches([sets[i] for i in full]), rows) if full else ()
            for i, row in zip(full, found, strict=True):
                digests[i], keys[i] = _digest(sets[i]), row
            return [[len(s) for s in sets], digests, keys]

        return work

    docs = docs.withColumn("text_key", F.expr(TEXT_KEY))
    return map_column(docs, ["doc_id", "text_key"], "text", make, "n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """digest and the set itself, as packed 64-bit hashes, of texts that have words."""

    def make():
        def work(texts: list[str | None]) -> list[list]:
            sets = shingle_sets(texts)
            return [[_digest(s) if len(s) else None for s in sets], [s.tobytes() for s in sets]]

        return work

    return map_column(docs, [], "text", make, "digest binary, shingles binary").where("digest is not null")


def _linked(shared, one, other, percent: int):
    return 100 * shared >= percent * (one + other - shared)


def forest(sets: list[np.ndarray], sides: list[int] | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with sides, of the links between sets of different sides."""
    n, root, out = len(sets), list(range(len(sets))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.asarray([len(s) for s in sets], np.int64)
    if n <= SMALL:
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n) if sides is None or sides[i] != sides[j]]
        for i, j in pairs:
            few, many = sorted((sizes[i], sizes[j]))
            if 100 * few < percent * many or find(i) == find(j):
                continue
            if _linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), few, many, percent):
                root[find(i)] = find(j)
                out.append((i, j))
        return out
    ids, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(n), sizes)
    place = np.cumsum(often > 1) - 1
    useful = often[at] > 1
    member, column = member[useful], place[at[useful]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        low, high = np.searchsorted(column, [start, start + _COLUMNS])
        part = np.zeros((n, _COLUMNS), np.float32)
        part[member[low:high], column[low:high] - start] = 1
        shared += part @ part.T
    links = _linked(shared.astype(np.int64), sizes[:, None], sizes[None, :], percent)
    if sides is not None:
        side = np.asarray(sides)
        links &= side[:, None] != side[None, :]
    reached = np.zeros(n, bool)
    for first in range(n):
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


def _verify(work: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) from rows (bucket, one, other, side, digest, shingles), grouped by the first three."""
    import pyarrow as pa

    def links(group: list) -> list[tuple[bytes, bytes]]:
        crossed = group[0][1] != group[0][2]
        found = forest([np.frombuffer(g[5], np.uint64) for g in group], [g[3] for g in group] if crossed else None, percent)
        return [(group[i][4], group[j][4]) for i, j in found]

    def run(batches):
        group: list = []
        for batch in batches:
            edges: list[tuple[bytes, bytes]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    edges += links(group)
                    group = []
                group.append(row)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*edges, strict=True)], names=["a", "b"])
        if group and (edges := links(group)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*edges, strict=True)], names=["a", "b"])

    key = ["bucket", "one", "other"]
    dealt = work.select(*key, "side", "digest", "shingles").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key and root for every row; root names the component, null without shingles.

    exact takes candidates by prefixes of the sets instead of bands of sketches, at the price of more buckets.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketched = staged(sketch_documents(docs, percent, exact), "sketches")
    rows = sketched.count()
    classes = sketched.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = staged(classes, "classes", rows)
    members = classes.select("digest", "rep", F.explode("bands").alias("bucket"))
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "digest"))
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), mark(1).alias("x"), mark(2).alias("y")).where("n > 1")
    # buckets with the same members count once
    buckets = buckets.groupBy("n", "x", "y").agg(F.min("bucket").alias("of_bucket"))
    buckets = staged(buckets.select("of_bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "buckets", rows)
    found = members.join(buckets, F.col("bucket") == F.col("of_bucket"))
    found = staged(found.select("digest", "rep", "bucket", "blocks"), "members", rows)
    mine = F.pmod(F.xxhash64(F.lit(3), "digest"), F.col("blocks")).cast("int")
    dealt = found.withColumn("mine", mine).withColumn("beside", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select(
        "bucket", F.least("mine", "beside").alias("one"), F.greatest("mine", "beside").alias("other"), F.col("mine").alias("side"), F.col("digest").alias("of_class")
    )
    wanted = found.select(F.col("rep").alias("wanted")).distinct()
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = _sets(texts).groupBy("digest").agg(F.first("shingles").alias("shingles"))
    labels = components(_verify(dealt.join(sets, F.col("of_class") == F.col("digest")), percent), rows)
    named = labels.join(classes.select("digest", "rep"), F.col("node") == F.col("digest")).select("node", "root", "rep")
    least = named.groupBy("root").agg(F.min("rep").alias("component")).select(F.col("root").alias("of_root"), "component")
    named = staged(named.join(staged(least, "roots", rows), F.col("root") == F.col("of_root")).select("node", "root", "component"), "named", rows)
    classes = classes.join(named, F.col("digest") == F.col("node"), "left")
    classes = staged(classes.select(F.col("digest").alias("of_class"), F.coalesce("component", "rep").alias("component"), F.coalesce("root", "digest").alias("root")), "class-names", rows)
    out = sketched.drop("bands").join(classes, F.col("digest") == F.col("of_class"), "left")
    out = out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key", "root")


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: one of each component, by the smallest id (null last) and then text key.

    Of rows without shingles one stays for each id and text.
    """
    found = near_duplicates(docs, percent).withColumn("alone", F.when(F.col("root").isNull(), F.struct("doc_id", "text_key")))
    least = found.groupBy("root", "alone").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"))
    kept = staged(least.select(F.col("least.doc_id").alias("of_doc"), F.col("least.text_key").alias("of_key")), "kept", docs.count())
    docs = docs.withColumn("text_key", F.expr(TEXT_KEY))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_key"))
    stay = docs.join(kept, same, "left_semi")
    first = Window.partitionBy("doc_id", "text_key").orderBy("doc_id")
    stay = stay.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth", "text_key")
    return sized(stay, kept.count(), TEXTS_A_PART)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = f"""
with recursive split as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select row, doc_id, case when len(w) >= {WIDTH} then list_distinct(list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else []::varchar[] end as shingles from split),
items as (select row, len(shingles) as n, unnest(shingles) as item from sets),
links as (
  select a.row as a, b.row as b from items a join items b on a.item = b.item and a.row <> b.row
  group by a.row, b.row, a.n, b.n having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach as (select row as a, row as b from sets union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select reach.a as row, min(sets.doc_id) as component_id from reach join sets on reach.b = sets.row group by reach.a)
select doc_id, len(shingles)::bigint as n_shingles, case when len(shingles) > 0 then component_id else doc_id end as component_id,
  case when len(shingles) > 0 then component_id is not distinct from doc_id else true end as kept
from sets join least using (row)
"""
