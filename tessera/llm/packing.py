"""Packing of documents into token sequences by a plan over the histogram of lengths.

Documents are tokenised and cut once into a staged table of pieces. Only the histogram of piece lengths, at most as many
rows as a sequence has tokens, reaches the driver. There best-fit decreasing runs over counts: runs of equal bins take
runs of equal pieces, so planning costs by distinct lengths and not by documents. The plan is a list of runs of slots
(length, first rank, first sequence, offset); a piece finds its slot by its rank within its length. Ranks are made
in two levels (within a bucket of a length, plus the count of the buckets before), so that no length, however common, is
ordered by one task.

Defined cases: a null or empty text is a document of one token (the end token); equal rows are interchangeable and each
gets its own slot; an empty table packs into nothing; other columns are ignored, whatever their names. The strings of
added tokens in a text have their ids from the tokenizers file.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.bpe import vocabulary
from tessera.llm.common import map_column, staged, table

CAPACITY = 2048
END = 0
#: Pieces in a rank bucket, on average; the number of buckets follows the table.
BUCKET = 20_000
#: Texts with a run of as much white space are split before the merges; a backtracking split gives up on longer runs.
LONG_SPACE = 10_000


def vocabulary_bytes(names: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary with its entries as bytes.

    Such files write a byte as one character: the printable ones of Latin-1 as themselves, the others in order from 256.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in shown)
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return {bytes(map(byte.__getitem__, name)): i for name, i in names.items()}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """A function from a text to its ids as an array of 32-bit integers, those of added tokens included.

    The vocabulary is read from the tokenizers file, whose ids rank its merges. tiktoken runs them: it gives the same ids
    as the tokenizers library (compared in the tests) in a quarter of its time and without a cache of words.
    """
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ranks = vocabulary_bytes(tokenizer.get_vocab(with_added_tokens=False))
    known = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
    own = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=known)
    allowed, split = set(known), regex.compile(pattern).findall
    long_space = regex.compile(rf"\s{{{LONG_SPACE}}}").search
    marks = regex.compile("(" + "|".join(map(regex.escape, sorted(known, key=len, reverse=True))) + ")") if known else None

    def in_pieces(text: str) -> np.ndarray:
        """The same ids, with the split made outside the library."""
        ids = array("I")
        for k, part in enumerate(marks.split(text) if marks else [text]):
            if k % 2:
                ids.append(known[part])
                continue
            for token in split(part):
                piece = token.encode()
                rank = ranks.get(piece)
                ids.extend(own._encode_single_piece(piece) if rank is None else (rank,))
        return np.frombuffer(ids, np.uint32)

    def encode(text: str) -> np.ndarray:
        if len(text) >= LONG_SPACE and long_space(text):
            return in_pieces(text)
        return own.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

    return encode


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents with their end token, cut where over capacity.

    All pieces but the first are full, so a cut document leaves one remainder to be packed.
    """
    end = np.asarray([END], dtype="<u4").tobytes()

    def make():
        own = encoder(path, pattern)

        def work(texts: list[str | None]):
            index, columns = [], [[] for _ in range(4 + with_ids)]
            for i, text in enumerate(texts):
                ids = (own(text).astype("<u4").tobytes() if text else b"") + end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    upto = at + (n - at - 1) % capacity + 1
                    part = ids[4 * at : 4 * upto]
                    index.append(i)
                    for column, value in zip(columns, (k, at, upto - at, zlib.crc32(part), part), strict=False):
                        column.append(value)
                    at, k = upto, k + 1
            return index, columns

        return work

    schema = "piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_column(docs, ["doc_id"], "text", make, schema, rows=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts: rows (length, first rank, first sequence, offset), ordered by length and rank.

    free[r] holds runs (first sequence, count) of bins with r tokens left. Each length takes the runs with the least
    room that suffices, whole or in part; when none is left it opens as many bins as it fills. Work and plan grow with
    the distinct lengths and the runs they split, not with the pieces.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    slots, opened = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        room = length
        while left:
            while room <= capacity and not free[room]:
                room += 1
            if room > capacity:
                new = -(-left // (capacity // length))
                free[capacity].append((opened, new))
                opened, room = opened + new, capacity
            first, count = free[room].pop()
            take = min(count, left)
            if take < count:
                free[room].append((first + take, count - take))
            slots.append((length, rank, first, capacity - room))
            free[room - length].append((first, take))
            rank, left = rank + take, left - take
            room = room - length if room - length >= length else room
    return np.asarray(sorted(slots), dtype=np.int64).reshape(-1, 4)


def slots_for(spark: SparkSession, slots: np.ndarray, capacity: int):
    """A function of the columns (length, rank) that gives the slot (sequence_id, offset)."""
    shift = np.int64(48)
    known = spark.sparkContext.broadcast((slots[:, 0] << shift | slots[:, 1], slots[:, 2], slots[:, 3], slots[:, 1]))

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, offset, at_rank = known.value
        ranks = rank.to_numpy(np.int64)
        at = np.searchsorted(keys, length.to_numpy(np.int64) << shift | ranks, side="right") - 1
        return pd.DataFrame({"sequence_id": first[at] + ranks - at_rank[at], "offset": offset[at]})

    return slot


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): every piece with its place."""
    spark = docs.sparkSession
    # every piece carries an id of its own within the staged table, so that equal rows spread over the buckets too
    cut = staged(pieces(docs, path, pattern, capacity, with_ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    buckets = max(64, -(-cut.count() // BUCKET))
    spread = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")
    # the counts of buckets are summed per length: at most capacity rows leave
    counts = cut.groupBy("length", spread.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts, "piece-counts")
    found = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = plan({row["length"]: row["n"] for row in found}, capacity)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = cut.withColumn("bucket", spread).withColumn("nth", F.row_number().over(within))
    here = (ranked["length"] == before["of_length"]) & (ranked["bucket"] == before["of_bucket"])
    placed = ranked.join(before, here).withColumn("rank", F.col("nth") - 1 + F.col("before"))
    slot = slots_for(spark, slots, capacity)
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = placed.withColumn("slot", slot("length", "rank"))
    return placed.select(*kept, "slot.sequence_id", "slot.offset", *(["ids"] if with_ids else []))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Pack by the 50k byte-level vocabulary with production parameters."""
    import public_tokenizers

    return pack(docs, vocabulary("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
