"""Resampling documents towards a target corpus: hashed n-gram weights, random keys, and the exact cutoff by medians of medians."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.session import stage

#: Words of a feature at most; buckets; percent drawn; words of a document that may be drawn; seed.
NGRAM, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, "2024"
#: Keys of which a task takes one median at a time, and keys that the driver sorts in the end at most.
CHUNK, FEW = 65_536, 4_096
#: Features whose buckets a task remembers, and texts taken together.
KNOWN, TOGETHER = 1_000_000, 500
#: A-Z become lower case; every other byte below 0x80 that is not a digit or a-z ends a word.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


class _Buckets(dict):
    """The bucket of each feature, worked out once while it is remembered."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.n
        return bucket


def _features(text: str | None, ngram: int) -> tuple[int, list[bytes]]:
    """(number of words, all runs of 1 to ``ngram`` consecutive words)."""
    words = (text or "").encode().translate(_WORD_BYTES).split(b" ")
    words = [w for w in words if w]
    out = list(words)
    for n in range(2, ngram + 1):
        out += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), out


def _counted(ngram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                _, features = _features(text.as_py(), ngram)
                if features:
                    total += np.bincount(np.fromiter(map(known.__getitem__, features), np.int64, len(features)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` numbers go to the driver."""
    rows = df.select(F.col(text).alias("text")).mapInArrow(_counted(ngram, buckets), "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, 1000 times the log of how much likelier the target is to show it, floored, with one added to each count."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _weighed(ngram: int, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gain))
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                words, sizes, flat = [], [], []
                for text in part["text"]:
                    n, features = _features(text.as_py(), ngram)
                    words.append(n)
                    sizes.append(len(features))
                    flat.append(np.fromiter(map(known.__getitem__, features), np.int64, len(features)))
                sums = np.concatenate([[0], np.cumsum(gain[np.concatenate(flat)])])
                stops = np.concatenate([[0], np.cumsum(sizes)])
                arrays = [part["key"], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums[stops[1:]] - sums[stops[:-1]])]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "n_words", "n_features", "weight"])

    return run


def noise(key: Column, seed: str = SEED) -> Column:
    """A Gumbel number for each key, in thousandths, from the first 32 bits of a digest of seed and key; a null key is empty text."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0)))).cast("long")


@dataclass(frozen=True)
class Place:
    """A key of the total order: higher scores first, then smaller ids, null ids last, then rows as they come."""

    down: int
    nameless: bool
    key: int
    row: int

    COLUMNS = ("down", "nameless", "key", "row")

    def literal(self) -> Column:
        return F.struct(F.lit(self.down).cast("long"), F.lit(self.nameless), F.lit(self.key).cast("long"), F.lit(self.row).cast("long"))


def _place() -> Column:
    """A scored row's key as a struct; null ids count as 0 behind all others."""
    return F.struct((-F.col("score")).alias("down"), F.col("key").isNull().alias("nameless"), F.coalesce("key", F.lit(0)).alias("key"), F.col("row"))


def _weighted_median(keys: list[np.ndarray], weights: np.ndarray) -> int:
    """The place of the first key, in order, up to which half of the weight lies."""
    order = np.lexsort(keys[::-1])
    return int(order[np.searchsorted(np.cumsum(weights[order]), (weights.sum() + 1) // 2)])


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each task: the median of its chunks' medians, weighted by their sizes, and the number of its keys."""
    held, medians, sizes = [], [], []

    def close() -> None:
        columns = [pa.concat_arrays([b[c] for b in held]).cast(pa.int64()).to_numpy() for c in Place.COLUMNS]
        n = len(columns[0])
        if n:
            middle = _weighted_median(columns, np.ones(n, np.int64))
            medians.append([int(c[middle]) for c in columns])
            sizes.append(n)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            close()
            held = []
    if held:
        close()
    if sizes:
        columns = [np.array(c, np.int64) for c in zip(*medians, strict=True)]
        middle = _weighted_median(columns, np.array(sizes))
        yield pa.RecordBatch.from_arrays([pa.array([int(c[middle])]) for c in columns] + [pa.array([sum(sizes)])], [*Place.COLUMNS, "n"])


def cutoff(keys: DataFrame, k: int) -> Place | None:
    """The k-th smallest of the distinct ``keys`` (down, nameless, key, row), which are staged; None for none.

    Each round takes the median of every task's keys that remain and, of these medians weighted by the
    tasks' remaining sizes, the median: an eighth of the keys at least lies on either side of it. One
    count says on which side the cutoff is, and the other side goes. What remains is written anew when it
    has shrunk to a quarter, so all rounds together read a small multiple of the keys. One row for each
    task goes to the driver, and in the end at most ``FEW`` keys.
    """
    whole = F.struct(*Place.COLUMNS)
    left = written = keys.count()
    if not 0 < k <= left:
        return None
    while left > FEW:
        flat = keys.select("down", F.col("nameless").cast("long").alias("nameless"), "key", "row")
        tasks = flat.mapInArrow(_medians, "down long, nameless long, key long, row long, n long").collect()
        columns = [np.array([t[c] for t in tasks], np.int64) for c in Place.COLUMNS]
        middle = tasks[_weighted_median(columns, np.array([t["n"] for t in tasks]))]
        pivot = Place(middle["down"], bool(middle["nameless"]), middle["key"], middle["row"])
        below = keys.filter(whole < pivot.literal()).count()
        if below == k - 1:
            return pivot
        if below >= k:
            keys, left = keys.filter(whole < pivot.literal()), below
        else:
            keys, left, k = keys.filter(whole > pivot.literal()), left - below - 1, k - below - 1
        if 4 * left <= written:
            keys, written = stage(keys, "keys"), left
    return Place(**keys.orderBy(*Place.COLUMNS).limit(k).collect()[-1].asDict())


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their rank, from 1, by score and key: a range sort, and one count for each of its partitions."""
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("row").asc()]
    n = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = winners.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = stage(placed, "winners")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))  # one row for each sort partition
    rank = F.col("__first") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(starts), "__part").withColumn("rank", rank).drop("__part", "__at", "__first")


def resample(
    df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", ngram: int = NGRAM, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
) -> DataFrame:
    """One row for each document: key, n_features, weight, score, rank (null unless it is drawn).

    Features are all runs of 1 to ``ngram`` words (ASCII letters in lower case, digits and all
    characters beyond ASCII), joined by a space. A feature's bucket is its CRC-32 modulo ``buckets``.
    A document weighs the sum of its buckets' gains: how much likelier the target's texts are to
    show them than the whole table's. Random keys are added to the weights, so that the highest scores
    are a sample without replacement in proportion to the weights' exponentials; of the N documents
    with ``least_words`` words or more the best floor(percent * N / 100) are drawn, ties to the smaller key.

    The table is read twice, to count and to weigh. The driver sees ``buckets`` counts, one number for
    each task and partition, and at most ``FEW`` keys. Null and empty texts have no features and weigh
    0; a null key draws as empty text and comes last among ties. Rows of one key are drawn each by
    itself; if equal in score and key, as many as there is room for. Other columns are not read. An
    empty target leaves all its counts at 0; an empty table gives no rows.
    """
    gain = gains(bucket_counts(df, text, ngram, buckets), bucket_counts(target, target_text, ngram, buckets))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    weighed = rows.mapInArrow(_weighed(ngram, gain), "key long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("key"), seed)).withColumn("row", F.monotonically_increasing_id())
    scored = stage(scored, "scored")
    fits = F.col("n_words") >= least_words
    keys = scored.filter(fits).select(_place().alias("place")).select("place.*")
    last = cutoff(keys, percent * scored.filter(fits).count() // 100)
    out = [F.col("key").alias(key), "n_features", "weight", "score", "rank"]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*out)
    wins = fits & (_place() <= last.literal())
    drawn = ranked(scored.filter(wins).select("key", "n_features", "weight", "score", "row"))
    rest = scored.filter(~wins).withColumn("rank", F.lit(None).cast("long"))
    return rest.select(*out).unionByName(drawn.select(*out))
