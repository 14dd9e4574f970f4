"""Best-two-fit packing of token sequences, on counts of lengths: bins filled alike are planned once."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from sedimart.llm.bytebpe import TOGETHER, Remembering
from sedimart.session import stage

CAPACITY = 2048
#: Pieces of one length are spread over so many groups, and numbered within each.
SALTS = 64
#: Fixed value: pre-tokens of the byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Words:
    """Ids of texts by a byte-level tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        encoding = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.remembering = Remembering(encoding.encode_ordinary, lengths)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, as the tokenizers library gives them.

        The file's ids are the ranks of its merges, so a rank encoder over its vocabulary gives the
        same ids in a quarter of the time; tests hold them against the library. A text that holds
        the string of a special token goes to the library itself.
        """
        plain = [not any(s in t for s in self.special) for t in texts]
        found = iter(self.remembering.ids([t for t, p in zip(texts, plain, strict=True) if p]))
        whole = lambda t: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return [next(found) if p else whole(t) for t, p in zip(texts, plain, strict=True)]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def _pieces_of(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _words(path), 0
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                rows, number, start, length, crc = [], [], [], [], []
                for row, ids in enumerate(words.ids(part["text"].to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    for i, stop in enumerate(range(first, n + 1, capacity)):
                        begin = max(0, stop - capacity) if i else 0
                        rows.append(row)
                        number.append(i)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(ids[4 * begin : 4 * stop]))
                salt = (seen + np.arange(len(rows))) % SALTS
                seen += len(rows)
                yield pa.RecordBatch.from_pydict({
                    "key": part["key"].take(pa.array(rows, pa.int32())), "piece": pa.array(number, pa.int32()), "start": start, "length": length, "ids_crc32": crc, "salt": pa.array(salt, pa.int32()),
                })

    return run


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many bins, how many pieces of each length in each of them), by best-two-fit.

    A bin is filled greedily: the largest length that fits and is left, again and again. While a gap
    is left, the bin's smallest piece may give way to two unpacked ones that fit into the gap that
    grows by it, if they fill it better; of all pairs the one that fills it most, of these the one
    with the larger first piece. Bins that come out alike are planned once and made as often as the
    lengths last, so the work grows with the capacity, not with the number of pieces: each plan
    uses up some length.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    sizes, plans = np.arange(capacity + 1), []
    while left.any():
        use: dict[int, int] = {}
        gap = capacity
        free = left.copy()

        def put(length: int, times: int, use=use, free=free) -> int:
            free[length] -= times
            use[length] = use.get(length, 0) + times
            return length * times

        while gap and (fits := np.flatnonzero(free[1 : gap + 1])).size:
            length = int(fits[-1]) + 1
            gap -= put(length, min(gap // length, int(free[length])))
        while gap:
            smallest = min(use)
            room = gap + smallest
            # for each first piece the largest second one that is left beside it
            largest = np.maximum.accumulate(np.where(free > 0, sizes, 0))[: room + 1]
            second = largest[::-1].copy()  # at a: the largest of at most room - a
            twice = (second == sizes[: room + 1]) & (free[: room + 1] < 2)
            below = np.concatenate([[0], largest[:-1]])
            second[twice] = below[: room + 1][twice]
            both = np.where((free[: room + 1] > 0) & (second > 0), sizes[: room + 1] + second, 0)
            best = int(both.max(initial=0))
            if best <= smallest:
                break
            first = int(np.flatnonzero(both == best)[-1])
            put(smallest, -1)
            if not use[smallest]:
                del use[smallest]
            gap = room - put(first, 1) - put(best - first, 1)
        times = min(int(left[length]) // n for length, n in use.items())
        for length, n in use.items():
            left[length] -= times * n
        plans.append((times, use))
    return plans


def _places(plans: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces of it in a bin, first bin, offset) in order of ranks."""
    places: dict[int, list] = {}
    ranks: dict[int, int] = {}
    bins = 0
    for times, use in plans:
        offset = 0
        for length in sorted(use, reverse=True):
            places.setdefault(length, []).append((ranks.get(length, 0), use[length], bins, offset))
            ranks[length] = ranks.get(length, 0) + times * use[length]
            offset += use[length] * length
        bins += times
    return {length: np.array(rows, dtype=np.int64) for length, rows in places.items()}


def _placed(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            bins, offsets = np.empty_like(rank), np.empty_like(rank)
            for size in np.unique(length):
                own, table = length == size, places[int(size)]
                row = table[np.searchsorted(table[:, 0], rank[own], side="right") - 1]
                since = rank[own] - row[:, 0]
                bins[own] = row[:, 2] + since // row[:, 1]
                offsets[own] = row[:, 3] + since % row[:, 1] * size
            kept = {c: batch[c] for c in ("key", "piece", "start", "length", "ids_crc32")}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": bins, "offset": offsets})

    return run


def pack_documents(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; one of more than ``capacity`` ids is cut into pieces of
    that many, the first of which may be shorter. Null and empty texts are the end alone. Documents
    with equal or null keys are packed each by itself; an empty table gives no rows. Other columns
    are not read. ``key`` is an integer.

    The pieces are staged once. Only their counts by length, as many rows as the capacity at most,
    go to the driver, which plans the bins; a plan says which ranks among the pieces of a length go
    to which bins, so each piece finds its place alone. Ranks come from a numbering within (length,
    salt), shifted by the salts before, so a length that a third of all pieces have is spread too.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = rows.mapInArrow(_pieces_of(tokenizer_path, capacity, end_id), "key long, piece int, start long, length long, ids_crc32 long, salt int")
    cut = stage(cut, "pieces")
    sizes = cut.groupBy("length", "salt").agg(F.count("*").alias("n"))
    plans = plan_bins({r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("key", "piece", "ids_crc32")
    ranked = cut.join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.row_number().over(within) - 1)
    narrow = ranked.select("key", "piece", "start", "length", "ids_crc32", "rank")
    out = narrow.mapInArrow(_placed(_places(plans)), "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("key", key)
