"""Byte-level BPE: overlapping chunks are pre-tokenised alone and stitched where their boundaries agree again."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

#: Texts of more characters than this are cut into chunks that go to different tasks.
CHUNK = 50_000
#: Characters that a chunk reads beyond each of its ends.
OVERLAP = 500
#: Pieces whose ids a worker remembers, some 200 MB of them; others are encoded each time.
REMEMBERED = 1_000_000
#: Texts that are encoded together.
TOGETHER = 500
#: Unicode's white space, as the pattern's \\s has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT, BLANK = re.compile(f"(?<=[^{WHITE}])[{WHITE}]"), re.compile(f"(?<=[^{WHITE}]) ")


def pieces(text: str) -> list[str]:
    """The text cut at blanks that follow a visible character; these blanks are left out.

    No pre-token goes on from a visible character to white space, so each cut is a boundary of
    pre-tokens, wherever pre-tokenising began.
    """
    words = text.split(" ")
    # single blanks between words: a plain split has such places only
    if "" not in words and not any(map(str.isspace, set(map(itemgetter(-1), words)))):
        return words
    return BLANK.split(text)


class Remembering:
    """Encodes texts piece by piece and remembers the ids of pieces, as words come again and again."""

    def __init__(self, encode: Callable[[str], list[int]], token_lengths: np.ndarray):
        """``encode`` gives ids of a text, ``token_lengths`` the bytes of each id."""
        self.encode, self.token_lengths = encode, token_lengths
        self.known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Ids of pieces with their blank; regular ones are encoded as one text and told apart by their bytes."""
        regular = [w for w in new if w and not w[-1].isspace()]
        if regular:
            ids = np.array(self.encode(" " + " ".join(regular)), dtype="<u4")
            ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in regular), dtype=np.int64, count=len(regular)))
            stops = 4 * (np.searchsorted(np.cumsum(self.token_lengths[ids]), ends) + 1)
            flat, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
            self.known.update((w, flat[a:b]) for w, a, b in zip(regular, starts, stops.tolist(), strict=True))
        self.known.update((w, self._bytes(f" {w}")) for w in new if not w or w[-1].isspace())

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [pieces(t) for t in texts]
        first = [words.pop(0) for words in cut]
        new = set().union(*cut).difference(self.known)
        if len(self.known) >= REMEMBERED and 2 * len(new) > len(set().union(*cut)):
            self.known.clear()  # the words have changed
            new = set().union(*cut)
        self._learn(list(new))
        out = [self._bytes(head) + b"".join(map(self.known.__getitem__, words)) for head, words in zip(first, cut, strict=True)]
        full = len(self.known) - len(new) >= REMEMBERED
        for word in new:
            if full or len(word) > 64:
                del self.known[word]
        return out


class Codec:
    """Ids of texts and bytes of ids, by a file of ranks and the pattern of pre-tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.remembering = Remembering(encoding.encode_ordinary, np.array(list(map(len, self.bytes_of))))

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.remembering.ids(texts)

    def decode(self, ids: bytes) -> bytes:
        """The raw bytes of the ids, one after the other."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=4)
def _codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _cuts(text: str) -> list[int]:
    """Places between a visible character and white space after it, boundaries of pre-tokens wherever one starts."""
    return [found.start() for found in CUT.finditer(text)]


def chunks(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """(start of the chunk's own part in the slice, length of its own part, slice with the overlaps)."""
    out = []
    for at in range(0, max(len(text), 1), size):
        first = max(0, at - overlap)
        out.append((at - first, min(size, len(text) - at), text[first : at + size + overlap]))
    return out


def boundaries(text: str, own: int, length: int, last: bool) -> tuple[int, int]:
    """Where a chunk's pieces begin and end in its slice, -1 where its overlap has no place to stitch.

    Both neighbours look for the first certain boundary from the same place on, over the same
    overlap, so they agree if there is one; a place to stitch lies past the overlap's first
    character, as a chunk cannot see what stands before that.
    """
    begin, end = (0 if own == 0 else -1), (len(text) if last else -1)
    for at in _cuts(text):
        if begin < 0 and at >= own:
            begin = at
        if end < 0 and at >= own + length:
            end = at
    return begin, end


def _digests(codec: Codec, ids: list[bytes]) -> dict[str, list]:
    return {
        "n_tokens": [len(x) // 4 for x in ids],
        "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
        "decoded_sha256": [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids],
    }


def _encoded_whole(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                yield pa.RecordBatch.from_pydict({"key": part["key"]} | _digests(codec, codec.encode(part["text"].to_pylist())))

    return run


def _cut(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, key, text in zip(batch["row"].to_pylist(), batch["key"].to_pylist(), batch["text"], strict=True):
                parts = chunks(text.as_py(), size, overlap)
                for i in range(0, len(parts), 16):
                    own, length, body = zip(*parts[i : i + 16], strict=True)
                    n = len(own)
                    yield pa.RecordBatch.from_pydict({
                        "row": [row] * n, "key": pa.array([key] * n, pa.int64()), "chunk": pa.array(range(i, i + n), pa.int32()), "n_chunks": pa.array([len(parts)] * n, pa.int32()), "own": pa.array(own, pa.int32()), "length": pa.array(length, pa.int32()), "text": body,
                    })

    return run


def _encoded_chunks(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            begins, ends, ids, bodies = [], [], [], []
            for chunk, n, own, length, text in zip(*(batch[c].to_pylist() for c in ("chunk", "n_chunks", "own", "length", "text")), strict=True):
                begin, end = boundaries(text, own, length, chunk == n - 1)
                whole = 0 <= begin <= end
                # both are kept as distances from the start of an own part: this chunk's and the next one's
                begins.append(begin - own if whole else None)
                ends.append(end - own - length if whole else None)
                ids.append(codec.encode([text[begin:end]])[0] if whole else None)
                bodies.append(text[own : own + length])
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in ("row", "key", "chunk")} | {
                "begin": pa.array(begins, pa.int64()), "end": pa.array(ends, pa.int64()), "ids": pa.array(ids, pa.binary()), "text": bodies,
            })

    return run


def _stitched(ranks_path: str, pattern: str):
    def run(table: pa.Table) -> pa.Table:
        """All chunks of one text: its ids if every two neighbours met, else those of the text as a whole."""
        codec = _codec(ranks_path, pattern)
        table = table.sort_by("chunk")
        begin, end, ids = (table[c].to_pylist() for c in ("begin", "end", "ids"))
        if None not in begin and None not in end and begin[0] == 0 and end[:-1] == begin[1:]:
            all_ids = b"".join(ids)
        else:
            all_ids = codec.encode(["".join(table["text"].to_pylist())])[0]
        return pa.Table.from_pydict({"key": table["key"].slice(0, 1)} | _digests(codec, [all_ids]))

    return run


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row for each document: key, n_tokens, ids_sha256, decoded_sha256.

    Texts of up to ``chunk`` characters are one chunk. Longer ones are cut into chunks that overlap,
    and these are spread over tasks: each is pre-tokenised and encoded alone, between the first
    certain boundaries past its ends. A text's chunks are put together in order where each ends at
    the boundary at which the next begins; where an overlap holds no such place (a huge word, say),
    the text is encoded as a whole, with the same ids.

    Null and empty texts have no ids, and the digests of none. Rows with equal or null keys give a
    row each; other columns are not read. ``key`` is an integer.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    short = rows.filter(F.length("text") <= chunk).mapInArrow(_encoded_whole(ranks_path, pattern), out)
    large = rows.filter(F.length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "key", "text")
    cut = large.mapInArrow(_cut(chunk, overlap), "row long, key long, chunk int, n_chunks int, own int, length int, text string")
    alone = cut.repartition("row", "chunk").mapInArrow(_encoded_chunks(ranks_path, pattern), "row long, key long, chunk int, begin long, end long, ids binary, text string")
    both = short.unionByName(alone.groupBy("row").applyInArrow(_stitched(ranks_path, pattern), out))
    return both.select(F.col("key").alias(key), "n_tokens", "ids_sha256", "decoded_sha256")
