"""Repeated passages by sparse suffix arrays: suffixes at minimiser positions are sorted, neighbours compared and extended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sedimart.llm.shingles import long_runs, runs, word_hashes
from sedimart.session import stage

#: Words of a passage at least; words of the minimisers' grams; positions of which the least gram is retained.
PASSAGE, GRAM, STRETCH = 50, 8, 16
TOGETHER = 100


def minimisers(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions whose gram is the least of some stretch of positions within one text, the leftmost of equal ones.

    Which position a stretch retains follows from its words alone, so a passage retains the same
    ones wherever it stands: of each stretch that lies within it, one.
    """
    grams = runs(words, GRAM)
    if len(grams) < STRETCH:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, STRETCH).argmin(1)
    start = np.arange(len(least))
    text = np.searchsorted(first, start, side="right") - 1
    whole = start + STRETCH + GRAM - 1 <= first[1:][text]
    return np.unique((start + least)[whole])


def _suffixes(passage: int):
    """(doc, at, head): retained suffixes with the hash of as many words as they must share with another.

    A passage's first stretch lies within it, so one of its first STRETCH words is retained, with the
    rest of the passage to its right.
    """
    head = passage - STRETCH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                words, first, _, _ = word_hashes([(t or "").encode() for t in part["text"].to_pylist()])
                at = minimisers(words, first)
                text = np.searchsorted(first, at, side="right") - 1
                fits = at + head <= first[1:][text]
                at, text = at[fits], text[fits]
                if len(at):
                    yield pa.RecordBatch.from_pydict({"doc": part["doc"].take(pa.array(text)), "at": (at - first[text]).astype(np.int32), "head": long_runs(words, head)[at].view(np.int64)})

    return run


def _neighbours(by: str, of: str | None = None):
    """Rows, sorted by ``by``, that share it with a neighbour; ``first`` marks the first of equal ones.

    Each row is compared with the one before and the one after it; one row is carried from batch to
    batch. With ``of``, ``copy_of`` is that column of the first of equal rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, again, origin = None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            value = table[by].to_numpy()
            before = np.concatenate([[again], value[1:] == value[:-1]])
            after = np.concatenate([value[1:] == value[:-1], [False]])
            table = table.append_column("first", pa.array(~before))
            if of:
                start = np.maximum.accumulate(np.where(before, 0, np.arange(len(value))))
                copy_of = table[of].take(pa.array(start)).to_pylist()
                if again:  # the equal rows at the top began in an earlier batch
                    top = int(np.argmin(before)) if not before.all() else len(value)
                    copy_of[:top] = [origin] * top
                table = table.append_column("copy_of", pa.array(copy_of, table[of].type))
                origin = copy_of[-1]
            shared = pa.array((before | after)[:-1])
            yield from table.slice(0, len(value) - 1).filter(shared).to_batches()
            held, again = batch.slice(batch.num_rows - 1), bool(before[-1])
        if held is not None and again:
            last = pa.Table.from_batches([held]).append_column("first", pa.array([False]))
            if of:
                last = last.append_column("copy_of", pa.array([origin], last[of].type))
            yield from last.to_batches()

    return run


def _windows(passage: int):
    """(key, doc, start, window): passages of the least length that hold a suffix with a neighbour, extended both ways."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                words, first, _, _ = word_hashes([(t or "").encode() for t in part["text"].to_pylist()])
                window = long_runs(words, passage).view(np.int64)
                text = np.repeat(np.arange(part.num_rows), pc.list_value_length(part["at"]).to_numpy(zero_copy_only=False))
                at = part["at"].flatten().to_numpy() + first[text]
                # the suffix may begin at each of the first words of the passage, to the left, and the rest lies to the right
                start = (at[:, None] - np.arange(STRETCH)).ravel()
                text = np.repeat(text, STRETCH)
                fits = (start >= first[text]) & (start + passage <= first[1:][text])
                start, place = np.unique(start[fits], return_index=True)
                text = text[fits][place]
                if len(start):
                    owner = pa.array(text)
                    yield pa.RecordBatch.from_pydict({"key": part["key"].take(owner), "doc": part["doc"].take(owner), "start": (start - first[text]).astype(np.int32), "window": window[start]})

    return run


def repeated_windows(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """(key, doc, start, first, copy_of): all runs of ``passage`` words that occur twice or more in ``docs`` (key, doc, text)."""
    suffixes = docs.select("doc", "text").mapInArrow(_suffixes(passage), "doc long, at int, head long")
    ordered = suffixes.repartition("head").sortWithinPartitions("head", "doc", "at")
    alike = ordered.mapInArrow(_neighbours("head"), "doc long, at int, head long, first boolean")
    places = alike.groupBy("doc").agg(F.collect_list("at").alias("at"))
    windows = docs.join(places, "doc").select("key", "doc", "text", "at").mapInArrow(_windows(passage), "key long, doc long, start int, window long")
    ordered = windows.repartition("window").sortWithinPartitions("window", F.col("key").asc_nulls_last(), "doc", "start")
    again = ordered.mapInArrow(_neighbours("window", "key"), "key long, doc long, start int, window long, first boolean, copy_of long")
    return again.select("key", "doc", "start", "first", "copy_of")


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """One row for each repeated passage of a document: key, start_word, n_words, first, copy_of.

    A passage is a run of words, of ``passage`` words or more, each of whose windows of that many
    words occurs more than once in the table, in this document or another; words are compared with
    A-Z lower-cased, and by 64-bit hashes. ``first`` is true for windows whose other occurrences all
    come later (by key, null keys last, then by place), which are to stay; passages of both kinds
    are reported apart and may overlap. ``copy_of`` is the smallest key of the first occurrences.

    Only suffixes at positions that the content selects are sorted, about one in eight; neighbours
    that share their first words point to the passages around them. These are extended to the left
    and right, and their windows sorted and compared in turn. A row only ever meets its
    neighbours, so any number of copies costs no more than their length. Null, empty and short texts
    have no passages; rows of one key, equal ones too, are documents of their own, in the order in
    which they are read, and ``doc`` is their number. Row numbers must come out alike when ``df`` is
    read twice, as they do for files. Other columns are not read.
    """
    docs = df.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("doc"), F.col(text).alias("text"))
    found = repeated_windows(docs, passage)
    order = Window.partitionBy("doc", "first").orderBy("start")
    apart = F.coalesce(F.col("start") > F.lag("start").over(order) + passage, F.lit(True)).cast("int")
    spans = found.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order))
    merged = spans.groupBy("doc", "first", "span").agg(F.first("key").alias("key"), F.min("start").alias("start"), F.max("start").alias("end"), F.min("copy_of").alias("copy_of"))
    return merged.select(
        F.col("key").alias(key), F.col("start").cast("long").alias("start_word"), (F.col("end") - F.col("start") + passage).cast("long").alias("n_words"), "first", "copy_of", "doc"
    )


def _without(text: str, spans: str, rest: str, schema: pa.Schema):
    """Rows with ``rest`` in place of the text and the spans that are cut from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, cut in zip(batch[text].to_pylist(), batch[spans].to_pylist(), strict=True):
                if cut:
                    raw = body.encode()
                    _, _, begin, end = word_hashes([raw])
                    keep = np.ones(len(raw), dtype=bool)
                    for span in cut:
                        last = span["start_word"] + span["n_words"]
                        keep[begin[span["start_word"]] : begin[last] if last < len(begin) else end[last - 1]] = False
                    body = np.frombuffer(raw, np.uint8)[keep].tobytes().decode()
                out.append(body)
            made = {rest: pa.array(out, pa.string())}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch[n] for n in schema.names], schema.names)

    return run


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, with a mark more for each column of ``df`` that has them already."""
    out = []
    for name in names:
        while name in df.columns:
            name += "_"
        out.append(name)
    return out


def drop_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """The table with every repeated passage cut from its text, but for the first occurrence of each.

    Documents that are left without a word by the cuts go; all others keep their other columns, and null
    and empty texts stay as they are. Of repeated rows the first keeps its passages. The passages are
    found once and written; then one pass over the table cuts them. Row numbers must come out alike
    when ``df`` is read twice, as they do for files. An empty table stays empty, and helper columns step
    aside for columns of the same name.
    """
    row, spans, rest, of = _free(df, "__row", "__spans", "__rest", "__of")
    cuts = repeated_passages(df, key, text, passage).filter(~F.col("first"))
    cuts = stage(cuts.groupBy(F.col("doc").alias(of)).agg(F.collect_list(F.struct("start_word", "n_words")).alias(spans)), "cuts")
    joined = df.withColumn(row, F.monotonically_increasing_id()).join(cuts, F.col(row) == F.col(of), "left").drop(row, of)
    schema = joined.withColumn(rest, F.lit(None).cast("string")).drop(text).schema
    done = joined.mapInArrow(_without(text, spans, rest, pa.schema([(n, pa.null()) for n in schema.names])), schema)
    kept = done.filter(F.col(spans).isNull() | F.col(rest).rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumnRenamed(rest, text).select(*[f"`{c}`" for c in df.columns])
