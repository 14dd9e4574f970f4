"""N-gram Jaccard join by prefix filters under several global token orders, and the groups that its links make."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.llm.shingles import mix, shingle_sets
from sedimart.session import stage

WORDS, PERCENT = 5, 80
#: The share of all tokens, by their hash, that come before the others in the first order, the seldom ones first.
FRONT = 0.34
#: Rounds in which every token's texts are held against one of them, before all pairs that are left.
PIVOTS = 4
#: Words of 64 bits in a set's signature.
SIGNATURE = 4
SIGNED = [f"sign{i}" for i in range(SIGNATURE)]
#: The orders by hash alone, with their salts.
ORDERS = {"second": 6, "third": 7}
TOGETHER = 100
#: Pairs to verify; ``weight`` is the size of a's set.
SHARING = "a long, b long, weight long"


def _batch(kinds: str, columns: dict) -> pa.RecordBatch:
    """A batch whose columns stand in the order of ``kinds``, as Spark takes them by place."""
    names = [k.split(" ")[0].strip("`") for k in kinds.split(", ")]
    if set(names) != set(columns):
        raise ValueError(f"columns {list(columns)} are not {names}")
    arrays = [c if isinstance(c := columns[n], (pa.Array, pa.ChunkedArray)) else pa.array(c) for n in names]
    return pa.RecordBatch.from_arrays(arrays, names)


def _front(shingles: np.ndarray) -> np.ndarray:
    """Whether each token is one of the share whose sets are counted."""
    return mix(shingles, 9) < np.uint64(int(FRONT * 2.0**64))


def prefix_length(size, percent: int):
    """How many first tokens, under any order, two sets must show to share one, if their similarity reaches percent."""
    least = percent * size + 99
    return size - (F.floor(least / 100) if isinstance(size, Column) else least // 100) + 1


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            yield part, shingle_sets([(t or "").encode() for t in part["text"].to_pylist()], n)


def _digest(shingles: np.ndarray) -> int:
    """A number that tells sets apart, whatever document they come from."""
    return int(mix(mix(shingles, 2).sum(keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def _signature(shingles: np.ndarray) -> np.ndarray:
    """Bits that each token flips one of: sets that differ in d tokens differ in d bits at most."""
    flips = np.bincount((mix(shingles, 8) % np.uint64(64 * SIGNATURE)).astype(np.int64), minlength=64 * SIGNATURE)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


def _firsts(shingles: np.ndarray, percent: int, salt: int) -> np.ndarray:
    """The prefix of a set under the order by hash, its tokens in no order of their own."""
    place, n = mix(shingles, salt), prefix_length(len(shingles), percent)
    first = np.argpartition(place, n - 1)[:n]
    if np.count_nonzero(place == place[first].max()) > 1:  # ties go by the token itself
        first = np.lexsort((shingles, place))[:n]
    return shingles[first]


def _candidates(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The tokens that may be in the set's prefix under the first order: all of the front share, others where these are too few."""
    front, n = _front(shingles), prefix_length(len(shingles), percent)
    if (short := n - np.count_nonzero(front)) <= 0:
        return shingles[front]
    others = shingles[~front]
    return np.concatenate([shingles[front], others[np.lexsort((others, mix(others, 5)))[:short]]])


def _described(n: int, percent: int, kinds: str, carry: Sequence[str] = ()):
    """Each text's set in short.

    ``second`` and ``third`` are the prefixes under the orders by hash, each token as 16 bits;
    ``candidates`` tells how many tokens may be in the prefix under the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, n):
            signs = np.array([_signature(s) for s in sets]).reshape(-1, SIGNATURE)
            nodes = [_digest(s) if len(s) else None for s in sets]
            marks = {c: pa.array([mix(_firsts(s, percent, salt), 3).astype(np.uint16).tobytes() if len(s) else None for s in sets], pa.binary()) for c, salt in ORDERS.items()}
            candidates = [max(np.count_nonzero(_front(s)), prefix_length(len(s), percent)) for s in sets]
            columns = {"key": part["key"], "size": pa.array(map(len, sets), pa.int64()), "node": pa.array(nodes, pa.int64()), "candidates": pa.array(candidates, pa.int64())}
            columns |= {c: signs[:, i] for i, c in enumerate(SIGNED)} | marks | {c: part[c] for c in carry}
            yield _batch(kinds, columns)

    return run


def _shown(n: int, percent: int):
    """The tokens that may be in each text's prefix under the first order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, n):
            firsts = {_digest(s): _candidates(s, percent) for s in sets if len(s)}
            if firsts:
                owner = np.repeat(np.array(list(firsts), np.int64), [len(f) for f in firsts.values()])
                yield _batch("token long, node long", {"token": np.concatenate(list(firsts.values())).view(np.int64), "node": owner})

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the links (a, b): the smallest node that each one reaches.

    Large and small stars in turn: every node hands its larger, then its smaller neighbours to its
    smallest one, until nothing changes. Each round is staged; a round shuffles links and sums, and
    gathers no node's neighbours.
    """
    links = stage(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    known = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        links = stage(small, "links")
        sums = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == known:
            break
        known = sums
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _verified(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                ends = [part[c].to_pylist() for c in ("a", "b")]
                texts: dict[int, str] = {}
                for node, text in ((x, t) for side, c in zip(ends, ("text_a", "text_b"), strict=True) for x, t in zip(side, part[c], strict=True)):
                    if node not in recent and node not in texts:
                        texts[node] = text.as_py()
                if len(recent) > 500:
                    texts |= {x: t.as_py() for side, c in zip(ends, ("text_a", "text_b"), strict=True) for x, t in zip(side, part[c], strict=True)}
                    recent.clear()
                recent |= zip(texts, shingle_sets([t.encode() for t in texts.values()], n), strict=True)
                linked = []
                for a, b in zip(*ends, strict=True):
                    s, t = recent[a], recent[b]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    linked.append(100 * both >= percent * (len(s) + len(t) - both))
                yield _batch("a long, b long", {"a": part["a"], "b": part["b"]}).filter(pa.array(linked))

    return run


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose prefixes share a token under each of the orders by hash."""
    for batch in batches:
        kept = np.ones(batch.num_rows, dtype=bool)
        for c in ORDERS:
            for i, (x, y) in enumerate(zip(batch[f"{c}_a"].to_pylist(), batch[f"{c}_b"].to_pylist(), strict=True)):
                if kept[i]:
                    shown = np.zeros(1 << 16, dtype=bool) if len(x) > 4096 else None
                    one, two = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
                    if shown is None:
                        kept[i] = not set(one.tolist()).isdisjoint(two.tolist())
                    else:
                        shown[one] = True
                        kept[i] = shown[two].any()
        yield _batch(SHARING, {c: batch[c] for c in ("a", "b", "weight")}).filter(pa.array(kept))


class Join:
    """The distinct sets of a table, their prefixes under the orders, and the links found so far."""

    def __init__(self, docs: DataFrame, n: int, percent: int, carry: Sequence[str] = ()):
        """``docs`` has key, text and the columns of ``carry``."""
        self.n, self.percent = n, percent
        kinds = "key long, size long, node long, candidates long, " + ", ".join(f"{c} long" for c in SIGNED) + "".join(f", {c} binary" for c in ORDERS)
        kinds += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
        self.rows = stage(docs.mapInArrow(_described(n, percent, kinds, carry), kinds), "described")
        one = [F.first(c).alias(c) for c in ("size", "candidates", *SIGNED, *ORDERS)]
        nodes = self.rows.filter("node is not null").groupBy("node").agg(F.min("key").alias("key"), *one)
        self.nodes = stage(nodes.withColumn("band", _band("size", percent)), "nodes")
        shown = docs.mapInArrow(_shown(n, percent), "token long, node long")
        # how many sets have each token; the first count, of copies too, only drops the many tokens that nothing shares
        times = F.count("*").over(Window.partitionBy("token"))
        met = shown.withColumn("n_sets", times).filter("n_sets > 1").dropDuplicates(["token", "node"]).withColumn("n_sets", times).filter("n_sets > 1")
        # a node's tokens are no more than its prefix; they stand next to its signature once, not each
        tokens = met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n_sets", "token")))["token"].alias("tokens"))
        near = tokens.join(self.nodes.select("node", "size", "band", "candidates", *SIGNED), "node")
        # tokens of its own come first in the prefix, as many as candidates are in no other set
        left = prefix_length(F.col("size"), percent) - F.col("candidates") + F.size("tokens")
        near = near.withColumn("tokens", F.slice("tokens", 1, F.greatest(left, F.lit(0)).cast("int"))).filter("size(tokens) > 0")
        self.shown = stage(near.drop("candidates"), "prefixes")
        wanted = self.shown.select("node")
        keys = self.nodes.join(wanted, "node", "left_semi").select("key").distinct()
        # a key may stand for several texts: the digest of each says whose it is
        found = docs.join(keys, docs["key"].eqNullSafe(keys["key"]), "left_semi").mapInArrow(_noded(n), "node long, text string")
        self.texts = stage(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "texts")
        self.weight = self.nodes.agg(F.sum("size")).first()[0] or 0
        self.links: DataFrame | None = None

    def _labelled(self) -> DataFrame:
        """(token, node, size, band, signature, label): each shown token, with the group that its set is in by now."""
        if self.links is None:
            shown = self.shown.withColumn("label", F.col("node"))
        else:
            labels = components(self.links)
            shown = stage(self.shown.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
        return shown.withColumn("token", F.explode("tokens")).drop("tokens")

    def _fit(self, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        """Whether sizes and signatures allow the two sets to link.

        Neither size may be too small beside the other. Sets that link differ in at most
        (100 - percent) / (100 + percent) of the sum of their sizes, and in no fewer tokens than
        their signatures in bits.
        """
        x, y = a("size"), b("size")
        bits = [F.bit_count(a(c).bitwiseXOR(b(c))) for c in SIGNED]
        near = (100 + self.percent) * functools.reduce(operator.add, bits) <= (100 - self.percent) * (x + y)
        return (100 * x >= self.percent * y) & (100 * y >= self.percent * x) & near

    def _add(self, pairs: DataFrame) -> None:
        """Verify the pairs (a, b) on their whole sets and keep those that link."""
        # each step is staged, so that the shuffles of the one before, wider than its result, are gone from disk
        pairs = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        # the other orders: both must share a token of the prefix under each of them
        for side in "ab":
            weight = [F.col("size").alias("weight")] if side == "a" else []
            pairs = pairs.join(self.nodes.select(F.col("node").alias(side), *weight, *[F.col(c).alias(f"{c}_{side}") for c in ORDERS]), side)
        marks = [f"{c}_{side}" for c in ORDERS for side in "ab"]
        pairs = stage(pairs.select("a", "b", "weight", *marks).mapInArrow(_sharing, SHARING), "sharing")
        # each pair carries the text of a to that of b: all pairs in turn, about as much text at a time as the sets have
        parts = max(1, -(-(pairs.agg(F.sum("weight")).first()[0] or 0) // max(1, self.weight)))
        for part in range(parts):
            within = lambda c, part=part: F.pmod(F.xxhash64(c), F.lit(parts)) == part
            text = lambda side: self.texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
            both = pairs.filter(within("a")).select("a", "b").join(text("a").filter(within("a")), "a").join(text("b"), "b")
            found = stage(both.select("a", "b", "text_a", "text_b").mapInArrow(_verified(self.n, self.percent), "a long, b long"), "found")
            self.links = found if self.links is None else self.links.unionByName(found)

    def against_pivots(self, rounds: range) -> None:
        """Hold each token's sets against one of them that a hash picks, other than those in its group already."""
        labelled = self._labelled()
        wanted = []
        for i in rounds:
            picked = F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node", "size", "label", *SIGNED)).alias("p")
            pivots = labelled.groupBy("token").agg(picked, F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("token", "p")
            met = labelled.join(pivots, "token").filter((F.col("label") != F.col("p.label")) & self._fit(F.col, lambda c: F.col(f"p.{c}")))
            wanted.append(met.select(F.col("node").alias("a"), F.col("p.node").alias("b")))
        pairs = wanted[0]
        for more in wanted[1:]:
            pairs = pairs.unionByName(more)
        self._add(pairs)

    def against_all(self) -> None:
        """All pairs of a token's sets that are not in one group by now, and of sizes that may link.

        Sets that link lie in one band of sizes or in two that touch, so a set meets those of its own
        band and of the next.
        """
        labelled = self._labelled()
        split = labelled.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("token")
        left = labelled.join(split, "token")
        names = ("node", "size", "label", *SIGNED)
        right = left.select("token", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"), F.col("band").alias("band_b"), *[F.col(c).alias(f"{c}_b") for c in names])
        apart = ((F.col("band") != F.col("band_b")) | (F.col("node") < F.col("node_b"))) & (F.col("label") != F.col("label_b"))
        met = left.join(right, ["token", "band"]).filter(apart & self._fit(F.col, lambda c: F.col(f"{c}_b")))
        self._add(met.select(F.col("node").alias("a"), F.col("node_b").alias("b")))


def _band(size: str, percent: int) -> Column:
    """Sizes of one band, or of two that touch, are all that may link: a band ends where the sizes have grown by 100 / percent."""
    if percent >= 100:
        return F.col(size).cast("int")
    return F.floor(F.log(F.col(size).cast("double")) / float(np.log(100 / percent)) * (1 - 1e-9)).cast("int")


def _noded(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, n):
            yield _batch("node long, text string", {"node": pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()), "text": part["text"]})

    return run


def link_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT, carry: Sequence[str] = (), group: bool = False) -> DataFrame:
    """One row for each document: key, n_shingles, component_id (the smallest key that links reach), ``carry``.

    With ``group``, a last column of that name tells groups apart, whatever their keys: it is null for
    documents without words.

    A document's set has its runs of ``n`` words, lower-cased A-Z; fewer words are one run; without
    words it is empty and linked with nothing. Two sets link if 100 * common >= percent * union.

    Documents of equal sets become one node. Under any one order of all tokens, two sets that link
    share a token among the first of each. The first order has a share of the tokens, by their hash,
    before the others, and of these the ones that fewer sets have before those that more have, by exact
    counts; tokens of one set alone never meet another. Candidates share a prefix token under it, and under two more orders by hash, whose prefixes each set carries in short.
    A token that many sets show would make all pairs of them, so they are first held against pivots;
    sets that links have joined by then are not paired again, and the last pass pairs whatever still
    lies in different groups, by bands of size, so no link between groups is lost. Before a pair is made,
    sizes and signatures of 256 bits must allow a link; this loses none. Every candidate is verified
    on the whole sets. Tokens are 64-bit hashes, as are nodes.

    Null and empty texts have no words. Rows of one key are rows of their own; null keys do not
    count as smallest, unless a group has no other. Other columns are not read. An empty table gives
    no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *carry)
    join = Join(rows, n, percent, carry)
    join.against_pivots(range(1))
    join.against_pivots(range(1, PIVOTS))
    join.against_all()
    labels = components(join.links)
    labelled = join.nodes.select("node", "key").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("key").alias("component_id"))
    of = labelled.join(least, "label").select("node", "component_id", F.col("label").alias("group"))
    alone = join.rows.filter("node is null").select("key", "size", F.col("key").alias("component_id"), *carry, F.lit(None).cast("long").alias("group"))
    grouped = join.rows.filter("node is not null").join(of, "node").select("key", "size", "component_id", *carry, "group")
    return grouped.unionByName(alone).select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id", *carry, *(["group"] if group else []))
