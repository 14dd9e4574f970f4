"""LM scoring: a log-bilinear neural model, trained in numpy by noise-contrastive estimation, normalised over its classes."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sedimart.session import stage

#: Classes of tokens: the end, so many most frequent words, and the other words by a hash of their last bytes.
HEADS, TAILS, SUFFIX = 255, 64, 3
#: Words whose counts go to every task, at most; those beyond meet their counts in a join.
KNOWN_WORDS = 150_000
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000
#: The network: classes before a token that it sees, size of the vectors, and noise tokens.
CONTEXT, WIDTH, NOISE, EPOCHS, BATCH, SEED = 3, 16, 64, 2, 1024, 11
#: Tokens that a task trains on, about; and after so many a block of whole texts ends.
TASK_TOKENS, BLOCK = 1_000_000, 50_000
#: Texts whose words are looked up together.
TEXTS = 1000
#: Tokens whose classes are normalised together.
TOGETHER = 1024
#: Logits up to this size, either way, have exponentials that add up as they are.
FLAT = 60
END = b""


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as bytes: what stands between blanks and tabs to carriage returns."""
    return text.encode().lower().split() if text else []


class LogBilinear:
    """Chances of a token's class from the classes before it.

    The vectors of the classes before, each turned by the matrix of its distance, add up to a
    prediction; its product with a class's vector, and the class's bias, is the class's logit.
    """

    def __init__(self, classes: int, shares: np.ndarray, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.classes, self.shares = classes, shares
        self.prior = np.log(NOISE * shares).astype(np.float32)
        # the last row of each of the first stands for the start of a text
        sizes = [CONTEXT * (classes + 1) * WIDTH, classes * WIDTH, classes]
        self._splits, total = np.cumsum(sizes)[:-1], sum(sizes)
        first = [draw.standard_normal(n) * 0.1 for n in sizes[:2]]
        self.load(np.concatenate([*first, np.log(shares), np.full(total, 1e-2)]))

    def load(self, state: np.ndarray) -> None:
        """Take over weights and sums of squared slopes, in one row as in ``state``."""
        self.state = state.astype(np.float32)
        self.weights, self.squares = np.split(self.state, 2)
        into, out, self.bias = np.split(self.weights, self._splits)
        self.into, self.out = into.reshape(CONTEXT, self.classes + 1, WIDTH), out.reshape(self.classes, WIDTH)

    def contexts(self, ids: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
        """[CONTEXT, tokens]: the classes before each token of its text, nearest first; ``starts`` are the texts' first tokens."""
        starts = np.zeros(1, np.int64) if starts is None else starts
        place = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
        out = np.full((CONTEXT, len(ids)), self.classes, np.int64)
        for i in range(CONTEXT):
            out[i, i + 1 :] = ids[: max(0, len(ids) - i - 1)]
            out[i, place <= i] = self.classes
        return out

    def predict(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.into[i][contexts[i]] for i in range(CONTEXT))

    def learn_once(self, contexts: np.ndarray, targets: np.ndarray, draw: np.random.Generator) -> None:
        """Noise-contrastive estimation: tell each token from NOISE ones drawn by the classes' shares; Adagrad.

        Slopes are summed by class before they are added, so a batch costs its products and one row for
        each class.
        """
        order, prior = draw.permutation(len(targets)), self.prior
        drawn = draw.choice(self.classes, (-(-len(order) // BATCH), NOISE), p=self.shares)
        slope = np.empty_like(self.weights)
        into, out, bias = np.split(slope, self._splits)
        into, out = into.reshape(self.into.shape), out.reshape(self.out.shape)
        for at, noise in zip(range(0, len(order), BATCH), drawn, strict=True):
            rows = order[at : at + BATCH]
            right, before = targets[rows], contexts[:, rows]
            vector, false = self.predict(before), self.out[noise]
            true = self.out[right]
            d_right = 1 / (1 + np.exp(prior[right] - self.bias[right] - (vector * true).sum(1))) - 1
            d_noise = vector @ false.T
            np.exp(np.subtract(prior[noise] - self.bias[noise], d_noise, out=d_noise), out=d_noise)
            d_noise += 1
            np.reciprocal(d_noise, out=d_noise)
            d_vector = d_right[:, None] * true + d_noise @ false
            slope[:] = 0
            wide = d_vector.astype(np.float64)
            for i in range(CONTEXT):
                _add_by_class(into[i], before[i], wide)
            _add_by_class(out, right, d_right[:, None] * vector)
            np.add.at(out, noise, d_noise.T @ vector)
            bias += np.bincount(right, d_right, self.classes) + np.bincount(noise, d_noise.sum(0), self.classes)
            slope /= np.float32(len(rows))
            self.squares += slope**2
            self.weights -= np.float32(0.1) * slope / np.sqrt(self.squares)

    def fit(self, contexts: np.ndarray, targets: np.ndarray, shares: np.ndarray) -> LogBilinear:
        """Train on tokens that are all at hand, in EPOCHS rounds; ``shares`` are those of the noise."""
        draw = np.random.default_rng(SEED)
        self.shares, self.prior = shares, np.log(NOISE * shares).astype(np.float32)
        for _ in range(EPOCHS):
            self.learn_once(contexts, targets, draw)
        return self

    def log_chances(self, ids: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Natural logarithms of the chances of ``ids``, normalised over all classes."""
        found = np.empty(len(ids))
        # the bias is one more component, so that the product adds it
        out, ones = np.vstack([self.out.T, self.bias]), np.ones(self.classes, np.float32)
        longest, highest = np.linalg.norm(self.out, axis=1).max(), np.abs(self.bias).max()
        for at in range(0, len(ids), TOGETHER):
            rows = slice(at, at + TOGETHER)
            vector = self.predict(contexts[:, rows])
            logits = np.hstack([vector, np.ones((len(vector), 1), np.float32)]) @ out
            right = logits[np.arange(len(logits)), ids[rows]]
            if np.sqrt((vector * vector).sum(1).max()) * longest + highest > FLAT:
                top = logits.max(1, keepdims=True)
                right, logits = right - top[:, 0], logits - top
            np.exp(logits, out=logits)
            found[rows] = right - np.log(logits @ ones)
        return found


def _add_by_class(sums: np.ndarray, classes: np.ndarray, values: np.ndarray) -> None:
    """Add each row of ``values`` to the row of its class."""
    place = classes[:, None] * sums.shape[1] + np.arange(sums.shape[1])
    sums += np.bincount(place.ravel(), values.ravel(), sums.size).reshape(sums.shape)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and ends of all texts with their counts, added up as far as they fit."""
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(words(text.as_py()))
            counts[END] += 1
            if len(counts) >= COUNTED:
                yield pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())})
                counts.clear()
    if counts:
        yield pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())})


def _tail(word: bytes) -> int:
    return 1 + HEADS + zlib.crc32(word[-SUFFIX:]) % TAILS


class Vocabulary:
    """What every task knows of the training tokens: counts of the frequent words, sums over the others."""

    def __init__(self, known: dict[bytes, int], tokens: int, distinct: int, tails: dict[int, tuple[int, int]]):
        """``tails``: by class, the tokens and the distinct words of those that are no heads."""
        self.known, self.tokens, self.distinct = known, tokens, distinct
        heads = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:HEADS]
        self.heads = {END: 0} | {w: 1 + i for i, w in enumerate(heads)}
        # a word that training lacks counts as one more word in each class
        self.tail_sums = np.array([tails.get(1 + HEADS + i, (0, 0))[0] + 0.1 * (tails.get(1 + HEADS + i, (0, 0))[1] + 1) for i in range(TAILS)])
        counts = np.array([known.get(END, 0), *[known[w] for w in heads], *[0] * (HEADS - len(heads)), *self.tail_sums])
        self.shares = (counts + 1) / (counts + 1).sum()

        self._words: pa.Array | None = None

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """The tokens of all texts, one text after the other, each with its end.

        (place of each token among the known words, their number for others; class of each token; first
        token of each text and the end; which tokens are not known, and what they are).
        """
        if self._words is None:
            self._words = pa.array(self.known, pa.binary())
            self._classes = np.array([*(self.heads[w] if w in self.heads else _tail(w) for w in self.known), 0])
            self._end = next((i for i, w in enumerate(self.known) if w == END), len(self.known))
        other = len(self._words)
        # these are the blanks that ``words`` splits at; it leaves empty words out
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        found, edges = split.flatten(), split.offsets.to_numpy()
        real = pc.binary_length(found).to_numpy() > 0
        starts = np.concatenate([[0], np.cumsum(real)])[edges - edges[0]] + np.arange(len(edges))
        found = found.filter(pa.array(real)).cast(pa.binary())
        place = np.full(starts[-1], self._end)
        word = np.ones(len(place), dtype=bool)
        word[starts[1:] - 1] = False
        place[word] = pc.index_in(found, value_set=self._words).fill_null(other).to_numpy()
        classes = self._classes[place]
        rare = np.flatnonzero(place == other)
        unknown = [END] * len(rare)
        if is_word := np.flatnonzero(word[rare]).tolist():
            at = rare[is_word]
            for i, w in zip(is_word, found.take(pa.array(at - np.searchsorted(starts[1:], at, side="right"))).to_pylist(), strict=True):
                unknown[i] = w
        classes[rare] = [_tail(w) if w else 0 for w in unknown]
        return place, classes, starts, rare, unknown


def count_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all documents, with the ends under the empty word; null texts have an end only."""
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_counted, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """Collects the most frequent words, at most ``known_words`` of them, and one row for each class of the others.

    Words are taken down to a count that a histogram of counts by eighths of powers of two gives, so
    the driver sorts nothing and ties are taken or left together.
    """
    octave = F.floor(8 * F.log2("n"))
    sizes = sorted(((r["o"], r["c"]) for r in counts.groupBy(octave.alias("o")).agg(F.count("*").alias("c")).collect()), reverse=True)
    total = itertools.accumulate(c for _, c in sizes)
    least = min((o for (o, _), t in zip(sizes, total, strict=True) if t <= known_words), default=math.inf)
    known = {bytes(r["word"]): r["n"] for r in counts.filter((octave >= least) | (F.col("word") == END)).collect()} if sizes else {}
    draft = Vocabulary(known, 0, 0, {})
    other = counts.filter(~F.col("word").isin(*draft.heads))
    tail = 1 + HEADS + F.crc32(F.expr(f"substring(word, greatest(length(word) - {SUFFIX - 1}, 1), {SUFFIX})")) % TAILS
    tails = {r["tail"]: (r["n"], r["c"]) for r in other.groupBy(tail.alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect()}
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("c")).first()
    return Vocabulary(known, sums["n"], sums["c"], tails)


def _blocks(vocab: Vocabulary):
    """Blocks of whole texts as classes of two bytes each, every text followed by its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                _, classes, starts, _, _ = vocab.places(batch["text"].slice(at, TEXTS))
                ids = classes.astype(np.uint16)
                for first, end in itertools.pairwise(starts.tolist()):
                    texts.append(ids[first:end])
                    n += end - first
                    if n >= BLOCK:
                        yield pa.RecordBatch.from_pydict({"ids": pa.array([np.concatenate(texts).tobytes()], pa.binary())})
                        texts, n = [], 0
        if n:
            yield pa.RecordBatch.from_pydict({"ids": pa.array([np.concatenate(texts).tobytes()], pa.binary())})

    return run


def _trained(shares: np.ndarray, state: np.ndarray, epoch: int):
    """The model's state after a task's tokens, times their number, and the number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, draw, n = LogBilinear(len(shares), shares), np.random.default_rng([SEED, epoch]), 0
        model.load(state)
        for batch in batches:
            for block in batch["ids"]:
                ids = np.frombuffer(block.as_py(), np.uint16).astype(np.int64)
                ends = np.flatnonzero(ids == 0) + 1
                contexts = model.contexts(ids, np.concatenate([[0], ends[:-1]]))
                # a text beyond a block's length is gone through in parts that keep their contexts
                for at in range(0, len(ids), 2 * BLOCK):
                    model.learn_once(contexts[:, at : at + 2 * BLOCK], ids[at : at + 2 * BLOCK], draw)
                n += len(ids)
        if n:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "state": pa.array([(model.state.astype(np.float64) * n).tobytes()], pa.binary())})

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, state = 0, 0.0
    for batch in batches:
        for count, part in zip(batch["n"].to_pylist(), batch["state"], strict=True):
            n, state = n + count, state + np.frombuffer(part.as_py())
    if n:
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "state": pa.array([state.tobytes()], pa.binary())})


def learn(docs: DataFrame, vocab: Vocabulary, text: str = "text") -> LogBilinear:
    """The network, from every token of all documents, whatever their length.

    In each epoch every task goes on from the same state over its texts; then the states are
    averaged by numbers of tokens, first in about as many tasks as the root of their number, then on
    the driver. So the weights depend on how the table is split, and in their last digits on the order in
    which states arrive.
    """
    model = LogBilinear(1 + HEADS + TAILS, vocab.shares)
    if not vocab.tokens:
        return model
    blocks = stage(docs.select(F.col(text).alias("text")).mapInArrow(_blocks(vocab), "ids binary"), "classes")
    tasks = max(1, vocab.tokens // TASK_TOKENS)
    blocks = blocks.repartition(tasks)
    between = math.isqrt(tasks - 1) + 1
    for epoch in range(EPOCHS):
        trained = blocks.mapInArrow(_trained(vocab.shares, model.state, epoch), "n long, state binary")
        sums = trained.repartition(between).mapInArrow(_summed, "n long, state binary").collect()
        model.load(sum(np.frombuffer(r["state"]) for r in sums) / sum(r["n"] for r in sums))
    return model


def _scored(model: LogBilinear, known: dict[bytes, float], vocab: Vocabulary):
    """One row (no word) for each text, and one for each of its words whose count isn't known here."""
    log_sums = np.log10(vocab.tail_sums)
    logs = np.array([*(known[w] for w in vocab.known), 0.0])
    other = len(logs) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                place, classes, starts, rare, words_of = vocab.places(part["text"])
                log = logs[place]
                score = model.log_chances(classes, model.contexts(classes, starts[:-1])) / math.log(10)
                # a word of a tail class has its share of the class: its count over the class's sum
                tails = classes > HEADS
                score[tails] += log[tails] - log_sums[classes[tails] - HEADS - 1]
                sums = lambda values: np.add.reduceat(values, starts[:-1]).tolist()  # noqa: E731, B023
                scores, bases, knowns = sums(score), sums(log), sums((place != other).astype(np.int64))
                others = [Counter(words_of[a:b]) for a, b in itertools.pairwise(np.searchsorted(rare, starts).tolist())]
                out: dict[str, list] = {c: [] for c in ("of", "doc", "word", "times", "tokens", "known", "score", "base")}
                for i in range(part.num_rows):
                    own = others[i]
                    nothing = [None] * len(own)
                    out["of"] += [row] * (1 + len(own))
                    out["doc"] += [i, *nothing]
                    out["word"] += [None, *own]
                    out["times"] += [0, *own.values()]
                    out["tokens"] += [int(starts[i + 1] - starts[i]), *nothing]
                    out["known"] += [knowns[i], *nothing]
                    out["base"] += [bases[i], *nothing]
                    out["score"] += [scores[i], *nothing]
                    row += 1
                doc = pa.array(out.pop("doc"), pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "of": pa.array(out["of"], pa.int64()), "key": part["key"].take(doc), "held_out": part["held_out"].take(doc), "word": pa.array(out["word"], pa.binary()), "times": pa.array(out["times"], pa.int64()),
                    "tokens": pa.array(out["tokens"], pa.int64()), "known": pa.array(out["known"], pa.int64()), "score": pa.array(out["score"], pa.float64()), "base": pa.array(out["base"], pa.float64()),
                })

    return run


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out=None, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row for each document: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those for which ``held_out(key)`` is false (crc32 of the id as text,
    modulo 10, is 0 for held-out ones; a null id counts as held out). Counts are taken over all of
    them, and the network is trained on all of their tokens. A token's chance under the model is that of its class, normalised over all classes, and
    within a class of infrequent words the word's share by its count and 0.1.

    The frequent words' counts, a bounded number, go to every task, which scores its texts by
    batched matrix products. A word beyond them leaves one row for each text that has it; these rows
    meet the table of counts in a join, no hot word being among them, and their sums go back to the
    text's own row by a number that lives within that job.

    Null and empty texts are the end alone. Repeated documents give a row each; if nothing is to
    learn from, all shares are equal and no word is known. Other columns are not read.
    """
    held = held_out or (lambda k: F.coalesce(F.crc32(k.cast("string").cast("binary")) % 10 == 0, F.lit(True)))
    train = docs.filter(~held(F.col(key)))
    counts = stage(count_tokens(train, text), "counts")
    vocab = vocabulary(counts, known_words)
    model = learn(train, vocab, text)
    logs = {w: math.log10(n + 0.1) for w, n in vocab.known.items()}
    rows = docs.select(F.col(key).cast("long").alias("key"), held(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    scored = rows.mapInArrow(_scored(model, logs, vocab), "of long, key long, held_out boolean, word binary, times long, tokens long, known long, score double, base double")
    # numbers count from 0 in each task; the task's own number tells them apart
    scored = stage(scored.withColumn("part", F.spark_partition_id()), "scored")
    rare = scored.filter(F.col("word").isNotNull()).select("part", "of", "word", "times")
    met = rare.join(counts, "word", "left").select("part", "of", "times", F.col("n").isNotNull().alias("seen"), F.log10(F.coalesce("n", F.lit(0)) + 0.1).alias("log"))
    sums = met.groupBy("part", "of").agg(F.sum(F.col("times") * F.col("log")).alias("rare"), F.sum(F.when(F.col("seen"), F.col("times")).otherwise(0)).alias("rare_known"))
    own = scored.filter(F.col("word").isNull()).drop("word", "times").join(sums, ["part", "of"], "left")
    rest = F.coalesce("rare", F.lit(0.0))
    per_token = math.log10(vocab.tokens + 0.1 * (vocab.distinct + 1))
    return own.select(
        F.col("key").alias(key), "held_out",
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rest - F.col("tokens") * per_token).alias("base_score"),
        (F.col("score") + rest).alias("score"),
    )
