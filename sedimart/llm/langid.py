"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Labelled documents that the network learns from, at most so many in all, equally many of each language.
SAMPLE_DOCS = 4_000
#: Characters of a sampled document, from a place that its id decides.
SAMPLE_CHARS = 400
HIDDEN, WINDOW, STEPS, BATCH, SEED = 8, 48, 400, 256, 7
#: Bytes that the network reads at a stretch when it predicts; a text is cut into stretches, all of which are read.
STRETCH = 256
#: Stretches that are read together.
TOGETHER = 2048
#: A document whose best language scores less is of no clear language.
LEAST_SCORE = 0.4
#: Letters, in tasks as in Spark; numbers and marks that look like letters are none.
LETTER = regex.compile(r"\p{L}")


def bucket(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: its remainder modulo 4 is 2, or it has no id."""
    return F.coalesce(bucket(key, 4) == 2, F.lit(True))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


class Network:
    """Gated recurrent units in both directions; a softmax over the languages at every byte.

    Arrays have the direction first: 0 reads forwards, 1 backwards. ``x`` has the gates' inputs for
    each byte (update, reset, candidate), ``u`` the recurrent weights, ``v`` and ``c`` the output.
    """

    def __init__(self, langs: list[str], seed: int = SEED, hidden: int = HIDDEN):
        draw = np.random.default_rng(seed)
        self.langs, h = langs, hidden
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {"x": normal(2, 256, 3 * h, scale=0.3), "u": normal(2, h, 3 * h, scale=h**-0.5), "v": normal(2, h, len(langs), scale=h**-0.5), "c": np.zeros(len(langs), np.float32)}

    def _run(self, codes: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each byte, [2, time, rows, hidden], each direction in its own order of time."""
        x, u = self.weights["x"], self.weights["u"]
        time, rows = codes.shape
        h, kind = u.shape[1], x.dtype
        parts = [(np.ascontiguousarray(w[:, :, : 2 * h]), np.ascontiguousarray(w[:, :, 2 * h :])) for w in (x, u)]
        (x_gates, x_new), (u_gates, u_new) = parts
        states, tape = np.empty((2, time, rows, h), kind), []
        state, gates, new = np.zeros((2, rows, h), kind), np.empty((2, rows, 2 * h), kind), np.empty((2, rows, h), kind)
        turned = np.empty_like(gates), np.empty_like(new)
        for t in range(time):
            if keep:
                gates, new = np.empty_like(gates), np.empty_like(new)
            for d, row in ((0, t), (1, time - 1 - t)):
                np.take(x_gates[d], codes[row], axis=0, out=gates[d], mode="clip")
                np.take(x_new[d], codes[row], axis=0, out=new[d], mode="clip")
            np.matmul(state, u_gates, out=turned[0])
            gates += turned[0]
            _sigmoid(gates)
            z, r = gates[:, :, :h], gates[:, :, h:]
            np.matmul(r * state, u_new, out=turned[1])
            new += turned[1]
            np.tanh(new, out=new)
            if keep:
                tape.append((state, z, r, new))
            after = states[:, t]
            np.subtract(new, state, out=after)
            after *= z
            after += state
            state = after
        return states, tape

    def _posterior(self, states: np.ndarray) -> np.ndarray:
        """Chances of the languages at each byte, [time, rows, languages]."""
        logits = states[0] @ self.weights["v"][0] + states[1][::-1] @ self.weights["v"][1] + self.weights["c"]
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all bytes of windows [time, rows], and its gradients by backpropagation through time."""
        time, rows = codes.shape
        u, v = self.weights["u"], self.weights["v"]
        h = u.shape[1]
        states, tape = self._run(codes, keep=True)
        chances = self._posterior(states)
        loss = -float(np.log(chances[:, np.arange(rows), labels] + 1e-9).mean())
        d_out = chances
        d_out[:, np.arange(rows), labels] -= 1
        d_out /= time * rows
        in_order = np.stack([d_out, d_out[::-1]])
        out = {"v": np.einsum("dtrh,dtrk->dhk", states, in_order, optimize=True), "c": d_out.sum((0, 1))}
        d_states = np.stack([in_order[d] @ v[d].T for d in (0, 1)])
        d_x, d_u, d_state = np.zeros_like(self.weights["x"]), np.zeros_like(u), np.zeros((2, rows, h), np.float32)
        for t in range(time - 1, -1, -1):
            before, z, r, new = tape[t]
            d_state = d_state + d_states[:, t]
            d_new = d_state * z * (1 - new * new)
            d_gated = d_new @ u[:, :, 2 * h :].transpose(0, 2, 1)
            d_gates = np.concatenate([d_state * (new - before) * z * (1 - z), d_gated * before * r * (1 - r)], axis=2)
            d_u[:, :, 2 * h :] += (r * before).transpose(0, 2, 1) @ d_new
            d_u[:, :, : 2 * h] += before.transpose(0, 2, 1) @ d_gates
            d_in = np.concatenate([d_gates, d_new], axis=2)
            for d, row in ((0, t), (1, time - 1 - t)):
                np.add.at(d_x[d], codes[row], d_in[d])
            d_state = d_state * (1 - z) + d_gated * r + d_gates @ u[:, :, : 2 * h].transpose(0, 2, 1)
        return loss, out | {"x": d_x, "u": d_u}

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Network:
        """Adam on windows at random places of the texts, every language as often as any other."""
        draw = np.random.default_rng(seed)
        of = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        for step in range(1, steps + 1):
            chosen = np.concatenate([draw.choice(rows, BATCH // len(of) + 1) for rows in of])
            windows = []
            for i in chosen:
                at = int(draw.integers(0, max(1, len(texts[i]) - WINDOW + 1)))
                windows.append(texts[i][at : at + WINDOW].ljust(WINDOW))
            codes = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW).T
            _, slopes = self.gradients(codes, labels[chosen])
            rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, w in self.weights.items():
                first[k] += 0.1 * (slopes[k] - first[k])
                second[k] += 0.01 * (slopes[k] ** 2 - second[k])
                w -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean chances over all bytes of each text, [texts, languages]; a text of no bytes has zeros."""
        total = np.zeros((len(texts), len(self.langs)))
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        whole = np.frombuffer(b"".join(t.ljust(-(-len(t) // STRETCH) * STRETCH) for t in texts), np.uint8).reshape(-1, STRETCH)
        counts = -(-sizes // STRETCH)
        of = np.repeat(np.arange(len(texts)), counts)
        last = np.cumsum(counts)[counts > 0] - 1
        filled = np.full(len(whole), STRETCH)
        filled[last] = sizes[counts > 0] - (counts[counts > 0] - 1) * STRETCH
        for at in range(0, len(whole), TOGETHER):
            rows = slice(at, at + TOGETHER)
            chances = self._posterior(self._run(np.ascontiguousarray(whole[rows].T), keep=False)[0])
            chances *= (np.arange(STRETCH)[:, None] < filled[rows])[:, :, None]
            np.add.at(total, of[rows], chances.sum(0))
        return total / np.maximum(sizes, 1)[:, None]


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_DOCS) -> Network | None:
    """A network from labelled documents that are not held out, or None if there are none.

    The one sample taken: of each language, different documents whose hash of id and text is least, at
    most ``sample`` / number of languages of them, ``SAMPLE_CHARS`` characters of each. A bound on the
    hash lets through a few more than are wanted, so little is compared; repeated rows are one. Which
    ones follows from the rows alone, so the same table gives the same network.
    """
    usable = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    usable = usable.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("key")))
    counts = docs.filter(F.col(lang).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(lang).cast("string").alias("lang")).count()
    sizes = {r["lang"]: r["count"] for r in counts.collect()}
    if not sizes:
        return None
    most = max(1, sample // len(sizes))
    bound = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, (1.2 * most + 50) / n)]), F.col("lang"))
    h = F.xxhash64("key", "text")
    draw = F.shiftrightunsigned("h", 11) / F.lit(float(2**53))
    place = F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    drawn = usable.withColumn("h", h).filter(draw < bound).select("lang", "h", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text")).dropDuplicates(["lang", "h"])
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h"))
    rows = drawn.withColumn("place", order).filter(F.col("place") <= most).collect()
    rows = sorted((r["h"], r["lang"], r["text"]) for r in rows)
    langs = sorted({lang for _, lang, _ in rows})
    if not langs:
        return None
    return Network(langs).fit([t.encode() for _, _, t in rows], np.array([langs.index(lang) for _, lang, _ in rows]))


def _predicted(network: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t if network and t and LETTER.search(t) else "" for t in part["text"].to_pylist()]
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                if network:
                    chances = network.pooled([t.encode() for t in texts])
                    langs = [network.langs[k] if t else "und" for t, k in zip(texts, chances.argmax(1), strict=True)]
                    scores = np.clip(chances.max(1), 0.0, 1.0)
                yield pa.RecordBatch.from_pydict({c: part[c] for c in part.schema.names if c != "text"} | {"lang_pred": langs, "score": scores})

    return run


def _clear(network: Network | None, text: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            only = pa.RecordBatch.from_pydict({"text": batch[text]})
            found = pa.Table.from_batches(_predicted(network)(iter([only])))
            kept = pc.and_(pc.not_equal(found["lang_pred"], "und"), pc.greater_equal(found["score"], least))
            yield batch.filter(kept.combine_chunks())

    return run


def keep_identified(docs: DataFrame, network: Network | None, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows whose text has a language with a score of ``least`` or more, with all their columns.

    Texts that are null or have no letter go. If there was nothing to learn from, all rows go or
    stay by their letters alone.
    """
    if network is None:
        return docs.filter(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return docs.mapInArrow(_clear(network, text, least), docs.schema)


def predict_language(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, held_out, lang_pred and score, from the text alone.

    Every byte of the whole text gets chances of the languages; their mean over the text decides, and
    is the score. A null text, or one without a letter, is ``und`` with score 0, as are all texts if
    there was nothing to learn from; ties go to the language that sorts first. Documents of null key
    count as held out. Equal rows give a row each; an empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    out = rows.mapInArrow(_predicted(network), "key long, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("key", key)
