"""Language ID, language model, nearest neighbours, Jaccard groups, repeated passages and the pipeline."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimart.llm import ann, jaccard, langid, lm, suffixes
from sedimart.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"aa": "lo mo ro so to vo lolo moso".split(), "bb": "ki pi xi zi wi kizi pixi wiki".split()}


def table(spark, texts, lang=None):
    return spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, t in texts], DOCS)


# --- language ID

@pytest.fixture(scope="module")
def spoken(spark):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(WORDS[k], k=draw.randint(5, 150))), k, "s", 0) for i, k in enumerate(itertools.islice(itertools.cycle(WORDS), 300))]
    rows += [(1000, None, "aa", "s", 0), (1001, "12 34", "bb", "s", 0), (None, "lo mo ro so", None, "s", 0), (1002, "", None, "s", 0), (1004, "½ ² ① Ⅷ", "aa", "s", 0), (1003, "ki pi " * 20000, None, "s", 0), (1003, "ki pi " * 20000, None, "s", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_gradients_are_those_of_the_loss():
    net = langid.Network(["a", "b", "c"])
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    draw = np.random.default_rng(0)
    codes, labels = draw.integers(0, 256, (6, 4)), np.array([0, 1, 2, 1])
    _, slopes = net.gradients(codes, labels)
    for name, w in net.weights.items():
        at = np.unravel_index(np.abs(slopes[name]).argmax(), w.shape)
        w[at] += 1e-4
        above = net.gradients(codes, labels)[0]
        w[at] -= 2e-4
        below = net.gradients(codes, labels)[0]
        w[at] += 1e-4
        assert slopes[name][at] == pytest.approx((above - below) / 2e-4, rel=1e-3, abs=1e-5)


def test_languages_of_held_out_documents(spoken):
    net = langid.learn(spoken)
    rows = langid.predict_language(spoken, net).collect()
    assert len(rows) == spoken.count()
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.95
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by[1000] == by[1001] == by[1002] == by[1004] == ("und", 0.0)
    assert by[1003][0] == "bb" and by[None][0] == "aa" and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in langid.keep_identified(spoken, net).collect()} == {k for k, (lang, score) in by.items() if lang != "und" and score >= langid.LEAST_SCORE}


def test_one_hot_id_does_not_swell_the_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(langid.Network, "fit", lambda self, texts, labels: taken.append((len(texts), len(set(texts)))) or self)
    rows = [(9, f"lo mo {i}", "aa") for i in range(2000)] + [(8, "ki pi", "bb")] * 2000 + [(8, "ki xi", "bb")]
    langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=100)
    [(n, different)] = taken
    assert 45 <= n == different <= 52  # at most 50 of each, repeated rows once


def test_languages_without_labels_or_rows(spoken):
    blank = spoken.withColumn("lang", F.lit(None).cast("string"))
    assert langid.learn(blank) is None
    assert {r.lang_pred for r in langid.predict_language(blank, None).collect()} == {"und"}
    assert langid.predict_language(spoken.filter("false"), langid.learn(spoken.filter("false"))).count() == 0


# --- language model

def test_chances_add_up_to_one():
    draw = np.random.default_rng(3)
    shares = draw.dirichlet(np.ones(20))
    model = lm.LogBilinear(20, shares)
    contexts, targets = draw.integers(0, 20, (lm.CONTEXT, 500)), draw.integers(0, 20, 500)
    model.fit(contexts, targets, shares)
    one = contexts[:, :1].repeat(20, 1)
    assert np.exp(model.log_chances(np.arange(20), one)).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("known_words", [lm.KNOWN_WORDS, 4])
def test_base_scores_and_better_model_scores(spark, spoken, known_words):
    rows = lm.score_documents(spoken, known_words=known_words).collect()
    texts = [(r.doc_id, [*(r.text or "").encode().lower().split(), b""]) for r in spoken.collect()]
    held = lambda k: k is None or zlib.crc32(str(k).encode()) % 10 == 0
    counts = collections.Counter(w for k, t in texts if not held(k) for w in t)
    n, v = sum(counts.values()), len(counts)
    want = collections.defaultdict(list)
    for k, t in texts:
        want[k].append((held(k), len(t), sum(w in counts for w in t), n, math.fsum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)))
    for r in rows:
        own = want[r.doc_id].pop()
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == own[:4]
        assert r.base_score == pytest.approx(own[4], rel=1e-9)
    assert not any(want.values())
    far = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in far) > sum(r.base_score for r in far)


def test_scores_equal_a_plain_reference(spark, spoken):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    train = spoken.filter(~held).coalesce(1)
    counts = lm.count_tokens(train)
    vocab = lm.vocabulary(counts, 6)
    model = lm.learn(train, vocab)
    n = {bytes(r.word): r.n for r in counts.collect()}
    tails = collections.defaultdict(float)
    for w, c in n.items():
        if w not in vocab.heads:
            tails[lm._tail(w)] += c + 0.1
    want = collections.defaultdict(list)
    for r in spoken.collect():
        if len(r.text or "") > 10_000:
            continue
        ids, total = [], 0.0
        for w in [*lm.words(r.text), b""]:
            k = vocab.heads.get(w) if w in vocab.heads else lm._tail(w)
            before = ([*reversed(ids)] + [model.classes] * lm.CONTEXT)[: lm.CONTEXT]
            logits = model.out @ sum(model.into[i][c] for i, c in enumerate(before)) + model.bias
            total += (float(logits[k]) - math.log(np.exp(logits.astype(np.float64)).sum())) / math.log(10)
            if w not in vocab.heads:
                total += math.log10((n.get(w, 0) + 0.1) / (tails[k] + 0.1))
            ids.append(k)
        want[r.doc_id].append(total)
    got = lm.score_documents(spoken.coalesce(1), known_words=6).collect()
    for r in got:
        if r.doc_id != 1003:
            assert r.score == pytest.approx(want[r.doc_id].pop(), rel=1e-4)


def test_scores_of_unseen_texts_and_no_rows(spark, spoken):
    only = table(spark, [(i, "unseen words") for i in range(30) if zlib.crc32(str(i).encode()) % 10 == 0])
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in lm.score_documents(only).collect())
    assert lm.score_documents(spoken.filter("false")).count() == 0


def test_all_tokens_of_long_texts_train(spark):
    keys = {h: next(i for i in range(100) if (zlib.crc32(str(i).encode()) % 10 == 0) == h) for h in (False, True)}
    docs = table(spark, [(keys[False], "aa bb " * 4000 + "cc dd " * 4000), (keys[True], "cc dd " * 100)])
    [row] = [r for r in lm.score_documents(docs).collect() if r.held_out]
    # what follows cc and dd stands beyond the first 20,000 characters only
    assert (row.score - row.base_score) / row.n_tokens > 0.3


# --- nearest neighbours

def test_neighbours_are_found_with_exact_scores(spark):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((8, 24))
    vectors = centres[draw.integers(0, 8, 900)] + 0.8 * draw.standard_normal((900, 24))
    vectors[5] = vectors[25]
    rows = [(i, [float(x) for x in v], "clash", 1) for i, v in enumerate(vectors)]
    odd = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (2080, [1.0, 2.0]), (2081, [1.0, 1.0])]
    rows += [(k, v, "clash", 1) for k, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector string, row int")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, block=300).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {*range(0, 900, 20), 2080} and [x[1:] for x in got[2080]] == [(2081, 3.0)]
    hits = 0
    for q in range(0, 900, 20):
        found = sorted(got[q])
        assert [x[0] for x in found] == list(range(1, 21))
        assert [x[1:] for x in found] == sorted((x[1:] for x in found), key=lambda x: (-x[1], x[0]))
        scores = (vectors * vectors[q]).sum(1)
        assert all(s == pytest.approx(scores[i], rel=1e-12) for _, i, s in found)
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:20]
        hits += len({i for _, i, _ in found} & set(order))
    assert hits >= 0.9 * 20 * 45


@pytest.mark.parametrize("width", [64, 128, 384])
def test_recall_in_blocks_of_production_size(width):
    draw = np.random.default_rng(width)
    vectors = draw.standard_normal((ann.BLOCK, width))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    directions = np.random.default_rng(ann.SEED).standard_normal((ann.PROJECTIONS, width + 1))
    asked = np.arange(0, ann.BLOCK, 400)
    hits = 0
    for i, (found, products) in zip(asked, ann.Projections(vectors, 1.0, directions).search(vectors[asked], asked, directions, 20), strict=True):
        exact = vectors @ vectors[i]
        exact[i] = -np.inf
        assert i not in found and products == pytest.approx(exact[found])
        hits += len(set(found[np.argsort(-products)[:20]].tolist()) & set(np.argsort(-exact)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(asked)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert collections.Counter((r.query_id, r["rank"], r.vec_id) for r in rows) == collections.Counter([(0, 1, 0), (0, 2, 20), (0, 1, 0), (0, 2, 20), (20, 1, 0), (20, 2, 0)])
    assert ann.nearest(df.filter("false"), F.lit(True)).count() == 0


# --- Jaccard groups

def brute_groups(texts, percent=80):
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    changed = True
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    keys = collections.defaultdict(list)
    for (k, _), at in zip(texts, label, strict=True):
        keys[at].append(k)
    least = {at: min((k for k in own if k is not None), default=None) for at, own in keys.items()}
    return collections.Counter((k, len(s), least[at]) for (k, _), s, at in zip(texts, sets, label, strict=True))


def near_texts():
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    shared = " ".join(word() for _ in range(30))
    texts, key = [], 100
    for size in (6, 20, 60, 200):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(8):
                other = list(base)
                for _ in range(draw.randint(0, max(1, size // 20))):
                    other[draw.randrange(size)] = word()
                texts.append((key, " ".join(other)))
                key += 1
        texts += [(key + i, f"{shared} {word()} {' '.join(word() for _ in range(size))}") for i in range(5)]
        key += 5
    draw.shuffle(texts)
    return texts + [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "É two"), (7, "é two"), (None, texts[0][1]), (8, "w " * 5000), (9, "w " * 30), (9, "w " * 30)]


@pytest.mark.parametrize("pivots", [1, 4])
def test_groups_equal_brute_force(spark, monkeypatch, pivots):
    monkeypatch.setattr(jaccard, "PIVOTS", max(2, pivots))
    texts = near_texts()
    assert collections.Counter(map(tuple, jaccard.link_groups(table(spark, texts)).collect())) == brute_groups(texts)


def test_groups_of_no_rows(spark):
    assert jaccard.link_groups(table(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in jaccard.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_signatures_differ_in_no_more_bits_than_tokens():
    rng = np.random.default_rng(4)
    for common, own in ((0, 3), (5, 1), (100, 20), (400, 300)):
        both = rng.integers(0, 2**63, common).astype(np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, own).astype(np.uint64)]) for _ in "ab")
        bits = sum(int(x).bit_count() for x in (jaccard._signature(a) ^ jaccard._signature(b)).view(np.uint64))
        assert bits <= 2 * own
        assert not (jaccard._signature(a) ^ jaccard._signature(a[::-1])).any()


def test_shingles_are_words_in_a_row():
    one, two = shingle_sets([b"a b c d e f", b"A  b\tc d\ne f"])
    assert (one == two).all() and len(one) == 2 and [len(s) for s in shingle_sets([b"", b" ", b"x", b"a b c d"])] == [0, 0, 1, 1]


# --- repeated passages

def brute_passages(texts, n):
    seen = collections.defaultdict(list)
    docs = sorted(set(texts), key=lambda kt: (kt[0] is None, kt[0] or 0, kt[1] or ""))
    for k, t in docs:
        w = (t or "").encode().lower().split()
        for i in range(len(w) - n + 1):
            seen[tuple(w[i : i + n])].append((k, t, i))
    first, later = collections.defaultdict(set), collections.defaultdict(set)
    for places in seen.values():
        for j, (k, t, i) in enumerate(places):
            if len(places) > 1:
                (later if j else first)[k, t].update(range(i, i + n))
    return first, later


@pytest.fixture(scope="module")
def passages():
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 70, 300)]
    texts = []
    for k in range(60):
        body = []
        for _ in range(draw.randint(1, 4)):
            body += [word() for _ in range(draw.randint(0, 80))] + (draw.choice(shared) if draw.random() < 0.6 else [])
        texts.append((k, " ".join(body).replace(" ", draw.choice([" ", "\n", "  "]))))
    return texts + [(70, None), (71, ""), (72, "Same " * 120), (73, "clean short text"), (74, texts[0][1].upper()), (None, texts[1][1]), (75, "é" * 2000)]


def test_passages_equal_brute_force(spark, passages):
    first, later = brute_passages(passages, 50)
    got = {True: collections.defaultdict(set), False: collections.defaultdict(set)}
    for r in suffixes.repeated_passages(table(spark, passages)).collect():
        assert r.n_words >= 50
        got[r.first][r.doc_id].update(range(r.start_word, r.start_word + r.n_words))
    assert got[True] == {k: v for (k, _), v in first.items()}
    assert got[False] == {k: v for (k, _), v in later.items()}


def test_cut_texts_keep_first_occurrences(spark, passages):
    _, later = brute_passages(passages, 50)
    docs = table(spark, passages, "en").withColumn("doc", F.lit("clash"))
    rest = suffixes.drop_repeats(docs)
    assert rest.columns == docs.columns
    got = {r.doc_id: r.text for r in rest.collect()}
    for k, t in passages:
        words = (t or "").split()
        kept = [w for i, w in enumerate(words) if i not in later[k, t]]
        if later[k, t] and not kept:
            assert k not in got
        else:
            assert (got[k] or "").split() == kept and (later[k, t] or got[k] == t)


def test_passages_of_no_rows_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    assert suffixes.repeated_passages(table(spark, [])).count() == 0
    twice = table(spark, [(1, text), (1, text), (2, "short"), (3, None)])
    got = sorted((r.doc_id, r.start_word, r.n_words, r.first, r.copy_of) for r in suffixes.repeated_passages(twice).collect())
    assert got == [(1, 0, 80, False, 1), (1, 0, 80, True, 1)]
    clashing = twice.withColumns({c: F.lit("clash") for c in ("__row", "__spans", "__rest", "__of", "__text", "__doc", "doc", "first")})
    rest = suffixes.drop_repeats(clashing)
    assert rest.columns == clashing.columns and sorted((r.doc_id, r.text, r["__rest"]) for r in rest.filter("text is not null").collect()) == [(1, text, "clash"), (2, "short", "clash")]
    assert suffixes.drop_repeats(table(spark, [])).count() == 0


# --- pipeline

def test_pipeline_keeps_clean_documents_and_drops_the_others(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(3)
    clean = [" ".join(draw.choices(WORDS["aa"], k=3) + [f"lo{draw.randrange(10**6)}mo" for _ in range(90)]) for _ in range(60)]
    passage = " ".join(f"so{i}to" for i in range(60))
    texts = [(i, t) for i, t in enumerate(clean)]
    texts += [(100, None), (101, "1 2 3"), (102, "too short"), (103, clean[0]), (104, clean[1] + " vo"), (105, clean[2] + " " + passage), (106, clean[3][::-1] + " " + passage)]
    docs = table(spark, texts, "aa")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left, seen = docs, []
    for name, apply in corpus_pipeline.STAGES:
        left = apply(spark, left, str(tmp_path))
        seen.append((name, left.columns))
    assert all(columns == docs.columns for _, columns in seen[:-1])
    packed = left.collect()
    ids = {r.doc_id for r in packed}
    assert ids == {*range(60), 105, 106}
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()} == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed}


def test_pipeline_stages_decide_by_row(spark, tmp_path):
    import corpus_pipeline

    clean = [" ".join(f"lo{i}mo{j}" for j in range(90)) for i in range(4)]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    judged = corpus_pipeline.judge(spark, table(spark, [(1, clean[0]), (1, "too short"), (None, clean[1]), (None, "short")], "aa"), str(tmp_path))
    assert {(r.doc_id, r.text) for r in judged.collect()} == {(1, clean[0]), (None, clean[1])} and judged.columns == [c.split()[0] for c in DOCS.split(", ")]
    # a unique text of an id stays beside a copy of another; of equal rows one stays, also without ids
    texts = [(1, clean[0]), (2, clean[0] + " x"), (2, clean[1]), (3, clean[2]), (3, clean[2]), (None, clean[3]), (None, clean[3]), (None, clean[2]), (4, None), (5, "")]
    left = corpus_pipeline.deduplicate(spark, table(spark, texts, "aa"), str(tmp_path))
    got = collections.Counter((r.doc_id, r.text) for r in left.collect())
    assert got == collections.Counter([(1, clean[0]), (2, clean[1]), (3, clean[2]), (None, clean[3]), (4, None), (5, "")])
