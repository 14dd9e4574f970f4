"""Steps of the training-data operators that must do less work for the same rows."""

import numpy as np
import pyarrow as pa

from sedimart.llm import ann, jaccard, lm


def test_passages_that_two_texts_share_make_no_pairs(spark):
    own = [[f"w{i}x{j}" for j in range(300)] for i in range(30)]
    texts = [" ".join([*words, *(f"both{i // 2}x{j}" for j in range(20))]) for i, words in enumerate(own)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string")
    # a text has many tokens of its own, which come before those of two texts
    assert jaccard.Join(docs, 5, 80).shown.count() == 0
    near = docs.union(spark.createDataFrame([(100, texts[4] + " more"), (101, "a b c d e f"), (102, "a b c d e f g")], docs.schema))
    found = {r["key"]: r["component_id"] for r in jaccard.link_groups(near, "key").collect()}
    assert found == {i: 4 if i == 100 else i for i in (*range(30), 100, 101, 102)}


def test_candidates_hold_the_prefix():
    draw = np.random.default_rng(3)
    for size in (1, 2, 4, 9, 60, 700):
        shingles = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        found = jaccard._candidates(shingles, 80)
        assert len(found) >= jaccard.prefix_length(size, 80) and len(np.unique(found)) == len(found)
        assert set(shingles[jaccard._front(shingles)].tolist()) <= set(found.tolist()) <= set(shingles.tolist())


def test_search_gives_the_nearest_not_all_that_it_met():
    draw = np.random.default_rng(4)
    vectors, directions = draw.standard_normal((400, 8)), draw.standard_normal((ann.PROJECTIONS, 9))
    vectors[30] = vectors[31]
    index = ann.Projections(vectors, np.linalg.norm(vectors, axis=1).max(), directions)
    for i, (found, products) in enumerate(index.search(vectors, np.arange(400), directions, 5)):
        assert 5 <= len(found) <= 7
        assert products.tolist() == (vectors[found] * vectors[i]).sum(1).tolist()


def test_words_are_looked_up_for_many_texts_at_once():
    vocab = lm.Vocabulary({b"the": 9, b"": 4, "süß".encode(): 3, b"odd": 1}, 17, 4, {})
    texts = ["The süß\todd\x0b\x0cnew  THE", None, "", " \n", "\xa0the  the\x1fthe"]
    for sliced in (pa.array(texts), pa.array(["x the", *texts]).slice(1)):
        place, classes, starts, rare, unknown = vocab.places(sliced)
        tokens = [[*lm.words(t), lm.END] for t in texts]
        flat = [w for t in tokens for w in t]
        assert starts.tolist() == np.cumsum([0, *map(len, tokens)]).tolist()
        assert place.tolist() == [list(vocab.known).index(w) if w in vocab.known else 4 for w in flat]
        assert classes.tolist() == [vocab.heads[w] if w in vocab.heads else lm._tail(w) for w in flat]
        assert unknown == [flat[i] for i in rare.tolist()] == [w for w in flat if w not in vocab.known]
    assert lm.Vocabulary({}, 0, 0, {}).places(pa.array(["a", None]))[4] == [b"a", b"", b""]


def test_gradients_add_up_by_class():
    sums, classes, values = np.zeros((4, 3), np.float32), np.array([2, 0, 2]), np.arange(9.0).reshape(3, 3)
    lm._add_by_class(sums, classes, values)
    assert sums.tolist() == [[3, 4, 5], [0, 0, 0], [6, 8, 10], [0, 0, 0]]
