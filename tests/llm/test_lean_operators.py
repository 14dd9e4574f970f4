"""Operators that must give the same rows with less work."""

import numpy as np

from sedimart.llm import ann, jaccard, lm


def test_chances_add_up_with_small_and_large_logits():
    draw = np.random.default_rng(0)
    model = lm.LogBilinear(8, np.full(8, 1 / 8))
    ids = draw.integers(0, 8, 3000)
    contexts = model.contexts(ids)
    for factor in (1, 300):
        model.out *= factor
        logits = (model.predict(contexts) @ model.out.T + model.bias).astype(np.float64)
        top = logits.max(1)
        assert (np.abs(logits).max() > lm.FLAT) == (factor > 1)
        right = logits[np.arange(len(ids)), ids] - top - np.log(np.exp(logits - top[:, None]).sum(1))
        np.testing.assert_allclose(model.log_chances(ids, contexts), right, rtol=1e-3, atol=1e-3)


def test_first_windows_are_looked_up_together():
    draw = np.random.default_rng(1)
    vectors, directions = draw.standard_normal((300, 6)), draw.standard_normal((ann.PROJECTIONS, 7))
    index = ann.Projections(vectors, np.linalg.norm(vectors, axis=1).max(), directions)
    queries, own = vectors[:9], np.arange(9)
    together = list(index.search(queries, own, directions, 5))
    assert len(index._steps(queries @ directions[:, :-1].T)) == ann.STEPS
    index._steps = lambda places: []
    for (a, x), (b, y) in zip(together, index.search(queries, own, directions, 5), strict=True):
        assert a.tolist() == b.tolist() and x.tolist() == y.tolist()


def test_pairs_are_staged_before_their_texts_come(spark, monkeypatch):
    names = []
    monkeypatch.setattr(jaccard, "stage", lambda df, name: (names.append(name), kept(df, name))[1])
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, "other words of its own kind here")], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.link_groups(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert names.count("pairs") == names.count("sharing") == names.count("found") == 3


def test_pairs_of_much_text_are_verified_in_turn(spark, monkeypatch):
    names = []
    monkeypatch.setattr(jaccard, "stage", lambda df, name: (names.append(name), kept(df, name))[1])
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text + f" {i}") for i in range(12)], "doc_id long, text string")
    join = jaccard.Join(docs.withColumnRenamed("doc_id", "key"), 5, 80)
    join.against_all()
    assert names.count("sharing") == 1 and names.count("found") > 3
    nodes = {r["node"] for r in join.nodes.collect()}
    links = [(r["a"], r["b"]) for r in join.links.collect()]
    assert len(nodes) == 12 and sorted(links) == sorted((a, b) for a in nodes for b in nodes if a < b)


kept = jaccard.stage
