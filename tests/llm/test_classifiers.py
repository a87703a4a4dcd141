"""Quality classifier and language identification: held-out accuracy and odd rows."""

from __future__ import annotations

import zlib

import numpy as np

from rulecheck.llm import language, quality

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in quality.op3_quality(spark, SF).collect()}
    labels = {r.doc_id: r.label for r in quality.labels_of(spark, SF).collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(r.predicted, labels[i]) for i, r in got.items() if r.held_out and i in labels]
    assert len(held) > 80 and np.mean([p == q for p, q in held]) >= 0.95


def test_quality_of_odd_rows(spark):
    rows = [(1, "good words here", "a"), (2, "x x x x", "b"), (None, None, "c"), (3, "", "d"), (1, "good words here", "a"), (4, "w" * 10_000, "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, label int")
    weights = quality.fit(docs, labels)
    scored = quality.score_documents(docs, weights).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    assert sorted(r._rest.score for r in scored) == ["a", "a", "b", "c", "d", "e"]
    assert quality.score_documents(docs.where("false"), weights).collect() == []
    nothing = quality.fit(docs, labels.where("false"))
    assert not nothing.any() and {r.score for r in quality.score_documents(docs, nothing).collect()} == {0.5}


def test_quality_sample_is_bounded_and_ignores_held_out_rows(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS label")
    assert quality.fit(docs, labels, sample_rows=100).any()
    held = labels.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1")
    assert not quality.fit(docs, held).any()


def test_updates_are_follow_the_regularised_leader():
    """One feature, one step: the closed form of the proximal update."""
    w = quality.train([None], np.array([1]))
    g = 0.5 - 1
    steps, n, z = quality.EPOCHS, 0.0, 0.0
    for _ in range(steps):
        b = 0.0 if abs(z) <= quality.L1 else -(z - np.sign(z) * quality.L1) / ((quality.BETA + np.sqrt(n)) / quality.ALPHA + quality.L2)
        g = 1 / (1 + np.exp(-b)) - 1
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / quality.ALPHA
        z, n = z + g - sigma * b, n + g * g
    b = -(z - np.sign(z) * quality.L1) / ((quality.BETA + np.sqrt(n)) / quality.ALPHA + quality.L2)
    assert np.isclose(w[-1], b) and not w[:-1].any()


def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in language.op6_language(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [got[d.doc_id].lang_pred == d.lang for d in docs if got[d.doc_id].held_out]
    assert np.mean(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_learns_from_repeated_ids(spark):
    """A row there 1000 times, and an id of 1000 texts, count as the texts that they hold."""
    kind = "doc_id bigint, text string, lang string"
    repeated = spark.createDataFrame([(i, "the cat and the dog", "en") for i in (1, 3, 4, 5, 6, 7, 8) for _ in range(1000)], kind)
    for doc_id in (1, 3, 4, 5, 6, 7, 8):
        own = repeated.where(f"doc_id = {doc_id}")
        learns = own.where(language.is_training(language.F.col("doc_id"))).count() > 0
        assert language.fit(own, landmarks=8).languages == (["en"] if learns else [])
    texts = spark.createDataFrame([(1, f"the cat and dog {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "en") for i in range(1000)], kind)
    assert language.fit(texts, landmarks=32).languages == ["en"]


def test_language_of_odd_rows(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(30)] + [(i, "le chat et le chien " * 3, "fr") for i in range(30, 60)]
    docs = spark.createDataFrame(rows + [(None, "x", "en"), (61, "y", None), (62, None, "fr")], "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert sorted(model.languages) == ["en", "fr"]
    asked = spark.createDataFrame(
        [(1, "the dog", "q"), (2, "le chien", "q"), (3, None, "q"), (4, "", "q"), (5, "12 !?", "q"), (5, "12 !?", "q"), (6, "中", "q"), (7, "the " * 9000, "q")],
        "doc_id bigint, text string, lang_pred string",
    )
    got = [(r._rest.doc_id, r.lang_pred, r.score) for r in language.predict_documents(asked, model).collect()]
    assert [p for i, p, _ in got if i in (1, 2, 7)] == ["en", "fr", "en"]
    assert [(p, s) for i, p, s in got if i in (3, 4, 5)] == [("und", 0.0)] * 4
    assert len(got) == 8 and next(p for i, p, _ in got if i == 6) in ("en", "fr")
    assert language.predict_documents(asked.where("false"), model).collect() == []
    unlearned = language.fit(docs.where("false"))
    assert {r.lang_pred for r in language.predict_documents(asked, unlearned).collect()} == {"und"}


def test_presence_is_of_whole_grams_inside_one_text():
    raw = np.frombuffer(b"abcab", np.uint8)
    whole = language.presence(raw, np.array([0, 5]))
    parts = language.presence(raw, np.array([0, 3, 5]))
    assert whole.sum() == 3 + 3 + 3 + 2  # a b c, ab bc ca, abc bca cab, abca bcab
    assert parts[0].sum() == 3 + 2 + 1 and parts[1].sum() == 2 + 1


def test_training_is_plain_follow_the_regularised_leader():
    """The same updates, feature by feature in dictionaries."""
    texts, labels = ["good words, good Words here", "x1 x1 x1 !!", "", "other words here"], np.array([1, 0, 1, 1])
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= quality.L1:
            return 0.0
        return -(zi - (quality.L1 if zi > 0 else -quality.L1)) / ((quality.BETA + n.get(i, 0.0) ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for text, label in zip(texts, labels.tolist(), strict=True):
            index, _, count = quality.features(*quality.text_buffer(quality.pa.array([text], quality.pa.large_string())))
            value = {quality.DIMENSIONS: 1.0}
            for i in index.tolist():
                value[i] = value.get(i, 0.0) + 1.0 / count[0]
            dot = sum(weight(i) * v for i, v in value.items())
            error = 1.0 / (1.0 + np.exp(-dot)) - label
            for i, v in value.items():
                w, g, old = weight(i), error * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / quality.ALPHA * w
                n[i] = old + g * g
    got = quality.train(texts, labels)
    assert set(np.flatnonzero(got).tolist()) <= set(z)
    assert np.allclose([got[i] for i in z], [weight(i) for i in z], rtol=1e-4, atol=1e-6)


def test_quality_sample_stays_at_its_bound(spark, monkeypatch):
    """One id with very many texts and repeated labels: no more rows train than the sample has."""
    docs = spark.range(6_000).selectExpr("IF(id < 5000, 3, id) AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(6_000).selectExpr("IF(id < 5000, 3, id) AS doc_id", "CAST(id % 2 AS INT) AS label")
    seen = []
    real = quality.smallest
    monkeypatch.setattr(quality, "smallest", lambda rows, most, *by: seen.append(real(rows, most, *by)) or seen[-1])
    assert quality.fit(docs, labels, sample_rows=200).any()
    assert [s.count() for s in seen] == [200, 200]


def test_language_model_is_the_direct_ridge_solution(spark):
    """Dense kernel rows of every text against every landmark, solved at once."""
    words = {"en": "the cat and dog", "fr": "le chat et chien", "de": "der hund und katze"}
    dice = np.random.default_rng(3)
    rows = [(i, " ".join(dice.choice(words[y].split(), 6)) + f" {y}{i}", y) for i, y in enumerate(["en", "fr", "de"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, landmarks=12)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    drawn = {r.text: r.drawn for r in docs.select("text", language.F.xxhash64("doc_id", "text").alias("drawn")).collect()}
    marks = [t for y in words for t in sorted((r[1] for r in learned if r[2] == y), key=drawn.get)[:4]]

    def kernel(texts, others):
        a, b = (language.presence(*language.text_buffer(language.pa.array(x, language.pa.large_string()))).astype(float) for x in (texts, others))
        return (a @ b.T) / np.sqrt(np.outer(a.sum(axis=1), b.sum(axis=1)))

    level, vectors = np.linalg.eigh(kernel(marks, marks))
    keep = level > 1e-6 * level.max()
    coordinates = lambda texts: np.c_[kernel(texts, marks) @ vectors[:, keep] / np.sqrt(level[keep]), np.ones(len(texts))]
    x = coordinates([r[1] for r in learned])
    y = np.array([[r[2] == name for name in model.languages] for r in learned], float)
    inner = x.T @ x
    penalty = language.RIDGE * np.trace(inner) / len(inner) * np.eye(len(inner))
    penalty[-1, -1] = 1e-9
    asked = [r[1] for r in rows]
    want = coordinates(asked) @ np.linalg.solve(inner + penalty, x.T @ y)
    best, score = language.predict(model, *language.text_buffer(language.pa.array(asked, language.pa.large_string())))
    assert best.tolist() == want.argmax(axis=1).tolist()
    assert np.allclose(score, np.clip(want.max(axis=1), 0, 1), atol=1e-3)
