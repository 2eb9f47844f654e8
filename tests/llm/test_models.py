import random

import numpy as np
import pytest
from edge import ODD, SCHEMA, documents

from adloom.llm import language, quality
from adloom.llm.common import held_out

WORDS = {"aa": ["tha", "ening", "wor", "lith", "shu"], "bb": ["ñora", "quezo", "illa", "dró", "uve"]}


def labelled(spark, n=400):
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(n):
        lang = truth[i] = rng.choice(sorted(WORDS))
        text = " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60)))
        rows.append((i, text, lang if rng.random() < 0.9 else None, "s", len(text), 7, 7, 7, 7.0, 7, "x", "x", "x"))
    return spark.createDataFrame(rows, SCHEMA), truth


def test_text_vectors_follow_the_definition():
    texts = ["Ab c", "", None, "12 !", "abcabc é"]
    got = language.text_vectors(texts, 128)
    for text, vector in zip(texts, got, strict=True):
        clean = [c if c.isalpha() else " " for c in (text or "").lower()]
        clean = " ".join("".join(clean).split())
        padded = f" {clean} " if clean else " "
        want = np.zeros(128)
        for k in range(len(padded) - 2):
            letters = [language._letter_vectors(np.array([ord(c)]), 128)[0].astype(float) for c in padded[k : k + 3]]
            want += np.roll(letters[0], 2) * np.roll(letters[1], 1) * letters[2]
        assert np.array_equal(vector, want), text


def test_counts_are_alike_for_small_and_large_alphabets():
    texts = ["".join(chr(0x4E00 + (i * 7 + k) % 900) for k in range(300)) for i in range(5)] + ["abc"]
    grams, owner, gram, count = language.gram_counts(texts)
    whole = {(int(o), tuple(grams[g])): int(c) for o, g, c in zip(owner, gram, count, strict=True)}
    for i, text in enumerate(texts):
        alone = language.gram_counts([text])
        assert {tuple(alone[0][g]): int(c) for g, c in zip(alone[2], alone[3], strict=True)} == {g: c for (o, g), c in whole.items() if o == i}


def test_languages_are_told_apart_on_the_held_out_fold(spark):
    docs, truth = labelled(spark)
    prototypes = language.learn_prototypes(docs)
    assert sorted(prototypes) == ["aa", "bb"]
    rows = language.predict_languages(docs.withColumn("held", held_out()), prototypes, "doc_id", "held").collect()
    assert len(rows) == 400 and all(r["lang_pred"] == truth[r["doc_id"]] and 0 <= r["score"] <= 1 for r in rows)
    assert 40 < sum(r["held"] for r in rows) < 120


def test_held_out_rows_teach_nothing(spark):
    docs, _ = labelled(spark)
    changed = docs.withColumn("lang", held_out().cast("string")).where(held_out())
    assert language.learn_prototypes(changed) == {}


def test_language_of_odd_rows(spark):
    docs, _ = labelled(spark, 50)
    prototypes = language.learn_prototypes(docs)
    odd = documents(spark, ODD)
    rows = language.predict_languages(odd, prototypes, "doc_id", "n_chars").collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} >= {1, 2, 3, 11}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in language.predict_languages(odd, {}, "doc_id").collect())
    marks = documents(spark, [(1, "\u0301"), (2, "e\u0301"), (3, "9 \u0301\u0300 9"), (4, None)])
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict_languages(marks, prototypes, "doc_id").collect()}
    assert got[1] == got[3] == got[4] == "und" and got[2] != "und"
    assert language.predict_languages(odd.where("false"), prototypes).count() == 0


def marked(spark, n=400):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        lines = [" ".join(rng.choice(WORDS["aa"]) for _ in range(rng.randint(4, 14))).capitalize() + "." for _ in range(rng.randint(1, 9))]
        good = rng.random() < 0.7
        if not good:
            lines[rng.randrange(len(lines))] = " ".join("".join(rng.choice(WORDS["aa"])).upper() + "!!" for _ in range(25))
        texts.append((i, "\n".join(lines)))
        labels.append((i, int(good), 0))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), dict(texts), {i: q for i, q, _ in labels}


def test_quality_on_the_held_out_fold(spark):
    docs, labels, texts, truth = marked(spark)
    field = quality.learn_field(docs, labels)
    rows = quality.score_quality(docs.withColumn("held", held_out()), field, "doc_id", "held").collect()
    held = [r for r in rows if r["held"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_bad_lines_are_found(spark):
    docs, labels, texts, truth = marked(spark)
    field = quality.learn_field(docs, labels)
    right = total = 0
    for i, text in texts.items():
        data = np.frombuffer(text.encode(), np.uint8)
        classes, _, lines = quality.line_features(data, np.array([0, len(data)]))
        bad = field.line_badness(classes, lines) > 0.5
        right += sum(b == ("!!" in line) for b, line in zip(bad, text.split("\n"), strict=True))
        total += len(bad)
    assert right / total > 0.95


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lines = np.array([0, 3, 4, 8])
    scores, ties = rng.normal(size=8), rng.normal(size=(2, 2))
    chains = quality.Chains(lines)
    bad, moves, norm = chains.forward_backward(scores[chains.rows], ties)
    got = np.zeros(8)
    got[chains.rows] = bad
    for rank, text in enumerate(chains.order):
        a, b = lines[text], lines[text + 1]
        weights, marginals, pairs = [], np.zeros(b - a), np.zeros((2, 2))
        for code in range(2 ** (b - a)):
            states = [(code >> k) & 1 for k in range(b - a)]
            w = np.exp(sum(scores[a + k] * s for k, s in enumerate(states)) + sum(ties[p, q] for p, q in zip(states, states[1:], strict=False)))
            weights.append(w)
            marginals += w * np.array(states)
            for p, q in zip(states, states[1:], strict=False):
                pairs[p, q] += w
        assert np.allclose(norm[rank], np.log(sum(weights)))
        assert np.allclose(got[a:b], marginals / sum(weights)) and np.allclose(moves[rank], pairs / sum(weights))


def test_line_features_match_single_texts():
    texts = [t or "" for _, t in ODD if len(t or "") < 200] + ["a b\n\nA!! B!!\na b", "\n", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    classes, sizes, lines = quality.line_features(data, offsets)
    for k, text in enumerate(texts):
        own = np.frombuffer(text.encode(), np.uint8)
        alone = quality.line_features(own, np.array([0, len(own)]))
        assert np.array_equal(alone[0], classes[lines[k] : lines[k + 1]]) and np.array_equal(alone[1], sizes[lines[k] : lines[k + 1]])
        assert len(alone[0]) == text.count("\n") + 1
        assert [s - 1 for s in alone[1]] == [len(x.encode()) for x in text.split("\n")]


def test_quality_of_odd_rows(spark):
    docs, labels, _, _ = marked(spark, 60)
    odd_labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, 0), (1, 0, 1)], labels.schema))
    field = quality.learn_field(docs, odd_labels)
    odd = documents(spark, ODD)
    rows = quality.score_quality(odd, field, "doc_id", "source").collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(odd.where("false"), field).count() == 0
    untaught = quality.learn_field(docs, labels.where("false"))
    assert {r["score"] for r in quality.score_quality(odd, untaught).collect()} == {0.5}


@pytest.mark.parametrize("steps", [1, 5])
def test_slope_of_the_likelihood_raises_it(steps):
    """A few steps of the fit improve the likelihood that it is the slope of."""
    rng = np.random.default_rng(2)
    lines = np.concatenate([[0], np.cumsum(rng.integers(1, 5, 40))])
    classes = rng.integers(0, 3, (lines[-1], len(quality.MEASURES))).astype(np.uint8)
    labels = np.array([int((classes[a:b, 0] < 2).all()) for a, b in zip(lines[:-1], lines[1:], strict=True)])

    def likelihood(field):
        chains = quality.Chains(lines)
        _, _, norm = chains.forward_backward(field.line_scores(classes, lines)[chains.rows], field.ties)
        good = np.minimum(field.ties[0, 0] * (chains.lengths - 1) - norm, -1e-9)
        return np.where(labels[chains.order] == 1, good, np.log(-np.expm1(good))).sum()

    sizes = np.ones(lines[-1])
    assert likelihood(quality.fit_field(classes, sizes, lines, labels, steps)) > likelihood(quality._start())
