import random
import sys
from itertools import product
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shoprec.llm.common import crc_mod  # noqa: E402
from shoprec.llm.hmm import Model, Settings, expected_counts, language_model_scores, padded_of  # noqa: E402
from shoprec.llm.labelled import sample  # noqa: E402
from shoprec.llm.quality_classifier import coordinate_descent, score_quality  # noqa: E402
from shoprec.llm.quality_rules import measures, quality_by_votes  # noqa: E402
from shoprec.llm.toxicity import learn, score_toxicity, without_toxic  # noqa: E402

CLASHING = "doc_id long, text string, score double, words string, n long, label int, row string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "w", 1, 7, "r") for r in rows], CLASHING)


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["ka", "lo", "mi", "ter", "an"]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


def documents(seed=1, n=80):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.choice([3, 25, 60, 300]))) for i in range(n)]
    block = prose(rnd, 12)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, f"{block} {block} end"), (n + 4, "a b " * 40),
             (n + 5, "same line\n\nsame line\n same line\nsame line"), (n + 6, "É#é *$ %& |<> ok"), (n + 7, rows[3][1]),
             (3, rows[3][1]), (None, rows[5][1]), (n + 8, "w " * 5000), (n + 9, "x" * 3000)]
    return rows


def test_measures_equal_brute_force(spark):
    rows = documents()
    got = measures(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    expected = sorted(((-1 if d is None else d), *brute.measures(t)) for d, t in rows)
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == expected


def test_votes_keep_clean_and_reject_faulty(spark):
    rnd = random.Random(3)
    clean = [(i, "\n".join(" ".join(f"word{rnd.randrange(5000)}" for _ in range(9)) for _ in range(9))) for i in range(200)]
    symbols = [(1000 + i, " ".join(w + "%%%" for w in t.split())) for i, t in clean[:15]]
    capitals = [(2000 + i, t.upper()) for i, t in clean[15:30]]
    got = {r.doc_id: r.kept for r in quality_by_votes(frame(spark, clean + symbols + capitals)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[i] for i in got if i >= 1000)
    none = quality_by_votes(frame(spark, [(1, None), (2, "too few words")])).collect()
    assert all(r.base_failed and not r.kept for r in none)
    assert quality_by_votes(frame(spark, [])).count() == 0


def test_verdict_is_no_bad_vote_at_a_moderate_share_of_good(spark):
    rnd = random.Random(8)
    clean = [(i, " ".join(f"word{rnd.randrange(5000)}" for _ in range(60))) for i in range(60)]
    symbols = [(1000 + i, " ".join(w + "%%%" for w in t.split())) for i, t in clean[:10]]
    capitals = [(2000 + i, t.upper()) for i, t in clean[10:20]]
    got = quality_by_votes(frame(spark, [*clean, *symbols, *capitals, (3000, "short")])).collect()
    assert all(r.kept == (not r.base_failed and all(r[c] != -1 for c in r.asDict() if c.startswith("vote_"))) for r in got)


def all_paths(model, seq):
    """Probability of a sequence as the sum over all state paths."""
    total = 0.0
    for path in product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[path[0], seq[0]]
        for a, b, s in zip(path, path[1:], seq[1:], strict=False):
            p *= model.move[a, b] * model.emit[b, s]
        total += p
    return total


def random_model(seed, k=3, s=5):
    rng = np.random.default_rng(seed)
    even = lambda x: x / x.sum(axis=-1, keepdims=True)
    return Model(even(rng.random(k)), even(rng.random((k, k))), even(rng.random((k, s))))


def test_forward_and_counts_equal_sums_over_paths():
    model = random_model(1)
    seqs = [np.array(x) for x in ([0, 1, 2, 3], [4], [2, 2, 0, 1, 3], [1, 4, 4])]
    seqs.sort(key=len, reverse=True)
    padded, alive = padded_of(seqs)
    logs = model.forward(padded, alive, False)[1]
    assert np.allclose(logs, [np.log10(all_paths(model, s)) for s in seqs])
    starts, moves, emits, total = expected_counts(model, seqs)
    assert np.isclose(total, logs.sum()) and np.isclose(starts.sum(), 4) and np.isclose(moves.sum(), 9)
    assert np.allclose(emits.sum(axis=0), np.bincount(np.concatenate(seqs), minlength=5))


def test_base_scores_equal_brute_force_and_training_helps(spark):
    rows = documents(4)
    small = Settings(states=2, rounds=3, known=40, symbols=20, classes=4)
    got = language_model_scores(frame(spark, rows), crc_mod(F.col("doc_id"), 7) != 2, small).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1:])
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    expected = sorted(brute.unigram(rows, lambda d: brute.crc(d) % 7 != 2), key=key)
    assert [m[:4] for m in mine] == [e[:4] for e in expected]
    assert np.allclose([m[4] for m in mine], [e[4] for e in expected])
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert all(r.score < 0 for r in got)


def test_probabilities_of_all_words_sum_to_one(spark):
    rows = [(1, "a b c d e f g"), (2, "a a b b c"), (3, "a")]
    words = ["a", "b", "c", "d", "e", "f", "g"]
    rows += [(10 + i, w) for i, w in enumerate(words)] + [(30, "")]
    small = Settings(states=2, rounds=2, known=4, symbols=2, classes=1)
    got = {r.doc_id: 10**r.score for r in language_model_scores(frame(spark, rows), F.col("doc_id") < 5, small).collect()}
    unknown = language_model_scores(frame(spark, [*rows, (40, "never")]), F.col("doc_id") < 5, small).where("doc_id = 40").first()
    # A text is a first token and the end, or the end alone; longer texts hold the rest.
    assert 0 < sum(got[10 + i] for i in range(7)) + 10**unknown.score + got[30] < 1
    assert unknown.n_known == 1 and unknown.score < got[16]


def test_language_model_without_training_rows(spark):
    got = language_model_scores(frame(spark, [(1, "a b"), (2, None)]), F.lit(False), Settings(states=2, rounds=1)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in got)
    assert language_model_scores(frame(spark, []), F.lit(True), Settings(states=2, rounds=1)).count() == 0


def labelled(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_quality_classifier_on_held_out_documents(spark):
    rnd = random.Random(6)
    rows = [(i, prose(rnd, 80) if i % 3 else " ".join(w + "!!" for w in prose(rnd, 80).upper().split())) for i in range(300)]
    docs = frame(spark, [*rows, (500, None), (501, ""), (None, rows[1][1]), (1, rows[1][1])])
    labels = labelled(spark, [(i, int(i % 3 > 0)) for i in range(200)] + [(None, 0), (5, None), (9999, 1)], "quality")
    got = score_quality(docs, labels, rows=150).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == 304 and all(0 <= r.score <= 1 for r in got)
    assert all((score[i] > 0.5) == (i % 3 > 0) for i in range(200, 300))
    one = score_quality(docs, labelled(spark, [(1, 1)], "quality")).first()
    none = score_quality(docs, labelled(spark, [], "quality")).first()
    assert one.score == pytest.approx(0.99) and none.score == pytest.approx(0.5)
    assert score_quality(docs.limit(0), labels).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    y = np.where(x @ [1.0, -2, 0.5, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    w = coordinate_descent([(np.arange(4), r) for r in x], y, 4, epochs=500)

    def loss(v):
        return v @ v / 2 + (np.maximum(0, 1 - y * (x @ v[:4] + v[4])) ** 2).sum()

    assert all(loss(w) <= loss(w + 0.01 * rng.normal(size=5)) + 1e-6 for _ in range(50))


def test_toxicity_chain(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        text = prose(rnd, 60).split()
        if i % 5 == 0:
            text[rnd.randrange(60)] = rnd.choice(["Vile,", "vile", "rotten!"])
        rows.append((i, " ".join(text)))
    docs = frame(spark, [*rows, (500, None), (501, ""), (None, "so VILE"), (0, rows[0][1])])
    labels = labelled(spark, [(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (7, None)], "toxic")
    model = learn(docs, labels)
    got = score_toxicity(docs, model).collect()
    assert {r.doc_id for r in got if r.toxic} == {None, *range(0, 400, 5)} and len(got) == 404
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 404 - 82
    assert learn(docs, labelled(spark, [], "toxic")) == b""
    assert score_toxicity(docs, b"").where("toxic = 1").count() == 0
    assert without_toxic(docs, b"").count() == 404 and score_toxicity(docs.limit(0), model).count() == 0


def test_models_do_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(21)
    rows = [(i, prose(rnd, 40) + (" grumpf" if i % 5 == 0 and i % 3 else "") + (" fine" if i % 4 else "")) for i in range(300)]
    rows += [(8, prose(rnd, 30)) for _ in range(200)]  # one id with many texts
    docs = frame(spark, rows)
    mixed = frame(spark, rnd.sample(rows, len(rows))).repartition(13)
    tox = labelled(spark, [(i, int(i % 5 == 0)) for i in range(300)], "toxic")
    fine = labelled(spark, [(i, int(i % 4 > 0)) for i in range(300)], "quality")
    assert sample(docs, tox, "toxic", 300).count() == 300
    assert learn(docs, tox) == learn(mixed, tox.repartition(5))
    got = [sorted((r.doc_id, r.score) for r in score_quality(d, fine, rows=200).collect()) for d in (docs, mixed)]
    assert got[0] == got[1]
