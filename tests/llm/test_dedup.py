import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shoprec.llm.components import components  # noqa: E402
from shoprec.llm.jaccard import jaccard_components  # noqa: E402
from shoprec.llm.merging import merge_front_coded, merge_runs  # noqa: E402
from shoprec.llm.suffix_dedup import remove_repeats  # noqa: E402

KINDS = "doc_id long, text string, h string, n_bytes int, s string, n string, hash string, name int"


def frame(spark, rows):
    """Documents with columns named like those the operators make."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "q", 5) for r in rows], KINDS)


def passages(seed, n, size=40, letters="ab \n"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(size)) for _ in range(n)]


def corpus(seed=1):
    rnd = random.Random(seed)
    parts = passages(seed, 6, 30, "abcdé ")
    rows = []
    for i in range(60):
        rows.append((i, "".join(rnd.choice(parts) if rnd.random() < 0.5 else passages(rnd.random(), 1, 25, "abcdé ")[0] for _ in range(4))))
    return [*rows, (60, None), (61, ""), (62, "a" * 500), (63, "ab" * 200), (64, "xyz" * 120), (64, "xyz" * 120),
            (None, rows[3][1]), (65, "q" * 19), (66, "q" * 20), (67, "\x00" * 45 + "tail"), (68, "short")]


@pytest.mark.parametrize(("length", "sizes"), [(20, {}), (20, {"run": 50, "range_size": 20}), (37, {"crowd": 3}), (20, {"crowd": 1, "range_size": 10})])
def test_repeats_equal_brute_force(spark, length, sizes):
    rows = corpus(length)
    found = remove_repeats(frame(spark, rows), length, **sizes).drop("kept", "carried").collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(brute.repeats(rows, length), key=key)


def test_repeats_in_many_near_copies(spark):
    rnd = random.Random(5)
    base = passages(9, 1, 900, "abcdefgh ")[0]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rnd.randrange(6)):
            text[rnd.randrange(len(text))] = "#"
        rows.append((i, "".join(text)))
    found = remove_repeats(frame(spark, rows), 200, run=40, range_size=50).drop("kept", "carried").collect()
    assert sorted(map(tuple, found)) == sorted(brute.repeats(rows, 200))


def test_repeats_carry_columns_and_empty_table(spark):
    rows = frame(spark, [(1, "héllo" * 30), (2, "zwei" * 3)])
    got = {r.doc_id: r for r in remove_repeats(rows, 50, carry=["h", "hash"]).collect()}
    assert got[1].n_removed == 180 and got[1].kept == "" and got[2].kept == "zweizweizwei"
    assert got[2].carried.h == "x" and got[2].carried.hash == "q"
    assert remove_repeats(rows.limit(0), 50).count() == 0


def words_of(rnd, n, size=300):
    return [f"W{rnd.randrange(size)}" for _ in range(n)]


def similar(seed):
    rnd = random.Random(seed)
    rows, texts = [], []
    for _ in range(12):
        base = words_of(rnd, rnd.choice([4, 12, 40, 90]))
        for _ in range(rnd.randrange(1, 9)):
            text = list(base)
            for _ in range(rnd.randrange(3)):
                text[rnd.randrange(len(text))] = rnd.choice(words_of(rnd, 3))
            texts.append(rnd.choice([" ", "\t", "\n "]).join(text))
    chain = words_of(rnd, 60, 10_000)  # each is near the next one only
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[1:], f"new{rnd.random()}"]
    texts += ["", None, "  \n ", "one", "ONE", "one two", "one two", "É é e", "é é e"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    return [*rows, (3, texts[3]), (None, texts[5])]


@pytest.mark.parametrize(("n", "percent", "seed"), [(3, 90, 1), (3, 90, 2), (5, 80, 3), (2, 50, 4)])
def test_jaccard_equals_brute_force(spark, n, percent, seed):
    rows = similar(seed)
    found = [tuple(r) for r in jaccard_components(frame(spark, rows), n, percent).collect()]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(found, key=key) == sorted(brute.jaccard(rows, n, percent), key=key)


def test_jaccard_with_words_in_all_documents(spark):
    rnd = random.Random(8)
    common = " ".join(words_of(rnd, 30))
    rows = [(i, " ".join(words_of(rnd, rnd.randrange(3, 40), 10_000)) + " " + common) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " more") for i in range(20)]
    found = sorted(tuple(r) for r in jaccard_components(frame(spark, rows), 3, 90).collect())
    assert found == sorted(brute.jaccard(rows, 3, 90))


def test_jaccard_of_no_documents(spark):
    assert jaccard_components(frame(spark, []), 3, 90).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 301), (301, 302), (302, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(300, 303), 300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_loser_trees():
    rnd = random.Random(2)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted((rnd.randrange(20), r) for _ in range(rnd.randrange(9))) for r in range(k)]
        assert list(merge_runs(runs)) == sorted(x for r in runs for x in r)
        texts = [sorted({"".join(rnd.choice("ab") for _ in range(6)).encode() for _ in range(9)}) for _ in range(k)]
        coded = []
        for run in texts:
            before, items = b"", []
            for t in run:
                same = next((i for i, (x, y) in enumerate(zip(before, t, strict=False)) if x != y), min(len(before), len(t)))
                items.append((same, t[same:], t))
                before = t
            coded.append(iter(items))
        out = list(merge_front_coded(coded))
        assert [t for _, t, _ in out] == sorted(t for r in texts for t in r)
        for (_, a, _), (same, b, _) in zip(out, out[1:], strict=False):
            assert a[:same] == b[:same] and (a == b or a[same] != b[same])


def test_many_rows_without_id_and_many_equal_rows(spark):
    import time

    rnd = random.Random(11)
    base = [words_of(rnd, 40, 5000) for _ in range(1000)]
    texts = []
    for w in base:  # each text and a near copy
        changed = list(w)
        changed[rnd.randrange(len(w))] = "changed"
        texts += [" ".join(w), " ".join(changed)]

    def timed(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8).cache()
        frame.count()
        start = time.time()
        found = jaccard_components(frame, 3, 80).collect()
        return time.time() - start, found

    timed([(i, t) for i, t in enumerate(texts[:50])])  # compiles
    plain, found = timed([(i, t) for i, t in enumerate(texts)])
    assert {r.component_id for r in found} == set(range(0, 2000, 2))
    nameless, found = timed([(None, t) for t in texts])
    assert len(found) == 2000 and {r.component_id for r in found} == {None} and all(r.n_shingles for r in found)
    equal, found = timed([(i % 3, texts[0]) for i in range(1000)] + [(7, texts[1])] * 1000)
    assert len(found) == 2000 and {r.component_id for r in found} == {0}
    assert nameless < 2 * plain + 5 and equal < 2 * plain + 5


def test_links_in_texts_beyond_a_block(spark):
    rnd = random.Random(12)
    w = words_of(rnd, 250_000, 10**6)  # over 1 MiB
    assert len(" ".join(w)) > 1 << 20
    near, far = list(w), list(w)
    for k in range(0, 250_000, 100):
        near[k] = "n"
    for k in range(0, 250_000, 10):
        far[k] = "f"
    rows = [(5, " ".join(w)), (3, " ".join(near)), (4, " ".join(far))]
    got = {r.doc_id: r for r in jaccard_components(frame(spark, rows), 3, 90).collect()}
    shingled = {d: brute.shingles(t, 3) for d, t in rows}
    assert {d: r.n_shingles for d, r in got.items()} == {d: len(x) for d, x in shingled.items()}
    assert {d: r.component_id for d, r in got.items()} == {5: 3, 3: 3, 4: 4}


def test_one_leader_with_many_chunks(spark, monkeypatch):
    from shoprec.llm import jaccard

    monkeypatch.setattr(jaccard, "GROUP", 4)
    monkeypatch.setattr(jaccard, "COMMON", 3)
    rnd = random.Random(13)
    core = words_of(rnd, 30, 9000)
    rows = [(i, " ".join([*core, *words_of(rnd, rnd.randrange(0, 12), 9000)])) for i in range(120)]
    found = jaccard_components(frame(spark, rows).repartition(5), 3, 80).collect()
    assert sorted(map(tuple, found)) == sorted(brute.jaccard(rows, 3, 80))


def test_intermediate_tables_go_when_read(spark, tmp_path, monkeypatch):
    from shoprec.llm import common

    monkeypatch.setattr(common, "work_dir", lambda _, name: f"{tmp_path}/{name}-{random.random()}")
    found = jaccard_components(frame(spark, similar(3)), 3, 80)
    left = {p.name.split("-")[0] for p in tmp_path.iterdir()}
    assert left == {"nodes", "labels", "small"}  # the last are read by the result, and the components
    assert spark.conf.get(common.Scratch.TIDY) == "false"
    assert found.count() == len(similar(3))
