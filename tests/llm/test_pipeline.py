import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


def test_stages_in_order():
    assert [k for k, _ in pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]


@pytest.fixture
def folder(spark, tmp_path):
    rnd = random.Random(1)
    text = lambda n: " ".join(f"wort{rnd.randrange(99999)}" for _ in range(n))
    rows = [(i, text(80)) for i in range(120)]
    rows = [(i, t + (" vile" if i % 6 == 0 else "")) for i, t in rows]
    passage = text(60)
    rows += [(200, rows[1][1]), (201, rows[1][1] + " extra"), (202, text(30) + " " + passage), (203, passage + " " + text(30)),
             (204, text(50) + " " + rows[2][1][:0] + "frage " + text(0)), (None, "kein name"), (205, None), (206, "")]
    item = text(25)
    rows.append((207, text(40) + " " + item))
    docs = [(i, t, "de", "src", None if t is None else len(t)) for i, t in rows]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), docs, passage


def test_each_stage(spark, folder):
    path, docs, passage = folder
    table = spark.read.parquet(f"{path}/documents.parquet")
    stage = dict(pipeline.STAGES)
    clean = stage["toxicity"](spark, table, path)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert clean.columns == table.columns and ids(table) - ids(clean) == {i for i in range(120) if i % 6 == 0}
    one = stage["ngram_jaccard_join"](spark, table, path)
    found = brute.jaccard([(d[0], d[1]) for d in docs], 5, 80)
    assert one.columns == table.columns and ids(one) == {None, *[d for d, _, c in found if d == c]}
    assert {200, 201} & ids(one) == set()
    cut = stage["suffix_array_dedup"](spark, table, path)
    assert cut.schema == table.schema or cut.columns == table.columns
    rows = {r.doc_id: r for r in cut.collect()}
    plain = {r[0]: r for r in brute.repeats([(d[0], d[1]) for d in docs], 200)}
    assert {k: len(r.text.encode()) for k, r in rows.items()} == {k: r[1] - r[2] for k, r in plain.items()}
    assert passage[:200] not in rows[202].text and all(r.n_chars == len(r.text) for r in rows.values())
    free = stage["benchmark_decontamination"](spark, table, path)
    assert ids(table) - ids(free) == {207} and free.columns == table.columns


def test_null_and_repeated_ids_are_judged_by_row(spark, tmp_path):
    rnd = random.Random(2)
    text = lambda n: " ".join(f"wort{rnd.randrange(99999)}" for _ in range(n))
    item, a, b, c, d = text(25), text(40), text(40), text(40), text(40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(pipeline.STAGES)
    rows = [(None, a), (None, f"{b} {item}"), (7, c), (7, f"{d} {item}"), (8, f"{a} {item}"), (9, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    free = stage["benchmark_decontamination"](spark, table, str(tmp_path))
    assert {tuple(r) for r in free.collect()} == {(None, a), (7, c), (9, None)}
    # Copies under a null id and under another; different texts of one id, one of them near another id's.
    rows = [(None, a), (None, a), (None, b), (3, b + " more"), (5, c), (5, d), (2, d + " more"), (5, c), (6, c), (None, None), (None, ""), (None, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    one = [tuple(r) for r in stage["ngram_jaccard_join"](spark, table, str(tmp_path)).collect()]
    assert {r for r in one if r[1]} == {(None, a), (3, b + " more"), (5, c), (2, d + " more")}
    assert len([r for r in one if r[1]]) == 4 and len(one) == 7


def test_run(spark, folder):
    path, docs, _ = folder
    pieces = pipeline.run(spark, path).collect()
    ids = {r.doc_id for r in pieces}
    assert not ids & {0, 6, 200, 201, 207} and {1, 7, 202, 203, 205, None} <= ids
    used = {}
    for r in pieces:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 1024


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_run_on_the_test_tables(spark):
    pieces = pipeline.run(spark, str(DATA))
    assert pieces.count() > 0


CLASHING = ("doc_id long, text string, lang string, source string, n_chars long, __key long, __group string, s string, "
            "name int, kept string, carried string, p_toxic double, token long, a string, b string")
EXTRA = (5, "g", "s", 1, "k", "c", 0.5, 9, "a", "b")


def judged(spark, path, rows):
    """Each stage over rows with columns named as the stages and operators name their own."""
    table = spark.createDataFrame([(i, t, "de", "src", len(t or ""), *EXTRA) for i, t in rows], CLASHING)
    out = {}
    for name, stage in pipeline.STAGES:
        got = stage(spark, table, path)
        out[name] = got
        if name != "best_fit_packing":
            assert got.columns == table.columns, name
            assert all(tuple(r)[5:] == EXTRA for r in got.collect()), name
    return out


def test_stages_with_clashing_columns_and_long_texts(spark, folder):
    path, _, _ = folder
    rnd = random.Random(9)
    long = " ".join(f"wort{rnd.randrange(10**6)}" for _ in range(160_000))
    assert len(long) > 1 << 20
    rows = [(i, " ".join(f"wort{rnd.randrange(99999)}" for _ in range(60))) for i in range(10)]
    rows += [(50, long), (51, long + " more"), (None, None), (None, ""), (None, None), (7, rows[7][1])]
    got = judged(spark, path, rows)
    texts = lambda name: sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got[name].collect()))
    every = sorted((i is None, i or 0, t or "") for i, t in rows)
    assert texts("toxicity") == every and texts("benchmark_decontamination") == every
    assert texts("ngram_jaccard_join") == sorted((i is None, i or 0, t or "") for i, t in rows[:11] + rows[12:15])
    plain = {i: max(len(t) - 200, 0) for i, t in rows if i is not None and i < 50}
    cut = {r.doc_id: len(r.text) for r in got["suffix_array_dedup"].collect() if r.doc_id is not None}
    assert cut[50] == 0 and cut[51] <= 199 and cut[7] == 0 and all(cut[i] >= plain[i] for i in plain if i != 7)
    pieces = got["best_fit_packing"].collect()
    assert sum(r.doc_id == 50 for r in pieces) > 100 and sum(r.doc_id is None for r in pieces) == 3


def test_stages_of_no_documents(spark, folder):
    path, _, _ = folder
    assert all(df.count() == 0 for df in judged(spark, path, []).values())


def test_of_equal_rows_the_first_by_its_other_columns_stays(spark, folder):
    path, _, _ = folder
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, lang, "x") for lang in ("fr", "de", "en") for _ in range(40)] + [(2, text, "aa", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7)
    one = dict(pipeline.STAGES)["ngram_jaccard_join"](spark, table, path)
    assert [tuple(r) for r in one.collect()] == [(1, text, "de", "x")]
