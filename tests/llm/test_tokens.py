import glob
import random
import struct
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shoprec.llm import token_ids
from shoprec.llm.token_files import (
    Layout, documents_between, places, token_summary, tokens_between, write_tokens,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a \n b", "\n", "\nx y", " lead", "trail ", "a  b", "a 　b", "don't  x's",
       "<|endoftext|> x", "a\x85 b", "x\x1c y", "é è", "a  b c", "’s ’", "a '' b", "tab\tand\tline\nend", "x" * 3000,
       "a b c d", "b c", "a b c d"]


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(PATH)
    coder.encode_special_tokens = True
    return lambda text: [*coder.encode(text or "", add_special_tokens=False).ids, 2]


def summary(rows, ids_of):
    at, out = 0, []
    for doc_id, text in rows:
        own = ids_of(text)
        out.append((doc_id, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
        at += len(own)
    return out


@pytest.mark.parametrize("way", ["words", "words by the library", "whole texts"])
def test_ids_by_words_are_those_of_whole_texts(ids_of, way, monkeypatch):
    monkeypatch.setattr(token_ids, "WORDS", 5)  # forgets between calls
    coder = token_ids.Encoder(PATH)
    if way != "words":
        coder.quick = None
    coder.by_words = way != "whole texts"
    for texts in (ODD, ODD[::-1], [], ["one"], [f"w{k} word" for k in range(9)], ["w3 w4 word"]):
        ids, edges = coder.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_hold_all_ids_in_order(spark, ids_of, encoding, tmp_path):
    rnd = random.Random(1)
    rows = [(k, t) for k, t in enumerate(ODD)]
    rows += [(1000 - k, " ".join(rnd.choice(["tree", "Haus", "été", "x1"]) for _ in range(rnd.randrange(1, 400)))) for k in range(300)]
    rows += [(5000, "very long " * 400_000), (6000, None)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, 2, "f", 7) for r in rows],
                                  "doc_id long, text string, hash long, place int, ids string, n_tokens int")
    layout = Layout(ids=encoding, file_bytes=1 << 18, group_bytes=1 << 16, page_rows=16)
    path = write_tokens(frame.repartition(5), PATH, str(tmp_path / "tokens"), layout)
    expected = summary(sorted(rows), ids_of)
    assert sorted(tuple(r) for r in token_summary(spark, path).collect()) == expected
    assert sorted(tuple(r) for r in places(spark, path).collect()) == [r[:3] for r in expected]
    files = sorted(glob.glob(f"{path}/*.parquet"))
    assert len(files) > 3
    order = [i for f in files for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    assert order == sorted(order)
    metas = [pq.ParquetFile(f).metadata for f in files]
    meta = next(m for m in metas if m.num_row_groups and m.num_rows > 10)
    columns = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.num_columns)}
    assert all(c.has_offset_index for c in columns.values())
    assert all(columns[c].has_column_index and "DELTA_BINARY_PACKED" in columns[c].encodings for c in ("doc_id", "n_tokens", "before"))
    ids = columns["ids.list.element"].encodings
    assert ("RLE_DICTIONARY" in ids) == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in ids) == (encoding == "delta")
    every = [i for _, t in sorted(rows) for i in ids_of(t)]
    for a, b in ((0, 1), (37, 38), (500, 9000), (len(every) - 10, len(every) + 5), (len(every), len(every) + 1)):
        got = sorted(tokens_between(spark, path, a, b).collect(), key=lambda r: r["start"])
        assert [i for r in got for i in r["ids"]] == every[a:b]
        assert all(every[r["start"] : r["start"] + len(r["ids"])] == r["ids"] for r in got)
    some = documents_between(spark, path, 800, 810)
    assert {r["doc_id"]: r["ids"] for r in some.collect()} == {d: ids_of(t) for d, t in rows if 800 <= d <= 810}
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,800)" in plan
    assert "ids:array" not in places(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_small_row_groups(spark, tmp_path):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a text of number "), F.col("id")).alias("text"))
    layout = Layout(group_bytes=1 << 14, page_rows=32)
    path = write_tokens(frame, PATH, str(tmp_path / "tokens"), layout)
    metas = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")]
    assert sum(m.num_rows for m in metas) == 3000 and max(m.num_row_groups for m in metas) > 1


def test_repeated_null_and_no_rows(spark, ids_of):
    rows = [(None, "a"), (None, None), (None, "a"), (3, "x y"), (3, "x y"), (3, "b"), (1, "")] + [(7, "same text")] * 500
    got = token_summary(spark, write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    got = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == [None] * 3 + [1, 3, 3, 3] + [7] * 500
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crc = lambda t: zlib.crc32(struct.pack(f"<{len(ids_of(t))}I", *ids_of(t)))
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r["doc_id"], r["ids_crc32"]) for r in got), key=key) == sorted(((d, crc(t)) for d, t in rows), key=key)
    empty = write_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert token_summary(spark, empty).count() == 0 and tokens_between(spark, empty, 0, 9).count() == 0
    with pytest.raises(ValueError):
        Layout(ids="plain")
