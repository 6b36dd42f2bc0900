import base64
import hashlib
import random
import struct
import sys
import time
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shoprec.llm.decontamination import contamination, mark_tiles  # noqa: E402
from shoprec.llm.packing import Capacity, best_fit, lower_bound, pack, slots  # noqa: E402
from shoprec.llm.sharding import cuts, shard_documents  # noqa: E402
from shoprec.llm.warc import archive_pages, histories, members, read_archives, url_key  # noqa: E402

CLASHING = "doc_id long, text string, length long, rank int, size string, atom string, part string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, 4, "s", "a", "p", "w") for r in rows], CLASHING)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_bins_keep_every_capacity(score):
    rnd = random.Random(1)
    counts = {rnd.randrange(1, 65): rnd.randrange(1, 200) for _ in range(50)}
    capacity = Capacity(64, 5, 64 * 64, score=score)
    bins = best_fit(counts, capacity)
    used = dict.fromkeys(counts, 0)
    for number, lengths in bins:
        assert sum(lengths) <= 64 and len(lengths) <= 5 and sum(x * x for x in lengths) <= 64 * 64
        for x in lengths:
            used[x] += number
    assert used == counts
    places = slots(bins)
    assert all([r[0] for r in v] == sorted(r[0] for r in v) for v in places.values())
    loose = best_fit(counts, Capacity(64, 64, 64 * 64))
    room: list[int] = []  # best fit over single pieces
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        at = min(fits, key=room.__getitem__) if fits else len(room)
        room[at:at + 1] = [(room[at] if fits else 64) - length]
    assert lower_bound(counts, 64) <= sum(n for n, _ in loose) <= 1.01 * len(room)
    assert best_fit({}, capacity) == []
    with pytest.raises(ValueError):
        Capacity(64, 5, 10)


def single_pieces(counts, capacity):
    """Contents of the bins when each piece is placed for itself."""
    limits = (capacity.tokens, capacity.documents, capacity.attention)
    shares = [w / m for w, m in zip(capacity.weights, limits, strict=True)]
    bins = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        need = (length, 1, length * length)

        def score(left, need=need):
            if capacity.score == "dot":
                return -sum(s * s * a * n for s, a, n in zip(shares, left, need, strict=True))
            return sum((s * (a - n)) ** 2 for s, a, n in zip(shares, left, need, strict=True))

        fits = [b for b in bins if all(a >= n for a, n in zip(b[0], need, strict=True))]
        at = min(fits, key=lambda b: (score(b[0]), b[0][0]), default=None)
        if at is None:
            bins.append(at := [limits, []])
        at[0] = tuple(a - n for a, n in zip(at[0], need, strict=True))
        at[1].append(length)
    return [lengths for _, lengths in bins]


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("documents", [1024, 6])
def test_equal_pieces_are_placed_as_one_by_one(score, documents):
    capacity = Capacity(documents=documents, score=score)
    assert sum(n for n, _ in best_fit({300: 10}, capacity)) == 4
    rnd = random.Random(3)
    hot, short, spread = {300: 400}, {200: 500}, {}
    for lengths, low, high in ((hot, 400, 1024), (short, 150, 400), (spread, 1, 1024)):
        for _ in range(500):
            x = rnd.randrange(low, high + 1)
            lengths[x] = lengths.get(x, 0) + 1
    for counts in (hot, short, spread, {7: 1000}, {1: 3000, 2: 5}):
        mine = [lengths for n, lengths in best_fit(counts, capacity) for _ in range(n)]
        assert sorted(mine) == sorted(single_pieces(counts, capacity))


def test_packing_against_the_tokenizer(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["tree", "Haus", "été", "x1", "don't", "<|endoftext|>", "a\n\nb"]) for _ in range(rnd.randrange(1, 90)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "  two  spaces \n and\t tab "), (63, " lead"), (64, "trail "), (65, "word " * 700),
             (5, rows[5][1]), (None, "id  less"), (66, "x" * 2000)]
    got = pack(frame(spark, rows), path, Capacity(128, 128, 128 * 128)).collect()
    expected = []
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 128 or 128
        for k, start in enumerate([0, *range(first, len(ids), 128)]):
            own = ids[start : start + (first if k == 0 else 128)]
            expected.append((doc_id, k, start, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected, key=key)
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 128
    assert pack(frame(spark, []), path).count() == 0


def test_smallest_capacity_and_cuts(spark):
    rnd = random.Random(4)
    for shards in (1, 3, 7):
        sizes = [rnd.choice([1, 5, 9, 60]) for _ in range(30)]
        table = spark.createDataFrame(list(enumerate(sizes)), "atom int, bytes long")
        capacity, last = cuts(table, shards)
        assert capacity == brute.smallest_capacity(sizes, shards)
        edges = [0, *[x + 1 for x in last], len(sizes)]
        assert len(last) < shards and all(sum(sizes[a:b]) <= capacity for a, b in zip(edges, edges[1:], strict=False))
    assert cuts(spark.createDataFrame([], "atom int, bytes long"), 4) == (0, [])


@pytest.mark.parametrize("at", [0, 13, 27])
def test_other_shards_are_near_equal_beside_a_large_group(spark, at):
    rnd = random.Random(6)
    sizes = [rnd.randrange(5, 15) for _ in range(400)]
    sizes[10 * at : 10 * at] = [sum(sizes) // 2]  # a third of all bytes
    capacity, last = cuts(spark.createDataFrame(list(enumerate(sizes)), "atom int, bytes long"), 16)
    edges = [0, *[x + 1 for x in last], len(sizes)]
    runs = [sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    assert len(runs) == 16 and max(runs) == capacity == max(sizes)
    others = sorted(runs)[:-1]
    assert others[-1] <= 1.2 * sum(others) / 15 and others[0] >= 0.8 * sum(others) / 15


def test_no_shard_is_empty_while_there_are_items(spark):
    for sizes, shards in (([1] * 100, 16), ([50, 1, 1, 60, 1, 60], 4), ([9, 9, 9], 5), ([100, 30, 1, 1, 1, 1, 30], 6)):
        capacity, last = cuts(spark.createDataFrame(list(enumerate(sizes)), "atom int, bytes long"), shards)
        edges = [0, *[x + 1 for x in last], len(sizes)]
        runs = [sum(sizes[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        assert len(runs) == min(shards, len(sizes)) and all(runs)
        assert capacity == brute.smallest_capacity(sizes, shards) == max(runs)


def test_shards(spark):
    rnd = random.Random(5)
    rows = [(i, "t" * rnd.randrange(200) + str(i % 90)) for i in range(300)]
    rows += [(300, None), (301, ""), (None, "é"), (4, rows[4][1]), (302, "long" * 3000)] + [(400 + i, "copy") for i in range(60)]
    got = shard_documents(frame(spark, rows), shards=4, part=8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((size(t), zlib.crc32((t or "").encode())) for _, t in rows)
    assert len({(r.text_crc32, r.shard) for r in got}) == len({r.text_crc32 for r in got})
    for s in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == s)
        assert 0 <= s < 4 and own == list(range(len(own)))
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)
    assert shard_documents(frame(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, sha string, size int, keeper string, run int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "k", 2) for r in rows], PAGES)


def test_archives_round_trip(spark):
    rows = [(i, f"http://Example.com/{i % 3}?q={i}", ["same", "other\r\n\r\nWARC/1.1", "é" * 50, None, ""][i % 5]) for i in range(40)]
    rows += [(40, None, "no url"), (41, "bad url\r\nX: y", "ctl"), (42, "http://[oops", "x" * 300_000), (7, rows[7][1], rows[7][2]), (None, "http://n/", "nobody")]
    files = archive_pages(pages(spark, rows), file_bytes=2000)
    got = histories(read_archives(files)).collect()
    assert files.agg(F.sum("records")).first()[0] == len(rows) == len(got)
    keeper = {}
    for page, _, html in rows:
        if page is not None:
            keeper[html or ""] = max(keeper.get(html or "", -1), page)
    expected = []
    for page, _, html in rows:
        raw, kept = (html or "").encode(), keeper.get(html or "")
        revisit = kept is not None and page != kept
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected.append((-1 if page is None else page, len(raw), digest, "revisit" if revisit else "response", kept if revisit else -1))
    mine = [(-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in got]
    assert sorted(mine) == sorted(expected)
    order = [(r.url_key, r.time) for r in got]
    assert order == sorted(order)
    with open(files.first()["path"].removeprefix("file://"), "rb") as f:
        raw = list(members(f, block=100))
    assert raw and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for _, r in raw)
    assert all(b"\r\nX: y" not in r for _, r in raw)


def test_smallest_payload_and_no_pages(spark):
    rows = [(1, "http://a/", "ab"), (2, "http://a/", "ab"), (3, "http://b/", "abcd"), (4, "http://b/", "abcd")]
    got = {r.page_id: r.record_type for r in histories(read_archives(archive_pages(pages(spark, rows), least=3))).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert histories(read_archives(archive_pages(pages(spark, [])))).count() == 0
    assert url_key("http://www.Example.org:81/a?b") == "org,example,www:81)/a?b" and url_key(None) == ""


def test_tiles():
    assert mark_tiles([9, 1, 2, 3, 4, 5, 9], [1, 2, 3, 4, 5], 5) == (5, 1)
    item = list(range(1, 13))
    assert mark_tiles([*item[6:], 0, *item[:6]], item, 5) == (12, 2)  # in the other order
    assert mark_tiles([*item[:6], 0, *item[:6]], item, 5) == (6, 1)  # each word of the item once
    assert mark_tiles(item[:4], item, 5) == (0, 0)
    assert mark_tiles([7, 8, 7, 8], [7, 8, 7, 8, 7, 8], 2) == (4, 1)
    assert mark_tiles([], item, 5) == (0, 0) and mark_tiles([5], [5], 5) == (1, 1)


def test_tiles_equal_plain_greedy_tiling():
    rnd = random.Random(8)
    for _ in range(400):
        kinds = rnd.choice([1, 2, 3, 6])
        text = [rnd.randrange(1, kinds + 1) for _ in range(rnd.randrange(0, 40))]
        item = [rnd.randrange(1, kinds + 1) for _ in range(rnd.randrange(0, 16))]
        shortest = rnd.choice([1, 2, 5])
        assert mark_tiles(text, item, shortest) == brute.tiles(text, item, shortest), (text, item, shortest)


def test_tiles_of_a_long_repetitive_text():
    begun = time.monotonic()
    assert mark_tiles([7] * 100_000, [7] * 60, 5) == (60, 1)
    assert mark_tiles([7, 8] * 50_000, [*[7] * 30, *[7, 8] * 15], 5) == (30, 1)
    assert time.monotonic() - begun < 4


def test_contamination_of_rows_without_ids_and_with_one_id(spark):
    rnd = random.Random(3)
    items = [(i, " ".join(f"b{i}w{rnd.randrange(40)}" for _ in range(12))) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    clean = [(None, f"clean words {i} here and there") for i in range(500)]
    rows = [*clean, *[(None, f"text {i % 700} {items[i % 20][1]}") for i in range(1000)], *[(5, f"text {i} {items[3][1]}") for i in range(500)]]
    got = contamination(frame(spark, rows), bench).collect()
    want = {(None, i) for i in range(20)} | {(5, 3)}
    assert sorted((str(r.doc_id), r.item_id) for r in got) == sorted((str(d), i) for d, i in want)
    assert all(r.matched_words == 12 and r.tiles == 1 for r in got)


def test_contamination_equals_plain_tiling(spark):
    rnd = random.Random(12)
    prose = lambda n: [f"w{rnd.randrange(30)}" for _ in range(n)]
    items = [(i, prose(rnd.choice([1, 3, 8, 20, 60]))) for i in range(40)]
    docs = []
    for i in range(120):
        own = prose(rnd.choice([0, 4, 30, 200]))
        for _ in range(rnd.randrange(3)):
            part = rnd.choice(items)[1]
            cut = rnd.randrange(len(part))
            own += [*part[cut:], *prose(2), *part[:cut]]
        docs.append((i, own))
    want = set()
    for d, text in docs:
        for i, item in items:
            marked, count = brute.tiles(text, item, 5)
            if count and marked >= 0.5 * len(item):
                want.add((d, i, len(item), marked, count))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id int, text string")
    found = contamination(frame(spark, [(d, " ".join(w)) for d, w in docs]), bench).collect()
    assert {(r.doc_id, r.item_id, r.item_words, r.matched_words, r.tiles) for r in found} == want and want


def test_contamination(spark):
    rnd = random.Random(9)
    text = lambda n, tag="w": " ".join(f"{tag}{rnd.randrange(9999)}" for _ in range(n))
    items = [(i, text(30, "q")) for i in range(10)] + [(10, "two words"), (11, None), (12, ""), (3, None)]
    q = [t.split() for _, t in items[:10]]
    docs = [(i, text(200)) for i in range(50)]
    docs += [
        (100, f"{text(40)} {items[0][1].upper()} {text(10)}"),
        (101, " ".join([text(5), *q[1][15:], text(9), *q[1][:15]])),  # reordered
        (102, " ".join([text(5), *q[2][:12], text(9)])),  # less than half
        (103, " ".join([*q[3][:10], text(3), *q[3][12:22], *q[4]])),
        (104, "so two WORDS meet"), (105, None), (106, ""), (None, items[5][1]), (100, docs[1][1]), (107, items[6][1] + " " + text(20_000)),
    ]
    bench = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, seed string, size int")
    got = {(r.doc_id, r.item_id) for r in contamination(frame(spark, docs), bench).collect()}
    assert got == {(100, 0), (101, 1), (103, 3), (103, 4), (104, 10), (None, 5), (107, 6)}
    assert contamination(frame(spark, []), bench).count() == 0
    assert contamination(frame(spark, docs), bench.limit(0)).count() == 0
