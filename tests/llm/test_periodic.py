import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from shoprec.llm.periodic import periodic_runs, run_digests  # noqa: E402
from shoprec.llm.queries import looped  # noqa: E402
from shoprec.llm.suffix_tree import SuffixTree, next_smaller, runs  # noqa: E402


def plain_runs(w, least=2):
    """Maximal stretches with a smallest period, found by trying all periods."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - a
            shorter = any(all(w[k] == w[k + p] for k in range(a, a + n - p)) for p in range(1, q))
            if n >= max(least, 2 * q) and not shorter:
                out.append((a, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, rewrite=None):
    w = brute.WORD.findall(text or "")
    n = len(w)
    if rewrite:
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    spans = plain_runs(w, 12)
    gone = {i for a, length, q in spans for i in range(a + q, a + length)}
    return n, spans, " ".join(x for i, x in enumerate(w) if i not in gone)


def symbols(rnd, n):
    k = rnd.choice([1, 2, 2, 3, 8])
    w = [rnd.randrange(1, k + 1) for _ in range(n)]
    if n > 3 and rnd.random() < 0.4:
        p = rnd.randrange(1, n)
        w = [w[i % p] for i in range(n)]
    return w


def test_trees_extensions_and_orders():
    rnd = random.Random(1)
    for _ in range(150):
        w = symbols(rnd, rnd.randrange(1, 40))
        n = len(w)
        tree = SuffixTree(w)
        assert sorted(x for x in tree.suffix.tolist() if x >= 0) == list(range(n + 1))
        ahead = tree.euler()
        closed = [*w, 0]
        assert ahead.leaves.tolist() == sorted(range(n + 1), key=lambda i: closed[i:])
        turned = [*[1000 - x for x in w], 0]
        falling = tree.falling()
        assert falling.tolist() == sorted(range(n + 1), key=lambda i: turned[i:])
        ends = next_smaller(falling)
        for i in range(n):
            assert ends[i] == next(j for j in range(i + 1, n + 1) if turned[j:] < turned[i:])
            for j in range(i + 1, n + 1):
                same = next((k for k in range(n + 1 - j) if closed[i + k] != closed[j + k]), n + 1 - j)
                import numpy as np

                assert ahead.between(np.array([i]), np.array([j]))[0] == same


def test_runs_of_symbols():
    rnd = random.Random(2)
    for _ in range(1500):
        w = symbols(rnd, rnd.randrange(0, 70))
        assert runs(w) == plain_runs(w)
        assert runs(w, 12) == plain_runs(w, 12)


def test_long_stretches_use_packed_lists(monkeypatch):
    from shoprec.llm import suffix_tree

    rnd = random.Random(3)
    cases = [symbols(rnd, 60) for _ in range(100)]
    before = [runs(w) for w in cases]
    monkeypatch.setattr(suffix_tree, "LONG", 10)
    assert [runs(w) for w in cases] == before
    assert runs([1] * 5000) == [(0, 5000, 1)]


def texts(rnd):
    lexicon = [f"w{k}" for k in range(12)] + ["été", "ß", "中文"]
    rows = []
    for i in range(250):
        w = [rnd.choice(lexicon) for _ in range(rnd.randrange(0, 90))]
        for _ in range(rnd.randrange(0, 3)):
            at, p, m = rnd.randrange(len(w) + 1), rnd.randrange(1, 9), rnd.randrange(2, 30)
            unit = [rnd.choice(lexicon) for _ in range(p)]
            w[at:at] = [unit[k % p] for k in range(m)]
        rows.append((i, "".join(x + rnd.choice([" ", " ", "\n", " \t", "\x0b"]) for x in w)))
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "  lead and trail  "), (None, "a " * 30), (None, None),
             (5, rows[5][1]), (5, rows[5][1]), (1004, "x y " * 20), (1005, "A a " * 9)]
    return rows


KIND = "doc_id long, text string, start int, length string, runs long, period double"


@pytest.mark.parametrize("rewrite", [None, looped])
def test_documents_against_all_periods(spark, rewrite):
    rows = texts(random.Random(4))
    frame = spark.createDataFrame([(*r, 1, "l", 2, 0.5) for r in rows], KIND).repartition(3)
    got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in periodic_runs(frame, 12, rewrite).collect()]
    wanted = [(d, *expected(d, t, rewrite)) for d, t in rows]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert sum(len(r[2]) for r in got) > 50
    digests = []
    for d, _, spans, text in wanted:
        best = min(spans, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in spans)
        digests.append((d, len(spans), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in run_digests(frame, 12, rewrite).collect()]
    assert sorted(got, key=str) == sorted(digests, key=str)


def test_long_texts(spark):
    rnd = random.Random(6)
    lines = [" ".join(f"v{rnd.randrange(10**6)}" for _ in range(20)) for _ in range(9000)]
    plain = "\n".join(lines)  # over 1 MiB without a run
    block = " ".join(f"u{k}" for k in range(3000))
    rows = [(1, plain), (2, plain + "\n" + (block + " ") * 30), (3, "same " * 250_000)]
    got = {r[0]: r for r in run_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][1:6] == (0, None, None, None, None)
    assert got[2][1:6] == (1, 180_000, 90_000, 3000, 30_000)
    assert got[3][1:6] == (1, 0, 250_000, 1, 250_000_000)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1][7] == sha(plain.replace("\n", " ")) and got[3][7] == sha("same")
    assert got[2][7] == sha(plain.replace("\n", " ") + " " + block)


def test_no_rows_and_bad_minimum(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert run_digests(none).count() == 0 and periodic_runs(none).count() == 0
    with pytest.raises(ValueError):
        run_digests(none, minimum=1)
