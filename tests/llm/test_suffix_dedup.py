import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmill.llm import suffix_dedup as S


def brute(texts):
    data, count = [(t or "").encode() for t in texts], Counter()
    for b in data:
        count.update(b[i : i + S.LENGTH] for i in range(len(b) - S.LENGTH + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - S.LENGTH + 1):
            if count[b[i : i + S.LENGTH]] > 1:
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    some = lambda n: "".join(r.choice("abcdefgh éü") for _ in range(n))
    base = [some(r.randint(380, 900)) for _ in range(4)]
    out = [some(399), "a" * 400, "a" * 401, "ab" * 300, "x" * 399, "x" * 399]
    for _ in range(15):
        b = r.choice(base)
        i = r.randint(0, max(0, len(b) - 380))
        out.append(some(r.randint(0, 300)) + b[i : i + r.randint(300, 700)] + some(r.randint(0, 300)))
    letters = list(base[0] + some(500))
    for _ in range(25):
        u = list(letters)
        for _ in range(r.randint(0, 3)):
            u[r.randrange(len(u))] = "Z"
        out.append("".join(u))
    d = some(450)
    return out + [out[10]] * 2 + [d + some(5) + d[20:] + d]


@pytest.mark.parametrize("seed,buckets", [(1, 1), (2, 5)])
def test_matches_brute_force(messy, texts, seed, buckets):
    docs = messy(texts + corpus(seed))
    rows = docs.select("doc_id", "text").collect()
    want = sorted((repr(r.doc_id), *e) for r, e in zip(rows, brute([r.text for r in rows]), strict=True))
    got = S.repeated(docs, buckets=buckets).collect()
    assert sorted((repr(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_passages_of_over_50_words_are_counted(spark):
    """Against all runs of words: 51 shared words are always noticed, fewer than 40 never."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(1, 5)))
    some = lambda n: [word() + str(r.randrange(10**6)) for _ in range(n)]
    shared = {n: some(n) for n in (39, 51, 52, 70)}
    rows = []
    for n, passage in shared.items():
        for k in range(3):
            rows.append((n, " ".join(some(r.randrange(60))) + " " + ("\t" if k else " ").join(passage) + "\n" + " ".join(some(r.randrange(60)))))
    twice = some(60)
    rows += [(0, " ".join(twice + some(5) + twice)), (0, " ".join(some(300))), (0, None), (0, ""), (60, "é " * 49 + "a b"), (60, "é " * 49 + "a b")]
    got = {}
    for x in S.repeated(spark.createDataFrame(list(enumerate(rows)), "doc_id long, r struct<n:int,text:string>").selectExpr("doc_id", "r.text AS text"), buckets=3).collect():
        got[x.id] = x.n_passages
    assert all((got[k] > 0) == (n >= 51) for k, (n, _) in enumerate(rows))


def test_empty(empty):
    assert S.repeated(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=120), st.integers(1, 40))
def test_suffix_order(letters, span):
    t = np.array(letters, np.int64)
    rank = S.suffix_ranks(t, span)
    key = [tuple(letters[i : i + span] + [0] * max(0, span - len(letters) + i)) for i in range(len(letters))]
    order = sorted(range(len(letters)), key=lambda i: rank[i])
    assert all(key[a] <= key[b] for a, b in zip(order, order[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=150), st.integers(1, 12))
def test_repeated_windows(letters, width):
    starts = np.arange(max(0, len(letters) - width + 1))
    count = Counter(tuple(letters[i : i + width]) for i in starts)
    assert S.repeated_windows(np.array(letters, np.int32), starts, width).tolist() == [count[tuple(letters[i : i + width])] > 1 for i in starts]


def contexts(n, seed):
    r = np.random.default_rng(seed)
    sides = []
    for _ in range(2):
        x = np.tile(r.integers(97, 99, S.SIDE).astype(np.uint8), (n, 1))
        for i in range(n):
            x[i, r.integers(0, S.SIDE, r.integers(0, 3))] = 122
        sides.append(x)
    a, b = r.integers(60, S.SIDE + 1, n), r.integers(60, S.SIDE + 1, n)
    for x, m in zip(sides, (a, b), strict=True):
        x[np.arange(S.SIDE)[None, :] >= m[:, None]] = 0
    return S.Contexts(g=r.integers(0, 3, n).astype(np.uint64), left=sides[0], right=sides[1], a=a, b=b, base=np.zeros(n, np.int64), full=r.random(n) < 0.1, key=np.arange(n), pos=np.full(n, 1000))


def covered(found):
    return {(int(k), p) for key, first, last in found for k, x, y in zip(key, first, last, strict=True) for p in range(int(x), int(y) + 1)}


@pytest.mark.parametrize("seed", range(4))
def test_groups_dealt_by_narrow_ranges_lose_nothing(monkeypatch, seed):
    c = contexts(200, seed)
    count = Counter()
    windows = {}
    for i in range(len(c)):
        for d in range(S.SIDE + 1):
            if d <= c.a[i] and S.SIDE - d <= c.b[i]:
                windows[i, 1000 - d] = (c.g[i], d, c.left[i, :d].tobytes(), c.right[i, : S.SIDE - d].tobytes())
                count[windows[i, 1000 - d]] += 1
    want = {k for k, w in windows.items() if count[w] > 1 and not c.full[k[0]]}
    assert covered(S.solve(c)) == want
    assert set().union(*(covered(S.solve(p)) for p in c.narrowed(S.NARROW))) == want
    monkeypatch.setattr(S, "LETTERS", 1500)
    assert covered(S.solve(c)) == want
