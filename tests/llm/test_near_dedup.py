import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quillmill.llm import near_dedup as N


def shingles(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d is None, d or 0, len(sets[i]), -1 if d is None else least[find(i)]) for i, (d, _) in enumerate(rows))


def edited(r, words, n):
    w = list(words)
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("size,percent,block", [(3, 85, 512), (5, 80, 512), (3, 85, 8)])
def test_matches_brute_force(messy, texts, monkeypatch, size, percent, block):
    monkeypatch.setattr(N, "BLOCK", block)
    r = random.Random(5)
    base = [f"w{r.randrange(400)}" for _ in range(120)]
    other = [f"v{r.randrange(400)}" for _ in range(90)]
    many = texts + [edited(r, base, r.randrange(12)) for _ in range(40)] + [edited(r, other, r.randrange(4)) for _ in range(10)] + [" ".join(base)] * 6 + ["one", "ONE", "two words"]
    docs = messy(many)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    got = N.near_duplicates(docs, size=size, percent=percent, matches=N.MATCHES if percent == 85 else None).collect()
    assert sorted((x.id is None, x.id or 0, x.n_shingles, -1 if x.component_id is None else x.component_id) for x in got) == brute(rows, size, percent)
    assert all(x.kept == (x.id is None or x.id == x.component_id) for x in got)


def test_stage_keeps_one_of_each_and_all_columns(messy, texts):
    docs = messy([*texts, texts[6] + " more"])
    kept = N.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 6 in ids and 10 not in ids and 11 not in ids and 2 in ids and None in ids


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    b = " ".join(f"word{k}" for k in range(60))
    rows = [(1, b + " more"), (5, "quite another text that nothing else is like at all"), (5, b), (7, None), (7, b)]
    kept = N.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((d, t or "") for d, t in [rows[0], rows[1], rows[3]])


def test_chains_and_templates_match_brute_force(spark, monkeypatch):
    """A chain in which only neighbours are linked, and many texts that are close but not close enough: no hub connects either."""
    monkeypatch.setattr(N, "BLOCK", 16)
    r = random.Random(9)
    chain = [f"c{k}" for k in range(400)]
    rows = [" ".join(chain[4 * k : 4 * k + 100]) for k in range(60)]
    template = [f"t{k}" for k in range(100)]
    rows += [edited(r, template, 5) for _ in range(40)]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size=3, percent=85, matches=30).collect()
    assert sorted((False, x.id, x.n_shingles, x.component_id) for x in got) == brute(rows, 3, 85)


def test_empty(empty):
    assert N.near_duplicates(empty).count() == 0 and N.keep_one_of_each(empty).count() == 0


def test_shingle_hashes_follow_order_and_case():
    h = lambda t: list(next(N.sets(pa.array([t]), 3)))
    assert h("a b c") == h("A\tB\n c") and h("a b c") != h("a c b") and h("a b") != h("a b b") and h("") == h(None) == []
    assert h("É b c") != h("é b c") and len(h("a b c a b c a")) == 3


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 2000).astype(np.uint64))
    b = np.concatenate([a[:1700], r.integers(0, 2**63, 300).astype(np.uint64)])
    assert 0.5 < (N.signature(a) == N.signature(b)).mean() < 0.95
