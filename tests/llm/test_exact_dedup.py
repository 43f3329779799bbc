from collections import defaultdict

import pytest

from quillmill.llm import exact_dedup as X

UP, LOW = X._UPPER, X._LOWER


def norm(t):
    return (t or "").translate(str.maketrans(UP, LOW))


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_groups_match_brute_force(messy, texts, keep, partitions):
    many = texts + ["hot copy of a text"] * 40 + ["HOT copy of a text"] * 20 + ["straße", "STRASSE", "ÄB", "äb", "Äb"]
    docs = messy(many)
    by = defaultdict(list)
    for r in docs.collect():
        by[norm(r.text)].append(r.doc_id)
    got = X.groups(docs, keep=keep, partitions=partitions).collect()
    assert len(got) == docs.count()
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(by)
    pick = min if keep == "min" else max
    import hashlib

    for text, ids in by.items():
        rows = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        real = [i for i in ids if i is not None]
        assert {r.group_size for r in rows} == {len(ids)} and {r.keep_id for r in rows} == {pick(real) if real else None}


def test_keep_one_returns_the_rows_as_they_were(messy, texts):
    docs = messy(texts * 5)
    kept = X.keep_one(docs, partitions=5)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = kept.collect()
    assert len({norm(r.text) for r in rows}) == len(rows) == len({norm(r.text) for r in docs.collect()})
    assert all(r["a.b"] == "y" for r in rows if r.doc_id is not None)


def test_empty(empty):
    assert X.groups(empty).count() == 0 and X.keep_one(empty).count() == 0


def test_bad_end(empty):
    with pytest.raises(ValueError):
        X.groups(empty, keep="first")


def _batches(rows, names):
    import pyarrow as pa

    kinds = {"id": pa.int64(), "text": pa.string(), "h": pa.int64(), "part": pa.int32()}
    for k in range(0, len(rows), 3):
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(zip(*rows[k : k + 3], strict=True), names, strict=True)], names=names)


def test_texts_that_share_a_hash_are_told_apart():
    """Sorted partitions as the hash would give them if it were the same for different texts."""
    rows = [(1, "a", 5, 0), (2, "a", 5, 0), (3, "b", 5, 0), (4, "c", 7, 0), (4, "c", 7, 0), (9, "d", 8, 0), (1, "x", 9, 0), (2, "y", 9, 0), (None, "y", 9, 0)]
    got = [r for b in X._runs(_batches(rows, ["id", "text", "h", "part"])) for r in b.to_pylist()]
    assert [(r["id"], r["keep_id"], r["n"], r["kept"]) for r in got] == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 2, True), (4, 4, 2, False), (9, 9, 1, True), (1, 1, 1, True), (2, 2, 2, True), (None, 2, 2, False)]
    assert [r["text"] for r in got] == [b"a", None, b"b", None, None, None, b"x", b"y", None]
    firsts = [r for b in X._firsts(_batches(rows, ["id", "text", "h", "part"])) for r in b.to_pylist()]
    assert [(r["id"], r["__run"], r["__open"]) for r in firsts] == [(1, 0, True), (3, 1, True), (4, 2, False), (9, 3, False), (1, 4, True), (2, 5, True)]
