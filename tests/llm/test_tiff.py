import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmill.llm import tiff as T


@settings(max_examples=120, deadline=None)
@given(st.binary(max_size=3000), st.sampled_from([T.NONE, T.LZW, T.DEFLATE, T.PACKBITS]), st.sampled_from([1, 2]), st.sampled_from([0, 16, 48]), st.sampled_from("<>"), st.integers(1, 9))
def test_round_trip(data, compression, predictor, tile, order, rows):
    how = T.Layout(compression, predictor, 6, rows, 4, tile)
    payload = T.pad(data)
    media = T.write_pages(T.payload_pages(payload, how), how, order)
    read = list(T.read_pages(media))
    assert b"".join(p.pixels.tobytes() for p in read) == payload and len(read) == -(-len(payload) // (192 * rows))
    assert {(p.compression, p.predictor) for p in read} == {(compression, predictor)}


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=2000), st.integers(0, 3))
def test_codecs(data, shrink):
    data = bytes(b & (255 >> shrink * 2) for b in data) * 3
    assert T.unpack_bits(T.pack_bits(data), len(data)) == data and T.unlzw(T.lzw(data), len(data)) == data


def test_lzw_passes_the_table_limit():
    data = np.random.default_rng(1).integers(0, 256, 60_000).astype(np.uint8).tobytes()
    assert T.unlzw(T.lzw(data), len(data)) == data


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 400), st.integers(0, 255))
def test_broken_bytes_raise_one_error(junk, at, value):
    good = bytearray(T.write_pages(T.payload_pages(T.pad(b"abc" * 100), T.Layout()), T.Layout()))
    good[at % len(good)] = value
    for data in (bytes(good), bytes(good[: at % len(good)]), b"II*\0" + junk, junk):
        try:
            list(T.read_pages(data))
        except T.TiffError:
            pass


def test_pages_of_a_table(spark, messy):
    how = T.Layout(rows_per_page=2)
    media = T.write_pages(T.payload_pages(T.pad(b"a" * 1000), how), how)
    loop = bytearray(media)
    (first,) = struct.unpack_from("<I", media, 4)
    n = struct.unpack_from("<H", media, first)[0]
    struct.pack_into("<I", loop, first + 2 + 12 * n, first)
    rows = [(1, bytearray(media), "k", 5), (1, bytearray(media), "k", 5), (None, None, None, None), (2, bytearray(), "x", 1), (3, bytearray(b"II*\0junkjunk"), "y", 2), (4, loop, "z", 3)]
    df = spark.createDataFrame(rows, "id int, media binary, `a.b` string, width int")
    out = T.pages(df, "media")
    assert out.columns == ["id", "a.b", *"page width height samples compression predictor pixels feature error".split()]
    got = out.collect()
    assert sorted(r.page for r in got if r.id == 1) == [0, 0, 1, 1, 2, 2]
    assert b"".join(bytes(r.pixels) for r in got if r.id == 1)[:192] == b"a" * 192
    assert {r.id: r.error for r in got if r.id != 1 and r.page is None} == {None: "empty", 2: "empty", 3: "a directory is cut off", 4: "the directories form a loop"}
    assert T.pages(df.limit(0), "media").count() == 0


def test_stored_texts_and_query(spark, messy, texts, tiny, tmp_path):
    docs = messy(texts)
    got = T.store(docs, "text", carry=["doc_id", "text", "a.b"]).collect()
    assert len(got) == docs.count()
    for r in got:
        data = (r.text or "").encode()
        assert r.n_bytes == len(data) and b"".join(p.pixels.tobytes() for p in T.read_pages(bytes(r.media))) == T.pad(data) and r.payload_bytes % 192 == 0 < r.payload_bytes
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {(r.doc_id, r.n_bytes): r for r in T.op5_tiff(spark, str(tmp_path)).collect()}
    for r in docs.collect():
        payload = T.pad((r.text or "").encode())
        q = rows[r.doc_id, len((r.text or "").encode())]
        assert q.payload_sha256 == hashlib.sha256(payload).hexdigest() and q.tail_crc32 == zlib.crc32(payload[-16:]) and q.payload_bytes == len(payload)
    same = {}
    for r in rows.values():
        assert same.setdefault(r.payload_sha256, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_layouts_of_the_query_are_all_used(spark, tiny):
    """Every codec, strips and tiles, several pages: and each file is read back page by page."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    read = T.pages(T.store(docs, "text", carry=["doc_id"]), "media")
    kinds = {(r.compression, r.predictor) for r in read.select("compression", "predictor").distinct().collect()}
    assert {c for c, _ in kinds} == {T.NONE, T.LZW, T.DEFLATE, T.PACKBITS} and {p for _, p in kinds} == {1, 2}
    many = T.op5_tiff(spark, tiny).where("CAST(split(feature, 'x')[0] AS int) > 1").count()
    assert many > 0 and read.where("error IS NOT NULL").count() == 0
    assert {how.order for how in T.LAYOUTS} == {"<", ">"} and {bool(how.tile) for how in T.LAYOUTS} == {True, False}


def test_feature_sees_the_picture():
    a = np.zeros((16, 64, 3), np.uint8)
    a[:8] = 200
    assert T.page_feature(a).startswith("ffffffff00000000:100.000") and T.page_feature(a[:1])


def test_errors():
    with pytest.raises(T.TiffError):
        T.write_pages(T.payload_pages(T.pad(b""), T.Layout()), T.Layout(compression=7))
