"""KD-tree search, BPE, WARC archives: brute force, the reference encoder, round trips."""
import hashlib
import io
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from verdant.llm import bpe as B, kd_topk as K, wacz as W

VECS = "vec_id long, embedding array<float>, id int, v string, score long"


# -- search ---------------------------------------------------------------------

def brute_top(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault((i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)), None)
    out = []
    for q, qv in good:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q and len(v) == len(qv))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block", [(16_384, 8_192), (40, 3)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(300)]
    rows += [(i, [0.5] * 5) for i in range(300, 420)]                     # many equal vectors: ties
    rows += [(440, None), (460, [1.0, None, 0.0, 0.0, 0.0]), (480, [float("nan")] * 5), (500, [float("inf")] * 5), (None, [1.0] * 5)]
    rows += [(520, [1.0, 2.0]), (521, [3.0, 4.0]), (540, []), (541, []), rows[0], rows[0]]
    df = spark.createDataFrame([(i, v, 1, "x", 1) for i, v in rows], VECS)
    got = K.top_k(df, lambda i: i % 20 == 0, 20, shard_rows=shard_rows, query_block=block).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, 20)


def test_top_k_of_empty_and_single_tables(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "x", 1)], VECS)
    assert K.top_k(df, lambda i: i % 20 == 0).count() == 0
    assert K.top_k(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_the_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    centre = rng.integers(-60, 60, (30, 8)) * 10
    points = np.concatenate([c + rng.integers(-3, 4, (200, 8)) for c in centre])
    ids = rng.permutation(len(points))
    queries = points[:20]
    q, i, s = K.search(points, ids, queries, np.full(20, -1), [float("-inf")] * 20, 5)
    for n, x in enumerate(queries):
        scores = points @ x
        order = np.lexsort((ids, -scores))[:5]
        assert list(i[5 * n:5 * n + 5]) == list(ids[order]) and list(s[5 * n:5 * n + 5]) == list(scores[order])
    big = points.astype(np.int64) * 2 ** 20  # past what floats hold exactly
    _, i2, s2 = K.search(big, ids, big[:20], np.full(20, -1), [float("-inf")] * 20, 5)
    assert list(s2) == [x * 2 ** 40 for x in s.tolist()] and list(i2) == list(i)


# -- BPE ----------------------------------------------------------------------------

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def test_replay_equals_the_encoder_on_random_words(encoder):
    rng = random.Random(8)
    words = {"".join(rng.choices("abtheAB  é\n日1!ßing", k=rng.randint(1, 40))) for _ in range(6000)}
    words |= {"a" * 3000, "the" * 1000, "日本語" * 300, "abab" * 500, "\U0001f600" * 40}
    got = B.Replay(B.read_ranks(PATH)).encode(words)
    assert all(got[w] == encoder._encode_single_piece(w.encode()) for w in words)


def test_lower_ranks_that_turn_up_go_first():
    """A vocabulary in which merging makes a pair of lower rank than the one replayed."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"abc": 256, b"ab": 257, b"cab": 258, b"bc": 259, b"abab": 260, b"ca": 261, b"bab": 262}
    enc = tiktoken.Encoding("small", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(4000)}
    got = B.Replay(ranks).encode(words)
    assert all(got[w] == enc._encode_single_piece(w.encode()) for w in words)


def test_encode_and_decode_rows(spark, encoder):
    texts = [None, "", " ", "Hello  world's\n\n'tis 123 ½ été 日本", "x" * 50_000, "a b " * 40_000, "<|endoftext|>"]
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)] + [(3, texts[3], "k", 1), (None, "null id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    ranks = B.vocabulary(spark, PATH)
    ids = B.encode(df, ranks, P.PATTERN)
    assert ids.columns == ["doc_id", "text", "decoded", "ids"]
    out = B.decode(ids, ranks).collect()
    assert len(out) == len(rows)
    for r in out:
        assert list(r.ids) == encoder.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert B.decode(B.encode(df.limit(0), ranks, P.PATTERN, keep=["doc_id"]), ranks).count() == 0


def test_forgetting_pieces_changes_nothing(spark, encoder, monkeypatch):
    monkeypatch.setattr(B, "KEPT", 3)
    df = spark.createDataFrame([(i, f"some words {i} and {i * 7} more words") for i in range(300)], "doc_id long, text string")
    got = B.encode(df, B.vocabulary(spark, PATH), P.PATTERN).collect()
    assert all(list(r.ids) == encoder.encode_ordinary(r.text) for r in got)


# -- archives ---------------------------------------------------------------------------

class Bytes:
    """What the reader needs of a file."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_own_zip_opens_elsewhere_and_reads_back(zip64):
    out = io.BytesIO()
    z = W.StoredZip(out, zip64)
    for name, parts in (("archive/data.warc.gz", [b"abc", b"", b"defg" * 100]), ("indexes/index.cdx", [b"1 0 3\n"])):
        z.begin(name)
        for p in parts:
            z.add(p)
        z.end()
    z.close()
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as other:
        assert other.testzip() is None and other.read("archive/data.warc.gz") == b"abc" + b"defg" * 100
    f = Bytes(out.getvalue())
    head, size = W.directory(f, f.size())["archive/data.warc.gz"]
    assert size == 403 and f.read_at(3, W.data_offset(f, head)) == b"abc"


def test_directories_of_other_writers_and_broken_files():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"one")
        with z.open("archive/data.warc.gz", "w", force_zip64=True) as m:
            m.write(b"two!")
        z.writestr("packed", b"x" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5 a comment"
    f = Bytes(out.getvalue())
    found = W.directory(f, f.size())
    assert set(found) == {"a", "archive/data.warc.gz"}  # deflated members are not ranges of records
    head, size = found["archive/data.warc.gz"]
    assert f.read_at(size, W.data_offset(f, head)) == b"two!"
    with pytest.raises(ValueError):
        W.directory(Bytes(b"no archive"), 10)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, sha1 string, least int")


@pytest.mark.parametrize("threshold", [0, 5])
def test_round_trip_of_records(spark, threshold):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""),
            (4, "é\r\nX: y", "été " * 20_000), (7, "u", "longer text"), (8, "u", "longer text"), (None, "u", "longer text"),
            (6, "u", "WARC/1.1\r\n\r\n\r\n"), (6, "u", "WARC/1.1\r\n\r\n\r\n"), (None, "n", "only null")]
    got = W.round_trip(pages(spark, rows), threshold).collect()
    assert len(got) == len(rows)

    def expected(i, h):
        body = (h or "").encode()
        same = [j for j, _, x in rows if (x or "") == (h or "") and j is not None]
        first = min(same, default=None)
        revisit = len(body) >= threshold and first is not None and i != first
        return (i, len(body), W.base32_sha1(body), "revisit" if revisit else "response", first if revisit else None)

    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) \
        == sorted(str(expected(i, h)) for i, _, h in rows)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha1(bytes(r.payload)).digest() and len(r.payload) == r.payload_bytes


def test_records_are_read_by_ranges(spark, scratch):
    rows = [(i, "u", f"page {i} " + "x" * 3000 * (i % 3)) for i in range(400)]
    manifest = W.write(W.planned(pages(spark, rows)).coalesce(1), scratch("wacz"), zip64=True)
    path = manifest.first().path
    with open(path.removeprefix("file:"), "rb") as f:
        data = f.read()
    places = {r.start: r.length for r in W.entries(manifest).collect()}
    assert len(places) == 400
    for start, length in list(places.items())[:20]:
        assert W.parse_record(zlib.decompress(data[start:start + length], 31))["record_type"] == "response"
    few = W.read(W.entries(manifest).filter(F.col("start") == min(places))).collect()
    assert len(few) == 1


def test_archives_of_an_empty_table(spark):
    assert W.round_trip(pages(spark, []).limit(0)).count() == 0
