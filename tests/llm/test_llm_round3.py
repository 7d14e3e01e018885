"""Importance resampling, hard negatives and SentencePiece encoding against plain Python and the library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skyjoin.llm import hard_negatives, importance, sentence_pieces

ROWS = brute.hard_rows()
LETTERS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


# ---- importance resampling

def features(text, longest=1, buckets=importance.BUCKETS):
    w = LETTERS.findall(brute.lower(text).encode())
    return [zlib.crc32(b" ".join(w[k : k + n])) % buckets for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


def resampled(rows, target, longest=1, percent=10, least=20, buckets=importance.BUCKETS):
    """(doc_id, n_features, weight, score) with counts, and the scores drawn in order."""
    s, t = (Counter(b for text in texts for b in features(text, longest, buckets)) for texts in ([r[1] for r in rows], target))
    size_s, size_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * size_s / ((s[b] + 1) * size_t))) for b in range(buckets)]
    out, able = Counter(), []
    for i, text, *_ in rows:
        found = features(text, longest, buckets)
        weight = sum(gain[b] for b in found)
        h = int(sha(f"2024:{'' if i is None else i}".encode())[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[(i, len(found), weight, score)] += 1
        if len(features(text)) >= least:
            able.append((-score, i is None, i))
    return out, [(-s, i) for s, _, i in sorted(able)[: percent * len(able) // 100]]


@pytest.mark.parametrize("longest, percent, least", [(1, 10, 20), (3, 50, 2), (2, 100, 0)])
def test_importance(hard, spark, stage, longest, percent, least):
    target = [brute.prose(k, 30) for k in range(5)] + [None, "", "one two three"]
    bench = brute.with_clashes(spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string"))
    got = importance.resample(hard, bench, stage, longest=longest, percent=percent, least_words=least).collect()
    want, drawn = resampled(ROWS, target, longest, percent, least)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    ranked = sorted((r["rank"], r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [(s, i) for _, s, i in ranked] == drawn and [k for k, *_ in ranked] == list(range(1, len(drawn) + 1))


def test_bit_planes_equal_sums():
    rng = np.random.default_rng(5)
    gains = rng.integers(-12_000, 12_000, 777)
    planes = importance.GainPlanes(gains.tolist())
    row, bucket = np.divmod(rng.choice(40 * 777, 5_000, replace=False), 777)
    count = rng.integers(1, 5_000, 5_000)
    assert (planes.weights(row, bucket, count, 40) == np.bincount(row, (gains[bucket] * count).astype(float), 40).astype(np.int64)).all()
    assert not importance.GainPlanes([0] * 70).weights(row[:0], bucket[:0], count[:0], 3).any()


def test_importance_draws_what_looks_like_the_target(spark, stage):
    near = [(k, brute.prose(1, 5) + " " + " ".join(random.Random(k).choices(["apple", "pear", "plum"], k=30))) for k in range(100)]
    far = [(100 + k, " ".join(random.Random(k).choices(["iron", "zinc", "lead", "pear"], k=35))) for k in range(900)]
    target = spark.createDataFrame([("apple pear plum " * 50,)], "text string")
    got = importance.resample(spark.createDataFrame(near + far, "doc_id long, text string"), target, stage).where("rank is not null").collect()
    assert len(got) == 100 and sum(r["doc_id"] < 100 for r in got) == 100


def test_importance_of_nothing(spark, stage, empty):
    assert importance.resample(empty, empty, stage).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_features"], r["rank"]) for r in importance.resample(some, empty, stage, least_words=1, percent=100).collect()}
    assert got == {1: (2, 1), 2: (0, None)}


# ---- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def mined(rows, positives=5, negatives=3):
    """Every anchor against every row, with whole numbers."""
    clean = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        clean.append((i, [math.floor(256 * np.float64(np.float32(x))) for x in v], label))
    out = Counter()
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for n, (i, v, label) in enumerate(clean):
        if i is None or i % 50:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(clean) if m != n]
        for p, j, _ in sorted([s for s in scores if s[2] == label], key=order)[:positives]:
            held = sorted([s for s in scores if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p], key=order)[:negatives]
            for rank, (score, k, _) in enumerate(held, 1):
                out[(i, j, rank, k, p, score)] += 1
    return out


def as_counter(df):
    return Counter(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def hard_vectors():
    rng = random.Random(6)
    rows = [(k, [rng.gauss(0, 0.3) + (k % 5 == j) for j in range(12)], k % 5 + (k % 11 == 0)) for k in range(420)]
    rows += [(1000 + k, [0.5] * 12, k % 3) for k in range(150)]  # ties: equal vectors of several labels
    rows += [(2000, None, 1), (2050, [0.1] * 12, None), (2100, [], 2), (2150, [float("nan")] * 12, 1), (2200, [0.1, None] + [0.2] * 10, 1), (2250, [float("inf")] + [0.0] * 11, 3),
             (2300, [0.0] * 12, 1), (2350, [0.7, -0.2], 2), (None, [0.4] * 12, 2), (None, [0.4] * 12, 1), (None, None, None), (50, [0.3] * 12, 1), (50, [0.3] * 12, 1),
             (2400, [-0.5] * 12, 4), (2450, [1e30, -1e30] + [0.0] * 10, 8), (2500, [0.9] * 12, 9)]
    return rows


def test_hard_negatives(spark, stage, monkeypatch):
    rows = [r for r in hard_vectors() if r[0] != 2450]
    df = brute.with_clashes(spark.createDataFrame(rows, VECTORS)).repartition(3)
    want = mined(rows)
    assert as_counter(hard_negatives.mine(df, stage)) == want and len(want) > 100
    huge = hard_negatives.mine(spark.createDataFrame(hard_vectors(), VECTORS), stage)
    assert huge.count() > 100  # values out of range are cut, nothing fails


def test_hard_negatives_in_many_parts(spark, stage, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 32)
    monkeypatch.setattr(hard_negatives, "HELD", 96 * 12)
    rows = [r for r in hard_vectors() if r[0] != 2450]
    # a third of all rows of one label
    rows = [(i, v, 1 if label is not None and n % 3 == 0 else label) for n, (i, v, label) in enumerate(rows)]
    assert as_counter(hard_negatives.mine(spark.createDataFrame(rows, VECTORS), stage)) == mined(rows)


def test_hard_negatives_of_nothing(spark, stage):
    nothing = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(nothing, stage).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(50, [1.0], 1), (51, None, 1)], VECTORS), stage).collect() == []


def test_coordinate_ranges_keep_every_row_within_the_cosine():
    rng = np.random.default_rng(2)
    vectors = np.round(rng.normal(size=(400, 8)) * 100)
    vectors[:50] = np.round(vectors[50] + rng.normal(size=(50, 8)) * 10)
    lengths = np.linalg.norm(vectors, axis=1)
    bucket = hard_negatives.Bucket.of(0, vectors, lengths)
    pruned = 0
    for q in [*vectors[:60], np.eye(8)[0] * 300]:
        direction = q / np.linalg.norm(q)
        cosines = vectors @ direction / lengths
        for least in (0.05, 0.5, 0.9, 0.999, 1.0):
            some = bucket.candidates(direction, np.argsort(-np.abs(direction))[:4], least)
            held = set(range(400)) if some is None else set(some.tolist())
            assert set(np.flatnonzero(cosines >= least + 1e-9).tolist()) <= held
            pruned += 400 - len(held)
    assert pruned > 30_000


# ---- SentencePiece

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)


def test_pieces(hard, library):
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentence_pieces.encode(hard, with_spans=False).collect())
    want = Counter()
    for i, text, *_ in ROWS:
        ids = library.encode(text or "")
        want[(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))] += 1
    assert got == want


def test_spans_point_at_the_text(hard, library):
    got = {r.doc_id: r for r in sentence_pieces.encode(hard).collect()}
    for i, text, *_ in ROWS:
        if i is None:
            continue
        proto = library.encode(text or "", return_type="proto")
        assert [(p.id, p.start, p.stop) for p in got[i].pieces] == [(p.id, p.begin, p.end) for p in proto.pieces]
        assert got[i].n_covered == len((text or "").encode())
    back = sentence_pieces.decode(sentence_pieces.encode(hard).select("doc_id", F.col("pieces.id").alias("ids")))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, library.decode(library.encode(t or ""))) for i, t, *_ in ROWS)


def test_pieces_of_an_empty_table(empty):
    assert sentence_pieces.encode(empty).collect() == []


def variant(table, prefix, tidy):
    """The model with another normaliser."""
    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def message(field, value):
        return bytes([field << 3 | 2]) + number(len(value)) + value

    with open(sentence_pieces.MODEL, "rb") as file:
        parts = [message(f, v) for f, v in sentence_pieces.fields(file.read()) if f != 3]
    return b"".join(parts) + message(3, message(1, b"x") + message(2, table) + bytes([0x18, prefix, 0x20, tidy, 0x28, 1]))


@pytest.mark.parametrize("mapped", [False, True])
@pytest.mark.parametrize("prefix, tidy", [(0, 0), (0, 1), (1, 0), (1, 1)])
def test_normalisers(tmp_path, mapped, prefix, tidy):
    """Character maps, prefixes and tidied spaces: ids, spans and decoded texts are the library's, whole and by blocks."""
    import pyarrow as pa

    own = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    table = dict(sentence_pieces.fields(own.serialized_normalizer_spec()))[2] if mapped else b""
    data = variant(table, prefix, tidy)
    library, model = sentencepiece.SentencePieceProcessor(model_proto=data), sentence_pieces.Model(data)
    (tmp_path / "m.model").write_bytes(data)
    rng = random.Random(9)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "é", "東", "😀", "　", "\xa0", "x", "1", "<0x0A>", "<s>", "'", "\0", "�", "́", "ing", "ｆ", "㌔", "ﬁ", "\xad", "​", "¨", "Å", "A", "̊"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(400)] + ["", " ", "   ", "x" * 3000, "▁", " the", "the  "]
    protos = [library.encode(t, return_type="proto") for t in texts]
    for text, proto in zip(texts, protos):
        ids = [p.id for p in proto.pieces]
        assert model.encode(text.encode()) == [(p.id, p.begin, p.end) for p in proto.pieces]
        assert model.decode(ids).decode() == library.decode(ids)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    rows = [r for b in sentence_pieces.encode_batches(iter([batch]), str(tmp_path / "m.model"), True) for r in b.to_pylist()]
    for row, text, proto in zip(rows, texts, protos):
        ids = [p.id for p in proto.pieces]
        assert row["ids_sha256"] == sha(",".join(map(str, ids)).encode()) and row["decoded_sha256"] == sha(library.decode(ids).encode())
        assert [(p["id"], p["start"], p["stop"]) for p in row["pieces"]] == [(p.id, p.begin, p.end) for p in proto.pieces] and row["n_tokens"] == len(ids)


def test_decoding_any_ids(library):
    model, rng = sentence_pieces.model(sentence_pieces.MODEL), random.Random(10)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(3), rng.randrange(3, 259), rng.randrange(259, 32000), 29871, 259, 278]) for _ in range(rng.randrange(12))]
        assert model.decode(ids).decode() == library.decode(ids)


def test_models_not_taken():
    with pytest.raises(ValueError):
        sentence_pieces.Model(b"")
