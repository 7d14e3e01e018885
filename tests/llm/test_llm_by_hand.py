"""Parts of operators against versions by hand: differencing, resampling and features, the model's scores, word pieces."""

import math
import random
import zlib

import brute
import numpy as np
import pytest

from skyjoin.llm import lm, shards, telephony, token_counts


def differenced_by_hand(sizes, shards_count):
    """Sums of the shards: the two lists of largest spread are added, one of them turned round; of equals the older goes first."""
    lists = [(k, sorted([size] + [0] * (shards_count - 1))) for k, size in enumerate(sizes)]
    age = len(lists)
    while len(lists) > 1:
        lists.sort(key=lambda x: (x[1][0] - x[1][-1], x[0]))
        (_, a), (_, b) = lists[:2]
        lists = [*lists[2:], (age, sorted(x + y for x, y in zip(a, reversed(b))))]
        age += 1
    return lists[0][1]


@pytest.mark.parametrize("count, shards_count", [(1, 3), (2, 2), (7, 3), (60, 4), (300, 16)])
def test_differencing(count, shards_count):
    rng = random.Random(count)
    sizes = [rng.choice([5, 5, rng.randrange(1, 10_000)]) for _ in range(count)]
    homes = [slots[-1] for slots in shards.differenced([[0] * (shards_count - 1) + [s] for s in sizes], shards_count)]
    sums = [0] * shards_count
    for size, home in zip(sizes, homes, strict=True):
        sums[home] += size
    assert sorted(sums) == differenced_by_hand(sizes, shards_count)


def doubled_by_hand(pcm):
    """Each sample, then the one between it and the next."""
    at = lambda k: pcm[min(max(k, 0), len(pcm) - 1)]
    out = []
    for k, x in enumerate(pcm):
        between = math.floor((9 * (at(k) + at(k + 1)) - at(k - 1) - at(k + 2) + 8) / 16)
        out += [x, min(max(between, -32768), 32767)]
    return out


def test_doubled():
    rng = random.Random(2)
    for count in (1, 2, 3, 64, 333):
        pcm = [rng.choice([-32768, 32767, rng.randrange(-32768, 32768), 0]) for _ in range(count)]
        assert telephony.doubled(np.array(pcm, np.int16)).tolist() == doubled_by_hand(pcm)


def mu_by_hand(code):
    code = ~code & 0xFF
    size = ((code & 0x0F) * 8 + 0x84 << (code >> 4 & 7)) - 0x84
    return -size if code & 0x80 else size


def a_by_hand(code):
    code ^= 0x55
    part, step = code >> 4 & 7, code & 0x0F
    size = step * 16 + 8 if part == 0 else (step * 16 + 0x108) << part - 1
    return size if code & 0x80 else -size


def test_features(spark):
    """The whole feature string of texts of several lengths."""
    assert telephony.MU.tolist() == [mu_by_hand(c) for c in range(256)] and telephony.A.tolist() == [a_by_hand(c) for c in range(256)]

    def described(pcm):
        signs = [x < 0 for x in pcm]
        return f"n={len(pcm)} peak={max(map(abs, pcm))} rms={math.isqrt(sum(x * x for x in pcm) // len(pcm))} zero={sum(a != b for a, b in zip(signs, signs[1:]))}"

    texts = ["", "a", brute.prose(1, 30), "é東😀" * 50, "x" * 64]
    got = {r.doc_id: r.feature for r in telephony.store(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        data = text.encode()
        data += bytes(-len(data) % 64 if data else 64)
        pcm = doubled_by_hand([mu_by_hand(c) for c in data])
        adpcm = telephony.decode_adpcm(np.frombuffer(data, np.uint8)).ravel().tolist()
        want = f"mu {described(pcm)} crc={zlib.crc32(np.array(pcm, '<i2').tobytes())}; a {described([a_by_hand(c) for c in data])}; adpcm {described(adpcm)}"
        assert got[k] == want


def test_scores_of_a_model():
    """Texts scored by plain sums: the class's softmax after the two classes before, and add-one shares among words without a class."""
    draw = np.random.default_rng(4)
    texts = [brute.prose(k, 12) for k in range(20)] + ["", "the the the end", "a b a b c"]
    train = [t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 7 != 2]
    counts = brute.token_counts(train)
    ends = len(train)
    own = {w: k + 2 for k, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:9])}
    rest = {w: n for w, n in counts.items() if w not in own}
    noise = np.log(draw.dirichlet(np.ones(len(own) + 2))).astype(np.float32)
    model = lm.Model(noise)
    model.values += draw.normal(0, 0.4, len(model.values)).astype(np.float32)

    def score(text):
        words = brute.words(brute.lower(text))
        classes = [own.get(w, 1) for w in words] + [0]
        before, total = [len(own) + 2] * 2, 0.0
        for w, c in zip([*words, None], classes):
            hidden = model.a[before[0]].astype(float) + model.b[before[1]]
            logits = model.q.astype(float) @ hidden + model.bias
            total += (logits[c] - math.log(np.exp(logits).sum())) / math.log(10)
            if c == 1:
                total += math.log10((counts[w] + 1) / (sum(rest.values()) + len(rest) + 1))
            before = [before[1], c]
        return total

    import pyarrow as pa

    codes, distinct, sizes = [], {}, []
    for text in texts:
        words = brute.words(brute.lower(text))
        codes += [distinct.setdefault(w, len(distinct)) for w in words]
        sizes.append(len(words))
    names = [w.encode() for w in distinct]
    places = [k for w, k in distinct.items() if w in counts]
    row = {
        "classes": lm.classes_of(names, {w.encode(): c for w, c in own.items()}).tobytes(), "ids": list(range(len(texts))),
        "held": [zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))], "sizes": sizes, "codes": np.array(codes, np.int32).tobytes(),
        "places": places, "known": [counts[w] for w, k in distinct.items() if w in counts]}
    batch = pa.RecordBatch.from_pylist([row], pa.schema([
        ("classes", pa.binary()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()),
        ("places", pa.list_(pa.int64())), ("known", pa.list_(pa.int64()))]))
    totals = {"tokens": sum(counts.values()) + ends, "distinct": len(counts) + 1, "ends": ends, "other_tokens": sum(rest.values()), "other_distinct": len(rest)}
    got = [r for b in lm.score_batches(iter([batch]), {w.encode(): c for w, c in own.items()}, noise, model.values.tobytes(), totals) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    assert [r["score"] for r in got] == pytest.approx([score(t) for t in texts], rel=1e-5)


def test_long_words_in_pieces():
    """Words of several hundred characters, which the automaton takes one by one, against greedy matching."""
    rng = random.Random(5)
    pieces = [b"a", b"b", b"ab", b"abb", b"bab", b"aabba", b"c"]
    first, later = token_counts.roles(pieces)
    automaton = token_counts.Automaton(first, later)
    words = ["".join(rng.choice("abc") for _ in range(rng.choice([3, 63, 64, 65, 400]))).encode() for _ in range(200)] + [b"abd" * 50]
    assert automaton.count_all(words).tolist() == [brute.piece_count(w, set(first), set(later)) for w in words]
