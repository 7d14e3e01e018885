"""Plain Python versions of the operators, and a table of hard cases."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = ("row", "bucket", "size", "digest", "key", "word", "windows", "owner", "shard", "slot", "block", "taken", "path", "kept")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def prose(seed, count):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('abcdefghkmnprst')}{draw.choice('aeiou')}{draw.randrange(300)}" for _ in range(count))


def hard_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeated rows, near copies."""
    base, passage = prose(1, 60), prose(2, 20)
    near = base.split()
    near[30] = "changed"
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one Two three", "b"), (5, "ONE two three", "b"), (6, base, "a"), (7, " ".join(near), "a"),
        (8, base.upper(), None), (9, prose(3, 30) + " " + passage, "b"), (10, passage + "\n" + prose(4, 30), "c"), (11, "a " * 30_000, "c"), (12, "x" * 50_000, "a"),
        (13, prose(5, 20_000), "a"), (14, "naïve café 東京 　 w rd 'tis we're 12345 \U0001f600\U0001f600 <a>&#$%*|", "b"),
        (15, prose(6, 40) + "\n" + "same line here\n" * 3, "b"), (None, base, "a"), (None, None, None), (4, "one Two three", "b"), (17, "    spaced\t\tout   text  ", "c"), (6, base, "a")]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def shingles(text, size):
    w = words(lower(text))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def linked_classes(rows, size, percent):
    """doc_id: smallest doc_id reachable, over links of the rows' shingle sets."""
    sets = [(r[0], shingles(r[1], size)) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: top(i) for i in parent}


def without_repeats(rows, size=13):
    """[(doc_id, words, words left)], judged on the input."""
    last = 1 << 62
    first = {}
    listed = [(last if r[0] is None else r[0], words(r[1])) for r in rows]
    for i, w in listed:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), r in zip(listed, rows, strict=True):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((r[0], w, [x for k, x in enumerate(w) if k not in gone]))
    return out


def targets(sizes, most=3):
    """Target of each source from its size, as water rises: those that reach their limit stop."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        left, weights = total - sum(out.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / weights > most * sizes[s] + 1e-9]
        if not above:
            out.update({s: left * weight[s] / weights for s in free})
            break
        out.update({s: float(most * sizes[s]) for s in above})
        free -= set(above)
    return out


def repeats(text, least=5):
    """Words covered by substrings of least words or more that occur twice, and words in the longest."""
    w = words(text)
    covered, longest = set(), 0
    places = defaultdict(list)
    for k in range(len(w) - least + 1):
        places[tuple(w[k : k + least])].append(k)
    for found in places.values():
        if len(found) > 1:
            for n, a in enumerate(found):
                covered.update(range(a, a + least))
                for b in found[n + 1 :]:
                    size = 0
                    while b + size < len(w) and w[a + size] == w[b + size]:
                        size += 1
                    longest = max(longest, size)
    return covered, longest


def quality(text, most_covered=0.20, most_words=200):
    w = words(text)
    covered, longest = repeats(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    chars, inside = sum(map(len, w)), sum(len(w[k]) for k in covered)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return {"n_words": len(w), "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "base_failed": failed, "kept": not failed and inside / max(chars, 1) <= most_covered and longest <= most_words}


def piece_count(word, first, later):
    """Greedy longest match, piece by piece."""
    at, count, known = 0, 0, first
    while at < len(word):
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in known), 0)
        if not size:
            return 0
        at, count, known = at + size, count + 1, later
    return count


def token_counts(texts):
    return Counter(w for t in texts for w in words(lower(t)))
