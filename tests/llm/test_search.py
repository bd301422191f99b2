"""Ranked search, phrases and neighbour graphs against brute force on small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from claimweave.llm import collocations, lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = ["the", "of", "Cat", "dog", "élan", "x1", "İstanbul", "new", "york", "city", "tail"]


def texts(n, seed, longest=30):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(WORDS, [9, 7, 3, 3, 2, 1, 1, 4, 4, 4, 1], k=rng.randint(0, longest))) for _ in range(n)]
    return [t.replace("dog", "dog,").replace("tail", "tail\n") for t in out]


def ranked(documents, items, k=10):
    """The law of the search, row by row."""
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in documents]
    some = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(some), sum(x[2] for x in some)
    df = Counter(t for _, c, _ in some for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, length in some:
            m = 10 + 90 * length * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(TERM.findall((text or "").translate(LOWER))) if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def search(spark, documents, items, block_bytes):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").selectExpr("*", "1 AS block", "'t' AS term", "2 AS score")
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "5 AS rank")
    index = lexical_search.materialize(lexical_search.index_documents(docs, block_bytes), "inverted")
    rows = lexical_search.search(index, asked).select("item_id", "rank", "doc_id", "score").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_ranked_search_equals_brute_force(spark):
    documents = list(enumerate(texts(300, 1))) + [(7, "the cat"), (7, "the cat"), (None, "York city"), (400, None), (401, ""), (402, ".,;")]
    documents += [(i, "new york city") for i in (900, 800, 700)] + [(500, "x1 " * 50_000)]
    items = [(0, "the CAT of x1"), (1, "new york, new york"), (1, "new york, new york"), (2, None), (3, ""), (4, "unseen"), (None, "tail élan"), (5, " ".join(WORDS))]
    items += [(6, " ".join(f"w{i}" for i in range(90)) + " " + " ".join(WORDS))]  # more terms than a mask word has bits
    documents += [(1000 + i, f"w{i} w{89 - i} the") for i in range(90)]
    expected = ranked(documents, items)
    assert expected and search(spark, documents, items, 400) == expected
    assert search(spark, documents, items, 1 << 20) == expected


def test_ranked_search_of_empty_tables(spark):
    assert search(spark, [], [(1, "the")], 100) == []
    assert search(spark, [(1, "the")], [], 100) == []
    assert search(spark, [(1, None)], [(1, "the")], 100) == []


def test_masks_beyond_the_kth_score_are_not_needed():
    docs = [np.arange(0, 100), np.array([3, 50])]
    shares = [np.full(100, 5), np.array([9, 9])]
    best, scores = lexical_search.best_documents(docs, shares, np.array([1, 10]), np.arange(100), 2)
    assert best.tolist() == [3, 50] and scores.tolist() == [95, 95]


def phrases(documents, least, best):
    """The law of the phrases, by counting all of them."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in documents:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        rows = []
        for p, a in count.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in count.items() if len(p) == 2 and b >= least):
                continue
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, count[p[:k]], count[p[k:]]))
        rows.sort()
        out += [(lang, r, x[3], x[4], x[5], x[6], n[lang], -x[0]) for r, x in enumerate(rows[:best], 1)]
    return sorted(out)


def test_phrases_equal_brute_force(spark):
    rng = random.Random(5)
    documents = [(rng.choice(["en", "fr", None, "und"]), t) for t in texts(400, 2)] + [("en", None), (None, ""), ("de", " . , "), ("en", "a" * 100_000)]
    documents += [("en", "New York City Hall; new\tyork city hall")] * 20 + [("xx", "z z z z z z z z z z z z z")]
    df = spark.createDataFrame(documents, "lang string, text string").selectExpr("*", "1 AS shard", "'w' AS word", "2 AS n")
    for shard_bytes, best in ((2000, 2000), (1 << 20, 15)):
        found = sorted(tuple(r) for r in collocations.mine_phrases(df, 10, best, shard_bytes).collect())
        assert found == phrases(documents, 10, best)


def test_phrases_of_empty_tables(spark):
    for rows in ([], [("en", None)], [("en", "one two three")]):
        assert collocations.mine_phrases(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_phrase_index_extends_both_ways():
    symbols = np.array([1, 2, 3, 0, 1, 2, 1, 2, 3, 3, 0])
    index = collocations.PhraseIndex(symbols, 4)
    words = index.words(np.array([2]))
    parent, symbol, count, low, twin = index.left(*words)
    assert (parent.tolist(), symbol.tolist(), count.tolist()) == ([0], [1], [3])
    _, symbol, count, _, _ = index.right(twin, count, low)
    assert (symbol.tolist(), count.tolist()) == ([1, 3], [1, 2])


def test_packed_numbers_come_back():
    ids = np.array([0, 5, 1 << 20, (1 << 32) - 1])
    assert collocations.unpack(collocations.pack(ids)).tolist() == ids.tolist()
    keys = np.array([-5, 0, 7, 1 << 60])
    assert collocations.unpack_sorted(collocations.pack_sorted(keys)).tolist() == keys.tolist()


def linked(rows, threshold=0.9):
    """Links, component and first id of every row, by comparing all rows."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [[] for _ in rows]
    unit = {i: np.array(rows[i][1], np.float64) / np.linalg.norm(np.array(rows[i][1], np.float64)) for i in good}
    for i in good:
        links[i] = [j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    out = []
    for i, (own, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            for j in links[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((own, len(links[i]), first, own == first))
    return sorted(out, key=str)


def found_links(spark, rows, kind="float", **options):
    from claimweave.llm import near_vectors

    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").selectExpr("*", "1 AS node", "'k' AS key", "2 AS copies")
    result, recall = near_vectors.link_vectors(df, **options)
    return sorted((tuple(r) for r in result.collect()), key=str), recall


def cloud(rng, center, n, spread):
    return center + rng.normal(size=(n, len(center))) * spread / math.sqrt(len(center))


def floats(x):
    return [float(np.float32(v)) for v in x]


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [v for n in (1, 2, 5, 40, 12) for v in cloud(rng, rng.normal(size=16), n, 0.25 * 4 if n == 40 else 0.5)]
    vectors += list(rng.normal(size=(250, 16))) + [vectors[3]] * 4 + [vectors[3] * 2]
    rows = [(i * 3 % 1000 + 1, floats(v)) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None] * 8), (2004, [math.nan] * 16), (2005, [math.inf] + [1.0] * 15)]
    rows += [(None, floats(vectors[5])), (None, floats(rng.normal(size=16))), (7, floats(vectors[9])), (2010, [1.0, 0.0, 0.0]), (2011, [1.0, 0.01, 0.0])]
    expected = linked(rows)
    for options in ({}, {"leaf": 32, "k": 3}):
        got, recall = found_links(spark, rows, **options)
        assert recall == 1.0
        assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert all(x[3] == (x[0] == x[2]) for x in got)


def test_near_vectors_with_full_lists_and_large_groups(spark, monkeypatch):
    from claimweave.llm import near_vectors

    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rng = np.random.default_rng(4)
    center = rng.normal(size=12)
    center /= np.linalg.norm(center)
    side = rng.normal(size=12)
    side -= side @ center * center
    side /= np.linalg.norm(side)
    # tight islands at 20 degrees from each other: lists are full of an island before they see the next one
    at = [math.cos(a) * center + math.sin(a) * side for a in np.radians([0, 20, 40, 60])]
    vectors = [v for c in at for v in cloud(rng, c, 60, 0.01)] + list(cloud(rng, -center, 90, 0.35)) + list(rng.normal(size=(60, 12)))
    rows = [(i, floats(v)) for i, v in enumerate(vectors)]
    got, recall = found_links(spark, rows, leaf=64, k=4)
    assert recall == 1.0 and got == linked(rows)


def test_near_vectors_of_small_tables(spark):
    assert found_links(spark, [])[0] == []
    assert found_links(spark, [(1, None)])[0] == [(1, 0, 1, True)]
    assert found_links(spark, [(1, [1.0, 0.0])], "double")[0] == [(1, 0, 1, True)]
    assert found_links(spark, [(2, [1.0, 0.0]), (1, [1.0, 0.0])], "double")[0] == [(1, 1, 1, True), (2, 1, 1, False)]
