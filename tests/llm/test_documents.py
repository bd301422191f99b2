"""Fingerprints, Jaccard join, repeats: against plain versions, and on edge inputs."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import fingerprints, jaccard_join, repeats, shingles
from claimweave.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, n bigint, digest string, part int, range int, `key` string"


def corpus(seed=3, n=90):
    """Random documents with copies, near copies, shared passages, nulls and repeated rows."""
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["É", "ß", "λ"]
    make = lambda k: [rng.choice(words) for _ in range(k)]
    passage, base = " ".join(make(30)), make(80)
    rows = []
    for i in range(n):
        kind = rng.randrange(7)
        w = make(rng.randrange(0, 70))
        if kind == 0:
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(words)
        text = " ".join(w) + (" " + passage if kind == 1 else "")
        if kind == 2 and rows:
            text = rng.choice(rows)[1]
        rows.append((i * 3, text))
    return [*rows, (7, None), (8, ""), (9, " \n"), (None, "a b c d e f"), (11, "One two"), (12, "one TWO"),
            rows[0], rows[0], (13, "the end of it\x0b all"), (14, "ab " * 400), (15, "ab " * 380)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "k") for r in rows], SCHEMA)


def test_shingle_sets_equal_plain_sets():
    texts = [t or "" for _, t in corpus()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    sets = shingles.shingle_sets(data, offsets)
    plain = [brute.shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(0, len(texts), 5):
        for j in range(0, len(texts), 3):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_jaccard_join(spark):
    rows = corpus()
    found = jaccard_join.join_documents(frame(spark, rows)).collect()
    assert brute.same(found, brute.components(rows))


def test_jaccard_join_of_frequent_tokens(spark):
    """A large group of near copies, whose tokens are all frequent, and short frequent lines."""
    rng = random.Random(5)
    base = ["b%d" % i for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = "x%d" % rng.randrange(10**6)
        rows.append((1000 - i, " ".join(w)))
    rows += [(2000 + i, "same short line of eight words all over " + "y%d" % (i % 40)) for i in range(60)]
    found = jaccard_join.join_documents(frame(spark, rows)).collect()
    assert brute.same(found, brute.components(rows))


def test_signatures_are_complete():
    """Sets that link always share a signature, in whatever class their tokens are."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(4, 120))
        a = np.unique(rng.integers(0, 2**56, n, dtype=np.uint64))
        drop = int(rng.integers(0, max(1, n // 9) + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**56, drop, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        rare = set(rng.permutation(np.intersect1d(a, b))[: int(rng.integers(0, n))].tolist())
        signatures = []
        for s, other in ((a, b), (b, a)):
            shared = np.intersect1d(s, other)
            r = np.array(sorted(x for x in shared.tolist() if x in rare), np.uint64)
            f = np.array(sorted(x for x in shared.tolist() if x not in rare), np.uint64)
            need = len(s) + 4 * len(s) // -5 + 1 - (len(s) - len(shared))
            signatures.append(jaccard_join._signatures(len(s), r, f, need))
        assert len(np.intersect1d(*signatures))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}}


def test_repeats(spark):
    rows = corpus()
    found = repeats.remove_repeats(frame(spark, rows)).drop("kept").collect()
    assert brute.same(found, brute.kept_bytes(rows))


def test_repeats_of_the_largest_ids_and_without_ids(spark):
    """Null is above every id, and rows of one id or without one share nothing with each other."""
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(30)]
    passage = "".join(rng.choice("abcdefgh ") for _ in range(80))
    top = 2**63 - 1
    rows = [(None, t + passage) for t in texts] + [(top, texts[0] + passage), (top, "x" + passage), (top - 1, texts[1])]
    rows += [(-(2**63), texts[2][:120]), (None, None), (None, texts[3]), (None, texts[3])]
    found = repeats.remove_repeats(frame(spark, rows)).drop("kept").collect()
    assert brute.same(found, brute.kept_bytes(rows))
    assert sum(r["doc_id"] == top and r["n_removed"] == 0 for r in found) == 2


def test_repeats_of_one_common_passage(spark, monkeypatch):
    """Anchors above the limit go window by window, with the same result."""
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(120)) + line + str(i)) for i in range(40)]
    found = repeats.remove_repeats(frame(spark, rows)).drop("kept").collect()
    assert brute.same(found, brute.kept_bytes(rows))


def test_maximal_repeats_list_all_occurrences():
    common = b"x" * 3 + bytes(range(65, 117)) + b"yz"
    segments = [b"1" + common + b"2", b"3" + common + b"4", b"5" + common[:-1] + b"6"]
    found = repeats.maximal_repeats(segments, np.array([1, 2, 3]))
    whole = {length: sorted(zip(s.tolist(), o.tolist())) for length, s, o in found}
    assert whole[len(common)] == [(0, 1), (1, 1)]
    assert whole[len(common) - 1] == [(0, 1), (1, 1), (2, 1)]


def test_fingerprints(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = [*dict(rows).items()]
    found = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(frame(spark, rows), ranges=7).collect()}
    assert len(found) == len(rows)
    order = sorted(rows, key=lambda r: -r[0])
    jaccard = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    by_text = {}
    for (doc, text), (_, after) in zip(order, [*order[1:], order[0]]):
        text, after, row = text or "", after or "", found[doc]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        # All sets fit the sketch, so the estimates are exact.
        assert row["near_edited"] == pytest.approx(jaccard(brute.shingles(text), brute.shingles(edited)))
        assert row["near_next"] == pytest.approx(jaccard(brute.shingles(text), brute.shingles(after)))
        assert row["distinct_estimate"] == len(brute.shingles(text))
        assert by_text.setdefault(text, row["fingerprint"]) == row["fingerprint"]


def test_fingerprints_of_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, None), (5, "x"), (5, "x"), (5, "w")]
    assert fingerprints.fingerprint_documents(frame(spark, rows)).count() == 5
    only = fingerprints.fingerprint_documents(frame(spark, [(None, "a b")])).collect()[0]
    assert only["near_next"] == 1.0


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(4)
    words = [str(rng.randrange(10**9)) for _ in range(6000)]
    texts = [(1, " ".join(words[:3000])), (2, " ".join(words[1500:4500]))]
    df = spark.createDataFrame(texts, "k bigint, text string").select("k", fingerprints.sketch(F.col("text")).alias("sketch"))
    both = df.where("k = 1").select(F.col("sketch").alias("a")).crossJoin(df.where("k = 2").select(F.col("sketch").alias("b")))
    r = both.select(
        fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.containment(F.col("a"), F.col("b")),
        fingerprints.distinct_shingles(F.col("a")), fingerprints.merge(F.col("a"), F.col("b")),
    ).first()
    assert abs(r[0] - 1 / 3) < 0.13 and abs(r[1] - 0.5) < 0.2 and abs(r[2] / 2996 - 1) < 0.3
    merged = fingerprints.merged_sketch(df.withColumn("g", F.lit(1)), ["g"]).first()
    assert merged["sketch"] == r[3]


@pytest.mark.parametrize("operator", [
    fingerprints.fingerprint_documents, jaccard_join.join_documents, repeats.remove_repeats,
])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0
