"""Sharding, mixing, token files, packing, search, classifiers and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimweave.llm import (
    mixing, packing, personal_data, pivot_search, quality, queries, sharding, token_files, tokens,
)
from claimweave.llm.tables import new_folder
from tests.llm import brute
from tests.llm.test_documents import corpus

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, position int, taken int"


def frame(spark, rows):
    """(doc_id, text, source) rows as documents with clashing extra columns."""
    full = [(d, t, "en", s, None if t is None else len(t), "r", 1, 2) for d, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def documents(n=200, seed=1):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["a", "a", "a", "b", "é", None])) for i, (_, t) in enumerate(corpus(seed, n))]
    return [*rows, (None, "x y", "a"), rows[0], rows[0]]


# --- sharding -------------------------------------------------------------------------------


def test_interleave(spark):
    rows = documents()
    found = sharding.interleave(frame(spark, rows), tie=["doc_id", "text"]).collect()
    assert brute.same([(r.doc_id, r.text, r.source) for r in found], rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    per = Counter((r.shard, r.source) for r in found)
    for source, n in Counter(s for _, _, s in rows).items():
        counts = [per[(i, source)] for i in range(16)]
        assert max(counts) - min(counts) <= 2, (source, n, counts)
    again = sharding.interleave(frame(spark, rows[::-1]), tie=["doc_id", "text"]).collect()
    assert brute.same([(r.doc_id, r.shard, r.slot) for r in found], [(r.doc_id, r.shard, r.slot) for r in again])
    assert sharding.interleave(frame(spark, [])).count() == 0


def test_write_shards(spark):
    path = new_folder(spark, "shards")
    sharding.write_shards(sharding.interleave(frame(spark, documents(40)), shards=3), path)
    assert Counter(r["shard"] for r in spark.read.parquet(path).collect()).keys() == {0, 1, 2}


# --- mixing ---------------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held = {}
    while True:
        left = share * sum(sizes.values()) - sum(held.values())
        free = [s for s in names if s not in held]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return held | target
        held |= {s: most * sizes[s] for s in over}


def test_mix(spark):
    rows = [(d, "w " * (40 * len(t or "") % 700), s) for d, t, s in documents(150)]
    counted = frame(spark, rows).withColumn("size", mixing.word_count(F.col("text")))
    found = mixing.mix_sources(counted, "source", "size", ["doc_id"]).collect()
    assert len(found) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    targets = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix_sources(counted.orderBy(F.rand()), "source", "size", ["doc_id"]).collect()
    assert brute.same([(r.doc_id, r.taken) for r in found], [(r.doc_id, r.taken) for r in again])


def test_mix_of_many_small_sources(spark):
    rows = [(i, "w " * 5, "s%03d" % i) for i in range(200)] + [(1000 + i, "w " * 300, "t%d" % (i % 3)) for i in range(60)]
    counted = frame(spark, rows).withColumn("size", mixing.word_count(F.col("text")))
    found = mixing.mix_sources(counted, "source", "size", ["doc_id"]).collect()
    targets, taken = {r.source: r.target for r in found}, Counter()
    for r in found:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and (r.shard is None) == (r.taken == 0)
    least = min(targets.values())
    assert all(abs(taken[s] - t) <= least / 2 for s, t in targets.items())
    assert {r.shard for r in found if r.source[0] == "t" and r.taken} == {0, 1, 2, 3}


def test_mix_keeps_columns_of_its_own_names(spark):
    names = ["taken", "target", "source_size", "head", "tail", "shard", "key", "row", "words", "doc", "size"]
    rows = [(i, "a b c d e f", "s%d" % (i % 2)) for i in range(10)]
    df = frame(spark, rows)
    for name in names:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    own = out.collect()
    assert own and all(r[name] == f"{name}{r.doc_id}" for r in own for name in names)


def test_apportion_takes_highest_quotients(spark):
    rng = random.Random(6)
    targets = [rng.choice([0.0, 5.0, 10.0, rng.random() * 100]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(targets)), "rank bigint, target double")
    for house in (0, 1, 17, 400):
        quotients = sorted(((-t / (2 * k - 1), i) for i, t in enumerate(targets) if t for k in range(1, 200)))[:house]
        plain = Counter(i for _, i in quotients)
        found = {r.rank: r.n for r in mixing.apportion(df, house, "n").collect()}
        assert found == {i: plain[i] for i in range(40)}


def test_mixed_documents(spark):
    rows = [(i, " ".join("%d.%d" % (i, j) for j in range(30 + i % 50)), "s%d" % (i % 3)) for i in range(60)]
    rows += [(100, None, "s1"), (101, "", "s1")]
    df = frame(spark, rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = Counter(w for r in out.collect() for w in r.text.split())
    counted = df.withColumn("size", mixing.word_count(F.col("text"))).withColumn("mark", F.xxhash64("text"))
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(counted, "source", "size", ["doc_id", "mark"]).collect()}
    per = Counter()
    for w, n in words.items():
        per[int(w.split(".")[0])] += n
    assert per == Counter({d: n for d, n in taken.items() if n})


def test_mix_of_nothing(spark):
    assert mixing.mixed_documents(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [(1, None, None), (2, " ", "a")])).count() == 0


# --- tokens ---------------------------------------------------------------------------------

ODD = ["", "A b.", "it's", "don't, we'll.", "x\x0by\x1cz", "\xa0a\x85b", "É é ß İ Σς", "<|endoftext|> a", "<|ENDOFTEXT|>",
       "1234 5.6", "a" * 5000, "中文 mixed text", "é combining", "...,,,", "wörd., wörd", "½ ² µ ª"]


def library_ids(texts):
    coder = tokens.encoder(tokens.default_path())
    found = coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [list(x.ids) for x in found]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(4)) for _ in range(200)]
    coder = tokens.Encoder(tokens.default_path())
    for at in range(0, len(texts), 7):
        some = texts[at : at + 7]
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(some)] == library_ids(some)


def test_other_tokenizers_go_whole():
    import public_tokenizers

    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not coder.by_word
    expected = [x.ids for x in coder.tokenizer.encode_batch(ODD, add_special_tokens=False)]
    assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(ODD)] == expected


def odd_documents():
    texts = [*ODD, None, ODD[1], ODD[1], "word " * 3000]
    return [((7 * i) % 23 if i != 4 else None, t, "s") for i, t in enumerate(texts)]


def test_token_files_round_trip(spark):
    rows = odd_documents()
    folder = new_folder(spark, "tokens")
    files = token_files.write_tokens(frame(spark, rows), folder, tokens.default_path(), 2)
    found = token_files.read_documents(files, folder).collect()
    ids = library_ids([t for _, t, _ in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    start, expected = 0, []
    for i in order:
        own = [*ids[i], 2]
        expected.append((rows[i][0], start, len(own), crc(own)))
        start += len(own)
    assert brute.same(found, expected)
    assert files.agg(F.sum("tokens")).first()[0] == start
    empty = new_folder(spark, "tokens")
    assert token_files.read_documents(token_files.write_tokens(frame(spark, []), empty, tokens.default_path(), 2), empty).count() == 0


def test_packing(spark):
    rows = odd_documents() + [(100 + i, "word " * (i * 37 % 2500), "s") for i in range(60)]
    found = packing.pack_documents(frame(spark, rows)).collect()
    ids = {}
    for (doc, _, _), own in zip(rows, library_ids([t for _, t, _ in rows])):
        ids.setdefault(doc, []).append([*own, 1])
    spans = defaultdict(list)
    for r in found:
        assert any(
            len(x) == r.doc_tokens and crc(x[r.start : r.start + r.length]) == r.ids_crc32 for x in ids[r.doc_id]
        )
        spans[r.sequence_id].append((r.offset, r.offset + r.length))
    assert sum(r.length for r in found) == sum(len(x) for own in ids.values() for x in own)
    assert sorted(spans) == list(range(len(spans)))
    for own in spans.values():
        own.sort()
        assert own[0][0] == 0 and own[-1][1] <= 2048
        assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_pack_histogram_places_every_length():
    rng = random.Random(9)
    for _ in range(30):
        histogram = {rng.randrange(1, 2049): rng.randrange(1, 10**6) for _ in range(rng.randrange(0, 60))}
        patterns = packing.pack_histogram(histogram)
        placed = Counter()
        for count, lengths in patterns:
            assert sum(lengths) <= 2048 and count > 0
            for x in lengths:
                placed[x] += count
        assert placed == Counter(histogram)


# --- search ---------------------------------------------------------------------------------


def plain_search(rows, k=5):
    clean = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, v in {(i, tuple(v)) for i, v in clean if i % 3 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in clean if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return out


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(150)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]
    rows += [(3001, None), (3003, [float("nan")] * 6), (3006, [None] * 6), (3009, [float("inf")] * 6), (None, [1.0] * 6),
             (3012, [1.0, 2.0]), (3015, []), rows[5], (3018, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = pivot_search.search(df, F.col("vec_id") % 3 == 0, pivots=9).collect()
    assert brute.same(found, plain_search(rows))


def test_search_of_little(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(0, [1.0])], [(0, None)], [(0, [])]):
        assert pivot_search.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 3 == 0).count() == 0


# --- personal data --------------------------------------------------------------------------

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 12 <= len(digits) <= 19 and personal_data.luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    bits = ["a", "b1", "@", ".", "-", "1", "23", "+", "(", ")", " ", "_", "%", "x@y.z", "1.2.3.4", "é", "255", "0300",
            "4111 1111 1111 1111", "+1 (609) 555-7932", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 10**6, "1" * 10**6, "a@" * 10**5, "+" * 10**6, "1.2." * 10**5):
        personal_data.base_spans(text)


def card(rng):
    digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(digits + str(d) for d in range(10) if personal_data.luhn(digits + str(d)))


def test_picks_hidden_spans_and_keeps_base_ones(spark):
    rng = random.Random(7)
    texts = []
    for i in range(900):
        number = str(rng.randrange(10**15, 10**16))
        number = number if not personal_data.luhn(number) else number[:-1] + str((int(number[-1]) + 1) % 10)
        texts.append(rng.choice([
            f"pay {card(rng)} now", f"mail bob{i}@host{i}.example.com today", f"host 10.{i % 256}.3.4 up",
            f"call +1 (609) 555-{i % 10000:04d} now", f"number {number} is none", f"version 1.{i}.3 of 2020", "plain words",
        ]))
    hidden = f"ref 12 {card(rng)} end"
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(5000, hidden, "s"), (5001, None, "s"), (5002, "", "s")]
    df = frame(spark, rows)
    picker = personal_data.fit(df)
    found = {r.doc_id: r for r in personal_data.find(df, picker).collect()}
    for doc, text, _ in rows:
        base = ",".join("%s:%d:%d" % s for s in plain_spans(text or ""))
        assert set(filter(None, base.split(","))) <= set(found[doc].spans.split(","))
    assert "card:7:23" in found[5000].spans
    wrong = [found[d].spans for d, t, _ in rows if t and ("is none" in t or "version" in t or t == "plain words") and found[d].spans]
    assert not wrong
    clean = {r.doc_id: r for r in personal_data.redact(df, picker).collect()}
    assert clean[5000].text == "ref 12 <CARD> end" and clean[5000].n_chars == 17
    assert clean[5001].text is None and clean[5000].row == "r"
    assert personal_data.redact(df, picker).columns == df.columns
    nothing = frame(spark, [])
    assert personal_data.find(nothing, personal_data.fit(nothing)).count() == 0


def test_every_text_is_learned_from(spark):
    # The base spans lie only in the texts whose ids hash highest, behind 20,000 others.
    rng = random.Random(4)
    spans = [f"pay {card(rng)} now" for _ in range(60)] + [f"number {rng.randrange(10**15, 10**16)} is none" for _ in range(60)]
    order = spark.range(20_200).orderBy(F.desc(F.xxhash64(F.lit(9), "id"))).limit(len(spans)).collect()
    held = spark.createDataFrame([(r.id, t) for r, t in zip(order, spans)], "id bigint, held string")
    texts = spark.range(20_200).join(held, "id", "left")
    df = texts.select(F.col("id").alias("doc_id"), F.coalesce("held", F.lit("plain words")).alias("text"))
    picker = personal_data.fit(df)
    assert picker.trees is not None
    text = f"ref 12 {card(rng)} end"
    assert picker.added(text, personal_data.base_spans(text)) == [("card", 7, 23)]


def test_trees_are_the_same_by_spark_and_in_the_driver(spark, monkeypatch):
    rng = random.Random(6)
    texts = [f"pay {card(rng)} now, call +1 (609) 555-{i:04d}" for i in range(40)] + [f"on 2020-11-12 1{i % 10} it was 1.{i}.3.9.4" for i in range(40)]
    df = frame(spark, [(i, t, "s") for i, t in enumerate([*texts, *texts[:5], None, ""])])
    found = personal_data.examples(df)
    cuts = personal_data.feature_cuts(found)
    one = personal_data.binned(found, cuts)
    monkeypatch.setattr(personal_data, "FEW_ROWS", 0)
    passes = personal_data.binned(found.repartition(5), cuts)
    assert one.blocks and passes.blocks is None
    rounds = personal_data.boost
    monkeypatch.setattr(personal_data, "boost", lambda *a, **k: rounds(*a, **k | {"rounds": 3}))
    picker = personal_data.learn(one, cuts)
    assert len(picker.trees.trees) == 3 and picker == personal_data.learn(passes, cuts)
    # equal texts count as often as they occur
    assert found.agg(F.sum("n")).first()[0] == sum(len(personal_data.marked(t)) for t in [*texts, *texts[:5]])


def test_bins_keep_the_order_of_values():
    values = np.array([0, 1, 255, 999, 1000, 1009, 1010, 9999, 10_000, 10_099, 10_100, 999_999])
    edges = personal_data._edges(values)
    assert edges.tolist() == [0, 1, 255, 999, 1009, 1009, 1019, 9999, 10_099, 10_099, 10_199, 999_999]
    cuts = [np.array([1, 1009, 10_099])] * personal_data.FEATURES
    bins = personal_data._bins(np.repeat(values[:, None], personal_data.FEATURES, 1), cuts)[:, 0]
    for at, cut in enumerate(cuts[0]):
        assert ((bins <= at) == (values <= cut)).all()


# --- quality --------------------------------------------------------------------------------


def test_few_base_spans_teach_every_hidden_form(spark):
    rng = random.Random(3)
    names = ["bob", "ann.lee", "carla7", "d.moor", "eve_k", "frank"]

    def number(n):
        return "".join(str(rng.randrange(1, 10)) for _ in range(n))

    def quad():
        return ".".join(str(rng.randrange(1, 256)) for _ in range(4))

    texts = []
    for i in range(16):
        texts += [f"pay {card(rng)} now", f"mail {rng.choice(names)}@host{i}.example.com today", f"host {quad()} up",
                  f"call +{rng.randrange(1, 10)} ({number(3)}) {number(3)}-{number(4)} now",
                  "we met at noon. Then (at) last", f"on 2020-1{i % 3}-12 1{i % 10} it ended"]
    hidden = [("card", "ref 12 ", card(rng), " end"), ("ip", "node 999.", quad(), " up"),
              ("phone", "call ", f"1 ({number(3)}) {number(3)}-{number(4)}", " now"),
              ("email", "mail ", "greta (at) host3 (dot) example (dot) com", " today")]
    rows = [(i, t, "s") for i, t in enumerate([*texts, *("".join(h[1:]) for h in hidden)])]
    df = frame(spark, rows)
    found = {r.doc_id: r.spans for r in personal_data.find(df, personal_data.fit(df)).collect()}
    for i, (kind, before, span, _) in enumerate(hidden, len(texts)):
        assert found[i] == f"{kind}:{len(before)}:{len(before + span)}", rows[i]
    for i, text in enumerate(texts):
        assert found[i] == ",".join("%s:%d:%d" % s for s in plain_spans(text)), text


def test_negative_risk_separates_junk():
    rng = np.random.default_rng(5)
    good, junk = rng.normal(0, 1, (3000, 4)), rng.normal(3, 1, (700, 4))
    model = quality.train(good[:800], np.concatenate([good[800:], junk]), 0.76)
    fresh, bad = model.scores(rng.normal(0, 1, (500, 4))), model.scores(rng.normal(3, 1, (500, 4)))
    assert (fresh >= 0.3).mean() > 0.97 and (bad < 0.3).mean() > 0.9


@pytest.mark.parametrize("prior, shift", [(0.4, 0.0), (0.9, 3.0), (None, 0.0)])
def test_risk_and_its_gradient(prior, shift):
    """Both branches against the sums written out and against differences."""
    rng = np.random.default_rng(2)
    w = [rng.normal(0, 1, s) for s in ((3, 5), 5, 5, 1)]
    w[3] -= 2 * shift
    p, u = rng.normal(shift, 1, (7, 3)), rng.normal(0, 1, (11, 3))

    def plain():
        score = lambda x: 1 / (1 + math.exp(-(sum(
            math.tanh(sum(x[i] * w[0][i][j] for i in range(3)) + w[1][j]) * w[2][j] for j in range(5)) + w[3][0])))
        good = sum(-math.log(score(x)) for x in p) / len(p)
        junk = sum(-math.log(1 - score(x)) for x in u) / len(u)
        if prior is None:
            return good + junk
        rest = junk - prior * sum(-math.log(1 - score(x)) for x in p) / len(p)
        return prior * good + rest if rest >= 0 else -rest

    value, grads = quality.risk(w, p, u, prior)
    assert value == pytest.approx(plain())
    for array, grad in zip(w, grads):
        for at in np.ndindex(array.shape):
            array[at] += 1e-5
            above = plain()
            array[at] -= 2e-5
            below = plain()
            array[at] += 1e-5
            assert grad[at] == pytest.approx((above - below) / 2e-5, abs=1e-6)


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.8, 1.0])
def test_prior_from_positives_and_unlabelled(prior):
    rng = np.random.default_rng(9)
    n = int(4000 * prior)
    u = np.concatenate([rng.normal(0, 1, (n, 4)), rng.normal(3, 1, (4000 - n, 4))])
    found = quality.estimate_prior(rng.normal(0, 1, (2000, 4)), u[rng.permutation(len(u))])
    assert abs(found - prior) < 0.06


def test_one_row_of_a_repeated_id_trains(spark, monkeypatch):
    """Copies of one id neither fill the sample nor reach the driver."""
    words = [(i, " ".join(f"w{i * j % 97}" for j in range(30)), "a") for i in range(60)]
    labels = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "UNLABELLED", 40)
    once = quality.fit(frame(spark, words), labels)
    again = quality.fit(frame(spark, words + words[:1] * 500 + words[7:8] * 500), labels)
    assert all((a == b).all() for a, b in zip(once.weights, again.weights))


def test_quality_on_held_out_labels(spark, data):
    folder = data.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = queries.QUERIES["op4_quality"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    good, junk = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.predicted for r in good) / len(good) > 0.99
    assert sum(r.predicted for r in junk) / len(junk) < 0.05


def test_quality_of_odd_tables(spark):
    df = frame(spark, [(1, None, "a"), (None, "", "a"), (2, "some words here", "a")])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r.score for r in quality.score(df, quality.fit(df, none)).collect()] == [1.0] * 3
    some = spark.createDataFrame([(i, 1 if i % 2 else None) for i in range(20)] + [(1, 0), (None, 1)], "doc_id bigint, quality int")
    scored = quality.score(df.withColumn("score", F.lit(7)), quality.fit(df, some))
    assert scored.columns == [*df.columns, "score"]
    assert quality.keep_good(frame(spark, []), some).count() == 0


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, path = docs.columns, None
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == columns, name
        path = new_folder(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    good, first, clean = (kept[k] for k in ("quality_classifier", "ngram_jaccard_join", "personal_data"))
    plain = {d: c for d, _, c in brute.components(sorted(good.items()))}
    assert set(first) == {d for d, c in plain.items() if d == c}
    assert set(clean) == set(first)
    assert not any(plain_spans(t) for t in clean.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    ids = library_ids([r.text for r in docs.collect()])
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(x) + 1 for x in ids)


def test_one_row_of_a_group_stays(spark):
    def prose(i, n=60):
        return " ".join(f"w{i}x{j}" for j in range(n))

    near = prose(1) + " more"
    rows = [
        (5, prose(0), "a"), (5, prose(0), "a"), (5, prose(0), "b"),  # repeated rows
        (2, prose(1), "a"), (None, near, "a"), (None, prose(1), "a"),  # null ids beside one
        (None, prose(2), "a"), (None, prose(2), "a"), (None, prose(2) + " more", "a"),  # null ids only
        (7, prose(3), "a"), (7, prose(4), "a"), (6, prose(4), "a"),  # one id, two texts
        (None, prose(5), "a"), (None, "", "a"), (None, None, "a"), (8, "  ", "a"),
    ]
    docs = frame(spark, rows)
    kept = corpus_pipeline.keep_first_copies(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    of_two = [(None, t) for t in (prose(2), prose(2) + " more") if (None, t) in found]
    assert len(of_two) == 1
    rest = [(5, prose(0)), (2, prose(1)), (7, prose(3)), (6, prose(4)), (None, prose(5)), (None, ""), (None, None), (8, "  ")]
    assert found == sorted(rest + of_two, key=str)
