import math
import random
import re
from collections import Counter
from glob import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimweave.operators import candidates, cleaning, evaluation, inverted, lexical, profiling, rerank, vectors, verdict
from claimweave.plans import retrieval, verification, views
from claimweave.scale import _range_keys, number_rows, with_row_index
from claimweave.schema import SchemaMismatch, require_columns
from claimweave.sources import index_store, tables


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- sources, cleaning, profile -----------------------------------------------------------


def test_csv_round_trip_keeps_quotes_and_newlines(spark, tmp_path):
    data = [(1, "u", 'say "hi"\nnow', "a,b\\c  ", 1), (2, "", "हिन्दी", "x", 0)]
    df = spark.createDataFrame(data, "article_id bigint, url string, title string, content string, label int")
    tables.write_articles(df, f"{tmp_path}/csv", f"{tmp_path}/pq")
    back = tables.read_articles_csv(spark, f"{tmp_path}/csv")
    assert rows(back, "article_id", "title", "content", "label") == rows(df, "article_id", "title", "content", "label")
    # blank text reads back as null from CSV, and stays blank in Parquet
    assert back.where("article_id = 2").first()["url"] is None
    assert spark.read.parquet(f"{tmp_path}/pq").where("article_id = 2").first()["url"] == ""


def test_byte_order_mark_and_fallback(spark, tmp_path):
    (tmp_path / "a.csv").write_text('article_id,url,title,content,label\n"7","u","t","c","1"\n', encoding="utf-8-sig")
    df = tables.read_first_available(spark, [f"{tmp_path}/none.csv", f"{tmp_path}/a.csv"])
    assert rows(df, "article_id", "label") == [(7, 1)]
    with pytest.raises(Exception):
        tables.read_first_available(spark, [f"{tmp_path}/none.csv"])


def test_cleaning(spark):
    raw = [
        (" u ", " t ", "c", "1"), (" u ", " t ", "c", "1"), ("u", "t", "c", "1"), ("v", None, " d", "1.0"),
        ("w", "t", "c", "x"), ("x", "t", "c", None), ("y", "t", "c", "0.9"),
    ]
    df = spark.createDataFrame(raw, "URL string, TITLE string, CONTENT string, BOOL string")
    out = cleaning.clean_articles(df)
    # rows that differ only in outer white space survive
    assert rows(out, "url", "title", "content", "label") == [
        ("u", "t", "c", 1), ("u", "t", "c", 1), ("v", "", "d", 1), ("y", "t", "c", 0),
    ]
    assert rows(out, "article_id") == [(1,), (2,), (3,), (4,)]
    assert tuple(cleaning.duplicate_stats(df).first()) == (7, 6, 1)


def test_row_index_over_many_ranges(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"))
    out = with_row_index(df, [F.desc("k")], "n").collect()
    assert sorted((r["n"], r["k"]) for r in out) == [(i + 1, 4999 - i) for i in range(5000)]


@pytest.fixture
def many_ranges(spark):
    """Small inputs keep all their shuffle partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, old)


def test_numbers_of_texts_with_common_beginnings(spark, many_ranges):
    rng = random.Random(4)
    long = "same beginning " * 50
    urls = [None, "", "a", "b" * 64, "b" * 65, "b" * 70 + "x", long, long + "\u00e9", long + "z"]
    table = [
        (rng.choice(urls), rng.choice([None, "t", long]) or None, long + str(rng.randrange(300)), rng.randrange(2))
        for _ in range(1500)
    ]
    df = spark.createDataFrame(table, "url string, title string, content string, label int").repartition(5)
    plain = sorted(table, key=lambda r: [(x is not None, x.encode() if isinstance(x, str) else x or 0) for x in r])
    found = number_rows(df, df.columns, "n", start=0, width=4).collect()
    assert [tuple(r)[:4] for r in sorted(found, key=lambda r: r["n"])] == plain
    assert sorted(r["n"] for r in found) == list(range(1500))
    assert number_rows(df.limit(0), df.columns, "n").collect() == []


def test_range_keys_hold_no_whole_text(spark, many_ranges):
    """One long beginning in all rows: the first exchange still spreads them."""
    long = "x" * 5000
    df = spark.range(2000).select(F.concat(F.lit(long), F.col("id").cast("string")).alias("text"))
    ranges = df.repartitionByRange(*_range_keys(df, ["text"], 64), F.xxhash64("text")).groupBy(F.spark_partition_id()).count()
    assert ranges.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = number_rows(df, ["text"], "n").select("n", F.substring("text", 5001, 9).alias("t")).orderBy("n").collect()
    assert [r["t"] for r in out] == sorted(str(i) for i in range(2000))


def test_profile_checks(spark, data):
    articles = views.articles(spark, data)
    n = articles.count()
    assert profiling.assert_row_count(articles, n) == n
    with pytest.raises(profiling.RowCountMismatch):
        profiling.assert_row_count(articles, n + 1)
    with pytest.raises(SchemaMismatch, match="content"):
        require_columns(articles.drop("content"))
    audit = profiling.dataset_audit(views.labelled_articles(spark, data)).first()
    assert audit["status"] == "PASS" and sum(audit["label_distribution"].values()) == audit["row_count"]
    assert profiling.dataset_audit(articles).first()["status"] == "FAIL"
    inline = spark.createDataFrame([("a", "FAKE"), ("b", "REAL"), ("c", "FAKE")], "title string, label string")
    assert rows(profiling.label_distribution(inline), "label", "count") == [("FAKE", 2), ("REAL", 1)]


def test_reports_derive_from_one_record(spark, data):
    from claimweave.plans.profile import reports

    articles = views.articles(spark, data)
    whole = reports(articles, articles.count())
    single = {
        "label_distribution": profiling.label_distribution, "label_statistics": profiling.label_statistics,
        "length_statistics": profiling.length_statistics, "data_quality": profiling.data_quality,
    }
    for name, alone in single.items():
        assert whole[name].columns == alone(articles).columns
        assert [tuple(r) for r in whole[name].collect()] == [tuple(r) for r in alone(articles).collect()], name
    with pytest.raises(profiling.RowCountMismatch):
        reports(articles, 1)
    empty = reports(articles.limit(0), 0)
    assert tuple(empty["length_statistics"].first()) == (None,) * 4
    assert tuple(empty["data_quality"].first()) == (0,) * 5


# --- index and scores against brute force -------------------------------------------------


def tiny(spark):
    texts = ["the cat sat on the mat", "the cat ran", "a dog ran off", "the dog sat", "cats and dogs"]
    data = [(i, "", t, t * 2, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "article_id bigint, url string, title string, content string, label int")


def test_char_counts(spark):
    got = {(r["article_id"], r["term"]): r["tf"] for r in lexical.char_postings(tiny(spark)).collect()}
    want = {}
    for r in tiny(spark).collect():
        t = " ".join(f"{r['title']} {r['title']} {r['content']}".lower().split())
        for n in (3, 4, 5):
            for term, tf in Counter(t[i : i + n] for i in range(len(t) - n + 1)).items():
                want[(r["article_id"], term)] = tf
    assert got == want


def plain_terms(rows, channel):
    out = {}
    for key, text in rows:
        text = (text or "").lower()
        if channel == "char":
            text = re.sub(r"\s{2,}", " ", text)
            terms = [text[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)]
        else:
            words = re.findall(r"\w{2,}", text)
            terms = words + [" ".join(p) for p in zip(words, words[1:])]
        for term in terms:
            out[(key, term)] = out.get((key, term), 0) + 1
    return out


def odd_texts():
    rng = random.Random(5)
    words = ["the", "cat", "  ", "naïve", "\U0001f600", "日本語", "x", "\x00", "sat\n\non", "हिन"]
    some = [(rng.choice([None, 1, 2, 3, 4, 5]), " ".join(rng.choices(words, k=rng.randrange(9)))) for _ in range(60)]
    return some + [(6, "ab"), (7, ""), (8, None), (9, "cat \U0001f600 cat")]


@pytest.mark.parametrize("chunk", [1, 40, 1 << 16])
def test_term_lists_of_repeated_ids_and_odd_texts(spark, chunk):
    data = odd_texts()
    texts = lexical.dealt(spark.createDataFrame(data, "article_id bigint, search_text string"))
    for channel in ("char", "word"):
        if channel == "word":  # without combining marks, where Python's word differs
            data = [(k, t and t.replace("हिन", "on")) for k, t in data]
            texts = lexical.dealt(spark.createDataFrame(data, "article_id bigint, search_text string"))
        lists = lexical.term_lists(texts, channel, chunk_chars=chunk).collect()
        found = [((r.article_id, t), n) for r in lists for t, n in zip(r.terms, r.tfs)]
        assert len(found) == len(dict(found)) and all(r.terms for r in lists)
        assert dict(found) == plain_terms(data, channel)


def test_runs_of_a_large_alphabet(monkeypatch):
    monkeypatch.setattr(lexical, "KEY_LIMIT", 1)
    texts = [" ".join((t or "").split()) for _, t in odd_texts()]
    found = {}
    for of, terms, tf in lexical.char_counts(texts, np.arange(len(texts))):
        found |= {(o, t): n for o, t, n in zip(of.tolist(), terms.to_pylist(), tf.tolist())}
    assert found == plain_terms(enumerate(texts), "char")


def test_lists_have_a_largest_size(monkeypatch):
    monkeypatch.setattr(lexical, "LIST_TERMS", 3)
    (of, terms, tf), *_ = lexical.char_counts(["abcdefgh", "xyz"], np.arange(2))
    rows = lexical._lists(pa.array([5, 6]), of, terms, tf).to_pylist()
    assert [(r["key"], len(r["terms"])) for r in rows] == [(5, 3), (5, 3), (6, 1)]


def test_postings_are_summed_without_a_row_each(spark, data):
    from checks.registry import QUERIES

    for name in ("index_char_postings", "index_word_postings"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan, name


def test_tfidf_and_cap(spark):
    counts = lexical.word_postings(tiny(spark))
    vocabulary = lexical.fit_vocabulary(counts, 5, "word")
    v = {r["term"]: r for r in vocabulary.collect()}
    assert v["the"]["df"] == 3 and math.isclose(v["the"]["idf"], math.log(6 / 4) + 1)
    weights = lexical.tfidf(counts, vocabulary)
    norms = weights.groupBy("article_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert all(math.isclose(r["n"], 1.0) for r in norms)
    terms = lexical.document_frequency(counts)
    best = sorted(terms.collect(), key=lambda r: (-r["total"], r["term"]))[:4]
    assert rows(lexical.cap_vocabulary(terms, 4), "term") == sorted((r["term"],) for r in best)


def test_vocabulary_is_whole_unless_capped(spark, monkeypatch):
    # As many terms as the preset and one more.
    n = lexical.FIXED_TERMS["char"] + 1
    counts = spark.range(3 * n).select(
        (F.col("id") % 3).alias("article_id"), (F.col("id") / 3).cast("bigint").cast("string").alias("term"), F.lit(1).alias("tf")
    )
    whole = lexical.fit_vocabulary(counts, 3, "char")
    assert whole.count() == n
    assert lexical.fit_vocabulary(counts, 3, "char", lexical.FIXED_TERMS["char"]).count() == n - 1
    few = counts.where("term < '1005'")
    terms = whole.where("term < '1005'").withColumn("salts", F.when(F.col("term") == "1", 3).otherwise(1))

    def weights():
        return rows(lexical.tfidf(few, terms).withColumn("w", F.round("w", 8)), "article_id", "term", "w", "salts")

    small = weights()
    monkeypatch.setattr(lexical.measure(terms).__class__, "fits", lambda *a, **k: False)
    assert weights() == small and small


def test_vector_topk_blocks(spark, data, monkeypatch):
    own = views.article_vectors(spark, data)
    asked = own.select(F.col("article_id").alias("query_id"), "embedding", F.col("article_id").alias("exclude_article_id"))
    small = rows(vectors.best_scores(asked, own, 5), "query_id", "rank", "article_id")
    monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", 64)
    monkeypatch.setattr("claimweave.scale.Measured.fits", lambda *a, **k: False)
    assert rows(vectors.best_scores(asked, own, 5), "query_id", "rank", "article_id") == small
    table = {r["article_id"]: r["embedding"] for r in own.collect()}
    for q in list(table)[:10]:
        score = {a: round(sum(x * y for x, y in zip(table[q], e)), 8) for a, e in table.items() if a != q}
        best = sorted(score, key=lambda a: (-score[a], a))[:5]
        assert [a for query, _, a in small if query == q] == best


def test_a_pair_of_blocks_holds_few_scores():
    import tracemalloc

    rng, n, m = np.random.default_rng(3), 2048, 10_000
    pa = inverted.pa

    def packed(values, kind):
        return pa.array([values], pa.list_(kind))

    asked, articles = rng.random((n, 8)), rng.random((m, 8)).astype("f4")
    batch = pa.RecordBatch.from_arrays(
        [packed(np.arange(n), pa.int64()), packed([None] * n, pa.int64()), packed(asked.ravel(), pa.float64()), packed(np.arange(m), pa.int64()),
         packed(articles.ravel(), pa.float32())], ["queries", "excluded", "asked", "ids", "vectors"])
    tracemalloc.start()
    found = next(vectors._block_topk(3)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    scores = np.round(asked @ articles.astype("f8").T, 8)
    want = [a for line in scores for a in np.lexsort((np.arange(m), -line))[:3].tolist()]
    assert found.column("article_id").to_pylist() == want
    assert peak < 60e6  # all scores at once are 164 MB, and twice that when rounded


def test_identity_hits_equal_plain_search(spark, data, index):
    prepared = candidates.prepare_claims(views.claims(spark, data)).cache()
    a = rows(candidates.identity_hits(prepared, index), "claim_id", "article_id", "hits")
    assert a
    found = Counter()
    texts = index.windows.collect()
    for c in prepared.collect():
        for w in texts:
            n = sum(v in f"{w['title_n']} {w['identity_content']}" for v in c["identity_variants"])
            if n:
                found[(c["claim_id"], w["article_id"], n)] += 1
    assert a == sorted(found)


def test_char_lists_of_large_alphabets(monkeypatch):
    texts = ["abcab", "", "ab", "\x00\x00a\x00", "नमस्ते नमस्ते", "😀😀😀b"]
    want = {}
    for i, t in enumerate(texts):
        for n in (3, 4):
            for term, tf in Counter(t[j : j + n] for j in range(len(t) - n + 1)).items():
                want[(term, i)] = tf

    def got():
        out = {}
        for terms, cuts, at, tf in inverted.char_lists(texts, (3, 4)):
            for k, term in enumerate(terms):
                out |= {(term, int(a)): int(n) for a, n in zip(at[cuts[k] : cuts[k + 1]], tf[cuts[k] : cuts[k + 1]])}
        return out

    assert got() == want
    # as with an alphabet too large for keys of one number
    monkeypatch.setattr(inverted, "KEY_LIMIT", 0)
    assert got() == want


def test_scores_stop_early_without_changing_the_best():
    rng = np.random.default_rng(1)
    size, depth = 400, 10
    rows = []
    for n in [*rng.integers(1, 60, 150), *rng.integers(150, 400, 12)]:
        at = np.sort(rng.choice(size, n, replace=False))
        rows.append((at, rng.random(n) * (0.02 if n > 100 else 1.0), np.array([0, 2]), rng.random(2)))
    full = np.zeros((3, size))
    for at, w, claim, q in rows:
        full[np.ix_(claim, at)] += np.outer(q, w)
    scores = inverted._Scores(3, size, rows)
    scores.add_rare()
    scores.drop_hopeless(depth, np.zeros(size, bool))
    assert 0 < scores.kept.sum() < size
    scores.add_frequent(scores.kept)
    for claim in (0, 2):
        best = scores.best(claim, depth)
        assert best.tolist() == np.argsort(-full[claim], kind="stable")[:depth].tolist()
        assert np.allclose(scores.sums[claim, best], full[claim, best])
    assert len(scores.best(1, depth)) == 0


def test_one_article_with_every_claim_lies_on_several_tasks(spark, index):
    pairs = spark.range(200).select(F.col("id").alias("claim_id"), F.lit(5).cast("bigint").alias("article_id"))
    pairs = pairs.unionByName(spark.createDataFrame([(1, 6), (2, 7)], "claim_id bigint, article_id bigint"))
    table = index.articles.select("article_id", "title")
    spread = candidates.attach_by_article(pairs, table, 10)
    assert rows(spread, "claim_id", "article_id", "title") == rows(pairs.join(table, "article_id"), "claim_id", "article_id", "title")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = spread.where("article_id = 5").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def test_hot_terms_are_salted_without_changing_scores(spark, data, index):
    prepared = candidates.prepare_claims(views.claims(spark, data)).cache()
    weights = candidates.claim_term_weights(prepared, index, "char", char_original="q_original")
    plain = lexical.lexical_scores(weights, index.channel_postings("char"), ["char_original"], True)
    split = index.vocabulary_char.select("term", F.ceil(F.col("df") / 20).cast("int").alias("salts"))

    def salted(df):
        return df.drop("salts").join(split, "term")

    again = lexical.lexical_scores(salted(weights), salted(index.channel_postings("char")), ["char_original"], False)
    a, b = (rows(x, "claim_id", "article_id", F.round("char_original", 6)) for x in (plain, again))
    assert split.agg(F.max("salts")).first()[0] > 1
    assert a == b


def test_packed_lists_give_positions_and_counts_back():
    lists = [([3, 700, 701, 8191], [1, 1, 1, 1]), ([0], [1]), ([0, 2], [1, 255]), ([5, 6, 9], [1, 256, 70_000])]
    cuts = np.r_[0, np.cumsum([len(at) for at, _ in lists])]
    at, tf = (np.concatenate([x[i] for x in lists]).astype("<u4") for i in (0, 1))
    packed_at, packed_tf = inverted._packed(at, tf, cuts)
    assert [len(x) for x in packed_tf.to_pylist()] == [0, 0, 2, 12]
    table = inverted.pa.table({"at": packed_at, "tf": packed_tf, "n": np.diff(cuts)})
    n = table.column("n").to_numpy()
    assert inverted._positions(table.column("at"), n).tolist() == at.tolist()
    assert inverted._counts(table.column("tf"), n).tolist() == tf.tolist()


def test_index_stores_texts_once_and_no_weights(spark, data, index, tmp_path, monkeypatch):
    assert "w" not in index.lists.columns
    weights = rows(index.channel_postings("word"), "article_id", "term", F.round("w", 9))
    total = index.channel_postings("char").groupBy("article_id").agg(F.round(F.sum(F.col("w") * F.col("w")), 9).alias("n"))
    assert {r["n"] for r in total.collect()} == {1.0}
    # a large vocabulary is joined by a shuffle, sums are passed on early, chunks are small
    monkeypatch.setattr(inverted, "SMALL_VOCABULARY", 0)
    monkeypatch.setattr(inverted, "HELD_SUMS", 10)
    kept = spark.sparkContext.getCheckpointDir()
    before = set(glob(f"{kept.removeprefix('file:')}/*/*counts*"))
    path = str(tmp_path / "index")
    index_store.save_index(views.articles(spark, data), views.article_vectors(spark, data), path, 3, chunk_chars=20_000)
    again = index_store.load_index(spark, path)
    assert rows(again.channel_postings("word"), "article_id", "term", F.round("w", 9)) == weights
    assert set(glob(f"{kept.removeprefix('file:')}/*/*counts*")) == before
    stored = spark.read.parquet(f"{path}/windows").columns
    assert "entity_w" in stored and "event_w" not in stored and "fact_w" not in stored
    assert rows(again.windows, "article_id", "event_w", "fact_w", "event_digits") == rows(
        index_store.article_windows(views.articles(spark, data)), "article_id", "event_w", "fact_w", "event_digits")


def test_reported_scores_are_those_of_single_postings(spark, data, index):
    prepared = candidates.prepare_claims(views.claims(spark, data)).cache()
    weights = candidates.claim_term_weights(prepared, index, "word", word_original="q_original", word_claim="q_claim")
    plain = lexical.lexical_scores(weights, index.channel_postings("word"), ["word_original", "word_claim"], True)
    names = ("word_original", "word_claim")
    a, b = (rows(x, "claim_id", "article_id", *[F.round(n, 6) for n in names]) for x in (plain, candidates.word_scores(prepared, index)))
    assert a and a == b
    # single postings never cross a shuffle
    plan = candidates.word_scores(prepared, index)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" in plan and "SortMergeJoin [term" not in plan


def test_claims_with_enough_articles_check_no_single_hits(spark, data, index):
    prepared = candidates.prepare_claims(views.claims(spark, data)).cache()
    whole = candidates.identity_candidates(prepared, index, 10**9).collect()
    for limit in (1, 7):
        best = {}
        for r in sorted(whole, key=lambda r: (-r["hits"], r["article_id"])):
            best.setdefault(r["claim_id"], []).append((r["claim_id"], r["article_id"], r["hits"]))
        want = sorted(x for some in best.values() for x in some[:limit])
        assert rows(candidates.identity_candidates(prepared, index, limit), "claim_id", "article_id", "hits") == want


def test_retrieval_invariants(spark, data, index, monkeypatch):
    claims, claim_vectors = views.claims(spark, data), views.claim_vectors(spark, data)
    found = retrieval.retrieve(claims, claim_vectors, index).cache()
    columns = ("claim_id", "retrieval_rank", "article_id", "relevance")
    # small blocks of claims, joins by shuffle and articles spread over tasks give the same rows
    monkeypatch.setattr(inverted, "CLAIMS", 7)
    monkeypatch.setattr(inverted, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(candidates.attach_by_article, "__defaults__", (3, "claim_id"))
    again = retrieval.retrieve(claims, claim_vectors, index)
    assert rows(found, *columns) == rows(again, *columns)
    # one claim alone ranks as in the batch
    one = claims.where("claim_id = -1")
    assert rows(retrieval.retrieve(one, claim_vectors, index), *columns) == rows(found.where("claim_id = -1"), *columns)
    # a claim never retrieves its own article
    own = found.join(claims.select("claim_id", "exclude_article_id"), "claim_id")
    assert own.where("article_id = exclude_article_id").count() == 0
    evidence = verification.find_evidence(claims, claim_vectors, index).collect()
    assert all(0 <= r["evidence_score"] <= 1 for r in evidence)
    ranks = {}
    for r in evidence:
        ranks.setdefault(r["claim_id"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 3 for v in ranks.values())


def test_verbatim_passages_are_found(spark, data, index):
    claims = views.question_claims(spark, data)
    articles = views.articles(spark, data)
    verbatim = claims.join(articles, F.contains("content", "claim")).select("claim_id", "article_id")
    found = retrieval.retrieve(claims, views.claim_vectors(spark, data), index)
    hit = verbatim.join(found, ["claim_id", "article_id"], "left_semi")
    claims_with = verbatim.select("claim_id").distinct().count()
    assert claims_with > 0 and hit.select("claim_id").distinct().count() == claims_with


def test_blank_claims_are_rejected(spark, data, index):
    claims = views.question_claims(spark, data)
    blank = claims.limit(1).withColumn("claim", F.lit("  ")).withColumn("claim_id", F.lit(-999).cast("bigint"))
    done = verification.verify(claims.unionByName(blank), views.claim_vectors(spark, data), index)
    assert [tuple(r) for r in done.rejected.collect()] == [(-999, "empty claim")]
    assert done.prompts.count() == claims.count()


# --- reranking on a hand-computed pair ----------------------------------------------------


def test_rerank_pair(spark):
    schema = (
        "claim_id bigint, evidence_id string, article_id bigint, title string, content string, semantic_score double, "
        "lexical_score double, claim_lexical_score double, phrase_match_score double, entity_match_score double, "
        "number_date_match_score double, relevance_score double, evidence_type string"
    )
    pair = [
        (1, "E1", 1, "India GDP growth fact check: viral claim is false", "Fact check shows that the viral claim about India's GDP growth is false.",
         0.70, 0.55, 0.60, 0.45, 0.80, 0.50, 0.75, "FACT_CHECK_FALSE"),
        (1, "E2", 2, "India wins cricket tournament", "India won an important cricket tournament.",
         0.25, 0.02, 0.01, 0.0, 0.50, 0.0, 0.10, "NEWS"),
    ]
    query = spark.createDataFrame([(1, "India GDP growth viral claim is false")], "claim_id bigint, claim string")
    first, second = rerank.rerank(spark.createDataFrame(pair, schema), query).orderBy("rank").collect()
    # all query words are in the first title and content
    assert first["claim_match"] == 1.0 and first["directness_score"] == 1.0 and first["fact_check_score"] == 1.0
    expected = 0.15 * 0.7 + 0.10 * 0.55 + 0.22 + 0.15 * 0.45 + 0.15 * 0.8 + 0.09 * 0.5 + 0.10 + 0.04
    assert math.isclose(first["evidence_score"], round(expected, 4), abs_tol=1e-9)
    assert first["strong_evidence"] and first["evidence_type"] == "FACT_CHECK_FALSE" and first["retriever_relevance"] == 0.75
    # stopwords leave gdp, growth, viral, is, false: none of them is in the second article
    assert second["claim_match"] == 0.01 and math.isclose(second["directness_score"], round(1 / 7, 4))
    assert not second["strong_evidence"]
    repeated = spark.createDataFrame([pair[1], pair[1], pair[0]], schema)
    assert rerank.rerank(repeated, query).count() == 2


def test_evidence_types(spark):
    schema = "claim_id bigint, article_id bigint, title string, content string, evidence_type string"
    data = [
        (1, 1, "fact check: this is false", "", None), (1, 2, "fact check", "verified and correct, accurate", ""),
        (1, 3, "fact check", "", "odd"), (1, 4, "x", "false", None), (1, 5, "x", "y", " fact_check "),
    ]
    query = spark.createDataFrame([(1, "anything")], "claim_id bigint, claim string")
    scored = rerank.score_evidence(spark.createDataFrame(data, schema), query)
    assert rows(scored, "article_id", "evidence_type") == [
        (1, "FACT_CHECK_FALSE"), (2, "FACT_CHECK_TRUE"), (3, "FACT_CHECK"), (4, "NEWS"), (5, "FACT_CHECK"),
    ]


# --- verdicts and evaluation --------------------------------------------------------------


def test_responses(spark):
    data = [
        (1, '{"verdict": " real ", "confidence": "0.51239", "explanation": " e "}'), (2, "[1]"), (3, None),
        (4, '{"verdict": 3, "confidence": [], "evidence_analysis": [1, {"evidence_id": "E9", "relationship": " CONTRADICTS"}, {"x": 1}]}'),
    ]
    out = verdict.validate_responses(spark.createDataFrame(data, "claim_id bigint, raw string"))
    got = {r["claim_id"]: r for r in out.collect()}
    assert (got[1]["verdict"], got[1]["confidence"], got[1]["summary"]) == ("REAL", 0.5124, "e")
    assert got[2]["error"] == "not a JSON object" and got[3]["error"] == "no valid JSON"
    assert (got[4]["verdict"], got[4]["confidence"], got[4]["explanation"]) == ("UNCERTAIN", 0.0, verdict.NO_EXPLANATION)
    assert rows(verdict.explode_relations(out), "position", "evidence_id", "relationship") == [
        (1, "E9", "contradicts"), (2, "", "insufficient"),
    ]


def test_no_evidence_sentence(spark):
    claims = spark.createDataFrame([(5,)], "claim_id bigint")
    schema = "claim_id bigint, rank int, evidence_id string, article_id bigint, title string, url string, label int, evidence_type string, " \
        "semantic_score double, lexical_score double, entity_match double, number_date_match double, claim_match double, " \
        "evidence_score double, strong_evidence boolean, content string"
    out = verdict.evidence_blocks(claims, spark.createDataFrame([], schema)).first()
    assert out["evidence_block"] == verdict.NO_EVIDENCE


def test_published_metrics_record(spark):
    # two valid rows, both predicted FAKE, one of them right: the stored example of the metrics
    data = [(0, "FAKE", 0.9), (1, "FAKE", 0.8), (0, "UNCERTAIN", 0.8), (1, "UNCERTAIN", 0.93)] + [(i % 2, "ERROR", None) for i in range(6)]
    df = spark.createDataFrame(data, "true_label int, predicted_verdict string, confidence double")
    record = evaluation.metrics_record(df, df, "x", 5).first()
    assert (record["valid_predictions"], record["uncertain_count"], record["error_count"]) == (2, 2, 6)
    assert (record["fake_precision"], record["fake_recall"], record["fake_f1"]) == (0.5, 1.0, 0.6667)
    assert (record["macro_f1"], record["weighted_f1"], record["accuracy_all_cases"]) == (0.3333, 0.3333, 0.1)
    assert record["classification_report"]["macro avg"]["recall"] == 0.5
    # one class only: averages cover the classes that occur
    only = df.where("true_label = 0 AND predicted_verdict = 'FAKE'")
    assert tuple(evaluation.avg_f1(only).first()) == (1.0, 1.0)
    empty = df.where("predicted_verdict = 'ERROR'")
    assert rows(evaluation.confusion_matrix(empty), "Predicted_FAKE", "Predicted_REAL") == [(0, 0), (0, 0)]
    assert evaluation.classification_report(empty).count() == 0
    assert tuple(evaluation.avg_f1(empty).first()) == (0.0, 0.0)


def test_evaluation_sinks(spark, data, tmp_path):
    p = views.predictions(spark, data)
    metrics = evaluation.metrics_record(p, views.labelled_articles(spark, data), "articles", 5)
    tables.write_evaluation(p, evaluation.confusion_matrix(p), metrics, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/metrics").first()["evaluation_sample_size"] == p.count()
    assert spark.read.option("header", "true").csv(f"{tmp_path}/evaluation_results").count() == p.count()


def test_numbers_are_read_strictly(spark):
    from claimweave.functions import numeric

    texts = ["1d", "0f", "0x1", "1_0", "", " 2.5 ", "-.5e1", "7.", "nan", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(numeric.to_number(F.col("t"))).collect()]
    assert got == [None] * 5 + [2.5, -5.0, 7.0] + [None] * 2


def test_article_with_null_content_is_found(spark):
    articles = spark.createDataFrame([(1, None, None, None, None)], "article_id bigint, url string, title string, content string, label int")
    ids = spark.createDataFrame([(1,), (2,)], "article_id bigint")
    found = {r["article_id"]: r["found"] for r in profiling.lookup_articles(articles, ids).collect()}
    assert found == {1: True, 2: False}


def test_failed_reply_is_an_error_row(spark):
    from claimweave.plans.verification import respond

    claims = spark.createDataFrame([(i, "c") for i in range(3)], "claim_id bigint, claim string").withColumns(
        {"entities": F.array(F.lit("e")), "numbers_dates": F.array(F.lit("1"))}
    )
    fields = "claim_id bigint, rank int, evidence_id string, article_id bigint, title string, content string, url string, evidence_type string, strong_evidence boolean"
    replies = spark.createDataFrame([(0, "broken"), (1, '{"verdict": "REAL", "confidence": true}')], "claim_id bigint, raw string")
    got = {r["claim_id"]: r for r in respond(claims, spark.createDataFrame([], fields), replies).collect()}
    assert (got[0]["verdict"], got[0]["confidence"], got[0]["error"]) == (None, None, "no valid JSON")
    assert (got[1]["verdict"], got[1]["confidence"], got[1]["error"]) == ("REAL", 1.0, None)
    assert got[2]["error"] == "no reply"
