"""The packed index against plain searches, and what must not become rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import candidates, inverted, term_search
from claimweave.plans import views
from claimweave.sources import index_store

ARTICLES = [
    (1, "Quarterly Budget Review", "The harbour council met on 12 May 2020 about the new bridge over the river."),
    (2, "New bridge", "opened in 1999; the harbour council said nothing."),
    (3, None, "rebridged harbours of 20 20 and nothing else"),
    (4, "council of the harbour", None),
    (5, "", "bridge over troubled water, budget 2020"),
    (6, "नया पुल", "नगर परिषद ने नया पुल खोला 2020"),
    (7, "Council", "Harbour"),
]
CLAIMS = [
    (-1, "Harbour council opens new bridge", ["harbour", "bridge", "harbour council"], ["2020"], None),
    (-2, "budget bridge", ["bridge"], ["12", "1999"], 2),
    (-3, "नया पुल खोला गया", ["नया पुल"], [], 6),
    (-4, "review new", ["council", "review new"], [], None),
]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    articles = spark.createDataFrame([(i, f"u{i}", t, c, i % 2) for i, t, c in ARTICLES], "article_id bigint, url string, title string, content string, label int")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i, *_ in ARTICLES], "article_id bigint, embedding array<float>")
    claims = spark.createDataFrame(
        [(i, c, c, c, e, n, x) for i, c, e, n, x in CLAIMS],
        "claim_id bigint, claim string, source_title string, source_content string, entities array<string>, numbers_dates array<string>, exclude_article_id bigint")

    def build(**options):
        path = str(tmp_path_factory.mktemp("small"))
        index_store.save_index(articles, vectors, path, 2, **options)
        return index_store.load_index(spark, path)

    return build, candidates.prepare_claims(claims).cache()


def _plain(prepared, index, limit):
    """Identity candidates by searching every text for every term."""
    out = []
    texts = sorted(index.windows.collect(), key=lambda w: w["article_id"])
    for c in prepared.collect():
        found = []
        for w in texts:
            title, content = w["title_n"], w["identity_content"]
            text = f"{title} {content}"
            hits = sum(v in text for v in c["identity_variants"])
            if w["article_id"] == c["exclude_article_id"] or not hits:
                continue
            found_digits = "".join(x for x in text if x.isdecimal())
            numbers = sum(n["value"] in text or (len(n["digits"]) >= 2 and n["digits"] in found_digits) for n in c["numbers_s"])
            phrases = sum(p in title or p in content for p in c["phrases"])
            if hits >= 2 or numbers >= 0.2 * max(len(c["numbers_s"]), 1) or phrases >= 0.15 * max(len(c["phrases"]), 1):
                found.append((-hits, w["article_id"]))
        out += [(c["claim_id"], a, -h) for h, a in sorted(found)[:limit]]
    return sorted(out)


@pytest.mark.parametrize("limit", [1, 2, 300])
def test_identity_candidates_equal_plain_search(small, limit):
    build, prepared = small
    index = build()
    got = sorted(tuple(r) for r in candidates.identity_candidates(prepared, index, limit).collect())
    assert got == _plain(prepared, index, limit)
    assert any(r[1] == 3 for r in _plain(prepared, index, 300))  # "rebridged" contains "bridge"


def test_a_phrase_across_title_and_content_is_none():
    assert inverted._in_title_or_content("new bridge opened", 10, "new bridge")
    assert not inverted._in_title_or_content("new bridge opened", 3, "new bridge")
    assert inverted._in_title_or_content("new bridge new bridge", 3, "new bridge")
    assert not inverted._in_title_or_content(" new", 0, "old")


def test_pieces_are_found_in_words_of_any_length():
    words = ["a", "ab", "bridge", "rebridged", "bridgehead", "नगर", "x" * 40]
    texts = [["ab", "rebridged"], ["bridge", "नगर"], ["bridgehead", "x" * 40, "a"]]
    terms = inverted.pa.array(words)
    at = [[i for i, t in enumerate(texts) if w in t] for w in words]
    text, sizes = inverted._blobs(terms)
    n = np.array([len(x) for x in at])
    steps, _, _ = inverted._pack(np.concatenate(at).astype("<u4"), np.ones(int(n.sum()), "<u4"), n)
    found = inverted._Words({"terms": text, "sizes": sizes, "n": n.astype("<u4").tobytes(), "at": steps.tobytes(), "ids": [1, 2, 3]})
    for piece in ("a", "b", "ab", "rid", "ridge", "bridge", "bridged", "bridgeh", "गर", "xxxxxxx", "none", "zz"):
        assert found.holding(piece).tolist() == [any(piece in w for w in t) for t in texts], piece


def test_no_row_per_term_or_posting(spark, data, index):
    # a chunk has a row for itself, one for its words and one per channel and part
    rows = index.lists.groupBy("chunk").agg(F.count("*").alias("n"), F.max(F.when(F.col("channel") == inverted.HEAD, F.col("part"))).alias("parts")).collect()
    assert rows and all(r["n"] <= 2 + 2 * r["parts"] for r in rows)
    prepared = candidates.prepare_claims(views.claims(spark, data)).cache()
    # lists are scored and searched where they lie
    for df in (candidates.word_scores(prepared, index), index.article_weights("char"), inverted.named_entities(candidates._identity_side(prepared), index.lists)):
        plan = df._jdf.queryExecution().toString()
        assert "Exchange hashpartitioning(chunk" not in plan.split("== Physical Plan ==")[1]


def test_weights_in_lists_are_those_of_postings(index):
    for channel in ("word", "char"):
        lists = {r["article_id"]: sorted(round(w, 9) for w in r["ws"]) for r in index.article_weights(channel).collect()}
        single: dict = {}
        for r in index.channel_postings(channel).select("article_id", "w").collect():
            single.setdefault(r["article_id"], []).append(round(r["w"], 9))
        assert lists == {a: sorted(ws) for a, ws in single.items()}


def test_parts_and_caps_do_not_change_the_terms_kept(spark, small, monkeypatch):
    build, _ = small

    def terms(index):
        return {c: {(r["article_id"], r["term"], round(r["w"], 9)) for r in index.channel_postings(c).collect()} for c in ("word", "char")}

    whole = terms(build())
    monkeypatch.setattr(inverted, "SMALL_VOCABULARY", 0)
    assert terms(build(chunk_chars=60)) == whole
    most = {"word": 3, "char": 40}
    capped = build(max_terms=most)
    for channel, found in terms(capped).items():
        kept = {r["term"] for r in capped.vocabulary(channel).collect()}
        assert len(kept) == most[channel] and {t for _, t, _ in found} == kept


@pytest.mark.parametrize("held", [term_search.HELD_CLAIMS, 0])
def test_found_terms_equal_plain_search(small, monkeypatch, held):
    build, prepared = small
    index = build(windows=index_store.Windows(content=20, entity=30, event=12, fact=9))
    monkeypatch.setattr(term_search, "HELD_CLAIMS", held)
    pairs = prepared.select("claim_id").crossJoin(index.articles.select("article_id"))
    claims = {c["claim_id"]: c for c in prepared.collect()}
    windows = {w["article_id"]: w for w in index.windows.collect()}
    found = term_search.find_terms(pairs, index.windows, prepared).collect()
    assert len(found) == len(claims) * len(windows)
    for r in found:
        c, w = claims[r["claim_id"]], windows[r["article_id"]]
        assert r["matched_entities"] == [e["name"] for e in c["entities_s"] if any(v in w["entity_w"] for v in e["variants"])]
        assert r["event_entities"] == [e["name"] for e in c["entities_s"] if any(v in w["event_w"] for v in e["variants"])]
        assert r["phrases"] == [p for p in c["phrases"] if p in w["title_n"] or p in w["content_w"]]
        assert r["title_phrases"] == [p for p in c["phrases"] if p in w["title_n"]]
        assert r["title_tokens"] == [t for t in c["claim_tokens"] if t in w["title_n"]]
        assert r["content_tokens"] == [t for t in c["claim_tokens"] if t in w["content_w"]]
        hits = sum(n["value"] in w["event_w"] or (len(n["digits"]) >= 2 and n["digits"] in w["event_digits"]) for n in c["numbers_s"])
        assert r["number_date_match"] == (hits / len(c["numbers_s"]) if c["numbers_s"] else 0.0)
