from checks import registry
from checks.compare import connect, difference
from claimweave.plans import views
from claimweave.streaming import requests


def test_stream_equals_batch(spark, data):
    stream = registry.QUERIES["stream_verify"](spark, data).toPandas()
    batch = registry.batch_of_requests(spark, data).toPandas()
    assert len(stream) and difference(stream, batch) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_equal_their_twins(spark, data):
    con = connect(data)
    for name in ("label_statistics", "clean_articles", "text_token_sets", "channel_identity", "retrieve_top12", "rerank_top3"):
        ours = registry.QUERIES[name](spark, data).toPandas()
        theirs = con.execute(registry.ORACLES[name]).df()
        assert difference(ours, theirs) is None, name


def test_replayed_batch_leaves_nothing_behind(spark, data, index, tmp_path):
    vectors = registry._request_vectors(spark, data)
    places = [f"{tmp_path}/{x}" for x in ("out", "rejects", "log")]
    work = tmp_path / "log-work" / "7"
    (work / "left-by-a-lost-attempt").mkdir(parents=True)
    incoming = views.requests(spark, data)

    def seen():
        return sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet"))

    requests.verify_batch(incoming, 7, *places, index, vectors)
    first = seen()
    assert first and not work.exists() and all(p.startswith(("out", "rejects")) for p in first)
    requests.verify_batch(incoming, 7, *places, index, vectors)
    assert seen() == first and not work.exists()
    row = requests.read_log(spark, places[2]).collect()
    rejected = spark.read.parquet(places[1]).count()
    assert [(r.batch_id, r.requests, r.rejected, r.evidence) for r in row] == [
        (7, incoming.count(), rejected, spark.read.parquet(places[0]).count())
    ]
