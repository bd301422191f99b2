"""The search index: per-article tables bucketed by article, and the inverted file.

Articles, windows and vectors share one bucketing on ``article_id``, so fetching texts for
pairs shuffles only the pairs. The inverted file (``operators.inverted``) is bucketed by chunk, so a
batch of claims is scored where the lists lie.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.text import digits, fold, nfkc, normalize_text, text_or_blank
from claimweave.operators import inverted, lexical
from claimweave.operators.lexical import CHAR, WORD
from claimweave.scale import materialize, scratch, small_batches, work_folder
from claimweave.schema import ARTICLE_COLUMNS, require_columns

BUCKETED = ["articles", "windows", "vectors"]
PLAIN = ["vocabulary_word", "vocabulary_char", "config"]
# How the inverted file is bucketed and sorted.
BY_CHUNK = ("chunk", "channel", "part")


@dataclass(frozen=True)
class SearchIndex:
    articles: DataFrame
    windows: DataFrame
    vectors: DataFrame
    lists: DataFrame
    vocabulary_word: DataFrame
    vocabulary_char: DataFrame
    config: DataFrame
    buckets: int
    parts: int

    def channel_postings(self, channel: str) -> DataFrame:
        """(article_id, term, w, salts) of one channel, taken out of the packed lists."""
        return inverted.postings(self.lists, channel)

    def article_weights(self, channel: str) -> DataFrame:
        """(article_id, ws): the weights of one channel, one list per article."""
        return inverted.article_weights(self.lists, channel)

    def vocabulary(self, channel: str) -> DataFrame:
        return getattr(self, f"vocabulary_{channel}")

    def stats(self) -> DataFrame:
        """(metric, value): indexed articles, then features and postings per channel, from the list lengths."""

        def count(metric: str, value, of: DataFrame) -> DataFrame:
            return of.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).select(F.lit(metric).alias("metric"), "value")

        stats = count("articles", F.count("*"), self.articles)
        for channel in (WORD, CHAR):
            own = self.lists.where(F.col("channel") == channel)
            stats = stats.unionByName(count(f"{channel}_features", F.count("*"), self.vocabulary(channel)))
            # a posting is a position of two bytes
            stats = stats.unionByName(count(f"{channel}_postings", F.sum(F.octet_length("at") / 2), own))
        return stats


@dataclass(frozen=True)
class Windows:
    """Characters of the content that each match signal sees; None is the whole content."""

    content: int | None = None
    entity: int | None = None
    event: int | None = None
    fact: int | None = None
    identity: int | None = None


WINDOWS = ["title_n", "content_w", "entity_w", "event_w", "fact_w", "identity_content", "event_digits"]
# The lengths of the behaviour being matched.
FIXED_WINDOWS = Windows(content=7000, entity=5000, event=7000, fact=1500, identity=7000)


def article_windows(articles: DataFrame, windows: Windows = Windows()) -> DataFrame:
    """Normalised texts that the match signals look at, computed once per article.

    Windows cut first and normalise afterwards, except the identity window, which normalises first.
    """
    title, content = text_or_blank(F.col("title")), text_or_blank(F.col("content"))

    def head(n, text=content):
        return F.substring(text, 1, n) if n else text

    def joined(n):
        return normalize_text(F.concat_ws(" ", title, head(n)))

    def other(n):
        # a content that neither window cuts gives the entity window again
        lengths = [x for x in (n, windows.entity) if x]
        return F.when(F.length(content) <= min(lengths), F.col("entity_w")).otherwise(joined(n))

    others = {name: other(n) for name, n in own_windows(windows).items() if name != "entity_w"}
    apart = articles.withColumns({"title_n": normalize_text(title), "content_w": normalize_text(head(windows.content))})
    if windows.entity is None and windows.content is None:
        # nothing normalises across the space between title and content
        entity = F.trim(F.concat_ws(" ", "title_n", "content_w"))
    else:
        entity = joined(windows.entity)
    cut = apart.withColumn("entity_w", entity).select(
        "article_id",
        "title_n",
        "content_w",
        "entity_w",
        *[column.alias(name) for name, column in others.items()],
        *([] if whole_contents(windows) else [head(windows.identity, fold(nfkc(content))).alias("identity_content")]),
    )
    return with_equal_windows(cut.withColumn("event_digits", digits(F.col("event_w" if "event_w" in cut.columns else "entity_w"))))


def whole_contents(windows: Windows) -> bool:
    """Whether the identity window equals the content window."""
    return windows.content is None and windows.identity is None


def own_windows(windows: Windows) -> dict[str, int | None]:
    """Windows of title and content that differ from the entity window, and that one."""
    others = {"event_w": windows.event, "fact_w": windows.fact}
    return {"entity_w": windows.entity} | {k: n for k, n in others.items() if n != windows.entity}


def with_equal_windows(cut: DataFrame) -> DataFrame:
    """All window columns; one that is not there equals the entity window, or that of the content."""
    equal = {"identity_content": "content_w"}
    columns = {c: F.col(c if c in cut.columns else equal.get(c, "entity_w")).alias(c) for c in WINDOWS}
    return cut.select("article_id", *columns.values())


def count_chars(articles: DataFrame) -> int:
    """Characters of all titles and contents."""
    length = F.coalesce(F.length("title"), F.lit(0)) + F.coalesce(F.length("content"), F.lit(0))
    return articles.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]


def buckets_for(chars: int, tasks: int) -> int:
    """As many buckets as shuffles have tasks, if each gets a chunk of characters, and more beyond 64 MB each."""
    return max(min(max(tasks, 8), -(-chars // inverted.CHUNK_CHARS)), -(-chars // (64 << 20)), 1)


def _save_bucketed(
    rows: DataFrame, directory: str, name: str, buckets: int, partitioned: bool = False, key: tuple[str, ...] = ("article_id",)
) -> None:
    """Write a table bucketed by the first column of ``key`` and sorted by all of them.

    ``partitioned``: the rows are not dealt out again, as they already are hashed on it into ``buckets`` parts, or
    lie in few buckets per task.
    """
    table = f"claimweave_{name}_{uuid.uuid4().hex}"
    hashed = rows if partitioned else rows.repartition(buckets, key[0])
    (
        hashed.write.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{directory}/{name}")
        .bucketBy(buckets, key[0])
        .sortBy(*key)
        .mode("overwrite")
        .saveAsTable(table)
    )
    # the entry only served the bucketed write; the files of an external table stay
    rows.sparkSession.sql(f"DROP TABLE {table}")


def _load_bucketed(spark: SparkSession, directory: str, name: str, buckets: int, key: tuple[str, ...] = ("article_id",)) -> DataFrame:
    table = f"claimweave_{name}_{uuid.uuid4().hex}"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in spark.read.parquet(f"{directory}/{name}").schema.fields
    )
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({key[0]}) SORTED BY ({', '.join(key)}) INTO {buckets} BUCKETS "
        f"LOCATION '{directory}/{name}'"
    )
    return spark.table(table)


def save_index(
    articles: DataFrame,
    vectors: DataFrame,
    directory: str,
    buckets: int | None = None,
    windows: Windows = Windows(),
    max_terms: dict[str, int] | None = None,
    parts: int = 16,
    chunk_chars: int = inverted.CHUNK_CHARS,
    **config,
) -> None:
    """Build and write the whole index.

    ``buckets`` follow from the size of the texts unless they are given. Intermediate tables are removed at the end.
    ``max_terms`` caps the vocabulary of a channel, as ``lexical.FIXED_TERMS`` does; without it all terms stay.
    ``parts`` is the step in which the parts of the terms grow with the texts.
    """
    spark = articles.sparkSession
    require_columns(articles)
    chars = count_chars(articles)
    buckets = buckets or buckets_for(chars, int(spark.conf.get("spark.sql.shuffle.partitions")))
    _save_bucketed(articles.select(*ARTICLE_COLUMNS), directory, "articles", buckets)
    # from here on every step reads the hashed copy and keeps its partitioning
    articles = _load_bucketed(spark, directory, "articles", buckets)
    equal = {"identity_content"} if whole_contents(windows) else set()
    stored = ["article_id", *[c for c in WINDOWS if c not in equal and (not c.endswith("_w") or c == "content_w" or c in own_windows(windows))]]
    with small_batches(spark):
        _save_bucketed(article_windows(articles, windows).select(*stored), directory, "windows", buckets, True)
    vector_columns = vectors.select(
        F.col("article_id").cast("bigint").alias("article_id"), F.col("embedding").cast("array<float>")
    )
    _save_bucketed(vector_columns, directory, "vectors", buckets)
    n = articles.count()
    work = f"{work_folder(spark)}/index-work-{uuid.uuid4().hex}"
    with scratch(work):
        inputs = inverted.index_inputs(articles, windows.identity)
        counted = inverted.count_terms(inputs, inverted.parts_for(chars, parts), chunk_chars)
        chunks = max(buckets, -(-chars // chunk_chars))
        with small_batches(spark):
            _save_bucketed(counted, work, "counts", chunks, True, BY_CHUNK)
        counts = _load_bucketed(spark, work, "counts", chunks, BY_CHUNK)
        merged = materialize(inverted.merge_terms(counts, bool(max_terms)), "merged")
        caps = {}
        for channel in (WORD, CHAR):
            path, most = f"{directory}/vocabulary_{channel}", (max_terms or {}).get(channel)
            terms = lexical.fit_terms(inverted.frequencies(merged, channel), n, channel, most)
            terms.write.mode("overwrite").option("compression", "zstd").parquet(path)
            if most is not None and not terms.isEmpty():
                caps[channel] = inverted.last_kept(spark.read.parquet(path))
        _save_bucketed(inverted.finished(counts, merged, n, caps), directory, "inverted", chunks, True, BY_CHUNK)
        spark.createDataFrame([(chunks,)], "chunk_buckets int").coalesce(1).write.mode("overwrite").parquet(f"{directory}/layout")
    first = vectors.select(F.size("embedding").alias("d")).first()
    settings = {
        "document_count": n,
        "embedding_dimension": first["d"] if first else 0,
        "content_limit": 1500,
        "normalized": True,
        "buckets": buckets,
        "parts": parts,
        **config,
    }
    rows = [(k, str(v)) for k, v in sorted(settings.items())]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{directory}/config")


def load_index(spark: SparkSession, directory: str) -> SearchIndex:
    config = spark.read.parquet(f"{directory}/config")
    settings = {r["name"]: r["value"] for r in config.where("name IN ('buckets', 'parts')").collect()}
    buckets, parts = int(settings["buckets"]), int(settings["parts"])
    tables = {name: _load_bucketed(spark, directory, name, buckets) for name in BUCKETED}
    tables["windows"] = with_equal_windows(tables["windows"])
    tables.update({name: spark.read.parquet(f"{directory}/{name}") for name in PLAIN})
    chunks = spark.read.parquet(f"{directory}/layout").first()["chunk_buckets"]
    lists = _load_bucketed(spark, directory, "inverted", chunks, BY_CHUNK)
    return SearchIndex(**tables, lists=lists, buckets=buckets, parts=parts)
