"""Sampling articles for evaluation and measuring verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.jsontext import to_json_array
from claimweave.functions.numeric import safe_ratio
from claimweave.operators.profiling import label_name

CLASSES = [(0, "FAKE"), (1, "REAL")]


def seeded_key(id_column: Column, seed: int) -> Column:
    """Reproducible pseudo-random sort key."""
    return F.md5(F.concat_ws(":", id_column.cast("string"), F.lit(str(seed))))


def balanced_sample(articles: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """n random articles per class; each task keeps at most n per class before the shuffle."""
    order = Window.partitionBy("label").orderBy(seeded_key(F.col("article_id"), seed), "article_id")
    return (
        articles.where(F.col("label").isNotNull())
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") <= n)
        .drop("_rn")
    )


def shuffle_rows(parts: list[DataFrame], seed: int = 42) -> DataFrame:
    """Concatenation of samples in a seeded order."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.orderBy(seeded_key(F.col("article_id"), seed), "article_id")


def verdict_to_binary(verdict: Column) -> Column:
    return F.when(verdict == "FAKE", 0).when(verdict == "REAL", 1)


def evaluation_rows(
    truth: DataFrame, claims: DataFrame, evidence: DataFrame, verdicts: DataFrame
) -> DataFrame:
    """One row per sampled article; an article without a valid verdict is an ERROR row.

    ``truth`` has (article_id, label); the others are keyed by claim_id = article_id, and
    ``verdicts`` may carry processing_time_seconds.
    """
    top = evidence.where(F.col("rank") == 1).select(
        "claim_id",
        F.col("article_id").alias("top_evidence_article_id"),
        F.col("evidence_id").alias("top_evidence_id"),
        F.col("evidence_type").alias("top_evidence_type"),
        F.col("evidence_score").alias("top_evidence_score"),
    )
    sizes = evidence.groupBy("claim_id").agg(F.count("*").alias("n_evidence"))
    joined = (
        truth.select(F.col("article_id").alias("claim_id"), F.col("label").alias("true_label"))
        .join(claims, "claim_id", "left")
        .join(verdicts, "claim_id", "left")
        .join(top, "claim_id", "left")
        .join(sizes, "claim_id", "left")
    )
    c, have = F.col, set(joined.columns)
    error = F.when(
        c("verdict").isNull(),
        F.coalesce(c("error") if "error" in have else F.lit(None), F.lit("no verdict")),
    )
    ok = c("verdict").isNotNull()

    def field(name, type_name="string"):
        value = c(name) if name in have else F.lit(None).cast(type_name)
        return F.when(ok, value).alias(name)

    predicted = F.coalesce(F.upper("verdict"), F.lit("ERROR"))
    truth_name = label_name(c("true_label"))
    count = F.when(ok, F.coalesce("n_evidence", F.lit(0)))
    return joined.select(
        c("claim_id").alias("article_id"),
        "true_label",
        truth_name.alias("true_verdict"),
        predicted.alias("predicted_verdict"),
        verdict_to_binary(predicted).alias("predicted_binary"),
        field("confidence", "double"),
        (ok & (predicted == truth_name)).alias("correct"),
        field("claim"),
        field("claim_type"),
        field("is_fact_check_article"),
        field("claim_status"),
        F.when(ok, to_json_array(c("entities"))).alias("entities"),
        F.when(ok, to_json_array(c("numbers_dates"))).alias("numbers_dates"),
        # both counts are the reranked size
        count.alias("retrieved_count"),
        count.alias("reranked_count"),
        field("top_evidence_article_id", "bigint"),
        field("top_evidence_id"),
        field("top_evidence_type"),
        field("top_evidence_score", "double"),
        field("explanation"),
        field("summary"),
        field("processing_time_seconds", "double"),
        error.alias("error"),
    )


def confusion_counts(rows: DataFrame) -> DataFrame:
    """One row of all sums the metrics need: the only pass over the result rows.

    ``rows`` has true_label, predicted_verdict and optionally confidence and
    processing_time_seconds. ``cm_tp`` counts truth t predicted as p over valid rows.
    """
    label, verdict = F.col("true_label"), F.col("predicted_verdict")
    cells = [
        F.count_if((label == t) & (verdict == name)).alias(f"cm_{t}{p}")
        for t, _ in CLASSES
        for p, name in CLASSES
    ]

    def mean(column):
        return F.avg(column) if column in rows.columns else F.lit(None).cast("double")

    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(verdict == "UNCERTAIN").alias("uncertain"),
        F.count_if(verdict == "ERROR").alias("errors"),
        F.count_if(verdict.isin("FAKE", "REAL")).alias("valid"),
        *cells,
        mean("confidence").alias("average_confidence"),
        mean("processing_time_seconds").alias("average_processing_time_seconds"),
    ).withColumn("correct", F.col("cm_00") + F.col("cm_11"))


def verdict_counts(rows: DataFrame) -> DataFrame:
    return confusion_counts(rows).select("total", "uncertain", "errors", "valid", "correct")


def _class_measures(t: int) -> dict[str, Column]:
    o = 1 - t
    hit = F.col(f"cm_{t}{t}")
    precision = safe_ratio(hit, hit + F.col(f"cm_{o}{t}"))
    recall = safe_ratio(hit, hit + F.col(f"cm_{t}{o}"))
    f1 = safe_ratio(2 * hit, 2 * hit + F.col(f"cm_{o}{t}") + F.col(f"cm_{t}{o}"))
    support = hit + F.col(f"cm_{t}{o}")
    return {"precision": precision, "recall": recall, "f1": f1, "support": support}


def _measures_list(counts: DataFrame) -> DataFrame:
    items = [
        F.struct(F.lit(name).alias("name"), *[v.alias(k) for k, v in _class_measures(t).items()])
        for t, name in CLASSES
    ]
    return counts.withColumn("classes", F.array(*items))


def class_metrics(rows: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class over valid rows; 0 on empty denominators."""
    return _measures_list(confusion_counts(rows)).select(F.inline("classes"))


def _average(columns: DataFrame, measure: str, weighted: bool, present_only: bool) -> Column:
    """Mean of a measure over both classes, or over those that occur in truth or prediction."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for t, _ in CLASSES:
        o = 1 - t
        m = _class_measures(t)
        occurs = m["support"] + F.col(f"cm_{o}{t}") > 0
        w = m["support"].cast("double") if weighted else F.lit(1.0)
        if present_only:
            w = F.when(occurs, w).otherwise(0.0)
        total, weight = total + w * m[measure], weight + w
    return safe_ratio(total, weight)


def avg_f1(rows: DataFrame) -> DataFrame:
    """Macro and support-weighted F1 over the classes that occur."""
    counts = confusion_counts(rows)
    return counts.select(
        _average(counts, "f1", False, True).alias("macro_f1"),
        _average(counts, "f1", True, True).alias("weighted_f1"),
    )


def confusion_matrix(rows: DataFrame) -> DataFrame:
    """Truth by prediction in fixed order; empty cells stay 0."""
    items = [
        F.struct(
            F.lit(f"Actual_{name}").alias("actual"),
            F.col(f"cm_{t}0").alias("Predicted_FAKE"),
            F.col(f"cm_{t}1").alias("Predicted_REAL"),
        )
        for t, name in CLASSES
    ]
    return confusion_counts(rows).select(F.inline(F.array(*items)))


def _average_struct(counts: DataFrame, name: str, weighted: bool) -> Column:
    measures = [_average(counts, m, weighted, False).alias(m) for m in ("precision", "recall", "f1")]
    return F.struct(F.lit(name).alias("name"), *measures, (F.col("valid")).alias("support"))


def classification_report(rows: DataFrame) -> DataFrame:
    """Per-class measures followed by macro and weighted averages; no rows without valid verdicts."""
    counts = _measures_list(confusion_counts(rows)).where(F.col("valid") > 0)
    averages = F.array(
        _average_struct(counts, "macro avg", False), _average_struct(counts, "weighted avg", True)
    )
    return counts.select(F.inline(F.concat(F.col("classes"), averages)))


def _rates() -> dict[str, Column]:
    c = F.col
    return {
        "uncertain_rate": safe_ratio(c("uncertain"), c("total")),
        "error_rate": safe_ratio(c("errors"), c("total")),
        "coverage_rate": safe_ratio(c("valid"), c("total")),
        "accuracy_all_cases": safe_ratio(c("correct"), c("total")),
        "accuracy_valid_cases": safe_ratio(c("correct"), c("valid")),
    }


def rates(rows: DataFrame) -> DataFrame:
    return confusion_counts(rows).select(*[v.alias(k) for k, v in _rates().items()])


def means(rows: DataFrame) -> DataFrame:
    """Means that skip nulls."""
    return confusion_counts(rows).select("average_confidence", "average_processing_time_seconds")


def metrics_record(rows: DataFrame, articles: DataFrame, dataset: str, sample_per_class: int) -> DataFrame:
    """One row with all metrics, rounded as reported, and the nested per-class report."""
    totals = articles.agg(F.count("*").alias("total_dataset_rows"))
    labels = rows.agg(
        F.count_if(F.col("true_label") == 0).alias("fake_samples"),
        F.count_if(F.col("true_label") == 1).alias("real_samples"),
    )
    counts = _measures_list(confusion_counts(rows))
    # three one-row tables
    key = F.lit(1).alias("_k")
    joined = (
        counts.select(key, "*")
        .join(F.broadcast(totals.select(key, "*")), "_k")
        .join(F.broadcast(labels.select(key, "*")), "_k")
    )

    def r(column, places=4):
        return F.round(F.coalesce(column, F.lit(0.0)), places)

    per_class = {}
    for t, name in CLASSES:
        for measure in ("precision", "recall", "f1"):
            per_class[f"{name.lower()}_{measure}"] = r(_class_measures(t)[measure])
    rate = _rates()
    report = F.when(
        F.col("valid") > 0,
        F.struct(
            F.col("classes")[0].dropFields("name").alias("FAKE"),
            F.col("classes")[1].dropFields("name").alias("REAL"),
            rate["accuracy_valid_cases"].alias("accuracy"),
            _average_struct(joined, "", False).dropFields("name").alias("macro avg"),
            _average_struct(joined, "", True).dropFields("name").alias("weighted avg"),
        ),
    )
    return joined.select(
        F.lit(dataset).alias("dataset"),
        F.create_map(*[F.lit(x) for t, name in CLASSES for x in (str(t), name)]).alias(
            "dataset_label_mapping"
        ),
        "total_dataset_rows",
        F.col("total").alias("evaluation_sample_size"),
        F.lit(sample_per_class).alias("sample_per_class"),
        "fake_samples",
        "real_samples",
        F.col("valid").alias("valid_predictions"),
        F.col("uncertain").alias("uncertain_count"),
        F.col("errors").alias("error_count"),
        F.col("correct").alias("correct_predictions"),
        *[r(rate[k]).alias(k) for k in ("accuracy_all_cases", "accuracy_valid_cases", "coverage_rate")],
        *[v.alias(k) for k, v in per_class.items()],
        r(_average(joined, "f1", False, True)).alias("macro_f1"),
        r(_average(joined, "f1", True, True)).alias("weighted_f1"),
        *[r(rate[k]).alias(k) for k in ("uncertain_rate", "error_rate")],
        r(F.col("average_confidence")).alias("average_confidence"),
        r(F.col("average_processing_time_seconds"), 3).alias("average_processing_time_seconds"),
        report.alias("classification_report"),
    )
