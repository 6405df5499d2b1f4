"""Queries on scores, rules, profiles and tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions import cells
from assayer.functions.text import match_band, quality_band, score_text
from assayer.operators import checks, monitor, profile, scoring, tiering
from assayer.operators.sketches import DISTINCT_ERROR, RANK_ERROR, merge_sketches, profile_from_sketches, profile_sketches
from assayer.operators.scoring import TIER_THRESHOLDS, QualitySpec
from assayer.plans import views
from assayer.plans.batch import Run, assess, grade_source
from assayer.plans.catalog import register
from assayer.plans.definitions import CUSTOMER_ID, CUSTOMER_V1, EMAIL, PAYMENT_METHOD, PAYMENT_METHODS, PHONE, SALES_V1
from assayer.plans.views import AS_OF, CUSTOMER_SRC, EVENT_SRC, RUN_AT, SALES_SRC, SOURCE_RUNS
from assayer.session import fresh_path

QUANTITY_RULE = {"quantity": {"min": 1, "max": 10000}}
FEED_SPEC = QualitySpec(name="feeds", rules={"value": {"min": 1, "max": 100}}, date_column="ts", max_age_days=60)
RUN = Run("run-1", RUN_AT, schemas={("sales_transactions", 1): SALES_V1})

SALES_COMPLETENESS = "1.0e0 - (count(*) - count(quantity) + count(*) - count(payment_method)) / (count(*) * 8.0e0)"
SALES_ACCURACY = "1.0e0 - count(*) FILTER (WHERE NOT (quantity BETWEEN 1 AND 10000)) / (count(*) * 8.0e0)"
FEED_SCORES = f"""(SELECT source_name,
  1.0e0 - sum(CASE WHEN payload IS NULL THEN 1 ELSE 0 END) / (count(*) * 5.0e0) AS c,
  1.0e0 - count(*) FILTER (WHERE NOT (value BETWEEN 1 AND 100)) / (count(*) * 5.0e0) AS a,
  greatest(0.0e0, least(1.0e0, 1.0e0 - avg(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01')) / 60)) AS t
FROM {EVENT_SRC} GROUP BY source_name) q"""
TIER_SQL = """CASE WHEN c >= 0.95 AND a >= 0.9 AND t >= 0.85 THEN 'gold' WHEN c >= 0.8 AND a >= 0.8 AND t >= 0.7 THEN 'silver'
  WHEN c >= 0.7 AND a >= 0.6 AND t >= 0.5 THEN 'bronze' ELSE 'rejected' END"""


def _score(df: DataFrame, spec: QualitySpec, *wanted: str) -> DataFrame:
    return scoring.score(df, spec, AS_OF).select(*[F.round(w, 6).alias(w) for w in wanted])


@register(
    "completeness",
    f"""SELECT round(1.0 - (sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN email IS NULL THEN 1 ELSE 0 END)
 + sum(CASE WHEN phone IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN address IS NULL THEN 1 ELSE 0 END)
 + sum(CASE WHEN acctbal IS NULL OR isnan(acctbal) THEN 1 ELSE 0 END)) / (count(*) * 7.0e0), 6) AS completeness FROM {CUSTOMER_SRC}""",
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score(views.customer_src(spark, sf_dir), QualitySpec(), "completeness")


@register(
    "missing_counts",
    f"""SELECT CAST(sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS name_missing,
 CAST(sum(CASE WHEN phone IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS phone_missing,
 CAST(sum(CASE WHEN acctbal IS NULL OR isnan(acctbal) THEN 1 ELSE 0 END) AS BIGINT) AS acctbal_missing,
 count(*) AS record_count FROM {CUSTOMER_SRC}""",
)
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.missing_counts(views.customer_src(spark, sf_dir), ["name", "phone", "acctbal"])


@register("accuracy_range", f"SELECT round({SALES_ACCURACY}, 6) AS accuracy FROM {SALES_SRC}")
def accuracy_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score(views.sales_src(spark, sf_dir), QualitySpec(rules=QUANTITY_RULE), "accuracy")


@register(
    "accuracy_pattern",
    f"""SELECT round(1.0 - count(*) FILTER (WHERE NOT regexp_matches(email, '{EMAIL}')) / (count(*) * 7.0e0), 6) AS accuracy
 FROM {CUSTOMER_SRC}""",
)
def accuracy_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score(views.customer_src(spark, sf_dir), QualitySpec(rules={"email": {"pattern": EMAIL}}), "accuracy")


@register(
    "accuracy_enum",
    f"""SELECT round(1.0 - count(*) FILTER (WHERE NOT payment_method IN ('CREDIT','DEBIT','CASH','CHECK','TRANSFER'))
 / (count(*) * 8.0e0), 6) AS accuracy FROM {SALES_SRC}""",
)
def accuracy_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"payment_method": {"allowed_values": PAYMENT_METHODS}}
    return _score(views.sales_src(spark, sf_dir), QualitySpec(rules=rules), "accuracy")


@register(
    "accuracy_combined",
    f"""SELECT round(1.0 - (count(*) FILTER (WHERE NOT (quantity BETWEEN 1 AND 10000))
 + count(*) FILTER (WHERE NOT regexp_matches(payment_method, '{PAYMENT_METHOD}'))
 + count(*) FILTER (WHERE NOT payment_method IN ('CREDIT','DEBIT','CASH'))) / (count(*) * 8.0e0), 6) AS accuracy FROM {SALES_SRC}""",
)
def accuracy_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        **QUANTITY_RULE,
        "payment_method": {"pattern": PAYMENT_METHOD, "allowed_values": ["CREDIT", "DEBIT", "CASH"]},
        "no_such_column": {"pattern": "x"},
    }
    return _score(views.sales_src(spark, sf_dir), QualitySpec(rules=rules), "accuracy")


@register("accuracy_default", f"SELECT round({SALES_COMPLETENESS}, 6) AS accuracy FROM {SALES_SRC}")
def accuracy_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score(views.sales_src(spark, sf_dir), QualitySpec(), "accuracy")


@register(
    "timeliness",
    """SELECT round(greatest(0.0e0, least(1.0e0, 1.0e0 - avg(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01')) / 30)), 6)
 AS timeliness FROM events""",
)
def timeliness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score(views.table(spark, sf_dir, "events"), QualitySpec(date_column="ts"), "timeliness")


@register(
    "timeliness_default",
    f"""SELECT source_type, CASE WHEN source_type = 'kafka' THEN 1.0e0 ELSE 0.5e0 END AS timeliness
 FROM (SELECT DISTINCT source_type FROM {SOURCE_RUNS}) q""",
)
def timeliness_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = QualitySpec(streaming=F.col("source_type") == "kafka")
    scores = scoring.score(views.source_runs(spark, sf_dir), spec, AS_OF, ["source_type"])
    return scores.select("source_type", "timeliness")


@register(
    "quality_metrics",
    f"""SELECT round({SALES_COMPLETENESS}, 6) AS completeness, round({SALES_ACCURACY}, 6) AS accuracy, 0.5e0 AS timeliness,
 (min(quantity) >= 1 AND max(quantity) <= 10000) AS schema_valid,
 CAST(CASE WHEN min(quantity) < 1 OR max(quantity) > 10000 THEN 1 ELSE 0 END AS INT) AS schema_error_count,
 CAST(CASE WHEN count(*) FILTER (WHERE regexp_matches(payment_method, '{PAYMENT_METHOD}')) / (count(*) * 1.0e0) < 0.9
      THEN 1 ELSE 0 END AS INT) AS schema_warning_count
 FROM {SALES_SRC}""",
)
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = QualitySpec(name="sales_transactions", rules=QUANTITY_RULE)
    row = assess(views.sales_src(spark, sf_dir), spec, SALES_V1, AS_OF)
    return row.select(
        F.round("completeness", 6).alias("completeness"),
        F.round("accuracy", 6).alias("accuracy"),
        "timeliness",
        "schema_valid",
        "schema_error_count",
        "schema_warning_count",
    )


@register(
    "tier_classify",
    f"SELECT {TIER_SQL} AS data_classification FROM (SELECT {SALES_COMPLETENESS} AS c, {SALES_ACCURACY} AS a, 0.5e0 AS t FROM {SALES_SRC}) q",
)
def tier_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiering.tier(views.sales_src(spark, sf_dir), QualitySpec(rules=QUANTITY_RULE), AS_OF).select("data_classification")


@register(
    "tier_by_group",
    f"""SELECT source_name, round(c, 6) AS completeness, round(a, 6) AS accuracy, round(t, 6) AS timeliness,
 {TIER_SQL} AS data_classification FROM {FEED_SCORES}""",
)
def tier_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_tiers(tiering.tier(views.event_src(spark, sf_dir), FEED_SPEC, AS_OF, ["source_name"]))


def rounded_tiers(graded: DataFrame) -> DataFrame:
    return graded.select(
        "source_name", *[F.round(m, 6).alias(m) for m in scoring.SCORE_COLUMNS], "data_classification"
    )


@register(
    "tier_invalid_schema",
    f"""SELECT source_name, CASE WHEN c >= 0.7 AND a >= 0.6 AND t >= 0.5 THEN 'bronze' ELSE 'rejected' END AS data_classification
 FROM {FEED_SCORES}""",
)
def tier_invalid_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = views.event_src(spark, sf_dir)
    graded = tiering.tier(feed, FEED_SPEC, AS_OF, ["source_name"], schema_valid=F.lit(False))
    return graded.select("source_name", "data_classification")


@register(
    "tier_override",
    f"""SELECT source_name, CASE WHEN c >= 0.95 AND a >= 0.9 AND t >= 0.85 THEN 'gold' WHEN c >= 0.8 AND a >= 0.8 AND t >= 0.75 THEN 'silver'
 WHEN c >= 0.6 AND a >= 0.6 AND t >= 0.7 THEN 'bronze' ELSE 'rejected' END AS data_classification FROM {FEED_SCORES}""",
)
def tier_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = {"bronze": {"completeness": 0.6, "accuracy": 0.6, "timeliness": 0.7}, "silver": {"timeliness": 0.75}}
    scores = scoring.score(views.event_src(spark, sf_dir), FEED_SPEC, AS_OF, ["source_name"])
    graded = tiering.classify(scores, tiering.merge_thresholds(TIER_THRESHOLDS, own))
    return graded.select("source_name", "data_classification")


def feed_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds of each feed, set by how many events it has delivered; only some tiers and metrics have any."""
    counted = views.event_src(spark, sf_dir).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")

    def least(tier: str, metric: str, value):
        return F.struct(F.lit(tier).alias("tier"), F.lit(metric).alias("metric"), value.alias("least"))

    rows = F.array(
        least("gold", "completeness", F.lit(0.9) + n % 10 / F.lit(100.0)),
        least("gold", "timeliness", F.lit(0.72)),
        least("silver", "accuracy", F.lit(0.95) + n % 5 / F.lit(100.0)),
        F.when(n % 2 == 0, least("bronze", "consistency", F.lit(0.1))),
    )
    return counted.select("source_name", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("t")).select("source_name", "t.*")


@register(
    "tier_by_table",
    f"""SELECT q.source_name, CASE WHEN c >= 0.9e0 + n % 10 / 100.0e0 AND t >= 0.72 THEN 'gold' WHEN a >= 0.95e0 + n % 5 / 100.0e0 THEN 'silver'
 WHEN n % 2 <> 0 THEN 'bronze' ELSE 'rejected' END AS data_classification
 FROM {FEED_SCORES} JOIN (SELECT source_name, count(*) AS n FROM {EVENT_SRC} GROUP BY source_name) k ON k.source_name = q.source_name""",
)
def tier_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.score(views.event_src(spark, sf_dir), FEED_SPEC, AS_OF, ["source_name"])
    graded = tiering.classify_by_table(scores, feed_thresholds(spark, sf_dir), ["source_name"])
    return graded.select("source_name", "data_classification")


@register(
    "group_quality_columns",
    f"""SELECT e.event_id, e.source_name, {TIER_SQL} AS data_classification, round(c, 6) AS metric_completeness
 FROM {EVENT_SRC.replace(') event_src', ') e')} JOIN {FEED_SCORES} ON q.source_name = e.source_name""",
)
def group_quality_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = views.event_src(spark, sf_dir)
    graded = tiering.tier(feed, FEED_SPEC, AS_OF, ["source_name"])
    return tiering.add_group_quality_columns(feed, graded, ["source_name"]).select(
        "event_id", "source_name", "data_classification", F.round("metric_completeness", 6).alias("metric_completeness")
    )


SALES_SOURCE = {"name": "sales_transactions", "validation_rules": QUANTITY_RULE}


def quality_sql(columns: str) -> str:
    return f"""WITH sales AS (SELECT * FROM {SALES_SRC}),
m AS (SELECT {SALES_COMPLETENESS} AS c, {SALES_ACCURACY} AS a, 0.5e0 AS t, (min(quantity) >= 1 AND max(quantity) <= 10000) AS valid,
      count(*) FILTER (WHERE regexp_matches(payment_method, '{PAYMENT_METHOD}')) / (count(*) * 1.0e0) AS r FROM sales),
g AS (SELECT *, CASE WHEN valid AND c >= 0.95 AND a >= 0.9 AND t >= 0.85 THEN 'gold' WHEN valid AND c >= 0.8 AND a >= 0.8 AND t >= 0.7 THEN 'silver'
      WHEN c >= 0.7 AND a >= 0.6 AND t >= 0.5 THEN 'bronze' ELSE 'rejected' END AS tier FROM m)
SELECT {columns} FROM sales, g"""


@register(
    "quality_columns",
    quality_sql(
        """transaction_id, g.tier AS data_classification, round(g.c, 6) AS metric_completeness, round(g.a, 6) AS metric_accuracy,
 g.t AS metric_timeliness, g.valid AS schema_valid, CAST(CASE WHEN g.valid THEN 0 ELSE 1 END AS INT) AS schema_error_count,
 CAST(CASE WHEN g.r < 0.9 THEN 1 ELSE 0 END AS INT) AS schema_warning_count,
 TIMESTAMP '2024-02-01 00:00:00' AS processing_timestamp, 'sales_transactions' AS source_name"""
    ),
)
def quality_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded, _ = grade_source(views.sales_src(spark, sf_dir), SALES_SOURCE, RUN)
    return graded.select(
        "transaction_id",
        "data_classification",
        F.round("metric_completeness", 6).alias("metric_completeness"),
        F.round("metric_accuracy", 6).alias("metric_accuracy"),
        "metric_timeliness",
        "schema_valid",
        "schema_error_count",
        "schema_warning_count",
        "processing_timestamp",
        "source_name",
    )


@register(
    "rule_violations",
    f"""SELECT transaction_id, 'quantity' AS column_name, 'range' AS issue_type FROM {SALES_SRC} WHERE NOT (quantity BETWEEN 1 AND 10000)
 UNION ALL SELECT transaction_id, 'payment_method', 'pattern' FROM {SALES_SRC}
 WHERE NOT regexp_matches(payment_method, '{PAYMENT_METHOD}')""",
)
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {**QUANTITY_RULE, "payment_method": {"pattern": PAYMENT_METHOD}}
    return scoring.rule_breaches(views.sales_src(spark, sf_dir), rules, ["transaction_id"])


@register(
    "pattern_match",
    f"""SELECT customer_id, (phone IS NOT NULL AND regexp_extract(phone, '{PHONE}', 0) <> '') AS phone_matches FROM {CUSTOMER_SRC}""",
)
def pattern_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.customer_src(spark, sf_dir).select(
        "customer_id", cells.pattern_hit(F.col("phone"), PHONE).alias("phone_matches")
    )


@register(
    "empty_counts",
    f"""SELECT count(*) FILTER (WHERE address = '') AS empty_count, count(*) FILTER (WHERE address IS NOT NULL) AS non_null_count,
 count(*) FILTER (WHERE isnan(acctbal)) AS nan_count FROM {CUSTOMER_SRC}""",
)
def empty_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = views.customer_src(spark, sf_dir)
    return feed.agg(
        F.count_if(cells.is_empty_text("address")).alias("empty_count"),
        F.count("address").alias("non_null_count"),
        F.count_if(cells.is_not_a_number("acctbal", feed.schema["acctbal"].dataType)).alias("nan_count"),
    )


def _pattern_sql(column: str, pattern: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(CASE WHEN regexp_extract({column}, '{pattern}', 0) <> '' THEN 1 END) AS match_count,
 count(*) AS total_count FROM {CUSTOMER_SRC}"""


@register(
    "pattern_validation",
    f"""SELECT column_name, match_count, total_count, round(r, 6) AS match_ratio,
 CASE WHEN r < 0.5 THEN 'error' WHEN r < 0.9 THEN 'warning' ELSE 'ok' END AS severity
 FROM (SELECT *, match_count / (total_count * 1.0e0) AS r FROM ({_pattern_sql('email', EMAIL)} UNION ALL
 {_pattern_sql('phone', PHONE)} UNION ALL {_pattern_sql('customer_id', CUSTOMER_ID)}) p) q""",
)
def pattern_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.pattern_validation(views.customer_src(spark, sf_dir), dict(CUSTOMER_V1.patterns))
    return checked.withColumn("match_ratio", F.round("match_ratio", 6))


@register(
    "range_validation",
    f"""SELECT column_name, lower, upper, actual_min, actual_max, (actual_min >= lower AND actual_max <= upper) AS in_range FROM (
 SELECT 'quantity' AS column_name, 1.0e0 AS lower, 10000.0e0 AS upper, CAST(min(quantity) AS DOUBLE) AS actual_min,
        CAST(max(quantity) AS DOUBLE) AS actual_max FROM {SALES_SRC}
 UNION ALL SELECT 'unit_price', 0.01e0, 100000.0e0, CAST(min(unit_price) AS DOUBLE), CAST(max(unit_price) AS DOUBLE) FROM {SALES_SRC}
 UNION ALL SELECT 'total_price', 0.01e0, 1000000.0e0, CAST(min(total_price) AS DOUBLE), CAST(max(total_price) AS DOUBLE) FROM {SALES_SRC}) q""",
)
def range_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.range_validation(views.sales_src(spark, sf_dir), {c: dict(r) for c, r in SALES_V1.ranges.items()})


def _profile_sql(column: str, kind: str) -> str:
    number, text = kind == "number", kind == "text"
    distinct = f"count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)"
    return f"""SELECT '{column}' AS column_name, count(*) AS record_count, count(*) - count({column}) AS null_count,
 count({column}) AS non_null_count, CAST({'0' if number else 'NULL'} AS BIGINT) AS nan_count,
 CAST({f"count(*) FILTER (WHERE {column} = '')" if text else 'NULL'} AS BIGINT) AS empty_count,
 CAST({distinct if text else 'NULL'} AS BIGINT) AS distinct_count,
 CAST({f'min({column})' if number else 'NULL'} AS DOUBLE) AS min_value, CAST({f'max({column})' if number else 'NULL'} AS DOUBLE) AS max_value,
 round(count({column}) / (count(*) * 1.0e0), 6) AS completeness,
 CAST({f'round(({distinct}) / (count({column}) * 1.0e0), 6)' if text else 'NULL'} AS DOUBLE) AS cardinality_ratio FROM sales"""


@register(
    "profile_columns",
    f"WITH sales AS (SELECT * FROM {SALES_SRC}) "
    + " UNION ALL ".join(
        _profile_sql(c, k)
        for c, k in {
            "transaction_id": "text", "customer_id": "text", "product_id": "text", "quantity": "number",
            "unit_price": "number", "total_price": "number", "transaction_date": "time", "payment_method": "text",
        }.items()
    ),
)
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.profile_columns(views.sales_src(spark, sf_dir))
    return rows.withColumns(
        {"completeness": F.round("completeness", 6), "cardinality_ratio": F.round("cardinality_ratio", 6)}
    )


@register(
    "metrics_long",
    f"""SELECT 'completeness' AS metric, round({SALES_COMPLETENESS}, 4) AS score FROM {SALES_SRC}
 UNION ALL SELECT 'accuracy', round({SALES_ACCURACY}, 4) FROM {SALES_SRC}
 UNION ALL SELECT 'timeliness', 0.5e0 FROM {SALES_SRC} HAVING count(*) > 0""",
)
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.metrics_long(scoring.score(views.sales_src(spark, sf_dir), QualitySpec(rules=QUANTITY_RULE), AS_OF))


@register(
    "score_table",
    f"""SELECT source_name, printf('%.4f', round(c, 4)) AS completeness, printf('%.4f', round(a, 4)) AS accuracy,
 printf('%.4f', round(t, 4)) AS timeliness, CASE WHEN c >= 0.9 THEN 'good' WHEN c >= 0.8 THEN 'medium' WHEN c >= 0.7 THEN 'borderline'
 ELSE 'poor' END AS completeness_band, 'N/A' AS consistency FROM {FEED_SCORES}""",
)
def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scoring.score(views.event_src(spark, sf_dir), FEED_SPEC, AS_OF, ["source_name"])
    scores = scores.withColumns({"completeness_band": quality_band(F.col("completeness")), "consistency": F.lit(None).cast("double")})
    return monitor.score_table(scores, ["source_name", "completeness_band"], [*scoring.SCORE_COLUMNS, "consistency"])


@register(
    "match_band",
    f"""SELECT CASE WHEN r >= 0.9 THEN 'good' WHEN r >= 0.7 THEN 'medium' ELSE 'poor' END AS band FROM
 (SELECT count(CASE WHEN regexp_extract(phone, '{PHONE}', 0) <> '' THEN 1 END) / (count(*) * 1.0e0) AS r FROM {CUSTOMER_SRC}) q""",
)
def match_band_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.pattern_validation(views.customer_src(spark, sf_dir), {"phone": PHONE})
    return checked.select(match_band(F.col("match_ratio")).alias("band"))


@register(
    "preview_info",
    f"""SELECT count(*) AS row_count, 8 AS column_count, 'struct<transaction_id:string,customer_id:string,product_id:string,quantity:int,'
 || 'unit_price:decimal(10,2),total_price:decimal(10,2),transaction_date:timestamp_ntz,payment_method:string>' AS schema_text FROM {SALES_SRC}""",
)
def preview_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(views.sales_src(spark, sf_dir))[0]


@register("sample_rows", "SELECT event_id, user_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 5")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = profile.preview(views.table(spark, sf_dir, "events"), order=["ts", "event_id"])[1]
    return first.select("event_id", "user_id", "event_type", "value")


PROFILED = ("event_id", "user_id", "value", "event_type", "props")
PROFILE_SQL = """WITH e AS (SELECT event_id, user_id, event_type, props, CASE WHEN event_id % 4 > 0 THEN value END AS value FROM events)
 SELECT 'event_id' AS column_name, count(*) AS record_count, count(*) - count(event_id) AS null_count, CAST(NULL AS BIGINT) AS empty_count,
  CAST(min(event_id) AS DOUBLE) AS min_value, CAST(max(event_id) AS DOUBLE) AS max_value, true AS distinct_within, true AS median_within FROM e
 UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), NULL, min(user_id), max(user_id), true, true FROM e
 UNION ALL SELECT 'value', count(*), count(*) - count(value), NULL, min(value), max(value), true, true FROM e
 UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), count(*) FILTER (WHERE event_type = ''), NULL, NULL, true, NULL FROM e
 UNION ALL SELECT 'props', count(*), count(*) - count(props), count(*) FILTER (WHERE props = ''), NULL, NULL, true, NULL FROM e"""


def profiled_events(events: DataFrame) -> DataFrame:
    """The events with some values missing."""
    return events.withColumn("value", F.when(F.col("event_id") % 4 > 0, F.col("value")))


def within_error(profile: DataFrame, events: DataFrame) -> DataFrame:
    """A profile from sketches, with its estimates held against exact counts of the rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text"), (F.col(c).cast("double") if i < 3 else F.lit(None).cast("double")).alias("number")) for i, c in enumerate(PROFILED)])
    cells = events.select(F.explode(pairs).alias("p")).select("p.*").groupBy("column_name", "text", "number").agg(F.count("*").alias("n"))
    median = F.element_at("quantiles", 2)
    exact = cells.join(profile.select("column_name", median.alias("median")), "column_name").groupBy("column_name").agg(
        F.count("*").alias("exact"), F.sum(F.when(F.col("number") < F.col("median"), F.col("n"))).alias("below"),
        F.sum(F.when(F.col("number") <= F.col("median"), F.col("n"))).alias("upto"))
    filled = F.col("non_null_count")
    near = (F.coalesce("below", F.lit(0)) <= (0.5 + RANK_ERROR) * filled) & (F.col("upto") >= (0.5 - RANK_ERROR) * filled)
    return profile.join(exact, "column_name").select(
        "column_name", "record_count", "null_count", "empty_count", "min_value", "max_value",
        (F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1.0), DISTINCT_ERROR * F.col("exact"))).alias("distinct_within"),
        F.when(median.isNotNull(), near).alias("median_within"))


@register("profile_of_days", PROFILE_SQL)
def profile_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of all days from sketches that were kept day by day, without reading the rows again."""
    path, events = fresh_path(spark, "sketches"), profiled_events(views.table(spark, sf_dir, "events"))
    daily = profile_sketches(events.withColumn("day", F.to_date("ts")), PROFILED, ["day"])
    daily.write.partitionBy("day").parquet(path)
    return within_error(profile_from_sketches(merge_sketches(spark.read.parquet(path))), events)
