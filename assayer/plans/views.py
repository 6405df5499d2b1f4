"""Input views over the given tables: feeds with planted defects, run results, landed payloads, registries.

Each view exists twice, as a DataFrame and as the text of an SQL sub-query.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 2, 1)
RUN_AT = datetime(2024, 2, 1)
LAST_DAY = date(2024, 1, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def customer_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_customer_src(table(spark, sf_dir, "customer"))


def as_customer_src(customers: DataFrame) -> DataFrame:
    """Customer feed: null names and phones, malformed mails and phones, empty addresses, NaN balances."""
    key = F.col("c_custkey")
    return customers.select(
        F.concat(F.lit("CUST-"), padded(key, 6)).alias("customer_id"),
        F.when(key % 13 != 0, F.col("c_name")).alias("name"),
        F.when(key % 9 == 0, "bad.address")
        .otherwise(F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 7 == 0, "12-34")
        .otherwise(F.concat(F.lit("+1"), padded(key, 10)))
        .alias("phone"),
        F.when(key % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("address"),
        F.when(key % 19 == 0, float("nan")).otherwise(F.col("c_acctbal")).alias("acctbal"),
        (F.timestamp_add("DAY", (key % 40).cast("int"), ntz("2024-01-01 00:00:00"))).alias("created_at"),
    )


CUSTOMER_SRC = """(
SELECT 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS name,
       CASE WHEN c_custkey % 9 = 0 THEN 'bad.address' ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
       CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '12-34'
            ELSE '+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS phone,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS address,
       CASE WHEN c_custkey % 19 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS acctbal,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 40 AS INT)) AS created_at
FROM customer) customer_src"""


def sales_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales feed: null and zero quantities, missing and unknown payment methods."""
    lines, orders, parts = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    priority = F.col("o_orderpriority")
    return (
        lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(parts, F.col("p_partkey") == F.col("l_partkey"))
        .select(
            F.concat(F.lit("TXN-"), padded(F.col("l_orderkey") * 10 + F.col("l_linenumber"), 8)).alias("transaction_id"),
            F.concat(F.lit("CUST-"), padded(F.col("o_custkey"), 6)).alias("customer_id"),
            F.concat(F.lit("PRD-"), padded(F.col("l_partkey"), 6)).alias("product_id"),
            F.when(F.col("l_orderkey") % 17 == 0, F.lit(None))
            .when(F.col("l_linenumber") == 7, 0)
            .otherwise(F.col("l_quantity").cast("int"))
            .alias("quantity"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("total_price"),
            F.col("l_shipdate").alias("transaction_date"),
            F.when(priority == "1-URGENT", "CREDIT")
            .when(priority == "2-HIGH", "DEBIT")
            .when(priority == "3-MEDIUM", "CASH")
            .when(priority == "4-NOT SPECIFIED", F.lit(None))
            .otherwise("VOUCHER")
            .alias("payment_method"),
        )
    )


SALES_SRC = """(
SELECT 'TXN-' || lpad(CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR), 8, '0') AS transaction_id,
       'CUST-' || lpad(CAST(o.o_custkey AS VARCHAR), 6, '0') AS customer_id,
       'PRD-' || lpad(CAST(l.l_partkey AS VARCHAR), 6, '0') AS product_id,
       CASE WHEN l.l_orderkey % 17 = 0 THEN NULL WHEN l.l_linenumber = 7 THEN 0 ELSE CAST(l.l_quantity AS INT) END AS quantity,
       CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(l.l_extendedprice AS DECIMAL(10,2)) AS total_price,
       l.l_shipdate AS transaction_date,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CREDIT' WHEN '2-HIGH' THEN 'DEBIT' WHEN '3-MEDIUM' THEN 'CASH'
            WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'VOUCHER' END AS payment_method
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey) sales_src"""


def as_event_src(events: DataFrame) -> DataFrame:
    """Message feed: some payloads are null, some cannot be decoded."""
    return events.select(
        F.concat(F.lit("feed-"), F.col("event_type")).alias("source_name"),
        "event_id",
        "ts",
        "value",
        F.when(F.col("event_id") % 50 == 0, "not json")
        .when(F.col("event_id") % 21 == 0, F.lit(None))
        .otherwise(F.col("props"))
        .alias("payload"),
    )


def event_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_src(table(spark, sf_dir, "events"))


EVENT_SRC = """(
SELECT 'feed-' || event_type AS source_name, event_id, ts, value,
       CASE WHEN event_id % 50 = 0 THEN 'not json' WHEN event_id % 21 = 0 THEN NULL ELSE props END AS payload
FROM events) event_src"""


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of source runs: all statuses, families and tiers, many runs per source."""
    kind = F.col("user_id") % 5
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("src-"), F.col("user_id").cast("string")).alias("source_name"),
        F.when(kind == 0, "file").when(kind == 1, "database").when(kind == 2, "api").when(kind == 3, "kafka")
        .otherwise("nvd")
        .alias("source_type"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "pending")
        .otherwise("success")
        .alias("status"),
        F.when(value >= 100, "gold").when(value >= 50, "silver").when(value >= 10, "bronze").otherwise("rejected")
        .alias("classification"),
        F.floor(value * 10).cast("bigint").alias("record_count"),
        F.col("ts").alias("finished_at"),
    )


SOURCE_RUNS = """(
SELECT event_id AS seq, 'src-' || CAST(user_id AS VARCHAR) AS source_name,
       CASE user_id % 5 WHEN 0 THEN 'file' WHEN 1 THEN 'database' WHEN 2 THEN 'api' WHEN 3 THEN 'kafka' ELSE 'nvd' END AS source_type,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' ELSE 'success' END AS status,
       CASE WHEN value >= 100 THEN 'gold' WHEN value >= 50 THEN 'silver' WHEN value >= 10 THEN 'bronze' ELSE 'rejected' END AS classification,
       CAST(floor(value * 10) AS BIGINT) AS record_count, ts AS finished_at
FROM events) source_runs"""


def declared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema registry: one schema per brand, up to twelve versions each, fields named after parts."""
    kind = F.col("p_type")
    declared = table(spark, sf_dir, "part").select(
        F.concat(F.lit("feed-"), F.lower(F.translate("p_brand", "#", "-"))).alias("schema_name"),
        F.concat(F.lit("v"), (F.col("p_size") % 12 + 1).cast("string")).alias("version_label"),
        (F.col("p_size") % 12 + 1).cast("int").alias("version"),
        F.translate("p_name", " ", "_").alias("name"),
        F.when(kind == "ECONOMY", "integer").when(kind == "STANDARD", "string").when(kind == "PROMO", "double")
        .when(kind == "SMALL", "decimal(10,2)").when(kind == "MEDIUM", "timestamp").otherwise("float")
        .alias("type"),
        (F.col("p_partkey") % 3 != 0).alias("nullable"),
        "p_partkey",
    )
    return declared.groupBy("schema_name", "version_label", "version", "name").agg(
        F.min_by("type", "p_partkey").alias("type"), F.min_by("nullable", "p_partkey").alias("nullable")
    )


DECLARED_FIELDS = """(
SELECT schema_name, version_label, version, name, arg_min(type, p_partkey) AS type, arg_min(nullable, p_partkey) AS nullable
FROM (SELECT 'feed-' || lower(replace(p_brand, '#', '-')) AS schema_name,
             'v' || CAST(p_size % 12 + 1 AS VARCHAR) AS version_label,
             CAST(p_size % 12 + 1 AS INT) AS version,
             replace(p_name, ' ', '_') AS name,
             CASE p_type WHEN 'ECONOMY' THEN 'integer' WHEN 'STANDARD' THEN 'string' WHEN 'PROMO' THEN 'double'
                  WHEN 'SMALL' THEN 'decimal(10,2)' WHEN 'MEDIUM' THEN 'timestamp' ELSE 'float' END AS type,
             p_partkey % 3 <> 0 AS nullable, p_partkey
      FROM part) d
GROUP BY schema_name, version_label, version, name) declared_fields"""


def observed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields seen in delivered records: every line item delivers the field of its part.

    Line items are reduced to one row per part before the join.
    """
    key = F.col("p_partkey")
    seen = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.bool_or(F.col("l_discount") == 0).alias("nullable"))
    fields = (
        table(spark, sf_dir, "part")
        .join(seen, key == F.col("l_partkey"))
        .select(
            F.concat(F.lit("feed-"), F.lower(F.translate("p_brand", "#", "-"))).alias("schema_name"),
            F.concat(F.translate("p_name", " ", "_"), F.when(key % 7 == 0, "_raw").otherwise("")).alias("name"),
            F.when(key % 5 == 0, "bigint").when(key % 5 == 1, "string").when(key % 5 == 2, "decimal(12,4)")
            .when(key % 5 == 3, "timestamp_ntz").otherwise("double")
            .alias("type"),
            "nullable",
            key,
        )
    )
    return fields.groupBy("schema_name", "name").agg(
        F.min_by("type", "p_partkey").alias("type"), F.bool_or("nullable").alias("nullable")
    )


OBSERVED_FIELDS = """(
SELECT schema_name, name, arg_min(type, p_partkey) AS type, bool_or(nullable) AS nullable
FROM (SELECT 'feed-' || lower(replace(p_brand, '#', '-')) AS schema_name,
             replace(p_name, ' ', '_') || CASE WHEN p_partkey % 7 = 0 THEN '_raw' ELSE '' END AS name,
             CASE p_partkey % 5 WHEN 0 THEN 'bigint' WHEN 1 THEN 'string' WHEN 2 THEN 'decimal(12,4)'
                  WHEN 3 THEN 'timestamp_ntz' ELSE 'double' END AS type,
             l_discount = 0 AS nullable, p_partkey
      FROM part JOIN lineitem ON l_partkey = p_partkey) o
GROUP BY schema_name, name) observed_fields"""


def versions_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version that the newest part of each brand was delivered in."""
    return table(spark, sf_dir, "part").groupBy(
        F.concat(F.lit("feed-"), F.lower(F.translate("p_brand", "#", "-"))).alias("schema_name")
    ).agg(F.max_by((F.col("p_size") % 12 + 1).cast("int"), "p_partkey").alias("current"))


VERSIONS_IN_USE = """(
SELECT 'feed-' || lower(replace(p_brand, '#', '-')) AS schema_name, arg_max(CAST(p_size % 12 + 1 AS INT), p_partkey) AS current
FROM part GROUP BY 1) versions_in_use"""

LATEST_VERSIONS = f"(SELECT schema_name, max(version) AS latest FROM {DECLARED_FIELDS} GROUP BY schema_name) latest_versions"

# A response page holds this many events, and a source answers with this many pages.
PAGE_SIZE = 100
PAGES_PER_SOURCE = 12


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed response pages: (source, page, items), each with one page worth of events in id order."""
    number = F.expr(f"event_id div {PAGE_SIZE}")
    return (
        table(spark, sf_dir, "events")
        .groupBy(number.alias("number"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(F.col("event_id").alias("id"), F.col("value").alias("v"), F.col("event_type").alias("kind"))
                )
            ).alias("items")
        )
        .select(
            F.concat(F.lit("api-"), F.expr(f"number div {PAGES_PER_SOURCE}").cast("string")).alias("source"),
            (F.col("number") % PAGES_PER_SOURCE + 1).cast("int").alias("page"),
            "number",
            "items",
        )
    )


EVENT_PAGES = f"""(
SELECT 'api-' || CAST(event_id // {PAGE_SIZE} // {PAGES_PER_SOURCE} AS VARCHAR) AS source,
       CAST(event_id // {PAGE_SIZE} % {PAGES_PER_SOURCE} + 1 AS INT) AS page,
       event_id // {PAGE_SIZE} AS number, event_id AS id, value AS v, event_type AS kind
FROM events) event_pages"""

ITEM = "struct<id:bigint,v:double,kind:string>"


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a ``meta.has_more`` flag. Some end early, some lack their results, some hold an object instead."""
    number = F.col("number")
    meta = F.struct((number % 17 != 9).alias("has_more"))
    listed = F.to_json(F.struct(F.struct("items").alias("data"), meta.alias("meta")))
    as_object = F.to_json(F.struct(F.struct(F.element_at("items", 1).alias("items")).alias("data"), meta.alias("meta")))
    absent = F.to_json(F.struct(meta.alias("meta")))
    payload = F.when(number % 23 == 5, as_object).when(number % 19 == 3, absent).otherwise(listed)
    return event_pages(spark, sf_dir).select("source", "page", payload.alias("payload"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that name the next one under ``links.next``, or nothing on the last."""
    following = F.when(F.col("number") % 13 != 7, F.concat(F.lit("p"), (F.col("page") + 1).cast("string")))
    payload = F.to_json(F.struct(F.col("items").alias("results"), F.struct(following.alias("next")).alias("links")))
    return event_pages(spark, sf_dir).select("source", "page", payload.alias("payload"))


CVES_PER_PAGE = 20


def cve_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed vulnerability feed pages whose records are the documents, whole texts included."""
    key = F.col("doc_id")
    text = F.struct(F.col("lang"), F.col("text").alias("value"))
    score = (key % 101 / 10).cast("float")
    severity = F.when(score >= 9, "CRITICAL").when(score >= 7, "HIGH").when(score >= 4, "MEDIUM").otherwise("LOW")

    def entry(version: str, vector: str) -> Column:
        data = F.struct(
            F.lit(version).alias("version"),
            F.lit(vector).alias("vectorString"),
            score.alias("baseScore"),
            severity.alias("baseSeverity"),
        )
        return F.struct(
            F.col("source"),
            F.lit("Primary").alias("type"),
            data.alias("cvssData"),
            (score / 2).cast("float").alias("exploitabilityScore"),
            (score / 4).cast("float").alias("impactScore"),
        )

    newer = F.create_map(F.lit("cvssMetricV31"), F.array(entry("3.1", "CVSS:3.1/AV:N")))
    both = F.create_map(
        F.lit("cvssMetricV31"), F.array(entry("3.1", "CVSS:3.1/AV:N")), F.lit("cvssMetricV2"), F.array(entry("2.0", "AV:N/AC:L"))
    )
    matches = F.transform(
        F.sequence(F.lit(0), (key % 3).cast("int")),
        lambda i: F.struct(
            (key % 2 == 0).alias("vulnerable"),
            F.concat(F.lit("cpe:2.3:a:"), F.col("source"), F.lit(":"), i.cast("string")).alias("criteria"),
        ),
    )
    node = F.struct(F.lit("OR").alias("operator"), F.lit(False).alias("negate"), matches.alias("cpeMatch"))
    cve = F.struct(
        F.concat(F.lit("CVE-2023-"), padded(key, 8)).alias("id"),
        F.col("source").alias("sourceIdentifier"),
        F.date_format(F.timestamp_add("HOUR", (key % 9000).cast("int"), ntz("2023-01-01 00:00:00")), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("published"),
        F.date_format(F.timestamp_add("HOUR", (key % 9500).cast("int"), ntz("2023-01-02 00:00:00")), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("lastModified"),
        F.when(key % 4 == 0, "Modified").otherwise("Analyzed").alias("vulnStatus"),
        F.array(text).alias("descriptions"),
        F.when(key % 3 == 0, both).otherwise(newer).alias("metrics"),
        F.array(F.struct(F.array(node).alias("nodes"))).alias("configurations"),
    )
    documents = table(spark, sf_dir, "documents")
    total = documents.count()
    page = F.expr(f"doc_id div {CVES_PER_PAGE}")
    return (
        documents.select(page.alias("page"), F.struct(cve.alias("cve")).alias("v"))
        .groupBy("page")
        .agg(F.collect_list("v").alias("vulnerabilities"))
        .select(
            F.to_json(
                F.struct(
                    F.lit(total).alias("totalResults"),
                    F.lit(CVES_PER_PAGE).alias("resultsPerPage"),
                    (F.col("page") * CVES_PER_PAGE).alias("startIndex"),
                    "vulnerabilities",
                )
            ).alias("payload")
        )
    )


CVES = """(
SELECT doc_id, 'CVE-2023-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS id, source,
       TIMESTAMP '2023-01-01 00:00:00' + to_hours(CAST(doc_id % 9000 AS INT)) AS published,
       CASE WHEN doc_id % 4 = 0 THEN 'Modified' ELSE 'Analyzed' END AS status, text, lang,
       CAST(CAST(doc_id % 101 AS DOUBLE) / 10 AS FLOAT) AS score,
       CAST(doc_id % 3 + 1 AS INT) AS cpe_count
FROM documents) cves"""
SEVERITY = "CASE WHEN score >= 9 THEN 'CRITICAL' WHEN score >= 7 THEN 'HIGH' WHEN score >= 4 THEN 'MEDIUM' ELSE 'LOW' END"
