"""Queries on scans and landed payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.payload import lookup
from assayer.plans import views
from assayer.plans.catalog import register
from assayer.plans.views import EVENT_PAGES, EVENT_SRC, ITEM
from assayer.session import fresh_path
from assayer.operators.schema import definition_from_frame, definition_from_json, definition_to_json, spark_type, to_struct, type_name
from assayer.sources import catalog, cve, files, incremental, payloads


@register("scan_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_files(spark, f"{sf_dir}/customer.parquet", "parquet")


@register(
    "scan_formats",
    " UNION ALL ".join(
        f"SELECT '{f}' AS file_format, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS total FROM orders"
        for f in ("csv", "json", "orc", "parquet", "text", "xml")
    ),
)
def scan_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    schema = "o_orderkey bigint, o_totalprice double"
    landed = fresh_path(spark, "formats")
    found = []
    for kind in ("csv", "json", "orc", "parquet", "text", "xml"):
        path, options = f"{landed}/{kind}", {}
        if kind == "text":
            orders.select(F.concat_ws(" ", "o_orderkey", "o_totalprice").alias("value")).write.text(path)
            words = F.split("value", " ")
            rows = files.read_files(spark, path, "text").select(
                words[0].cast("bigint").alias("o_orderkey"), words[1].cast("double").alias("o_totalprice")
            )
        else:
            options = {"rowTag": "row", "rootTag": "rows"} if kind == "xml" else {}
            orders.write.format(kind).options(**options).save(path)
            rows = files.read_files(spark, path, kind, options, schema)
        found.append(
            rows.agg(
                F.count(F.lit(1)).alias("n"),
                F.sum("o_orderkey").alias("keys"),
                F.round(F.sum("o_totalprice"), 2).alias("total"),
            ).withColumn("file_format", F.lit(kind))
        )
    return catalog.union_sources(*found)


@register(
    "scan_csv_schema",
    """SELECT c_custkey AS customer, c_name AS name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS balance,
 c_custkey % 10 = 0 AS is_corrupt FROM customer""",
)
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    landed = fresh_path(spark, "declared-csv")
    views.table(spark, sf_dir, "customer").select("c_custkey", "c_name", balance.alias("c_acctbal")).write.option(
        "header", "true"
    ).csv(landed)
    declared = [
        {"name": "customer", "type": "bigint", "required": True},
        {"name": "name", "type": "string", "required": True},
        {"name": "balance", "type": "double", "required": False},
    ]
    rows = files.read_declared_csv(spark, landed, declared, {"enforceSchema": "true"})
    return rows.select("customer", "name", "balance", F.col(files.CORRUPT).isNotNull().alias("is_corrupt"))


@register("scan_dir", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "folder")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    orders.write.mode("append").parquet(folder)
    orders.write.mode("append").json(folder)
    orders.write.mode("append").parquet(f"{folder}/nested")
    return files.read_dir(spark, folder, "parquet", orders.schema)


@register(
    "scan_merge_schema",
    """SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_name END AS c_name, CASE WHEN c_nationkey >= 12 THEN c_acctbal END AS c_acctbal
 FROM customer""",
)
def scan_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "merge")
    customers = views.table(spark, sf_dir, "customer")
    customers.where("c_nationkey < 12").select("c_custkey", "c_name").write.parquet(f"{folder}/part=1")
    customers.where("c_nationkey >= 12").select("c_custkey", "c_acctbal").write.parquet(f"{folder}/part=2")
    return files.read_parquet_merged(spark, folder).select("c_custkey", "c_name", "c_acctbal")


@register(
    "json_extract_path",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events",
)
def json_extract_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", lookup(F.col("props"), "k").alias("k"), lookup(F.col("props"), "missing").alias("missing")
    )


@register(
    "payload_rows",
    f"""SELECT source, page, id, v, kind FROM {EVENT_PAGES} WHERE number % 23 <> 5 AND number % 19 <> 3
 UNION ALL SELECT source, page, id, v, kind FROM {EVENT_PAGES} WHERE number % 23 = 5 AND id % 100 = 0""",
)
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.extract_path(views.api_pages(spark, sf_dir), "data.items", ITEM).select("source", "page", "item.*")


@register(
    "api_pages",
    f"""WITH p AS (SELECT *, number % 17 = 9 AS last, number % 23 = 5 AS bad, number % 23 <> 5 AND number % 19 = 3 AS absent FROM {EVENT_PAGES}),
 s AS (SELECT source, min(CASE WHEN last AND NOT bad THEN page END) AS last_page, min(CASE WHEN bad THEN page END) AS bad_page FROM p GROUP BY source)
 SELECT p.source, p.page, p.id, p.v, p.kind FROM p JOIN s ON s.source = p.source
 WHERE NOT p.absent AND (s.last_page IS NULL OR p.page <= s.last_page) AND (s.bad_page IS NULL OR p.page < s.bad_page)""",
)
def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = payloads.normalise_pages(views.api_pages(spark, sf_dir), ITEM, "data.items", has_more_path="meta.has_more")
    return items.select("source", "page", "item.*")


@register(
    "api_pages_limited",
    f"""SELECT source, page, id, v, kind FROM {EVENT_PAGES} WHERE page <= 5""",
)
def api_pages_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit a caller may set on the pages of a source."""
    pages = views.event_pages(spark, sf_dir).select("source", "page", F.to_json("items").alias("payload"))
    return payloads.normalise_pages(pages, ITEM, max_pages=5).select("source", "page", "item.*")


@register(
    "api_linked_pages",
    f"""WITH p AS (SELECT *, number % 13 = 7 AS last FROM {EVENT_PAGES}),
 s AS (SELECT source, min(CASE WHEN last THEN page END) AS last_page FROM p GROUP BY source)
 SELECT p.source, p.page, p.id, p.v, p.kind FROM p JOIN s ON s.source = p.source WHERE s.last_page IS NULL OR p.page <= s.last_page""",
)
def api_linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = payloads.normalise_pages(views.linked_pages(spark, sf_dir), ITEM, "results", next_link_path="links.next")
    return items.select("source", "page", "item.*")


@register("json_array_rows", f"SELECT source, page, id, v, kind FROM {EVENT_PAGES}")
def json_array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.event_pages(spark, sf_dir).select("source", "page", F.to_json("items").alias("payload"))
    return payloads.json_array_rows(pages, ITEM).select("source", "page", "item.*")


@register("json_files", "SELECT id, v, kind FROM " + EVENT_PAGES)
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fresh_path(spark, "json-payload")
    views.event_pages(spark, sf_dir).select(F.to_json("items").alias("value")).write.text(landed)
    return payloads.json_files_rows(spark, landed).select("id", "v", "kind")


@register("csv_payload", f"SELECT source, page, id, v, kind FROM {EVENT_PAGES}")
def csv_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform("items", lambda i: F.concat_ws(",", i["id"].cast("string"), i["v"].cast("string"), i["kind"]))
    text = F.concat(F.lit("id,v,kind\n"), F.array_join(lines, "\n"))
    pages = views.event_pages(spark, sf_dir).select("source", "page", text.alias("payload"))
    return payloads.csv_text_rows(pages, "id bigint, v double, kind string").drop("line")


@register(
    "csv_files",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment || ', "' || c_name || '"' END AS address FROM customer""",
)
def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fresh_path(spark, "csv-payload")
    address = F.when(
        F.col("c_custkey") % 11 != 0, F.concat(F.col("c_mktsegment"), F.lit(', "'), F.col("c_name"), F.lit('"'))
    )
    views.table(spark, sf_dir, "customer").select("c_custkey", "c_name", address.alias("address")).write.option(
        "header", "true"
    ).option("escape", '"').csv(landed)
    schema = "c_custkey bigint, c_name string, address string"
    return payloads.csv_payload_rows(spark, landed, schema, escape='"', multiLine="true")


@register("xml_payload", f"SELECT source, page, id, v, kind FROM {EVENT_PAGES}")
def xml_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_xml(F.struct(F.col("items").alias("row")), {"rowTag": "rows"})
    pages = views.event_pages(spark, sf_dir).select("source", "page", text.alias("payload"))
    return payloads.xml_text_rows(pages, ITEM)


@register("xml_files", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fresh_path(spark, "xml-payload")
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    customers.write.format("xml").options(rootTag="rows", rowTag="row").save(landed)
    return payloads.xml_payload_rows(spark, landed, "row", "c_custkey bigint, c_name string, c_acctbal double")


@register(
    "cve_rows",
    """SELECT id, source AS sourceIdentifier, strftime(published, '%Y-%m-%dT%H:%M:%S') || '.000' AS published, status AS "vulnStatus",
 lang, text AS description, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS INT) AS metric_families, cpe_count FROM """
    + views.CVES,
)
def cve_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cves = cve.read_cve_pages(views.cve_pages(spark, sf_dir), views.CVES_PER_PAGE, None)
    return cves.select(
        "id",
        "sourceIdentifier",
        "published",
        "vulnStatus",
        F.col("descriptions")[0]["lang"].alias("lang"),
        F.col("descriptions")[0]["value"].alias("description"),
        F.size("metrics").alias("metric_families"),
        F.size(F.col("configurations")[0]["nodes"][0]["cpeMatch"]).alias("cpe_count"),
    )


@register(
    "cve_metrics",
    f"""SELECT id, 'cvssMetricV31' AS metric_family, '3.1' AS cvss_version, score AS base_score, {views.SEVERITY} AS severity, cpe_count
 FROM {views.CVES} UNION ALL SELECT id, 'cvssMetricV2', '2.0', score, {views.SEVERITY}, cpe_count FROM {views.CVES} WHERE doc_id % 3 = 0""",
)
def cve_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cve.cve_scores(cve.read_cve_pages(views.cve_pages(spark, sf_dir), views.CVES_PER_PAGE, None))


@register(
    "cve_range",
    f"""SELECT id FROM {views.CVES} WHERE published BETWEEN TIMESTAMP '2023-01-05 00:00:00' AND TIMESTAMP '2023-12-31 23:59:59.999'""",
)
def cve_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    cves = cve.read_cve_pages(views.cve_pages(spark, sf_dir), views.CVES_PER_PAGE, None)
    return cve.published_between(cves, datetime(2023, 1, 5), datetime(2023, 12, 31, 23, 59, 59, 999000)).select("id")


@register(
    "cve_filters",
    f"""SELECT id FROM {views.CVES} WHERE {views.SEVERITY} = 'HIGH' AND contains(lower(text), 'en')
 AND starts_with(source, 'src1') AND doc_id % 2 = 0""",
)
def cve_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    cves = cve.read_cve_pages(views.cve_pages(spark, sf_dir), views.CVES_PER_PAGE, None)
    params = {
        "cvssV3Severity": "HIGH",
        "keywordSearch": "en",
        "cpeMatchString": "cpe:2.3:a:src1",
        "isVulnerable": True,
        "cveId": None,
        "cvssV2Metrics": None,
    }
    return cve.filter_cves(cves, params).select("id")


@register(
    "date_range_filter",
    """SELECT o_orderkey, o_totalprice FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59'""",
)
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    return incremental.date_range(orders, "o_orderdate", datetime(1997, 1, 1), datetime(1997, 12, 31, 23, 59, 59)).select(
        "o_orderkey", "o_totalprice"
    )


@register(
    "incremental_load",
    """SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00')
 AND event_id NOT IN (SELECT event_id FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00')""",
)
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = fresh_path(spark, "state")
    events = views.table(spark, sf_dir, "events")
    first = incremental.date_range(
        incremental.incremental_scan(events, "ts", incremental.load_high_water(spark, state, "events")),
        "ts",
        None,
        datetime(2024, 1, 20),
    )
    incremental.advance_high_water(first, "ts", state, "events")
    mark = incremental.load_high_water(spark, state, "events")
    return incremental.incremental_scan(events, "ts", mark, first, ["event_id"]).select("event_id", "event_type")


@register("retention", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.retain_days(views.table(spark, sf_dir, "events"), "ts", 7, datetime(2024, 2, 1)).select("event_id")


@register("typed_by_definition", "SELECT event_id, user_id, event_type, value, ts FROM events")
def typed_by_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns brought to the types of a definition that was kept as JSON."""
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    kept = definition_from_json(definition_to_json(definition_from_frame(events, "events")), "events", 1)
    texts = events.select(*[F.col(c).cast("string") for c in events.columns])
    return texts.select(*[F.col(f.name).cast(spark_type(type_name(f.dataType))) for f in to_struct(kept).fields])


@register("parse_event_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def parse_event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return payloads.parse_value(events, "k int").select("event_id", "k")


@register("infer_event_schema", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def infer_event_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return payloads.parse_value(events, payloads.infer_json_schema(events)).select("event_id", "k")


@register(
    "bad_json_split",
    f"""SELECT count(*) FILTER (WHERE payload = 'not json') AS dead_letter, count(*) FILTER (WHERE payload <> 'not json') AS parsed,
 count(*) FILTER (WHERE payload IS NULL) AS empty_value FROM {EVENT_SRC}""",
)
def bad_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payloads.parse_value(views.event_src(spark, sf_dir), "k int", "payload")
    state = payloads.value_state(F.col("_raw"), F.col("_corrupt"))
    return rows.agg(
        F.count_if(state == "dead_letter").alias("dead_letter"),
        F.count_if(state == "parsed").alias("parsed"),
        F.count_if(state == "empty").alias("empty_value"),
    )


@register(
    "union_sources",
    """SELECT c_custkey AS id, 'customer' AS src, c_mktsegment AS segment FROM customer
 UNION ALL SELECT s_suppkey AS id, 'supplier' AS src, NULL AS segment FROM supplier""",
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.lit("customer").alias("src"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("src"))
    return catalog.union_sources(customers, suppliers)


@register(
    "source_catalog",
    """SELECT s_name AS name, CASE s_nationkey % 5 WHEN 0 THEN 'file' WHEN 1 THEN 'database' WHEN 2 THEN 'api' WHEN 3 THEN 'kafka' ELSE 'nvd' END AS family,
 '/landing/' || CAST(s_suppkey AS VARCHAR) AS location, s_acctbal > 0 AS enabled, s_nationkey % 5 = 3 AS streaming,
 '{"host":"h' || CAST(s_nationkey AS VARCHAR) || '"}' AS settings FROM supplier""",
)
def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of sources whose configuration is kept as a table."""
    kind = F.col("s_nationkey") % 5
    family = F.when(kind == 0, "file").when(kind == 1, "database").when(kind == 2, "api").when(kind == 3, "kafka").otherwise("nvd")
    place = F.when(kind == 1, "table").when(kind == 3, "topic").otherwise("path")
    settings = F.create_map(
        place, F.concat(F.lit("/landing/"), F.col("s_suppkey").cast("string")),
        F.lit("host"), F.concat(F.lit("h"), F.col("s_nationkey").cast("string")),
        F.lit("password"), F.col("s_name"), F.lit("api_key"), F.col("s_name"),
    )
    configured = views.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), family.alias("family"), settings.alias("settings"), (F.col("s_acctbal") > 0).alias("enabled"), (kind == 3).alias("streaming"))
    rows = catalog.catalog_rows(configured)
    kept = F.map_filter(F.from_json("settings", "map<string,string>"), lambda k, _: ~k.isin("path", "table", "topic"))
    return rows.withColumn("settings", F.to_json(kept))


@register("event_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup')")
def event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return events.where(F.col("event_type").isin("error", "signup")).select("event_id", "event_type")
