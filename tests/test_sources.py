from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assayer.functions.payload import is_truthy, lookup
from assayer.sources import catalog, config, cve, files, incremental, jdbc, kafka, payloads


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported"):
        files.read_files(spark, "x", "xlsx")


def test_options_reach_the_reader(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a;b\n1;x\n")
    df = files.read_files(spark, path, "csv", {"header": True, "sep": ";", "inferSchema": True})
    assert df.dtypes == [("a", "int"), ("b", "string")]


def test_declared_csv_keeps_broken_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,n\n1,5\n2,many\n")
    rows = files.read_declared_csv(
        spark, path, [{"name": "id", "type": "int", "required": True}, {"name": "n", "type": "integer"}]
    ).collect()
    assert [(r["id"], r["n"], r[files.CORRUPT]) for r in rows] == [(1, 5, None), (2, None, "2,many")]


def test_dir_reads_one_extension_and_no_subfolder(spark, tmp_path):
    write(tmp_path / "a.json", '{"a": 1}')
    write(tmp_path / "b.json", '{"a": 2}')
    write(tmp_path / "c.txt", "{}")
    write(tmp_path / "sub" / "d.json", '{"a": 3}')
    assert sorted(r["a"] for r in files.read_dir(spark, str(tmp_path), "json", "a int").collect()) == [1, 2]


def test_payload_lookups(spark):
    df = spark.createDataFrame([('{"a":{"b.c":1,"d":[1,2]},"t":true,"z":0,"e":"","n":null}',), ("not json",)], "p string")
    p = F.col("p")
    row = df.select(
        lookup(p, "a.d").alias("d"), lookup(p, "a.x").alias("x"), is_truthy(lookup(p, "t")).alias("t"),
        is_truthy(lookup(p, "z")).alias("z"), is_truthy(lookup(p, "e")).alias("e"), is_truthy(lookup(p, "n")).alias("n"),
    ).collect()
    assert tuple(row[0]) == ("[1,2]", None, True, False, False, False)
    assert tuple(row[1]) == (None, None, False, False, False, False)


def pages(spark, bodies, source="s"):
    return spark.createDataFrame([(source, i + 1, json.dumps(b)) for i, b in enumerate(bodies)], "source string, page int, payload string")


def ids(df):
    return [r["id"] for r in df.orderBy("page", "position").select("item.id").collect()]


def body(*values, more=True):
    return {"data": {"items": [{"id": v} for v in values]}, "meta": {"has_more": more}}


def test_pages_stop_behind_the_first_without_more(spark):
    landed = pages(spark, [body(1, 2), body(3), body(4, more=False), body(5)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1, 2, 3, 4]


def test_pages_stop_where_the_flag_is_missing_and_at_the_limit(spark):
    landed = pages(spark, [body(1), {"data": {"items": [{"id": 2}]}}, body(3)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1, 2]
    many = pages(spark, [body(i) for i in range(15)])
    assert ids(payloads.normalise_pages(many, "struct<id:int>", "data.items", "meta.has_more")) == list(range(15))
    assert ids(payloads.normalise_pages(many, "struct<id:int>", "data.items", max_pages=12)) == list(range(12))


def test_pages_without_list_end_reading_and_missing_ones_do_not(spark):
    landed = pages(spark, [body(1), {"data": {"items": {"id": 9}}, "meta": {"has_more": True}}, body(3)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1]
    landed = pages(spark, [body(1), {"meta": {"has_more": True}}, body(3)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1, 3]


def test_a_json_null_stops_reading(spark):
    landed = pages(spark, [body(1), {"data": {"items": None}, "meta": {"has_more": True}}, body(3)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1]


def test_a_broken_last_page_does_not_hide_an_earlier_stop(spark):
    landed = pages(spark, [body(1, more=False), {"data": {"items": 5}, "meta": {}}, body(3)])
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "data.items", "meta.has_more")) == [1]


def test_pages_that_are_lists_themselves(spark):
    landed = spark.createDataFrame([("s", 1, '[{"id":1}]'), ("s", 2, ' [{"id":2},{"id":3}]'), ("s", 3, '{"id":4}'), ("s", 4, '[{"id":5}]')], "source string, page int, payload string")
    assert ids(payloads.normalise_pages(landed, "struct<id:int>")) == [1, 2, 3]


def test_flag_beside_the_results_and_broken_payloads(spark):
    landed = spark.createDataFrame(
        [("s", 1, '{"d":{"r":[{"id":1}],"more":1}}'), ("s", 2, '{"d":{"r":[],"more":true}}'), ("s", 3, '{"d":{"r":[{"id":3}],"more":0}}'),
         ("s", 4, '{"d":{"r":[{"id":4}]}}'), ("t", 1, "oops"), ("t", 2, '{"d":{"r":[{"id":9}],"more":true}}')],
        "source string, page int, payload string",
    )
    assert ids(payloads.normalise_pages(landed, "struct<id:int>", "d.r", "d.more")) == [1, 3]


def test_next_links_and_many_sources(spark):
    def linked(v, following):
        return {"results": [{"id": v}], "links": {"next": following} if following else {}}

    a = pages(spark, [linked(1, "p2"), linked(2, None), linked(3, None)], "a")
    b = pages(spark, [linked(10, "p2"), linked(11, "p3"), linked(12, "")], "b")
    read = payloads.normalise_pages(a.union(b), "struct<id:int>", "results", next_link_path="links.next")
    assert sorted(ids(read)) == [1, 2, 10, 11, 12]


def test_hot_source_pages_equal_brute_force(spark):
    rows = []
    for source in range(7):
        count = 10 if source == 0 else 3
        for page in range(1, count + 1):
            rows.append((f"s{source}", page, json.dumps(body(source * 100 + page, more=(page * (source + 1)) % 5 != 0))))
    df = spark.createDataFrame(rows, "source string, page int, payload string")
    expected = []
    for source in range(7):
        for name, page, payload in rows:
            if name == f"s{source}":
                expected.append(json.loads(payload)["data"]["items"][0]["id"])
                if not json.loads(payload)["meta"]["has_more"]:
                    break
    found = payloads.normalise_pages(df, "struct<id:int>", "data.items", "meta.has_more")
    assert sorted(ids(found)) == sorted(expected)


def test_extract_path_takes_lists_and_objects(spark):
    df = spark.createDataFrame([("a", '{"r":[{"id":1},{"id":2}]}'), ("b", '{"r":{"id":3}}'), ("c", "{}"), ("d", "x")], "k string, payload string")
    rows = payloads.extract_path(df, "r", "struct<id:int>").select("k", "item.id").collect()
    assert sorted(map(tuple, rows)) == [("a", 1), ("a", 2), ("b", 3)]


def test_json_array_with_differing_keys(spark):
    df = spark.createDataFrame([('[{"a":1},{"a":2,"b":"x"}]',)], "payload string")
    assert [tuple(r) for r in payloads.json_array_rows(df, "struct<a:int,b:string>").select("item.*").collect()] == [(1, None), (2, "x")]


def test_csv_payload_with_quotes_and_empty_values(spark, tmp_path):
    text = 'id,name\n1,"Doe, J"\n2,\n3,x\n'
    df = spark.createDataFrame([("s", text)], "source string, payload string")
    rows = payloads.csv_text_rows(df, "id int, name string").orderBy("line").collect()
    assert [(r["id"], r["name"]) for r in rows] == [(1, "Doe, J"), (2, None), (3, "x")]
    path = write(tmp_path / "p.csv", text)
    assert [tuple(r) for r in payloads.csv_payload_rows(spark, path).collect()] == [(1, "Doe, J"), (2, None), (3, "x")]
    empty = spark.createDataFrame([("s", "id,name"), ("s", "")], "source string, payload string")
    assert payloads.csv_text_rows(empty, "id int, name string").count() == 0


def test_xml_payload(spark, tmp_path):
    text = "<rows><row><id>1</id></row><row><id>2</id></row></rows>"
    path = write(tmp_path / "p.xml", text)
    assert sorted(r["id"] for r in payloads.xml_payload_rows(spark, path).collect()) == [1, 2]
    df = spark.createDataFrame([(text,)], "payload string")
    assert sorted(r["id"] for r in payloads.xml_text_rows(df, "struct<id:int>").collect()) == [1, 2]


def test_event_values(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "not json"), (3, None), (4, "{}")], "i int, value string")
    good, bad = payloads.split_values(df, "k int")
    assert sorted((r["i"], r["k"]) for r in good.collect() if r["k"] is not None) == [(1, 5)]
    assert sorted(r["i"] for r in good.collect()) == [1, 3, 4]
    assert [tuple(r) for r in bad.collect()] == [(2, "not json")]
    ddl = payloads.infer_json_schema(df.unionByName(spark.createDataFrame([(5, '{"s": {"t": [1.5, 2]}, "n": null}')], df.schema)))
    assert payloads.parse_value(df, ddl).columns == ["i", "_raw", "k", "n", "s", "_corrupt"]
    assert ddl == "STRUCT<k: BIGINT, n: STRING, s: STRUCT<t: ARRAY<DOUBLE>>>"


def test_message_values_by_declaration_by_all_values_or_as_text(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "s": "x"}'), (2, "not json"), (3, None), (4, '{"other": true}')], "offset bigint, value string")

    def decoded(declared, df=df):
        rows, dead = payloads.split_decoded(payloads.decode_values(df, declared))
        return rows.columns, [tuple(r) for r in rows.collect()], [tuple(r) for r in dead.collect()]

    declared = {"type": "struct", "fields": [{"name": "k", "type": "integer", "nullable": True, "metadata": {}}]}
    lost = [(2, "not json")]
    assert decoded(declared) == (["k"], [(5,), (None,), (None,)], lost)
    assert decoded("k int, s string") == (["k", "s"], [(5, "x"), (None, None), (None, None)], lost)
    # every field that any value has
    assert decoded("avro") == (["k", "other", "s"], [(5, None, "x"), (None, None, None), (None, True, None)], lost)
    text = (["value"], [('{"k": 5, "s": "x"}',), ("not json",), (None,), ('{"other": true}',)], [])
    assert decoded(None) == text
    assert decoded("avro", spark.createDataFrame([(1, "no")], df.schema)) == (["value"], [("no",)], [])


def test_decoded_fields_may_have_the_names_of_message_columns(spark):
    df = spark.createDataFrame([("a", 1, '{"key": "own", "offset": 7}'), ("b", 2, "{")], "key string, offset bigint, value string")
    rows, dead = payloads.split_decoded(payloads.decode_values(df, "key string, offset int"))
    assert [tuple(r) for r in rows.collect()] == [("own", 7)]
    assert [r.asDict() for r in dead.collect()] == [{"key": "b", "offset": 2, "raw_value": "{"}]


def test_element_type_of_landed_pages(spark):
    landed = pages(spark, [{"data": {"items": []}}, body(1), {"data": {"items": [{"id": 2, "extra": "x"}]}}])
    assert payloads.infer_element(landed, "data.items") == "struct<extra:string,id:bigint>"
    assert payloads.infer_element(landed, "nowhere") is None


def cve_body(number, **extra):
    metric = {"cvssData": {"version": "3.1", "vectorString": "CVSS:3.1/AV:N", "baseScore": 7.5, "baseSeverity": "HIGH"}}
    return {
        "cve": {
            "id": f"CVE-{number}", "published": f"2023-0{number}-01T00:00:00.000",
            "descriptions": [{"lang": "en", "value": "Log4j problem" if number == 1 else "other"}],
            "metrics": {"cvssMetricV31": [metric]} if number != 3 else {},
            "configurations": [{"nodes": [{"operator": "OR", "cpeMatch": [{"vulnerable": number == 1, "criteria": f"cpe:2.3:a:v{number}"}]}]}],
            **extra,
        }
    }


def feed(spark, *bodies):
    return spark.createDataFrame([(json.dumps(b),) for b in bodies], "payload string")


def test_cve_pages_follow_total_and_limit(spark):
    landed = feed(
        spark,
        {"totalResults": 3, "startIndex": 0, "vulnerabilities": [cve_body(1), cve_body(2)]},
        {"totalResults": 3, "startIndex": 2, "vulnerabilities": [cve_body(3)]},
        {"totalResults": 3, "startIndex": 4, "vulnerabilities": [cve_body(4)]},
    )
    assert sorted(r["id"] for r in cve.read_cve_pages(landed, 2, None).collect()) == ["CVE-1", "CVE-2", "CVE-3"]
    assert cve.read_cve_pages(landed, 2, 1).count() == 2


def test_empty_cve_feed_keeps_its_columns(spark):
    empty = cve.read_cve_pages(feed(spark, {"totalResults": 0, "vulnerabilities": []}))
    assert empty.count() == 0
    assert empty.columns == [
        "id", "sourceIdentifier", "published", "lastModified", "vulnStatus", "descriptions", "metrics", "weaknesses",
        "configurations", "references",
    ]


def test_cve_filters(spark):
    records = cve.read_cve_pages(feed(spark, {"totalResults": 3, "vulnerabilities": [cve_body(1), cve_body(2), cve_body(3)]}))

    def found(**params):
        return sorted(r["id"][-1] for r in cve.filter_cves(records, params).collect())

    assert found(cvssV3Severity="high") == ["1", "2"]
    assert found(cvssV3Severity=None, keywordSearch=None) == ["1", "2", "3"]
    assert found(keywordSearch="LOG4J") == ["1"]
    assert found(cveId="CVE-2") == ["2"]
    assert found(cpeMatchString="cpe:2.3:a:v3") == ["3"]
    assert found(isVulnerable=True) == ["1"]
    assert found(cvssV2Severity="HIGH") == []
    assert found(cvssV3Metrics="AV:N") == ["1", "2"]
    with pytest.raises(ValueError, match="unknown feed"):
        found(colour="red")
    within = cve.published_between(records, dt.datetime(2023, 2, 1), None)
    assert sorted(r["id"] for r in within.collect()) == ["CVE-2", "CVE-3"]
    assert [(r["id"], r["base_score"], r["cpe_count"]) for r in cve.cve_scores(records).orderBy("id").collect()] == [
        ("CVE-1", 7.5, 1), ("CVE-2", 7.5, 1),
    ]


def test_incremental_loads_skip_and_repeat_nothing(spark, tmp_path):
    state = str(tmp_path / "state")
    schema = "id int, t timestamp_ntz"
    day = lambda n: dt.datetime(2024, 1, n)
    arrivals = [
        [(i, day(i)) for i in range(1, 5)] + [(100, None)],
        [(i, day(i)) for i in range(5, 8)] + [(40, day(4)), (101, None)],  # one of the mark's own moment, one without a time
        [],
        [(70, day(7)), (4, day(8))],  # a late tie, and a changed row
    ]
    there, loaded = [], None
    for wave in arrivals:
        there += wave
        df = spark.createDataFrame(there, schema)
        rows = incremental.incremental_scan(df, "t", incremental.load_high_water(spark, state, "s"), loaded, ["id"])
        got = [tuple(r) for r in rows.collect()]
        assert sorted(got, key=str) == sorted(wave, key=str)
        new = spark.createDataFrame(got, schema)
        incremental.advance_high_water(new, "t", state, "s")
        loaded = new if loaded is None else loaded.unionByName(new)
    assert incremental.load_high_water(spark, state, "s") == day(8)
    assert incremental.load_high_water(spark, state, "other") is None


def test_retention(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 25),), (dt.datetime(2024, 1, 24, 23),)], "t timestamp_ntz")
    assert incremental.retain_days(df, "t", 7, dt.datetime(2024, 2, 1)).count() == 1


def test_variables():
    env = {"HOST": "db", "EMPTY": ""}
    assert config.resolve("${HOST}", env) == "db"
    assert config.resolve("${NONE}", env) == ""
    assert config.resolve("Bearer ${NONE}", env) == "Bearer ${NONE}"
    assert config.resolve("http://${HOST}:${PORT:9200}/", env) == "http://db:9200/"
    assert config.resolve("${EMPTY:x}", env) == ""
    assert config.resolve({"a": ["${HOST}", 5]}, env) == {"a": ["db", 5]}


CONFIG = {
    "kafka_sources": [{"name": "k", "topic": "t", "streaming_enabled": True}, {"name": "k2", "topic": "t2"}],
    "file_sources": [{"name": "f", "type": "csv", "path": "/p"}, {"name": "off", "type": "csv", "path": "/p", "enabled": False}],
    "api_sources": [{"name": "a", "base_url": "https://h/v1/", "endpoint": "/now", "response_path": "d", "api_key": "x"}],
    "database_sources": [{"name": "d", "table": "t", "connection": {"type": "mysql", "host": "h", "password": "p"}}],
}


def test_sources_come_in_family_order_with_one_spelling():
    found = list(config.all_sources(CONFIG))
    assert [(f, s["name"]) for f, s in found] == [("file", "f"), ("database", "d"), ("api", "a"), ("kafka", "k"), ("kafka", "k2")]
    settings = {s["name"]: s for _, s in found}
    assert settings["f"]["format"] == "csv"
    assert (settings["a"]["url"], settings["a"]["results_path"]) == ("https://h/v1/now", "d")
    assert config.find_source(CONFIG, "off")[0] == "file"
    assert [s["name"] for s in config.streaming_sources(CONFIG)] == ["k"]
    with pytest.raises(ValueError, match="no source"):
        config.find_source(CONFIG, "zzz")
    with pytest.raises(ValueError, match="unknown source family"):
        config.normalise({}, "ftp")


def test_catalog_leaves_secrets_out(spark):
    rows = {r["name"]: r for r in catalog.source_catalog(spark, CONFIG).collect()}
    assert rows["k"]["streaming"] and not rows["k2"]["streaming"]
    assert rows["a"]["location"] == "https://h/v1/now"
    assert "api_key" not in rows["a"]["settings"] and '"p"' not in rows["d"]["settings"]


def test_jdbc_options():
    source = {
        "connection": {"type": "postgresql", "host": "h", "port": 5432, "database": "d", "user": "u", "password": "p"},
        "table": "sales", "query": "SELECT 1",
    }
    options = jdbc.jdbc_options(source)
    assert options["url"] == "jdbc:postgresql://h:5432/d"
    assert options["driver"] == "org.postgresql.Driver"
    assert options["query"] == "SELECT 1" and "dbtable" not in options
    assert options["fetchsize"] == "10000"
    bounds = {"partitionColumn": "id", "lowerBound": 1, "upperBound": 100000, "numPartitions": 10}
    split = jdbc.jdbc_options({**source, "options": bounds})
    assert split["dbtable"] == "(SELECT 1) source_query" and "query" not in split
    assert split["numPartitions"] == "10"
    assert jdbc.jdbc_options({"url": "jdbc:x:y", "table": "t"})["dbtable"] == "t"
    with pytest.raises(ValueError, match="partitioned read"):
        jdbc.jdbc_options({**source, "options": {"partitionColumn": "id"}})
    with pytest.raises(ValueError, match="table or a query"):
        jdbc.jdbc_options({"url": "jdbc:x:y"})


def test_kafka_options():
    options = kafka.kafka_options(
        {
            "bootstrap_servers": "b:9092", "topic": "t", "group_id": "g", "starting_offsets": "earliest",
            "options": {"failOnDataLoss": False, "maxOffsetsPerTrigger": 10000},
            "authentication": {"type": "SASL_SSL", "username": "u", "password": "p"},
        }
    )
    assert options["subscribe"] == "t"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10000"
    assert 'username="u"' in options["kafka.sasl.jaas.config"]


@pytest.mark.parametrize("read", [kafka.read_kafka_stream, kafka.read_kafka_range])
def test_kafka_readers_ask_for_the_package(spark, read):
    with pytest.raises(AnalysisException, match="kafka"):
        read(spark, {"bootstrap_servers": "b:9092", "topic": "t"})


def test_avro_asks_for_the_package(spark, tmp_path):
    with pytest.raises(AnalysisException, match="(?i)avro"):
        files.read_files(spark, str(tmp_path), "avro")


def test_kafka_sink_inherits_the_brokers():
    options = kafka.kafka_sink_options({"bootstrap_servers": "b:9092", "topic": "t", "group_id": "g"}, "out")
    assert options == {"kafka.bootstrap.servers": "b:9092", "topic": "out"}


def test_json_files(spark, tmp_path):
    lines = write(tmp_path / "a.json", '[{"a":1},{"a":2,"b":"x"}]\n[{"a":3}]\n')
    assert sorted(r["a"] for r in payloads.json_files_rows(spark, lines).collect()) == [1, 2, 3]
    whole = write(tmp_path / "b.json", '[\n{"a":1},\n{"a":2,"b":"x"}\n]')
    assert payloads.json_files_rows(spark, whole, "a int, b string", multi_line=True).count() == 2


def test_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="table name"):
        catalog.read_table(spark, None)
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("assayer_test_table")
    assert catalog.read_table(spark, "assayer_test_table", "default").count() == 3
    described = catalog.describe_tables(spark, "default").where("table_name = 'assayer_test_table'").collect()
    assert [(r["column_name"], r["type"]) for r in described] == [("id", "bigint")]
    spark.sql("DROP TABLE assayer_test_table")


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3,)], "a int")
    assert sorted(map(tuple, catalog.union_sources(a, b).collect()), key=lambda r: r[0]) == [(1, 2), (3, None)]
