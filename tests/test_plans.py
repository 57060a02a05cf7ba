from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark import crypto, events, io, jsonx, vault, views
from veilmark.plans import cdc, documents, loans
from veilmark.sources import files, versioned
from veilmark.streaming import consume_stream

HISTORY = "array<struct<email:string,mobile_phone:string,stack:string,created_at:timestamp,loan_application_oid:string>>"
EVENTS = f"national_id string, market string, history {HISTORY}, compliance_event string, is_valid_national_id string"
DAY = datetime.datetime(2024, 1, 1)


def entry(email=None, mobile=None, stack="s", oid="1", at=DAY):
    return (email, mobile, stack, at, oid)


def sample_vault(spark, at="2024-01-01"):
    rows = [
        ("100000000001", "SE", [entry("a@x", "+46701", "s", "app1")], "flag", "valid"),
        ("100000000001", "SE", [entry("a2@x", None, "s", "app2")], "flag", "valid"),
        ("100000000002", "NO", [entry("b@x", "+4712345678", "t", "app1", DAY)], "flag", "valid"),
        ("100000000003", "SE", [], "flag_gdpr_5_year_complaint", "valid"),
        ("100000000004", "SE", [], "flag", "invalid"),
    ]
    return vault.build(spark.createDataFrame(rows, EVENTS), "secret", F.lit(at).cast("timestamp"))


# ------------------------------------------------------------------ vault


def test_vault_has_one_row_per_person_and_market(spark):
    rows = sample_vault(spark).collect()
    assert sorted(r.ssn for r in rows) == ["100000000001", "100000000002"]
    merged = next(r for r in rows if r.ssn.endswith("1"))
    assert sorted(h.email for h in merged.history) == ["a2@x", "a@x"]
    assert not merged.is_anonymized and len(merged.aead_key) == 32
    assert rows[0].__fields__ == list(vault.VAULT_COLUMNS)


def test_insert_absent_is_idempotent(spark):
    first = sample_vault(spark)
    again = vault.insert_absent(first, sample_vault(spark, "2025-01-01"))
    assert again.count() == first.count()
    assert {r.ingestion_timestamp for r in again.collect()} == {DAY}


def test_flag_update_leaves_flagged_rows_alone(spark):
    view = spark.createDataFrame([("100000000001",)], "ssn_clean string")
    later = F.lit("2024-02-01").cast("timestamp")
    once = vault.mark_anonymised(sample_vault(spark), {"v": view}, as_of=later)
    twice = vault.mark_anonymised(once, {"v": view}, as_of=F.lit("2024-03-01").cast("timestamp"))
    flags = {r.ssn: (r.is_anonymized, r.ingestion_timestamp.month) for r in twice.collect()}
    assert flags == {"100000000001": (True, 2), "100000000002": (False, 1)}
    assert vault.mark_anonymised(once, {"v": spark.range(1)}, as_of=later, keyless={"v"}).count() == 2
    with pytest.raises(ValueError, match="without a key column"):
        vault.mark_anonymised(once, {"v": spark.range(1)}, as_of=later)


def test_lookup_has_one_row_per_key(spark):
    keys = sample_vault(spark)
    for by, stack in (("ssn", None), ("email", None), ("mobile", None), ("app", "s")):
        found = vault.lookup(keys, by, stack)
        assert found.count() == found.select("key").distinct().count() > 0
    with pytest.raises(ValueError):
        vault.lookup(keys, "app")


# ------------------------------------------------------------------ views


def test_strategy_choice():
    def kind(columns, tags=("email", "ssn", "phone", "notes"), **extra):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns.split()])
        return views.classify(schema, tags, "t", **extra).kind

    assert kind("ssn email phone application_id") == "ssn"
    assert kind("application_id email phone") == "app"
    assert kind("email phone") == "double"
    assert kind("email_address notes") == "email"
    assert kind("mobile_phone notes") == "mobile"
    assert kind("puhelin notes") == "mobile"
    assert kind("notes other") == "unkeyed"
    assert kind("ssn email", dataset="d", exclude_datasets={"d"}) == "passthrough"
    assert kind("other application_id") == "passthrough"
    assert kind("ssn email", exclude={"t"}) == "passthrough"
    assert kind("foreigner_ssn email") == "email"


def test_tagged_table_without_a_key_is_refused(spark):
    """A key inside an array names many people; the table must not be published in clear."""
    schema = "id int, contacts array<struct<email:string,notes:string>>"
    df = spark.createDataFrame([(1, [("a@x", "n")])], schema)
    assert views.classify(df, {"email", "notes"}, "t").kind == "unkeyed"
    with pytest.raises(ValueError, match="no key outside arrays"):
        views.encrypted_view(df, "t", "SE", {"email", "notes"}, sample_vault(spark))
    open_ = views.encrypted_view(df, "t", "SE", {"email"}, sample_vault(spark), dataset="d", exclude_datasets={"d"})
    assert [r.is_anonymised for r in open_.collect()] == [False]


def test_selecting_one_column_reads_it_and_the_key(spark, small):
    customers = spark.read.parquet(f"{small}/customer.parquet").withColumnRenamed("c_phone", "ssn")
    view = views.encrypted_view(customers, "t", "SE", {"ssn"}, sample_vault(spark)).select("c_name")
    plan = view._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "customer.parquet" in line]
    assert len(reads) == 1 and "c_name" in reads[0] and "c_acctbal" not in reads[0] and "c_address" not in reads[0]


def test_placeholder_ids_gather_no_history(spark):
    """A third of the events without a real id: one row without history, everybody else complete."""
    schema = (
        "national_id string, market string, history array<struct<email:string>>, is_valid_national_id string, "
        "compliance_event string"
    )
    rows = [(["0", "", str(i)][i % 3] if i % 3 else "0", "SE", [(f"{i}@x",)], "valid", "e") for i in range(60)]
    built = {r.ssn: len(r.history) for r in vault.build(spark.createDataFrame(rows, schema), "secret").collect()}
    assert built["0"] == built[""] == 0 and all(n == 1 for ssn, n in built.items() if ssn not in ("", "0"))


def test_view_keeps_rows_orders_columns_and_types(spark):
    rows = [
        (1, "100000000001", "a@x", 10),
        (2, "100000000001", "", 0),
        (3, "999", "c@x", 5),
        (4, None, None, None),
        (5, "ANONYMIZED", "d@x", 1),
    ]
    df = spark.createDataFrame(rows, "id int, ssn string, email string, net_income long")
    view = views.encrypted_view(df, "t", "SE", {"email", "netincome"}, sample_vault(spark))
    assert view.columns == ["email", "net_income", "id", "ssn", "is_anonymised"]
    assert view.schema["net_income"].dataType == T.StringType()
    got = {r.id: r for r in view.collect()}
    assert len(got) == 5
    assert len(got[1].email) > 50 and len(got[1].net_income) > 50
    assert (got[2].email, got[2].net_income) == ("", "0")
    assert (got[3].email, got[3].net_income) == ("c@x", "5")
    assert (got[4].email, got[4].net_income) == (None, None)
    assert [got[i].is_anonymised for i in (1, 2, 3, 4, 5)] == [True, True, False, False, True]


def test_view_hides_or_shows_the_join_key(spark):
    df = spark.createDataFrame([("100000000001", "x")], "ssn string, notes string")
    keys = sample_vault(spark)
    assert "ssn_clean" not in views.encrypted_view(df, "t", "SE", {"notes"}, keys).columns
    shown = views.encrypted_view(df, "t", "SE", {"notes"}, keys, expose_join_key=True)
    assert shown.columns == ["notes", "ssn", "ssn_clean", "is_anonymised"]


def test_view_needs_a_stack_for_application_ids(spark):
    df = spark.createDataFrame([("app1", "x")], "application_id string, notes string")
    with pytest.raises(ValueError):
        views.encrypted_view(df, "t", "SE", {"notes"}, sample_vault(spark))
    per_stack = {
        stack: views.encrypted_view(df, "t", "SE", {"notes"}, sample_vault(spark), stack=stack).first().notes
        for stack in ("s", "t", "none")
    }
    assert per_stack["none"] == "x" and len(set(per_stack.values())) == 3


def test_double_join_prefers_email(spark):
    keys = sample_vault(spark)
    df = spark.createDataFrame(
        [("a@x", "12345678", "n"), (None, "12345678", "n"), ("zz", "1", "n")], "email string, phone string, notes string"
    )
    view = views.encrypted_view(df, "t", "NO", {"notes"}, keys)
    by = {k: vault.lookup(keys, "email").filter(f"key = '{k}'").first() for k in ("a@x", "b@x")}
    rows = view.withColumn("by", F.coalesce("email", F.lit("none"))).collect()

    def opens(cipher, person):
        df = spark.createDataFrame([(cipher, person.uuid, person.cipher_key)], "c string, u string, k binary")
        return df.select(crypto.det_decrypt_with(F.col("c"), F.col("k"), F.col("u"))).first()[0]

    got = {r.by: r for r in rows}
    assert opens(got["a@x"].notes, by["a@x"]) == "n"
    assert opens(got["none"].notes, by["b@x"]) == "n"
    assert (got["zz"].notes, got["zz"].is_anonymised) == ("n", False)


# --------------------------------------------------------------- sources


def write_lines(tmp_path, name, lines):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.txt").write_text("\n".join(lines) + "\n")
    return str(folder)


SCHEMA = io.schema_from_json('[{"name":"a","type":"INTEGER"},{"name":"b","type":"STRING"}]')


def test_bad_record_budget(spark, tmp_path):
    path = write_lines(tmp_path, "bad", ["1,x", "oops,y", "2,z", "nope,w"])
    landing = io.scan_csv(spark, path, SCHEMA, header=False, max_bad=2)
    assert landing.rows.select("b").count() == 2 and landing.check() == {"rows": 4, "bad": 2}
    with pytest.raises(io.BadRecordBudgetExceeded, match="2 bad records, 1 allowed"):
        io.scan_csv(spark, path, SCHEMA, header=False, max_bad=1).land(f"{tmp_path}/over")
    with pytest.raises(ValueError, match="holds no table"):
        versioned.read(spark, f"{tmp_path}/over")
    with pytest.raises(Exception, match="malformed record"):
        io.read_csv(spark, path, SCHEMA, header=False).collect()


def test_json_budget_counts_all_columns(spark, tmp_path):
    path = write_lines(tmp_path, "json", ['{"a":1,"b":"x"}', '{"a":"y","b":"z"}', "{broken"])
    good = io.scan_ndjson(spark, path, SCHEMA, max_bad=2).land(f"{tmp_path}/landed")
    assert [r.b for r in good.select("b").collect()] == ["x"]
    with pytest.raises(io.BadRecordBudgetExceeded):
        io.scan_ndjson(spark, path, SCHEMA, max_bad=1).land(f"{tmp_path}/landed")
    # The refused batch left the table as it was.
    assert versioned.read(spark, f"{tmp_path}/landed").count() == 1 and versioned.version(spark, f"{tmp_path}/landed").number == 1


def test_landing_reads_the_files_once(spark, tmp_path):
    path = write_lines(tmp_path, "once", [f'{{"a":{i},"b":"x"}}' for i in range(100)])
    landing = io.scan_ndjson(spark, path, SCHEMA, max_bad=5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "one read")
    try:
        before = len(tracker.getJobIdsForGroup("landing"))
        io.scan_ndjson(spark, path, SCHEMA, max_bad=5)
        io.read_ndjson(spark, path, SCHEMA)
        assert len(tracker.getJobIdsForGroup("landing")) == before
        plan = landing.rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1
        assert landing.land(f"{tmp_path}/landed").count() == 100
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_fields_are_refused(spark, tmp_path):
    path = write_lines(tmp_path, "extra", ['{"a":1,"b":"x"}', '{"a":1,"b":"x","c":2}'])
    with pytest.raises(io.UnknownFields, match="c to c"):
        io.scan_ndjson(spark, path, SCHEMA).land(f"{tmp_path}/t")
    with pytest.raises(Exception, match="undeclared fields c"):
        io.read_ndjson(spark, path, SCHEMA).collect()
    assert io.read_ndjson(spark, path, SCHEMA, strict=False).count() == 2
    header = write_lines(tmp_path, "header", ["b,a", "x,1"])
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv(spark, header, SCHEMA).collect()


def test_undeclared_paths_at_any_depth(spark):
    schema = T.StructType.fromDDL("a struct<x:int,y:struct<z:int>>, l array<struct<p:int,q:array<struct<r:int>>>>, m string, n array<int>")
    texts = {
        '{"a":{"x":1,"y":{"z":2}},"l":[{"p":1,"q":[{"r":1}]}],"m":"s","n":[1]}': [],
        '{"A":{"X":1},"M":null,"l":null}': [],
        '{"a":{"x":1,"w":1,"y":{"z":2,"v":{}}},"k":1}': ["k", "a.w", "a.y.v"],
        '{"l":[{"p":1},{"s":1,"q":[{"r":1},{"t":1}]}]}': ["l.s", "l.q.t"],
        '{"a":[1],"l":{"p":1},"m":{"inner":1},"n":"x"}': [],
        "[1]": [],
        "{broken": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = df.select("v", files.undeclared(F.try_parse_json("v"), schema).alias("u")).collect()
    assert {r.v: sorted(r.u) for r in found} == {t: sorted(u) for t, u in texts.items()}


def test_schema_json_roundtrip():
    text = json.dumps(
        [
            {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
            {"name": "amount", "type": "NUMERIC", "mode": "NULLABLE"},
            {
                "name": "items",
                "type": "RECORD",
                "mode": "REPEATED",
                "fields": [{"name": "email", "type": "STRING", "mode": "NULLABLE", "policyTags": {"names": ["t/1"]}}],
            },
        ]
    )
    schema = io.schema_from_json(text)
    assert schema["amount"].dataType == T.DecimalType(38, 9)
    assert isinstance(schema["items"].dataType, T.ArrayType)
    assert io.schema_from_json(io.schema_to_json(schema)) == schema
    assert io.schema_from_json(text, drop=["id"]).fieldNames() == ["amount", "items"]


def test_a_replacement_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versioned.replace(spark.range(5).toDF("id"), path)
    again = versioned.replace(versioned.read(spark, path).filter("id < 3"), path)
    assert again.count() == 3 and versioned.read(spark, path, 1).count() == 5


def test_readers_see_whole_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versioned.replace(spark.range(5).toDF("id"), path)
    reader = versioned.read(spark, path)
    last = versioned.version(spark, path)
    # Staged and not committed: nobody sees it.  Committed: only new readers do.
    staged = versioned.stage(spark.range(50).toDF("id"), path, last)
    assert versioned.read(spark, path).count() == 5
    versioned.commit(spark, path, last, staged)
    assert versioned.read(spark, path).count() == 50 and reader.count() == 5
    # A second writer that started from the same version fails, and the table stays.
    late = versioned.stage(spark.range(7).toDF("id"), path, last)
    with pytest.raises(versioned.ConcurrentCommit):
        versioned.commit(spark, path, last, late)
    assert versioned.read(spark, path).count() == 50
    # A writer that dies between staging and commit leaves the table as it was.
    monkeypatch.setattr(versioned, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        versioned.replace(spark.range(9).toDF("id"), path)
    monkeypatch.undo()
    assert versioned.read(spark, path).count() == 50
    assert versioned.expire(spark, path, keep=1) == 1 and versioned.read(spark, path).count() == 50
    with pytest.raises(ValueError, match="no version 1"):
        versioned.read(spark, path, 1)


def test_updates_write_hit_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("g"), F.lit("old").alias("v"))
    versioned.replace(rows.union(spark.createDataFrame([(None, None, "old")], "id long, g long, v string")), path, "id % 8")
    before = versioned.version(spark, path)
    assert len(before.folders) == 9
    after = versioned.update(spark, path, F.col("id").isin(8, 16, 19), {"v": F.lit("new")})
    changed = {b for b in after.folders if after.folders[b] != before.folders[b]}
    assert changed == {"0", "3"} and set(after.folders) == set(before.folders)
    found = {r.id: r.v for r in versioned.read(spark, path).collect()}
    assert len(found) == 101 and {i for i, v in found.items() if v == "new"} == {8, 16, 19}
    assert versioned.update(spark, path, F.col("id") > 1000, {"v": F.lit("none")}) == after
    nulls = versioned.update(spark, path, F.col("id").isNull(), {"v": F.lit("null")})
    assert sum(nulls.folders[b] != after.folders[b] for b in nulls.folders) == 1
    with pytest.raises(ValueError, match="moves rows"):
        versioned.rewrite(spark, path, lambda t: t.filter("id = 1"), lambda t: t.withColumn("id", F.col("id") + 1))
    emptied = versioned.rewrite(spark, path, lambda t: t.filter("id % 8 = 1"), lambda t: t.filter("id < 0"))
    assert "1" not in emptied.folders and versioned.read(spark, path).filter("id % 8 = 1").count() == 0
    assert versioned.expire(spark, path, keep=1) == 3 and versioned.read(spark, path).count() == 88


def test_view_names_carry_market_suffixes():
    assert io.view_id("stream_fi", "orders") == "view_orders_fi"
    assert io.view_id("stream", "orders") == "view_orders"


# ------------------------------------------------------------ change events


def test_every_table_rule_builds_a_spec():
    schema = T.StructType([T.StructField("created_at", T.TimestampType()), T.StructField("ts", T.LongType())])
    specs = {name: cdc.spec_from_schema(name, schema) for name in cdc.TABLE_RULES}
    assert len(specs) == 24
    assert specs["cookie_mappings"].table == "application_cookie_mappings"
    assert {n for n, s in specs.items() if not s.keep_rn} == {
        "bid_accepts",
        "bid_logs",
        "credit_report_latest_inquiries",
    }
    assert sum(s.floor is not None for s in specs.values()) == 7
    assert [f.name for f in specs["bids"].fields] == ["created_at"]


def test_parsed_table_types_cleans_and_floors(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("accepted", T.BooleanType()),
            T.StructField("amount", T.DecimalType(38, 9)),
            T.StructField("created_at", T.TimestampType()),
        ]
    )
    old = '{"id":1,"created_at":"2020-12-31 00:00:00"}'
    new = '{"id":"2","accepted":"1","amount":"10.25","created_at":"2021-01-01 00:00:00"}'
    rows = [("bids", 5, 1, 1, "history", old), ("bids", 6, 1, 1, "history", new), ("bids", 6, 1, 1, "zz", new), ("x", 6, 9, 9, "h", new)]
    log = spark.createDataFrame(rows, "table string, ts long, xid long, xoffset long, source string, data string")
    out = cdc.parsed_table(log, cdc.spec_from_schema("bids", schema)).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.natural_key, row.id, row.accepted, float(row.amount), row.source, row.rn) == ("116", 2, True, 10.25, "zz", 1)


def test_change_tables_read_the_log_once(spark, small, tmp_path):
    from workload import q_changes

    specs = q_changes.specs()
    assert {s.table for s in specs} == {r.table or n for n, r in cdc.TABLE_RULES.items()} and len(specs) == 24
    q_changes.change_log(spark, small).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert plan_of(cdc.change_tables(log, specs))[:2] == (1, 1)
    cdc.write_change_tables(log, specs, str(tmp_path / "tables"))
    for spec in specs:
        found = cdc.read_change_table(spark, str(tmp_path / "tables"), spec)
        assert found.columns == cdc.parsed_table(log, spec).columns
        scans, shuffles, plan = plan_of(found)
        assert (scans, shuffles) == (1, 0) and f"(table#" in plan.split("PartitionFilters: ")[1].split("\n")[0]
        read = plan.split("ReadSchema: ")[1].split("\n")[0]
        assert read.startswith(f"struct<{spec.table}:struct<")
    bids = next(s for s in specs if s.table == "bids")
    one = cdc.read_change_table(spark, str(tmp_path / "tables"), bids).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, cdc.parsed_table(log, bids).collect())) and one


def test_json_scalars_only(spark):
    rows = [('{"a":{"x":1},"b":"{curly}","c":[1],"d":5,"e":null}',)]
    spec = [jsonx.JsonField(k) for k in "abcdef"]
    out = jsonx.parse_typed(spark.createDataFrame(rows, "j string"), "j", spec).first()
    assert tuple(out) == (None, "{curly}", None, "5", None, None)


# --------------------------------------------------------------- documents


def test_longest_array_may_come_from_a_deleted_version(spark):
    rows = [
        ("d", 1, "update", [1, 2, 3]),
        ("d", 2, "delete", [1, 2, 3, 4]),
        ("d", 3, "update", [1]),
        ("gone", 1, "delete", [1]),
        ("null", 1, "update", None),
    ]
    df = spark.createDataFrame(rows, "_id string, __v int, operationType string, loans array<int>").withColumns(
        {"updatedAt": F.lit(None).cast("timestamp"), "time_archived": F.lit(None).cast("timestamp")}
    )
    got = {r._id: (r.versions, r.loans, r.brand) for r in documents.latest_documents(df).collect()}
    assert got == {"d": (3, [1, 2, 3, 4], "first"), "null": (1, [], "first")}


def plan_of(df):
    """Parts of the plan before adaptive execution: scans and shuffles."""
    df._jdf.queryExecution().executedPlan()
    text = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    return text.count("FileScan parquet"), text.count("Exchange hashpartitioning"), text


def test_current_documents_take_one_scan_and_one_shuffle(spark, small, tmp_path):
    import workload.fixtures as fx

    fx.documents(spark, small).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    for df in (documents.latest_documents(raw), documents.applications(raw)):
        assert plan_of(df)[:2] == (1, 1)
    *counts, plan = plan_of(documents.latest_documents(raw).select("_id", "brand"))
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert counts == [1, 1] and not any(c in read for c in ("loans", "bids", "estates", "person", "history", "acceptedBid"))
    # The flat table reads members, never whole arrays.
    read = plan_of(documents.applications(raw))[2].split("ReadSchema: ")[1].split("\n")[0]
    assert not any(c in read for c in ("loans", "bids", "estates", "creditReports", "history"))


def test_versions_that_tie(spark):
    rows = [("a", 1, "update", i, [i]) for i in range(50)] + [("b", 1, None, 1, [1]), (None, 1, "update", 1, None)]
    df = spark.createDataFrame(rows, "_id string, __v int, operationType string, amount int, loans array<int>").withColumns(
        {"updatedAt": F.lit(None).cast("timestamp"), "time_archived": F.lit(None).cast("timestamp")}
    )
    columns = ["_id", "amount", F.to_json(F.struct("loans"))]
    first = {tuple(r) for r in documents.latest_documents(df).select(*columns).collect()}
    again = documents.latest_documents(df.repartition(7, "amount")).select(*columns)
    assert first == {tuple(r) for r in again.collect()} and {r[0] for r in first} == {"a", None}
    chosen = documents.latest_documents(df, tiebreak=[F.col("amount")]).filter("_id = 'a'").first()
    assert chosen.amount == 49


def test_flat_columns_have_distinct_names(spark, small):
    import workload.fixtures as fx

    raw = fx.documents(spark, small)
    flat = documents.applications(raw, "Owner")
    names = [c.lower() for c in flat.columns]
    assert len(names) == len(set(names)) > 150
    assert "lastpaidoutbyownerbank" in names and "loans" not in names
    history = [c.lower() for c in documents.all_versions(raw).columns]
    assert len(history) == len(set(history)) and "clearingnumber" in history and "fbccookie" not in history


def test_unmatched_employments_stay_null(spark):
    job = "struct<id:int,applicant_id:int,employer:string>"
    schema = f"data_id int, applicants array<struct<data_id:int,id:int,ssn:string,employments:array<{job}>>>"
    rows = [
        (1, [(1, 7, "a", [(1, 7, "x"), (2, 8, "y")]), (9, 8, "b", [])]),
        (2, []),
    ]
    out = loans.applicants(spark.createDataFrame(rows, schema)).collect()
    got = sorted(((r.id, r.employments and [tuple(e) for e in r.employments]) for r in out), key=str)
    assert got == [(7, [(1, 7, "x")]), (None, None)]


# ------------------------------------------------------------------ events


def sample_messages(spark):
    rows = [("1", 5, ["a"], "SE", "x@y"), ("2", None, None, "NO", None), ("3", 6, [], "DK", ""), ("4", 7, ["b"], None, "q")]
    return spark.createDataFrame(
        rows, "national_id string, customer_id long, emails array<string>, market string, latest_email string"
    )


def test_union_tags_and_nulls(spark):
    text = {json.loads(r.message)["national_id"]: json.loads(r.message) for r in events.to_messages(sample_messages(spark)).collect()}
    assert text["1"]["customer_id"] == {"long": 5} and text["1"]["emails"] == {"array": ["a"]}
    assert text["2"]["customer_id"] is None and text["2"]["mobile_phones"] is None
    assert list(text["1"]) == [f.name for f in events.MESSAGE_FIELDS]


def test_bare_members_read_like_wrapped_ones(spark):
    bare = spark.createDataFrame([("m", '{"national_id":"1","customer_id":5,"market":"SE"}')], "message_id string, message string")
    row = events.read_messages(bare).first()
    assert (row.national_id, row.customer_id, row.market, row.emails) == ("1", 5, "SE", None)


MARKETS = {"SE": ["one", "two"], "NO": "three", "DK": None}


def test_routing(spark):
    routed = events.route(events.read_messages(events.to_messages(sample_messages(spark))), MARKETS)
    by_market = {}
    for r in routed.collect():
        by_market.setdefault(r.market, set()).add(r.project)
    assert by_market == {"SE": {"one", "two"}, "NO": {"three"}, "DK": {None}, None: {"one", "two", "three"}}
    payload = json.loads(routed.filter("market = 'NO'").first().payload)
    assert list(payload["customer_ids"]) == ["SSN"]


def test_send_once_retries_and_gives_up():
    answers = iter([503, 500, 200])
    assert events.send_once(lambda p, q: next(answers), "", "x", 5, 0) == (True, 3, 200, None)
    assert events.send_once(lambda p, q: 404, "", "x", 5, 0)[:3] == (False, 1, 404)

    def down(payload, project):
        raise OSError("down")

    assert events.send_once(down, "", "x", 2, 0) == (False, 2, None, "down")


def test_deliver_sends_once_per_row(spark, tmp_path):
    log = str(tmp_path / "log")
    import os

    os.mkdir(log)

    def send(payload, project):
        import os
        import uuid

        open(os.path.join(log, uuid.uuid4().hex), "w").close()
        return 200 if project == "a" else 404

    rows = spark.createDataFrame([("1", "a", "{}"), ("2", "b", "{}"), ("3", None, "{}")], "message_id string, project string, payload string")
    ok, dead = events.deliver(rows, send, attempts=3, backoff=0, path=str(tmp_path / "out"))
    assert (ok.count(), dead.count(), ok.count()) == (1, 2, 1)
    assert len(os.listdir(log)) == 2
    totals = {r.project: (r.succeeded, r.failed) for r in events.counts(ok.unionByName(dead)).collect()}
    assert totals == {"a": (1, 0), None: (1, 2)}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    def send(payload, project):
        return 200 if project != "two" else 404

    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    messages = events.to_messages(sample_messages(spark))
    messages.limit(2).write.json(source)
    consume_stream(spark, source, MARKETS, send, out, state, attempts=1, backoff=0).awaitTermination()
    messages.join(spark.read.json(source).select("message_id"), "message_id", "left_anti").write.mode("append").json(source)
    consume_stream(spark, source, MARKETS, send, out, state, attempts=1, backoff=0, files_per_batch=1).awaitTermination()
    streamed = spark.read.schema(events.RESULT_SCHEMA).parquet(out).select(*events.RESULT_SCHEMA.names)
    batch = events.send_all(events.route(events.read_messages(messages), MARKETS), send, 1, 0)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_a_replayed_batch_sends_only_what_is_open(spark, tmp_path, monkeypatch):
    source, out, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "received"))

    def receive(payload, project):
        with open(log, "a") as file:
            file.write(f"{project}|{payload}\n")
        return 500 if project == "bad" else 200

    rows = [(str(i), i, ["a"], ["SE", "NO", "DK", "XX"][i % 4], f"m{i}") for i in range(60)]
    columns = [f.name for f in events.MESSAGE_FIELDS]
    full = spark.createDataFrame(rows, "national_id string, customer_id long, emails array<string>, market string, latest_email string")
    full = full.select(*[F.col(c) if c in full.columns else F.lit(None).cast(f.type).alias(c) for c, f in zip(columns, events.MESSAGE_FIELDS)])
    messages = events.to_messages(full)
    messages.write.json(source)
    projects = {"SE": ["p1", "p2"], "NO": "p1", "DK": "bad"}
    run = lambda: consume_stream(
        spark, source, projects, receive, out, state, attempts=1, backoff=0, chunk_rows=10
    ).awaitTermination()

    send, done = events._send_chunk, []

    def lost_after_three(*args):
        if len(done) == 3:
            raise RuntimeError("driver lost")
        send(*args)
        done.append(args[1])

    monkeypatch.setattr(events, "_send_chunk", lost_after_three)
    with pytest.raises(Exception, match="driver lost"):
        run()
    first = open(log).read().splitlines()
    assert 0 < len(first) < 60 and events.delivered(spark, out).count() >= len(first)
    monkeypatch.undo()
    run()
    received = open(log).read().splitlines()
    # 15 messages to two projects, 15 to one, 15 refused; each key once over both runs.
    assert len(received) == len(set(received)) == 60 and received[: len(first)] == first
    results = events.delivered(spark, out)
    assert results.count() == 75 and results.filter("ok").count() == 45
    # The same messages in a later batch: what was delivered is not sent again, what failed is.
    messages.write.mode("append").json(source)
    run()
    again = open(log).read().splitlines()[60:]
    assert len(again) == 15 and all(line.startswith("bad|") for line in again)


def test_placeholder_ids_meet_no_events(spark):
    keys = sample_vault(spark).withColumn("is_anonymized", F.lit(True)).withColumn("ssn", F.lit("0"))
    known = spark.createDataFrame(
        [("0", m, 1, "b", "m", "p", "e") for m in ("SE", "NO")] * 50,
        "national_id string, market string, customer_id long, last_brand_interaction string, email string, "
        "mobile_phone string, compliance_event string",
    )
    found = events.build(keys, known, F.lit("2024-01-01 11:00:00").cast("timestamp")).collect()
    assert len(found) == 2 and {r.customer_id for r in found} == {None}


def test_event_set_substitutes_missing_contacts(spark):
    keys = sample_vault(spark).withColumn("is_anonymized", F.lit(True))
    known = spark.createDataFrame(
        [("100000000001", "SE", 1, "b", "m", "p", "e"), ("100000000001", "NO", 2, "b", "m", "p", "e")],
        "national_id string, market string, customer_id long, last_brand_interaction string, email string, "
        "mobile_phone string, compliance_event string",
    )
    as_of = F.lit("2024-01-01 11:00:00").cast("timestamp")
    rows = {r.national_id: r for r in events.build(keys, known, as_of).collect()}
    assert rows["100000000001"].mobile_phones == ["+46701", "null"]
    assert rows["100000000001"].customer_id == 1 and rows["100000000002"].customer_id is None
    assert events.build(keys, known, F.lit("2024-01-01 13:00:00").cast("timestamp")).count() == 0


def test_documents_are_dealt_before_they_are_widened(spark, small):
    import workload.fixtures as fx
    from workload import q_documents

    nested_rows, members = fx.documents(spark, small), fx.member_versions(spark, small, q_documents.all_paths())
    grouped = [
        q_documents.current(spark, small),
        documents.child_table(q_documents.current(spark, small), "loans"),
        documents.credit_reports(q_documents.current(spark, small)),
        documents.applications(nested_rows),
        documents.applications(members),
        documents.all_versions(nested_rows, slim=True),
    ]
    for df in grouped:
        plan = plan_of(df)[2]
        # The shuffles are those of the narrow orders and lines; none follows for the versions.
        moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert moved and all("REPARTITION_BY_NUM" in line for line in moved)


def test_versions_are_sorted_before_they_are_widened(spark, small):
    import workload.fixtures as fx
    from workload import q_documents

    nested_rows, members = fx.documents(spark, small), fx.member_versions(spark, small, q_documents.all_paths())
    for df in (q_documents.current(spark, small), documents.applications(nested_rows), documents.applications(members)):
        tree = plan_of(df)[2].split("== Initial Plan ==")[-1].split("\n")
        # No sort above the one on the exploded orders: none holds rows with the members, whatever their width.
        below = [tree[i + 1] for i, line in enumerate(tree) if "Sort [" in line]
        assert "Generate explode" in below[0] and all("Exchange" in line for line in below[1:])


def test_full_documents_are_dealt_by_ranges_of_their_key(spark, small):
    """Neighbouring documents lie together where the wide result is written; no other shuffle."""
    from workload import q_documents

    for query in (q_documents.applications_full, q_documents.all_versions_full):
        tree = plan_of(query(spark, small))[2].split("== Initial Plan ==")[-1]
        moved = [line for line in tree.split("\n") if "Exchange " in line]
        assert len(moved) == 1 and "Exchange rangepartitioning(_id" in moved[0]


def test_flat_applications_take_few_values_and_whole_columns(spark):
    """A pick compares the orders once a value, so all members are one; a column with published members only is one piece."""
    team, lot = "struct<teamLeader:string,team:string>", "struct<type:string,coordinates:string,seed:int>"
    schema = (
        "_id string, __v int, operationType string, updatedAt timestamp, time_archived timestamp, originReference string, "
        f"teamAttributes {team}, random {lot}, acceptedBid struct<acceptedAt:timestamp,date:timestamp,requiredDocs:struct<payslip:string>>, "
        "paymentStatus struct<date:timestamp,bank:string>"
    )
    late = DAY + datetime.timedelta(days=9)
    rows = [
        ("a", 1, "update", DAY, DAY, "x?gclid=1", ("l1", "t1"), ("r1", "c1", 1), (DAY, DAY, ("p1",)), (late, "b1")),
        ("a", 2, "update", DAY, DAY, None, ("l2", None), ("r2", None, 2), (late, late, ("p2",)), (DAY, "b2")),
        ("a", 3, "delete", DAY, DAY, None, ("l3", "t3"), None, None, None),
        ("b", 1, "update", None, None, None, None, None, None, None),
        ("b", 1, "update", None, None, None, None, None, None, None),
        (None, 1, "update", DAY, DAY, None, ("l4", "t4"), None, (late, DAY, None), (DAY, None)),
        ("c", 1, None, DAY, DAY, None, ("l5", "t5"), None, None, None),
    ]
    flat = documents.applications(spark.createDataFrame(rows, schema))
    names = ["application_id", "versions", "teamLeader", "team", "randomtype", "payslip", "paymentStatusBank"]
    got = flat.select(*names, "acceptedAt", "acceptedBidDate", "paymentStatusDate", "companyName").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            # Dates of the first version, the last in which acceptance does not follow payment.
            ("a", 2, "l2", None, "r2", "p2", "b2", DAY, DAY, late, None),
            ("b", 1, None, None, None, None, None, None, None, None, None),
            (None, 1, "l4", "t4", None, None, None, DAY, DAY, DAY, None),
        ],
        key=str,
    )
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = flat._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("max_by(") == 4
    assert "teamAttributes, teamAttributes#" in plan and "acceptedBid, acceptedBid#" in plan and "random, struct(randomtype" in plan


def test_members_share_the_text_of_their_key(spark, small):
    import workload.fixtures as fx
    from workload import q_documents

    paths = q_documents.all_paths()
    rows = fx.member_versions(spark, small, paths).filter("_id = '7' AND __v = 2")
    row = rows.select("acceptedBid.signLink", "bankAccount.bankName", "utm.domain", "status.sent").first()
    assert tuple(row) == ("acceptedBid.signLink-7-2", "bankAccount.bankName-7-2", None, True)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        for query in (q_documents.all_versions_full, q_documents.applications_full):
            plan = query(spark, small)._jdf.queryExecution().optimizedPlan().toString()
            # Key and version become text a few times a row, not once a member.
            assert plan.count(" as string)") < 10
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_tasks_grow_with_the_documents(spark, small, monkeypatch):
    import workload.fixtures as fx

    few = fx.document_orders(spark, small).rdd.getNumPartitions()
    monkeypatch.setattr(fx, "DOCUMENTS_PER_TASK", 50)
    assert few == spark.sparkContext.defaultParallelism
    assert fx.document_orders(spark, small).rdd.getNumPartitions() == -(-fx.table(spark, small, "orders").count() // 50)


def test_contact_blocks_are_opened_by_one_join(spark, small):
    from workload import q_vault

    plan = plan_of(q_vault.view_triple(spark, small))[2]
    tree = plan.split("== Initial Plan ==")[-1]
    # One lookup seals and one opens; none leaves the rows of other types without a key.
    assert sum("Join" in line and "LeftOuter" in line for line in tree.split("\n")) == 2


def test_a_view_and_its_reopening_move_the_rows_once(spark, small):
    from workload import q_vault

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query, key in ((q_vault.encrypt_arrays, "application_id"), (q_vault.view_phone, "mobile_clean")):
            tree = plan_of(query(spark, small))[2].split("== Initial Plan ==")[-1]
            assert sum(f"Exchange hashpartitioning({key}#" in line for line in tree.split("\n")) == 1
            # The other shuffles are those of the inputs and of two lookups; no row is dealt by a helper column.
            assert tree.count("Join") == (3 if query is q_vault.encrypt_arrays else 2) and "hashpartitioning(__" not in tree
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_placeholder_keys_find_nobody(spark):
    history = "array<struct<email:string,mobile_phone:string,stack:string,created_at:timestamp,loan_application_oid:string>>"
    entry = [(e, None, "s", None, "1") for e in ("", "0", "a@x")]
    schema = f"national_id string, market string, compliance_event string, is_valid_national_id string, history {history}"
    keys = vault.build(spark.createDataFrame([("10", "SE", "flag", "valid", entry)], schema), "secret")
    assert [r.key for r in vault.lookup(keys, "email").collect()] == ["a@x"]
    rows = spark.createDataFrame([("0", "x"), ("", "x"), (None, "x"), ("a@x", "x")], "email string, notes string")
    view = views.encrypted_view(rows.withColumn("id", F.col("email")), "mails", "SE", {"notes"}, keys)
    assert {(r.id, r.notes != "x", r.is_anonymised) for r in view.collect()} == {
        ("0", False, False), ("", False, False), (None, False, False), ("a@x", True, True)
    }
