import datetime as dt

from pyspark.sql import functions as F

from relcheck.operators import activity, approvals, catalog as cat, ddl, messages as msg


def test_ddl_split_classify_order(spark):
    script = ";\n".join([
        'CREATE TABLE IF NOT EXISTS "app"."t1" (id int)',
        "ALTER TABLE app.t1 ADD COLUMN v int",
        "alter table only app.t1 add foreign key (id) references z(id)",
        "ALTER TABLE app.t1 ADD CONSTRAINT k PRIMARY KEY (id)",
        "ALTER TABLE app.other ADD COLUMN w int",
        "CREATE TABLE app.t1 (id bigint)",          # repeated: last text wins, first position kept
        "CREATE TABLE app.t2 (id int);",
    ])
    df = spark.createDataFrame([(1, script)], "script_id long, script string")
    st = ddl.statements(df).orderBy("pos").collect()
    assert [r.table_name for r in st] == ["app.t1"] * 4 + ["app.other", "app.t1", "app.t2"]
    assert [r.key_class for r in st][1:4] == ["other", "foreign_key", "primary_key"]
    assert st[-1].stmt == "CREATE TABLE app.t2 (id int)"
    sp = {r.pos: r.target for r in ddl.split_alters(ddl.statements(df)).collect()}
    assert sp == {2: "new", 3: "new", 4: "new", 5: "existing"}
    out = [r.stmt for r in ddl.ordered_new_tables(ddl.statements(df)).orderBy("create_pos", "class_rank", "pos").collect()]
    assert out == ["CREATE TABLE app.t1 (id bigint);",
                   "ALTER TABLE app.t1 ADD CONSTRAINT k PRIMARY KEY (id);",
                   "alter table only app.t1 add foreign key (id) references z(id);",
                   "ALTER TABLE app.t1 ADD COLUMN v int;",
                   "CREATE TABLE app.t2 (id int);"]


def test_ddl_names_modifiers_and_blanks(spark):
    scripts = [(1, "\n\n"), (2, ""), (3, None), (4, ';\n\n CREATE UNLOGGED TABLE "app"."t" (i int) ;\n'),
               (5, '\nCREATE TEMP TABLE IF NOT EXISTS "My T"."a.b" (i int);\nALTER TABLE IF EXISTS ONLY "My T" . "a.b" ADD v int'),
               (6, "create foreign table x$1.y (i int);\n;\nDROP TABLE z;")]
    df = spark.createDataFrame(scripts, "script_id long, script string")
    got = [(r.script_id, r.command, r.table_name, r.stmt[-6:]) for r in ddl.statements(df).orderBy("script_id", "pos").collect()]
    assert got == [(4, "CREATE", "app.t", "i int)"), (5, "CREATE", '"My T"."a.b"', "i int)"),
                   (5, "ALTER", '"My T"."a.b"', " v int"), (6, "CREATE", "x$1.y", "i int)"), (6, "OTHER", None, "ABLE z")]


def test_message_rules(spark):
    rows = [("f", 1, "myRetirementApp", "7", "", "2026-01-01", '["a","b"]'),
            ("f", 2, "nope", "", "X", "bad", '["a",'),
            ("f", 3, "SourceSystemB", "9", "Y", "", "")]
    df = spark.createDataFrame(rows, "file_name string, row_no int, source_system string, customer_id string, "
                                     "event_type string, event_date string, tags string")
    spec = msg.MessageSpec()
    t = {r.row_no: r for r in msg.typed_fields(df, spec).collect()}
    assert t[1].event_type == "UNKNOWN" and t[1].tags == ["a", "b"] and t[1].reasons == []
    assert t[2].reasons == ["unknown source system", "customer_id is required",
                            "event_date is not a valid date", "tags is not a JSON array"]
    assert t[3].event_date is None and t[3].tags is None and t[3].topic == "topic-b"
    m = {r.row_no: r for r in msg.to_messages(msg.typed_fields(df, spec), spec).collect()}
    assert set(m) == {1, 3} and m[1].key == "7"
    s = msg.run_summary(msg.typed_fields(df, spec)).collect()
    assert sum(r.n_failed for r in s) == 1 and sum(r.n_ok for r in s) == 2


def test_activity_end_day_and_zero_users(spark):
    ms = lambda y, m, d, h=0: int(dt.datetime(y, m, d, h, tzinfo=dt.timezone.utc).timestamp() * 1000)
    prs = spark.createDataFrame([(1, "u1", ms(1997, 12, 31, 0)), (2, "u1", ms(1997, 12, 31, 5)),
                                 (3, "u2", ms(1996, 1, 1))], "pr_id long, author string, created_ms long")
    rv = spark.createDataFrame([(3, "u1"), (1, "u2")], "pr_id long, reviewer string")
    users = spark.createDataFrame([("u1",), ("u2",), ("u9",)], "user string")
    a = {r.user: (r.submitted, r.reviewed) for r in
         activity.activity(prs, rv, users, "1997-01-01 00:00:00", "1997-12-31 00:00:00").collect()}
    assert a == {"u1": (1, 1), "u2": (0, 1), "u9": (0, 0)}


def test_approval_fanout(spark):
    ap = spark.createDataFrame([(1, "approved", "db1", dt.date(2024, 1, 1), "a;b"),
                                (2, "approved", "db9", dt.date(2024, 1, 1), "a"),
                                (3, "pending", "db2", dt.date(2024, 1, 1), "c")],
                               "approval_id long, status string, database_name string, release_date date, stakeholders string")
    existing = spark.createDataFrame([("db9",)], "database_name string")
    f = approvals.fanout(ap, existing)
    assert [r.database_name for r in f["database"].collect()] == ["db1"]
    assert sorted((r.database_name, r.stakeholder) for r in f["stakeholder"].collect()) == [
        ("db1", "a"), ("db1", "b"), ("db9", "a")]


def test_fk_pairs_by_position(spark):
    ku = spark.createDataFrame([("s", "t", "fk", "FOREIGN KEY", "b", 2, "r", "y"),
                                ("s", "t", "fk", "FOREIGN KEY", "a", 1, "r", "x")],
                               "table_schema string, table_name string, constraint_name string, constraint_type string, "
                               "column_name string, pos int, ref_table string, ref_column string")
    r = cat.foreign_keys(ku).first()
    assert [(p.local, p.remote) for p in r.pairs] == [("a", "x"), ("b", "y")]
