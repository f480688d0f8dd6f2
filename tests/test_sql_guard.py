"""C11: the guard walks the parsed plan; texts, comments and names cannot hide anything from it."""

import os

import pytest

from ledgerspark.operators.sql_guard import assert_select_only, guarded_sql


@pytest.fixture(scope="module", autouse=True)
def views(spark):
    spark.sql("SELECT id, id % 3 AS load, id % 2 AS `set`, array(id, 2) AS a FROM range(6)") \
        .createOrReplaceTempView("guard_data")


JAVA = "java_method('java.lang.System','getProperty','user.home')"


@pytest.mark.parametrize("sql", [
    rf"SELECT r'\' AS a, {JAVA} AS b, ' ' AS c", f"SELECT {JAVA}", "SELECT `reflect`('a', 'b')",
    f"SELECT id FROM guard_data WHERE {JAVA} = ''", f"SELECT id FROM guard_data ORDER BY {JAVA}",
    f"SELECT (SELECT {JAVA})", f"WITH x AS (SELECT {JAVA} AS v) SELECT v FROM x",
    f"SELECT id FROM guard_data WHERE EXISTS (SELECT 1 WHERE {JAVA} = '')",
    f"SELECT transform(a, x -> {JAVA}) FROM guard_data", f"SELECT max({JAVA}) OVER () FROM guard_data",
    f"SELECT e FROM guard_data LATERAL VIEW explode(array({JAVA})) t AS e",
    f"SELECT * FROM explode(array({JAVA}))", f"SELECT id FROM guard_data GROUP BY id HAVING {JAVA} = ''",
    f"SELECT * FROM guard_data a JOIN guard_data b ON {JAVA} = ''", f"VALUES ({JAVA})",
    "SELECT IDENTIFIER('java_method')('a', 'b')", "SELECT * FROM IDENTIFIER('guard_data')",
    "SELECT count(*) FROM text.`README.md`", "SELECT * FROM `text`.`README.md`",
    "SELECT * FROM csv.`/etc/passwd`", "SELECT (SELECT count(*) FROM text.`README.md`)",
    "SELECT * FROM no_such_view", "SELECT * FROM nowhere.guard_data",
    "SELECT TRANSFORM(id) USING 'cat' FROM guard_data", "TABLE guard_data", "VALUES (1)",
    "SET spark.sql.ansi.enabled = false", "EXPLAIN SELECT 1", "CACHE TABLE guard_data",
    "FROM guard_data INSERT INTO x SELECT *", "CREATE VIEW v AS SELECT 1", "SHOW TABLES",
    "SELECT 1; SELECT 2", "SELECT", "",
])
def test_refused(spark, sql):
    with pytest.raises(ValueError):
        guarded_sql(spark, sql)


@pytest.mark.parametrize("sql,n", [
    ("SELECT load, `set` FROM guard_data -- drop table x", 6), ("SELECT load FROM guard_data;", 6),
    (r"SELECT r'\' AS a, 'java_method(1)' AS b, ' ; ' AS c", 1),
    ("/* insert */ SELECT DISTINCT load FROM guard_data", 3),
    ("WITH x AS (SELECT id FROM guard_data), y AS (SELECT id FROM x) SELECT * FROM Y", 6),
    ("WITH x AS (WITH z AS (SELECT 1 AS v) SELECT v FROM z) SELECT v FROM x", 1),
    ("SELECT load, count(*) AS n FROM guard_data GROUP BY load HAVING count(*) > 1 ORDER BY n LIMIT 2", 2),
    ("SELECT a.id FROM guard_data a JOIN guard_data b USING (id) LEFT JOIN (VALUES (1, 2)) v(p, q) ON p = a.id", 6),
    ("SELECT id, e FROM guard_data LATERAL VIEW explode(a) t AS e", 12),
    ("SELECT id FROM guard_data WHERE id IN (SELECT load FROM guard_data) AND EXISTS (SELECT 1 FROM guard_data)", 3),
    ("SELECT sum(id) OVER (PARTITION BY load ORDER BY id) FROM guard_data", 6),
    ("SELECT id FROM guard_data UNION ALL SELECT id FROM guard_data INTERSECT SELECT 1L", 7),
    ("SELECT * FROM guard_data PIVOT (sum(id) FOR load IN (0, 1))", 6),
    ("SELECT filter(a, x -> x > 1), CASE WHEN id LIKE '1%' THEN 1 END FROM guard_data", 6),
    ("SELECT id FROM guard_data ORDER BY id LIMIT 2 OFFSET 1", 2), ("SELECT * FROM range(4)", 4),
])
def test_allowed(spark, sql, n):
    assert len(guarded_sql(spark, sql).collect()) == n


def test_registered_functions_and_tables_have_to_be_named(spark):
    spark.udf.register("guard_udf", lambda x: x)
    sql = "SELECT guard_udf(id) FROM guard_data"
    with pytest.raises(ValueError):
        assert_select_only(sql, spark)
    assert assert_select_only(sql, spark, functions=["guard_udf"])
    with pytest.raises(ValueError):
        assert_select_only("SELECT * FROM guard_data", spark, tables=["other"])
    assert assert_select_only("SELECT * FROM guard_data", spark, tables=["Guard_Data"])


def test_nothing_is_read_or_run_by_the_check(spark, scratch):
    path = os.path.join(scratch, "out")
    with pytest.raises(ValueError):
        guarded_sql(spark, f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet SELECT 1")
    assert not os.path.exists(path)
