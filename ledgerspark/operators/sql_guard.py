"""Read-only parameterised SQL.

Spark's own parser reads the statement; the guard then walks the parsed plan before anything is
resolved or run, and lets through what it knows:

* plan nodes that only read (``READ_NODES``): DDL, DML, commands and scripts have nodes of their own;
* tables and views of the catalogue, and the names that WITH introduces. A path such as
  ``parquet.`/x` `` is no catalogue name, so no file can be read by name;
* built-in functions, but for those that call arbitrary Java methods, and the table functions
  ``TABLE_FUNCTIONS``. Functions registered in the session have to be named by the caller.

Texts, comments and column names play no part in this: whatever they contain, they are leaves
of the plan. Markers ``?`` are bound by ``spark.sql(sql, args=[...])``.

No row limit is applied unless the caller gives one; ``guarded_page`` then also says whether rows
were left out.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import ParseException

# --- fixed values: names of Spark's plan nodes and functions ---------------------------------------
READ_NODES = frozenset((
    "Aggregate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join",
    "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "Pivot", "Project",
    "Sample", "Sort", "SubqueryAlias", "Union", "Unpivot", "UnresolvedHaving", "UnresolvedHint",
    "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedTVFAliases", "UnresolvedTableValuedFunction", "UnresolvedWith",
    "WithWindowDefinition"))
#: A statement of one of these alone (TABLE t, VALUES ...) is no SELECT.
NO_QUERY = frozenset(("LocalRelation", "UnresolvedInlineTable", "UnresolvedRelation"))
TABLE_FUNCTIONS = frozenset((
    "explode", "explode_outer", "inline", "inline_outer", "json_tuple", "posexplode",
    "posexplode_outer", "range", "stack"))
#: Built-in functions that call Java methods by name.
REFLECTION = frozenset(("java_method", "reflect", "try_reflect"))
#: Expressions that hide a name or run foreign code.
REFUSED_EXPRESSIONS = frozenset((
    "CallMethodViaReflection", "ExpressionWithUnresolvedIdentifier", "PythonUDF", "ScalaUDF",
    "TryReflect"))
# ---------------------------------------------------------------------------------------------------


def _items(seq) -> list:
    """The elements of a Scala sequence."""
    return [seq.apply(i) for i in range(seq.size())]


class _Walk:
    """One pass over a parsed plan that collects what is not allowed."""

    def __init__(self, spark: SparkSession, functions: Collection[str],
                 tables: Collection[str] | None):
        self.spark, self.tables = spark, tables
        self.functions = {f.lower() for f in functions}
        self.named: set[str] = set()                 # by WITH, lower case

    def plan(self, node) -> None:
        kind = node.getClass().getSimpleName()
        if kind not in READ_NODES:
            raise ValueError(f"{kind} does not belong in a read-only query")
        if kind == "UnresolvedWith":
            self.named |= {c.alias().lower() for c in _items(node.innerChildren())}
        elif kind == "UnresolvedRelation":
            self.relation(_items(node.multipartIdentifier()))
        elif kind == "UnresolvedTableValuedFunction":
            self.function(_items(node.name()), TABLE_FUNCTIONS)
        elif kind == "Generate":
            self.expression(node.generator())
        for expression in _items(node.expressions()):
            self.expression(expression)
        for child in _items(node.innerChildren()) + _items(node.children()):
            self.plan(child)

    def expression(self, e) -> None:
        kind = e.getClass().getSimpleName()
        if kind in REFUSED_EXPRESSIONS:
            raise ValueError(f"{kind} does not belong in a read-only query")
        if kind == "UnresolvedFunction":
            self.function(_items(e.nameParts()))
        elif kind == "UnresolvedGenerator":
            self.function([e.name().funcName()], TABLE_FUNCTIONS)
        for child in _items(e.children()):
            self.expression(child)

    def function(self, name: list[str], known: Collection[str] | None = None) -> None:
        text = ".".join(name).lower()
        if text in self.functions:
            return
        if known is None:
            analysis = self.spark._jvm.org.apache.spark.sql.catalyst.analysis
            of = self.spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
            built_in = len(name) == 1 and analysis.FunctionRegistry.builtin().functionExists(of(text))
            allowed = built_in and text not in REFLECTION
        else:
            allowed = text in known
        if not allowed:
            raise ValueError(f"the function {text} is not available here")

    def relation(self, name: list[str]) -> None:
        if len(name) == 1 and name[0].lower() in self.named:
            return
        text = ".".join(f"`{part.replace('`', '``')}`" for part in name)
        plain = ".".join(name).lower()
        allowed = plain in {t.lower() for t in self.tables} if self.tables is not None else True
        try:
            exists = self.spark.catalog.tableExists(text)
        except AnalysisException:                   # no such database, or no catalogue name at all
            exists = False
        if not (allowed and exists):
            raise ValueError(f"there is no table or view {plain}")


def assert_select_only(sql: str, spark: SparkSession | None = None,
                       functions: Collection[str] = (),
                       tables: Collection[str] | None = None) -> str:
    """The statement; ``ValueError`` unless it is one read-only query over catalogue tables.

    ``functions``: registered functions allowed beside the built-in ones. ``tables``: the only
    tables and views that may be read; all of the catalogue by default."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise ValueError("a query is checked by a session's parser: no session")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise ValueError(f"the query cannot be parsed: {e.getMessage()}") from e
    if plan.getClass().getSimpleName() in NO_QUERY:
        raise ValueError("the statement has to be a query (SELECT or WITH)")
    _Walk(spark, functions, tables).plan(plan)
    return sql


def guarded_sql(spark: SparkSession, sql: str, params: list | None = None,
                max_rows: int | None = None, fmt: str | None = None,
                functions: Collection[str] = (),
                tables: Collection[str] | None = None) -> DataFrame:
    """Run a guarded read-only query with positional parameters; ``max_rows`` limits the result
    if given. With ``fmt`` (json / csv / markdown) the result is rendered one line per row
    (``sources.sinks.render_rows``; header via ``render_rows``). ``functions`` and ``tables`` as in
    ``assert_select_only``."""
    assert_select_only(sql, spark, functions, tables)
    df = spark.sql(sql, args=list(params)) if params else spark.sql(sql)
    if max_rows is not None:
        df = df.limit(max(1, int(max_rows)))
    if fmt is None:
        return df
    from ..sources.sinks import render_rows
    return render_rows(df, fmt)[1]


def guarded_page(spark: SparkSession, sql: str, params: list | None = None,
                 max_rows: int = 5000) -> tuple[DataFrame, DataFrame]:
    """(at most ``max_rows`` rows, a one-row frame ``truncated``: whether there were more)."""
    df = guarded_sql(spark, sql, params)
    more = df.limit(max_rows + 1).agg((F.count(F.lit(1)) > max_rows).alias("truncated"))
    return df.limit(max_rows), more
