"""Ad-hoc SQL over the warehouse's tables, read-only in effect.

The text is parsed by Spark's own parser and analysed in a child session whose
only tables are views of the warehouse: cleansed base tables, monthly
metrics, quarterly and yearly roll-ups.  Only the views that the text names are
built.  A query is refused unless

* it is one query (read as a subquery, so DDL, DML and several statements are
  syntax errors);
* every table it names is one of the views, or a common table expression of its
  own: no files (``text.`/path` ``), no other catalogs, no table functions;
* every function it calls is in ``FUNCTIONS``: nothing that reflects into the
  JVM, reads files or tells about the machine;
* its analysed plan has no other source than those views.

Every error is a ``QueryError`` whose message is the text to show: ``run_sql``
raises it for what can be told before running, ``fetch`` also for what goes
wrong while the query runs, and ``answer`` returns it as text.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.rollups import ROLLUPS
from ..schemas import BASE_TABLES, METRICS, typed
from ..session import SHUFFLE_SETTINGS, configure
from .warehouse import Warehouse

PERIODS = ("quarterly", "yearly")

#: Functions that a query may call.
FUNCTIONS = frozenset("""
abs add_months any any_value approx_count_distinct array array_agg array_contains array_distinct array_join
array_max array_min array_size avg between bool_and bool_or cardinality cast ceil ceiling char_length
coalesce collect_list collect_set concat concat_ws contains corr count count_if covar_pop covar_samp
cume_dist current_date date date_add date_diff date_format date_sub date_trunc datediff day dayofmonth
dayofweek dayofyear decode dense_rank endswith every exists exp explode extract filter find_in_set first
first_value floor format_number format_string greatest grouping grouping_id hour if ifnull in initcap
instr isnan isnotnull isnull lag last last_day last_value lcase lead least left len length ln locate log
log10 log2 lower lpad ltrim make_date map max max_by mean median min min_by minute mod mode month
months_between named_struct negative next_day nth_value ntile nullif nvl nvl2 overlay percent_rank
percentile percentile_approx pmod pos position positive pow power quarter rank regexp_extract
regexp_like regexp_replace regr_slope repeat replace reverse right round row_number rpad rtrim second
sequence sign size skewness slice some sort_array split split_part sqrt startswith std stddev
stddev_pop stddev_samp string struct substr substring substring_index sum to_char to_date to_number
to_timestamp transform translate trim trunc try_add try_avg try_cast try_divide try_multiply
try_subtract try_sum try_to_date try_to_number try_to_timestamp ucase upper var_pop var_samp variance
weekday weekofyear when width_bucket window year
""".split())

#: Node kinds of analysed plans that bring rows and are not views.
SOURCES_ALLOWED = {"OneRowRelation", "LocalRelation", "CTERelationRef"}


class QueryError(ValueError):
    """What is wrong with an ad-hoc query, as text."""


def view_names() -> list[str]:
    return [*BASE_TABLES, *METRICS, *(f"{p}_{e}" for e in ROLLUPS for p in PERIODS)]


def _view(wh: Warehouse, name: str) -> DataFrame:
    for period in PERIODS:
        if name.startswith(f"{period}_"):
            return wh.rollup(name[len(period) + 1:], period)
    return wh.table(name)


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


class _Walk:
    """All nodes of a plan and of its expressions, subqueries included, down to views."""

    def __init__(self):
        self.plans, self.expressions = [], []

    def plan(self, node) -> "_Walk":
        self.plans.append(node)
        if _kind(node) == "View":
            return self
        for child in [*_items(node.children()), *_items(node.innerChildren())]:
            if hasattr(child, "innerChildren") and self._is_plan(child):
                self.plan(child)
        for expression in _items(node.expressions()):
            self.expression(expression)
        return self

    @staticmethod
    def _is_plan(node) -> bool:
        return ".plans.logical." in node.getClass().getName() or ".analysis." in node.getClass().getName() \
            or ".datasources." in node.getClass().getName() or ".execution." in node.getClass().getName()

    def expression(self, node) -> None:
        self.expressions.append(node)
        for child in _items(node.children()):
            self.expression(child)
        if hasattr(type(node), "plan") or "Subquery" in _kind(node) or _kind(node) in ("Exists", "ListQuery", "InSubquery"):
            try:
                self.plan(node.plan())
            except (Py4JError, TypeError):  # an expression over a subquery that is one of its children
                pass


def _check_parsed(spark: SparkSession, text: str) -> list[str]:
    """Names of the views that a query needs; QueryError if it names anything else."""
    walk = _Walk().plan(spark._jsparkSession.sessionState().sqlParser().parsePlan(text))
    allowed, needed, own = set(view_names()), set(), set()
    for node in walk.plans:
        if _kind(node) == "UnresolvedWith":
            own |= {part._1().lower() for part in _items(node.cteRelations())}
    for node in walk.plans:
        kind = _kind(node)
        if kind == "UnresolvedRelation":
            name = [str(p) for p in _items(node.multipartIdentifier())]
            if len(name) == 1 and name[0].lower() in allowed:
                needed.add(name[0].lower())
            elif len(name) > 1 or name[0].lower() not in own:
                raise QueryError(f"unknown table {'.'.join(name)}; known are {', '.join(view_names())}")
        elif "TableValuedFunction" in kind or "UnresolvedIdentifier" in kind or "Script" in kind:
            raise QueryError(f"not allowed in a query: {kind}")
    for node in walk.expressions:
        kind = _kind(node)
        if kind == "UnresolvedFunction":
            name = [str(p) for p in _items(node.nameParts())]
            if len(name) > 1 or name[0].lower() not in FUNCTIONS:
                raise QueryError(f"function {'.'.join(name)} is not allowed")
        elif "UnresolvedIdentifier" in kind or kind in ("CallMethodViaReflection", "TryReflect"):
            raise QueryError(f"not allowed in a query: {kind}")
    return sorted(needed)


def _check_analysed(df: DataFrame) -> None:
    allowed = set(view_names())
    for node in _Walk().plan(df._jdf.queryExecution().analyzed()).plans:
        kind = _kind(node)
        if kind == "View":
            name = node.desc().identifier().table()
            if name not in allowed:
                raise QueryError(f"unknown table {name}")
        elif not node.children().size() and kind.rstrip("$") not in SOURCES_ALLOWED:
            raise QueryError(f"not allowed in a query: {kind}")


def run_sql(wh: Warehouse, text: str) -> DataFrame:
    """The result of one read-only query; ``QueryError`` if the text is none or may not run."""
    query = f"SELECT * FROM (\n{text.strip().rstrip(';')}\n)"
    try:
        needed = _check_parsed(wh.spark, query)
        session = configure(wh.spark.newSession())
        for setting in SHUFFLE_SETTINGS:
            if (value := wh.spark.conf.get(setting, None)) is not None:
                session.conf.set(setting, value)
        classic = wh.spark._jvm.org.apache.spark.sql.classic.Dataset
        for name in needed:
            # the same plan in the child session: temporary views belong to the session of their frame
            view = classic.ofRows(session._jsparkSession, _view(wh, name)._jdf.logicalPlan())
            view.createOrReplaceTempView(name)
        out = session.sql(query)
        _check_analysed(out)
        out._jdf.queryExecution().executedPlan()  # errors of constant expressions show here
        return out
    except (PySparkException, Py4JError) as error:
        raise QueryError(_message(error)) from error


def _message(error: Exception) -> str:
    """The error's own text, without the stack below it."""
    return str(error).split("\n\nJVM stacktrace")[0].strip() or type(error).__name__


def fetch(wh: Warehouse, text: str, limit: int | None = None) -> list[dict]:
    """Rows of a query; errors while it runs are ``QueryError``, too."""
    df = run_sql(wh, text)
    try:
        return [r.asDict() for r in (df if limit is None else df.limit(limit)).collect()]
    except (PySparkException, Py4JError) as error:
        raise QueryError(_message(error)) from error


def answer(wh: Warehouse, text: str, limit: int | None = None) -> dict:
    """``{"results": rows, "sql_query": text, "error": None or what is wrong}``; never raises for a query."""
    try:
        return {"results": fetch(wh, text, limit), "sql_query": text, "error": None}
    except QueryError as error:
        return {"results": [], "sql_query": text, "error": str(error)}


def schema_catalog() -> dict[str, T.StructType]:
    """Tables and columns offered to people writing questions, roll-ups included."""
    out = {t: typed(t) for t in BASE_TABLES}
    out.update(METRICS)
    for entity, spec in ROLLUPS.items():
        fields = {f.name: f for f in METRICS[spec.source].fields}
        for period, label in (("quarterly", "quarter_year"), ("yearly", "year")):
            out[f"{period}_{entity}"] = T.StructType(
                [T.StructField(label, T.StringType()), *(fields[c] for c in (*spec.dims, *spec.sums))])
    return out
