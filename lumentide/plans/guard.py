"""A gate for SQL from outside: one read-only statement over the served relations.

The statement is parsed by Spark's own parser and its logical plan is walked: every operator, relation and function
has to be on a list, so that no way of writing a statement can pass what the lists do not hold.
"""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

#: Operators of a plan that only reads.
OPERATORS = frozenset("Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Join LateralJoin SubqueryAlias UnresolvedRelation UnresolvedWith UnresolvedHaving UnresolvedSubqueryColumnAliases Distinct Union Intersect Except OneRowRelation LocalRelation UnresolvedInlineTable WithWindowDefinition Generate UnresolvedHint Pivot Unpivot Expand Window".split())
#: Functions that depend on their arguments only.
FUNCTIONS = frozenset(
    "any any_value approx_count_distinct approx_percentile array_agg array_max array_min avg bit_and bit_or bit_xor bool_and bool_or collect_list collect_set corr count count_if every first first_value grouping grouping_id last last_value max max_by mean median min min_by mode percentile percentile_approx some std stddev stddev_pop stddev_samp sum try_avg try_sum var_pop var_samp variance"
    " cume_dist dense_rank lag lead nth_value ntile percent_rank rank row_number"
    " abs ceil ceiling exp floor greatest least ln log log10 log2 mod negative nullifzero pmod pow power round sign sqrt try_add try_divide try_multiply try_subtract width_bucket zeroifnull"
    " char_length concat concat_ws contains endswith format_number format_string initcap instr left length like lower lpad ltrim regexp_count regexp_extract regexp_like regexp_replace repeat replace reverse right rlike rpad rtrim split split_part startswith strpos substr substring translate trim upper"
    " add_months date date_add date_diff date_format date_part date_sub date_trunc datediff day dayofmonth dayofweek dayofyear extract from_unixtime hour make_date minute month months_between quarter second timestamp timestamp_micros timestamp_millis timestamp_seconds to_date to_timestamp trunc unix_date unix_micros unix_millis unix_seconds unix_timestamp weekofyear year"
    " and array cardinality cast coalesce double exists explode explode_outer filter flatten forall get if ifnull in inline int isnan isnotnull isnull map map_keys map_values named_struct not nullif nvl nvl2 or posexplode sequence size slice sort_array struct transform when".split()
)


class Refused(ValueError):
    """Why a statement was not run."""


def _each(seq: JavaObject) -> Iterator[JavaObject]:
    for i in range(seq.size()):
        yield seq.apply(i)


def _function(name: str) -> None:
    if name.lower() not in FUNCTIONS:
        raise Refused(f"{name} is not permitted")


def _expression(e: JavaObject, names: frozenset[str], subquery: JavaObject) -> None:
    kind = e.getClass().getSimpleName()
    if subquery.isInstance(e):
        _plan(e.plan(), names, subquery)
    elif kind == "UnresolvedFunction":
        _function(".".join(_each(e.nameParts())))
    elif kind == "UnresolvedGenerator":
        _function(e.name().unquotedString())
    elif "Identifier" in kind:
        raise Refused("names from expressions are not permitted")
    for child in _each(e.children()):
        _expression(child, names, subquery)


def _plan(node: JavaObject, names: frozenset[str], subquery: JavaObject) -> None:
    """names: the relations that may be read here."""
    kind = node.getClass().getSimpleName().rstrip("$")
    if kind not in OPERATORS:
        raise Refused(f"{kind} is not permitted: only SELECT over the served relations")
    if kind == "UnresolvedRelation":
        parts = list(_each(node.multipartIdentifier()))
        if len(parts) != 1 or parts[0].lower() not in names:
            raise Refused(f"{'.'.join(parts)} is not served; there are: {', '.join(sorted(names))}")
    if kind == "UnresolvedWith":  # each may read those before it, and hides a relation of its name only after itself
        for cte in _each(node.cteRelations()):
            _plan(cte._2(), names, subquery)
            names = names | {cte._1().lower()}
    for e in _each(node.expressions()):
        _expression(e, names, subquery)
    for child in _each(node.children()):
        _plan(child, names, subquery)


def check(sql: str, relations: set[str]) -> None:
    """Raises Refused unless sql is one SELECT or WITH over the relations and its own CTEs."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except (ParseException, Py4JJavaError) as e:
        raise Refused(f"not one statement that can be read: {str(e).splitlines()[0]}") from None
    _plan(plan, frozenset(r.lower() for r in relations), spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.SubqueryExpression"))


def run_select(spark: SparkSession, sql: str, relations: dict[str, DataFrame], limit: int = 1000) -> DataFrame:
    """The statement's rows over temporary views of the relations, at most ``limit``."""
    check(sql, set(relations))
    for name, rows in relations.items():
        rows.createOrReplaceTempView(name)
    return spark.sql(sql.strip().rstrip("; \n")).limit(limit)
