"""Queries of a tenant that can only read what belongs to the tenant.

A query is analysed, which reads no rows, and every relation in its plan is looked up: tables and views must lie in the
tenant's database, files below the tenant's folders. What is behind a view counts as if it had been named, and so do
subqueries. Temporary views, and relations of any other kind, are refused: new kinds have to be let in on purpose.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.tenancy import database_for
from ..workspace import qualified

#: Relations without data of anybody, and references to parts of the plan that are looked at on their own.
HARMLESS = ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef")


class NotYours(PermissionError):
    """A query names something outside the tenant's database and folders."""


def _each(items) -> Iterator:
    return (items.apply(i) for i in range(items.size()))


def _nodes(plan) -> Iterator:
    """All nodes of an analysed plan, those of its subqueries and of what its views stand for included."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [*_each(node.children()), *_each(node.innerChildren()), *_each(node.subqueries())]


def foreign_relations(df: DataFrame, tenant: str, folders: Sequence[str] = ()) -> list[str]:
    """Names of the relations in a query that do not belong to the tenant; see :func:`tenant_query`."""
    spark, own = df.sparkSession, database_for(tenant)
    allowed = [qualified(spark, folder).rstrip("/") for folder in folders]
    return sorted({name for node in _nodes(df._jdf.queryExecution().analyzed()) for name in _foreign(node, own, allowed)})


def _foreign(node, own: str, allowed: list[str]) -> list[str]:
    kind = node.getClass().getSimpleName().rstrip("$")
    if kind == "View":
        # What a temporary view holds may be anybody's, also where its plan has no relation left.
        return [node.desc().identifier().unquotedString()] if node.isTempView() else _outside(node.desc().identifier(), own)
    if not node.children().isEmpty() or kind in HARMLESS:
        return []
    if kind != "LogicalRelation":
        return [node.getClass().getSimpleName()]
    if node.catalogTable().isDefined():
        return _outside(node.catalogTable().get().identifier(), own)
    if node.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return [node.relation().getClass().getSimpleName()]
    paths = [path.toString() for path in _each(node.relation().location().rootPaths())]
    return [path for path in paths if not any(path == folder or path.startswith(f"{folder}/") for folder in allowed)]


def _outside(identifier, own: str) -> list[str]:
    database = identifier.database().get() if identifier.database().isDefined() else ""
    return [] if database == own else [identifier.unquotedString()]


def tenant_query(spark: SparkSession, tenant: str, sql: str, folders: Sequence[str] = ()) -> DataFrame:
    """The rows of a tenant's query; names without a database are those of the tenant.

    ``folders`` are those whose files the tenant may read by path, or by a view. Anything else than a query is an error,
    and one that names what is not the tenant's is refused with :class:`NotYours` before it reads a row.
    """
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database_for(tenant))
    try:
        # Inside another query there is no room for statements that would run at once.
        df = spark.sql(f"SELECT * FROM (\n{sql}\n)")
    finally:
        spark.catalog.setCurrentDatabase(before)
    foreign = foreign_relations(df, tenant, folders)
    if foreign:
        raise NotYours(f"not of tenant {tenant}: {', '.join(foreign)}")
    return df
