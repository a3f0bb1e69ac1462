"""Read-only SQL over the tables of a lake, now or at a snapshot."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.cleaning import clean_nonfinite
from salesloom.tables.lake import Lake
from salesloom.tables.log import SnapshotNotFound, TableNotFound

# What a statement may start with, and words it may not contain.
ALLOWED_FIRST_WORDS = ("select", "with", "show", "describe", "desc")
FORBIDDEN_WORDS = (
    "insert", "update", "delete", "drop", "alter", "truncate", "merge", "create", "call",
)
# What the text of an error begins with.
FAILED = "The query failed: "
# Functions that run arbitrary Java code.
FORBIDDEN_FUNCTIONS = ("reflect", "java_method", "try_reflect")
# What the parsed plan of a query may consist of. Anything else, known or not, is refused:
# script transformations, commands, writes, time travel by names that are no tables here.
QUERY_NODES = frozenset(
    "Project Filter Aggregate Join LateralJoin AsOfJoin Sort GlobalLimit LocalLimit Offset Distinct Union Intersect "
    "Except Window WithWindowDefinition Generate Expand Pivot Unpivot Sample Deduplicate UnresolvedHaving UnresolvedHint "
    "UnresolvedWith SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedInlineTable LocalRelation OneRowRelation "
    "UnresolvedRelation UnresolvedTableValuedFunction UnresolvedTVFAliases PipeOperator Range".split()
)
TABLE_FUNCTIONS = frozenset("range explode explode_outer posexplode posexplode_outer inline inline_outer stack".split())
# The name under which a snapshot is queried.
SNAPSHOT_NAME = "historical_data"

# Text that is not code: raw and plain strings, quoted names, comments.
_STRINGS = r"""(?<!\w)[rR](?:'[^']*'|"[^"]*")|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
_COMMENTS = r"""--[^\n]*|/\*(?!\+).*?\*/"""
_NO_CODE = f"{_STRINGS}|{_COMMENTS}"
_QUOTED = re.compile(rf"{_STRINGS}|`(?:[^`]|``)*`|{_COMMENTS}", re.DOTALL)


class ReadOnlyViolation(ValueError):
    """The statement is not one that only reads."""


@dataclass(frozen=True)
class Outcome:
    """Rows, or the text of the error that Spark raised."""

    rows: DataFrame | None
    error: str | None


def code_of(sql: str) -> str:
    """The statement without strings, quoted names and comments."""
    return _QUOTED.sub(" ", sql)


def check_read_only(sql: str) -> str:
    """The statement, trimmed, if it only reads.

    Words are looked for outside strings and quoted names, so a product called
    'drop' is fine and `DROP` on a line of its own is not.
    """
    statement = sql.strip().rstrip(";").rstrip()
    code = code_of(statement).lower()
    first = re.match(r"[\s(]*(\w+)", code)
    if first is None or first[1] not in ALLOWED_FIRST_WORDS:
        raise ReadOnlyViolation(f"A statement must begin with one of {', '.join(ALLOWED_FIRST_WORDS)}.")
    for word in FORBIDDEN_WORDS:
        if re.search(rf"\b{word}\b", code):
            raise ReadOnlyViolation(f"The word {word.upper()} has no place in a statement that only reads.")
    for name in FORBIDDEN_FUNCTIONS:
        if re.search(rf"\b{name}\s*\(", code):
            raise ReadOnlyViolation(f"The function {name} is not allowed.")
    return statement


def is_query(statement: str) -> bool:
    return re.match(r"[\s(]*(select|with)\b", code_of(statement).lower()) is not None


def replace_in_code(sql: str, pattern: re.Pattern[str], replacement: Any) -> str:
    """Substitute in the parts that are code, leaving strings and comments as they are."""
    out, position = [], 0
    for quoted in _QUOTED.finditer(sql):
        out += [pattern.sub(replacement, sql[position : quoted.start()]), quoted[0]]
        position = quoted.end()
    return "".join([*out, pattern.sub(replacement, sql[position:])])


def records(rows: DataFrame) -> Iterator[dict[str, Any]]:
    """Rows as dictionaries, fetched a partition at a time."""
    for row in rows.toLocalIterator():
        yield row.asDict(recursive=True)


class PlanCheck:
    """Walks a parsed plan, subqueries and common tables included, and refuses what doesn't only
    read the given relations."""

    def __init__(self, spark: SparkSession, relations: set[str]):
        self.parser = spark._jsparkSession.sessionState().sqlParser()
        loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        name = "org.apache.spark.sql.catalyst.expressions.SubqueryExpression"
        self.subquery = spark._jvm.java.lang.Class.forName(name, True, loader)
        self.known = {name.lower() for name in relations}

    def check(self, query: str) -> None:
        self._plan(self.parser.parsePlan(query), frozenset())

    def _plan(self, plan: Any, common: frozenset[str]) -> None:
        kind = plan.getClass().getSimpleName().rstrip("$")
        if kind not in QUERY_NODES:
            raise ReadOnlyViolation(f"{kind} is not part of a query that only reads.")
        if kind == "UnresolvedRelation":
            parts = [part.lower() for part in _each(plan.multipartIdentifier())]
            if len(parts) != 1 or parts[0] not in self.known | common:
                raise ReadOnlyViolation(f"{'.'.join(parts)} is not a table here.")
        if kind == "UnresolvedTableValuedFunction":
            name = ".".join(_each(plan.name())).lower()
            if name not in TABLE_FUNCTIONS:
                raise ReadOnlyViolation(f"The table function {name} is not allowed.")
        if kind == "UnresolvedWith":
            for named in _each(plan.cteRelations()):
                # A common table sees those before it, and itself where it is recursive.
                common |= {named._1().lower()}
                self._plan(named._2(), common)
        for child in _each(plan.children()):
            self._plan(child, common)
        for expression in _each(plan.expressions()):
            self._expression(expression, common)

    def _expression(self, expression: Any, common: frozenset[str]) -> None:
        kind = expression.getClass().getSimpleName()
        if kind == "UnresolvedFunction":
            name = list(_each(expression.nameParts()))[-1].lower()
            if name in FORBIDDEN_FUNCTIONS:
                raise ReadOnlyViolation(f"The function {name} is not allowed.")
        if self.subquery.isInstance(expression):
            self._plan(expression.plan(), common)
        for child in _each(expression.children()):
            self._expression(child, common)


def _each(sequence: Any) -> Iterator[Any]:
    for k in range(sequence.size()):
        yield sequence.apply(k)


class ReadOnlySql:
    """Tables are named plainly (`fact_sales`) or with a prefix (`local.db.fact_sales`).

    `<table>.snapshots`, `<table>.files`, `VERSION AS OF <snapshot>` and
    `TIMESTAMP AS OF '<time>'` work as in table formats that have them built in.
    """

    def __init__(self, lake: Lake, prefixes: tuple[str, ...] = ("local.db",)):
        self.lake = lake
        self.spark = lake.spark
        self.prefixes = (*prefixes, lake.namespace)

    def run(self, sql: str) -> DataFrame:
        """Rows of a statement on current data, with NaN and infinities as NULL."""
        return self._execute(*self._bind(check_read_only(sql)))

    def run_or_error(self, sql: str) -> Outcome:
        """Like run, with Spark's errors as text. A refused statement still raises."""
        statement = check_read_only(sql)
        try:
            return Outcome(self._execute(*self._bind(statement)), None)
        except (PySparkException, SnapshotNotFound, TableNotFound) as error:
            return Outcome(None, f"{FAILED}{error}")

    def run_at_or_error(self, snapshot_id: int | str, sql: str, table: str = "fact_sales") -> Outcome:
        """Like run_at, with errors as text. A refused statement still raises."""
        try:
            return Outcome(self.run_at(snapshot_id, sql, table), None)
        except ReadOnlyViolation:
            raise
        except (PySparkException, SnapshotNotFound, TableNotFound, ValueError) as error:
            return Outcome(None, f"{FAILED}{error}")

    def stream(self, sql: str) -> Iterator[dict[str, Any]]:
        """Rows as dictionaries; an error of Spark, also a late one, comes as the last."""
        outcome = self.run_or_error(sql)
        try:
            if outcome.rows is not None:
                yield from records(outcome.rows)
            else:
                yield {"error": outcome.error}
        except (PySparkException, Py4JError) as error:
            yield {"error": f"{FAILED}{error}"}

    def run_at(self, snapshot_id: int | str, sql: str, table: str = "fact_sales") -> DataFrame:
        """Rows of a statement on one table at a snapshot.

        The table goes by `historical_data`; its live name means the snapshot too.
        Other tables are read as they are now.
        """
        statement = self._unquoted(check_read_only(sql), [table])
        view = self._view(table, version=int(snapshot_id))
        names = "|".join([SNAPSHOT_NAME, self._name_pattern(table)])
        pattern = re.compile(rf"(?<![\w.`])(?:{names})(?![\w`])", re.IGNORECASE)
        bound, views = self._bind(replace_in_code(statement, pattern, view))
        return self._execute(bound, views | {view})

    def schema_text(self, tables: list[str]) -> dict[str, list[str] | str]:
        """Per table its columns as "name: type", or the text of an error."""
        texts: dict[str, list[str] | str] = {}
        for row in self.lake.schema_info(tables).orderBy("table_name", "ordinal").collect():
            if row["error"] is not None:
                texts[row["table_name"]] = row["error"]
            else:
                columns = texts.setdefault(row["table_name"], [])
                columns.append(f"{row['column_name']}: {row['data_type']}")
        return texts

    def _execute(self, statement: str, views: set[str] = frozenset()) -> DataFrame:
        prefixes = "|".join(re.escape(p) for p in self.prefixes)
        listing = re.fullmatch(
            rf"(?is)\s*show\s+tables(?:\s+(?:in|from)\s+(?:{prefixes}))?(?:\s+(?:like\s+)?'([^']*)')?\s*", statement
        )
        if listing:
            tables = self.lake.tables()
            if listing[1] is None:
                return tables
            names = "|".join(re.escape(p.strip()).replace(r"\*", ".*") for p in listing[1].split("|"))
            return tables.where(F.col("tableName").rlike(f"(?i)^(?:{names})$"))
        if is_query(statement):
            # As a subquery the grammar admits nothing but a query.
            statement = f"SELECT * FROM (\n{statement}\n)"
            PlanCheck(self.spark, set(views)).check(statement)
        else:
            described = re.fullmatch(r"(?is)\s*desc(?:ribe)?\s+(?:table\s+)?(?:extended\s+)?(\w+)\s*", statement)
            if described is None or described[1] not in views:
                raise ReadOnlyViolation("Only tables of this lake can be listed or described.")
        return clean_nonfinite(self.spark.sql(statement))

    def _unquoted(self, statement: str, tables: list[str]) -> str:
        """Quoted names of tables without their quotes; strings and comments stay."""
        names = re.compile("|".join(rf"{self._name_pattern(t)}(?:\.(?:snapshots|files))?" for t in tables) or "(?!)", re.I)
        part = r"(?:`[^`]+`|\w+)"
        pieces = re.compile(rf"{_NO_CODE}|(?P<name>{part}(?:\.{part})*)", re.DOTALL)

        def plain(found: re.Match[str]) -> str:
            bare = (found["name"] or "").replace("`", "")
            return bare if "`" in found[0] and bare and names.fullmatch(bare) else found[0]

        return pieces.sub(plain, statement)

    def _name_pattern(self, table: str) -> str:
        prefixes = "|".join(re.escape(p) for p in self.prefixes)
        return rf"(?:(?:{prefixes})\.)?{re.escape(table)}"

    def _bind(self, statement: str) -> tuple[str, set[str]]:
        """The statement with names of tables pointed at views, and these views."""
        tables = [row["tableName"] for row in self.lake.tables().collect()]
        statement = self._unquoted(statement, tables)
        code = code_of(statement).lower()
        views: set[str] = set()

        def view(table: str, **what: Any) -> str:
            views.add(name := self._view(table, **what))
            return name

        for table in tables:
            if table.lower() not in code:
                continue
            # The time of a TIMESTAMP clause is a string, so it is bound on the whole text.
            when = re.compile(
                rf"(?i)(?<![\w.`'\"]){self._name_pattern(table)}\s+"
                r"(?:FOR\s+)?(?:SYSTEM_)?(?:TIMESTAMP|TIME)\s+AS\s+OF\s+(?:TIMESTAMP\s+)?'([^']*)'"
            )
            statement = when.sub(lambda m, t=table: view(t, version=self._version_at(t, m[1])), statement)
            version = re.compile(
                rf"(?i)(?<![\w.`]){self._name_pattern(table)}\s+"
                r"(?:FOR\s+)?(?:SYSTEM_)?VERSION\s+AS\s+OF\s+(\d+)"
            )
            statement = replace_in_code(
                statement, version, lambda m, t=table: view(t, version=int(m[1]))
            )
            metadata = re.compile(
                rf"(?i)(?<![\w.`]){self._name_pattern(table)}\.(snapshots|files)(?![\w`])"
            )
            statement = replace_in_code(
                statement, metadata, lambda m, t=table: view(t, kind=m[1].lower())
            )
            live = re.compile(rf"(?i)(?<![\w.`]){self._name_pattern(table)}(?![\w`])")
            if live.search(code_of(statement)):
                statement = replace_in_code(statement, live, view(table))
        return statement, views

    def _version_at(self, table: str, when: str) -> int | None:
        return self.lake.state(table, as_of=dt.datetime.fromisoformat(when)).snapshot_id

    def _view(self, table: str, version: int | None = None, kind: str = "rows") -> str:
        """A view named after exactly what it shows: the lake, the log entry or snapshot, the kind.

        So calls in one session, on one lake or several, never change what another one reads.
        """
        state = self.lake.state(table, version)
        shown = f"e{state.entry}" if version is None else f"e{state.entry}_v{version}"
        name = f"{table}__{hashlib.sha1(self.lake.root.encode()).hexdigest()[:12]}_{shown}_{kind}"
        if kind == "snapshots":
            rows = self.lake.snapshots(table)
        elif kind == "files":
            rows = self.lake.file_counts(table)
        else:
            rows = self.lake.read(table, snapshot_id=version)
        rows.createOrReplaceTempView(name)
        return name
