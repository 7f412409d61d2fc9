"""One declarative query, written once, as Spark SQL and as the SQL that checks it.

A query is a function of a dialect; only spellings differ between the two, never the plan. Tables
are named in braces, so that Spark binds them to DataFrames without touching the catalog.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def text(value: str) -> str:
    """A string literal without escapes."""
    return "'" + value.replace("'", "''") + "'"


class Spark:
    name = "spark"

    def raw(self, pattern: str) -> str:
        return f'r"{pattern}"' if "'" in pattern else f"r'{pattern}'"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {self.raw(pattern)}, {self.raw(by.replace(chr(92) + '1', '$1'))})"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} rlike {self.raw(pattern)})"

    def all_matches(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, {self.raw(pattern)}, 0)"

    def first_match(self, x: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({x}, {self.raw(pattern)}, {group})"

    def lines(self, x: str) -> str:
        return f"split({x}, '\\n')"

    def pieces(self, x: str, sep: str) -> str:
        return f"split({x}, {self.raw(sep)})"

    def size(self, x: str) -> str:
        return f"CAST(size({x}) AS BIGINT)"

    def array(self, items: Iterable[str]) -> str:
        return f"array({', '.join(items)})"

    def numbered(self, columns: str, array: str, source: str) -> str:
        """Rows (columns, pos, item) of an array; pos counts from 0."""
        return f"SELECT {columns}, CAST(pos AS BIGINT) AS pos, item FROM (SELECT {columns}, posexplode({array}) AS (pos, item) FROM {source})"

    def each(self, columns: str, array: str, source: str) -> str:
        return f"SELECT {columns}, explode({array}) AS item FROM {source}"

    def starts(self, x: str, y: str) -> str:
        return f"startswith({x}, {y})"

    def ends(self, x: str, y: str) -> str:
        return f"endswith({x}, {y})"

    def joined(self, x: str, order: str | None = None, sep: str = ",") -> str:
        """The values of a group, in order, as one string."""
        if order is None or order == x:
            return f"array_join(array_sort(collect_list({x})), {text(sep)})"
        return f"array_join(transform(array_sort(collect_list(struct({order} AS o, {x} AS v))), s -> s.v), {text(sep)})"

    def day(self, x: str, n: str) -> str:
        return f"date_add({x}, CAST({n} AS INT))"

    def to_date(self, x: str, form: str) -> str:
        return f"CAST(try_to_timestamp({x}, '{form}') AS DATE)"

    def whole(self, x: str, y: str) -> str:
        return f"({x} div {y})"

    def even(self, x: str) -> str:
        return f"CAST(rint({x}) AS BIGINT)"

    def hex32(self, x: str) -> str:
        """The number of eight hexadecimal digits."""
        return f"CAST(conv({x}, 16, 10) AS BIGINT)"

    def field(self, json: str, key: str) -> str:
        return f"get_json_object({json}, '$.{key}')"

    def char(self, code: int) -> str:
        return f"chr({code})" if code < 256 else text(chr(code))

    def numbers(self, n: str) -> str:
        return f"(SELECT id AS i FROM range({n}))"

    def has(self, array: str, x: str) -> str:
        return f"array_contains({array}, {x})"

    def swap(self, x: str, old: str, new: str) -> str:
        return f"translate({x}, {text(old)}, {text(new)})"

    def lambda_(self, kind: str, array: str, var: str, body: str) -> str:
        return f"{ {'map': 'transform', 'keep': 'filter'}[kind] }({array}, {var} -> {body})"

    def glue(self, array: str, sep: str) -> str:
        return f"array_join({array}, {text(sep)})"


class Duck(Spark):
    name = "duck"

    def raw(self, pattern: str) -> str:
        return text(pattern)

    def sha(self, x: str) -> str:
        return f"sha256({x})"

    def replace_all(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {text(pattern)}, {text(by)}, 'g')"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {text(pattern)})"

    def all_matches(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, {text(pattern)})"

    def first_match(self, x: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({x}, {text(pattern)}, {group})"

    def lines(self, x: str) -> str:
        return f"string_split({x}, chr(10))"

    def pieces(self, x: str, sep: str) -> str:
        return f"string_split_regex({x}, {text(sep)})"

    def size(self, x: str) -> str:
        return f"CAST(len({x}) AS BIGINT)"

    def array(self, items: Iterable[str]) -> str:
        return f"[{', '.join(items)}]"

    def numbered(self, columns: str, array: str, source: str) -> str:
        return f"SELECT {columns}, CAST(unnest(range(len(a))) AS BIGINT) AS pos, unnest(a) AS item FROM (SELECT {columns}, {array} AS a FROM {source})"

    def each(self, columns: str, array: str, source: str) -> str:
        return f"SELECT {columns}, unnest({array}) AS item FROM {source}"

    def starts(self, x: str, y: str) -> str:
        return f"starts_with({x}, {y})"

    def ends(self, x: str, y: str) -> str:
        return f"ends_with({x}, {y})"

    def joined(self, x: str, order: str | None = None, sep: str = ",") -> str:
        return f"coalesce(string_agg({x}, {text(sep)} ORDER BY {order or x}), '')"

    def day(self, x: str, n: str) -> str:
        return f"CAST({x} + CAST({n} AS INT) AS DATE)"

    def to_date(self, x: str, form: str) -> str:
        return f"CAST(try_strptime({x}, '{form.replace('yyyy', '%Y').replace('MM', '%m').replace('dd', '%d')}') AS DATE)"

    def whole(self, x: str, y: str) -> str:
        return f"({x} // {y})"

    def even(self, x: str) -> str:
        return f"CAST(round_even({x}, 0) AS BIGINT)"

    def hex32(self, x: str) -> str:
        return f"CAST(concat('0x', {x}) AS BIGINT)"

    def field(self, json: str, key: str) -> str:
        return f"json_extract_string({json}, '$.{key}')"

    def char(self, code: int) -> str:
        return f"chr({code})"

    def numbers(self, n: str) -> str:
        return f"(SELECT range AS i FROM range({n}))"

    def has(self, array: str, x: str) -> str:
        return f"list_contains({array}, {x})"

    def lambda_(self, kind: str, array: str, var: str, body: str) -> str:
        return f"{ {'map': 'list_transform', 'keep': 'list_filter'}[kind] }({array}, lambda {var}: {body})"

    def glue(self, array: str, sep: str) -> str:
        return f"array_to_string({array}, {text(sep)})"


SPARK, DUCK = Spark(), Duck()
Plan = Callable[[Spark], str]


def _bound(sql: str, names: dict[str, str]) -> str:
    for table in TABLES:
        sql = sql.replace("{" + table + "}", names.get(table, table))
    return sql


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


def spark_query(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    """The plan over the tables of a folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql = plan(SPARK)
        used = [t for t in TABLES if "{" + t + "}" in sql]
        for t in used:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(f"loom_{t}")
        return spark.sql(_bound(sql, {t: f"loom_{t}" for t in used}))

    return run


def check_sql(plan: Plan) -> str:
    return _bound(plan(DUCK), {})


def first_of(conditions: Iterable[tuple[str, str]], otherwise: str) -> str:
    """An ordered cascade: the value of the first condition that holds."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in conditions) + f" ELSE {otherwise} END"


def any_in(x: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {text(w)})" for w in words) + ")"


def any_end(d: Spark, x: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(d.ends(x, text(w)) for w in words) + ")"


def values(rows: Iterable[tuple], names: str) -> str:
    """A small literal relation."""
    show = lambda v: "NULL" if v is None else text(v) if isinstance(v, str) else str(v)
    body = ", ".join(f"({', '.join(map(show, r))})" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({names}))"
