"""Helpers shared by the registered queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin
from ..sources.tables import table

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_STAMP = "%Y-%m-%d %H:%M:%S.%f"


def plain(df: DataFrame, digits: Mapping[str, int] | None = None) -> DataFrame:
    """Output in types both engines print alike: bigint, double, text, boolean.

    `digits` rounds quotients and means that the model itself leaves unrounded.
    """
    digits = digits or {}
    out = []
    for field in df.schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if field.name in digits:
            value = F.round(value, digits[field.name])
        if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
            value = value.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, STAMP)
        elif isinstance(kind, T.ArrayType):
            value = F.array_join(value, ",")
        out.append(value.alias(field.name))
    return df.select(*out)


# words that the two engines spell differently, for the stand-in texts
SPARK_WORDS = {
    "k": "cast(get_json_object(props, '$.k') as bigint)",
    "month_name": "date_format(l_shipdate, 'MMMM')",
    "week": "weekofyear(l_shipdate)",
    "iso_ts": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "ts_plus": "ts + make_dt_interval(0, 0, 0, 2)",
}
DUCK_WORDS = {
    "k": "cast(json_extract_string(props, '$.k') as bigint)",
    "month_name": "monthname(l_shipdate)",
    "week": "weekofyear(l_shipdate)",
    "iso_ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "ts_plus": "ts + interval 2 second",
}


def _fill(text: str, words: Mapping[str, str]) -> str:
    for word, spelling in words.items():
        text = text.replace("{" + word + "}", spelling)
    return text


@dataclass(frozen=True)
class Standin:
    """A logical input derived from one given table, column by column, in either engine."""

    source: str
    columns: Mapping[str, str]
    where: str = "true"

    def frame(self, spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
        """The rows, dealt to `tasks` tasks by the content of their source rows where that is given."""
        rows = table(spark, folder, self.source).where(_fill(self.where, SPARK_WORDS))
        if tasks:
            rows = rows.repartition(tasks, *rows.columns)
        return rows.selectExpr(*[f"{_fill(e, SPARK_WORDS)} as `{n}`" for n, e in self.columns.items()])

    @property
    def sql(self) -> str:
        picked = ", ".join(f'{_fill(e, DUCK_WORDS)} as "{n}"' for n, e in self.columns.items())
        return f"(select {picked} from {self.source} where {_fill(self.where, DUCK_WORDS)})"


_kept_rows: ContextVar[dict | None] = ContextVar("kept_rows", default=None)


@contextmanager
def shared_rows():
    """Within it, all queries read the `shared` rows of a folder from one place, written by the first that asks."""
    outer = _kept_rows.get()
    before = _kept_rows.set({} if outer is None else outer)
    try:
        yield
    finally:
        _kept_rows.reset(before)


def shared(folder: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows that `build` makes: plainly, or written once within `shared_rows`."""
    kept = _kept_rows.get()
    if kept is None:
        return build()
    if (label, folder) not in kept:
        kept[label, folder] = pin(build(), label)
    return kept[label, folder]


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def steps_sql(value: str, rungs, default, extra: str = "") -> str:
    """CASE text of a threshold ladder kept in the fixed values."""
    arms = " ".join(f"when {value} >= {t}{extra} then {literal(r)}" for t, r in rungs)
    return f"case {arms} else {default if default is not None else 'null'} end"


def groups_sql(value: str, groups, default) -> str:
    arms = " ".join(f"when {value} in ({quoted(members)}) then {literal(r)}" for members, r in groups)
    return f"case {arms} else {default} end"


def nth_sql(index: str, values) -> str:
    """Text of the value at a zero-based index of a literal list (null outside it)."""
    arms = " ".join(f"when {i} then {literal(v)}" for i, v in enumerate(values))
    return f"case {index} {arms} end"


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of a quotient or mean, as Spark rounds doubles."""
    scale = 10 if digits <= 4 else 14
    return f"cast(round(cast({value} as decimal(38,{scale})), {digits}) as double)"


def day(value: str) -> str:
    return f"cast(cast({value} as date) as varchar)"


def moment(value: str) -> str:
    return f"strftime({value}, '{SQL_STAMP}')"


def big(value: str) -> str:
    return f"cast({value} as bigint)"


def dbl(value: str) -> str:
    return f"cast({value} as double)"


class Catalog:
    """Named queries, each with the SQL that gives the same rows where there is one."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.checks: dict[str, str] = {}

    def add(self, name: str, check: str | None = None):
        def register(function):
            self.queries[name] = function
            if check is not None:
                self.checks[name] = check
            return function

        return register
