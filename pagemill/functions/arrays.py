"""Array helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F


# Rows of an Arrow batch that are Python objects at one time.
ROWS_AT_ONCE = 256


def few_at_once(column) -> Iterator:
    """The values of an Arrow array, some rows at a time: a batch of token arrays as
    Python objects is many times its Arrow size."""
    for at in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(at, ROWS_AT_ONCE).to_pandas()


def quoted(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` so that `body` may use it many times while it is computed
    once per row, whatever the optimizer merges."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_sql(value: Column, body: str) -> Column:
    """`let` with the body as a SQL lambda. Large expressions are parsed in the
    JVM in one call instead of being put together call by call."""
    return F.get(F.call_function("transform", F.array(value), F.expr(body)), F.lit(0))


# Runs of equal neighbours of `v`: start positions, then lengths.
_RUNS = """CASE WHEN size({v}) > 0 THEN get(transform(array(
    filter(sequence(0, size({v}) - 1), i -> i = 0 OR NOT (get({v}, i) <=> get({v}, i - 1)))),
    s -> transform(s, (b, j) -> named_struct('start', b, 'len', coalesce(get(s, j + 1), size({v})) - b))), 0)
  ELSE cast(array() AS array<struct<start:int,len:int>>) END"""


def runs(values: Column) -> Column:
    """Runs of equal neighbours as array<struct<start, len>> (0-based start)."""
    return let_sql(values, "v -> " + _RUNS.format(v="v"))


def term_counts(tokens: Column) -> Column:
    """Term frequencies of one document as array<struct<term, tf>>, by sorting
    the token array and measuring its runs: no explode, no shuffle."""
    return let_sql(
        F.sort_array(tokens),
        f"""t -> transform({_RUNS.format(v='t')},
          r -> named_struct('term', get(t, r.start), 'tf', cast(r.len AS bigint)))""",
    )


def max_tf(counts: Column) -> Column:
    """Largest frequency in a counts array; 1 for an empty document."""
    return F.coalesce(F.array_max(F.transform(counts, lambda c: c["tf"])), F.lit(1).cast("bigint"))


def norm(counts: Column, field: str = "tf") -> Column:
    """Euclidean length of a counts array."""
    return F.sqrt(
        F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c[field].cast("double") * c[field].cast("double"))
    )
