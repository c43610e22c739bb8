"""The derived columns and the median under names of their own in ``spark.sql``, as SQL functions.

Each is a temporary function whose body is SQL: it is put in place of its call before the plan is optimised, so filters,
pruning and code generation see through it, and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from featureflow.functions.derive import AGE_BAND_ENDS, FARE_BAND_ENDS, TITLE_OTHERWISE, TITLE_RULES, Rules


def literal(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_match_sql(column: str, rules: Rules, otherwise: str) -> str:
    """The category of the first rule with a keyword in the column, as ``first_match`` gives it for substrings."""
    tests = [" OR ".join(f"contains({column}, {literal(k)})" for k in words) for _, words in rules]
    cases = " ".join(f"WHEN {test} THEN {literal(name)}" for (name, _), test in zip(rules, tests, strict=True))
    return f"CASE {cases} ELSE {literal(otherwise)} END"


def band_sql(column: str, ends: Sequence[float], outside: str) -> str:
    """Number of the first end above the column; the last band takes the rest, null, and what ``outside`` says."""
    cases = " ".join(f"WHEN {column} < {end} THEN {i}" for i, end in enumerate(ends))
    return f"CASE WHEN {outside} THEN {len(ends)} {cases} ELSE {len(ends)} END"


def middle_sql(tallies: str) -> str:
    """The mean of the values at both middle ranks, by counting up the values in order."""
    held = f"filter({tallies}, t -> t.value IS NOT NULL AND t.count > 0)"
    total = f"aggregate({held}, 0L, (n, t) -> n + t.count)"
    reached = lambda rank, name: f"CASE WHEN a.{name} IS NULL AND a.at + t.count >= {rank} THEN t.value ELSE a.{name} END"
    step = f"named_struct('at', a.at + t.count, 'low', {reached(f'({total} + 1) div 2', 'low')}, 'high', {reached(f'{total} div 2 + 1', 'high')})"
    start = "named_struct('at', 0L, 'low', CAST(NULL AS DOUBLE), 'high', CAST(NULL AS DOUBLE))"
    return f"aggregate(array_sort({held}), {start}, (a, t) -> {step}, a -> (a.low + a.high) / 2)"


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions in this session and return their names.

    * ``title_group(name)``: the title group of a person's name.
    * ``age_band(age)``, ``fare_band(fare)``: band numbers.
    * ``middle(tallies)``: the exact median of an array of (value, count); null without values. The array is one key's,
      so it is meant for the output of ``middle_tally``, whose size does not follow the key's rows.
    * ``title_keywords()``: a table of (place, title, keyword), the rules in the order in which they are tested.
    """
    keywords = ", ".join(f"({i}, {literal(title)}, {literal(k)})" for i, (title, words) in enumerate(TITLE_RULES) for k in words)
    bodies = {
        "title_group(name STRING) RETURNS STRING": first_match_sql("name", TITLE_RULES, TITLE_OTHERWISE),
        "age_band(age DOUBLE) RETURNS INT": band_sql("age", AGE_BAND_ENDS, "age <= 0"),
        "fare_band(fare DOUBLE) RETURNS INT": band_sql("fare", FARE_BAND_ENDS, "fare < 0"),
        "middle(tallies ARRAY<STRUCT<value: DOUBLE, count: BIGINT>>) RETURNS DOUBLE": middle_sql("tallies"),
        "title_keywords() RETURNS TABLE (place INT, title STRING, keyword STRING)": f"SELECT * FROM VALUES {keywords} AS t(place, title, keyword)",
    }
    names = [prefix + head[: head.index("(")] for head in bodies]
    for name, (head, body) in zip(names, bodies.items(), strict=True):
        # A SQL function replaces none of another kind, such as a registered Python one of that name.
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        spark.sql(f"CREATE TEMPORARY FUNCTION {prefix}{head} RETURN {body}")
    return names
