"""Queries: imputation, categories, bands, records, averages and medians."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.derive import (
    TITLE_RULES,
    age_band,
    code_initial,
    fare_band,
    first_match,
    flag_equals,
    size_band,
    title_of,
)
from featureflow.functions.sql import register as register_sql
from featureflow.operators.aggregate import (
    approx_median,
    exact_median,
    global_avg,
    middle_tally,
    register_middle,
)
from featureflow.operators.encode import vector_slots
from featureflow.operators.impute import (
    TITLE_AGES,
    fill_constants,
    fill_group_medians,
    fill_means,
    fill_numeric_zero,
    fit_group_medians,
    fit_means,
    lookup_value,
)
from featureflow.operators.lookup import attach
from featureflow.operators.sketches import merged, quantile, rank_bound, store_part, stored
from featureflow.operators.split import below
from featureflow.plans.passengers import banded_record, labelled_points, plain_record, title_medians
from featureflow.plans.registry import query
from featureflow.plans.standin import BASE_SQL, base, id_cutoff, table
from featureflow.session import scratch_path
from featureflow.sources.files import register_view


def _train(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return below(base(spark, sf_dir, "PassengerId", *columns), "PassengerId", id_cutoff(spark, sf_dir))


TITLE_SQL = """CASE
  WHEN contains(Name, 'Capt') OR contains(Name, 'Col') OR contains(Name, 'Major') OR contains(Name, 'Dr')
    OR contains(Name, 'Rev') THEN 'Officer'
  WHEN contains(Name, 'Jonkheer') OR contains(Name, 'Don') OR contains(Name, 'Sir')
    OR contains(Name, 'the Countess') OR contains(Name, 'Dona') OR contains(Name, 'Lady') THEN 'Royalty'
  WHEN contains(Name, 'Mme') OR contains(Name, 'Ms') OR contains(Name, 'Mrs') THEN 'Mrs'
  WHEN contains(Name, 'Mlle') THEN 'Miss'
  WHEN contains(Name, 'Mr') THEN 'Mr'
  WHEN contains(Name, 'Master') THEN 'Master' ELSE 'Anyone' END"""
TITLE_AGE_SQL = """CASE title WHEN 'Miss' THEN 24.0 WHEN 'Anyone' THEN 18.0 WHEN 'Officer' THEN 36.0
  WHEN 'Royalty' THEN 39.0 WHEN 'Master' THEN 3.0 WHEN 'Mr' THEN 25.0 WHEN 'Mrs' THEN 31.0 END::DOUBLE"""
AGE_BAND_SQL = """CASE WHEN {x} > 0 AND {x} < 11 THEN 0 WHEN {x} >= 11 AND {x} < 21 THEN 1
  WHEN {x} >= 21 AND {x} < 31 THEN 2 WHEN {x} >= 31 AND {x} < 41 THEN 3 WHEN {x} >= 41 AND {x} < 51 THEN 4
  WHEN {x} >= 51 AND {x} < 61 THEN 5 WHEN {x} >= 61 AND {x} < 71 THEN 6 ELSE 7 END"""
FARE_BAND_SQL = """CASE WHEN {x} >= 0 AND {x} < 8 THEN 0 WHEN {x} >= 8 AND {x} < 15 THEN 1
  WHEN {x} >= 15 AND {x} < 32 THEN 2 ELSE 3 END"""
SIZE_BAND_SQL = "CASE WHEN SibSp + Parch < 2 THEN 1 WHEN SibSp + Parch <= {top} THEN 2 ELSE 3 END"
MEANS_SQL = """means AS (SELECT avg(Age) AS mean_age, avg(Fare) AS mean_fare
  FROM base, cut WHERE PassengerId < cutoff)"""


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, round(coalesce(Age, (SELECT avg(Age) FROM base)), 6) AS avg_age FROM base"""
)
def sql_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null age -> the overall average, as a scalar subquery in SQL."""
    register_view(base(spark, sf_dir, "PassengerId", "Age"), "ff_passengers")
    return spark.sql(
        """SELECT PassengerId, round(nvl(Age, (SELECT avg(Age) FROM ff_passengers)), 6) AS avg_age
           FROM ff_passengers"""
    )


@query(
    f"""WITH {BASE_SQL}, {MEANS_SQL}
    SELECT PassengerId, round(coalesce(Age, mean_age), 6) AS age, round(coalesce(Fare, mean_fare), 6) AS fare
    FROM base, means"""
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means fitted on the training rows, applied to all rows."""
    means = fit_means(_train(spark, sf_dir, "Age", "Fare"), "Age", "Fare")
    filled = fill_means(base(spark, sf_dir, "PassengerId", "Age", "Fare"), means, "Age", "Fare")
    return filled.select(
        "PassengerId", F.round("Age", 6).alias("age"), F.round("Fare", 6).alias("fare")
    )


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, coalesce(Embarked, 'S') AS embarked, coalesce(Cabin, 'Unknown') AS cabin,
           coalesce(Fare, 0.0) AS fare FROM base"""
)
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant per column."""
    rows = fill_constants(base(spark, sf_dir), {"Embarked": "S", "Cabin": "Unknown", "Fare": 0.0})
    return rows.select(
        "PassengerId", F.col("Embarked").alias("embarked"), F.col("Cabin").alias("cabin"), F.col("Fare").alias("fare")
    )


@query(
    f"""WITH {BASE_SQL}
    SELECT PassengerId, coalesce(Age, 0.0) AS age, coalesce(Fare, 0.0) AS fare, Cabin AS cabin FROM base""",
    name="fill_numeric_zero",
)
def numeric_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 in every numeric column; strings keep their nulls."""
    rows = fill_numeric_zero(base(spark, sf_dir))
    return rows.select(
        "PassengerId", F.col("Age").alias("age"), F.col("Fare").alias("fare"), F.col("Cabin").alias("cabin")
    )


@query(
    f"""WITH {BASE_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM base)
    SELECT PassengerId, title, coalesce(Age, {TITLE_AGE_SQL}) AS age FROM titled"""
)
def impute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null age -> the constant of the title."""
    rows = base(spark, sf_dir).withColumn("title", title_of("Name"))
    return rows.select(
        "PassengerId", "title", F.coalesce("Age", lookup_value(F.col("title"), TITLE_AGES)).alias("age")
    )


@query(
    f"""WITH {BASE_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM base),
    medians AS (SELECT title, median(Age) AS m FROM titled, cut WHERE PassengerId < cutoff GROUP BY title)
    SELECT PassengerId, title, round(coalesce(Age, m), 6) AS age FROM titled LEFT JOIN medians USING (title)"""
)
def impute_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null age -> median age of the title in the training rows."""
    titled = base(spark, sf_dir).select("PassengerId", "Age", title_of("Name").alias("title"))
    train = below(titled, "PassengerId", id_cutoff(spark, sf_dir))
    medians = fit_group_medians(train, "Age", ["title"])
    filled = fill_group_medians(titled, medians, "Age", ["title"], salt_by=["PassengerId"])
    return filled.select("PassengerId", "title", F.round("Age", 6).alias("age"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {TITLE_SQL} AS title FROM base")
def categorise_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title group of the name: ordered substring rules."""
    return base(spark, sf_dir).select("PassengerId", title_of("Name").alias("title"))


PART_RULES = (("aged", ("old", "new")), ("warmth", ("hot", "cold")), ("size", ("small", "large")))


@query(
    """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '\\b(old|new)\\b') THEN 'aged'
         WHEN regexp_matches(p_name, '\\b(hot|cold)\\b') THEN 'warmth'
         WHEN regexp_matches(p_name, '\\b(small|large)\\b') THEN 'size' ELSE 'other' END AS by_word,
       CASE WHEN contains(p_name, 'old') OR contains(p_name, 'new') THEN 'aged'
         WHEN contains(p_name, 'hot') OR contains(p_name, 'cold') THEN 'warmth'
         WHEN contains(p_name, 'small') OR contains(p_name, 'large') THEN 'size' ELSE 'other' END AS by_substring
       FROM part"""
)
def categorise_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules on whole words and on substrings: "old" is also found in "cold"."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        first_match("p_name", PART_RULES, "other", match="word").alias("by_word"),
        first_match("p_name", PART_RULES, "other").alias("by_substring"),
    )


@query(f"WITH {BASE_SQL} SELECT PassengerId, coalesce(substr(Cabin, 1, 1), 'U') AS cabin FROM base", name="code_initial")
def cabin_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First letter of the cabin, U where unknown."""
    return base(spark, sf_dir).select("PassengerId", code_initial("Cabin").alias("cabin"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {SIZE_BAND_SQL.format(top=4)} AS family_band FROM base")
def band_size_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family size, middle band 2 to 4."""
    size = F.col("SibSp") + F.col("Parch")
    rows = base(spark, sf_dir, "PassengerId", "SibSp", "Parch")
    return rows.select("PassengerId", size_band(size, 4).alias("family_band"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {SIZE_BAND_SQL.format(top=3)} AS family_band FROM base")
def band_size_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family size, middle band 2 to 3."""
    size = F.col("SibSp") + F.col("Parch")
    rows = base(spark, sf_dir, "PassengerId", "SibSp", "Parch")
    return rows.select("PassengerId", size_band(size, 3).alias("family_band"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {AGE_BAND_SQL.format(x='Age')} AS age_band FROM base")
def band_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight age bands; unknown, zero and 71 or more share one."""
    return base(spark, sf_dir, "PassengerId", "Age").select("PassengerId", age_band("Age").alias("age_band"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {FARE_BAND_SQL.format(x='Fare')} AS fare_band FROM base")
def band_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fare bands; negative and unknown share the last."""
    return base(spark, sf_dir).select("PassengerId", fare_band("Fare").alias("fare_band"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END AS filled
       FROM lineitem""",
    name="flag_equals",
)
def status_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0/1 flag."""
    flag = flag_equals("l_linestatus", "F").alias("filled")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", flag)


@query(
    f"""WITH {BASE_SQL}, {MEANS_SQL}
    SELECT PassengerId AS passenger_id, Survived AS survived, {TITLE_SQL} AS title, Pclass AS pclass, Sex AS sex,
           round(coalesce(Age, mean_age), 6) AS age, {SIZE_BAND_SQL.format(top=4)} AS family_band,
           coalesce(Fare, 0.0) AS fare, coalesce(Cabin, 'Unknown') AS cabin, coalesce(Embarked, 'S') AS embarked
    FROM base, means"""
)
def feature_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned record of every row."""
    means = fit_means(_train(spark, sf_dir, "Age", "Fare"), "Age", "Fare")
    return plain_record(base(spark, sf_dir), means).withColumn("age", F.round("age", 6))


TITLED_SQL = f"{BASE_SQL}, {MEANS_SQL}, titled AS (SELECT *, {TITLE_SQL} AS title FROM base, means)"
BANDED_SQL = f"""SELECT PassengerId AS passenger_id, Survived AS survived, title, Pclass AS pclass, Sex AS sex,
           {AGE_BAND_SQL.format(x="a")} AS age_band, {SIZE_BAND_SQL.format(top=3)} AS family_band,
           {FARE_BAND_SQL.format(x="f")} AS fare_band, coalesce(substr(Cabin, 1, 1), 'U') AS cabin,
           coalesce(Embarked, 'S') AS embarked FROM filled"""


@query(
    f"""WITH {TITLED_SQL},
    filled AS (SELECT *, coalesce(Age, {TITLE_AGE_SQL}) AS a, coalesce(Fare, mean_fare) AS f FROM titled)
    {BANDED_SQL}"""
)
def feature_record_banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The banded record of every row."""
    means = fit_means(_train(spark, sf_dir, "Age", "Fare"), "Age", "Fare")
    return banded_record(base(spark, sf_dir), means)


@query(
    f"""WITH {TITLED_SQL},
    filled AS (SELECT *, coalesce(nullif(Age, 0.0), {TITLE_AGE_SQL}) AS a, coalesce(Fare, mean_fare) AS f FROM titled)
    {BANDED_SQL}"""
)
def feature_record_zero_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The banded record of every row, age 0 taken as unknown."""
    means = fit_means(_train(spark, sf_dir, "Fare"), "Fare")
    return banded_record(base(spark, sf_dir), means, zero_is_null=True)


@query(
    f"""WITH {TITLED_SQL},
    medians AS (SELECT title, median(Age) AS m FROM titled, cut WHERE PassengerId < cutoff GROUP BY title),
    filled AS (SELECT *, coalesce(Age, m) AS a, coalesce(Fare, mean_fare) AS f FROM titled LEFT JOIN medians USING (title))
    {BANDED_SQL}"""
)
def feature_record_median_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The banded record of every row, unknown ages from the title's median in the training rows."""
    train = _train(spark, sf_dir, "Name", "Age", "Fare")
    return banded_record(base(spark, sf_dir), fit_means(train, "Fare"), ages=title_medians(train))


@query(
    f"""WITH {BASE_SQL}, {MEANS_SQL}
    SELECT PassengerId AS passenger_id, Survived::DOUBLE AS label, Pclass::DOUBLE AS x0,
           CASE WHEN Sex = 'male' THEN 1.0::DOUBLE ELSE 0.0 END AS x1,
           round(coalesce(Age, mean_age), 6) AS x2, SibSp::DOUBLE AS x3, Parch::DOUBLE AS x4,
           coalesce(Fare, 0.0) AS x5 FROM base, means"""
)
def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and a dense vector of six numbers, shown as columns."""
    rows = base(spark, sf_dir).withColumn("Fare", F.coalesce("Fare", F.lit(0.0)))
    points = labelled_points(rows, fit_means(_train(spark, sf_dir, "Age"), "Age"))
    unpacked = points.withColumn("x", vector_to_array("features"))
    return unpacked.select("passenger_id", "label", *vector_slots(F.col("x"), 6, "x")).withColumn(
        "x2", F.round("x2", 6)
    )


@query("SELECT round(avg(l_extendedprice), 4) AS l_extendedprice, round(avg(l_quantity), 4) AS l_quantity FROM lineitem")
def agg_global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages over the whole table."""
    averages = global_avg(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity")
    return averages.select(*[F.round(c, 4).alias(c) for c in averages.columns])


@query("SELECT median(l_extendedprice) AS median_price FROM lineitem")
def agg_global_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median over the whole table."""
    return exact_median(table(spark, sf_dir, "lineitem"), "l_extendedprice", out="median_price")


@query(
    """SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median_price
       FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def agg_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median per group."""
    rows = table(spark, sf_dir, "lineitem")
    return exact_median(rows, "l_extendedprice", ["l_returnflag", "l_linestatus"], out="median_price")


@query("SELECT l_partkey, median(l_extendedprice) AS median_price FROM lineitem GROUP BY l_partkey")
def agg_group_median_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median per group, with a number of groups that grows with the data."""
    rows = table(spark, sf_dir, "lineitem")
    return exact_median(rows, "l_extendedprice", ["l_partkey"], out="median_price")


@query()
def agg_approx_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched median per group."""
    rows = table(spark, sf_dir, "lineitem")
    return approx_median(rows, "l_extendedprice", ["l_returnflag"], "median_price")


@query(
    """SELECT l_returnflag, count(*) AS rows_n, true AS within_bound FROM lineitem GROUP BY l_returnflag"""
)
def agg_approx_median_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketched medians against the exact ranks: at most rows / accuracy away from the middle."""
    rows, accuracy = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice"), 10_000
    sketched = approx_median(rows, "l_extendedprice", ["l_returnflag"], "sketched", accuracy)
    compared = attach(rows, sketched, ["l_returnflag"])
    ranks = compared.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows_n"),
        F.count_if(F.col("l_extendedprice") < F.col("sketched")).alias("below"),
        F.count_if(F.col("l_extendedprice") <= F.col("sketched")).alias("up_to"),
    )
    slack = F.ceil(F.col("rows_n") / accuracy)
    middle = F.ceil(F.col("rows_n") / 2)
    within = (F.col("below") < middle + slack) & (F.col("up_to") >= middle - slack)
    return ranks.select("l_returnflag", "rows_n", within.alias("within_bound"))


@query("SELECT l_returnflag, median(l_quantity) AS median_quantity FROM lineitem GROUP BY l_returnflag")
def sql_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in exact percentile by name in SQL, over the tallied values near the middle.

    It keeps a value -> count table per group, which the tally keeps small for any input.
    """
    view = register_view(middle_tally(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"]), "ff_middle")
    return spark.sql(
        f"SELECT l_returnflag, percentile(l_quantity, 0.5, n) AS median_quantity FROM {view} GROUP BY l_returnflag"
    )


@query("SELECT l_returnflag, median(l_quantity) AS median_quantity FROM lineitem GROUP BY l_returnflag")
def udaf_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered aggregate by name in SQL, at every size: over the tallied values near the middle."""
    name = register_middle(spark)
    view = register_view(middle_tally(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"]), "ff_tallies")
    return spark.sql(
        f"SELECT l_returnflag, {name}(l_quantity, n) AS median_quantity FROM {view} GROUP BY l_returnflag"
    )


@query(
    """SELECT l_returnflag, count(*) AS rows_n, count(DISTINCT l_linenumber) AS parts, true AS within_bound, true AS same_size
       FROM lineitem GROUP BY l_returnflag"""
)
def agg_merged_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of sketches that were stored part by part and merged later, against the exact ranks."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", "l_extendedprice")
    path = scratch_path(spark, "sketches")
    numbers = [r[0] for r in rows.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]  # seven at most
    for number in numbers:
        store_part(rows.where(F.col("l_linenumber") == number), path, str(number), "l_extendedprice", ["l_returnflag"])
    parts = stored(spark, path)
    counts = parts.groupBy("l_returnflag").agg(F.count("part").alias("parts"))
    medians = merged(parts, ["l_returnflag"]).select("l_returnflag", quantile().alias("sketched"), "n").join(counts, "l_returnflag")
    compared = attach(rows, medians, ["l_returnflag"])
    ranks = compared.groupBy("l_returnflag", "parts").agg(
        F.count(F.lit(1)).alias("rows_n"),
        F.count_if(F.col("l_extendedprice") < F.col("sketched")).alias("below"),
        F.count_if(F.col("l_extendedprice") <= F.col("sketched")).alias("up_to"),
        F.max("n").alias("n"),
    )
    slack = F.col("rows_n") * rank_bound() + 1
    within = (F.col("below") <= F.col("rows_n") / 2 + slack) & (F.col("up_to") >= F.col("rows_n") / 2 - slack)
    return ranks.select("l_returnflag", "rows_n", "parts", within.alias("within_bound"), (F.col("n") == F.col("rows_n")).alias("same_size"))


@query(f"WITH {BASE_SQL} SELECT PassengerId, {TITLE_SQL} AS title, {AGE_BAND_SQL.format(x='Age')} AS age_band FROM base")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title group and age band by name in SQL."""
    register_sql(spark)
    view = register_view(base(spark, sf_dir, "PassengerId", "Name", "Age"), "ff_passengers")
    return spark.sql(f"SELECT PassengerId, title_group(Name) AS title, age_band(Age) AS age_band FROM {view}")


@query("SELECT l_returnflag, median(l_quantity) AS median_quantity FROM lineitem GROUP BY l_returnflag")
def sql_function_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median by name in SQL, without Python: over the tallied values near the middle."""
    register_sql(spark)
    view = register_view(middle_tally(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_returnflag"]), "ff_tallied")
    return spark.sql(
        f"""SELECT l_returnflag, middle(collect_list(named_struct('value', CAST(l_quantity AS DOUBLE), 'count', n))) AS median_quantity
        FROM {view} GROUP BY l_returnflag"""
    )


def _hits_sql() -> str:
    keywords = [(i, t, k) for i, (t, words) in enumerate(TITLE_RULES) for k in words]
    values = ", ".join(f"({i}, '{t}', '{k}')" for i, t, k in keywords)
    return f"""WITH {BASE_SQL}, rules(place, title, keyword) AS (VALUES {values})
    SELECT place, title, keyword, count(*) AS hits FROM rules JOIN base ON contains(Name, keyword) GROUP BY ALL"""


@query(_hits_sql())
def sql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules by name in SQL, as a table function: how many names hold each keyword."""
    register_sql(spark)
    view = register_view(base(spark, sf_dir, "PassengerId", "Name"), "ff_names")
    # One row per keyword, a fixed list, goes to every part of the rows.
    return spark.sql(
        f"""SELECT /*+ BROADCAST(rules) */ place, title, keyword, count(*) AS hits
        FROM {view} JOIN title_keywords() AS rules ON contains(Name, keyword) GROUP BY place, title, keyword"""
    )
