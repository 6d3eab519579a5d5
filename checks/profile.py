"""Profiling of whole tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from freightloom.operators import profile
from freightloom.operators.dedup import duplicate_groups
from freightloom.operators.order_statistics import column_edges, column_extents, values_at_ranks
from freightloom.sources import write_data_dictionary
from freightloom.session import scratch_dir

from .fixture import line_items, table
from .registry import query
from .sql import money_units, rounded_ratio, rounded_ratio_even


def gappy_orders(spark, sf_dir):
    """Orders with values missing by rule, as the test tables have none missing."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority",
    )


GAPPY = """(SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS o_custkey,
    NULLIF(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS o_orderdate, o_orderpriority FROM orders)"""
GAPPY_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
KINDS = {"string": "categorical", "timestamp_ntz": "other"}


def _per_column(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c, **extra) for c, extra in columns)


@query("profile_shape", "SELECT COUNT(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, sf_dir):
    return profile.shape(line_items(spark, sf_dir))


@query(
    "profile_types",
    _per_column(
        "SELECT '{c}' AS \"column\", '{t}' AS data_type, '{k}' AS kind, COUNT({c}) AS non_null, "
        f"COUNT(*) AS total FROM {GAPPY}",
        [
            (c, {"t": t, "k": KINDS.get(t, "numeric")})
            for c, t in GAPPY_COLUMNS.items()
        ],
    ),
)
def types(spark, sf_dir):
    return profile.type_census(gappy_orders(spark, sf_dir))


NUMERIC_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax",
)


@query(
    "profile_numeric",
    _per_column(
        """SELECT '{c}' AS "column", COUNT({c}) AS count,
        {mean} AS mean,
        ROUND(stddev_samp({c}), 2) AS std,
        ROUND(CAST(MIN({c}) AS DOUBLE), 2) AS min,
        ROUND(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 2) AS q25,
        ROUND(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 2) AS median,
        ROUND(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 2) AS q75,
        ROUND(CAST(MAX({c}) AS DOUBLE), 2) AS max,
        ROUND(CAST(MAX({c}) AS DOUBLE) - CAST(MIN({c}) AS DOUBLE), 2) AS range,
        ROUND(CAST(quantile_cont({c}, 0.75) AS DOUBLE) - CAST(quantile_cont({c}, 0.25) AS DOUBLE), 2) AS iqr
        FROM lineitem""",
        [
            (c, {"mean": rounded_ratio(money_units(c), f"COUNT({c}) * 10000")})
            for c in NUMERIC_LINE_COLUMNS
        ],
    ),
)
def numeric(spark, sf_dir):
    return profile.numeric_summary(line_items(spark, sf_dir))


SPREAD = """(SELECT CASE WHEN l_orderkey % 997 = 0 THEN CAST('Infinity' AS DOUBLE)
    ELSE CAST('1e' || (l_partkey % 500 - 250) AS DOUBLE) * l_linenumber END AS v FROM lineitem)"""


@query(
    "profile_quantiles_extreme",
    f"""SELECT 'v' AS "column", CAST(p AS DOUBLE) AS probability, quantile FROM (
    SELECT 0.25 AS p, quantile_disc(v, 0.25) AS quantile FROM {SPREAD}
    UNION ALL SELECT 0.5, quantile_disc(v, 0.5) FROM {SPREAD}
    UNION ALL SELECT 0.999, quantile_disc(v, 0.999) FROM {SPREAD})""",
)
def quantiles_extreme(spark, sf_dir):
    """Values over five hundred magnitudes, some infinite; the lower neighbour of each quantile."""
    spread = F.when(F.col("l_orderkey") % 997 == 0, F.lit(float("inf"))).otherwise(
        F.concat(F.lit("1e"), (F.col("l_partkey") % 500 - 250).cast("string")).cast("double") * F.col("l_linenumber")
    )
    values = line_items(spark, sf_dir).select(spread.alias("v"))
    extents, edges = column_extents(values, ["v"]), column_edges(values, ["v"])
    # Rank of the smallest value that at least the share p of all values does not exceed.
    ranks = {p: max(0, math.ceil(p * extents["v"][0]) - 1) for p in (0.25, 0.5, 0.999)}
    found = values_at_ranks(values, {"v": list(ranks.values())}, extents, edges)
    rows = [("v", p, found["v", rank]) for p, rank in ranks.items()]
    return spark.createDataFrame(rows, "column string, probability double, quantile double")


@query("profile_numeric_without_numbers", """SELECT 'p_size' AS "column", COUNT(p_size) AS count, MIN(p_size)::DOUBLE AS min,
    quantile_cont(p_size, 0.5)::DOUBLE AS median, MAX(p_size)::DOUBLE AS max FROM part""")
def numeric_without_numbers(spark, sf_dir):
    """Text columns have no numeric summary, so the one number among them is all there is."""
    part = table(spark, sf_dir, "part")
    none = profile.numeric_summary(part.select("p_name", "p_brand"), digits=None)
    one = profile.numeric_summary(part.select("p_name", "p_size", "p_brand"), digits=None)
    return none.unionByName(one).select("column", "count", "min", "median", "max")


@query("profile_distinct_without_text", """SELECT 'p_brand' AS "column", COUNT(DISTINCT p_brand) AS distinct_values FROM part""")
def distinct_without_text(spark, sf_dir):
    """Numbers are not counted unless they are asked for, so the one text among them is all there is."""
    part = table(spark, sf_dir, "part")
    none = profile.distinct_counts(part.select("p_partkey", "p_size"))
    return none.unionByName(profile.distinct_counts(part.select("p_partkey", "p_brand", "p_size")))


TEXT_PART_COLUMNS = ("p_name", "p_brand", "p_type")


@query(
    "profile_distinct",
    _per_column(
        "SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS distinct_values FROM part",
        [(c, {}) for c in TEXT_PART_COLUMNS],
    ),
)
def distinct(spark, sf_dir):
    return profile.distinct_counts(table(spark, sf_dir, "part"))


@query(
    "profile_top_values",
    "WITH counted AS ("
    + _per_column(
        "SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY {c}",
        [(c, {}) for c in TEXT_PART_COLUMNS],
    )
    + f""") SELECT "column", position, substr(value, 1, 50) AS value, n,
    {rounded_ratio('n * 100', '(SELECT COUNT(*) FROM part)')} AS percent
    FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS position FROM counted)
    WHERE position <= 10""",
)
def top_values(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"))


MISSING = "WITH missing AS (" + _per_column(
    "SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS missing, COUNT(*) AS total FROM " + GAPPY,
    [(c, {}) for c in GAPPY_COLUMNS],
) + ")"


@query(
    "profile_missing",
    f"""{MISSING} SELECT "column", missing,
    {rounded_ratio_even('missing * 100', 'total')} AS missing_percent FROM missing WHERE missing > 0""",
)
def missing(spark, sf_dir):
    return profile.missing_values(gappy_orders(spark, sf_dir))


@query(
    "profile_missing_total",
    f"""{MISSING} SELECT CAST(SUM(missing) AS BIGINT) AS missing_cells, CAST(SUM(total) AS BIGINT) AS total_cells,
    {rounded_ratio('SUM(missing) * 100', 'SUM(total)', 4)} AS missing_percent FROM missing""",
)
def missing_total(spark, sf_dir):
    return profile.missing_total(gappy_orders(spark, sf_dir))


@query(
    "profile_quality_summary",
    f"""{MISSING} SELECT MAX(total) AS n_rows, CAST(6 AS BIGINT) AS n_columns, CAST(3 AS BIGINT) AS numeric_columns,
    CAST(2 AS BIGINT) AS categorical_columns, CAST(SUM(missing) AS BIGINT) AS missing_cells,
    {rounded_ratio('SUM(missing) * 100', 'SUM(total)', 4)} AS missing_percent,
    {rounded_ratio('SUM(total - missing) * 100', 'SUM(total)')} AS completeness_percent FROM missing""",
)
def quality_summary(spark, sf_dir):
    return profile.quality_summary(gappy_orders(spark, sf_dir))


@query(
    "profile_dictionary",
    _per_column(
        """SELECT '{c}' AS "column", '{t}' AS data_type, COUNT({c}) AS non_null,
        COUNT(*) - COUNT({c}) AS missing, COUNT(DISTINCT {c}) AS distinct_values,
        {lo} AS minimum, {hi} AS maximum FROM """
        + GAPPY,
        [
            (
                c,
                {
                    "t": t,
                    "lo": "'-'" if t in KINDS else f"printf('%.2f', CAST(MIN({c}) AS DOUBLE))",
                    "hi": "'-'" if t in KINDS else f"printf('%.2f', CAST(MAX({c}) AS DOUBLE))",
                },
            )
            for c, t in GAPPY_COLUMNS.items()
        ],
    ),
)
def dictionary(spark, sf_dir):
    """Written as CSV and read back, as a user of the file would."""
    path = scratch_dir(spark, "dictionary")
    found = profile.data_dictionary(gappy_orders(spark, sf_dir))
    write_data_dictionary(found, path)
    return spark.read.schema(found.schema).option("header", True).csv(path)


@query(
    "profile_duplicates",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
    GROUP BY ALL HAVING COUNT(*) > 1""",
)
def duplicates(spark, sf_dir):
    return duplicate_groups(line_items(spark, sf_dir).select("l_orderkey", "l_linenumber"))
