"""The dashboard: one row per policy with the number of its named coverages, and the reads on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.functions.joins import lookup_join
from docloom.sources.tables import run_query

KEYS = ["file_name", "file_path"]
COLUMNS = [
    *KEYS, "policy_number", "carrier", "named_insured", "effective_date", "expiration_date",
    "policy_type", "claims_made_or_occurrence", "policy_confidence",
]
DETAIL_COLUMNS = [
    "file_name", "coverage_name", "coverage_section", "limit_amount", "aggregate_limit",
    "deductible_or_retention", "is_sublimit", "coverage_confidence", "coverage_page_reference",
]


def dashboard(policy_table: DataFrame, coverage_table: DataFrame) -> DataFrame:
    """Left join on name and path, then count per policy, without joining coverage rows one by one.

    Coverages are counted per key and equal policy rows are counted per group first, both combined
    before the shuffle, so a file holding a large share of either table reaches the join as one row. A
    group of ``copies`` equal policy rows meets the ``named`` coverages of its key that many times, hence
    the product. Null keys match nothing and give zero.
    """
    copies = policy_table.groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    named = coverage_table.groupBy(*KEYS).agg(F.count("coverage_name").alias("named"))
    joined = lookup_join(copies, named, KEYS, "left")
    return joined.select(*COLUMNS, (F.col("copies") * F.coalesce("named", F.lit(0))).alias("coverage_count"))


def dashboard_joined(policy_table: DataFrame, coverage_table: DataFrame) -> DataFrame:
    """The same result in the plain form, joining every coverage row; kept to check the other one."""
    joined = policy_table.select(*COLUMNS).join(coverage_table.select(*KEYS, "coverage_name"), KEYS, "left")
    return joined.groupBy(*COLUMNS).agg(F.count("coverage_name").alias("coverage_count"))


def dashboard_from_output(parsed: DataFrame) -> DataFrame:
    """The dashboard straight from parsed model output, without a coverage table.

    Each document counts its own coverages inside the row. The counts are then summed per key, the equal
    policies per group, and only these sums are joined. Both sides read the output, one its policies and
    one its coverages, so it should be a saved table.
    """
    named = F.size(
        F.filter(F.coalesce("extracted.coverages", F.array()), lambda c: c["coverage_name"].isNotNull())
    )
    policy = [
        F.col(f"extracted.policy.{'confidence' if name == 'policy_confidence' else name}").alias(name)
        for name in COLUMNS[2:]
    ]
    copies = parsed.select(*KEYS, *policy).groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    totals = parsed.select(*KEYS, named.alias("named")).groupBy(*KEYS).agg(F.sum("named").alias("total"))
    joined = lookup_join(copies, totals, KEYS, "left")
    return joined.select(*COLUMNS, (F.col("copies") * F.coalesce("total", F.lit(0))).alias("coverage_count"))


def create_dashboard_view(spark: SparkSession, view: str, policy_table: str, coverage_table: str) -> DataFrame:
    """Create or replace the persistent view over saved tables, in the pre-counted form of ``dashboard``."""
    columns = ", ".join(COLUMNS)
    spark.sql(
        f"""
        CREATE OR REPLACE VIEW {view} AS
        WITH copies AS (SELECT {columns}, COUNT(*) AS copies FROM {policy_table} GROUP BY {columns}),
             named AS (SELECT file_name, file_path, COUNT(coverage_name) AS named
                       FROM {coverage_table} GROUP BY file_name, file_path),
             marked_copies AS (SELECT *, xxhash64(file_name, file_path) AS key_hash FROM copies),
             marked_named AS (SELECT *, xxhash64(file_name, file_path) AS key_hash FROM named)
        SELECT {columns}, copies * COALESCE(named, 0) AS coverage_count
        FROM marked_copies LEFT JOIN marked_named USING (key_hash, file_name, file_path)
        """
    )
    return spark.table(view)


def dashboard_rows(view: DataFrame) -> DataFrame:
    """Rows by file name. The path and policy number follow so that equal names can share the sort."""
    return view.orderBy("file_name", "file_path", "policy_number")


def file_options(view: DataFrame) -> DataFrame:
    """File names to choose from: sorted, without nulls, one per dashboard row."""
    return view.filter(F.col("file_name").isNotNull()).select("file_name", "file_path").orderBy("file_name", "file_path").select("file_name")


def rows_for_file(view: DataFrame, file_name: str) -> DataFrame:
    return view.filter(F.col("file_name") == F.lit(file_name))


def coverage_detail(coverage_table: DataFrame, file_name: str) -> DataFrame:
    """Coverages of every file with this name, under whatever path, by coverage name."""
    return rows_for_file(coverage_table, file_name).select(*DETAIL_COLUMNS).orderBy("coverage_name")


def coverage_detail_query(spark: SparkSession, coverage_table: str, file_name: str) -> DataFrame:
    """The same read on a saved table, with the name as a query parameter."""
    columns = ", ".join(DETAIL_COLUMNS)
    return run_query(
        spark,
        f"SELECT {columns} FROM {coverage_table} WHERE file_name = :file_name ORDER BY coverage_name",
        file_name=file_name,
    )


def require_policies(view: DataFrame, name: str) -> DataFrame:
    """Stop on an empty dashboard."""
    if view.isEmpty():
        raise ValueError(f"No policy data found in {name}.")
    return view
