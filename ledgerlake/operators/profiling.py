"""Table profiling: column statistics, duplicate keys, value distributions.

Column statistics come from one aggregate over all columns, unpivoted to one
row per column. Distribution shares divide by a scalar subquery of the table
count, which Spark runs once and inlines; no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, NumericType

# Sample width and the labels of the fraud flag.
SAMPLE_CHARS = 20
EXACT = "decimal(38,4)"
FRAUD_LABELS, FRAUD_OTHER = {1: "FRAUD"}, "NORMAL"


def _statistics(df: DataFrame, c: str) -> tuple[Column, ...]:
    """(nulls, min, max, min_exact, max_exact, mean, least text) of one column, as aggregates.

    Whole numbers and decimals keep their exact least and greatest value beside the double,
    and their mean comes from an exact sum. Doubles that no decimal holds are summed as
    doubles, so no value leaves the mean.
    """
    col, kind = F.col(f"`{c}`"), df.schema[c].dataType
    none, exact_null = F.lit(None).cast("double"), F.lit(None).cast(EXACT)
    nulls = F.count_if(col.isNull())
    if not isinstance(kind, NumericType):
        return (nulls, none, none, exact_null, exact_null, none, F.min(col.cast("string")))
    low, high = F.min(col), F.max(col)
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        held = col.try_cast("decimal(38,10)")
        rest = F.sum(F.when(col.isNotNull() & held.isNull(), col.cast("double")))
        total = F.coalesce(rest + F.coalesce(F.sum(held).cast("double"), F.lit(0.0)),
                           F.sum(held).cast("double"))
        exact = (exact_null, exact_null)
    else:
        total = F.sum(col.cast("decimal(38,10)")).cast("double")
        exact = (low.cast(EXACT), high.cast(EXACT))
    return (nulls, low.cast("double"), high.cast("double"), *exact,
            F.try_divide(total, F.count(col)), F.lit(None).cast("string"))


def profile_columns(df: DataFrame, table_name: str) -> DataFrame:
    """Per column: null %, distinct count (nulls skipped); numeric columns
    also min/max/mean (2 places; whole numbers min_exact/max_exact too);
    others a 20-character sample (the least value, so the report is stable).

    One plain aggregate over native types gives all but the distinct counts:
    a row per task is shuffled. Those come from narrow (column, value) pairs,
    collapsed map-side (a value held by a third of the rows costs one row per
    task), instead of a multi-distinct Expand, which would shuffle every row
    once per column with all aggregate inputs attached.
    """
    cols = df.columns
    pairs, entries, aggs = [], [], []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        if df.schema[c].dataType.typeName() in ("double", "float"):
            col = F.when(col == 0, F.lit(0.0)).otherwise(col)  # -0.0 and 0.0 are one value
        pairs.append(F.struct(F.lit(i).alias("i"), col.cast("string").alias("k")))
        names = ("nulls", "min", "max", "min_exact", "max_exact", "mean", "least")
        aggs += [x.alias(f"{n}{i}") for n, x in zip(names, _statistics(df, c))]
        entries.append(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"),
                                F.col("rows").alias("rows"),
                                *[F.col(f"{n}{i}").alias(n) for n in names]))
    stats = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).select(F.inline(F.array(*entries)))
    distinct = (df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
                .filter(F.col("k").isNotNull()).distinct()
                .groupBy(F.col("i").alias("di")).agg(F.count(F.lit(1)).alias("n_distinct")))
    return stats.join(distinct, F.col("i") == F.col("di"), "left").select(
        F.lit(table_name).alias("table_name"), "column_name",
        F.round(F.try_divide(F.col("nulls"), F.col("rows")) * 100, 1).alias("null_pct"),
        F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"),
        "min", "max", "min_exact", "max_exact", F.round("mean", 2).alias("mean"),
        F.substring("least", 1, SAMPLE_CHARS).alias("sample"))


def profile_duplicates(df: DataFrame, table_name: str, key: str) -> DataFrame:
    """Rows whose key repeats an earlier row (null counts as one value)."""
    k = F.col(key)
    distinct_keys = F.countDistinct(k) + F.when(F.count_if(k.isNull()) > 0, 1).otherwise(0)
    return df.agg((F.count(F.lit(1)) - distinct_keys).alias("duplicates")).select(
        F.lit(table_name).alias("table_name"), F.lit(key).alias("key_column"), "duplicates")


def profile_distribution(spark: SparkSession, df: DataFrame, table_name: str,
                         column: str, labels: dict | None = None,
                         other: str | None = None) -> DataFrame:
    """Value counts (nulls left out) with their share of ALL rows, 1 place.

    With ``labels`` a value is shown by its label, one without by ``other``.
    """
    value = F.col(column)
    if labels:
        expr = None
        for k, v in labels.items():
            expr = F.when(value == k, v) if expr is None else expr.when(value == k, v)
        value = expr.otherwise(F.lit(other))
    counts = (df.filter(F.col(column).isNotNull())
              .groupBy(value.cast("string").alias("value"))
              .agg(F.count(F.lit(1)).alias("count")))
    shares = spark.sql(
        "SELECT value, count, ROUND(count / (SELECT COUNT(*) FROM {src}) * 100, 1) AS pct "
        "FROM {counts}", src=df, counts=counts)
    return shares.select(F.lit(table_name).alias("table_name"),
                         F.lit(column).alias("column_name"), "value", "count", "pct")


def profile_layer_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table plus an overall row (table_name = 'TOTAL')."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    per_table = parts[0]
    for p in parts[1:]:
        per_table = per_table.unionByName(p)
    return per_table.rollup("table_name").agg(F.sum("rows").alias("rows")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "rows")
