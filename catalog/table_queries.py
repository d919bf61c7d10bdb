"""Preparation, profiling and scaling of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import table
from gleanwork.operators import preparation, profiling, scalers
from gleanwork.plans import sweep
from gleanwork.session import scratch_path
from gleanwork.sources import stores

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def rounded(df: DataFrame, columns, places: int = 8) -> DataFrame:
    return df.select(
        *[F.round(c, places).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


@register("s9_table_csv", "select * from customer")
def table_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer")
    stores.write_table_csv(table(spark, sf_dir, "customer"), path)
    return stores.read_table_csv(spark, path).withColumn(
        "c_custkey", F.col("c_custkey").cast("bigint")
    )


@register("t8_drop_columns", "select * exclude (o_orderdate, o_orderpriority) from orders")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preparation.drop_columns(
        table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderpriority"]
    )


@register(
    "t9_label_codes",
    """select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 0 end as o_orderstatus
       from orders""",
)
def label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return preparation.encode_labels(orders, "o_orderstatus", {"F": 1, "O": 0})


SETS = [
    ["l_quantity", "l_extendedprice", "l_discount"],
    ["l_tax", "l_discount", "l_quantity"],
    ["l_extendedprice", "l_tax", "l_quantity"],
]


@register("t10_feature_subset", "select l_tax, l_discount, l_quantity from lineitem")
def feature_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preparation.feature_subset(lineitem(spark, sf_dir), SETS, 1)


@register("t11_numeric_columns", "select p_partkey, p_size, p_retailprice from part")
def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(*preparation.numeric_columns(part))


@register(
    "t12_features_and_target",
    """select 'features' as side, count(*) as n, sum(p_size)::bigint as total from part
       union all
       select 'target', count(*), sum(length(p_brand))::bigint from part""",
)
def features_and_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, target = preparation.features_and_target(table(spark, sf_dir, "part"), "p_brand")
    rows = F.count(F.lit(1)).alias("n")
    return features.agg(
        F.lit("features").alias("side"), rows, F.sum("p_size").alias("total")
    ).unionAll(
        target.agg(F.lit("target").alias("side"), rows, F.sum(F.length("p_brand")).alias("total"))
    )


@register(
    "a7_table_overview",
    """select c as "column", t as type, (select count(*) from lineitem) as non_null,
              (select count(*) from lineitem) as rows
       from (values ('l_orderkey', 'bigint'), ('l_partkey', 'bigint'), ('l_suppkey', 'bigint'),
                    ('l_linenumber', 'int'), ('l_quantity', 'double'),
                    ('l_extendedprice', 'double'), ('l_discount', 'double'),
                    ('l_tax', 'double'), ('l_returnflag', 'string'), ('l_linestatus', 'string'),
                    ('l_shipdate', 'timestamp_ntz')) v(c, t)""",
)
def table_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.table_overview(lineitem(spark, sf_dir))


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero tax counts as missing, so there is something to fill."""
    return lineitem(spark, sf_dir).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))


COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


@register(
    "a8_missing_counts",
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter ({c} is null) as missing
            from (select * replace (nullif(l_tax, 0.0) as l_tax) from lineitem)"""
        for c in COLUMNS
    ),
)
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.missing_counts(with_gaps(spark, sf_dir))


@register(
    "a9_category_counts",
    "select event_type, user_id, count(*) as n from events group by all",
)
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.category_counts(table(spark, sf_dir, "events"), "event_type", "user_id")


def histogram_sql(bins: str) -> str:
    return f"""
    with s as (select min(value) as low, max(value) as high, count(*)::double as n,
                      quantile_cont(value, 0.75) - quantile_cont(value, 0.25) as iqr from events),
    b as (select low, high, {bins} as bins from s),
    p as (select event_type,
                 least(floor((value - low) / ((high - low) / bins)), bins - 1)::int as bin,
                 low, (high - low) / bins as step
          from events, b)
    select event_type, bin, count(*) as n, round(low + bin * step, 8) as bin_start
    from p group by event_type, bin, low, step"""


@register("a10_histogram", histogram_sql("20"))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = profiling.histogram(table(spark, sf_dir, "events"), "value", "event_type", 20)
    return rounded(made, ["bin_start"])


@register(
    "a10_histogram_auto",
    histogram_sql(
        "ceil((high - low) / least((high - low) / (log2(n) + 1), 2 * iqr / pow(n, 1.0 / 3)))"
    ),
)
def histogram_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = profiling.histogram(table(spark, sf_dir, "events"), "value", "event_type")
    return rounded(made, ["bin_start"])


@register(
    "a11_density",
    """
    with v as (select o_orderstatus, o_totalprice as v from orders),
    c as (select o_orderstatus, count(*) as n,
                 stddev_samp(v) * pow(count(*)::double, -0.2) as h from v group by all),
    s as (select min(v) as low, (max(v) - min(v)) / 49 as step from v),
    g as (select unnest(generate_series(0, 49))::int as point),
    k as (select o_orderstatus, point, low + point * step as x,
                 exp(-pow((low + point * step - v) / h, 2) / 2) / (n * h * sqrt(2 * pi())) as d
          from v join c using (o_orderstatus), s, g)
    select o_orderstatus, point, round(sum(d) * 1000, 8) as density, round(x, 6) as x
    from k group by o_orderstatus, point, x""",
)
def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = profiling.density(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus", 50)
    return made.select(
        "o_orderstatus",
        "point",
        F.round(F.col("density") * 1000, 8).alias("density"),
        F.round("x", 6).alias("x"),
    )


NUMBERS = COLUMNS[:8]


@register(
    "a12_correlations",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 8) as corr from lineitem"
        for a in NUMBERS
        for b in NUMBERS
    ),
)
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.correlations(lineitem(spark, sf_dir), NUMBERS), ["corr"])


@register(
    "a13_fill_means",
    """select * replace (round(coalesce(nullif(l_tax, 0.0), avg(nullif(l_tax, 0.0)) over ()), 8)
                         as l_tax)
       from lineitem""",
)
def fill_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(preparation.fill_means(with_gaps(spark, sf_dir)), ["l_tax"])


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]
KEYS = "l_orderkey, l_linenumber"

SHIFT_AND_DIVISOR = {
    "standard": ("avg({c})", "stddev_pop({c})"),
    "min_max": ("min({c})", "(max({c}) - min({c}))"),
    "robust": (
        "quantile_cont({c}, 0.5)",
        "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))",
    ),
    "max_abs": ("0.0", "max(abs({c}))"),
}


def scaled_sql(scaler: str, source: str = "lineitem", places: int | None = 7) -> str:
    shift, divisor = SHIFT_AND_DIVISOR[scaler]
    stats = ", ".join(
        f"{shift.format(c=c)} as s_{c}, coalesce(nullif({divisor.format(c=c)}, 0), 1) as d_{c}"
        for c in SCALED
    )
    value = "({c} - s_{c}) / d_{c}" if places is None else "round(({c} - s_{c}) / d_{c}, {p})"
    columns = ", ".join(value.format(c=c, p=places) + f" as {c}" for c in SCALED)
    return f"select {KEYS}, {columns} from {source}, (select {stats} from {source})"


def scaled(spark: SparkSession, sf_dir: str, scaler: str) -> DataFrame:
    items = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", *SCALED)
    return rounded(scalers.scale(items, SCALED, scaler), SCALED, 7)


@register("p1_standard_scaler", scaled_sql("standard"))
def standard_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled(spark, sf_dir, "standard")


@register("p2_min_max_scaler", scaled_sql("min_max"))
def min_max_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled(spark, sf_dir, "min_max")


@register("p3_robust_scaler", scaled_sql("robust"))
def robust_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled(spark, sf_dir, "robust")


@register("p4_max_abs_scaler", scaled_sql("max_abs"))
def max_abs_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled(spark, sf_dir, "max_abs")


@register(
    "p5_scalers_by_name",
    " union all ".join(
        f"select '{name}' as scaler, * from ({scaled_sql(name)})" for name in SHIFT_AND_DIVISOR
    ),
)
def scalers_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [
        scaled(spark, sf_dir, name).select(F.lit(name).alias("scaler"), "*")
        for name in scalers.SCALERS
    ]
    union = made[0]
    for other in made[1:]:
        union = union.unionAll(other)
    return union


@register(
    "p6_chained_scalers",
    f"with first as ({scaled_sql('standard', places=None)}) {scaled_sql('min_max', 'first')}",
)
def chained_scalers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", *SCALED)
    return rounded(scalers.scale_chained(items, SCALED, ["standard", "min_max"]), SCALED, 7)


# --- leaderboards -----------------------------------------------------------

# Trials taken from the table: a trial is a supplier, its model the return
# flag, its score the mean discount.
TRIALS = """
trials as (select l_returnflag as model, l_suppkey as trial_no,
                  round(avg(l_discount), 4) as score
           from lineitem group by all)
"""


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).groupBy(
        F.col("l_returnflag").alias("model"), F.col("l_suppkey").alias("trial_no")
    ).agg(F.round(F.avg("l_discount"), 4).alias("score"))


@register(
    "w11_best_per_model",
    f"""with {TRIALS} select * from (
          select *, row_number() over (partition by model order by score desc, trial_no) as place
          from trials) where place <= 10""",
)
def best_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.best_per_model(trials(spark, sf_dir))


@register(
    "w12_best_trial",
    f"with {TRIALS} select * from trials order by score desc, trial_no, model limit 1",
)
def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.best_trial(trials(spark, sf_dir), ["model"])
