"""Labelling scores, silhouettes, neighbour curves and clusterings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import table
from gleanwork.operators import centroids, cluster_metrics, neighbours, scalers, silhouette
from gleanwork.operators.dbscan import dbscan
from gleanwork.operators.mean_shift import mean_shift
from gleanwork.plans import sweep
from gleanwork.session import settle

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


SETS = [["f1", "f2", "f3"], ["f4", "f5", "f6"], ["f7", "f8", "f9"]]
FEATURES = [c for s in SETS for c in s]

# The rule-based cluster is the position of the largest of three components.
VECTORS = f"""
vectors as (select vec_id, label,
                   {', '.join(f'embedding[{i + 1}]::double as {c}' for i, c in enumerate(FEATURES))},
                   case when embedding[1] >= embedding[2] and embedding[1] >= embedding[3] then 0
                        when embedding[2] >= embedding[3] then 1 else 2 end as cluster
            from embeddings)
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i))
    rule = (
        F.when((at(0) >= at(1)) & (at(0) >= at(2)), 0).when(at(1) >= at(2), 1).otherwise(2)
    )
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        *[at(i).cast("double").alias(c) for i, c in enumerate(FEATURES)],
        rule.alias("cluster"),
    )


def plain_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).drop("cluster")


# --- counts and scores of a labelling ---------------------------------------


@register(
    "a14_group_sizes",
    f"""with {VECTORS}
        select 'cluster' as kind, cluster as value, count(*) as n from vectors group by all
        union all select 'class', label, count(*) from vectors group by all""",
)
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vectors(spark, sf_dir)
    parts = [
        cluster_metrics.group_sizes(points, column).select(
            F.lit(kind).alias("kind"), F.col(column).alias("value"), "n"
        )
        for kind, column in (("cluster", "cluster"), ("class", "label"))
    ]
    return parts[0].unionAll(parts[1])


@register(
    "a15_contingency",
    f"with {VECTORS} select label, cluster, count(*) as n from vectors group by all",
)
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_metrics.contingency(vectors(spark, sf_dir), "label", "cluster")


@register(
    "a16_purity",
    f"""with {VECTORS}, c as (select label, cluster, count(*) as n from vectors group by all),
        m as (select cluster, max(n) as largest, sum(n) as n from c group by cluster)
        select round(sum(largest) / sum(n), 10) as purity from m""",
)
def purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cluster_metrics.purity(vectors(spark, sf_dir), "label", "cluster")
    return made.select(F.round("purity", 10).alias("purity"))


@register(
    "a17_accuracy",
    f"with {VECTORS} select round(avg((label = cluster)::int), 10) as accuracy from vectors",
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cluster_metrics.accuracy(vectors(spark, sf_dir), "label", "cluster")
    return made.select(F.round("accuracy", 10).alias("accuracy"))


@register(
    "a18_cluster_count",
    f"""with {VECTORS} select count(distinct cluster - 1) filter (cluster - 1 <> -1) as clusters
        from vectors""",
)
def cluster_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = vectors(spark, sf_dir).withColumn("cluster", F.col("cluster") - 1)
    return cluster_metrics.cluster_count(shifted, "cluster")


# --- silhouettes ------------------------------------------------------------

AWAY = "sqrt(pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2) + pow(a.f3 - b.f3, 2))"

SILHOUETTES = f"""
sums as (select a.vec_id, a.cluster as own, b.cluster as other, sum({AWAY}) as total,
                count(*) as n
         from vectors a, vectors b group by all),
parts as (select vec_id, own,
                 max(case when own = other then total / nullif(n - 1, 0) end) as a,
                 min(case when own <> other then total / n end) as b,
                 max(case when own = other then n end) as n
          from sums group by all),
sil as (select vec_id, own as cluster,
               case when n = 1 then 0.0 else (b - a) / greatest(a, b) end as silhouette
        from parts)
"""


@register(
    "k5_mean_silhouette",
    f"with {VECTORS}, {SILHOUETTES} select round(avg(silhouette), 9) as silhouette from sil",
)
def mean_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = silhouette.mean_silhouette(vectors(spark, sf_dir), "vec_id", SETS[0], "cluster")
    return made.select(F.round("silhouette", 9).alias("silhouette"))


@register(
    "k6_silhouette_rows",
    f"""with {VECTORS}, {SILHOUETTES}
        select vec_id, cluster, round(silhouette, 8) as silhouette from sil""",
)
def silhouette_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = silhouette.silhouette_rows(vectors(spark, sf_dir), "vec_id", SETS[0], "cluster")
    return made.withColumn("silhouette", F.round("silhouette", 8))


@register(
    "k7_silhouette_profile",
    f"""with {VECTORS}, {SILHOUETTES}
        select vec_id, cluster, round(silhouette, 8) as silhouette,
               row_number() over (partition by cluster order by silhouette, vec_id) as place,
               count(*) over (partition by cluster) as cluster_size,
               round(avg(silhouette) over (), 8) as mean_silhouette
        from sil""",
)
def silhouette_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = silhouette.silhouette_profile(vectors(spark, sf_dir), "vec_id", SETS[0], "cluster")
    return made.withColumn("silhouette", F.round("silhouette", 8)).withColumn(
        "mean_silhouette", F.round("mean_silhouette", 8)
    )


# --- neighbour distances ----------------------------------------------------

CURVE = f"""
near as (select a.vec_id, {AWAY} as distance,
                row_number() over (partition by a.vec_id order by {AWAY}) as place
         from vectors a, vectors b),
curve as (select round(distance, 9) as distance, count(*) as rows,
                 sum(count(*)) over (order by round(distance, 9))::bigint as upto
          from near where place = 11 group by round(distance, 9))
"""


@register("k8_distance_curve", f"with {VECTORS}, {CURVE} select * from curve")
def distance_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.distance_curve(vectors(spark, sf_dir), SETS[0], 10)


@register(
    "k9_knee",
    f"""with {VECTORS}, {CURVE},
        ends as (select min(distance) as low, max(distance) as high, max(upto) as n from curve),
        chord as (select upto - 1 as position, distance,
                         round((upto - 1) / (n - 1) - (distance - low) / (high - low), 12) as below
                  from curve, ends)
        select position, distance from chord order by below desc, position limit 1""",
)
def knee(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = neighbours.distance_curve(vectors(spark, sf_dir), SETS[0], 10)
    return neighbours.knee(settle(curve))


# Few distinct points, many rows: the work runs on the distinct ones.
LINES = ["l_quantity", "l_discount", "l_tax"]


@register(
    "k8_distance_curve_of_lines",
    """
    with p as (select l_quantity as x, l_discount as y, l_tax as z, count(*) as w
               from lineitem group by all),
    near as (select a.x, a.y, a.z, a.w,
                    sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) as distance,
                    b.w as other
             from p a, p b),
    steps as (select x, y, z, w, distance, sum(other) as others from near group by all),
    sums as (select x, y, z, w, distance,
                    sum(others) over (partition by x, y, z order by distance) as seen
             from steps),
    reached as (select x, y, z, w, min(distance) as distance from sums where seen >= 11
                group by all)
    select round(distance, 9) as distance, sum(w)::bigint as rows,
           sum(sum(w)) over (order by round(distance, 9))::bigint as upto
    from reached group by round(distance, 9)""",
)
def distance_curve_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.distance_curve(table(spark, sf_dir, "lineitem"), LINES, 10)


# --- clusterings ------------------------------------------------------------

EPS, MIN_SAMPLES = 0.075, 6

DENSE = f"""
near as (select a.vec_id as a, b.vec_id as b from vectors a, vectors b
         where pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2) + pow(a.f3 - b.f3, 2)
               <= {EPS * EPS!r}::double),
core as (select a from near group by a having count(*) >= {MIN_SAMPLES}),
links as (select near.a, near.b from near join core using (a)
          where near.b in (select a from core)),
reach(node, label) as (
    select a, a from core
    union
    select links.b, reach.label from reach join links on links.a = reach.node
    where links.b > reach.label),
cores as (select node, min(label) as label from reach group by node)
"""


@register(
    "k3_dbscan",
    f"""with recursive {VECTORS}, {DENSE},
        borders as (select near.a as node, min(cores.label) as label
                    from near join cores on cores.node = near.b group by near.a),
        seeded as (select vec_id, coalesce(cores.label, borders.label) as seed
                   from vectors left join cores on cores.node = vec_id
                   left join borders on borders.node = vec_id)
        select vec_id, seed,
               case when seed is null then -1
                    else dense_rank() over (order by seed nulls last) - 1 end as cluster
        from seeded""",
)
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = dbscan(plain_vectors(spark, sf_dir), "vec_id", SETS[0], EPS, MIN_SAMPLES, "seed")
    return made.select("vec_id", "seed", "cluster")


@register("k1_kmeans")
def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = centroids.kmeans(plain_vectors(spark, sf_dir), "vec_id", SETS[0], 3, 3)
    return made.select("vec_id", "cluster")


@register("k2_gaussian_mixture")
def gaussian_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = plain_vectors(spark, sf_dir)
    made = [
        centroids.gaussian_mixture(points, "vec_id", SETS[0], 3, covariance).select(
            F.lit(covariance).alias("covariance"), "vec_id", "cluster"
        )
        for covariance in centroids.COVARIANCES
    ]
    union = made[0]
    for other in made[1:]:
        union = union.unionAll(other)
    return union


@register("k4_mean_shift")
def shifted_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scalers.scale(plain_vectors(spark, sf_dir), SETS[0], "standard")
    made = mean_shift(settle(scaled), "vec_id", SETS[0], 1.0, cluster_all=False)
    return made.select("vec_id", "cluster")


SCALED = ", ".join(
    f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 8) as {c}" for c in SETS[0]
)


@register(
    "k14_labelled_points", f"with {VECTORS} select cluster, label, {SCALED} from vectors"
)
def labelled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scalers.scale(vectors(spark, sf_dir), SETS[0], "standard")
    rounded = scaled.select(
        "cluster", "label", *[F.round(c, 8).alias(c) for c in SETS[0]]
    )
    return cluster_metrics.labelled_points(rounded, SETS[0], "cluster", "label")


# --- search over parameters -------------------------------------------------

SMALL_GRIDS = {
    "kmeans": {"n_clusters": [3, 7, 2], "n_init": [2], "algorithm": ["auto", "elkan"]},
    "dbscan": {"eps": [0.4, 0.6], "min_samples": [8]},
}


@register("k11_candidate_scores")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = settle(scalers.scale(plain_vectors(spark, sf_dir), SETS[0], "standard"))
    found = [
        (model, params, score)
        for model, grid in SMALL_GRIDS.items()
        for params, score in sweep.cluster_search(
            model, sweep.candidates(grid), scaled, "vec_id", SETS[0]
        )
    ]
    return sweep.search_table(spark, found)


@register("k12_clustering_sweep")
def clustering_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids = {"kmeans": {"n_clusters": [3, 5, 1], "n_init": [1], "algorithm": ["auto"]}}
    trials = sweep.clustering_sweep(
        plain_vectors(spark, sf_dir), "vec_id", SETS, ["standard", "robust"], grids
    )
    return sweep.best_per_model(trials)


def refitted(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return sweep.refit(
        plain_vectors(spark, sf_dir),
        "vec_id",
        "label",
        SETS,
        "standard",
        "kmeans",
        {"n_clusters": 3, "n_init": 2},
    )


@register("k13_refit_purity")
def refit_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.refit_report(refitted(spark, sf_dir), "label")


@register("k13_refit_sizes")
def refit_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.refit_sizes(refitted(spark, sf_dir), "label")


@register("u1_custom_scorer")
def custom_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = settle(scalers.scale(plain_vectors(spark, sf_dir), SETS[0], "min_max"))
    by_purity = lambda df: cluster_metrics.purity(df, "label", "cluster").first()["purity"]
    found = sweep.cluster_search(
        "kmeans",
        sweep.candidates({"n_clusters": [3, 9, 2], "n_init": [1]}),
        scaled,
        "vec_id",
        SETS[0],
        by_purity,
    )
    return sweep.search_table(spark, [("kmeans", p, s) for p, s in found])


# --- the same searches with a model that SQL can follow -----------------------

DENSITY_GRID = {"eps": [0.07, 0.075], "min_samples": [6]}

LABELLED = f"""
settings as (select unnest([0.07, 0.075]::double[]) as eps),
near as (select eps, a.vec_id as a, b.vec_id as b from vectors a, vectors b, settings
         where pow(a.f1 - b.f1, 2) + pow(a.f2 - b.f2, 2) + pow(a.f3 - b.f3, 2) <= eps * eps),
core as (select eps, a from near group by all having count(*) >= 6),
links as (select near.eps, near.a, near.b from near join core c on c.eps = near.eps and c.a = near.a
          join core o on o.eps = near.eps and o.a = near.b),
reach(eps, node, label) as (
    select eps, a, a from core
    union
    select links.eps, links.b, reach.label from reach join links
    on links.eps = reach.eps and links.a = reach.node where links.b > reach.label),
cores as (select eps, node, min(label) as label from reach group by all),
borders as (select near.eps, near.a as node, min(cores.label) as label
            from near join cores on cores.eps = near.eps and cores.node = near.b group by all),
labelled as (select s.eps, v.vec_id, v.label, v.f1, v.f2, v.f3,
                    coalesce(cores.label, borders.label, -1) as cluster
             from vectors v cross join settings s
             left join cores on cores.eps = s.eps and cores.node = v.vec_id
             left join borders on borders.eps = s.eps and borders.node = v.vec_id)
"""


def density_search(spark: SparkSession, sf_dir: str, scorer=None) -> DataFrame:
    points = settle(plain_vectors(spark, sf_dir))
    found = sweep.cluster_search(
        "dbscan", sweep.candidates(DENSITY_GRID), points, "vec_id", SETS[0], scorer
    )
    return sweep.search_table(spark, [("dbscan", p, s) for p, s in found]).select(
        "candidate",
        "model",
        F.col("params")["eps"].cast("double").alias("eps"),
        F.round("score", 9).alias("score"),
    )


@register(
    "k11_density_scores",
    f"""with recursive {VECTORS}, {LABELLED},
        sums as (select a.eps, a.vec_id, a.cluster as own, b.cluster as other,
                        sum({AWAY}) as total, count(*) as n
                 from labelled a join labelled b on a.eps = b.eps group by all),
        parts as (select eps, vec_id, own,
                         max(case when own = other then total / nullif(n - 1, 0) end) as a,
                         min(case when own <> other then total / n end) as b,
                         max(case when own = other then n end) as n
                  from sums group by all)
        select row_number() over (order by eps)::int as candidate, 'dbscan' as model, eps,
               round(avg(case when b is null then null when n = 1 then 0.0
                              else (b - a) / greatest(a, b) end), 9) as score
        from parts group by eps""",
)
def density_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density_search(spark, sf_dir)


@register(
    "u1_density_purity",
    f"""with recursive {VECTORS}, {LABELLED},
        c as (select eps, cluster, label, count(*) as n from labelled group by all),
        m as (select eps, cluster, max(n) as largest, sum(n) as n from c group by eps, cluster)
        select row_number() over (order by eps)::int as candidate, 'dbscan' as model, eps,
               round(sum(largest) / sum(n), 9) as score
        from m group by eps""",
)
def density_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_purity = lambda df: cluster_metrics.purity(df, "label", "cluster").first()["purity"]
    return density_search(spark, sf_dir, by_purity)


# --- a whole study, its winner and the refit of it ----------------------------

STUDY_GRID = {"dbscan": {"eps": [0.08, 0.4], "min_samples": [6]}}
STUDY_SCALERS = ["standard", "min_max"]

STUDY = f"""
raw as (select vec_id, label, unnest([
            {', '.join(f"{{'s': {i}, 'a': {a}, 'b': {b}, 'c': {c}}}" for i, (a, b, c) in enumerate(SETS))}
        ], recursive := true) from vectors),
scaled as (
    select s, 0 as k, vec_id, label,
           {', '.join(f"({c} - avg({c}) over w) / stddev_pop({c}) over w as {c}" for c in "abc")}
    from raw window w as (partition by s)
    union all
    select s, 1, vec_id, label,
           {', '.join(f"({c} - min({c}) over w) / (max({c}) over w - min({c}) over w)" for c in "abc")}
    from raw window w as (partition by s)),
pairs as (select x.s, x.k, x.vec_id as a, y.vec_id as b,
                 sqrt(pow(x.a - y.a, 2) + pow(x.b - y.b, 2) + pow(x.c - y.c, 2)) as d
          from scaled x join scaled y on x.s = y.s and x.k = y.k),
tenth as (select s, k, d as distance from pairs
          qualify row_number() over (partition by s, k, a order by d) = 11),
placed as (select s, k, distance, row_number() over (partition by s, k order by distance) - 1 as pos,
                  count(*) over (partition by s, k) - 1 as n,
                  min(distance) over (partition by s, k) as low,
                  max(distance) over (partition by s, k) as high
           from tenth),
knees as (select s, k, pos as knee_position, distance as knee_distance from placed
          qualify row_number() over (partition by s, k order by
              round(pos / n - (distance - low) / (high - low), 12) desc, pos) = 1),
settings as (select unnest([0.08, 0.4]::double[]) as eps),
near as (select s, k, eps, a, b from pairs, settings where d <= eps),
core as (select s, k, eps, a from near group by all having count(*) >= 6),
links as (select near.* from near join core c using (s, k, eps, a)
          join core o on o.s = near.s and o.k = near.k and o.eps = near.eps and o.a = near.b),
reach(s, k, eps, node, label) as (
    select s, k, eps, a, a from core
    union
    select l.s, l.k, l.eps, l.b, r.label from reach r join links l
    on l.s = r.s and l.k = r.k and l.eps = r.eps and l.a = r.node where l.b > r.label),
cores as (select s, k, eps, node, min(label) as seed from reach group by all),
borders as (select near.s, near.k, near.eps, near.a as node, min(cores.seed) as seed
            from near join cores on cores.s = near.s and cores.k = near.k
                 and cores.eps = near.eps and cores.node = near.b group by all),
made as (select v.s, v.k, e.eps, v.vec_id, v.label, v.a, v.b, v.c,
                coalesce(cores.seed, borders.seed, -1) as seed
         from scaled v cross join settings e
         left join cores on cores.s = v.s and cores.k = v.k and cores.eps = e.eps
              and cores.node = v.vec_id
         left join borders on borders.s = v.s and borders.k = v.k and borders.eps = e.eps
              and borders.node = v.vec_id),
numbered as (select *, case when seed = -1 then -1 else dense_rank() over (
                 partition by s, k, eps, seed = -1 order by seed) - 1 end as cluster from made),
sums as (select p.s, p.k, x.eps, p.a, x.cluster as own, y.cluster as other, sum(p.d) as total,
                count(*) as n
         from pairs p join numbered x on x.s = p.s and x.k = p.k and x.vec_id = p.a
         join numbered y on y.s = p.s and y.k = p.k and y.vec_id = p.b and y.eps = x.eps
         group by all),
parts as (select s, k, eps, a as vec_id,
                 max(case when own = other then total / nullif(n - 1, 0) end) as a,
                 min(case when own <> other then total / n end) as b,
                 max(case when own = other then n end) as n
          from sums group by all),
scores as (select s, k, eps, avg(case when b is null then null when n = 1 then 0.0
                                 else coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) end) as score
           from parts where s < 2 group by all),
trials as (select * from scores qualify row_number() over (
               partition by s, k order by score desc nulls last, eps) = 1),
best as (select * from trials where score > 0 order by score desc, s, k limit 1)
"""


def study(spark: SparkSession, sf_dir: str) -> sweep.Study:
    points = settle(plain_vectors(spark, sf_dir))
    return sweep.clustering_study(points, "vec_id", SETS[:2], STUDY_SCALERS, STUDY_GRID)


@register(
    "k12_density_study",
    f"""with recursive {VECTORS}, {STUDY}
        select array_to_string(list_extract([['f1', 'f2', 'f3'], ['f4', 'f5', 'f6']], t.s + 1), ' ')
                   as features,
               case t.k when 0 then 'standard' else 'min_max' end as scaler,
               knee_position, round(knee_distance, 8) as knee_distance, t.eps,
               round(t.score, 8) as score, coalesce(b.s = t.s and b.k = t.k, false) as best
        from trials t join knees using (s, k) left join best b on true""",
)
def density_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scaled set with its knee, best candidate and whether it won."""
    found = study(spark, sf_dir)
    won = found.winner
    is_best = F.lit(False) if won is None else (
        (F.col("features") == F.array(*[F.lit(f) for f in won.features]))
        & (F.col("scaler") == won.scaler)
        & (F.col("model") == won.model)
    )
    return found.trials.join(found.knees, ["features", "scaler"]).select(
        F.array_join("features", " ").alias("features"),
        "scaler",
        F.col("position").alias("knee_position"),
        F.round("distance", 8).alias("knee_distance"),
        F.col("params")["eps"].cast("double").alias("eps"),
        F.round("score", 8).alias("score"),
        is_best.alias("best"),
    )


@register(
    "k12_best_matrix",
    f"""with recursive {VECTORS}, {STUDY}
        select vec_id, round(a, 8) as x1, round(b, 8) as x2, round(c, 8) as x3, cluster
        from numbered join best using (s, k, eps)""",
)
def best_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaled matrix of the best trial with its labels."""
    won = study(spark, sf_dir).winner
    if won is None:
        return spark.createDataFrame(
            [], "vec_id long, x1 double, x2 double, x3 double, cluster long"
        )
    scaled = [F.round(c, 8).alias(f"x{i + 1}") for i, c in enumerate(won.features)]
    return won.matrix.join(won.labels, "vec_id").select("vec_id", *scaled, "cluster")


@register(
    "k13_winner_purity",
    f"""with recursive {VECTORS}, {STUDY},
        won as (select n.s, n.cluster, n.label from numbered n join best b on n.k = b.k and n.eps = b.eps),
        counts as (select s, cluster, label, count(*) as n from won group by all),
        largest as (select s, cluster, max(n) as largest, sum(n) as n from counts group by s, cluster)
        select s as feature_set, count(*) filter (cluster <> -1) as clusters,
               round(sum(largest) / sum(n), 9) as purity
        from largest group by s""",
)
def winner_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of the study refitted on every feature set."""
    points = settle(plain_vectors(spark, sf_dir))
    won = sweep.clustering_study(points, "vec_id", SETS[:2], STUDY_SCALERS, STUDY_GRID).winner
    if won is None:
        return spark.createDataFrame([], "feature_set int, clusters long, purity double")
    tables = sweep.refit_winner(points, "vec_id", "label", SETS, won)
    return sweep.refit_report(tables, "label").select(
        "feature_set", "clusters", F.round("purity", 9).alias("purity")
    )
