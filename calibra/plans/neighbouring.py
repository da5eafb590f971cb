"""Queries over neighbours, density clustering, centres and label quality, on the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import element_means
from ..operators import clusters as K, columns as C, density as G, features as X, labels as L, metrics as E, neighbors as N
from ..operators.splits import split
from .registry import query

PAIRS = """pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, a.label AS li, b.label AS lj,
    list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""
RANKED = f"{PAIRS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs)"
MEANS = """means AS (SELECT label, list(m ORDER BY pos) AS c FROM (
    SELECT label, pos, avg(v) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos) GROUP BY label)"""


def _label_means(t):
    """One center per label, in label order: a row per label."""
    points = t("embeddings").select("label", F.col("embedding").cast("array<double>").alias("x"))
    rows = element_means(points, ["label"], "x", 64).orderBy("label").collect()
    return [r["center"] for r in rows]


@query(
    "knn",
    f"WITH {RANKED} SELECT i AS vec_id, rank::INT AS rank, j AS neighbor, round(d, 6) AS distance FROM ranked WHERE rank <= 5",
)
def knn(t):
    return C.round_cols(N.knn(t("embeddings"), "vec_id", "embedding", 5), ["distance"], 6)


@query(
    "knn_with_self",
    f"""WITH {RANKED} SELECT i AS vec_id, (rank + 1)::INT AS rank, j AS neighbor, round(d, 6) AS distance FROM ranked WHERE rank <= 4
        UNION ALL SELECT vec_id, 1, vec_id, 0.0 FROM embeddings""",
)
def knn_with_self(t):
    return C.round_cols(N.knn(t("embeddings"), "vec_id", "embedding", 5, include_self=True), ["distance"], 6)


@query(
    "kdistance_eps",
    f"WITH {RANKED} SELECT round(quantile_cont(d, 0.9), 6) AS eps FROM ranked WHERE rank = 4",
)
def kdistance_eps(t):
    return C.round_cols(N.kdistance_eps(t("embeddings"), "vec_id", "embedding", 5, 0.9), ["eps"], 6)


@query(
    "kdistance_curve",
    f"WITH {RANKED} SELECT i AS vec_id, round(d, 6) AS kdistance FROM ranked WHERE rank = 4",
)
def kdistance_curve(t):
    return C.round_cols(N.kdistance(t("embeddings"), "vec_id", "embedding", 5), ["kdistance"], 6)


def _vote_sql(k: int, weight: str) -> str:
    return f"""WITH part AS (SELECT vec_id, label, embedding::DOUBLE[] AS x,
        row_number() OVER (ORDER BY md5(vec_id::VARCHAR || '|42')) <= ceil((SELECT count(*) FROM embeddings) * 0.2) AS test FROM embeddings),
      pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, b.label AS l, list_distance(a.x, b.x) AS d FROM part a JOIN part b ON a.test AND NOT b.test),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, j) AS rank FROM pairs),
      votes AS (SELECT i, l, sum({weight}) AS w FROM ranked WHERE rank <= {k} GROUP BY i, l)
      SELECT i AS vec_id, arg_min(l, (-round(w, 9), l)) AS predicted, round(max(w) / sum(w), 6) AS confidence FROM votes GROUP BY i"""


def _classified(t, k, weights):
    parts = split(t("embeddings"), "vec_id", 0.2, 42)
    train, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    return C.round_cols(N.knn_classify(train, test, "vec_id", "embedding", "label", k, weights), ["confidence"], 6)


@query("knn_classify", _vote_sql(5, "1.0"))
def knn_classify(t):
    return _classified(t, 5, "uniform")


@query("knn_classify_weighted", _vote_sql(11, "1.0 / d"))
def knn_classify_weighted(t):
    return _classified(t, 11, "distance")


def _silhouette_sql(label: str) -> str:
    return f"""SELECT count(DISTINCT own) AS clusters, count(*) AS points, round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
      FROM (SELECT i, any_value(own) AS own, max(CASE WHEN own = c THEN n END) AS n, max(CASE WHEN own = c THEN s / (n - 1) END) AS a,
                   min(CASE WHEN own <> c THEN s / n END) AS b
            FROM (SELECT p.i, o.l AS own, q.l AS c, sum(d) AS s FROM pairs p
                  JOIN (SELECT vec_id, {label} AS l FROM embeddings) o ON o.vec_id = p.i
                  JOIN (SELECT vec_id, {label} AS l FROM embeddings) q ON q.vec_id = p.j GROUP BY 1, 2, 3) g
            JOIN (SELECT {label} AS l, count(*) AS n FROM embeddings GROUP BY 1) z ON z.l = c GROUP BY i)"""


@query("silhouette", f"WITH {PAIRS} {_silhouette_sql('label')}")
def silhouette(t):
    return C.round_cols(N.silhouette(t("embeddings"), "vec_id", "embedding", "label"), ["silhouette"], 6)


@query(
    "method_ranking",
    f"""WITH {PAIRS}, s1 AS ({_silhouette_sql('label')}), s2 AS ({_silhouette_sql('label % 2')})
        SELECT 'label' AS method, silhouette FROM s1 UNION ALL SELECT 'parity', silhouette FROM s2""",
)
def method_ranking(t):
    df = t("embeddings").withColumn("parity", F.col("label") % 2)
    scores = N.silhouettes(df, "vec_id", "embedding", ["label", "parity"])
    ranked = L.rank_methods(scores.select(F.col("labeling").alias("method"), "silhouette"))
    return C.round_cols(ranked, ["silhouette"], 6)


@query(
    "silhouette_squared",
    f"""WITH {PAIRS}, means AS (SELECT i, li = lj AS own, lj, avg(d * d) AS m FROM pairs GROUP BY ALL),
        sides AS (SELECT i, min(m) FILTER (WHERE own) AS a, min(m) FILTER (WHERE NOT own) AS b FROM means GROUP BY i)
        SELECT 'label' AS labeling, round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM sides""",
)
def silhouette_squared(t):
    value = N.silhouette_squared(t("embeddings"), "embedding", "label")
    return t.spark.createDataFrame([("label", round(value, 6))], "labeling string, silhouette double")


@query(
    "inertia",
    f"""WITH {MEANS}, d AS (SELECT vec_id, min(list_distance(embedding::DOUBLE[], c)) AS d FROM embeddings, means GROUP BY vec_id)
        SELECT round(sum(d * d), 6) AS inertia FROM d""",
)
def inertia(t):
    df = t("embeddings").select(F.col("embedding").cast("array<double>").alias("x"))
    return C.round_cols(E.inertia(df, "x", _label_means(t)), ["inertia"], 6)


@query(
    "lloyd_step",
    f"""WITH {MEANS}, a AS (SELECT vec_id, arg_min(label, list_distance(x, c)) AS cluster, any_value(x) AS x
          FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), (SELECT row_number() OVER (ORDER BY label) - 1 AS label, c FROM means) GROUP BY vec_id),
        u AS (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM a)
        SELECT cluster::INT AS cluster, pos::INT AS pos, count(*) AS n, round(avg(v), 6) AS value FROM u GROUP BY cluster, pos""",
)
def lloyd_step(t):
    step = K.lloyd_step(t("embeddings"), "embedding", _label_means(t))
    return step.select("cluster", "n", F.posexplode("center").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(
    "fuzzy_step",
    f"""WITH {MEANS}, d AS (SELECT vec_id, x, row_number() OVER (PARTITION BY vec_id ORDER BY label) - 1 AS cluster, greatest(list_distance(x, c), 2.2e-16) AS d
          FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), means),
        u AS (SELECT vec_id, cluster, x, (1 / (d * d)) / sum(1 / (d * d)) OVER (PARTITION BY vec_id) AS u FROM d),
        v AS (SELECT cluster, u * u AS w, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS pos FROM u)
        SELECT cluster::INT AS cluster, pos::INT AS pos, round(sum(w), 6) AS weight, round(sum(w * v) / sum(w), 6) AS value FROM v GROUP BY cluster, pos""",
)
def fuzzy_step(t):
    step = K.fuzzy_step(t("embeddings"), "embedding", _label_means(t))
    out = step.select("cluster", F.round("weight", 6).alias("weight"), F.posexplode("center").alias("pos", "value"))
    return out.withColumn("value", F.round("value", 6))


@query(
    "elbow_total",
    """SELECT round(sum(v), 6) AS inertia FROM (SELECT pos, var_pop(x) * count(*) AS v FROM (
         SELECT unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY pos)""",
)
def elbow_total(t):
    return C.round_cols(K.total_inertia(t("embeddings"), "embedding"), ["inertia"], 6)


@query(
    "subtractive_potential",
    f"""WITH {PAIRS} SELECT i AS vec_id, round(1 + sum(exp(-d * d / 0.5625)), 6) AS potential FROM pairs GROUP BY i""",
)
def subtractive_potential(t):
    p = K.potentials(t("embeddings"), "vec_id", "embedding", 1.5)
    return p.select(F.col("id").alias("vec_id"), F.round("potential", 6).alias("potential"))


@query("subtractive")
def subtractive(t):
    assigned, _ = K.subtractive(t("embeddings"), "vec_id", "embedding", ra=1.5)
    return assigned


# --- density ----------------------------------------------------------------------------

EPS, MIN_SAMPLES = 1.14, 4
DBSCAN = f"""{PAIRS}, near AS (SELECT * FROM pairs WHERE d <= {EPS}),
  core AS (SELECT i FROM near GROUP BY i HAVING count(*) + 1 >= {MIN_SAMPLES}),
  edge AS (SELECT i, j FROM near WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)),
  walk(i, r) AS (SELECT i, i FROM core UNION SELECT e.j, w.r FROM walk w JOIN edge e ON e.i = w.i),
  comp AS (SELECT i, min(r) AS c FROM walk GROUP BY i),
  border AS (SELECT n.i, min(c.c) AS c FROM near n JOIN comp c ON c.i = n.j WHERE n.i NOT IN (SELECT i FROM core) GROUP BY n.i),
  named AS (SELECT i, c FROM comp UNION ALL SELECT i, c FROM border),
  dense AS (SELECT i, dense_rank() OVER (ORDER BY c) - 1 AS cluster FROM named),
  labeled AS (SELECT vec_id, coalesce(cluster, -1)::INT AS cluster FROM embeddings LEFT JOIN dense ON i = vec_id)"""


@query("dbscan", f"WITH RECURSIVE {DBSCAN} SELECT vec_id, cluster FROM labeled")
def dbscan(t):
    return G.dbscan(t("embeddings"), "vec_id", "embedding", EPS, MIN_SAMPLES)


@query("cluster_sizes", f"WITH RECURSIVE {DBSCAN} SELECT cluster, count(*) AS n FROM labeled GROUP BY cluster")
def cluster_sizes(t):
    return L.cluster_sizes(G.dbscan(t("embeddings"), "vec_id", "embedding", EPS, MIN_SAMPLES))


@query(
    "cluster_summary",
    f"""WITH RECURSIVE {DBSCAN} SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS clusters,
        count(*) FILTER (WHERE cluster = -1) AS noise FROM labeled""",
)
def cluster_summary(t):
    return L.cluster_summary(G.dbscan(t("embeddings"), "vec_id", "embedding", EPS, MIN_SAMPLES))


@query("dbscan_sweep")
def dbscan_sweep(t):
    return G.dbscan_sweep(t("embeddings"), "vec_id", "embedding", [1.10, 1.14, 1.18], [3, 5])


@query(
    "core_distance",
    f"WITH {RANKED} SELECT i AS vec_id, round(d, 6) AS core FROM ranked WHERE rank = 5",
)
def core_distance(t):
    return C.round_cols(G.core_distance(t("embeddings"), "vec_id", "embedding", 5), ["core"], 6)


@query(
    "mutual_reachability",
    f"""WITH {RANKED}, core AS (SELECT i, d AS c FROM ranked WHERE rank = 5)
        SELECT r.i AS vec_id, r.j AS neighbor, round(greatest(r.d, a.c, b.c), 6) AS reach
        FROM ranked r JOIN core a ON a.i = r.i JOIN core b ON b.i = r.j WHERE r.rank <= 5""",
)
def mutual_reachability(t):
    edges = G.mutual_reachability(t("embeddings"), "vec_id", "embedding", 5)
    return C.round_cols(edges.select("vec_id", "neighbor", "reach"), ["reach"], 6)


@query("density_levels")
def density_levels(t):
    _, scores = G.density_levels(t("embeddings"), "vec_id", "embedding", 3, 5, levels=5, neighbors=5)
    return scores


@query("density_clusters")
def density_clusters(t):
    return G.density_clusters(t("embeddings"), "vec_id", "embedding", 3, 5, seed=42, levels=5, neighbors=5)


OUTLIER = f"""{RANKED}, core AS (SELECT i, li, d AS c FROM ranked WHERE rank = 5),
  scored AS (SELECT i AS vec_id, li AS cluster, 1 - min(c) OVER (PARTITION BY li) / c AS score FROM core)"""


def _scored(t):
    core = G.core_distance(t("embeddings"), "vec_id", "embedding", 5)
    labels = t("embeddings").select("vec_id", F.col("label").alias("cluster"))
    return G.density_outlier(labels, core, "vec_id")


@query("density_outlier", f"WITH {OUTLIER} SELECT vec_id, cluster, round(score, 6) AS score FROM scored")
def density_outlier(t):
    return C.round_cols(_scored(t), ["score"], 6)


@query(
    "outlier_bands",
    f"""WITH {OUTLIER} SELECT round(avg(score), 6) AS global_mean, round(avg(score) FILTER (WHERE cluster = 1), 6) AS group_mean,
        count(*) FILTER (WHERE cluster = 1 AND score < 0.05) AS core, count(*) FILTER (WHERE cluster = 1 AND score >= 0.05 AND score < 0.20) AS border,
        count(*) FILTER (WHERE cluster = 1 AND score >= 0.20) AS outlier FROM scored""",
)
def outlier_bands(t):
    bands = L.outlier_bands(_scored(t).withColumn("one", F.col("cluster") == 1), "one")
    return C.round_cols(bands, ["global_mean", "group_mean"], 6)


# --- label quality ----------------------------------------------------------------------


@query(
    "mislabel_report",
    """SELECT count(*) AS total, count(*) FILTER (WHERE toxic = 1) AS confirmed, count(*) FILTER (WHERE toxic <> 1) AS reclassified,
         round(100.0 * count(*) FILTER (WHERE toxic = 1) / count(*), 6)::DOUBLE AS confirmed_percent,
         round(100.0 * count(*) FILTER (WHERE toxic <> 1) / count(*), 6)::DOUBLE AS reclassified_percent FROM labels WHERE quality = 1""",
)
def mislabel_report(t):
    df = t("labels").select("doc_id", "quality", F.col("toxic").alias("cluster"))
    return C.round_cols(L.mislabel_report(df, "quality"), ["confirmed_percent", "reclassified_percent"], 6)


@query("mislabeled_rows", "SELECT doc_id, quality, toxic AS cluster FROM labels WHERE quality = 1 AND toxic = 0")
def mislabeled_rows(t):
    return L.mislabeled(t("labels").select("doc_id", "quality", F.col("toxic").alias("cluster")), "quality")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "cluster_feature_diff",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(abs(avg({c}) FILTER (WHERE l_returnflag = 'R') - avg({c}) FILTER (WHERE l_returnflag = 'A')) / stddev_pop({c}), 6) AS difference
            FROM lineitem"""
        for c in _MEASURES
    ),
)
def cluster_feature_diff(t):
    cluster = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0)
    df = X.standardize(t("lineitem").select(*_MEASURES, cluster.alias("cluster")), _MEASURES)
    return C.round_cols(L.cluster_feature_diff(df, _MEASURES), ["difference"], 6)


CONSENSUS = f"""{RANKED}, votes AS (SELECT i, any_value(li) AS label, lj, sum(1 / d) AS w FROM ranked WHERE rank <= 11 GROUP BY i, lj),
  judged AS (SELECT i AS vec_id, any_value(label) AS label, arg_min(lj, (-round(w, 9), lj)) AS predicted, 1 - max(w) / sum(w) AS uncertainty
             FROM votes GROUP BY i),
  apart AS (SELECT vec_id, row_number() OVER (ORDER BY -uncertainty, vec_id) AS rn FROM judged WHERE label <> predicted),
  marked AS (SELECT j.*, coalesce(a.rn <= floor((SELECT count(*) FROM embeddings) * 0.3), false) AS relabeled
             FROM judged j LEFT JOIN apart a ON a.vec_id = j.vec_id),
  cleaned AS (SELECT *, CASE WHEN relabeled THEN predicted ELSE label END AS clean FROM marked)"""


def _relabeled(t):
    return L.relabel(t("embeddings"), "vec_id", "embedding", "label", k=11)


@query("relabel", f"WITH {CONSENSUS} SELECT vec_id, label, predicted, round(uncertainty, 6) AS uncertainty, relabeled, clean FROM cleaned")
def relabel(t):
    return C.round_cols(_relabeled(t), ["uncertainty"], 6)


@query(
    "relabel_summary",
    f"""WITH {CONSENSUS} SELECT count(*) AS rows, round(avg((label = predicted)::INT), 6) AS alignment, count(*) FILTER (WHERE label <> predicted) AS disagree,
        count(*) FILTER (WHERE relabeled) AS relabeled, floor(count(*) * 0.3)::BIGINT AS max_relabel FROM cleaned""",
)
def relabel_summary(t):
    return C.round_cols(L.relabel_summary(_relabeled(t), "label"), ["alignment"], 6)


@query(
    "class_balance",
    f"""WITH {CONSENSUS} SELECT 'original' AS version, label::VARCHAR AS class, count(*) AS n FROM cleaned GROUP BY 2
        UNION ALL SELECT 'relabeled', clean::VARCHAR, count(*) FROM cleaned GROUP BY 2""",
)
def class_balance(t):
    return L.balance(_relabeled(t), {"original": "label", "relabeled": "clean"})


# --- centre-based and hierarchical ------------------------------------------------------


@query("kmeans")
def kmeans(t):
    return K.kmeans(t("embeddings"), "vec_id", "embedding", 4, [1, 2, 3])[0]


@query("elbow")
def elbow(t):
    return K.elbow(t("embeddings"), "vec_id", "embedding", [1, 2, 3, 4], [1, 2])


@query("kmeans_aligned")
def kmeans_aligned(t):
    df = t("embeddings").withColumn("odd", F.col("label") % 2)
    return K.kmeans_aligned(df, "vec_id", "embedding", "odd", [1, 2, 3])


@query("fuzzy_cmeans")
def fuzzy_cmeans(t):
    assigned, _ = K.fuzzy_cmeans(t("embeddings"), "vec_id", "embedding", 3, seed=42)
    return assigned


@query("fuzzy_select")
def fuzzy_select(t):
    return K.fuzzy_select(t("embeddings"), "vec_id", "embedding", [2, 3, 4], seed=42)[0]


@query("micro_agglomerative")
def micro_agglomerative(t):
    return K.micro_agglomerative(t("embeddings"), "vec_id", "embedding", "average", [2, 3, 4], m=None, seed=42)[1]


@query("merge_table")
def merge_table(t):
    micro = K.micro_clusters(t("embeddings"), "vec_id", "embedding", 32, 42)
    return K.merge_table(micro, "vec_id", "ward")


@query("stability")
def stability(t):
    df = t("embeddings").select("vec_id", "embedding")

    def fit(sample, seed):
        return K.kmeans(sample, "vec_id", "embedding", 3, [seed])[0]

    return L.stability(df, "vec_id", fit(df, 42), fit, rounds=3, seed=42)[0]
