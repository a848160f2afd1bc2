"""Features, clustering models and their scores."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hourvault.operators import clustering as c
from hourvault.operators import distances, scores
from hourvault.operators.density import density_clusters
from hourvault.operators.features import (
    as_points, feature_table, join_datasets, mean_per_key, merged_features, numeric_columns, sample_rows, scaled)
from hourvault.operators.gold import repo_metrics
from hourvault.operators.hierarchy import ward
from hourvault.session import shared_dir
from hourvault.sources.sinks import write_centroids
from hourvault.sources.tables import read_dataset
from suite.base import events, query, table


def labelled_embeddings(spark, sf_dir):
    """The embeddings with their given label as cluster."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").alias("cluster"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def order_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("spent"))
    return feature_table(orders, "o_custkey", percent=None)


@query("hash_sample", """
SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 15""")
def hash_sample(spark, sf_dir):
    return sample_rows(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey")


@query("scaled_features", """
SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / (stddev_pop(p_size) OVER ()), 6) AS p_size,
       round((p_retailprice - avg(p_retailprice) OVER ()) / (stddev_pop(p_retailprice) OVER ()), 6) AS p_retailprice FROM part""")
def scaled_features(spark, sf_dir):
    rows = scaled(table(spark, sf_dir, "part"), ["p_size", "p_retailprice"], keep=["p_partkey"])
    return rows.select("p_partkey", *[F.round(x, 6).alias(x) for x in ("p_size", "p_retailprice")])


@query("feature_table", """
SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / (stddev_pop(p_size) OVER ()), 6) AS p_size,
       round((p_retailprice - avg(p_retailprice) OVER ()) / (stddev_pop(p_retailprice) OVER ()), 6) AS p_retailprice FROM part""")
def one_feature_table(spark, sf_dir):
    rows = feature_table(table(spark, sf_dir, "part"), "p_partkey")
    return rows.select("p_partkey", *[F.round(x, 6).alias(x) for x in rows.columns if x != "p_partkey"])


@query("mean_per_key", """
SELECT l_partkey, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount FROM lineitem GROUP BY 1""")
def means(spark, sf_dir):
    rows = mean_per_key(table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_discount", "l_returnflag"), "l_partkey")
    return rows.select("l_partkey", *[F.round(x, 6).alias(x) for x in ("l_quantity", "l_discount")])


@query("joined_datasets", """
SELECT c_custkey AS id, c_acctbal AS balance_x, s_acctbal AS balance_y, p_size AS size FROM customer JOIN supplier ON c_custkey = s_suppkey
JOIN part ON p_partkey = c_custkey""")
def joined_datasets(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    return join_datasets([customers, suppliers, parts], "id")


@query("merged_features", """
WITH l AS (SELECT l_partkey AS id, avg(l_quantity) AS l_quantity, avg(l_tax) AS l_tax FROM lineitem GROUP BY 1),
j AS (SELECT id, l_quantity, l_tax, p_size FROM l JOIN part ON p_partkey = id)
SELECT id, round((l_quantity - avg(l_quantity) OVER ()) / (stddev_pop(l_quantity) OVER ()), 6) AS l_quantity,
       round((l_tax - avg(l_tax) OVER ()) / (stddev_pop(l_tax) OVER ()), 6) AS l_tax,
       round((p_size - avg(p_size) OVER ()) / (stddev_pop(p_size) OVER ()), 6) AS p_size FROM j""")
def features_of_datasets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), "l_quantity", "l_tax")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name")
    rows = merged_features([lines, None, names, table(spark, sf_dir, "nation"), parts], "id")
    return rows.select("id", *[F.round(x, 6).alias(x) for x in rows.columns if x != "id"])


@query("model_input_reader", """
SELECT count(*) AS rows, count(DISTINCT c_custkey) AS keys FROM customer""")
def model_input_reader(spark, sf_dir):
    rows = read_dataset(spark, f"{sf_dir.rstrip('/')}/customer.parquet")
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("c_custkey").alias("keys"))


# One row per vector and dimension. Squared distances between all pairs check the linear formulas.
VECTORS_SQL = """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[64] AS x FROM embeddings),
d AS (SELECT vec_id, label, generate_subscripts(x, 1) AS dim, unnest(x) AS x FROM v),
centre AS (SELECT label, dim, avg(x) AS c, count(*) AS n FROM d GROUP BY 1, 2)
"""


@query("silhouette", """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[64] AS x FROM embeddings),
m AS (SELECT a.vec_id, a.label, b.label AS other, sum(array_distance(a.x, b.x) ** 2) AS total, count(*) AS n FROM v a, v b GROUP BY ALL),
s AS (SELECT vec_id, sum(CASE WHEN other = label THEN total / nullif(n - 1, 0) END) AS own, min(CASE WHEN other <> label THEN total / n END) AS near FROM m GROUP BY 1)
SELECT round(avg(CASE WHEN own IS NULL THEN 0 ELSE (near - own) / greatest(own, near) END), 6) AS silhouette FROM s""")
def silhouette(spark, sf_dir):
    points = labelled_embeddings(spark, sf_dir)
    return spark.createDataFrame([(round(scores.silhouette(points), 6),)], "silhouette double")


PLAIN_SQL = """
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[64] AS x FROM embeddings),
m AS (SELECT a.vec_id, a.label, b.label AS other, sum(array_distance(a.x, b.x)) AS total, count(*) AS n FROM v a, v b GROUP BY ALL),
s AS (SELECT vec_id, label, sum(CASE WHEN other = label THEN total / nullif(n - 1, 0) END) AS own, min(CASE WHEN other <> label THEN total / n END) AS near FROM m GROUP BY 1, 2),
p AS (SELECT label, CASE WHEN own IS NULL THEN 0 ELSE (near - own) / greatest(own, near) END AS s FROM s)
"""


@query("silhouette_exact", PLAIN_SQL + """
SELECT label AS cluster, count(*) AS points, round(avg(s), 6) AS silhouette FROM p GROUP BY 1 UNION ALL SELECT NULL, count(*), round(avg(s), 6) FROM p""")
def silhouette_exact(spark, sf_dir):
    """Plain silhouette of each cluster and (null) of all points."""
    found = distances.point_silhouettes(labelled_embeddings(spark, sf_dir))
    return found.rollup("cluster").agg(F.count(F.lit(1)).alias("points"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query("calinski_harabasz", VECTORS_SQL + """
, k AS (SELECT count(DISTINCT label) AS k, count(*) AS n FROM v),
g AS (SELECT dim, avg(x) AS g FROM d GROUP BY 1),
b AS (SELECT sum(n * (c - g) ** 2) AS b FROM centre JOIN g USING (dim)),
w AS (SELECT sum((x - c) ** 2) AS w FROM d JOIN centre USING (label, dim))
SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski FROM b, w, k""")
def calinski(spark, sf_dir):
    return scores.calinski_harabasz(labelled_embeddings(spark, sf_dir)).select(F.round("calinski", 6).alias("calinski"))


@query("davies_bouldin", VECTORS_SQL + """
, far AS (SELECT vec_id, label, sqrt(sum((x - c) ** 2)) AS r FROM d JOIN centre USING (label, dim) GROUP BY 1, 2),
s AS (SELECT label, avg(r) AS s FROM far GROUP BY 1),
gap AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.c - b.c) ** 2)) AS m FROM centre a JOIN centre b ON a.dim = b.dim AND a.label <> b.label GROUP BY 1, 2)
SELECT round(avg(worst), 6) AS davies FROM (SELECT i, max((p.s + q.s) / m) AS worst FROM gap JOIN s p ON p.label = i JOIN s q ON q.label = j GROUP BY 1)""")
def davies(spark, sf_dir):
    return scores.davies_bouldin(labelled_embeddings(spark, sf_dir)).select(F.round("davies", 6).alias("davies"))


@query("cluster_sizes_and_spread", VECTORS_SQL + """
SELECT label AS cluster, count(DISTINCT vec_id) AS n, round(sum((x - c) ** 2), 6) AS sse FROM d JOIN centre USING (label, dim) GROUP BY 1""")
def sizes(spark, sf_dir):
    return scores.cluster_stats(labelled_embeddings(spark, sf_dir)).select("cluster", "n", F.round("sse", 6).alias("sse"))


@query("guarded_evaluation", """
SELECT CASE r WHEN 1 THEN 'one cluster' ELSE 'noise rejected' END AS case_name, CASE r WHEN 1 THEN 1 ELSE (SELECT count(DISTINCT label) FROM embeddings WHERE label > 0) END AS n_clusters,
       -1.0::DOUBLE AS silhouette, -1.0::DOUBLE AS calinski, 'inf' AS davies FROM range(1, 3) t(r)""")
def guarded_evaluation(spark, sf_dir):
    points = labelled_embeddings(spark, sf_dir)
    noisy = points.withColumn("cluster", F.when(F.col("cluster") == 0, -1).otherwise(F.col("cluster")))
    cases = scores.evaluate(points.withColumn("cluster", F.lit(0))).withColumn("case_name", F.lit("one cluster")).unionByName(
        scores.evaluate(noisy, "reject").withColumn("case_name", F.lit("noise rejected")))
    return cases.withColumn("davies", F.when(F.col("davies") == float("inf"), "inf").otherwise(F.col("davies").cast("string")))


@query("cluster_profile", """
SELECT c_nationkey AS cluster, count(*) AS size, round(avg(c_acctbal), 6) AS c_acctbal FROM customer GROUP BY 1""")
def profile(spark, sf_dir):
    rows = scores.cluster_profile(table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "cluster"), ["c_acctbal"])
    return rows.withColumn("c_acctbal", F.round("c_acctbal", 6))


def separated_customers(spark, sf_dir):
    """Customers in five places far apart, at small distances around them: any sound clustering finds the places."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") % 5 * 1000 + F.col("c_acctbal") / 1000).alias("x"),
        (F.col("c_custkey") % 5 % 2 * 1000 + F.col("c_nationkey") / 10).alias("y"))
    return as_points(rows, "c_custkey")


def by_first_key(labelled):
    """Clusters named by their smallest key: c_custkey, cluster."""
    names = labelled.groupBy("cluster").agg(F.min("c_custkey").alias("first_key"))
    return labelled.select("c_custkey", "cluster").join(names, "cluster").select("c_custkey", F.col("first_key").alias("cluster"))


PLACES_SQL = "SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_custkey % 5) AS cluster FROM customer"


@query("kmeans", PLACES_SQL)
def kmeans(spark, sf_dir):
    return by_first_key(c.kmeans(separated_customers(spark, sf_dir))[0])


@query("kmeans_repositories", None)
def kmeans_repositories(spark, sf_dir):
    features = merged_features([repo_metrics(events(spark, sf_dir))], "repo_id", percent=None)
    labelled, _ = c.kmeans(as_points(features, "repo_id"))
    return scores.evaluate(labelled)


@query("kmeans_sweep", None)
def kmeans_sweep(spark, sf_dir):
    return c.best_models(c.kmeans_sweep(as_points(order_features(spark, sf_dir), "o_custkey")))


@query("hierarchical_sweep", None)
def hierarchical_sweep(spark, sf_dir):
    return c.hierarchical_sweep(as_points(order_features(spark, sf_dir), "o_custkey"))


@query("hierarchical", PLACES_SQL)
def hierarchical(spark, sf_dir):
    return by_first_key(c.hierarchical(separated_customers(spark, sf_dir), 5))


# Ward's merges one at a time: a row holds all clusters of a step.
WARD_SQL = """
WITH RECURSIVE f AS (SELECT c_nationkey AS id, avg(c_acctbal) AS x, count(*) AS y FROM customer GROUP BY 1),
p AS (SELECT id, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM f),
s AS (SELECT count(*) AS k, list({'ids': [id], 'n': 1::DOUBLE, 'x': x, 'y': y} ORDER BY id) AS c FROM p
  UNION ALL
  SELECT k - 1, list_concat(list_filter(c, lambda e, i: i <> b.i AND i <> b.j),
           [{'ids': list_concat(c[b.i].ids, c[b.j].ids), 'n': c[b.i].n + c[b.j].n, 'x': c[b.i].x + c[b.j].x, 'y': c[b.i].y + c[b.j].y}])
  FROM (SELECT k, c, list_min(flatten(list_transform(range(1, len(c) + 1), lambda i: list_transform(range(i + 1, len(c) + 1), lambda j:
          {'d': c[i].n * c[j].n / (c[i].n + c[j].n) * ((c[i].x / c[i].n - c[j].x / c[j].n) ** 2 + (c[i].y / c[i].n - c[j].y / c[j].n) ** 2),
           'i': i, 'j': j})))) AS b FROM s WHERE k > 2)),
l AS (SELECT k, unnest(c).ids AS ids FROM s WHERE k BETWEEN 2 AND 10)
SELECT CAST(k AS INTEGER) AS k, unnest(ids) AS c_nationkey, list_min(ids) AS cluster FROM l
"""


@query("hierarchy_of_nations", WARD_SQL)
def hierarchy_of_nations(spark, sf_dir):
    """The hierarchy cut into 2 to 10 clusters, each named by its smallest nation."""
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance"), F.count("*").alias("customers"))
    points = as_points(feature_table(rows, "c_nationkey", percent=None), "c_nationkey")
    names = {f"k{k}": k for k in c.SWEEP_K}
    labelled = ward(points).transform(points, names)
    labelled = labelled.select("c_nationkey", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("part")) for n, k in names.items()])).alias("cut")).select(
        "c_nationkey", "cut.*")
    first = labelled.groupBy("k", "part").agg(F.min("c_nationkey").alias("cluster"))
    return labelled.join(first, ["k", "part"]).select("k", "c_nationkey", "cluster")


@query("best_model", """
WITH v AS (SELECT vec_id, 'given labels' AS model, CAST(label AS BIGINT) AS label, embedding::DOUBLE[64] AS x FROM embeddings
  UNION ALL SELECT vec_id, 'by number', vec_id % 10, embedding::DOUBLE[64] FROM embeddings),
m AS (SELECT a.model, a.vec_id, a.label, b.label AS other, sum(array_distance(a.x, b.x) ** 2) AS total, count(*) AS n
  FROM v a JOIN v b ON a.model = b.model GROUP BY ALL),
s AS (SELECT model, vec_id, sum(CASE WHEN other = label THEN total / nullif(n - 1, 0) END) AS own, min(CASE WHEN other <> label THEN total / n END) AS near
  FROM m GROUP BY 1, 2)
SELECT model, '{}' AS params, (SELECT count(DISTINCT label) FROM v WHERE v.model = s.model) AS n_clusters,
       round(avg(CASE WHEN own IS NULL THEN 0 ELSE (near - own) / greatest(own, near) END), 6) AS silhouette
FROM s GROUP BY model ORDER BY silhouette DESC LIMIT 1""")
def best_model(spark, sf_dir):
    points = labelled_embeddings(spark, sf_dir)
    given = scores.evaluate(points).select(F.lit("given labels").alias("model"), F.lit("{}").alias("params"), "*")
    mixed = points.withColumn("cluster", (F.col("vec_id") % 10).cast("int"))
    other = scores.evaluate(mixed).select(F.lit("by number").alias("model"), F.lit("{}").alias("params"), "*")
    return c.best_models(given.unionByName(other), 1).select("model", "params", "n_clusters", F.round("silhouette", 6).alias("silhouette"))


# Five places far apart: the scores of the clustering that finds them.
SCORES_SQL = """
WITH f AS (SELECT c_custkey AS id, c_custkey % 5 AS place, c_custkey % 5 * 1000 + c_acctbal / 1000 AS x, c_custkey % 5 % 2 * 1000 + c_nationkey / 10 AS y FROM customer),
a AS (SELECT avg(x) AS x, avg(y) AS y, count(*) AS n FROM f),
c AS (SELECT place, avg(x) AS x, avg(y) AS y, count(*) AS n FROM f GROUP BY 1),
w AS (SELECT place, sum((f.x - c.x) ** 2 + (f.y - c.y) ** 2) AS w, avg(sqrt((f.x - c.x) ** 2 + (f.y - c.y) ** 2)) AS s FROM f JOIN c USING (place) GROUP BY 1),
ch AS (SELECT sum(c.n * ((c.x - a.x) ** 2 + (c.y - a.y) ** 2)) / 4 / ((SELECT sum(w) FROM w) / (max(a.n) - 5)) AS calinski FROM c, a),
db AS (SELECT avg(worst) AS davies FROM (SELECT p.place, max((v.s + u.s) / sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2)) AS worst
       FROM c p JOIN c q ON p.place <> q.place JOIN w v ON v.place = p.place JOIN w u ON u.place = q.place GROUP BY 1)),
m AS (SELECT f.id, f.place, c.place AS other, c.n * ((f.x - c.x) ** 2 + (f.y - c.y) ** 2) + w.w AS total, c.n FROM f, c JOIN w ON w.place = c.place),
sil AS (SELECT avg((near - own) / greatest(own, near)) AS silhouette FROM (
       SELECT id, sum(CASE WHEN other = place THEN total / (n - 1) END) AS own, min(CASE WHEN other <> place THEN total / n END) AS near FROM m GROUP BY 1))
"""


@query("run_record", SCORES_SQL + """
SELECT '{"k": 5}' AS params, 'KMeans' AS model_type, round(silhouette, 5) AS silhouette, round(calinski / 1e6, 4) AS calinski, round(davies, 5) AS davies FROM sil, ch, db, range(2)""")
def run_record(spark, sf_dir):
    """The best of two clusterings, stored by two runs and read back."""
    path = shared_dir(spark, "runs")
    points = separated_customers(spark, sf_dir)
    scored = c.kmeans_sweep(points, ks=(3, 5)).persist()
    for _ in range(2):
        c.append_run(scored, path)
    scored.unpersist()
    return spark.read.parquet(path).select("params", "model_type", F.round("silhouette", 5).alias("silhouette"),
                                           F.round(F.col("calinski") / 1e6, 4).alias("calinski"), F.round("davies", 5).alias("davies"))


@query("best_of_sweeps", SCORES_SQL + """
SELECT model, '{"k": 5}' AS params, 5 AS n_clusters, round(silhouette, 5) AS silhouette FROM sil, (VALUES ('KMeans'), ('Hierarchical')) v(model)""")
def best_of_sweeps(spark, sf_dir):
    """The best number of clusters, 2 to 10, of both methods: both find the places."""
    points = separated_customers(spark, sf_dir)
    best = [c.best_models(sweep(points), 1) for sweep in (c.kmeans_sweep, c.hierarchical_sweep)]
    return best[0].unionByName(best[1]).select("model", "params", "n_clusters", F.round("silhouette", 5).alias("silhouette"))


@query("centroid_file", """
SELECT round(avg(c_custkey % 5 * 1000 + c_acctbal / 1000), 6) AS x, round(avg(c_custkey % 5 % 2 * 1000 + c_nationkey / 10), 6) AS y FROM customer GROUP BY c_custkey % 5""")
def centroid_file(spark, sf_dir):
    path = shared_dir(spark, "centroids")
    _, model = c.kmeans(separated_customers(spark, sf_dir))
    write_centroids(c.centroids(model, ["x", "y"]), path)
    rows = spark.read.option("header", True).schema("cluster int, x double, y double").csv(path)
    return rows.select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


DENSITY_SQL = """
WITH p AS (SELECT p_partkey AS id, (p_size - avg(p_size) OVER ()) / (stddev_pop(p_size) OVER ()) AS x,
             (p_retailprice - avg(p_retailprice) OVER ()) / (stddev_pop(p_retailprice) OVER ()) AS y FROM part),
near AS (SELECT a.id AS id, b.id AS other FROM p a, p b WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 0.1 * 0.1),
core AS (SELECT id FROM near GROUP BY 1 HAVING count(*) >= 5)
SELECT id AS p_partkey, id IN (SELECT id FROM core) AS is_core,
       id NOT IN (SELECT near.id FROM near JOIN core ON near.other = core.id) AS is_noise FROM p
"""


@query("density_clusters", DENSITY_SQL)
def density(spark, sf_dir):
    features = feature_table(table(spark, sf_dir, "part"), "p_partkey", percent=None)
    labelled = density_clusters(features, "p_partkey", ["p_size", "p_retailprice"], 0.1, 5)
    return labelled.select("p_partkey", "is_core", (F.col("cluster") == -1).alias("is_noise"))


@query("density_sweep", None)
def density_sweep(spark, sf_dir):
    metrics = repo_metrics(events(spark, sf_dir))
    features = feature_table(metrics.select("repo_id", *[x for x in numeric_columns(metrics) if x != "repo_id"]), percent=None)
    return c.density_sweep(features, "repo_id", eps_values=(0.5,), min_samples=(3, 5))
