"""Model quality: training on the entity view recovers the planted groups."""

from pyspark.sql import functions as F

import fixture_views as fixtures
from linkforge.plans.linkage import run_linkage


def test_trained_linkage_recovers_planted_groups(spark):
    sf = "/root/testdata/sf0.01"
    latest = fixtures.registrations_latest(spark, sf)
    out = run_linkage(spark, latest)
    clusters = out["clusters"].select("uei", "cluster_id")
    truth = latest.select("uei", (F.col("uei").cast("long") / 4).cast("long").alias("group"))
    # pairwise precision / recall over co-clustered entity pairs (group sizes <= 8)
    a = clusters.join(truth, "uei")
    pred = (a.alias("x").join(a.alias("y"), (F.col("x.cluster_id") == F.col("y.cluster_id"))
                              & (F.col("x.uei") < F.col("y.uei")))
             .select(F.col("x.uei").alias("l"), F.col("y.uei").alias("r"),
                     (F.col("x.group") == F.col("y.group")).alias("same")))
    tp = pred.where("same").count()
    precision = tp / max(pred.count(), 1)
    b = truth.join(latest.where(F.col("name_norm").isNotNull()).select("uei"), "uei")
    true_pairs = (b.alias("x").join(b.alias("y"), (F.col("x.group") == F.col("y.group"))
                                    & (F.col("x.uei") < F.col("y.uei"))).count())
    recall = tp / max(true_pairs, 1)
    assert precision >= 0.95 and recall >= 0.95, (precision, recall)
