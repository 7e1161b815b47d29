from pyspark.sql import functions as F

from airshed.llm import pii

FOUND = """case when kind = 0 then concat('a', id, '@b.org') when kind = 1 then concat(id % 300, '.2.3.', id % 256)
  when kind = 2 then string(4000000000000000 + id * 7919) else concat('+49 30 ', id * 31, if(id % 3 = 0, ' 1', ' 12345')) end"""


def test_trees_and_thresholds_have_every_known_candidate(spark, monkeypatch):
    n, fitted, bins = 30_000, [], []

    class Trees(pii.GBTClassifier):
        def _fit(self, dataset):
            weighs = self.isDefined(self.weightCol)
            fitted.append(dataset.agg(F.sum(self.getWeightCol()) if weighs else F.count("*")).first()[0])
            return super()._fit(dataset)

    plain = pii.thresholds
    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    monkeypatch.setattr(pii, "thresholds", lambda b: bins.extend(b) or plain(b))
    known = spark.range(n).selectExpr("id", "id as row", "int(id % 4) as kind", "0 as start").selectExpr("*", f"{FOUND} as found")
    counts = F.lit(False)
    for k, name in enumerate(pii.KINDS):
        counts = counts | ((F.col("kind") == k) & pii.valid(name, F.col("found")))
    known = known.withColumns({"end": F.length("found"), "before": F.lit("see "), "after": F.lit(" ."), "is_base": counts, "known": F.lit(True), "free": F.lit(True)})
    wide = known.limit(40).withColumns({"known": F.lit(False), "is_base": F.lit(False)})
    pii.judged_candidates(known.drop("id").unionByName(wide.drop("id"))).count()
    assert len(fitted) == 1 and fitted[0] + sum(b[3] for b in bins) == n
    assert sum(b[2] for b in bins) == known.where("is_base and pmod(xxhash64(found, before, 3), 4) = 0").count()
