"""The batch jobs write their tables, and the stream reads the factor model's."""

import random
import tempfile

from rateflow import jobs
from rateflow.schemas import PRODUCT_RECS, SIMILARITY, USER_RECS
from rateflow.sources.tables import KeyedLog
from rateflow.streaming import jobs as streams


def test_load_models_and_stream(spark):
    base = tempfile.mkdtemp(prefix="rf-jobs-")
    rng = random.Random(1)
    with open(f"{base}/products.txt", "w", encoding="utf-8") as f:
        for p in range(12):
            f.write(f"{p}^name {p}^1^B^img^cat^tag{p % 3}|x{p % 3}|own{p}\n")
        f.write("1^short\n")
    with open(f"{base}/ratings.txt", "w", encoding="utf-8") as f:
        for u in range(30):
            for p in rng.sample(range(12), 6):
                f.write(f"{u},{p},{5.0 if (u + p) % 3 == 0 else 2.0},{1_000_000 + u * 100 + p}\n")
        f.write("1,2,x,3\n")
    out = f"{base}/tables"
    jobs.load(spark, out, f"{base}/products.txt", f"{base}/ratings.txt")
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("Product").count() == 12 and read("Rating").count() == 180
    assert [r.reason for r in read("ProductRejects").collect()] == ["short_row"]
    assert [r.reason for r in read("RatingRejects").collect()] == ["bad_value"]
    jobs.statistics(spark, out)
    assert read("RateMoreProducts").count() == read("AverageProducts").count() == 12
    assert read("RateMoreRecentlyProducts").columns == ["productId", "count", "yearmonth"]
    jobs.co_rating(spark, out)
    assert read("ItemCFProductRecs").schema.simpleString() == PRODUCT_RECS.simpleString()
    jobs.content_based(spark, out)
    same = {r.productId: sorted(x.productId for x in r.recs) for r in read("ContentBasedProductRecs").collect()}
    assert all(p % 3 == q % 3 for p, ps in same.items() for q in ps)
    jobs.factors(spark, out, rank=3, max_iter=5, reg=0.05)
    assert read("UserRecs").schema.simpleString() == USER_RECS.simpleString()
    assert read("Similarity").schema.simpleString() == SIMILARITY.simpleString()
    lists = {(r.productId, x.productId) for r in read("ProductRecs").collect() for x in r.recs}
    assert lists == {(r.productId, r.simProductId) for r in read("Similarity").collect()} and lists
    jobs.history(spark, out)
    spark.createDataFrame([(1, "3|4|5.0|2000000")], streams.LINE_SCHEMA).write.parquet(f"{base}/src")
    q = streams.start_stream_recs(spark, f"{base}/src", f"{out}/StreamRecs", f"{base}/ckpt", sims_path=f"{out}/Similarity",
                                  history_path=f"{out}/History", quarantine_path=f"{base}/bad", trigger={"availableNow": True})
    streams.run_to_end(q)
    got = streams.recs_from_log(KeyedLog(spark, f"{out}/StreamRecs", streams.STREAM_RECS).read()).collect()
    rated = {r.productId for r in read("Rating").where("userId = 3").collect()}
    assert [r.userId for r in got] == [3] and not rated & {x.productId for x in got[0].recs}
