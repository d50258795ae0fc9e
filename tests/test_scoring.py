"""Hand examples for the online rescoring (ledger rows 13-19)."""

import pytest

from rateflow.operators import scoring


@pytest.fixture()
def world(spark):
    sims = spark.createDataFrame(
        [(1, 2, 0.9), (2, 1, 0.9), (1, 3, 0.8), (3, 1, 0.8), (2, 10, 0.5), (10, 2, 0.5),
         (2, 11, 0.45), (11, 2, 0.45), (3, 10, 0.7), (10, 3, 0.7), (1, 10, 0.95)],
        "productId int, simProductId int, sim double")
    history = spark.createDataFrame([(7, 10, 5.0, 100), (7, 11, 3.0, 90)],
                                    "userId int, productId int, score double, timestamp int")
    return sims, history


def test_scores_hand_example(spark, world):
    sims, history = world
    msgs = spark.createDataFrame([(100, 7, 1, 2.0, 200)],
                                 "event_id long, userId int, productId int, score double, timestamp int")
    recents = scoring.recent_ratings(history)
    cand = scoring.candidates(msgs, sims, history)
    # 10 is rated already, so only 2 and 3 remain
    assert sorted(r.productId for r in cand.collect()) == [2, 3]
    got = {r.productId: r.score for r in scoring.scores(cand, recents, sims).collect()}
    # product 2: avg(0.5*5, 0.45*3) + log10(1) - log10(1); a score of exactly 3 is a dislike
    assert got[2] == pytest.approx((2.5 + 1.35) / 2)
    # product 3: 0.7*5, one like, no dislike (counter defaults to 1)
    assert got[3] == pytest.approx(3.5)
    recs = scoring.message_recs(msgs, sims, history, recents).first().recs
    assert [(e.productId, round(e.score, 6)) for e in recs] == [(3, 3.5), (2, 1.925)]


def test_likes_and_dislikes_use_log10(spark, world):
    sims, _ = world
    history = spark.createDataFrame([(7, 10, 5.0, 100), (8, 10, 4.0, 1)],
                                    "userId int, productId int, score double, timestamp int")
    hist = history.union(spark.createDataFrame(
        [(7, 20 + i, 5.0, 10 + i) for i in range(9)], history.schema))
    sims2 = sims.union(spark.createDataFrame([(3, 20 + i, 0.5) for i in range(9)], sims.schema))
    msgs = spark.createDataFrame([(1, 7, 1, 2.0, 200)],
                                 "event_id long, userId int, productId int, score double, timestamp int")
    recents = scoring.recent_ratings(hist)
    cand = scoring.candidates(msgs, sims2, hist)
    got = {r.productId: r.score for r in scoring.scores(cand, recents, sims2).collect()}
    mean = (0.7 * 5 + 9 * 0.5 * 5) / 10
    assert got[3] == pytest.approx(mean + 1.0)   # log10(10 likes)


def test_recent_ratings_keeps_newest_21(spark):
    h = spark.createDataFrame([(1, p, 4.0, p) for p in range(1, 23)],
                              "userId int, productId int, score double, timestamp int")
    got = scoring.recent_ratings(h).collect()
    assert len(got) == 21
    assert min(r.productId for r in got) == 2
    assert [r.productId for r in sorted(got, key=lambda r: r.rank)][:2] == [22, 21]


def test_unknown_product_gives_empty_list(spark, world):
    sims, history = world
    msgs = spark.createDataFrame([(5, 7, 999, 4.0, 300)],
                                 "event_id long, userId int, productId int, score double, timestamp int")
    r = scoring.message_recs(msgs, sims, history, scoring.recent_ratings(history)).first()
    assert r.recs == []
    flat = scoring.flat_recs(scoring.latest_per_user(
        scoring.message_recs(msgs, sims, history, scoring.recent_ratings(history))), "userId")
    assert [tuple(x) for x in flat.collect()] == [(7, None, None, None)]


def test_two_messages_of_a_user_keep_the_later(spark, world):
    sims, history = world
    msgs = spark.createDataFrame([(5, 7, 1, 4.0, 300), (6, 7, 999, 4.0, 400)],
                                 "event_id long, userId int, productId int, score double, timestamp int")
    recs = scoring.message_recs(msgs, sims, history, scoring.recent_ratings(history))
    latest = scoring.latest_per_user(recs).collect()
    assert len(latest) == 1 and latest[0].recs == []   # event 6 (no candidates) is later
