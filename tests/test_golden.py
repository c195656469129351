"""Known totals of the derived review tables at the smallest scale."""

from pyspark.sql import functions as F

from opinara.operators import windows as w
from opinara.operators.quality import annotate_validity
from opinara.plans import fixtures as fx


def test_review_totals(spark, sf_small):
    got = fx.reviews(spark, sf_small).agg(F.count("*"), F.sum("rating"), F.sum("likes"),
                                          F.count_distinct("product_id")).first()
    assert tuple(got) == (1000, 2932, 38876, 15)


def test_text_and_validation(spark, sf_small):
    reviews = fx.reviews_with_text(spark, sf_small)
    assert reviews.agg(F.sum(F.char_length("text"))).first()[0] == 2223638
    codes = {r.error_code: r["count"] for r in
             annotate_validity(reviews, "rating_f").groupBy("error_code").count().collect()}
    assert codes == {"": 500, "rating": 344, "empty_text": 51, "long_text": 58, "likes": 47}


def test_windows_and_classes(spark, sf_small):
    windows = fx.windows(spark, sf_small)
    n, total = windows.agg(F.count("*"), F.round(F.sum("avg_rating"), 2)).first()
    assert (n, total) == (773, 2278.31)
    classes = w.classify_arrival(fx.reviews(spark, sf_small), fx.WIDTH_S, fx.LATENESS_S)
    assert {r.arrival_class: r["count"] for r in classes.groupBy("arrival_class").count().collect()} == {
        "on_time": 97, "late": 494, "dropped": 409}


def test_changelog_and_sliding_totals(spark, sf):
    changes = w.tumbling_changelog(fx.reviews(spark, sf), fx.WIDTH_S, fx.LATENESS_S)
    assert {r.is_update: r["count"] for r in changes.groupBy("is_update").count().collect()} == {
        False: 774, True: 4936}
    assert changes.select("product_id", "window_start").distinct().count() == 2185
    n, reviews = fx.slides(spark, sf).agg(F.count("*"), F.sum("review_count")).first()
    assert (n, reviews) == (2462, 28464)
