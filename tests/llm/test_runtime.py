import threading

from cohortmark.llm.runtime import free_names, passing, stored


def test_each_thread_deletes_its_own_tables(spark):
    first, second, kept = threading.Event(), threading.Event(), []

    def one():
        with passing(spark):
            stored(spark.range(3).toDF("a"), "one")
            first.set()
            second.wait(60)

    def two():
        first.wait(60)
        with passing(spark):
            kept.append(stored(spark.range(5).toDF("a"), "two"))
            second.set()
            t.join()
            kept.append(kept[0].count())

    t, u = threading.Thread(target=one), threading.Thread(target=two)
    t.start(), u.start()
    u.join(120)
    assert kept[1] == 5


def test_free_names(spark):
    df = spark.range(1).selectExpr("id AS ROW", "id AS row_")
    assert free_names(df, "row", "other", "row") == ["row__", "other", "row___"]
