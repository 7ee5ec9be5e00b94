from __future__ import annotations

from pyspark.sql import functions as F

from tripmart.llm.tables import bounded_rows, settled, stored


def test_bounded_rows_are_a_fixed_choice(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    one = sorted(r.k for r in bounded_rows(rows.repartition(7), "k", 500).collect())
    other = sorted(r.k for r in bounded_rows(rows.orderBy(F.desc("k")), "k", 500).collect())
    order = rows.orderBy(F.pmod(F.xxhash64("k"), F.lit(1 << 53)), "k").limit(500)
    assert one == other == sorted(r.k for r in order.collect())
    assert bounded_rows(rows.limit(30), "k", 500).count() == 30 and bounded_rows(rows.limit(0), "k", 5).count() == 0


def test_settled_removes_what_led_to_the_result(spark):
    from pathlib import Path

    steps = []

    def build():
        steps.append(stored(spark.range(5), "step"))
        return steps[0].where("id > 2")

    result = settled(spark, build, "result")
    (folder,) = {Path(path.removeprefix("file:")).parent for path in steps[0].inputFiles()}
    assert sorted(r.id for r in result.collect()) == [3, 4] and not folder.exists()
