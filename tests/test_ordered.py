import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from folianth.operators.contains import contains_join
from folianth.operators.ordered import numbered, scan


def test_scan_equals_plain_windows(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([None, *range(50)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    got = scan(df, ["k"], ["n"], F.floor(F.col("n") / 16), previous={"p": F.col("v")}, following={"f": F.col("v")}, max_before={"m": F.col("v")}, sum_before={"s": F.lit(1).cast("bigint")})
    w = Window.partitionBy("k").orderBy("n")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("f"), F.max("v").over(before).alias("m"), F.coalesce(F.count(F.lit(1)).over(before), F.lit(0)).alias("s"))
    key = lambda r: (str(r.k), r.n)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert [r.item_no for r in numbered(df.where("k = 'b'"), ["k"], ["n"], F.floor(F.col("n") / 16)).orderBy("n").collect()] == list(range(1, df.where("k = 'b'").count() + 1))
    assert scan(df.limit(0), ["k"], ["n"], F.lit(0), previous={"p": F.col("v")}).count() == 0


def test_contains_join(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))) for i in range(40)] + [(99, None)]
    needles = [("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))),) for _ in range(40)] + [(None,)]
    a, b = spark.createDataFrame(needles, "needle string").distinct(), spark.createDataFrame(texts, "id int, body string")
    got = {(r.needle, r.id) for r in contains_join(a, "needle", b, "body", "id").collect()}
    assert got == {(n, i) for (n,) in needles if n for i, t in texts if t and n in t}
    assert contains_join(a.limit(0), "needle", b, "body", "id").count() == 0
