import math
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.functions import sketches as sk
from tallyloom.session import fresh_folder

ROWS = "at timestamp, shop string, price double, pieces long"
T0 = datetime(2024, 3, 1)
PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]


def sales(seed, days, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        price = rng.choice([None, math.nan, 0.0, 1.0, rng.lognormvariate(0, 3), -rng.random(), rng.random() * 1e9])
        rows.append((T0 + timedelta(days=rng.randrange(days), hours=rng.random() * 24), rng.choice("ab"), price, rng.randrange(50)))
    return rows


def test_ranks_are_off_by_no_more_than_stated(spark):
    rows = sales(1, 20, 60000)
    df = spark.createDataFrame(rows, ROWS)
    sketches = sk.day_sketches(df, "at", ["price", "pieces"], size=200)
    found = sk.sketched_quantiles(sketches, PROBS).cache()
    assert found.count() == 2 * len(PROBS)
    error = 2 * sk.rank_error(200)
    for r in sk.true_ranks(df, found, ["price", "pieces"]).collect():
        assert r.below - error <= r.p <= r.upto + error
    known = sorted(p for _, _, p, _ in rows if p is not None and not math.isnan(p))
    ends = {r.p: r.quantile for r in found.where("measure = 'price'").collect()}
    assert (ends[0.0], ends[1.0]) == (known[0], known[-1])
    assert {r.n for r in found.where("measure = 'price'").collect()} == {len(known)}
    assert sk.rank_error(2000) < 0.0015


def test_true_ranks(spark):
    df = spark.createDataFrame([(T0, "a", float(v), 1) for v in (1, 2, 2, 3)], ROWS)
    found = spark.createDataFrame([("price", 0.5, 2.0, 4)], "measure string, p double, quantile double, n long")
    r = sk.true_ranks(df, found, ["price"]).first()
    assert (r.below, r.upto) == (0.25, 0.75)


def test_a_new_day_reads_that_day_only(spark):
    path = fresh_folder(spark, "sketches")
    old, new = sales(2, 5, 3000), [(T0 + timedelta(days=9, minutes=i), "a", float(i), i) for i in range(100)]
    sk.write_day_sketches(sk.day_sketches(spark.createDataFrame(old, ROWS), "at", ["pieces"], ["shop"]), path)
    before = {(r.f, r.t) for r in files_of(spark, path)}
    for _ in range(2):  # a corrected day takes the place of the first
        sk.write_day_sketches(sk.day_sketches(spark.createDataFrame(new, ROWS), "at", ["pieces"], ["shop"]), path)
    after = {(r.f, r.t) for r in files_of(spark, path)}
    assert before < after and {f.split("day=")[1][:10] for f, _ in after - before} == {"2024-03-10"}
    found = {r.shop: (r.quantile, r.n) for r in sk.sketched_quantiles(sk.read_day_sketches(spark, path), [1.0], ["shop"]).collect()}
    want = {s: [p for _, shop, _, p in old + new if shop == s] for s in "ab"}
    assert found == {s: (max(v), len(v)) for s, v in want.items()}


def files_of(spark, path):
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()


def test_nothing_to_sketch(spark):
    none = sk.day_sketches(spark.createDataFrame([(T0, "a", None, None), (T0, "a", math.nan, None)], ROWS), "at", ["price", "pieces"])
    assert none.count() == 0 and sk.sketched_quantiles(none, [0.5]).count() == 0
