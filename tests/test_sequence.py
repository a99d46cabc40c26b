import random

from pyspark.sql import functions as F

from quillforge.operators import sequence


def expected(rows, inclusive):
    out, last = {}, {}
    for g, n, i, v in sorted(rows, key=lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2])):
        if inclusive and v is not None:
            last[g] = v
        out[i] = last.get(g)
        if v is not None:
            last[g] = v
    return out


def test_carries_over_chunks(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(30_000)]), i, rng.choice([None, None, None, f"v{i}"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, n int, i int, v string")
    for inclusive in (True, False):
        got = sequence.with_last(df, F.col("v"), ["g"], ["n", "i"], "carried", inclusive)
        assert {r.i: r.carried for r in got.collect()} == expected(rows, inclusive)
        assert got.columns == ["g", "n", "i", "v", "carried"]
    assert sequence.with_last(df.limit(0), F.col("v"), ["g"], ["n", "i"], "carried").count() == 0
