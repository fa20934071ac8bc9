"""Small inputs with every awkward case, and what they must turn into, computed plainly."""

import random

from pyspark.sql import Row, types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # Names that operators might use themselves.
    *[T.StructField(c, T.StringType()) for c in ("doc", "line", "key", "n", "span", "ids", "piece", "node", "comp", "id", "_id", "size")],
])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
SHARED = "This line is shared by MANY documents."


def frame(spark, rows):
    extra = len(SCHEMA) - 2
    return spark.createDataFrame([Row(i, t, *["x"] * extra) for i, t in rows], SCHEMA)


def edge_rows():
    rnd = random.Random(7)
    prose = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    long = "\n".join(prose(12) for _ in range(1500))
    base = prose(60)
    rows = [
        (1, None), (2, ""), (3, " \t "), (4, "one"), (5, "one two"), (6, base), (7, base), (8, base.upper()),
        (9, base + " omega"), (10, "omega " + base), (11, long), (12, long + "\n" + SHARED),
        (13, f"{SHARED}\nown line of thirteen\n{SHARED}"), (14, f"  {SHARED.lower()}\t\nshort\n"), (14, f"  {SHARED.lower()}\t\nshort\n"),
        (None, f"{SHARED}\nnobody's line"), (None, None), (15, "x" * 30_000), (16, "日本語 テスト ✓ İ Σας"), (17, "\n\n\n"),
    ]
    return rows + [(100 + i, prose(40)) for i in range(30)]
