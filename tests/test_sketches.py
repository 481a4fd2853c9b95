"""Mergeable profiles: halves against the whole, exact values, parts written again, edge cases."""

import random

from pyspark.sql import functions as F

from tunemill.operators import sketches as sk

SCHEMA = "source string, day int, text string, n long"


def rows(n=6000, seed=3):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.randint(1, 4),
             rng.choice([None, "", " \t", "x" * rng.randint(1, 900), f"t{rng.randint(0, 2000)}"]),
             rng.choice([None, rng.randint(-50, 5000)])) for _ in range(n)]


def profile(df, part):
    return sk.read_profile(sk.merge_parts(sk.part_profile(df, part, ("text", "n"))))


def by_key(df):
    return {(r.source, r.field): r for r in df.collect()}


def test_halves_merged_equal_the_whole(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    parts = sk.part_profile(df, F.col("day"), ("text", "n"))
    halves = sk.merge_parts(parts.withColumn("half", F.col("part") <= 2), "half")
    halved, direct, whole = (by_key(x) for x in (
        sk.read_profile(sk.merge_parts(halves)), sk.read_profile(sk.merge_parts(parts)), profile(df, F.lit(1))))
    assert set(halved) == set(whole) == {(s, f) for s in ("a", "b", None) for f in ("text", "n")}
    for k, r in whole.items():
        exact = [c for c in r.asDict() if c not in ("p50", "p90")]
        assert [halved[k][c] for c in exact] == [direct[k][c] for c in exact] == [r[c] for c in exact]


def test_against_plain_python(spark):
    data = rows()
    out = by_key(profile(spark.createDataFrame(data, SCHEMA), F.col("day")))
    for s in ("a", "b", None):
        for f, at in (("text", 2), ("n", 3)):
            r, v = out[s, f], [x[at] for x in data if x[0] == s]
            here = [x for x in v if x is not None]
            size = sorted(len(x) if f == "text" else x for x in here)
            assert (r.n_rows, r.n_null, r.min_len, r.max_len) == (len(v), len(v) - len(here), size[0], size[-1])
            assert r.n_blank == (sum(not x.strip() for x in here) if f == "text" else 0)
            assert r.avg_len == round(sum(size) / len(size), 4) or abs(r.avg_len - sum(size) / len(size)) < 1e-4
            assert abs(r.n_distinct - len(set(here))) <= sk.DISTINCT_BOUND * len(set(here))
            for p, q in ((r.p50, 0.5), (r.p90, 0.9)):
                assert sum(x < p for x in size) / len(size) <= q + sk.RANK_BOUND
                assert sum(x <= p for x in size) / len(size) >= q - sk.RANK_BOUND


def test_errors_are_seen(spark):
    """A wrong estimate is reported as one; a right one is not."""
    df = spark.createDataFrame([("a", 1, "x" * i, i) for i in range(1, 101)], SCHEMA)
    given = profile(df, F.col("day"))
    good = by_key(sk.profile_errors(df, given, ("text", "n")))
    assert all(r.distinct_error <= sk.DISTINCT_BOUND and r.p50_error <= sk.RANK_BOUND and r.exact_distinct == 100
               for r in good.values())
    bad = by_key(sk.profile_errors(df, given.withColumn("p50", F.lit(70)).withColumn("n_distinct", F.lit(50)), ("text", "n")))
    assert all(abs(r.p50_error - 0.19) < 1e-9 and r.distinct_error == 0.5 for r in bad.values())


def test_parts_are_replaced_not_added(spark, tmpdir_path):
    df = spark.createDataFrame(rows(500), SCHEMA)
    path = tmpdir_path + "/profile"
    sk.write_parts(sk.part_profile(df, F.col("day"), ("text",)), path)
    again = sk.write_parts(sk.part_profile(df.where("day = 2"), F.col("day"), ("text",)), path)
    new = df.limit(40).withColumn("day", F.lit(9))
    more = sk.write_parts(sk.part_profile(new, F.col("day"), ("text",)), path)
    assert again.where("part < 9").agg(F.sum("n_rows")).first()[0] == 500
    assert sk.merge_parts(more).agg(F.sum("n_rows")).first()[0] == 540


def test_nulls_clashing_names_and_empty(spark, tmpdir_path):
    df = spark.createDataFrame([(None, None, None), ("a", None, None)], "source string, field string, value string")
    out = by_key(sk.write_parts(sk.part_profile(df, F.lit(None).cast("int"), ("field", "value")), tmpdir_path + "/p")
                 .transform(sk.merge_parts).transform(sk.read_profile))
    assert len(out) == 4
    assert all((r.n_rows, r.n_null, r.min_len, r.avg_len, r.n_distinct, r.p50) == (1, 1, None, None, 0, None)
               for r in out.values())
    errors = sk.profile_errors(df, sk.read_profile(sk.merge_parts(sk.part_profile(df, F.lit(1), ("value",)))), ("value",))
    assert [(r.exact_distinct, r.distinct_error, r.p50_error) for r in errors.collect()] == [(0, 0.0, 0.0)] * 2
    none = sk.write_parts(sk.part_profile(df.limit(0), F.lit(1), ("value",)), tmpdir_path + "/none")
    assert sk.read_profile(sk.merge_parts(none)).count() == 0
