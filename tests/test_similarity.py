from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spanforge.operators import segment as S
from spanforge.operators import similarity as X


def words(rng, n, alphabet="abcd"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_contained_pairs_equal_all_pairs(spark):
    rng = random.Random(1)
    a = [(k, words(rng, rng.randint(1, 24))) for k in (0, 1) for _ in range(60)]
    b = [(k, s[rng.randint(0, 1) : len(s) - rng.randint(0, 2)]) for k, s in a[::2]] + [(k, words(rng, rng.randint(1, 24))) for k in (0, 1) for _ in range(40)] + [(0, ""), (1, "a"), (1, "ab")]
    left, right = (spark.createDataFrame(sorted(set(x)), "doc_id long, letters string") for x in (a, b))
    got = {(r.doc_id, r.a, r.b, round(r.ratio, 9)) for r in X.contained_pairs(left, right, "doc_id").collect()}
    want = {(k, s, t, round(min(len(s), len(t)) / max(len(s), len(t)), 9)) for k, s in a for m, t in b if k == m and s and t and (s in t or t in s) and min(len(s), len(t)) >= 0.8 * max(len(s), len(t))}
    assert got == want and len(want) > 40


def test_anchors_keep_a_large_key_small(spark):
    """Titles that share all but their number: work follows what meets, not the square."""
    a = spark.range(3000).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("regulamentodotrabalho"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("letters"))
    b = a.select("doc_id", F.concat("letters", F.lit("x")).alias("letters"))
    assert X.contained_pairs(a, b, "doc_id").count() == 3000


def grams(s):
    return {s[i : i + 3] for i in range(len(s) - 2)}


def jaccard(s, t):
    return len(grams(s) & grams(t)) / len(grams(s) | grams(t))


@pytest.mark.parametrize("most", [10**6, 0])
def test_similar_pairs_equal_all_pairs(spark, monkeypatch, most):
    """Both ways of the join, broadcast and shuffled."""
    monkeypatch.setattr(X, "MOST_TOKENS", most)
    rng = random.Random(2)
    base = [words(rng, rng.randint(20, 60), "abcdefgh0123") for _ in range(40)]
    changed = []
    for s in base:
        for _ in range(3):
            at, n = rng.randint(0, len(s) - 8), rng.randint(1, 8)
            changed.append(s[:at] + words(rng, n, "xyz") + s[at + n :])
    a = spark.createDataFrame([(i % 2, i, s) for i, s in enumerate(base)], "doc long, i int, a string")
    b = spark.createDataFrame([(j % 2, j, s) for j, s in enumerate([*changed, *base[:3], *base[:3]])], "doc long, j int, b string")
    rows = b.collect()
    got = sorted((r.i, r.j, round(r.jaccard, 9)) for r in X.similar_pairs(a.drop("doc"), b.drop("doc")).collect())
    want = sorted((i, r.j, round(jaccard(s, r.b), 9)) for i, s in enumerate(base) for r in rows if jaccard(s, r.b) >= 0.6)
    assert got == want and len(want) > 40
    keyed = sorted((r.doc, r.i, r.j) for r in X.similar_pairs(a, b, "doc").collect())
    assert keyed == sorted((i % 2, i, r.j) for i, s in enumerate(base) for r in rows if r.doc == i % 2 and jaccard(s, r.b) >= 0.6)


def test_ten_times_the_lines(spark):
    """The right side is read once, and ten times its lines give ten times the pairs."""
    rng = random.Random(3)
    lines = [" ".join(words(rng, rng.randint(3, 9), "aeioustrn") for _ in range(9)) for _ in range(60)]
    left = spark.createDataFrame([(i, 0, t) for i, t in enumerate(lines[:20])], "a long, a_line int, text string")
    right = spark.createDataFrame([(i, 1, t + " end") for i, t in enumerate(lines)], "b long, b_line int, text string")
    once = S.similar_lines(left, right)
    many = S.similar_lines(left, right.crossJoin(spark.range(10).select(F.col("id").alias("c"))).select((F.col("b") * 10 + F.col("c")).alias("b"), "b_line", "text"))
    assert once.count() >= 20 and many.count() == 10 * once.count()
    assert S.similar_lines(left.where("false"), right).count() == 0 and S.similar_lines(left, right.where("false")).count() == 0
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange hash" not in plan


def test_best_places_equal_a_greedy_scan(spark):
    rng = random.Random(4)
    edges = {(k, rng.randint(0, 12), rng.randint(0, 12)): rng.choice([0.8, 0.9, 1.0]) for k in (0, 1) for _ in range(60)}
    size = {(k, a): rng.choice([5, 6, 7]) for k in (0, 1) for a in range(13)}
    rows = [(k, a, b, r, size[k, a]) for (k, a, b), r in edges.items()]
    want = set()
    for k in (0, 1):
        taken = set()
        for a in sorted(range(13), key=lambda a: (-size[k, a], a)):
            free = [(-r, b) for (kk, aa, b), r in edges.items() if kk == k and aa == a and b not in taken]
            if free:
                taken.add(min(free)[1])
                want.add((k, a, min(free)[1]))
    got = S.best_places(spark.createDataFrame(rows, "doc long, a long, b long, ratio double, size int"), "doc")
    assert {(r.doc, r.a, r.b) for r in got.collect()} == want
    assert S.best_places(spark.createDataFrame([], "doc long, a long, b long, ratio double, size int"), "doc").count() == 0


def test_points_within_ranges(spark):
    points = spark.createDataFrame([(0, p, f"p{p}") for p in range(0, 40, 3)] + [(1, 5, "x"), (None, 5, "y")], "doc_id long, start long, name string")
    ranges = spark.createDataFrame([(0, 3, 9, "a"), (0, 9, 10, "b"), (0, 30, 36, "c"), (None, 0, 9, "d")], "doc_id long, start long, stop long, name string")
    got = sorted((r.name, r._name) for r in S.within(points, ranges, "doc_id", kept=["name"]).where("_name is not null").collect())
    assert got == [("p3", "a"), ("p30", "c"), ("p33", "c"), ("p6", "a"), ("p9", "b"), ("y", "d")]


def test_titles_at_one_start_are_one_place(spark):
    wanted = spark.createDataFrame([(0, 1, "Alpha"), (0, 2, "Beta x"), (0, 3, "Gamma rays"), (0, 4, "Delta")], "doc_id long, item long, title string")
    titles = spark.createDataFrame([(0, 5, "Alpha"), (0, 5, "BETAX"), (0, 5, "Gamma ray"), (0, 9, "D e l t a"), (0, 9, "Gamma ray")], "doc_id long, start long, title string")
    assert [(r.item, r.start) for r in S.title_matches(wanted, titles).orderBy("item").collect()] == [(1, 5), (4, 9)]


def test_sets_are_confirmed_after_the_join(spark):
    """The confirmation is no condition of the join, where it came before the cheap ones and was worked out for all that met."""
    a = spark.createDataFrame([(0, "abcdefgh")], "i int, a string")
    b = spark.createDataFrame([(0, "abcdefgh")], "j int, b string")
    joins = [x for x in X.similar_pairs(a, b)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert len(joins) == 1 and "bit_count" in joins[0] and "regexp_extract_all" not in joins[0] and "array_intersect" not in joins[0]


def test_a_join_by_key_broadcasts_nothing(spark):
    """Rows of long letters, one for each token and all in the driver, were more than it holds."""
    rows = spark.createDataFrame([(0, "abcdefgh")], "doc long, a string")
    plan = X.similar_pairs(rows, rows.withColumnRenamed("a", "b"), "doc")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and "posexplode" not in plan


@pytest.mark.parametrize("few", [0, 40, 10**6])
def test_contained_pairs_of_small_and_large_keys(spark, monkeypatch, few):
    """Each with each in small keys, the index in large ones: the same pairs."""
    monkeypatch.setattr(X, "FEW", few)
    rng = random.Random(5)
    a = {(k, words(rng, rng.randint(1, 12), "ab")) for k, n in ((0, 8), (1, 40)) for _ in range(n)} | {(None, "abc")}
    b = {(k, s + "b") for k, s in a} | {(k, s[1:]) for k, s in a} | a
    left, right = (spark.createDataFrame(sorted(x, key=repr), "doc_id long, letters string") for x in (a, b))
    got = sorted((r.doc_id, r.a, r.b, round(r.ratio, 9)) for r in X.contained_pairs(left, right, "doc_id").collect())
    assert got == sorted((k, s, t, round(min(len(s), len(t)) / max(len(s), len(t)), 9)) for k, s in a for m, t in b if k is not None and k == m and s and t and (s in t or t in s) and min(len(s), len(t)) >= 0.8 * max(len(s), len(t)))


def test_best_windows_compare_a_text_once(spark):
    """Organisations that share a text are not each paired with every window, and not sorted where they were read."""
    orgs = spark.createDataFrame([(0, 1, "large ring"), (0, 2, "large ring"), (0, 3, "none"), (0, 4, None), (1, 1, "large ring")], "doc_id long, id long, text string")
    windows = spark.createDataFrame([(0, 7, "ring"), (0, 8, "large"), (0, 9, "the large ring"), (1, 2, "bolt")], "doc_id long, idx long, name string")
    found = S.best_windows(orgs, windows)
    assert sorted((r.doc_id, r.id, r.idx, r.status) for r in found.collect()) == [(0, 1, 9, "org_anchored"), (0, 2, 9, "org_anchored"), (0, 3, 7, "org_unanchored"), (0, 4, 7, "org_unanchored"), (1, 1, 2, "org_unanchored")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3 and "RepartitionByExpression [doc_id" in plan
