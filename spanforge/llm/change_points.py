"""Penalised change points of daily series, folded by higher-order functions in the JVM.

The daily series of a key is one array.  A fold over it keeps an array of
states, one for each end of a first part of the series: best cost, number of
segments, the predecessor (where the last segment of that best cut begins), and
running sums.  A day is added by weighing all places where a last segment that
ends there may begin.  Walking the predecessors back gives the segments, which
are exploded into rows.

Cost and number of segments are one number, so the least of them is the least
cost with the fewest segments, and the first place of it is the earliest start of
the last segment; the same holds for what is before that segment, which is how
ties are to be broken.  Places that a bound proves to be no best ones are passed
over.

Rows are summed up by key and day before they are shuffled, and again after, so
a key is at most as many rows as it has days, however many rows it had; the fold
is spread by key.  What a task holds of a key grows with its days, not its rows.

Sums of one series are taken in doubles where these hold every whole number that
arises (then quotients have the right floor too), and in decimals where they do
not, without bounds and with equal results.  A spread beyond 64 bits is weighed
as it is and null in the result.

Defined cases: rows without a value, a day or a wanted flag are not taken; a
null key is a key like others; repeated rows count as often as they are there;
days without rows between the first and the last are 0; values may be negative;
a series of fewer than twice the least length is one segment; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import common

LEAST_DAYS = 5
PENALTY = 10_000
FLAGS = ("kept", "swapped")
#: A cost that no cut reaches, for ends before which no segment fits; sums with it stay in 64 bits.
NEVER = 1 << 60
#: Days, and days times the largest absolute value, up to which doubles hold all whole numbers of a fold.
MOST_DAYS, MOST_ROOT = 40_000, 90_000_000
#: Type of sums that doubles do not hold.
EXACT = "decimal(38,0)"
#: Steps of the bounded fold from one anchor to the next.
STRIDE = 3
#: In doubles, a segment adds this to the cost of a cut, so that of equal costs the fewest segments are least.
ONE = "4.76837158203125E-7D"  # 2 to the power of -21


def spread_sql(n: str, s: str, q: str) -> str:
    """1 + floor of the variance, in decimals; div would have 64 bits only."""
    n = f"CAST({n} AS {EXACT})"
    above, below = f"({n} * {q} - {s} * {s})", f"({n} * {n})"
    return f"1 + CAST(({above} - {above} % {below}) / {below} AS {EXACT})"


def cost_sql(n: str, spread: str) -> str:
    return f"{n} * floor(1000 * ln({spread}))"


def _let(name: str, value: str, use: str) -> str:
    """use, with value computed once under a name; what use gives is copied, so it should be small."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _plain_fold_sql(least_days: int, penalty: int) -> str:
    """The states (cost, segments, from) of a series `days` of n_days values, in decimals: the state at e is that of the first e days, from 0."""
    size = "(size(acc) - i)"  # days from place i (of 0) up to this day, which is number size(acc)
    spread = f"CAST({spread_sql(size, '(d.s - x.s)', '(d.q - x.q)')} AS double)"
    key = f"x.key + ({cost_sql(size, spread)} + {penalty}) * (n_days + 1) + 1"
    weighed = f"transform(slice(acc, 1, size(acc) - {least_days - 1}), (x, i) -> {key})"
    best = _let("k", weighed, "named_struct('key', array_min(k), 'from', CAST(array_position(k, array_min(k)) AS int) - 1, 's', d.s, 'q', d.q)")
    none = f"named_struct('key', {NEVER}L, 'from', 0, 's', d.s, 'q', d.q)"
    sums = f"named_struct('s', CAST(element_at(acc, -1).s + v - low AS {EXACT}), 'q', CAST(element_at(acc, -1).q + CAST(v - low AS {EXACT}) * (v - low) AS {EXACT}))"
    step = _let("d", sums, f"array_append(acc, IF(size(acc) < {least_days}, {none}, {best}))")
    first = f"array(named_struct('key', -{penalty}L * (n_days + 1), 'from', 0, 's', CAST(0 AS {EXACT}), 'q', CAST(0 AS {EXACT})))"
    last = "transform(acc, x -> named_struct('cost', x.key div (n_days + 1), 'segments', CAST(pmod(x.key, n_days + 1) AS int), 'from', x.from))"
    return f"aggregate(days, {first}, (acc, v) -> {step}, acc -> {last})"


def _bounded_fold_sql(least_days: int, penalty: int) -> str:
    """The same states in doubles, with most places passed over that a bound shows to be no best ones.

    least_days ends are done in one step, which need only states before it.  In
    each STRIDE-th step all places are weighed at its last end, the anchor a.  For
    a place i and a later end j, cost(i, j) is at least cost(i, a) + cost(a, j)
    less a slack: without the floors it is, as squares add up and the logarithm is
    concave; one floor takes at most 1 a day, and the other 1000 / V a day, where
    V, 1 + the floor of the spread at j, is at least its value at a divided by far
    (the greatest ratio of days that arises).  So from the step after next on only
    those places are weighed whose bound is not above the cost by the last best
    place, and those that came after.

    Bounds leave out what is strictly worse only, so ties are as they would be.
    """
    later = (STRIDE + 1) * least_days  # ends of which an anchor is used are at most so much after it
    far = 1 + -(-later // least_days)

    def spread(d: str, x: str) -> str:
        m, s, q = (f"({d}.{c} - {x}.{c})" for c in "psq")
        return f"(1D + floor(({m} * {q} - {s} * {s}) / ({m} * {m})))"

    def cost(d: str, x: str) -> str:
        return f"({d}.p - {x}.p) * floor(1000D * ln({spread(d, x)}))"

    state = lambda key, start: f"named_struct('p', d.p, 's', d.s, 'q', d.q, 'key', {key}, 'from', {start})"
    at_least = lambda c: f"CAST(array_position({c}, array_min({c})) AS int) - 1"
    more = f"{penalty}D + {ONE}"
    seen = "concat(acc.states, acc.rest.fresh)"
    now = "element_at(r, -1)"
    ends = f"transform(sequence(1, size(vs)), k -> named_struct('p', {now}.p + k, 's', {now}.s + aggregate(slice(vs, 1, k), 0D, (t, v) -> t + v), 'q', {now}.q + aggregate(slice(vs, 1, k), 0D, (t, v) -> t + v * v)))"
    whole = f"(size(e) = {least_days} AND size(r) % {STRIDE * least_days} = 1)"
    others = _let("till", f"{now}.p + size(e) - IF({whole}, 1, 0)", "filter(e, d -> d.p <= till)")
    most = _let("i", f"r[{now}.from]", _let("a", f"r[size(acc.use) + {least_days - 1}]", f"array_max(transform(e, d -> i.key + {cost('d', 'i')} - {cost('d', 'a')}))"))
    near = f"IF(size(acc.use) = 0, slice(r, 1, 0), {_let('most', most, 'filter(slice(r, 1, size(acc.use)), (x, i) -> get(acc.use, i) <= most)')})"
    places = f"concat(near, slice(r, size(acc.use) + 1, CAST(d.p AS int) - {least_days - 1} - size(acc.use)))"
    best = _let("c", places, _let("k", f"transform(c, x -> x.key + {cost('d', 'x')})", state(f"array_min(k) + {more}", f"CAST(c[{at_least('k')}].p AS int)")))
    early = f"transform({others}, d -> IF(d.p < {least_days}, {state('1E15D', '0')}, {best}))"
    bounds = f"transform(v, (y, i) -> y - (d.p - i + {later}) * (1D + {far * 1000}D / get(spreads, i)) - 1D)"
    weighed = "transform(r, (x, i) -> x.key + (d.p - x.p) * floor(1000D * ln(get(spreads, i))))"
    last = _let("d", "element_at(e, -1)", _let("spreads", f"transform(r, x -> {spread('d', 'x')})", _let("v", weighed, f"named_struct('state', {state(f'array_min(v) + {more}', at_least('v'))}, 'w', {bounds})")))
    both = _let("o", last, f"named_struct('fresh', concat({early}, array(o.state)), 'w', o.w)")
    rest = _let("r", seen, _let("e", ends, _let("near", near, f"IF({whole}, {both}, named_struct('fresh', {early}, 'w', slice(acc.use, 1, 0)))")))
    step = f"named_struct('states', {seen}, 'use', IF(size(acc.rest.w) > 0, acc.rest.w, acc.use), 'rest', {rest})"
    zero = f"array(named_struct('p', 0D, 's', 0D, 'q', 0D, 'key', {-penalty}D, 'from', 0))"
    first = f"named_struct('states', slice({zero}, 1, 0), 'use', slice(array(0D), 1, 0), 'rest', named_struct('fresh', {zero}, 'w', slice(array(0D), 1, 0)))"
    told = f"transform({seen}, x -> named_struct('cost', CAST(floor(x.key) AS bigint), 'segments', CAST((x.key - floor(x.key)) / {ONE} AS int), 'from', x.from))"
    steps = f"transform(sequence(1, CAST(n_days AS int), {least_days}), b -> transform(slice(days, b, {least_days}), v -> CAST(v AS double)))"
    return f"aggregate({steps}, {first}, (acc, vs) -> {step}, acc -> {told})"


def daily_series(rows: DataFrame, key: str, day: Column, value: Column) -> DataFrame:
    """key, first_day, n_days and days: the sums of value of every day from the first to the last.

    Each row of the shuffles is a key's day.
    """
    by_day = rows.select(F.col(key), day.alias("_day"), value.cast("long").alias("_value")).groupBy(key, "_day").agg(F.sum("_value").alias("_value"))
    dealt = by_day.repartition(common.shuffle_partitions(rows.sparkSession), key)  # the fold is work by key: not to be put into few tasks for the little that is shuffled
    series = dealt.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_day", "_value"))).alias("_sparse"))
    gap = "coalesce(get(_sparse, i + 1)._day - x._day, 1)"
    filled = F.expr(f"flatten(transform(_sparse, (x, i) -> concat(array(x._value), array_repeat(0L, CAST({gap} - 1 AS int)))))")
    return series.select(key, F.col("_sparse")[0]["_day"].cast("long").alias("first_day"), filled.alias("days")).withColumn("n_days", F.size("days").cast("long"))


def segmented(series: DataFrame, key: str, least_days: int = LEAST_DAYS, penalty: int = PENALTY) -> DataFrame:
    """series (key, first_day, n_days, days) cut into segments: key, segment_no, first_day, n_days, total, spread, cost, n_segments, best_cost."""
    rows = series.withColumn("low", F.array_min("days")).withColumn("_most", F.greatest(F.abs(F.array_max("days")), F.abs("low")).cast("decimal(20,0)") * F.col("n_days"))
    narrow = (F.col("_most") <= MOST_ROOT) & (F.col("n_days") <= MOST_DAYS)
    states = F.when(narrow, F.expr(_bounded_fold_sql(least_days, penalty))).otherwise(F.expr(_plain_fold_sql(least_days, penalty)))
    folded = rows.withColumn("states", F.when(F.col("n_days") >= 2 * least_days, states))
    back = "aggregate(sequence(1, element_at(states, -1).segments), array(CAST(n_days AS int)), (ends, k) -> array_prepend(ends, states[ends[0]].from))"
    cut = folded.withColumn("bounds", F.coalesce(F.expr(back), F.expr("array(0, CAST(n_days AS int))")))
    placed = cut.select(
        key,
        F.col("first_day").alias("_first"),
        "low",
        F.col("days").alias("given"),
        F.posexplode(F.expr("transform(slice(bounds, 1, size(bounds) - 1), (b, i) -> named_struct('from', b, 'to', bounds[i + 1]))")).alias("_at", "_cut"),
        (F.size("bounds") - 1).cast("long").alias("n_segments"),
        F.expr("element_at(states, -1).cost").alias("_best"),
    )
    own = placed.withColumn("_days", F.slice("given", F.col("_cut.from") + 1, F.col("_cut.to") - F.col("_cut.from")))
    sums = own.select(
        key,
        (F.col("_at") + 1).cast("int").alias("segment_no"),
        (F.col("_first") + F.col("_cut.from")).alias("first_day"),
        F.size("_days").cast("long").alias("n_days"),
        F.expr("aggregate(_days, 0L, (s, v) -> s + v)").alias("total"),
        F.expr(f"aggregate(_days, CAST(0 AS {EXACT}), (s, v) -> CAST(s + v - low AS {EXACT}))").alias("_s"),
        F.expr(f"aggregate(_days, CAST(0 AS {EXACT}), (s, v) -> CAST(s + CAST(v - low AS {EXACT}) * (v - low) AS {EXACT}))").alias("_q"),
        "n_segments",
        "_best",
    )
    costed = sums.withColumn("_spread", F.expr(spread_sql("n_days", "_s", "_q"))).withColumn("spread", F.expr("try_cast(_spread AS bigint)"))
    mine = costed.withColumn("cost", F.expr(f"CAST({cost_sql('n_days', 'CAST(_spread AS double)')} AS bigint)"))
    mine = mine.withColumn("best_cost", F.coalesce("_best", F.col("cost")))
    return mine.select(key, "segment_no", "first_day", "n_days", "total", "spread", "cost", "n_segments", "best_cost")


def change_points(rows: DataFrame, key: str, day: Column, value: Column, least_days: int = LEAST_DAYS, penalty: int = PENALTY) -> DataFrame:
    """The segments of the daily sums of value of each key; day is a number of days."""
    return segmented(daily_series(rows, key, day, value), key, least_days, penalty)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of every vendor's daily quantities, of lines that were kept or swapped."""
    lines = common.table(spark, sf_dir, "sale_lines")
    taken = lines.where(F.col("flag").isin(*FLAGS) & F.col("quantity").isNotNull() & F.col("shipped_at").isNotNull())
    return change_points(taken, "vendor_id", F.unix_date(F.to_date("shipped_at")), F.col("quantity"))


_WEIGHED = f"""keys[i + 1] + ((j - i) * floor(1000 * ln((1 + ((j - i) * (q[j + 1] - q[i + 1]) - (s[j + 1] - s[i + 1]) * (s[j + 1] - s[i + 1])) // ((j - i) * (j - i)))::DOUBLE))::BIGINT + {PENALTY}) * (n + 1) + 1"""
ORACLE_SQL = f"""WITH RECURSIVE taken AS (
    SELECT vendor_id, shipped_at::DATE AS d, sum(quantity)::BIGINT AS v FROM sale_lines WHERE flag IN ({", ".join(f"'{f}'" for f in FLAGS)}) AND quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY 1, 2),
calendar AS (SELECT vendor_id, unnest(range(min(d), max(d) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS d FROM taken GROUP BY 1),
daily AS (SELECT c.vendor_id, c.d, coalesce(t.v, 0) AS v FROM calendar c LEFT JOIN taken t ON t.vendor_id IS NOT DISTINCT FROM c.vendor_id AND t.d = c.d),
running AS (SELECT vendor_id, d, sum(v) OVER w AS s, sum(v * v) OVER w AS q FROM daily WINDOW w AS (PARTITION BY vendor_id ORDER BY d)),
series AS (SELECT vendor_id, (min(d) - DATE '1970-01-01')::BIGINT AS first, count(*)::BIGINT AS n, list_prepend(0, list(s::BIGINT ORDER BY d)) AS s, list_prepend(0, list(q::BIGINT ORDER BY d)) AS q FROM running GROUP BY 1),
fold(vendor_id, first, n, s, q, j, keys, froms) AS (
    SELECT vendor_id, first, n, s, q, 0::BIGINT, [(-{PENALTY} * (n + 1))::BIGINT], [0::BIGINT] FROM series
    UNION ALL
    SELECT vendor_id, first, n, s, q, j, list_append(keys, coalesce(list_min(c), {NEVER}::BIGINT)), list_append(froms, coalesce(list_position(c, list_min(c)), 1) - 1::BIGINT) FROM (
        SELECT *, list_transform(range(0, greatest(j - {LEAST_DAYS - 1}, (n < {LEAST_DAYS})::BIGINT)), lambda i: {_WEIGHED}) AS c
        FROM (SELECT vendor_id, first, n, s, q, j + 1 AS j, keys, froms FROM fold WHERE j < n))),
ends AS (SELECT * FROM fold WHERE j = n),
walk AS (
    SELECT *, n AS b, froms[n + 1] AS a, keys[n + 1] % (n + 1) AS no FROM ends
    UNION ALL SELECT vendor_id, first, n, s, q, j, keys, froms, a, froms[a + 1], no - 1 FROM walk WHERE a > 0),
cut AS (SELECT *, b - a AS days, s[b + 1] - s[a + 1] AS total, q[b + 1] - q[a + 1] AS squares FROM walk),
spread_ AS (SELECT *, 1 + (days * squares - total * total) // (days * days) AS spread FROM cut)
SELECT vendor_id, no::INTEGER AS segment_no, first + a AS first_day, days AS n_days, total, spread, days * floor(1000 * ln(spread::DOUBLE))::BIGINT AS cost,
    keys[n + 1] % (n + 1) AS n_segments, keys[n + 1] // (n + 1) AS best_cost FROM spread_"""
