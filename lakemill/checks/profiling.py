"""Samples, quantiles, bounds and histograms."""

from pyspark.sql import functions as F

from lakemill.checks.registry import job
from lakemill.operators import histograms as H
from lakemill.operators import profiling as P
from lakemill.operators import quality, sampling

FEATURES = ["fare_amount", "mta_tax", "tolls_amount", "total_amount", "trip_distance", "trip_duration_minutes"]
MINUTES = "(epoch(dropoff_datetime)::bigint - epoch(pickup_datetime)::bigint) / 60e0"
# Features as one long table.
LONG = f"""feats AS (SELECT * REPLACE (trip_distance::double AS trip_distance), {MINUTES} AS trip_duration_minutes FROM trips),
long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::double AS x FROM feats" for c in FEATURES)})"""


def rank(q, condition="true"):
    """Smallest value with at least a share q of the rows at or below it."""
    return f"quantile_disc(x, {q}) FILTER (WHERE {condition})"


QUARTILES = f"""qs AS (SELECT feature, {rank(0.01)} AS q01, {rank(0.25)} AS q25, {rank(0.5)} AS q50, {rank(0.75)} AS q75,
    {rank(0.99)} AS q99, {rank(0.995)} AS q995 FROM long WHERE x IS NOT NULL GROUP BY feature),
first AS (SELECT *, CASE WHEN q75 - q25 <= 0 THEN q99 ELSE least(q99, q75 + 3 * (q75 - q25)) END AS hi1 FROM qs)"""
TWO_STAGE = f"""{LONG}, {QUARTILES},
tails AS (SELECT feature, quantile_disc(x, 0.25) AS t25, quantile_disc(x, 0.75) AS t75, quantile_disc(x, 0.99) AS t99
  FROM long JOIN first USING (feature) WHERE x > hi1 GROUP BY feature),
bounds AS (SELECT feature, CASE WHEN hi <= 0 THEN 1 ELSE hi END::double AS hi FROM (
  SELECT feature, greatest(hi1, coalesce(CASE WHEN t75 - t25 > 0 THEN least(t99, t75 + 3 * (t75 - t25)) ELSE t99 END, hi1)) AS hi
  FROM first LEFT JOIN tails USING (feature)) b)"""


def features(d):
    """Numeric features of the trips; the measure may be negative here."""
    minutes = (F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")) / F.lit(60.0)
    timed = d.view("trips").withColumn("trip_duration_minutes", minutes)
    return timed.select(*[F.col(c).cast("double").alias(c) for c in FEATURES])


def bounds_frame(d, bounds):
    rows = [(c, low, high) for c, (low, high) in bounds.items()]
    return d.spark.createDataFrame(rows, "feature string, lo double, hi double")


@job("sample_fraction")
def _(d):
    return sampling.sample_fraction(d.table("lineitem"), 0.2, 42)


@job("shuffled_sample")
def _(d):
    return sampling.shuffled_sample(d.table("lineitem"), 0.02, 42)


@job(
    "sample_to_target_bytes",
    """WITH sized AS (
         SELECT *, ('0x' || md5('42:' || event_id)[1:12])::BIGINT AS place,
           length('{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","user_id":' || user_id
             || ',"event_type":"' || event_type || '","value":' || value::varchar || ',"props":"'
             || replace(props, '"', '\\"') || '"}')::BIGINT AS size
         FROM events
       ), summed AS (
         SELECT *, coalesce(sum(size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(size) OVER () AS total FROM sized
       )
       SELECT event_id, ts, user_id, event_type, value, props FROM summed WHERE before < total // 4""",
)
def _(d):
    """A quarter of the events by the bytes of their JSON; milliseconds in the times, so that SQL measures the same."""
    events = d.table("events")
    text = F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"})
    total = events.agg(F.sum(F.length(text))).first()[0]
    return sampling.sample_to_bytes(events, total // 4, 42, F.col("event_id"), F.length(text))


@job("row_cap")
def _(d):
    return sampling.row_cap(d.table("lineitem"), 50_000)


@job("sorted_values", "SELECT tolls_amount FROM trips WHERE tolls_amount IS NOT NULL ORDER BY tolls_amount")
def _(d):
    return sampling.sorted_values(d.view("trips"), "tolls_amount")


@job(
    "approx_quantiles",
    f"WITH {LONG}, {QUARTILES} SELECT feature, q01, q25, q50, q75, q99 FROM qs",
)
def _(d):
    found = P.quantiles(features(d), FEATURES, P.PROBABILITIES, 0.0)
    rows = [(c, *q) for c, q in found.items()]
    return d.spark.createDataFrame(rows, "feature string, q01 double, q25 double, q50 double, q75 double, q99 double")


@job("approx_quantiles_sketch")
def _(d):
    found = P.quantiles(features(d), FEATURES, P.PROBABILITIES, 0.02)
    rows = [(c, *q) for c, q in found.items()]
    return d.spark.createDataFrame(rows, "feature string, q01 double, q25 double, q50 double, q75 double, q99 double")


@job("outlier_bounds_two_stage_iqr", f"WITH {TWO_STAGE} SELECT feature, 0::double AS lo, hi FROM bounds")
def _(d):
    return bounds_frame(d, P.outlier_bounds(features(d), FEATURES, "two_stage_iqr", 0.0))


@job("outlier_bounds_two_stage_iqr_sketch")
def _(d):
    return bounds_frame(d, P.outlier_bounds(features(d), FEATURES, "two_stage_iqr", 0.02))


@job(
    "outlier_bounds_coverage",
    f"""WITH {LONG}, {QUARTILES} SELECT feature, 0::double AS lo,
          CASE WHEN greatest(hi1, q995) <= 0 THEN 1 ELSE greatest(hi1, q995) END::double AS hi FROM first""",
)
def _(d):
    return bounds_frame(d, P.outlier_bounds(features(d), FEATURES, "coverage_quantile", 0.0))


@job(
    "outlier_bounds_hard_cap",
    f"""WITH {LONG}, {QUARTILES} SELECT feature, 0::double AS lo,
          greatest(hi1, CASE feature WHEN 'mta_tax' THEN 20 ELSE 200 END)::double AS hi FROM first""",
)
def _(d):
    return bounds_frame(d, P.outlier_bounds(features(d), FEATURES, "hard_cap", 0.0))


EVENT_BOUND = """vals AS (SELECT fare_amount AS x FROM rt_events WHERE fare_amount IS NOT NULL),
q AS (SELECT quantile_disc(x, 0.25) AS q25, quantile_disc(x, 0.75) AS q75, quantile_disc(x, 0.99) AS q99 FROM vals),
h AS (SELECT CASE WHEN q75 - q25 <= 0 THEN q99 ELSE least(q99, q75 + 3 * (q75 - q25)) END AS hi1 FROM q),
t AS (SELECT quantile_disc(x, 0.25) AS t25, quantile_disc(x, 0.75) AS t75, quantile_disc(x, 0.99) AS t99
  FROM vals WHERE x > (SELECT hi1 FROM h)),
ub AS (SELECT greatest(10, hi1, coalesce(CASE WHEN t75 - t25 > 0 THEN least(t99, t75 + 3 * (t75 - t25)) ELSE t99 END, hi1))::double
  AS bound FROM h, t)"""


@job("upper_bound_single", f"WITH {EVENT_BOUND} SELECT bound AS upper_bound FROM ub")
def _(d):
    bound = P.upper_bound(d.view("rt_events"), "fare_amount", 0.0)
    return d.spark.createDataFrame([(bound,)], "upper_bound double")


@job(
    "multi_column_min_max",
    f"""WITH {LONG} SELECT feature, greatest(min(x), 0)::double AS lo,
          CASE WHEN least(max(x), 50000) <= greatest(min(x), 0) THEN greatest(min(x), 0) + 1
            ELSE least(max(x), 50000) END::double AS hi FROM long GROUP BY feature""",
)
def _(d):
    limits = {c: 0.0 for c in FEATURES}, {c: 50_000.0 for c in FEATURES}
    return bounds_frame(d, P.min_max(features(d), FEATURES, *limits))


@job(
    "describe_profile",
    f"""WITH {LONG} SELECT feature, count(x) AS n, round(avg(x), 4) AS mean, round(stddev(x), 4) AS stddev,
          min(x) AS min, max(x) AS max FROM long GROUP BY feature""",
)
def _(d):
    return P.describe(features(d), FEATURES).withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


SPLIT = {"fare_amount": (0.0, 20000.0), "tolls_amount": (0.0, 1500.0)}
PEAK = "(coalesce(fare_amount > 20000, false) OR coalesce(tolls_amount > 1500, false))"


@job("split_range_and_peak", f"SELECT trip_key, {PEAK} AS is_peak FROM trips")
def _(d):
    ranged, peak = quality.split_range(d.view("trips"), SPLIT)
    mark = lambda df, flag: df.select("trip_key", F.lit(flag).alias("is_peak"))
    return mark(ranged, False).union(mark(peak, True))


@job(
    "clip_to_bounds",
    """SELECT trip_key, least(greatest(fare_amount, 5000), 20000) AS fare_amount,
         CASE WHEN tolls_amount IS NOT NULL THEN least(greatest(tolls_amount, 0), 1500) END AS tolls_amount FROM trips""",
)
def _(d):
    clipped = quality.clip(d.view("trips"), {"fare_amount": (5000.0, 20000.0), "tolls_amount": (0.0, 1500.0)})
    return clipped.select("trip_key", "fare_amount", "tolls_amount")


def rint(x):
    return f"round_even({x}, 0)"


def equal_width(source, lo, hi, bins, clamp=True):
    """Long counts over (feature, x) of ``source`` with per-feature bounds."""
    place = f"CASE WHEN x >= hi THEN {bins - 1} ELSE floor((x - lo) / width) END"
    place = f"greatest(0, least({bins - 1}, {place}))" if clamp else place
    return f"""limits AS (SELECT feature, {lo} AS lo, {hi} AS hi,
        greatest(1, {rint(f"(({hi}) - ({lo})) / {bins}")})::double AS width FROM {source[1]}),
      placed AS (SELECT feature, ({place})::int AS bucket FROM {source[0]} JOIN limits USING (feature) WHERE x IS NOT NULL),
      counted AS (SELECT feature, bucket, count(*) AS cnt FROM placed GROUP BY ALL),
      frame AS (SELECT feature, lo, width, unnest(range({bins}))::int AS bucket FROM limits)
      SELECT feature, bucket, lo + bucket * width AS left_edge, lo + (bucket + 1) * width AS right_edge,
        {rint("lo + (bucket + 0.5) * width")} AS center, width AS bin_width, coalesce(cnt, 0) AS cnt
      FROM frame LEFT JOIN counted USING (feature, bucket)"""


WIDE_BOUNDS = "in_range AS (SELECT * FROM feats WHERE {})".format(
    " AND ".join(f"({c} IS NULL OR {c} <= (SELECT hi FROM bounds WHERE feature = '{c}'))" for c in FEATURES)
)
PEAK_ROWS = "peak AS (SELECT * FROM feats WHERE {})".format(
    " OR ".join(f"coalesce({c} > (SELECT hi FROM bounds WHERE feature = '{c}'), false)" for c in FEATURES)
)


def long_of(name, view):
    return f"{name} AS ({' UNION ALL '.join(f'SELECT {chr(39)}{c}{chr(39)} AS feature, {c}::double AS x FROM {view}' for c in FEATURES)})"


def split(d):
    rows = features(d)
    bounds = P.outlier_bounds(rows, FEATURES, "two_stage_iqr", 0.0)
    return bounds, *quality.split_range(rows, bounds)


@job(
    "histogram_equal_width",
    f"WITH {TWO_STAGE}, {WIDE_BOUNDS}, {long_of('kept', 'in_range')}, " + equal_width(("kept", "bounds"), "0::double", "hi", 40),
)
def _(d):
    bounds, ranged, _ = split(d)
    return H.histogram(ranged, FEATURES, 40, bounds)


@job("histogram_equal_width_sketch")
def _(d):
    rows = features(d)
    bounds = P.outlier_bounds(rows, FEATURES, "two_stage_iqr", 0.02)
    return H.histogram(quality.split_range(rows, bounds)[0], FEATURES, 40, bounds)


@job(
    "histogram_equal_width_unclamped",
    f"WITH {TWO_STAGE}, {WIDE_BOUNDS}, {long_of('kept', 'in_range')}, "
    + equal_width(("kept", "bounds"), "0::double", "hi", 40, clamp=False),
)
def _(d):
    bounds, ranged, _ = split(d)
    return H.histogram(ranged, FEATURES, 40, bounds, clamp=False)


@job(
    "histogram_peak",
    f"""WITH {TWO_STAGE}, {PEAK_ROWS}, {long_of('kept', 'peak')},
      spans AS (SELECT feature, greatest(min(x), any_value(hi)) AS lo2, max(x) AS top FROM kept JOIN bounds USING (feature)
        WHERE x IS NOT NULL GROUP BY feature),
      ranges AS (SELECT feature, lo2, CASE WHEN top <= lo2 THEN lo2 + 1 ELSE top END AS hi2 FROM spans), """
    + equal_width(("kept", "ranges"), "lo2", "hi2", 40),
)
def _(d):
    bounds, _, peak = split(d)
    return H.peak_histogram(peak, FEATURES, 40, bounds)


@job(
    "histogram_minmax",
    f"""WITH {LONG}, spans AS (SELECT feature, min(x) AS lo, CASE WHEN max(x) <= min(x) THEN min(x) + 1 ELSE max(x) END AS hi
        FROM long GROUP BY feature),
      limits AS (SELECT feature, lo, hi, (hi - lo) / 50 AS width FROM spans),
      counted AS (SELECT feature, least(49, CASE WHEN x >= hi THEN 49 ELSE floor((x - lo) / width) END)::int AS bucket,
        count(*) AS cnt FROM long JOIN limits USING (feature) WHERE x IS NOT NULL GROUP BY ALL),
      frame AS (SELECT feature, lo, width, unnest(range(50))::int AS bucket FROM limits)
      SELECT feature, bucket, lo + bucket * width AS left_edge, lo + (bucket + 1) * width AS right_edge,
        lo + (bucket + 0.5::double) * width AS center, width AS bin_width, coalesce(cnt, 0) AS cnt
      FROM frame LEFT JOIN counted USING (feature, bucket)""",
)
def _(d):
    return H.minmax_histogram(features(d), FEATURES)


FIXED = """top AS (SELECT (ceil(greatest(coalesce(max(fare_amount), 1), 10) / 2) * 2)::int AS last FROM {0}),
  frame AS (SELECT unnest(range((SELECT last // 2 FROM top)))::int AS bucket),
  counted AS (SELECT least(floor(fare_amount / 2), (SELECT last // 2 - 1 FROM top))::int AS bucket, {1}
    FROM {0} WHERE fare_amount >= 0 GROUP BY 1)"""
EDGES = "bucket, bucket * 2::double AS left_edge, (bucket + 1) * 2::double AS right_edge, bucket * 2::double + 1 AS center"


@job(
    "histogram_fixed_width",
    f"""WITH {FIXED.format("rt_events", "count(*) AS n")}
        SELECT {EDGES}, coalesce(n, 0) AS cnt FROM frame LEFT JOIN counted USING (bucket)""",
)
def _(d):
    return H.fixed_histogram(d.view("rt_events"), "fare_amount")


CEIL = """w AS (SELECT bound, greatest(1, ceil(greatest(bound, 1) / 40))::double AS width FROM ub),
  counted AS (SELECT CASE WHEN x >= bound THEN 39 ELSE floor(x / width) END::int AS bucket, count(*) AS n
    FROM vals, w WHERE x >= 0 OR x >= bound GROUP BY 1),
  frame AS (SELECT unnest(range(40))::int AS bucket)
  SELECT bucket, bucket * width AS left_edge, (bucket + 1) * width AS right_edge, width AS bin_width,
    bound AS upper_bound, width * 40 AS max_edge, coalesce(n, 0) AS cnt
  FROM frame CROSS JOIN w LEFT JOIN counted USING (bucket)"""


@job("histogram_ceil_width", f"WITH {EVENT_BOUND}, {CEIL}")
def _(d):
    return H.ceil_histogram(d.view("rt_events"), "fare_amount", relative_error=0.0)


@job(
    "histogram_before_after",
    f"""WITH {FIXED.format("rt_events", "count(*) FILTER (WHERE event_type <> 'purchase') AS a, count(*) AS b")}
        SELECT {EDGES}, coalesce(a, 0) AS before_cnt, coalesce(b, 0) AS after_cnt,
          (SELECT count(*) FROM rt_events WHERE event_type <> 'purchase') AS before_rows,
          (SELECT count(*) FROM rt_events) AS after_rows
        FROM frame LEFT JOIN counted USING (bucket)""",
)
def _(d):
    rows = d.view("rt_events")
    return H.compare_histograms(rows.filter("event_type <> 'purchase'"), rows, "fare_amount")


@job(
    "missing_outputs",
    """SELECT p_brand || '/' || p_type || '/' || k AS key FROM (SELECT DISTINCT p_brand, p_type FROM part) w,
         (VALUES ('inrange.png'), ('peak.png')) v(k)
       WHERE p_brand || '/' || p_type || '/' || k NOT IN (SELECT p_brand || '/' || p_type || '/inrange.png'
         FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND l_quantity >= 48)""",
)
def _(d):
    kinds = F.explode(F.array(F.lit("inrange.png"), F.lit("peak.png")))
    key = lambda kind: F.concat_ws("/", "p_brand", "p_type", kind).alias("key")
    wanted = d.table("part").select("p_brand", "p_type").distinct().withColumn("k", kinds).select(key("k"))
    existing = d.sql(
        "SELECT p_brand, p_type FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_returnflag = 'R' AND l_quantity >= 48"
    ).select(key(F.lit("inrange.png")))
    return H.missing_outputs(wanted, existing)


@job("feature_labels", """SELECT feature, unit, title FROM (VALUES
      ('fare_amount', 'USD', 'Fare Amount'), ('mta_tax', 'USD', 'MTA Tax'), ('tolls_amount', 'USD', 'Toll Charges'),
      ('total_amount', 'USD', 'Total Amount'), ('trip_distance', 'miles', 'Trip Distance'),
      ('trip_duration_minutes', 'minutes', 'Trip Duration')) v(feature, unit, title)
    WHERE (SELECT count(*) FROM trips) > 0""")
def _(d):
    from lakemill.functions.labels import feature_title, feature_unit

    profile = P.describe(features(d), FEATURES).filter(F.col("n") > 0)
    return profile.select("feature", feature_unit(F.col("feature")).alias("unit"), feature_title(F.col("feature")).alias("title"))
