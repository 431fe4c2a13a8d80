"""Filters and joins that built-ins do not cover directly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordered import ordered_scan
from lakeops.session import materialize


def match_filter(
    df: DataFrame,
    is_in: Mapping[str, Sequence] | None = None,
    equals: Mapping[str, object] | None = None,
    at_least: Mapping[str, object] | None = None,
    below: Mapping[str, object] | None = None,
) -> DataFrame:
    """AND of optional filters; an empty or missing option does not filter. All push down to the scan."""
    literal = lambda v: F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz") if isinstance(v, datetime) else F.lit(v)
    for column, values in (is_in or {}).items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    for options, test in (
        (equals, lambda c, v: c == v),
        (at_least, lambda c, v: c >= v),
        (below, lambda c, v: c < v),
    ):
        for column, value in (options or {}).items():
            if value is not None:
                df = df.filter(test(F.col(column), literal(value)))
    return df


def merge_series(series: Mapping[str, DataFrame], on: str) -> DataFrame:
    """Full outer join of count series on one column; a missing count is 0.

    The series are stacked and summed rather than joined one after the other: one shuffle for any
    number of series. Each series has ``on`` and its count under the mapping's name, once per value.
    """
    names = list(series)
    stacked = [
        df.select(on, *[(F.col(n) if n == own else F.lit(0)).cast("bigint").alias(n) for n in names])
        for own, df in series.items()
    ]
    union = reduce(DataFrame.unionByName, stacked)
    return union.groupBy(on).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def anti_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Distinct non-null keys of left without a match in right.

    Both sides are made distinct first, which combines before the shuffle: a key with many rows on
    either side travels once per map task.
    """
    other = right.select(F.col(right_key or key).alias(key)).distinct()
    return left.select(key).filter(F.col(key).isNotNull()).distinct().join(other, key, "left_anti")


#: Keys whose pairs of a point and a period are at most this many times their rows are joined by the key alone, unless they have more rows than this.
PAIRS_A_ROW, KEY_ROWS = 64, 1_000_000

#: Seconds of the finest bin of a range join.
BIN_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def dyadic_bins(first: Column, last: Column) -> Column:
    """The fewest (level, bin) that cover the bins first to last exactly, where bin b of a level is made of bins 2 b and 2 b + 1 of the level below.

    As in a segment tree there are at most two on a level, so their number grows with the logarithm of the range.
    """
    two_to = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)

    def of_level(k: Column) -> Column:
        low, high = F.ceil(first / two_to(k)), F.floor((last + 1) / two_to(k)) - 1
        at = lambda b: F.struct(k.alias("level"), b.cast("long").alias("bin"))
        left = F.when((low <= high) & (F.pmod(low, F.lit(2)) == 1), at(low))
        right = F.when((low <= high) & (F.pmod(high, F.lit(2)) == 0), at(high))
        return F.array(left, right)

    levels = F.sequence(F.lit(0), F.ceil(F.log2((last - first + 1).cast("double"))).cast("int") + 1)
    return F.filter(F.flatten(F.transform(levels, of_level)), lambda b: b.isNotNull())


def range_join(
    points: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    unit: str = "week",
    hot_rows: int = 5_000_000,
    salts: int = 64,
    pairs_a_row: int = PAIRS_A_ROW,
    count: str | None = None,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Points inside periods (both ends included) of the same key; dates or times. NULL keys and bounds match nothing.

    With ``count`` the result is one row per point that lies in some period, with the number of its periods and the ``sums`` of their columns, and no pair is made; see ``range_totals``.

    Keys with few points or few periods, which have at most ``pairs_a_row`` pairs for each of their rows, are joined by the key alone: their rows travel once, and the
    pairs that are tried grow with the rows. All other keys are joined by bins. Both inputs are read for the counts and again for the join, so write those that are costly.

    Time is cut into bins of a unit, which pair up level by level. A period is laid out over the few bins of several levels that cover it,
    a point looks up its one bin on each level that some period uses, and the join is an equality of key, level and bin. Only in the
    units of a period's two ends can they meet in vain. Keys with more than
    ``hot_rows`` points are salted: their points on the upper levels, where many share a bin, are dealt to ``salts`` copies of the periods.
    """
    if count:
        return range_totals(points, periods, keys, at, start, end, count=count, sums=sums, unit=unit)
    some = lambda df: df.filter(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys]))
    points, periods = some(points), some(periods)
    inside = (F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))
    counted = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    each = counted(points, "_points").join(counted(periods, "_periods"), list(keys))
    both = F.col("_points") + F.col("_periods")
    # Products of counts as numbers of any size.
    many = F.col("_points").cast("double") * F.col("_periods") > pairs_a_row * both
    dense = materialize(each.filter(many | (both > KEY_ROWS)).select(*keys), "dense_keys")
    if dense.isEmpty():
        return points.join(periods, list(keys)).filter(inside)
    plain = points.join(dense, list(keys), "left_anti").join(periods.join(dense, list(keys), "left_anti"), list(keys)).filter(inside)
    binned = _binned_join(points.join(dense, list(keys), "left_semi"), periods.join(dense, list(keys), "left_semi"), keys, at, start, end, unit, hot_rows, salts)
    return plain.unionByName(binned)


def _binned_join(points, periods, keys, at, start, end, unit, hot_rows, salts) -> DataFrame:
    seconds = BIN_SECONDS[unit]
    bin_of = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp_ntz").cast("timestamp")) / (seconds * 1_000_000))
    laid = periods.filter(F.col(start) <= F.col(end)).withColumn("_b", F.explode(dyadic_bins(bin_of(start), bin_of(end))))
    laid = laid.withColumn("_level", F.col("_b.level")).withColumn("_bin", F.col("_b.bin")).drop("_b")
    used = sorted(r[0] for r in laid.select("_level").distinct().collect())  # a number per level, some dozens at most
    if not used:
        used = [0]
    looked_up = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_own", k).alias("bin")) for k in used]))
    spread = points.withColumn("_own", bin_of(at)).withColumn("_b", looked_up).withColumn("_level", F.col("_b.level")).withColumn("_bin", F.col("_b.bin"))
    hot = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    met = salted_join(spread.drop("_b"), laid, [*keys, "_level", "_bin"], F.col("_own"), salts=salts, hot=hot)
    return met.filter((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("_own", "_level", "_bin")


def range_totals(
    points: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, start: str, end: str, *, count: str, sums: Mapping[str, str] | None = None,
    unit: str = "day", hot_rows: int = 1_000_000,
) -> DataFrame:
    """``range_join`` summed up per point: the points with some period, the count of these periods and the sums of their columns, {new column: column}.

    No pair becomes a row. Starts, points and ends of a key are put in time order, and a point's totals are what has started up to it without what has ended before it. Keys of
    more than ``hot_rows`` rows are cut into slices of the unit. Sums are exact for whole numbers and decimals; a sum of NULLs alone is NULL. Rows of ``points`` that repeat stay.
    """
    sums = dict(sums or {})
    whole = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    kept = points.filter(whole & F.col(at).isNotNull())
    none = F.lit(0)
    own = F.struct(*[F.col(c) for c in points.columns])

    def steps(when: str, turn: int, sign: int) -> DataFrame:
        """What changes at the start (1) or after the end (-1) of the periods, added up for each moment."""
        numbers = [F.sum(F.lit(sign)).alias("_n")]
        for i, c in enumerate(sums.values()):
            numbers += [F.sum(F.col(c) * sign).alias(f"_s{i}"), F.sum(F.col(c).isNotNull().cast("long") * sign).alias(f"_c{i}")]
        real = periods.filter(whole & (F.col(start) <= F.col(end)))
        made = real.groupBy(*keys, F.col(when).cast("timestamp_ntz").alias("_at"), F.lit(turn).alias("_turn")).agg(*numbers)
        return made.withColumn("_id", F.lit(0).cast("long"))

    changes = [f"_{kind}{i}" for i in range(len(sums)) for kind in "sc"]
    marks = kept.select(*keys, F.col(at).cast("timestamp_ntz").alias("_at"), F.lit(1).alias("_turn"), F.monotonically_increasing_id().alias("_id"), own.alias("_point"))
    marks = marks.select("*", *[none.cast("long").alias(c) for c in ("_n", *changes)])
    rows = steps(start, 0, 1).unionByName(steps(end, 2, -1)).unionByName(marks, allowMissingColumns=True)
    seconds = BIN_SECONDS[unit]
    slices = F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / (seconds * 1_000_000))
    scanned = ordered_scan(rows, keys, ["_at", "_turn", "_id"], slices, running={f"{c}_upto": c for c in ("_n", *changes)}, hot_rows=hot_rows)
    met = scanned.filter((F.col("_turn") == 1) & (F.col("_n_upto") > 0))
    totals = [F.when(F.col(f"_c{i}_upto") > 0, F.col(f"_s{i}_upto")).alias(name) for i, name in enumerate(sums)]
    return met.select("_point.*", F.col("_n_upto").alias(count), *totals)


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column, how: str = "inner",
    hot_rows: int = 5_000_000, salts: int = 64, hot: DataFrame | None = None,
) -> DataFrame:
    """Equality join that spreads the hot keys of the left side.

    Keys with more than ``hot_rows`` left rows get one of ``salts`` salts from ``spread`` (any column
    with many values); only their right rows are copied once per salt. NULL keys, which match nothing,
    are spread as well; all other keys have salt 0. The list of hot keys is broadcast: it has at most
    (left rows / hot_rows) entries. ``hot`` names them instead, by some of the keys and a column ``_hot`` that is true.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if hot is None:
        hot = left.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    by = [k for k in keys if k in hot.columns]
    unmatched = F.lit(False)
    for key in keys:
        unmatched = unmatched | F.col(key).isNull()
    salted = F.coalesce(F.col("_hot"), F.lit(False)) | unmatched
    salt = F.when(salted, F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")
    many = left.join(F.broadcast(hot), by, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    few = right.join(F.broadcast(hot), by, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return many.join(few, [*keys, "_salt"], how).drop("_salt")


def _literals(pattern: Column) -> Column:
    """The literal stretches of a LIKE pattern, between its unescaped wildcards."""
    return F.transform(F.regexp_extract_all(pattern, F.lit(r"(?s)((?:[^%_\\]|\\.)+)"), F.lit(1)), lambda p: F.regexp_replace(p, r"(?s)\\(.)", "$1"))


def _grams(text: Column, size: Column) -> Column:
    """The different substrings of a text with so many characters."""
    letters = F.split(text, "")
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(letters, i, size), "")))


def matching_texts(texts: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """The distinct texts (column ``_text``) that are LIKE one of the patterns; NULLs match nothing.

    An index instead of a comparison of all pairs: a pattern of the form 'prefix%' is an equality join with the beginnings of texts, in the lengths
    that prefixes have. Any other is found by one gram of its literals, three characters if it has that many in a row, else two or one: of its grams the one
    that the fewest texts hold. Texts meet patterns by that gram, and LIKE decides. Patterns of wildcards alone ask for a length only.
    """
    p = F.col("_pattern")
    start = F.expr("substr(_pattern, 1, length(_pattern) - 1)")
    listed = patterns.select(F.col(pattern).alias("_pattern")).filter(p.isNotNull()).distinct()
    listed = listed.withColumn("_prefix", F.when(p.endswith("%") & ~start.rlike(r"[%_\\]") & (F.length(p) > 1), start))
    rest = listed.filter(F.col("_prefix").isNull()).select("_pattern", _literals(p).alias("_parts"))
    texts = texts.select(F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).distinct()

    prefixes = listed.select("_prefix").filter(F.col("_prefix").isNotNull())
    lengths = sorted(r[0] for r in prefixes.select(F.length("_prefix")).distinct().collect())  # one number per length of a prefix
    beginnings = F.array(*[F.substring("_text", 1, n) for n in lengths]) if lengths else F.array().cast("array<string>")
    hits = texts.select("_text", F.explode(beginnings).alias("_prefix")).join(prefixes, "_prefix", "left_semi").select("_text")

    size = F.least(F.lit(3), F.array_max(F.transform("_parts", F.length)))
    sized = rest.filter(F.size("_parts") > 0).select("_pattern", "_parts", size.alias("_size"))
    in_pattern = F.explode(F.array_distinct(F.flatten(F.transform("_parts", lambda s: _grams(s, F.col("_size"))))))
    wanted = sized.select("_pattern", in_pattern.alias("_gram"))
    sizes = sorted(r[0] for r in sized.select("_size").distinct().collect())  # of 1, 2 and 3
    in_text = F.explode(F.concat(*[_grams(F.col("_text"), F.lit(n)) for n in sizes]) if sizes else F.array().cast("array<string>"))
    postings = texts.select("_text", in_text.alias("_gram")).join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    postings = materialize(postings, "pattern_postings")
    often = postings.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # A gram that no text holds drops its pattern, which then matches none.
    rarest = wanted.join(often, "_gram", "left").groupBy("_pattern").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_rare"))
    met = postings.join(rarest.filter("_rare.n > 0").select("_pattern", F.col("_rare.gram").alias("_gram")), "_gram").filter(F.expr("_text like _pattern"))

    blank = rest.filter(F.size("_parts") == 0).select(F.length(F.translate("_pattern", "%", "")).alias("_least"), p.contains("%").alias("_more"))
    exact = blank.filter(~F.col("_more")).select("_least").distinct()
    least = blank.filter("_more").agg(F.min("_least")).scalar()
    long_enough = texts.filter(F.length("_text") >= least)
    as_long = texts.withColumn("_least", F.length("_text")).join(exact, "_least", "left_semi").select("_text")
    return hits.union(met.select("_text")).union(long_enough).union(as_long).distinct()


def matches_any_pattern(df: DataFrame, column: str, patterns: DataFrame, pattern: str, flag: str) -> DataFrame:
    """Flag rows whose text is LIKE any pattern row; NULL text gives NULL, no patterns give false.

    Only distinct texts meet the patterns, by an index of these (``matching_texts``). The hits come back by a join on the text.
    """
    hits = matching_texts(df, column, patterns, pattern).withColumn("_hit", F.lit(True))
    found = df.join(hits, F.col(column) == F.col("_text"), "left")
    known = patterns.agg(F.count(pattern) > 0).scalar()
    value = F.when(F.col(column).isNotNull() | ~known, F.coalesce(F.col("_hit"), F.lit(False)))
    return found.withColumn(flag, value).drop("_text", "_hit")


def in_lookup(df: DataFrame, value: Column, lookup: DataFrame, column: str, flag: str, extra: Column | None = None) -> DataFrame:
    """Boolean column: is the value in the lookup, or is ``extra`` true; never NULL."""
    side = lookup.select(F.col(column).alias("_value")).distinct().withColumn("_found", F.lit(True))
    out = df.withColumn("_probe", value).join(side, F.col("_probe") == F.col("_value"), "left")
    found = F.col("_found").isNotNull()
    if extra is not None:
        found = found | F.coalesce(extra, F.lit(False))
    return out.withColumn(flag, found).drop("_probe", "_value", "_found")


def is_internal_user(
    df: DataFrame, email: str, domains: DataFrame, column: str, addresses: Sequence[str] = (), flag: str = "is_internal_user"
) -> DataFrame:
    """Own e-mail domain, or one of a few fixed addresses."""
    from lakeops.functions.text import email_domain

    return in_lookup(df, email_domain(F.col(email)), domains, column, flag, F.col(email).isin(list(addresses)))


def is_personal_email(df: DataFrame, email: str, domains: DataFrame, column: str, flag: str = "is_personal_email") -> DataFrame:
    from lakeops.functions.text import email_domain

    return in_lookup(df, email_domain(F.col(email)), domains, column, flag)
