"""Incremental writes as snapshot algebra: each takes DataFrames and gives the new state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, key: str | list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    keys = [key] if isinstance(key, str) else key
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def new_keys(fetched: DataFrame, existing: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Rows of keys not yet known, the first of each key: the result of an insert that ignores conflicts."""
    unseen = fetched.join(existing.select(key).distinct(), key, "left_anti")
    return first_per_key(unseen, key, *order)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Incoming rows replace those with their key, except for the columns in ``keep``; ``incoming`` has one row per key."""
    other = [c for c in existing.columns if c != key]
    old = existing.select(key, *(F.col(c).alias(f"_old_{c}") for c in other), F.lit(True).alias("_old"))
    new = incoming.select(key, *(F.col(c).alias(f"_new_{c}") for c in other), F.lit(True).alias("_new"))
    both = old.join(new, key, "full_outer")

    def value(c: str) -> Column:
        if c in keep:
            return F.when(F.col("_old"), F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}"))
        return F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))

    return both.select(key, *(value(c).alias(c) for c in other))


def replace_children(existing: DataFrame, incoming: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """All rows of the given parents are replaced by the incoming ones."""
    return existing.join(parents.select(key).distinct(), key, "left_anti").unionByName(incoming.join(parents.select(key).distinct(), key, "left_semi"))


def accumulate(totals: DataFrame, delta: DataFrame, key: str, *sums: str) -> DataFrame:
    """Running totals with a batch of increments added."""
    return totals.select(key, *sums).unionByName(delta.select(key, *sums)).groupBy(key).agg(*(F.sum(c).alias(c) for c in sums))


def open_issues_once(issues: DataFrame, found: DataFrame, subject: str, kind: str = "issue_type") -> DataFrame:
    """Found issues of which none is open yet, one for each subject and kind."""
    still_open = issues.filter(F.col("resolved_at").isNull()).select(subject, kind).distinct()
    return found.dropDuplicates([subject, kind]).join(still_open, [subject, kind], "left_anti")


def resolve_issues(issues: DataFrame, solved: DataFrame, subject: str, now: Column) -> DataFrame:
    """Open issues of solved subjects get their time; others stay."""
    marks = solved.select(subject).distinct().withColumn("_solved", F.lit(True))
    rows = issues.join(marks, subject, "left")
    return rows.withColumn("resolved_at", F.when(F.col("resolved_at").isNull() & F.col("_solved"), now).otherwise(F.col("resolved_at"))).select(*issues.columns)


def fill_missing(stored: DataFrame, parsed: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Fields that are null in a stored row get the value of the parsed row with its keys."""
    new = parsed.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in fields))
    rows = stored.join(new, keys, "left")
    return rows.select(*(F.coalesce(c, f"_new_{c}").alias(c) if c in fields else F.col(c) for c in stored.columns))


def lookup_or_create(known: DataFrame, wanted: DataFrame, key: str, id_col: str) -> DataFrame:
    """Known (key, id) pairs, and an id derived from the key for each wanted key that has none."""
    missing = wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
    return known.select(key, id_col).unionByName(missing.select(key, F.sha2(F.col(key).cast("string"), 256).alias(id_col)))


#: Rows that one task may sort out of a queue.
FEW = 10_000


def flagged_first(rows: DataFrame, flagged: DataFrame, key: str, limit: int, *order: Column | str, last: bool = True, stage=None, few: int = FEW) -> DataFrame:
    """The first ``limit`` rows of a work queue; flagged keys go last, or first.

    A limit above ``few`` needs ``stage``, which writes a frame and returns it as read back: the queue is cut into ranges of its order and
    written once, whole ranges are taken by their counts, and only the range in which the limit falls is sorted. ``order`` must leave no ties then.
    """
    marks = flagged.select(key).distinct().withColumn("_flag", F.lit(1))
    queue = rows.join(marks, key, "left").withColumn("_flag", F.coalesce("_flag", F.lit(0)))
    by = [F.col("_flag").asc() if last else F.col("_flag").desc(), *order]
    if limit <= few or stage is None:
        return queue.orderBy(*by).limit(limit).drop("_flag")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number is not coalesced
    ranged = stage(queue.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()))
    taken = 0
    for part, n in sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()):  # a row per range
        if taken + n > limit:
            cut = ranged.filter(F.col("_range") == part).orderBy(*by).limit(limit - taken)
            return ranged.filter(F.col("_range") < part).unionByName(cut).drop("_flag", "_range")
        taken += n
    return ranged.drop("_flag", "_range")


#: Keys of which the place of one among many is guessed.
SAMPLE_KEYS = 20_000


def nth_key(rows: DataFrame, key: str, n: int, count: int, few: int = FEW):
    """The ``n``-th of ``count`` different keys in their order, by passes over the keys alone, which nothing shuffles or sorts.

    Of a bounded sample two keys are taken that most likely have the wanted one between them; a count tells how many keys there are up to each.
    That is repeated between them until ``few`` are left, which are sorted.
    """
    k, low, high = F.col(key), None, None

    def between(a, b) -> Column:
        return F.coalesce((k > F.lit(a) if a is not None else F.lit(True)) & (k <= F.lit(b) if b is not None else F.lit(True)), F.lit(False))

    keys = rows.select(key).filter(k.isNotNull())
    while count > max(few, 1):
        some = sorted(r[0] for r in keys.filter(between(low, high) & (F.pmod(F.xxhash64(key), F.lit(max(1, count // SAMPLE_KEYS))) == 0)).collect())
        at, room = n * len(some) // count, int(4 * len(some) ** 0.5) + 4
        a, b = some[at - room] if at >= room else low, some[at + room] if at + room < len(some) else high
        if (a, b) == (low, high):
            break
        up_to_a, up_to_b = keys.filter(between(low, high)).agg(F.count_if(between(low, a)) if a != low else F.lit(0), F.count_if(between(low, b))).first()
        if n <= up_to_a:
            high, count = a, up_to_a
        elif n > up_to_b:
            low, n, count = b, n - up_to_b, count - up_to_b
        else:
            low, high, n, count = a, b, n - up_to_a, up_to_b - up_to_a
    return keys.filter(between(low, high)).orderBy(key).offset(n - 1).limit(1).first()[0]


def first_of_queue(queue: DataFrame, key: str, limit: int, few: int = FEW) -> Column:
    """Whether a row is among the first ``limit`` of a queue in the order of ``_flag`` and a key without ties; a condition on the row, never null."""
    counts = sorted(tuple(r) for r in queue.groupBy("_flag").agg(F.count(key).alias("n")).collect())
    left = limit
    for flag, n in counts:
        if n > left:
            whole = F.col("_flag") < flag
            if left <= 0:
                return whole
            last = nth_key(queue.filter(F.col("_flag") == flag), key, left, n, few)
            return whole | ((F.col("_flag") == flag) & F.coalesce(F.col(key) <= F.lit(last), F.lit(False)))
        left -= n
    return F.lit(True)


def drain(pending, step, most: int = 1000) -> int:
    """Run ``step`` until nothing is pending or the pending count no longer falls; returns the steps taken."""
    left, taken = pending(), 0
    while left and taken < most:
        step()
        taken += 1
        now = pending()
        if now >= left:
            break
        left = now
    return taken


def split_rejected(parsed: DataFrame, required: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the required field, and those without it, for the issue log."""
    return parsed.filter(F.col(required).isNotNull()), parsed.filter(F.col(required).isNull())


def outcomes(filings: DataFrame, parsed: DataFrame, tried: DataFrame, key: str) -> DataFrame:
    """Filings with the status of a batch: parsed, failed, or as before if they were not tried."""
    good = parsed.select(key).distinct().withColumn("_good", F.lit(True))
    seen = tried.select(key).distinct().withColumn("_tried", F.lit(True))
    rows = filings.join(good, key, "left").join(seen, key, "left")
    status = F.when(F.col("_good"), "parsed").when(F.col("_tried"), "failed").otherwise(F.col("parse_status"))
    return rows.withColumn("parse_status", status).select(*filings.columns)
