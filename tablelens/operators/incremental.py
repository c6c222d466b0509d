"""Holding a table by date ranges: what is missing, merging it in, writing it down."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import day_range
from ..functions.projection import quoted
from .aggregate import AggSpec
from .day_states import DAY, DayStates, day_states, periods_of_states
from .joins import match
from .key_index import build_key_index, months_of
from .keyed import dedup_keep_last, keyed_upsert, union_by_name
from .paging import keep_most_recent

MONTH = "part_month"
Day = str | dt.date | None


def date_gaps(
    df: DataFrame,
    held_min: str = "held_min",
    held_max: str = "held_max",
    wanted_min: str = "wanted_min",
    wanted_max: str = "wanted_max",
) -> DataFrame:
    """One row (gap_min, gap_max) per missing closed day range of every input row.

    A null bound of the wanted range is open. Where nothing is held, the whole
    wanted range is missing. A fully covered row yields no gap.
    """
    first, last = F.to_date(df[held_min]), F.to_date(df[held_max])
    start, end = F.to_date(df[wanted_min]), F.to_date(df[wanted_max])

    def gap(low: Column, high: Column) -> Column:
        return F.struct(low.alias("gap_min"), high.alias("gap_max"))

    nothing = first.isNull() | last.isNull()
    before = F.when(start.isNull() | (start < first), gap(start, F.date_sub(first, 1)))
    after = F.when(end.isNull() | (end > last), gap(F.date_add(last, 1), end))
    gaps = F.when(nothing, F.array(gap(start, end))).otherwise(
        F.array_compact(F.array(before, after))
    )
    return df.select("*", F.inline(gaps))


def touches_day(wanted_max: Column, day: Column) -> Column:
    """Whether a wanted range is open-ended or reaches `day`, so that day is read again."""
    return wanted_max.isNull() | (F.to_date(wanted_max) >= day)


def widened(held: Column, new: Column, side: str) -> Column:
    """The bound of the union of two ranges; null means nothing known."""
    return F.least(held, new) if side == "min" else F.greatest(held, new)


def replace_range(held: DataFrame, fetched: DataFrame, date: str, start: Day, end: Day) -> DataFrame:
    """Held rows outside the range and fetched rows inside it.

    Rows deleted at the source vanish with the range. Rows without a date
    belong to no range and stay.
    """
    inside = day_range(held[date], start, end)
    outside = held.where(~F.coalesce(inside, F.lit(False)))
    return union_by_name(outside, fetched.where(day_range(fetched[date], start, end)))


def refresh_range(
    held: DataFrame, covered: DataFrame, source: DataFrame, date: str, start: Day, end: Day, today: Day = None
) -> tuple[DataFrame, DataFrame]:
    """The held table with the wanted range filled in from `source`, and what is covered then.

    `covered` is one row (held_min, held_max), null where nothing is held. Only
    the missing ranges are read from the source, and `today` again where the
    range reaches it. An open end counts as covered up to `today`.
    """
    def day(value: Day) -> Column:
        return F.lit(str(value) if value is not None else None).cast("date")

    asked = covered.select("held_min", "held_max", day(start).alias("wanted_min"), day(end).alias("wanted_max"))
    gaps = date_gaps(asked).select("gap_min", "gap_max")
    if today is not None:
        again = asked.where(touches_day(F.col("wanted_max"), day(today)))
        gaps = gaps.union(again.select(day(today), day(today)))
    for low, high in gaps.collect():  # three ranges at most
        held = replace_range(held, source, date, low, high)
    now = covered.select(
        widened(F.col("held_min"), day(start), "min").alias("held_min"),
        widened(F.col("held_max"), day(end if end is not None else today), "max").alias("held_max"),
    )
    return held, now


def incremental_merge(
    held: DataFrame,
    fetched: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    date: str | None = None,
    start: Day = None,
    end: Day = None,
) -> DataFrame:
    """Merge fetched rows into the held table, the later row of a key winning.

    With `date`, `fetched` is the complete content of the day range, so held
    rows of the range that did not come back are dropped, and fetched rows
    outside it are not taken.
    """
    if date is not None:
        inside = day_range(held[date], start, end)
        held = held.where(~F.coalesce(inside, F.lit(False)))
        fetched = fetched.where(day_range(fetched[date], start, end))
    return keyed_upsert(held, fetched, keys, seq)


def refresh_day(
    held: DataFrame, source: DataFrame, date: str, day: str | dt.date | Column
) -> DataFrame:
    """Read one day, normally today, again from the source.

    `day` may be a scalar subquery, such as the latest day of the source.
    """
    day = day if isinstance(day, Column) else F.lit(day).cast("date")

    def on_day(df: DataFrame) -> Column:
        return (df[date] >= day) & (df[date] < F.date_add(day, 1))

    others = held.where(~F.coalesce(on_day(held), F.lit(False)))
    return union_by_name(others, source.where(on_day(source)))


# ---------------------------------------------------------------- stored by month


def with_month(df: DataFrame, date: str) -> DataFrame:
    """Add the partition column of the stored table."""
    return df.withColumn(MONTH, F.date_format(F.to_date(F.col(date)), "yyyy-MM"))


def merge_stored(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    date: str,
    dates_move: bool = True,
    covered: tuple[Day, Day] | None = None,
    key_index: bool = False,
    most: int | None = None,
    states: DayStates | None = None,
) -> dict:
    """Upsert into a table stored by month, writing only the months it touches.

    Touched are the months of the incoming rows and, as a row may get another
    date, the months where their keys are held now. Finding those reads the key
    columns of the whole table; `dates_move=False` saves that where a key never
    changes its month, and `key_index=True` limits it to the months whose stored
    key filter may hold an arriving key (months written without one are read).
    New months go to a new folder, and a new version file that names the folder
    of every month is put in place last: until then readers see the old version
    whole, and no old file is touched. Running the same merge again gives the
    same table. `covered` is the range the rows were fetched for, recorded even
    where it held none. With `most`, only so many rows stay, the newest by
    `date`, and what counts as covered begins after the last day that lost rows.
    With `states`, the same version holds mergeable states of every day: only
    days where rows arrive or arriving keys were held are computed again, whole
    months only where they have no states yet or the cap cut them.

    Returns the months that were searched for arriving keys and those written;
    with `states` also the months and days whose states were computed from rows.
    """
    now = _version(spark, path)
    latest = dedup_keep_last(incoming, keys, seq)
    held = _months(spark, now)
    day = F.to_date(F.col(quoted(date))) if states else F.lit(None).cast("date")
    touched = with_month(latest, date).select(MONTH, day.alias(DAY))
    held = _months(spark, now)
    searched: list[str] = []
    if held is not None and (dates_move or states):
        searched = sorted(now["months"])
        wanted = latest.select(*map(quoted, keys)).distinct()
        if not dates_move:
            arriving = {r[0] or "" for r in touched.select(MONTH).distinct().collect()}
            searched = [m for m in searched if m in arriving]
        elif key_index:
            searched = _may_hold(spark, path, now, wanted, keys)
        columns = dict.fromkeys([*keys, date] if states else keys)
        moved = held.where(_in_months(searched)).select(*map(quoted, columns), MONTH)
        touched = touched.union(match(moved, wanted, keys, "left_semi").select(MONTH, day))
    # bounded by the calendar: one entry per month, or per day with states
    places = {(r[0] or "", r[1]) for r in touched.distinct().collect()}
    months = {month for month, _ in places}
    merged = latest
    if held is not None:
        merged = keyed_upsert(held.where(_in_months(months)).drop(MONTH), latest, keys, seq)
    written = _stored_months(spark, path, merged, keys, date, key_index)
    content = {"months": {m: f for m, f in now["months"].items() if m not in months} | written["months"]}
    content["indexes"] = now["indexes"] | written["indexes"]
    ranges = _joined([*now["covered"], *([_iso(covered)] if covered else [])])
    if most is not None:
        content, ranges = _capped(spark, path, content, ranges, keys, date, key_index, most)
    content["indexes"] = {f: i for f, i in content["indexes"].items() if f in content["months"].values()}
    report = {"searched": searched, "written": sorted(months)}
    if states is None:
        content["states"] = _still_valid(now["states"], content["months"])
    else:
        days = {m: {d for month, d in places if month == m} for m, f in written["months"].items() if content["months"].get(m) == f}
        content["states"], report["computed"] = _refreshed_states(spark, path, now, content["months"], days, date, states)
    _put_version(spark, path, now["version"] + 1, content | {"covered": ranges})
    return report


def _still_valid(states: dict, months: dict) -> dict:
    """The stored states without those of months whose rows are no longer the ones they were computed from."""
    return states and states | {"months": {m: s for m, s in states["months"].items() if months.get(m) == s["of"]}}


def _refreshed_states(
    spark: SparkSession, path: str, now: dict, months: dict, changed: dict[str, set], date: str, states: DayStates
) -> tuple[dict, dict]:
    """The states of all months, and the months and days they were computed for.

    `changed` names the days that changed in the months of which nothing else did.
    """
    some = _months(spark, {"months": months})
    spec = states.described() | {"date": date, "types": _typed(some, [*states.values, *states.keys, date]) if some else []}
    before = _still_valid(now["states"], now["months"]) if now["states"] and now["states"]["spec"] == spec else {"months": {}}
    kept = _still_valid(before, months)["months"]
    missing = {m: f for m, f in months.items() if m and m not in kept}
    if not missing:
        return {"spec": spec, "months": kept}, {"months": [], "days": []}
    partly = {m: f for m, f in missing.items() if m in changed and m in before["months"]}
    days = sorted(d for m in partly for d in changed[m])
    parts = []
    if whole := {m: f for m, f in missing.items() if m not in partly}:
        parts.append(day_states(_months(spark, {"months": whole}), date, states))
    if partly:
        rows, at = _months(spark, {"months": partly}), F.col(quoted(date))
        parts.append(day_states(rows.where(day_range(at, days[0], days[-1]) & F.to_date(at).isin(*days)), date, states))
        old = _months(spark, {"months": {m: before["months"][m]["folder"] for m in partly}}).drop(MONTH)
        parts.append(old.where(~F.col(DAY).isin(*days)))
    folder = f"{path}/states/{uuid.uuid4().hex}"
    _write_months(reduce(lambda a, b: a.unionByName(b), parts), folder, DAY)
    fresh = {m: {"of": f, "folder": folder} for m, f in missing.items()}
    return {"spec": spec, "months": kept | fresh}, {"months": sorted(whole), "days": [str(d) for d in days]}


def stored_states(spark: SparkSession, path: str) -> tuple[DataFrame, DayStates]:
    """The states of the last version; those of months that were merged without are computed from their rows."""
    now = _version(spark, path)
    if not now["states"]:
        raise ValueError(f"the table at {path} was never merged with states")
    spec, places = now["states"]["spec"], now["states"]["months"]
    states = DayStates(spec["values"], spec["keys"])
    stored = _months(spark, {"months": {m: s["folder"] for m, s in places.items()}})
    parts = [] if stored is None else [stored.drop(MONTH)]
    others = {m: f for m, f in now["months"].items() if m and m not in places}
    if others or not parts:
        rows = _months(spark, {"months": others or now["months"]})
        if rows is None:
            raise FileNotFoundError(f"no table stored at {path}")
        parts.append(day_states(rows, spec["date"], states))
    return reduce(lambda a, b: a.unionByName(b), parts), states


def resample_stored(spark: SparkSession, path: str, period: str, spec: AggSpec) -> DataFrame:
    """`resample` of a stored table from the states of its days: one row per day and keys is read, no row of the table."""
    held, states = stored_states(spark, path)
    return periods_of_states(held, states, period, spec)


def _in_months(months) -> Column:
    return F.coalesce(F.col(MONTH), F.lit("")).isin(*months) if months else F.lit(False)


def _stored_months(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], date: str, key_index: bool) -> dict:
    """Write rows by month to a new folder; the months it has, and where the filter of their keys is."""
    name = uuid.uuid4().hex
    folder = f"{path}/data/{name}"
    _write_months(rows, folder, date)
    months = {m: folder for m in _written_months(spark, folder)}
    if not key_index or not months:
        return {"months": months, "indexes": {}}
    stored = _months(spark, {"months": months})
    index = build_key_index(stored.select(*map(quoted, keys), MONTH), MONTH, keys)
    index.write.parquet(f"{path}/indexes/{name}")
    return {"months": months, "indexes": {folder: {"folder": f"{path}/indexes/{name}", "keys": _typed(stored, keys)}}}


def _typed(df: DataFrame, keys: Sequence[str]) -> list[list[str]]:
    return [[k, df.schema[k].dataType.simpleString()] for k in keys]


def _may_hold(spark: SparkSession, path: str, version: dict, wanted: DataFrame, keys: Sequence[str]) -> list[str]:
    """The months of a version that may hold one of the wanted keys."""
    usable = {f: i["folder"] for f, i in version["indexes"].items() if i["keys"] == _typed(wanted, keys)}
    found = {m for m, f in version["months"].items() if f not in usable}
    for folder, place in usable.items():
        own = {m for m, f in version["months"].items() if f == folder}
        index = spark.read.parquet(place).where(F.col("month").isin(*own))
        found |= {r[0] for r in months_of(index, wanted, keys).collect()}
    return sorted(found)


def _capped(
    spark: SparkSession, path: str, content: dict, ranges: list, keys: Sequence[str], date: str, key_index: bool, most: int
) -> tuple[dict, list]:
    """The months that hold the newest `most` rows, the oldest of them cut, and the ranges that are still whole."""
    held = _months(spark, content)
    counts = {r[0]: r[1] for r in held.groupBy(F.coalesce(F.col(MONTH), F.lit("")).alias("m")).count().collect()} if held else {}
    left, months, lost = most, {}, None
    for month in sorted(counts, reverse=True):  # rows without a date are the oldest
        n = counts[month]
        if n <= left:
            months[month] = content["months"][month]
        else:
            lost = lost or month
            if left:
                rows = held.where(_in_months([month])).drop(MONTH)
                cut = _stored_months(spark, path, keep_most_recent(rows, left, date, list(keys)), keys, date, key_index)
                months |= cut["months"]
                content["indexes"] |= cut["indexes"]
        left = max(0, left - n)
    if lost is None:
        return content, ranges
    # the last day that lost rows: in the month that was cut first
    last = None
    if lost:
        before = held.where(_in_months([lost])).drop(MONTH).select(F.to_date(F.col(quoted(date))).alias("d")).groupBy("d").count()
        stays = _months(spark, {"months": {m: f for m, f in months.items() if m == lost}})
        after = before.limit(0) if stays is None else stays.select(F.to_date(F.col(quoted(date))).alias("d")).groupBy("d").count()
        gone = before.join(after.withColumnRenamed("count", "kept"), "d", "left").where("count > coalesce(kept, 0)")
        last = gone.agg(F.max("d")).first()[0]
    content = {"months": months, "indexes": content["indexes"]}
    if last is None:  # only rows without a date went, which no range covers
        return content, ranges
    first = (last + dt.timedelta(1)).isoformat()
    return content, [[max(low or first, first), high] for low, high in ranges if high is None or high >= first]


def remove_old_versions(spark: SparkSession, path: str, keep: int = 1, older_than: float = 86_400.0) -> list[str]:
    """Remove all but the last `keep` versions and the folders only they named; returns the names of what went.

    A folder that no version names may belong to a merge that is still running;
    it goes once it was written more than `older_than` seconds ago. Readers of
    a removed version fail, so `keep` should cover the longest of them.
    """
    fs, _ = _files(spark, path)
    names = [n for n in _names(spark, f"{path}/versions") if n.endswith(".json")]
    gone, kept = names[: -max(1, keep)], names[-max(1, keep) :]
    used: set[str] = set()
    for name in kept:
        content = _content(spark, path, name)
        used |= {f.rpartition("/")[2] for f in content["months"].values()}
        used |= {i["folder"].rpartition("/")[2] for i in content["indexes"].values()}
        used |= {i["folder"].rpartition("/")[2] for i in content["states"].get("months", {}).values()}
    removed = []
    for name in gone:
        fs.delete(_files(spark, f"{path}/versions/{name}")[1], False)
        removed.append(f"versions/{name}")
    before = (dt.datetime.now(dt.UTC).timestamp() - older_than) * 1000
    for kind in ("data", "indexes", "states"):
        _, at = _files(spark, f"{path}/{kind}")
        for status in fs.listStatus(at) if fs.exists(at) else []:
            name = status.getPath().getName()
            if name not in used and status.getModificationTime() < before:
                fs.delete(status.getPath(), True)
                removed.append(f"{kind}/{name}")
    return removed


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The stored table as of its last version."""
    held = _months(spark, _version(spark, path))
    if held is None:
        raise FileNotFoundError(f"no table stored at {path}")
    return held.drop(MONTH)


def covered_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(held_min, held_max) of the day ranges merged so far, joined where they meet; null is open."""
    ranges = [tuple(r) for r in _version(spark, path)["covered"]]
    return spark.createDataFrame(ranges, "held_min string, held_max string").select(
        F.col("held_min").cast("date"), F.col("held_max").cast("date")
    )


def _write_months(df: DataFrame, folder: str, date: str) -> None:
    """Rows are sent to their month first; adaptive execution splits a large month over many tasks."""
    rows = with_month(df, date).hint("rebalance", F.col(MONTH))
    rows.write.partitionBy(MONTH).parquet(folder)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _written_months(spark: SparkSession, folder: str) -> list[str]:
    names = [n.partition("=")[2] for n in _names(spark, folder) if n.startswith(f"{MONTH}=")]
    return ["" if n == "__HIVE_DEFAULT_PARTITION__" else n for n in names]


def _version(spark: SparkSession, path: str) -> dict:
    """The last version: its number, the folder of each month, the covered ranges."""
    names = [n for n in _names(spark, f"{path}/versions") if n.endswith(".json")]
    if not names:
        return {"version": 0, "months": {}, "covered": [], "indexes": {}, "states": {}}
    return {"version": int(names[-1].partition(".")[0]), **_content(spark, path, names[-1])}


def _content(spark: SparkSession, path: str, name: str) -> dict:
    text = spark.read.option("wholetext", True).text(f"{path}/versions/{name}").first()[0]
    return {"indexes": {}, "states": {}, **json.loads(text)}


def _put_version(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Write a version file aside and give it its name, which must be free."""
    fs, aside = _files(spark, f"{path}/versions/{uuid.uuid4().hex}.new")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    _, place = _files(spark, f"{path}/versions/{number:012d}.json")
    if fs.exists(place) or not fs.rename(aside, place):
        raise RuntimeError(f"version {number} of {path} exists: another merge was quicker, run this one again")


def _months(spark: SparkSession, version: dict) -> DataFrame | None:
    """All rows of a version with their month, or None where there are none."""
    folders: dict[str, list[str]] = {}
    for month, folder in version["months"].items():
        folders.setdefault(folder, []).append(month)
    parts = []
    for folder, months in folders.items():
        rows = spark.read.option("recursiveFileLookup", False).parquet(folder)
        rows = rows.withColumn(MONTH, F.col(MONTH).cast("string"))
        parts.append(rows.where(F.coalesce(F.col(MONTH), F.lit("")).isin(*months)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _iso(covered: tuple[Day, Day]) -> list[str | None]:
    return [None if day is None else str(day)[:10] for day in covered]


def _joined(ranges: list[list[str | None]]) -> list[list[str | None]]:
    """Closed day ranges in order, joined where they overlap or adjoin; null is open."""
    out: list[list[str | None]] = []
    for low, high in sorted(ranges, key=lambda r: r[0] or ""):
        if out and (out[-1][1] is None or low is None or dt.date.fromisoformat(low) <= dt.date.fromisoformat(out[-1][1]) + dt.timedelta(1)):
            last = out[-1][1]
            out[-1][1] = None if last is None or high is None else max(last, high)
        else:
            out.append([low, high])
    return out
