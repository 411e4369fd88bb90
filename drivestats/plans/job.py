"""End-to-end refresh of statistics tables (E1-E3) with load control (L1-L4)."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from drivestats.functions.motion import DEFAULT_THRESHOLDS, EventThresholds
from drivestats.functions.timeparts import PARTITION_PARTS, in_partitions, partition_after, partition_start
from drivestats.operators.pairs import shuffle_width
from drivestats.operators.partitions import has_new_data, partition_paths
from drivestats.operators.segments import bucket_segments, merged, overlapping, trip_segments
from drivestats.operators.trips import complete_key
from drivestats.operators.rollup import rollup_stats
from drivestats.plans.grains import Grain, grain as as_grain
from drivestats.plans.stats import build_many, build_stats
from drivestats.session import work_path
from drivestats.sources import gold
from drivestats.sources.commits import Commit, CommitLog, newest_partition
from drivestats.sources.positions import check_positions, normalize, read_positions

log = logging.getLogger("drivestats")


# What an incremental run does with samples of time buckets that are already published.
APPEND, REBUILD, MERGE = "append", "rebuild", "merge"
LATE_ROWS = (APPEND, REBUILD, MERGE)
# Samples behind a staged row, kept in the commit log only.
SAMPLES = "_samples"
# Directories of the segment state; its rows have all of the output's partition columns.
STATE_PARTS = ("year", "month")


@dataclass
class RunResult:
    grain: str
    load_type: str  # effective load type after the fallback
    watermark: dt.datetime | None  # start of the newest source partition read before this run
    wrote: bool
    partitions: list[str] = field(default_factory=list)  # paths of all partitions that the run wrote or changed
    table: str | None = None
    rows_read: int = 0  # source rows after the watermark
    rows_rejected: int = 0  # of these, rows without a complete bucket key (unreadable ts, no trip id)
    rows_held: int = 0  # of these, late rows that were not taken in (see ``run``)


def validate_load_type(load_type: str) -> str:
    """L1: only FULL_LOAD and INCREMENTAL are accepted."""
    if load_type not in gold.LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r}: use one of {', '.join(gold.LOAD_TYPES)}")
    return load_type


def run(
    spark: SparkSession,
    grain: str | Grain,
    load_type: str,
    source: str | Sequence[str] | DataFrame,
    target_path: str,
    database: str | None = None,
    table: str | None = None,
    sample_seconds: float = 1.0,
    thresholds: EventThresholds = DEFAULT_THRESHOLDS,
    strategy: str = "blocks",
    reprocess_latest: bool = False,
    late_rows: str = APPEND,
    zone: str = "UTC",
) -> RunResult:
    """Refresh the ``grain`` table at ``target_path`` from positions at ``source``.

    * L1 validate the load type; L2 fall back to a full load when the target
      (catalog entry if named, and data) does not exist yet.
    * L3 the watermark is the newest source partition read so far, kept in the
      commit log beside the table (``sources/commits.py``); a table without a
      log falls back to its newest published partition, as the reference does.
    * P3 read only source partitions strictly after it (``reprocess_latest``
      reads the newest partition too).
    * L4 stop when nothing is new; otherwise one lazy plan, staged, recorded and
      then published. The row counts and the new mark are observed on that
      plan as it runs. A run that died is finished, or cleared away, by the
      next one, so a repeated run changes nothing.

    Source partitions follow arrival, time buckets follow the samples' own
    time, so new partitions may hold samples of buckets already published:

    * ``late_rows="append"`` (default, as the reference does) adds their
      statistics as a further row of the bucket.
    * ``late_rows="merge"`` keeps a state table of segments and merges late
      samples into it; the source of older samples is not read and need not
      exist any more. Late samples of a trip bucket in which a counter came
      twice, so that they fall inside a segment, are held: set aside under
      the run's ``held`` folder, counted, their bucket left as it is.
    * ``late_rows="rebuild"``, which ``reprocess_latest`` implies, builds the
      touched partitions again from the source partitions of the runs that
      wrote them. A partition for which the source now yields fewer samples
      than were published and are new is held, and left as it is.

    A full load without a single usable row leaves the target as it is.
    """
    g = as_grain(grain)
    load_type = validate_load_type(load_type)
    if late_rows not in LATE_ROWS:
        raise ValueError(f"unknown late_rows {late_rows!r}: use one of {', '.join(LATE_ROWS)}")
    if late_rows == MERGE and reprocess_latest:
        raise ValueError("merge takes every source partition once: reprocess_latest needs late_rows='rebuild'")
    commits = CommitLog(spark, target_path)
    last = _recover(spark, commits, g, target_path)
    if load_type == gold.INCREMENTAL and not gold.target_exists(spark, target_path, database, table):
        log.info("no history for %s at %s: switching to FULL_LOAD", g.name, target_path)
        load_type = gold.FULL_LOAD

    watermark = None
    if load_type == gold.INCREMENTAL:
        watermark = last.mark if last else newest_partition(spark, target_path, g.output_parts)
        if watermark is None:
            load_type = gold.FULL_LOAD
        elif late_rows == MERGE and not (last and last.has_state):
            raise ValueError("late_rows='merge' needs the segment state: make a full load with it first")

    source_rows = check_positions(source) if isinstance(source, DataFrame) else read_positions(spark, source)
    read_from = watermark
    if watermark is not None and reprocess_latest:
        read_from = watermark - dt.timedelta(microseconds=1)

    result = RunResult(g.name, load_type, watermark, wrote=False)
    run_no = last.run + 1 if last else 1
    if has_new_data(source_rows, read_from, g.source_parts):
        new_rows = source_rows if read_from is None else source_rows.where(partition_after(g.source_parts, read_from))
        work = _Work(spark, g, commits, run_no, target_path, sample_seconds, thresholds, strategy, zone)
        rebuild = watermark is not None and (reprocess_latest or late_rows == REBUILD)
        if late_rows == MERGE:
            commit = work.stage_merged(new_rows, load_type)
        elif rebuild:
            commit = work.stage_rebuilt(source_rows, new_rows, last)
        else:
            commit = work.stage_built(new_rows, load_type)
        result.rows_read, result.rows_rejected, result.rows_held = commit.rows_read, commit.rows_rejected, commit.rows_held
        if commit.rows_rejected:
            log.warning("%d of %d rows for %s have no complete bucket key", commit.rows_rejected, commit.rows_read, g.name)
        if commit.rows_held:
            log.warning("%d late rows for %s are held, see %s", commit.rows_held, g.name, commits.run_path(run_no))
        result.wrote = commit.has_rows
        if load_type == gold.FULL_LOAD and not commit.has_rows:
            commits.delete(commits.run_path(run_no))
        else:
            commits.record(commit)
            _publish(commits, commit, g, target_path)
            last = commit
    else:
        log.info("no new source data for %s after %s", g.name, watermark)

    if result.wrote:
        result.partitions = _changed(commits, run_no, g)
    if table and gold.path_exists(spark, target_path):
        result.table = _register(spark, commits, last, g, target_path, database, table)
    elif last and commits.published(last.run) is None:
        commits.mark_published(last.run, None)
    if result.wrote and load_type == gold.FULL_LOAD:
        commits.forget(before=run_no)
    return result


def _recover(spark: SparkSession, commits: CommitLog, g: Grain, target: str) -> Commit | None:
    """The newest recorded run. What was staged without a record goes; what was recorded is published."""
    last = None
    for n in commits.runs():
        commit = commits.commit(n)
        if commit is None:
            commits.delete(commits.run_path(n))
        else:
            last = commit
    if last and commits.published(last.run) is None:
        log.info("finishing run %d of %s", last.run, g.name)
        _publish(commits, last, g, target)
    return last


def _publish(commits: CommitLog, commit: Commit, g: Grain, target: str) -> None:
    """Replaces the staged partitions (all, on a full load) in the table and in the state; may be repeated."""
    dynamic = commit.load_type != gold.FULL_LOAD
    if commit.has_rows:
        rows = commits.staged(commit.run, "rows", f"{g.output_schema}, `{SAMPLES}` BIGINT").drop(SAMPLES)
        gold.write_stats(rows, target, g.output_parts, commit.load_type, dynamic_overwrite=dynamic)
    if commit.has_state and commit.has_rows:
        state = commits.staged(commit.run, "state")
        gold.write_partitioned(state, commits.state_path, STATE_PARTS, dynamic, [*g.bucket_keys, "first"], shuffle_width(state))


def _changed(commits: CommitLog, run_no: int, g: Grain) -> list[str]:
    """Paths of the partitions that a run staged: bounded by the calendar."""
    staged = commits.staged(run_no, "rows", f"{g.output_schema}, `{SAMPLES}` BIGINT")
    return sorted(r["path"] for r in partition_paths(staged, g.output_parts).collect())


def _register(spark, commits: CommitLog, last: Commit | None, g: Grain, target: str, database, table) -> str:
    """S6: the partitions of the newest run if the entry held all others before, else all of the storage."""
    name = gold.table_name(database, table)
    before = [n for n in commits.runs() if last and n < last.run]
    known = bool(before) and (commits.published(before[-1]) or {}).get("table") == name
    here = commits.published(last.run) if last else None
    if known and here is None and last.load_type == gold.INCREMENTAL and gold.table_exists(spark, database, table):
        gold.add_partitions(spark, database, table, _changed(commits, last.run, g) if last.has_rows else [])
    elif here is None or here.get("table") != name or not gold.table_exists(spark, database, table):
        gold.register_table(spark, target, database, table, g.output_parts, g.output_schema)
    if last and (here is None or here.get("table") != name):
        commits.mark_published(last.run, name)
    return name


class _Seen:
    """Row counts and the newest source partition, observed on the plan that reads the rows."""

    def __init__(self, grains: Sequence[Grain], rows: DataFrame, zone: str):
        marks = [F.max(F.struct(*g.source_parts)).alias(f"mark_{g.name}") for g in grains]
        bad = [F.count_if(~complete_key(g)).alias(f"bad_{g.name}") for g in grains]
        self._of = [(Observation(), [F.count(F.lit(1)).alias("n"), *marks], rows)]
        rows = rows.observe(*self._of[0][:1], *self._of[0][1])
        self._of.append((Observation(), bad, normalize(rows, zone)))
        self.samples = self._of[1][2].observe(self._of[1][0], *bad)
        self._values: dict | None = None

    def of(self, g: Grain) -> tuple[dt.datetime | None, int, int]:
        """(newest source partition, rows read, rows rejected), once the plan has run."""
        if self._values is None:
            self._values = {}
            for observation, columns, rows in self._of:
                try:
                    self._values |= observation.get
                except Py4JJavaError:
                    # No row was left to compute with, so the adaptive plan dropped the part that counts.
                    self._values |= rows.agg(*columns).first().asDict()
        mark = self._values[f"mark_{g.name}"]
        parts = mark.asDict() if mark is not None else {}
        start = None
        if parts and None not in parts.values():
            start = dt.datetime(*[int(parts.get(p, 1 if p in ("month", "day") else 0)) for p in PARTITION_PARTS])
        return start, self._values["n"], self._values[f"bad_{g.name}"]


class _Work:
    """One run's staging: every method writes ``rows`` (and ``state``) under the run's folder and returns its commit."""

    def __init__(self, spark, g: Grain, commits: CommitLog, run_no: int, target: str, sample_seconds, thresholds, strategy, zone):
        self.spark, self.g, self.commits, self.run_no, self.target = spark, g, commits, run_no, target
        self.sample_seconds, self.thresholds, self.strategy, self.zone = sample_seconds, thresholds, strategy, zone
        self.schema = f"{g.output_schema}, `{SAMPLES}` BIGINT"

    def _observed(self, new_rows: DataFrame) -> tuple[DataFrame, _Seen]:
        """The normalised rows, with their number, newest source partition and rejected rows counted where the plan runs."""
        seen = _Seen([self.g], new_rows, self.zone)
        return seen.samples, seen

    def _commit(self, seen: _Seen, load_type: str, **more) -> Commit:
        mark, n, bad = seen.of(self.g)
        return Commit(self.run_no, self.g.name, load_type, mark.isoformat() if mark else None, n, bad, **more)

    def _stage(self, df: DataFrame, part: str) -> DataFrame:
        path = self.commits.run_path(self.run_no, part)
        df.write.parquet(path)  # flat: only the published table has a directory per time bucket
        return self.spark.read.schema(df.schema).parquet(path)

    def _touched(self, staged: DataFrame) -> list[Row]:
        """The output partitions of a staged table: bounded by the calendar."""
        return staged.select(*self.g.output_parts).distinct().collect()

    def _stats(self, samples: DataFrame) -> DataFrame:
        return build_stats(
            samples, self.g, sample_seconds=self.sample_seconds, thresholds=self.thresholds, strategy=self.strategy,
            normalized=True, samples=SAMPLES,
        )

    def stage_built(self, new_rows: DataFrame, load_type: str) -> Commit:
        """Statistics of the new rows; on an incremental run beside the rows that their partitions hold already."""
        samples, seen = self._observed(new_rows)
        if load_type == gold.FULL_LOAD:
            rows = self._stage(self._stats(samples), "rows")
            return self._commit(seen, load_type, has_rows=not rows.isEmpty())
        new = self._stage(self._stats(samples), "new")
        touched = self._touched(new)
        if touched:
            before = gold.read_gold(self.spark, self.target, self.g.output_schema).where(in_partitions(self.g.output_parts, touched))
            self._stage(new.unionByName(before, allowMissingColumns=True), "rows")
        return self._commit(seen, load_type, has_rows=bool(touched), replaces=False)

    def stage_merged(self, new_rows: DataFrame, load_type: str) -> Commit:
        """Segments of the new rows, merged with those that the state holds of their partitions."""
        g, full = self.g, load_type == gold.FULL_LOAD
        samples, seen = self._observed(new_rows)
        fresh = self._stage(bucket_segments(samples, g, self.thresholds), "state" if full else "fresh")
        days = self._stage(fresh.select(*g.output_parts).distinct(), "touched")  # bounded by the calendar
        touched, held = days.collect(), 0
        if not touched:
            return self._commit(seen, load_type, has_rows=False, has_state=not full)
        # What a full load wrote is of touched partitions throughout.
        state = of_touched = fresh
        if not full:
            months = [dict(zip(STATE_PARTS, m)) for m in {tuple(r[p] for p in STATE_PARTS) for r in touched}]
            old = self.spark.read.schema(fresh.schema).parquet(self.commits.state_path).where(in_partitions(STATE_PARTS, months))
            keys = list(dict.fromkeys([*g.output_parts, *g.bucket_keys]))
            clash = overlapping(old.unionByName(fresh), keys)
            path = self.commits.run_path(self.run_no, "clash")
            clash.write.parquet(path)
            clash = self.spark.read.schema(clash.schema).parquet(path).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
            if not clash.isEmpty():
                same = F.lit(True)
                for k in keys:
                    same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
                aside = self._stage(fresh.join(clash, same, "left_semi"), "held")
                held = aside.agg(F.sum("samples")).first()[0] or 0
                fresh = fresh.join(clash, same, "left_anti")
            state = self._stage(old.unionByName(fresh), "state")
            # Thousands of days in one condition cost more on every row than all else that is done with it.
            of_touched = state.join(F.broadcast(days), list(g.output_parts), "left_semi")
        trips = merged(of_touched, g, self.thresholds, samples=SAMPLES)
        self._stage(rollup_stats(trips, g, self.sample_seconds, samples=SAMPLES), "rows")
        return self._commit(seen, load_type, rows_held=held, has_rows=True, has_state=True)

    def stage_rebuilt(self, source_rows: DataFrame, new_rows: DataFrame, last: Commit | None) -> Commit:
        """The touched partitions from all source rows that fall in them, where the source is still complete."""
        g = self.g
        samples, seen = self._observed(new_rows)
        fresh = samples.where(complete_key(g)).groupBy(*g.output_parts).agg(F.count(F.lit(1)).alias("fresh"))
        path = self.commits.run_path(self.run_no, "fresh")
        fresh.write.parquet(path)
        fresh = self.spark.read.schema(fresh.schema).parquet(path)
        touched = self._touched(fresh)
        if not touched:
            return self._commit(seen, gold.INCREMENTAL, has_rows=False)
        rows = source_rows.where(self._source_of(touched, last)) if last else source_rows
        inside = rows_of_buckets(normalize(rows, self.zone), self.spark.createDataFrame(touched), g)
        built = self._stage(self._stats(inside), "rebuilt")
        got = built.groupBy(*g.output_parts).agg(F.sum(SAMPLES).alias("got"))
        # A row without a count is of a table published without a log: nothing to hold it against.
        known = self._known_samples(last, touched)
        each = fresh.join(got, list(g.output_parts), "left")
        if known is not None:
            each = each.join(known, list(g.output_parts), "left")
        else:
            each = each.withColumn("known", F.lit(0).cast("long"))
        short = each.where(F.coalesce("got", F.lit(0)) < F.coalesce("known", F.lit(0)) + F.when(F.lit(self._repeats(last, seen)), 0).otherwise(F.col("fresh")))
        held = short.collect()  # partitions, bounded by the calendar
        if held:
            built = built.where(~in_partitions(g.output_parts, held))
        self._stage(built, "rows")
        n_held = sum(r["fresh"] for r in held)
        return self._commit(seen, gold.INCREMENTAL, rows_held=n_held, has_rows=len(held) < len(touched))

    def _repeats(self, last: Commit | None, seen: _Seen) -> bool:
        """Whether the new rows include rows of the newest partition read before."""
        mark = seen.of(self.g)[0]
        return last is not None and mark is not None and last.mark is not None and mark <= last.mark

    def _known_samples(self, last: Commit | None, touched: list[Row]) -> DataFrame | None:
        """Samples behind the published rows of ``touched``: of the last run that replaced a partition, and of those that added to it."""
        parts, each = list(self.g.output_parts), None
        for commit in filter(None, map(self.commits.commit, self.commits.runs())):
            if last is not None and commit.run <= last.run and commit.has_rows:
                rows = self.commits.staged(commit.run, "rows", self.schema).where(in_partitions(parts, touched))
                rows = rows.groupBy(*parts).agg(F.sum(SAMPLES).alias("n")).select("*", F.lit(commit.run).alias("run"), F.lit(commit.replaces).alias("replaces"))
                each = rows if each is None else each.union(rows)
        if each is None:
            return None
        since = F.max(F.when(F.col("replaces"), F.col("run"))).over(Window.partitionBy(*parts))
        counted = each.withColumn("since", F.coalesce(since, F.lit(0))).where("run >= since")
        return counted.groupBy(*parts).agg(F.sum("n").alias("known"))

    def _source_of(self, touched: list[Row], last: Commit) -> Column:
        """The source partitions of the runs that wrote ``touched``, and all newer ones.

        Partition columns only, so it prunes directories. A full load stands
        for all partitions up to its mark.
        """
        g, wanted = self.g, F.lit(False)
        before = None
        for n in self.commits.runs():
            commit = self.commits.commit(n)
            if commit is None or n > last.run or commit.mark is None:
                continue
            wrote = commit.has_rows and not self.commits.staged(n, "rows", self.schema).where(in_partitions(g.output_parts, touched)).isEmpty()
            if wrote:
                inside = ~partition_after(g.source_parts, commit.mark)
                wanted = wanted | (inside if before is None or commit.load_type == gold.FULL_LOAD else inside & partition_after(g.source_parts, before))
            before = commit.mark
        return wanted | partition_after(g.source_parts, last.mark - dt.timedelta(microseconds=1)) if last.mark else F.lit(True)


def rows_of_buckets(samples: DataFrame, buckets: DataFrame, g: Grain) -> DataFrame:
    """The normalised samples whose own time falls in one of ``buckets`` (rows of output parts).

    ``buckets`` holds a row per time bucket, a bounded number. The first and the
    last of them also bound ``ts``, which reaches the scan as a pushed filter.
    """
    ends = buckets.select(partition_start(g.output_parts).alias("t")).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    # No partition is longer than 31 days; the join decides exactly.
    inside = F.col("ts").between(_ntz(ends["lo"]), _ntz(ends["hi"] + dt.timedelta(days=31)))
    return samples.where(inside).join(F.broadcast(buckets), list(g.output_parts), "left_semi")


def _ntz(t: dt.datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def run_full_many(
    spark: SparkSession, source: str | Sequence[str] | DataFrame, targets: dict[str, str], sample_seconds: float = 1.0, zone: str = "UTC"
) -> dict[str, RunResult]:
    """Full loads of several grains from one scan and one shuffle of the samples.

    ``targets`` maps grain names to paths. The samples become segments once, in
    the shared folder; each table is computed from them, staged and published
    as by ``run``, so later incremental runs go on from its mark.
    """
    grains = [as_grain(name) for name in targets]
    source_rows = check_positions(source) if isinstance(source, DataFrame) else read_positions(spark, source)
    seen = _Seen(grains, source_rows, zone)
    path = work_path(spark, "segments")
    trip_segments(seen.samples).write.parquet(path)
    segments = spark.read.parquet(path)
    out = {}
    for g, (name, stats) in zip(grains, build_many(segments, grains, sample_seconds, SAMPLES).items()):
        target = targets[name]
        commits = CommitLog(spark, target)
        last = _recover(spark, commits, g, target)
        run_no = last.run + 1 if last else 1
        stats.write.parquet(commits.run_path(run_no, "rows"))
        staged = commits.staged(run_no, "rows", f"{g.output_schema}, `{SAMPLES}` BIGINT")
        start, n, bad = seen.of(g)
        result = RunResult(name, gold.FULL_LOAD, None, not staged.isEmpty(), rows_read=n, rows_rejected=bad)
        if result.wrote:
            commit = Commit(run_no, name, gold.FULL_LOAD, start.isoformat() if start else None, result.rows_read, result.rows_rejected)
            commits.record(commit)
            _publish(commits, commit, g, target)
            commits.mark_published(run_no, None)
            commits.forget(before=run_no)
            result.partitions = _changed(commits, run_no, g)
        out[name] = result
    CommitLog(spark, path).delete(path)
    return out
