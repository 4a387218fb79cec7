"""Loading a gold day into the star schema: stage, merge, check, publish or leave as it was.

The warehouse is a folder per table plus numbered manifests that name the folders in force. A load
writes new folders next to the old ones, runs the invariants on the result, and creates the next
manifest only if all of them hold. Until then, and after a failed load, readers see the
previous day's state. Of two loads that prepare the same number one wins; the other starts again
from the winner's state.

Facts are kept by day, or by month or year where days are small, and a load rewrites only the
parts it has rows for. Customers are kept in parts by a hash of the person: current versions, which a load
rewrites where it has people for, and closed ones, which it only adds to. Small parts of closed
versions are put together, `FAN` of one level into one of the next, so a row is rewritten as often as a
logarithm of the loads. A load checks only the parts it can have broken.

With `backfill` an address that arrives late is put in its place: all snapshots are kept in a log, the
versions of a person with a late one are built again from it, and the orders since are looked up again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daygrain.operators.copies import require_unique
from daygrain.operators.merge import upsert
from daygrain.operators.versions import ADDRESS, PERSON, SURROGATE, apply_feed, as_of, observed_history
from daygrain.plans import checks
from daygrain.plans.gold import dim_date
from daygrain.session import PACKED, configure, millisecond_timestamps
from daygrain.sinks import files
from daygrain.sinks.manifests import Manifests
from daygrain.sources import schemas
from daygrain.sources.readers import no_rows, read_gold_day
from daygrain.sources.ready import gold_days

WHOLE = ""  # the one part of a table that is not kept by date
PART = "_part"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}

DIM_CUSTOMER = schemas.struct(
    "customer_sk string, customer_unique_id string, zip string, city string, state string, "
    "valid_from date, valid_to date, is_current boolean"
)


CUSTOMERS = "dim_customer"
LOG = "customer_log"
_SNAPSHOT = schemas.struct(
    "customer_unique_id string, zip string, city string, state string, effective_date date"
).add("seen", "long")
# Closed parts of one level that are put together, and loads that start again after they lost.
FAN = 8
ATTEMPTS = 5
# A load of at most so many parts of a fact writes them where their rows are, a file of each part per task.
FEW_PARTS = 16


def _with_surrogate(table: str) -> StructType:
    return StructType([*schemas.GOLD[table].fields, StructField(SURROGATE, StringType())])


TABLES: dict[str, StructType] = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": schemas.GOLD["dim_product"],
    "dim_seller": schemas.GOLD["dim_seller"],
    "fact_orders": _with_surrogate("fact_orders"),
    "fact_order_items": _with_surrogate("fact_order_items"),
    "fact_sessions": schemas.GOLD["fact_sessions"],
}
DAY_COLUMN = {
    "fact_orders": "order_date",
    "fact_order_items": "order_date",
    "fact_sessions": "session_date",
}

# The gold table a dimension is fed from, where their names differ.
FEED = {"dim_customer": "customer_feed"}

# What a merge leaves as first loaded, and what it replaces without comparing.
KEPT_ON_MATCH = {
    "fact_orders": ("order_date", "customer_unique_id"),
    "fact_order_items": ("order_date", "customer_unique_id"),
}
NOT_COMPARED = {"fact_sessions": ("customer_unique_id", "session_date", "device")}


def merge_columns(table: str) -> tuple[list[str], list[str]]:
    """(compared, updated) columns of a table's merge."""
    keys = schemas.STAGING_KEYS[table]
    kept = KEPT_ON_MATCH.get(table, ())
    update = [c for c in TABLES[table].fieldNames() if c not in (*keys, *kept)]
    return [c for c in update if c not in NOT_COMPARED.get(table, ())], update


def merge_table(
    table: str, stored: DataFrame, staged: DataFrame, version_guard: bool = False, **options
) -> DataFrame:
    """Stored rows after merging the staged ones. `version_guard` keeps a stored session that
    has more events than the staged one, so days may be replayed in any order."""
    compare, update = merge_columns(table)
    if version_guard and table == "fact_sessions":
        options["guard"] = F.col("s.n_events") >= F.col("t.n_events")
    keys = schemas.STAGING_KEYS[table]
    return upsert(stored, staged, keys, compare=compare, update=update, **options)


def stage(spark: SparkSession, gold_dir: str, dt: str) -> dict[str, DataFrame]:
    """The day's gold frames in staging column order; a table without files is empty.

    Two staged rows with one key fail the load instead of letting a merge pick one.
    """
    return {
        table: require_unique(
            read_gold_day(spark, gold_dir, table, dt), keys, f"staged {table} of {dt}"
        )
        for table, keys in schemas.STAGING_KEYS.items()
    }


def apply_dimensions(
    stored: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    return {
        "dim_customer": apply_feed(stored["dim_customer"], staged["customer_feed"]),
        **{t: merge_table(t, stored[t], staged[t]) for t in ("dim_product", "dim_seller")},
    }


def apply_facts(
    stored: Mapping[str, DataFrame],
    staged: Mapping[str, DataFrame],
    people: DataFrame,
    version_guard: bool = False,
) -> dict[str, DataFrame]:
    """Facts after the day; orders and items take the customer version of their date."""
    resolved = {
        t: as_of(staged[t], people, "order_date") for t in ("fact_orders", "fact_order_items")
    }
    resolved["fact_sessions"] = staged["fact_sessions"]
    return {t: merge_table(t, stored[t], df, version_guard) for t, df in resolved.items()}


def apply_day(
    stored: Mapping[str, DataFrame], staged: Mapping[str, DataFrame], version_guard: bool = False
) -> dict[str, DataFrame]:
    """All tables after one staged day. Dimensions come first: facts look up their version."""
    dims = apply_dimensions(stored, staged)
    return {**dims, **apply_facts(stored, staged, dims["dim_customer"], version_guard)}


def _at_once(spark: SparkSession, jobs: Mapping[str, Callable[[], object]]) -> dict:
    """Results of independent Spark jobs, submitted together so small ones fill idle slots."""
    if not jobs:
        return {}
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job))
            for name, job in jobs.items()
        }
        return {name: future.result() for name, future in running.items()}


class InvariantError(ValueError):
    """A load would break an invariant; nothing of it was published."""


class Warehouse:
    """The published tables below one folder.

    `grain` is how the facts are cut into parts: by day, month or year, for all of them or by
    table. `buckets` is the number of customer parts, fixed by the first load. `calendar` replaces
    the shop's date dimension. `backfill` has to be on from the first load.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        version_guard: bool = False,
        calendar: DataFrame | None = None,
        grain: str | Mapping[str, str] = "day",
        buckets: int = 16,
        backfill: bool = False,
    ):
        self.spark, self.folder, self.version_guard = spark, folder, version_guard
        per_table = dict.fromkeys(DAY_COLUMN, grain) if isinstance(grain, str) else grain
        self.grain = {t: GRAINS[per_table.get(t, "day")] for t in DAY_COLUMN}
        self.calendar = dim_date(spark) if calendar is None else calendar
        self.manifests, self.buckets, self.backfill = Manifests(spark, folder), buckets, backfill

    def manifest(self) -> dict[str, dict[str, str]]:
        """Table to part to folder, as last published."""
        return self._published()[1]

    def _published(self) -> tuple[int, dict[str, dict[str, str]]]:
        number, found = self.manifests.latest()
        return number, {table: {} for table in TABLES} if found is None else found

    def read(
        self,
        table: str,
        manifest: Mapping[str, Mapping[str, str]] | None = None,
        parts: Iterable[str] | None = None,
    ) -> DataFrame:
        """A table, or only the given parts of it: folders of others are not even listed."""
        folders = (manifest or self.manifest()).get(table, {})
        wanted = [f for part, f in folders.items() if parts is None or part in parts]
        schema = _SNAPSHOT if table == LOG else TABLES[table]
        if not wanted:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(
            *[files.join(self.folder, f) for f in wanted]
        )

    def tables(self, manifest: Mapping | None = None) -> dict[str, DataFrame]:
        manifest = manifest or self.manifest()
        found = {table: self.read(table, manifest) for table in TABLES}
        return {**found, "dim_date": self.calendar}

    def _part_of(self, table: str) -> Column:
        return F.date_format(DAY_COLUMN[table], self.grain[table]).alias(PART)

    def _write(
        self, table: str, df: DataFrame, run: str, parts: Iterable[str] = ()
    ) -> dict[str, str]:
        """Write a table's new rows below this run's folder; returns part to folder.

        `parts` are those the rows of a fact are expected in.
        """
        home = files.join(table, f"run={run}")
        at = files.join(self.folder, home)
        if table not in DAY_COLUMN:
            df.write.mode("overwrite").options(**PACKED).parquet(at)
            return {WHOLE: home}
        df = df.withColumn(PART, self._part_of(table))
        if len(set(parts)) > FEW_PARTS:
            # Rebalancing puts a part's rows together and splits one that is too big for a task.
            df = df.hint("rebalance", PART)
        df.write.mode("overwrite").options(**PACKED).partitionBy(PART).parquet(at)
        return {
            name.split("=", 1)[1]: files.join(home, name)
            for name in files.children(self.spark, at)
            if name.startswith(f"{PART}=")
        }

    def _write_all(
        self, frames: Mapping[str, DataFrame], run: str, parts: Mapping[str, list[str]] | None = None
    ) -> dict[str, dict[str, str]]:
        parts = parts or {}
        return _at_once(
            self.spark,
            {t: lambda t=t: self._write(t, frames[t], run, parts.get(t, ())) for t in frames},
        )

    def _touched_parts(
        self, table: str, staged: DataFrame, manifest: Mapping[str, Mapping[str, str]]
    ) -> tuple[list[str], set[int]]:
        """Parts to rewrite: those of the staged rows, and those where their keys are stored; and
        the buckets of the people of both.

        Only keys, days and people are read, and at most one row per part and bucket is returned.
        """
        keys, part = schemas.STAGING_KEYS[table], self._part_of(table)
        bucket = self._bucket(manifest).alias("_bucket")
        stored = self.read(table, manifest).select(*keys, part, bucket)
        hit = stored.join(staged.select(*keys), keys, "left_semi").select(PART, "_bucket")
        found = staged.select(part, bucket).unionByName(hit).distinct().collect()
        return sorted({r[PART] for r in found}), {r["_bucket"] for r in found}

    # Customers: parts `<kind>-<bucket>-<buckets>`, closed ones and the log with `-<level>-<run>`.

    def _count_of_buckets(self, manifest: Mapping[str, Mapping[str, str]]) -> int:
        return next((int(p.split("-")[2]) for p in manifest.get(CUSTOMERS, {})), self.buckets)

    def _bucket(self, manifest: Mapping[str, Mapping[str, str]]) -> Column:
        return F.pmod(F.xxhash64(PERSON), F.lit(self._count_of_buckets(manifest))).cast("int")

    def _buckets_of(self, people: DataFrame, manifest: Mapping) -> set[int]:
        """At most one row per bucket is returned."""
        return {r[0] for r in people.select(self._bucket(manifest)).distinct().collect()}

    def _customer_parts(
        self, manifest: Mapping, buckets: Iterable[int], kinds: Iterable[str], table: str = CUSTOMERS
    ) -> list[str]:
        wanted = {(k, f"{b:03d}") for k in kinds for b in buckets}
        return [p for p in manifest.get(table, {}) if tuple(p.split("-")[:2]) in wanted]

    def _write_by_bucket(
        self, df: DataFrame, kind: Column, at: str, manifest: Mapping
    ) -> dict[str, str]:
        """Part name without level and run, to its folder."""
        count = F.lit(self._count_of_buckets(manifest))
        name = F.format_string("%s-%03d-%03d", kind, self._bucket(manifest), count)
        (
            df.withColumn(PART, name)
            .hint("rebalance", PART)
            .write.mode("overwrite")
            .options(**PACKED)
            .partitionBy(PART)
            .parquet(files.join(self.folder, at))
        )
        names = files.children(self.spark, files.join(self.folder, at))
        return {n.split("=", 1)[1]: files.join(at, n) for n in names if n.startswith(f"{PART}=")}

    def _add_parts(self, after: dict, table: str, written: Mapping[str, str], level: int, run: str):
        after[table].update({f"{name}-{level}-{run}": at for name, at in written.items()})

    def _write_customers(
        self, rows: DataFrame, after: dict, replaced: Iterable[str], run: str
    ) -> None:
        """Replace parts by new ones: current rows stand alone in their bucket, closed ones join others."""
        kind = F.when(F.col("is_current"), "open").otherwise("closed")
        written = self._write_by_bucket(rows, kind, files.join(CUSTOMERS, f"run={run}"), after)
        for part in replaced:
            del after[CUSTOMERS][part]
        after[CUSTOMERS].update({n: at for n, at in written.items() if n.startswith("open")})
        closed = {n: at for n, at in written.items() if n.startswith("closed")}
        self._add_parts(after, CUSTOMERS, closed, 0, run)

    def _put_together(self, after: dict, table: str, run: str) -> None:
        """Where a bucket has `FAN` added parts of one level, make them one of the next level."""
        level = 0
        while True:
            by_name: dict[str, list[str]] = {}
            for part in after[table]:
                *name, at, _ = part.split("-") if part.count("-") > 2 else (part, "-1", "")
                if int(at) == level:
                    by_name.setdefault("-".join(name), []).append(part)
            full = {name: parts for name, parts in by_name.items() if len(parts) >= FAN}
            if not full:
                return
            old = [p for parts in full.values() for p in parts]
            at = files.join(table, f"run={run}", f"level={level + 1}")
            kind = F.lit(next(iter(full)).split("-")[0])
            written = self._write_by_bucket(self.read(table, after, old), kind, at, after)
            for part in old:
                del after[table][part]
            self._add_parts(after, table, written, level + 1, run)
            level += 1

    def _late(self, feed: DataFrame, log: DataFrame) -> DataFrame:
        """People with a staged snapshot older than another one of theirs, and its day."""
        known = log.groupBy(PERSON).agg(F.max("effective_date").alias("_known"))
        return (
            feed.join(known, PERSON)
            .where(F.col("effective_date") < F.col("_known"))
            .groupBy(PERSON)
            .agg(F.min("effective_date").alias("_since"))
        )

    def _load_customers(
        self, feed: DataFrame, after: dict, number: int, run: str
    ) -> tuple[set[int], DataFrame | None]:
        """Merge the staged snapshots; returns their buckets and the people with a late one."""
        before = {t: dict(parts) for t, parts in after.items()}
        buckets = self._buckets_of(feed, after)
        open_parts = self._customer_parts(after, buckets, ["open"])
        stored, replaced, late = self.read(CUSTOMERS, after, open_parts), list(open_parts), None
        if self.backfill:
            if before[CUSTOMERS] and not before.get(LOG):
                raise ValueError("backfill has to be on from the first load: there is no log of snapshots")
            after.setdefault(LOG, {})
            log = self.read(LOG, before, self._customer_parts(before, buckets, ["log"], LOG))
            new = feed.select(PERSON, *ADDRESS, "effective_date").withColumn("seen", F.lit(number).cast("long"))
            late = self._late(feed, log)
            if late.isEmpty():
                late = None
        if late is None:
            rows = apply_feed(stored, feed)
        else:
            there = late.select(PERSON)
            again = self._buckets_of(there, before)
            closed_parts = self._customer_parts(before, again, ["closed"])
            closed = self.read(CUSTOMERS, before, closed_parts)
            replaced += closed_parts
            seen = log.unionByName(new).join(there, PERSON, "left_semi")
            rows = (
                apply_feed(stored.join(there, PERSON, "left_anti"), feed.join(there, PERSON, "left_anti"))
                .unionByName(closed.join(there, PERSON, "left_anti"))
                .unionByName(observed_history(seen, "seen"))
            )
        self._write_customers(rows, after, replaced, run)
        if self.backfill:
            at = files.join(LOG, f"run={run}")
            self._add_parts(after, LOG, self._write_by_bucket(new, F.lit("log"), at, before), 0, run)
            self._put_together(after, LOG, run)
        self._put_together(after, CUSTOMERS, run)
        return buckets, late

    def _parts_since(self, table: str, late: DataFrame, manifest: Mapping) -> list[str]:
        """Parts with orders of these people from their late snapshot on."""
        since = late.agg(F.date_format(F.min("_since"), self.grain[table])).first()[0]
        later = [p for p in manifest[table] if p >= since]
        stored = self.read(table, manifest, later).select(PERSON, DAY_COLUMN[table], self._part_of(table))
        met = stored.join(late, PERSON).where(F.col(DAY_COLUMN[table]) >= F.col("_since"))
        return [r[PART] for r in met.select(PART).distinct().collect()]

    def _exposed(
        self,
        staged: Mapping[str, DataFrame],
        parts: Mapping[str, list[str]],
        buckets: set[int],
        after: Mapping,
    ) -> dict[str, DataFrame]:
        """The tables as far as a load of the staged rows can have broken an invariant.

        What was published before holds all of them, so a broken one involves a row of a
        dimension or of a touched part: a key stored elsewhere would have made that part a
        touched one. Customers are read in the buckets of all people of the load, and orders meet
        them only if their person is in one. Orders and items are compared with each other, so a
        part that one of them touched is read of both. A version that a late address closes may
        be in use from that day on, so the orders of all later parts are read, too.
        """
        pair = "fact_orders", "fact_order_items"
        read: dict[str, set[str]] = {t: set(parts.get(t, ())) for t in DAY_COLUMN}
        if self.grain[pair[0]] == self.grain[pair[1]]:
            both = read[pair[0]] | read[pair[1]]
        else:
            both = {p for t in pair for p in after[t]}
        closed = staged["customer_feed"].agg(
            F.date_format(F.min("effective_date"), self.grain["fact_orders"])
        )
        since = closed.first()[0]
        later = {p for p in after["fact_orders"] if since is not None and p >= since}
        read |= {"fact_orders": both | later, "fact_order_items": both}
        read[CUSTOMERS] = set(self._customer_parts(after, buckets, ["open", "closed"]))
        found = {t: self.read(t, after, read.get(t)) for t in TABLES}
        among = found["fact_orders"].where(self._bucket(after).isin(sorted(buckets)))
        return {**found, checks.VERSIONED: among, "dim_date": self.calendar}

    def violations(self) -> list[tuple[str, int]]:
        """The invariants that the published tables break, checked on all parts."""
        return checks.violations(self.tables())

    def load_day(self, dt: str, gold_dir: str) -> list[str]:
        """Load one gold day; returns the tables it shipped.

        Raises, and publishes nothing, if an invariant is violated. Folders of a load that was
        not published are removed.
        """
        configure(self.spark)
        for _ in range(ATTEMPTS):
            number, before = self._published()
            run = uuid.uuid4().hex
            try:
                shipped, after = self._prepare(dt, gold_dir, number + 1, before, run)
                won = self.manifests.publish(number + 1, after)
            except BaseException:
                self._discard(run)
                raise
            if won:
                return sorted(shipped)
            self._discard(run)
        raise RuntimeError(f"{dt}: other loads were published {ATTEMPTS} times meanwhile, nothing published")

    def _discard(self, run: str) -> None:
        for table in (*TABLES, LOG):
            files.delete_folder(self.spark, files.join(self.folder, table, f"run={run}"))

    def _prepare(
        self, dt: str, gold_dir: str, number: int, before: Mapping, run: str
    ) -> tuple[set[str], dict[str, dict[str, str]]]:
        """Write the folders of the state after the day; returns what it shipped and that state."""
        spark = self.spark
        shipped = {
            t for t in schemas.GOLD if files.exists(spark, files.join(gold_dir, t, f"dt={dt}"))
        }
        staged = stage(spark, gold_dir, dt)
        touched = _at_once(
            spark,
            {
                t: lambda t=t: self._touched_parts(t, staged[t], before)
                for t in DAY_COLUMN
                if t in shipped
            },
        )
        parts = {t: found for t, (found, _) in touched.items()}
        versioned = ("fact_orders", "fact_order_items")
        # Looking up versions takes staged rows away from their key, so that the test for a repeated key
        # would be one more shuffle of whole rows: here only keys travel for it.
        _at_once(
            spark,
            {
                t: staged[t].agg(F.count(schemas.STAGING_KEYS[t][0])).collect
                for t in versioned
                if t in shipped
            },
        )
        staged |= {t: read_gold_day(spark, gold_dir, t, dt) for t in versioned}
        # Sessions have no version of their person.
        people_in = set().union(*(b for t, (_, b) in touched.items() if t in versioned))
        after = {t: dict(found) for t, found in {**dict.fromkeys(TABLES, {}), **before}.items()}
        late = None

        with millisecond_timestamps(spark):
            # The dimensions are written first, so that the facts read the customer versions from
            # their folder and do not run that merge again.
            if FEED[CUSTOMERS] in shipped:
                met, late = self._load_customers(staged[FEED[CUSTOMERS]], after, number, run)
                people_in |= met
            plain = {
                t: merge_table(t, self.read(t, before), staged[t])
                for t in ("dim_product", "dim_seller")
                if t in shipped
            }
            after |= self._write_all(plain, run)
            if late is not None:
                for t in versioned:
                    parts[t] = sorted({*parts.get(t, ()), *self._parts_since(t, late, before)})
            in_buckets = self._customer_parts(after, people_in, ["open", "closed"])
            people = self.read(CUSTOMERS, after, in_buckets)
            stored = {t: self.read(t, before, parts.get(t)) for t in DAY_COLUMN}
            facts = apply_facts(stored, staged, people, self.version_guard)
            if late is not None:
                facts |= {t: self._versions_again(facts[t], late, people) for t in versioned}
            facts = {t: df for t, df in facts.items() if t in parts}
            for table, folders in self._write_all(facts, run, parts).items():
                # A part whose last row moved to another part has no folder any more.
                for part in parts[table]:
                    after[table].pop(part, None)
                after[table].update(folders)

        # What looks broken in a part of the tables counts only if it is in the whole of them.
        found = checks.violations(
            self._exposed(staged, parts, people_in, after)
        ) and checks.violations(self.tables(after))
        if found:
            raise InvariantError(f"{dt}: invariants violated, nothing published: {found}")
        return shipped, after

    @staticmethod
    def _versions_again(facts: DataFrame, late: DataFrame, people: DataFrame) -> DataFrame:
        """Facts of people with a late snapshot point to the version of their date as it is now."""
        columns, there = facts.columns, late.select(PERSON)
        moved = as_of(facts.join(there, PERSON, "left_semi").drop(SURROGATE), people, "order_date")
        return facts.join(there, PERSON, "left_anti").unionByName(moved.select(columns))

    def vacuum(self, keep: int = 1) -> int:
        """Remove folders that only states before the last `keep` name; returns their number.

        Folders of a load under way are in no state yet and stay. Readers of a removed state fail.
        """
        numbers = self.manifests.numbers()
        states = {n: self.manifests.read(n) or {} for n in numbers}
        folders = {n: {f for parts in s.values() for f in parts.values()} for n, s in states.items()}
        kept = set().union(*(folders[n] for n in numbers[-keep:]))
        old = set().union(*(folders[n] for n in numbers[:-keep])) - kept
        for folder in old:
            files.delete_folder(self.spark, files.join(self.folder, folder))
        for n in numbers[:-keep]:
            self.manifests.forget(n)
        return len(old)

    def load_all(self, gold_dir: str) -> list[str]:
        """Load every gold day in date order; a day counts if any table has it."""
        days = gold_days(self.spark, gold_dir, schemas.GOLD)
        for dt in days:
            self.load_day(dt, gold_dir)
        return days


def load_day(spark: SparkSession, dt: str, gold_dir: str, folder: str) -> list[str]:
    return Warehouse(spark, folder).load_day(dt, gold_dir)
