"""Z01 with W15 and X02: a ledger kept up to date file by file.

Rolling all accounts over all days again for each day's file costs accounts x
days a file.  The store keeps movements and running state in one versioned
table instead, and a file changes only what it has to:

* ``m-<hash of source>``: the movements of a source file, summed by account and
  day.  A file that comes again replaces its own rows, wherever they stood.
* ``c-<yyyy-MM>``: for each account that moved so far, the sum of its movements
  up to the end of that month.  A file whose first changed day lies in month M
  shifts the months from M on; earlier ones are neither read nor written.

So the day's file of the running month writes its own rows and one row an
account; a late file also the months after it.  Rows and state are one commit:
a job that is lost leaves both as they were, and the same file again gives the
same balances.  The daily balances of any span (W15) start from the closings of
the month before it and read the movements since; the state to resume from
(X02) is the last month's closings alone.

Defined results: rows with a null account or date are kept with their source
but move no balance; a null amount is 0; an empty batch changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesoro.operators import ledger as LG
from tesoro.sinks.versioned import Manifest, VersionedTable
from tesoro.streaming.daily_files import SOURCE_COL

MONEY = "decimal(28,2)"
COLUMNS = ["part", "source", "account_number", "date", "amount"]


def month_part(date) -> F.Column:
    return F.concat(F.lit("c-"), F.date_format(date, "yyyy-MM"))


class LedgerStore(VersionedTable):
    """Movements and month-end sums in one table of versions."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, "part")

    # --- writing ---------------------------------------------------------------

    def apply(self, rows: DataFrame, source_col: str = SOURCE_COL, account: str = "account_number",
              date_col: str = "date", amount: str = "amount") -> int | None:
        """Load the movements of one or more whole source files; each replaces
        what was loaded of it before.  The new version, None without rows."""
        source = F.col(source_col).cast("string")
        fresh = self._staged(rows.groupBy(source.alias("source"), F.col(account).cast("string").alias("account_number"),
                                          F.col(date_col).cast("date").alias("date"))
                             .agg(F.coalesce(F.sum(F.col(amount).cast(MONEY)), F.lit(0)).cast(MONEY).alias("amount"))
                             .withColumn("part", F.concat(F.lit("m-"), F.hex(F.xxhash64("source")))).select(*COLUMNS))
        # one folder a file of the batch
        written = {r["part"] for r in fresh.select("part").distinct().collect()}
        if not written:
            return None
        base = self.manifest()
        sources = fresh.select("source").distinct()
        before = self._some(base, written, fresh)
        same = before["source"].eqNullSafe(sources["source"])
        former, rest = before.join(sources, same, "left_semi"), before.join(sources, same, "left_anti")
        change = self._staged(fresh.unionByName(former.withColumn("amount", -F.col("amount")))
                              .where("account_number IS NOT NULL AND date IS NOT NULL")
                              .groupBy("account_number", month_part("date").alias("part"))
                              .agg(F.sum("amount").cast(MONEY).alias("amount")).where("amount <> 0"))
        closings = self._closings(base, change, fresh)
        out = rest.unionByName(fresh)
        if closings is not None:
            out = out.unionByName(closings)
        return self._commit(out, base, lambda part, new: part not in new)

    def _closings(self, base: Manifest | None, change: DataFrame, like: DataFrame) -> DataFrame | None:
        """The month-end rows that ``change`` (account, month, amount) makes
        anew: those of its months and of all known months after its first."""
        new = {r["part"] for r in change.select("part").distinct().collect()}   # months
        if not new:
            return None
        known = self.months(base)
        months = sorted(new | {p for p in known if p >= min(new)})
        start = {p: p if p in known else max((k for k in known if k < p), default=None) for p in months}
        carry = self.spark.createDataFrame([(p, s) for p, s in start.items() if s], "to string, part string")
        carried = (self._some(base, {s for s in start.values() if s}, like).join(carry, "part")
                   .select(F.col("to").alias("part"), "account_number", "amount"))
        later = F.filter(F.array(*[F.lit(p) for p in months]), lambda p: p >= F.col("part"))
        shifted = change.select(F.explode(later).alias("part"), "account_number", "amount")
        month = F.last_day(F.to_date(F.concat(F.substring("part", 3, 7), F.lit("-01"))))
        return (carried.unionByName(shifted).groupBy("part", "account_number")
                .agg(F.sum("amount").cast(MONEY).alias("amount"))
                .select("part", F.lit(None).cast("string").alias("source"), "account_number", month.alias("date"), "amount"))

    # --- reading ---------------------------------------------------------------

    @staticmethod
    def months(m: Manifest | None) -> list[str]:
        return sorted(p[5:] for p in (m.parts if m else ()) if p.startswith("part=c-"))

    def _some(self, m: Manifest | None, parts: set[str], like: DataFrame) -> DataFrame:
        """The rows of some partitions; no other folder is listed."""
        own = {p: c for p, c in (m.parts.items() if m else ()) if p[5:] in parts}
        if not own:
            return like.limit(0)
        return self._rows(Manifest(m.version, m.schema, own)).select(*COLUMNS)

    def _state(self, accounts: DataFrame, m: Manifest, sums: DataFrame, opening_col: str) -> DataFrame:
        """``accounts`` with their opening balance moved by ``sums``."""
        total = sums.groupBy("account_number").agg(F.sum("amount").alias("_moved"))
        opening = (LG.opening_amount(opening_col) + F.coalesce("_moved", F.lit(0))).cast(MONEY)
        return accounts.join(total, "account_number", "left").withColumn(opening_col, opening).drop("_moved")

    def balances(self, accounts: DataFrame, start: dt.date, end: dt.date, pool: str = "currency",
                 opening_col: str = "opening_balance") -> DataFrame:
        """Every account on every day of [start, end]."""
        m = self.manifest()
        if m is None:
            raise FileNotFoundError(f"no version of {self.path}")
        all_rows = self._rows(m).select(*COLUMNS)
        known = [p for p in self.months(m) if p < f"c-{start:%Y-%m}"]
        moved = all_rows.where(F.col("part").startswith("m-") & (F.col("date") <= F.lit(end)))
        if known:
            moved = moved.where(F.col("date") > F.last_day(F.to_date(F.lit(f"{known[-1][2:]}-01"))))
        sums = moved.where(F.col("date") < F.lit(start)).select("account_number", "amount")
        if known:
            sums = sums.unionByName(self._some(m, {known[-1]}, all_rows).select("account_number", "amount"))
        opening = self._state(accounts, m, sums, opening_col)
        return LG.balance_roll_forward(opening, moved.where(F.col("date") >= F.lit(start)), start, end, pool=pool,
                                       opening_col=opening_col)

    def closing(self, accounts: DataFrame, opening_col: str = "opening_balance") -> DataFrame:
        """The accounts with the balance after all movements loaded, as
        ``opening_col`` of the next run."""
        m = self.manifest()
        if m is None:
            raise FileNotFoundError(f"no version of {self.path}")
        like = self.spark.createDataFrame([], f"part string, source string, account_number string, date date, amount {MONEY}")
        return self._state(accounts, m, self._some(m, set(self.months(m)[-1:]), like), opening_col)


def ledger_stream(spark: SparkSession, landing: str, schema, store: LedgerStore, checkpoint: str, fmt: str = "csv",
                  max_files: int | None = None, available_now: bool = True, processing_time: str = "1 minute"):
    """Load movement files as they land; with ``available_now`` block until
    the landed ones are loaded.  At most ``max_files`` files make one commit.
    A batch replayed after a failure gives the same balances."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.format(fmt).load(landing).select("*", F.col("_metadata.file_path").alias(SOURCE_COL))

    def load(batch: DataFrame, epoch_id: int) -> None:
        store.apply(batch)

    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
