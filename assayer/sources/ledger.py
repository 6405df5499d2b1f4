"""What incremental loads remember of rows they may meet again: a ledger beside the marks.

A load looks at rows of the mark's own moment and at rows without a time once more, as others may have joined them. Which of
them were loaded before stands in the ledger: their keys, as texts. A load appends a part that holds the entries it added, and then
its row in the table of marks, which names the part; after some parts one is written that stands for all. Entries of
earlier moments fall away with it. So a load reads a ledger of the size of one moment and the rows without a time, not
what all loads wrote.

A load that was begun and did not end leaves its ``begun`` row as the source's last one. What it wrote is in no part, so that the ledger
does not hold then: the caller compares with the written rows (``incremental_scan``), and the next part is made from them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.session import remove_path
from assayer.sources.incremental import STATE_SCHEMA, moment_literal

LOADS = f"{STATE_SCHEMA}, part string, whole boolean, columns array<string>"
ENTRY = "entry string, moment timestamp_ntz"
PARTS = 16  # parts until one is written that stands for all


@dataclass(frozen=True)
class Ledger:
    """The mark, the columns that tell rows apart, and the folders of the parts that count."""

    high_water: datetime | None
    columns: tuple[str, ...]
    parts: tuple[str, ...]


def load_ledger(spark: SparkSession, state_path: str, source: str) -> Ledger | None:
    """The ledger of a source; None if it has none that holds."""
    try:
        loads = spark.read.schema(LOADS).parquet(state_path).where(F.col("source") == source)
    except AnalysisException:  # nothing was loaded yet
        return None
    since = loads.where("whole").agg(F.max("saved_at")).first()[0]
    if since is None:
        return None
    rows = loads.where(F.col("saved_at") >= F.lit(since)).orderBy("saved_at").collect()  # two for each of at most PARTS loads
    last = rows[-1]
    if last["part"] is None:
        return None
    folder = _folder(state_path, source)
    return Ledger(last["high_water"], tuple(last["columns"]), tuple(f"{folder}/{r['part']}" for r in rows if r["part"]))


def holds_for(ledger: Ledger | None, df: DataFrame, keys: Sequence[str] | None) -> bool:
    """Whether a ledger tells the rows of ``df`` apart as asked."""
    return ledger is not None and set(ledger.columns) <= set(df.columns) and (not keys or set(keys) == set(ledger.columns))


def unseen_rows(df: DataFrame, modified: str, ledger: Ledger) -> DataFrame:
    """Rows after the mark, and those of its moment or without a time that no load has taken up.

    Both filters reach the scan; only rows of the second kind are joined. Equal rows that arrive together all stay.
    """
    moment = F.col(f"`{modified}`")
    if ledger.high_water is None:  # all rows loaded so far were without a time
        newer, open_rows = df.where(moment.isNotNull()), df.where(moment.isNull())
    else:
        mark = moment_literal(df, modified, ledger.high_water)
        newer, open_rows = df.where(moment > mark), df.where(moment.isNull() | (moment == mark))
    known = _entries(df.sparkSession, ledger).select(F.col("entry").alias("__entry")).distinct()
    unseen = open_rows.withColumn("__entry", entry_text(modified, ledger.columns)).join(known, "__entry", "left_anti")
    return newer.unionByName(unseen.select(*(F.col(f"`{c}`") for c in df.columns)))


def entry_text(modified: str, columns: Sequence[str]) -> Column:
    """A row's entry: its keys and its time as one text, nulls told apart from texts."""
    cells = [F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns)]
    cells.append(F.col(f"`{modified}`").cast("timestamp_ntz").cast("string").alias("__moment"))
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def begin_load(spark: SparkSession, state_path: str, source: str, high_water: datetime | None) -> None:
    """Note that rows of a source are about to be written. The mark stays."""
    _save(spark, state_path, source, high_water, None, None, None, None)


def end_load(
    written: DataFrame, modified: str, columns: Sequence[str], state_path: str, source: str,
    high_water: datetime | None, ledger: Ledger | None, loaded: DataFrame | None = None,
) -> datetime | None:
    """Move the mark to the newest row written and enter what may be met again; call it after the write committed.

    ``high_water`` is the mark before. ``ledger`` must be None if it did not hold; ``loaded`` is then all that was
    written so far, with ``written``, and None at the first load. Gives the new mark.
    """
    spark = written.sparkSession
    newest, records = written.agg(F.max(F.col(f"`{modified}`").cast("timestamp_ntz")), F.count(F.lit(1))).first()
    mark = max((m for m in (high_water, newest) if m is not None), default=None)
    old = _entries(spark, ledger) if ledger and set(ledger.columns) == set(columns) else None
    whole = old is None or len(ledger.parts) >= PARTS
    rows = written if old is not None or loaded is None else loaded
    moment = F.col(f"`{modified}`").cast("timestamp_ntz")
    due = moment.isNull() if mark is None else moment.isNull() | (moment == F.lit(mark))
    entries = rows.where(due).select(entry_text(modified, columns).alias("entry"), moment.alias("moment"))
    if whole and old is not None:
        entries = entries.unionByName(old.where(F.col("moment").isNull() | (F.col("moment") == F.lit(mark))))
    part = uuid.uuid4().hex
    entries.distinct().write.parquet(f"{_folder(state_path, source)}/{part}")
    _save(spark, state_path, source, mark, records, part, whole, sorted(columns))
    if whole and old is not None:
        for folder in ledger.parts:
            remove_path(spark, folder)
    return mark


def _entries(spark: SparkSession, ledger: Ledger) -> DataFrame:
    rows = spark.read.schema(ENTRY).parquet(*ledger.parts)
    at_mark = F.lit(False) if ledger.high_water is None else F.col("moment") == F.lit(ledger.high_water)
    return rows.where(F.col("moment").isNull() | at_mark)


def _folder(state_path: str, source: str) -> str:
    return f"{state_path.rstrip('/')}/_ledger/{quote(source, safe='')}"  # readers of the marks skip names that begin with _


def _save(spark: SparkSession, state_path: str, source: str, mark, records, part, whole, columns) -> None:
    row = spark.createDataFrame([(source, mark, records, None, part, whole, columns)], LOADS)
    row.withColumn("saved_at", F.current_timestamp()).write.mode("append").parquet(state_path)
