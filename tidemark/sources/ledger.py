"""A ledger of the stretches of time that writes have touched in a stored table.

Once :func:`keep_ledger` was called for a table, every append, upsert, fold and clean-up of it
notes the hours it is about to change before it publishes anything, and closes that note when it
is done. A note that was never closed, because its writer died, keeps counting as changed, so
nothing is lost between the two. Retention is not noted: what has been summed up outlives its
rows. A ledger is a folder of small numbered files next to the table, which the driver reads and
writes; a number is taken by creating its file, which fails where it is there already.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import Width, index_of, parse_width, start_of
from tidemark.functions.instants import Instant, instant

Span = tuple[datetime, datetime]
HOUR = timedelta(hours=1)


class Log:
    """Numbered entries in a folder, of which only the driver takes notice."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._system = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._system.exists(self._folder)

    def start(self) -> None:
        self._system.mkdirs(self._folder)

    def numbers(self) -> list[int]:
        if not self.exists():
            return []
        names = [s.getPath().getName() for s in self._system.listStatus(self._folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def _file(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, f"{number:012d}.json")

    def append(self, entry: dict) -> int:
        """Write an entry under the next free number; returns the number."""
        held = self.numbers()
        number = held[-1] + 1 if held else 1
        while True:
            try:
                out = self._system.create(self._file(number), False)
                break
            except Exception:
                if not self._system.exists(self._file(number)):
                    raise
                number += 1
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        return number

    def entries(self, after: int = 0) -> list[tuple[int, dict]]:
        """Entries above a number, up to the first that is still being written."""
        found = []
        for number in self.numbers():
            if number > after:
                stream = self._system.open(self._file(number))
                text = bytes(stream.readAllBytes()).decode()
                stream.close()
                if not text.endswith("}"):
                    break
                found.append((number, json.loads(text)))
        return found

    def last(self) -> dict | None:
        """The newest entry that is whole."""
        for number in reversed(self.numbers()):
            found = self.entries(number - 1)
            if found:
                return found[-1][1]
        return None

    def forget(self, upto: int) -> None:
        """Remove the entries up to a number; the last one stays, as numbers go on from it."""
        for number in self.numbers()[:-1]:
            if number <= upto:
                self._system.delete(self._file(number), False)


@dataclass(frozen=True)
class Changes:
    """What a ledger holds above a number: the spans, and the number that may be taken as read."""

    spans: list[Span]
    upto: int


def _ledger(spark: SparkSession, path: str) -> Log:
    return Log(spark, f"{path.rstrip('/')}-changes")


def keep_ledger(spark: SparkSession, path: str) -> None:
    """From now on, note the changes of the table at ``path``."""
    _ledger(spark, path).start()


def has_ledger(spark: SparkSession, path: str) -> bool:
    return _ledger(spark, path).exists()


@contextmanager
def noted(spark: SparkSession, path: str, spans: Sequence[Span]) -> Iterator[None]:
    """Note ``spans`` of a table that keeps a ledger as changed by what happens inside."""
    log = _ledger(spark, path)
    if not spans or not log.exists():
        yield
        return
    number = log.append({"spans": [[s.isoformat() for s in span] for span in spans]})
    yield
    log.append({"closes": number})


def changes(spark: SparkSession, path: str, after: int = 0) -> Changes:
    """The spans noted above a number. Notes that are not closed are given again next time."""
    spans, waiting, upto = [], [], after
    for number, entry in _ledger(spark, path).entries(after):
        upto = number
        if "closes" in entry:
            if entry["closes"] in waiting:
                waiting.remove(entry["closes"])
        else:
            waiting.append(number)
            spans += [tuple(map(datetime.fromisoformat, span)) for span in entry["spans"]]
    return Changes(joined(spans), min([upto, *[n - 1 for n in waiting]]))


def forget_changes(spark: SparkSession, path: str, upto: int) -> None:
    """Drop the entries that all who read the ledger have taken up."""
    _ledger(spark, path).forget(upto)


def hours_of(df: DataFrame, time: str = "time") -> list[Span]:
    """The hours that a frame has rows in, neighbours joined: one small job."""
    hours = df.filter(F.col(time).isNotNull()).select(F.floor(F.unix_seconds(time) / 3600).alias("hour")).distinct()
    starts = sorted(datetime(1970, 1, 1) + HOUR * r["hour"] for r in hours.collect())
    return joined([(s, s + HOUR) for s in starts])


def joined(spans: Sequence[Span], at_most: int | None = None) -> list[Span]:
    """The spans in order, those that meet made one; the closest ones too, down to ``at_most``."""
    out: list[Span] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        elif low < high:
            out.append((low, high))
    while at_most is not None and len(out) > at_most:
        k = min(range(len(out) - 1), key=lambda k: out[k + 1][0] - out[k][1])
        out[k : k + 2] = [(out[k][0], out[k + 1][1])]
    return out


def widened(spans: Sequence[Span], width: str | Width) -> list[Span]:
    """The whole buckets that the spans touch."""
    width = parse_width(width)

    def ceiling(moment: datetime) -> datetime:
        low = index_of(moment, width)
        return moment if start_of(low, width) == moment else start_of(low + 1, width)

    return joined([(start_of(index_of(low, width), width), ceiling(high)) for low, high in spans])


def clipped(spans: Sequence[Span], start: Instant, end: Instant) -> list[Span]:
    """The parts of the spans inside ``[start, end)``."""
    start, end = instant(start), instant(end)
    return joined([(max(low, start), min(high, end)) for low, high in spans])


def days_in(spans: Sequence[Span]) -> list:
    """The dates that the spans touch."""
    found = set()
    for low, high in spans:
        day = low.date()
        while datetime(day.year, day.month, day.day) < high:
            found.add(day)
            day += timedelta(days=1)
    return sorted(found)
