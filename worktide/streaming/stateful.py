"""Per-key state over streams: lifecycle status, lease expiry, token buckets.

Rows wait in their key's state until the watermark has passed them and are then taken in (time, id) order, so the
results do not depend on which file or micro-batch brought a row. They equal the batch forms' as long as no row comes
later than ``delay``; Spark drops later ones and counts them in the progress report's ``numRowsDroppedByWatermark``.
Rows still waiting when a stream stops come out when it goes on. Rows without a time are left out. What is due is taken
with the key's new rows if some come in that micro-batch, or else by a timer.

The state lives in the RocksDB store. Keys share buckets: a micro-batch calls the store and hands over rows once a bucket, not once a key,
and the number of buckets sets what one call holds. A bucket has one value with its waiting rows and what is known of its keys, as long as
both are few. What is known of more keys lies in pages, of which a micro-batch reads and writes those it needs. More rows wait in slots of
time, a map entry for each slot and micro-batch. Slots are narrow near the watermark and eight times as wide at each step further
ahead; one timer a bucket opens what the watermark reaches, and rows of a wide slot that are not due move to narrower ones. A row is thus written and
read at most once a step, however many rows wait beside it: a micro-batch costs what is new and what is due. Rows and pages are kept as
Arrow record batches.
One task works on a bucket in a micro-batch; the batch forms in ``operators`` cut hot keys into chunks instead.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.audit import allowed_step
from worktide.operators.limits import BucketFold

_STEP = 8
#: Up to so many waiting rows are kept in a bucket's own value.
_FEW = 64
#: A page of what is known has about so many keys at most.
_PAGE = 500
#: Up to so many answers go out at once.
_TOLD = 10_000
#: So many buckets share the keys.
BUCKETS = 1024
#: A data frame's times end in 2262: from 2200 on, in milliseconds, the watermark's time runs so many (two to this power) times slower.
_FAR, _SLOWER = 7_258_118_400_000, 8
#: And they begin in 1677; no watermark is that early.
_EARLY = -8_000_000_000_000


class _Watcher:
    """What a stream knows of a key, a tuple of the type ``known``, and what it says about it."""

    known: str

    def step(self, known: tuple | None, row: tuple) -> tuple[tuple | None, list[tuple]]:
        """After a row (microseconds, id, other columns)."""
        raise NotImplementedError

    def settle(self, known: tuple | None, mark_us: int) -> tuple[tuple | None, list[tuple]]:
        """After all rows before the watermark."""
        return known, []

    def wake(self, known: tuple) -> int | None:
        """When to settle if no row comes, in microseconds."""
        return None


def _milliseconds(us: int) -> int:
    return -(-us // 1000)


def _real(mark: int) -> int:
    """What a watermark stands for, in milliseconds."""
    return mark if mark <= _FAR else _FAR + (mark - _FAR << _SLOWER)


def _marked(ms: int) -> int:
    """The first watermark that stands for ``ms`` or later."""
    return ms if ms <= _FAR else _FAR - (_FAR - ms >> _SLOWER)


def _in_order(row: Sequence) -> tuple:
    return row[0], row[1] is not None, row[1]


def _packed(rows: Iterable[tuple], names: Sequence[str]) -> bytes | None:
    """Rows as an Arrow record batch; None for no rows."""
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    if not columns:
        return None
    batch = pa.record_batch(columns, names=list(names))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _values(column: pa.Array) -> list:
    plain = pa.types.is_integer(column.type) or pa.types.is_boolean(column.type) or pa.types.is_string(column.type)
    return column.to_numpy(zero_copy_only=False).tolist() if plain and not column.null_count else column.to_pylist()


def _unpacked(packed: bytes | None) -> list[tuple]:
    if packed is None:
        return []
    with pa.ipc.open_stream(bytes(packed)) as reader:
        return list(zip(*map(_values, reader.read_next_batch().columns), strict=True))


class _Known:
    """What is known of a bucket's keys: one page in the bucket's own value, or several, by the key's checksum, in a map."""

    def __init__(self, pages, first: bytes | None, keys: int, wakes: Sequence[int | None], watcher: _Watcher, names: Sequence[str]):
        self.pages, self.first, self.keys, self.wakes, self.watcher, self.names = pages, first, keys, list(wakes), watcher, names
        self.open: dict[int, dict] = {}
        self.changed: set[int] = set()

    def _place(self, key) -> int:
        return zlib.crc32(repr(key).encode()) % len(self.wakes) if len(self.wakes) > 1 else 0

    def _page(self, place: int) -> dict:
        if place not in self.open:
            packed = self.first if len(self.wakes) == 1 else self.pages.getValue((place,))[0]
            self.open[place] = {row[0]: row[1:] for row in _unpacked(packed)}
        return self.open[place]

    def get(self, key) -> tuple | None:
        return self._page(self._place(key)).get(key)

    def put(self, key, known: tuple | None) -> None:
        place = self._place(key)
        page = self._page(place)
        if known != page.get(key):
            self.changed.add(place)
            self.keys += (known is not None) - (key in page)
            if known is None:
                del page[key]
            else:
                page[key] = known

    def wake(self) -> int | None:
        """When the first key wants to settle, in microseconds."""
        for place in self.changed:
            wakes = map(self.watcher.wake, self.open[place].values())
            self.wakes[place] = min((w for w in wakes if w is not None), default=None)
        return min((w for w in self.wakes if w is not None), default=None)

    def settle(self, mark: int) -> list[tuple]:
        """Settles the keys that want it before the watermark: what is said of them, the key last."""
        said = []
        self.wake()
        for place in [p for p, wake in enumerate(self.wakes) if wake is not None and wake < mark * 1000]:
            for key, known in list(self._page(place).items()):
                if self.watcher.wake(known) < mark * 1000:
                    known, more = self.watcher.settle(known, mark * 1000)
                    self.put(key, known)
                    said += [(*answer, key) for answer in more]
        return said

    def save(self) -> None:
        """Writes the pages that have changed, and more or fewer of them if the keys have become many or few."""
        was, wanted = len(self.wakes), 1
        while wanted * _PAGE < self.keys:
            wanted *= 2
        # Fewer only when most pages have become nearly empty, or all: keys that come and go do not move pages each time.
        if was < wanted or wanted * 8 <= was or not self.keys and was > 1:
            rows = {key: known for place in range(was) for key, known in self._page(place).items()}
            for place in range(wanted, was):
                self.pages.removeKey((place,))
            if was > 1 == wanted:
                self.pages.removeKey((0,))
            self.wakes, self.open = [None] * wanted, {place: {} for place in range(wanted)}
            for key, known in rows.items():
                self.open[self._place(key)][key] = known
            self.changed = set(self.open)
        self.wake()
        for place in self.changed:
            packed = _packed(((key, *known) for key, known in self.open[place].items()), self.names)
            if len(self.wakes) == 1:
                self.first = packed
            else:
                self.pages.updateValue((place,), (packed,))
        if len(self.wakes) > 1:
            self.first = None
        self.changed = set()


class _InEventOrder(StatefulProcessor):
    """Feeds ``watcher`` the rows of a bucket's keys as the watermark passes them.

    Rows and answers are handed over as ``Row``; a row has the key's column, the first of ``names``, besides those of ``row_type``.
    """

    def __init__(self, watcher: _Watcher, known_type: T.StructType, row_type: T.StructType, names: Sequence[str], base_ms: int):
        self.watcher, self.names, self.base = watcher, list(names), base_ms
        self.known_names, self.row_names = (names[0], *known_type.names), (*row_type.names, names[0])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # What is known of few keys, the few rows that wait, the slots in use with their numbers of chunks, the number of keys known, when
        # each page wants to settle, and the time of the bucket's timer.
        self.own = handle.getValueState("own", "known binary, rows binary, levels array<int>, places array<bigint>, chunks array<int>, "
                                               "keys bigint, wakes array<bigint>, timer bigint")
        self.waiting = handle.getMapState("waiting", "level int, place bigint, chunk int", "rows binary")
        self.pages = handle.getMapState("pages", "page int", "known binary")

    def _load(self) -> tuple[_Known, list[tuple], dict[tuple[int, int], int], int | None]:
        held = self.own.get()
        if held is None:
            return _Known(self.pages, None, 0, [None], self.watcher, self.known_names), [], {}, None
        first, few, levels, places, chunks, keys, wakes, timer = held
        slots = {(level, place): n for level, place, n in zip(levels, places, chunks, strict=True)}
        return _Known(self.pages, first, keys, wakes, self.watcher, self.known_names), _unpacked(few), slots, timer

    def _put(self, slots: dict, rows: list[tuple], mark: int) -> list[tuple]:
        """Keeps the rows: returns them if they are few and no slot is in use, or else puts them into slots."""
        if not slots and len(rows) <= _FEW:
            return rows
        new: dict[tuple[int, int], list[tuple]] = {}
        for row in rows:
            at, level, width = row[0] // 1000, 0, self.base
            while at - mark >= _STEP * width:
                level, width = level + 1, width * _STEP
            new.setdefault((level, at // width), []).append(row)
        for slot, found in new.items():
            chunk = slots.get(slot, 0)
            self.waiting.updateValue((*slot, chunk), (_packed(found, self.row_names),))
            slots[slot] = chunk + 1
        return []

    def _take(self, slots: dict, mark: int) -> list[tuple]:
        """The rows of the slots that the watermark has entered, out of the state."""
        rows = []
        for level, place in [s for s in slots if s[1] * self.base * _STEP ** s[0] < mark]:
            for chunk in range(slots.pop((level, place))):
                rows.extend(_unpacked(self.waiting.getValue((level, place, chunk))[0]))
                self.waiting.removeKey((level, place, chunk))
        return rows

    def _opens(self, known: _Known, few: list[tuple], slots: dict) -> int | None:
        """When, in milliseconds, the bucket has something to say or to move."""
        # A narrow slot opens when it has passed, a wide one when its first stretch has.
        times = [place * self.base * _STEP ** level + self.base for level, place in slots]
        if few:
            times.append(min(row[0] for row in few) // 1000 + self.base)
        wake = known.wake()
        if wake is not None:
            times.append(_milliseconds(wake))
        return min(times, default=None)

    def _pass(self, known: _Known, few: list[tuple], slots: dict, mark: int) -> tuple[list[tuple], list[tuple]]:
        """Takes what the watermark has passed: the few rows left, and what is said, the key last."""
        due, later, said = [], [], []
        for row in few + self._take(slots, mark):
            (due if _milliseconds(row[0]) < mark else later).append(row)
        # Rows have their key last.
        due.sort(key=_in_order)
        last: dict = {}
        for row in due:
            key = row[-1]
            now, more = self.watcher.step(last[key] if key in last else known.get(key), row[:-1])
            last[key] = now
            said += [(*answer, key) for answer in more]
        for key, now in last.items():
            known.put(key, now)
        said += known.settle(mark)
        return self._put(slots, later, mark), said

    def _save(self, known: _Known, few: list[tuple], slots: dict, timer: int | None, mark: int) -> None:
        opens = self._opens(known, few, slots)
        wanted = None if opens is None else _marked(max(opens, mark) + 1)
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        known.save()
        if wanted is None and not known.keys:
            self.own.clear()
        else:
            levels, places = zip(*slots, strict=True) if slots else ((), ())
            self.own.update((known.first, _packed(few, self.row_names), list(levels), list(places), list(slots.values()), known.keys, known.wakes, wanted))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802,N803
        mark = _real(max(0, timerValues.getCurrentWatermarkInMs()))
        known, few, slots, timer = self._load()
        new, said = self._picked(rows), []
        opens = self._opens(known, few + new, slots)
        if 0 < mark and opens is not None and opens < mark:
            # The watermark has passed these rows and all of this micro-batch are here: no need to keep them for a timer.
            few, said = self._pass(known, few + new, slots, mark)
        else:
            few = self._put(slots, few + new, mark)
        self._save(known, few, slots, timer, mark)
        return self._tell(said)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802,N803
        mark = _real(timerValues.getCurrentWatermarkInMs())
        known, few, slots, timer = self._load()
        few, said = self._pass(known, few, slots, mark)
        self._save(known, few, slots, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer, mark)
        return self._tell(said)

    def _picked(self, rows: Iterator[Row]) -> list[tuple]:
        """The rows as tuples, the key last."""
        return list(map(itemgetter(*self.row_names), rows))

    def _tell(self, said: list[tuple]) -> Iterator[Row]:
        made = Row(*self.names)
        for start in range(0, len(said), _TOLD):
            *columns, keys = map(list, zip(*said[start:start + _TOLD], strict=True))
            yield made(keys, *columns)


class _InFrames(_InEventOrder):
    """Hands rows and answers over as data frames, whole columns at a time: rows one by one cost eight times as much.

    A frame has the bucket, the time, a number whose bits tell which of the other columns are null, and those: the columns of the row and the key.
    """

    def _picked(self, rows: Iterator[pd.DataFrame]) -> list[tuple]:
        found = []
        for frame in rows:
            absent, *columns = [frame.iloc[:, i].tolist() for i in range(2, frame.shape[1])]
            some = any(absent)
            for i, column in enumerate(columns):
                if some and any(bits >> i & 1 for bits in absent):
                    columns[i] = [None if bits >> i & 1 else value for bits, value in zip(absent, column, strict=True)]
            found += zip(*columns, strict=True)
        return found

    def _tell(self, said: list[tuple]) -> Iterator[pd.DataFrame]:
        for row in super()._tell(said):
            # Objects, as whole numbers with nulls among them would become floating.
            yield pd.DataFrame({name: pd.Series(column, dtype=object) for name, column in zip(self.names, row, strict=True)})


def _in_event_order(rows: DataFrame, key: str, ts: Column, row_id: str, carried: Sequence[str], delay: str,
                    watcher: _Watcher, outputs: str, buckets: int) -> DataFrame:
    """Run ``watcher`` over each key's rows: the key, and the ``outputs`` of what it says."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    us = F.unix_micros(ts.cast("timestamp"))
    near = F.when(us > _FAR * 1000, _FAR * 1000 + F.shiftright(us - _FAR * 1000, _SLOWER)).otherwise(F.greatest(us, F.lit(_EARLY * 1000)))
    timed = rows.select(key, us.alias("__us"), F.timestamp_micros(F.when(us.isNotNull(), near)).alias("__ts"), row_id, *carried)
    keyed = timed.withWatermark("__ts", delay).filter(F.col("__ts").isNotNull())
    given = ("__us", row_id, *carried, key)
    # Whole numbers with nulls among them would become floating in a data frame: the bits tell what is null.
    bits = sum((F.when(F.col(n).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(given)), F.lit(0))
    whole = [F.coalesce(n, F.lit(0).cast(keyed.schema[n].dataType)) if isinstance(keyed.schema[n].dataType, T.IntegralType) else F.col(n) for n in given]
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("__bucket")
    framed = keyed.select(bucket, "__ts", bits.alias("__absent"), *[c.alias(f"__{i}") for i, c in enumerate(whole)])
    row_type = T.StructType([T.StructField(n, keyed.schema[n].dataType) for n in given[:-1]])
    made = T.StructType([T.StructField(key, rows.schema[key].dataType), *T.StructType.fromDDL(outputs).fields])
    base = max(1, pd.Timedelta(delay).value // 1_000_000 // _STEP)
    processor = _InFrames(watcher, T.StructType.fromDDL(watcher.known), row_type, made.names, base)
    return framed.groupBy("__bucket").transformWithStateInPandas(processor, made, "Append", "EventTime")


class _Lifecycle(_Watcher):
    """Knows the last status and when it came; ``forget`` microseconds later it does not, unless that is None."""

    known = "status string, since bigint"

    def __init__(self, forget: int | None):
        self.forget = forget

    def step(self, known, row):
        us, event, kind, status = row
        if known is not None and self.forget is not None and known[1] + self.forget < us:
            known = None
        return (known, []) if status is None else ((status, us), [(event, us, kind, status, known and known[0])])

    def settle(self, known, mark_us):
        return (None if known is not None and self.forget is not None and known[1] + self.forget < mark_us else known), []

    def wake(self, known):
        return None if self.forget is None else known[1] + self.forget


def lifecycle_stream(events: DataFrame, delay: str, forget: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Each event with the status its job had before it and whether the move is allowed.

    A job's last status is kept for good, as any later event has to be judged by it, or for the time ``forget``: an event
    that comes later than that counts as the job's first.
    """
    types = events.schema
    stated = events.withColumn("status", R.event_status(F.col("event_type")))
    outputs = f"event_id {types['event_id'].dataType.simpleString()}, us bigint, event_type string, status string, previous_status string"
    watcher = _Lifecycle(None if forget is None else pd.Timedelta(forget).value // 1000)
    followed = _in_event_order(stated, "job_id", F.col("created_at"), "event_id", ["event_type", "status"], delay, watcher, outputs, buckets)
    at = F.timestamp_micros("us").cast(types["created_at"].dataType).alias("created_at")
    return followed.select("job_id", "event_id", at, "event_type", "status", "previous_status").withColumn("allowed", allowed_step())


class _Lease(_Watcher):
    """Knows when the lease ends."""

    known = "ends bigint"

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def step(self, known, row):
        us, _, alive = row
        return ((us + self.ttl,) if alive else None), ([known] if known is not None and known[0] < us else [])

    def settle(self, known, mark_us):
        # Every row up to the lease's end has been seen.
        return (None, [known]) if known is not None and _milliseconds(known[0]) * 1000 < mark_us else (known, [])

    def wake(self, known):
        return known[0]


def expiry_stream(signals: DataFrame, ttl_seconds: int, delay: str, signal_id: str = "signal_id", buckets: int = BUCKETS) -> DataFrame:
    """Leases nobody renewed or ended within the TTL: (job_id, expired_at), reported once the watermark has passed the end.

    ``signals`` has job_id, ts, alive and a unique id: a start or renewal keeps the lease alive, an end closes it.
    """
    found = _in_event_order(signals, "job_id", F.col("ts"), signal_id, ["alive"], delay, _Lease(ttl_seconds * 1_000_000), "us bigint", buckets)
    return found.select("job_id", F.timestamp_micros("us").alias("expired_at"))


class _Bucket(_Watcher):
    """Knows level and time of the last request; forgets a bucket that is full again, as an unknown one is full."""

    known = "level bigint, us bigint"

    def __init__(self, fold: BucketFold):
        self.fold = fold

    def step(self, known, row):
        level, decision = self.fold.step(known or self.fold.start((row[0],)), (row[0],))
        return tuple(level), [(row[1], *decision)]

    def settle(self, known, mark_us):
        return (None if known is not None and self.wake(known) < mark_us else known), []

    def wake(self, known):
        return known[1] + self.fold.cost


def rate_limit_stream(requests: DataFrame, delay: str, capacity: int = S.RATE_PER_MINUTE, period_seconds: int = 60,
                      buckets: int = BUCKETS) -> DataFrame:
    """Token-bucket decisions per client as requests arrive: request_id, client_id, allowed, units_left."""
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    watcher = _Bucket(BucketFold(capacity, period_seconds * 1_000_000))
    outputs = f"request_id {dict(requests.dtypes)['request_id']}, allowed boolean, units_left bigint"
    return _in_event_order(requests, "client_id", F.col("ts"), "request_id", [], delay, watcher, outputs, buckets)
