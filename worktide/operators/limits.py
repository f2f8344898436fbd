"""Token-bucket accounting per client, over a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktide.functions import states as S
from worktide.operators.ordered import Fold, ordered_fold


class BucketFold(Fold):
    """A bucket of ``capacity`` tokens that fills up once per period; a request costs one token.

    Integer units (tokens times period in microseconds) keep results exact: ``dt`` microseconds refill
    ``dt * capacity`` units and a token is worth one period.

    The effect of a run of requests on an unknown start level is a step function kept as pieces
    [from, end, slope]: levels from ``from`` on (up to the next piece) end at ``end`` plus, for slope 1,
    the distance to ``from``. Requests shift pieces, cut them where a token becomes available or the
    bucket overflows, and neighbours that line up again are merged, so the list stays about as long as
    the capacity.
    """

    inputs = ("__us",)
    outputs = (T.StructField("allowed", T.BooleanType()), T.StructField("units_left", T.LongType()))

    def __init__(self, capacity: int, period_us: int):
        self.capacity, self.cost = capacity, period_us
        self.full = capacity * period_us

    # The state is [level, time of the last request].
    def start(self, row):
        return [self.full, row[0]]

    def step(self, state, row):
        level = min(self.full, state[0] + max(0, row[0] - state[1]) * self.capacity)
        allowed = level >= self.cost
        if allowed:
            level -= self.cost
        return [level, row[0]], (allowed, level)

    # A summary is {"seen": [time of first row, time of last row], "pieces": [...]}: the pieces map the
    # level found at the first row, refill included, to the level after the last one.
    def unknown(self):
        return {"seen": None, "pieces": [[0, 0, 1]]}

    def extend(self, summary, row):
        pieces, seen = summary["pieces"], summary["seen"]
        refill = (row[0] - seen[1]) * self.capacity if seen else 0
        cut: list[list[int]] = []
        for index, (begin, end, slope) in enumerate(pieces):
            stop = pieces[index + 1][0] if index + 1 < len(pieces) else self.full + 1
            for low, level, tilt in self._request(begin, stop, end + refill, slope):
                if cut:
                    last = cut[-1]
                    if tilt == last[2] and level == last[1] + tilt * (low - last[0]):
                        continue
                cut.append([low, level, tilt])
        return {"seen": [seen[0] if seen else row[0], row[0]], "pieces": cut}

    def _request(self, begin: int, stop: int, level: int, slope: int):
        """One piece after its refill: split at the price of a token and at the brim, then charge."""
        if not slope:
            level = min(level, self.full)
            yield begin, level - self.cost if level >= self.cost else level, 0
            return
        rich = begin + max(0, self.cost - level)         # from here on a token is there
        brim = begin + max(0, self.full - level)         # from here on the bucket is full
        if rich > begin:
            yield begin, level, 1
        if rich < min(brim, stop):
            yield rich, level + (rich - begin) - self.cost, 1
        if brim < stop:
            yield max(brim, begin), self.full - self.cost, 0

    def resolve(self, summary, state):
        if summary["seen"] is None:
            return state
        first, last = summary["seen"]
        level = min(self.full, state[0] + (first - state[1]) * self.capacity)
        for begin, end, slope in reversed(summary["pieces"]):
            if level >= begin:
                return [end + slope * (level - begin), last]
        raise AssertionError("a level below zero")


def rate_limit(requests: DataFrame, capacity: int = S.RATE_PER_MINUTE, period_seconds: int = 60,
               client: str = "client_id", ts: str = "ts", request_id: str = "request_id",
               chunks: int | None = None) -> DataFrame:
    """Which requests a token bucket per client would have let through.

    Adds ``allowed`` and ``units_left`` (tokens times the period in microseconds). Buckets start full.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    timed = requests.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    folded = ordered_fold(timed, client, ["__us", request_id],
                          BucketFold(capacity, period_seconds * 1_000_000), chunks)
    return folded.drop("__us")
