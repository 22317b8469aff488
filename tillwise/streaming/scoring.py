"""Per-event scores with keyed state that outlives micro-batches and restarts.

Events wait in the state until the watermark has passed them, and are then scored in the order of (time, id),
however late, and in whatever order, they arrive. Customers are dealt to buckets by a hash of their id, and the state is
kept by bucket, so that a call serves all customers of a bucket. A bucket keeps its waiting events in pieces by spans of
event time, so that only the spans that are due are read, one after another; it keeps the last revenues of each customer
as a bounded list, and forgets them after a quiet time of the customer. Events without revenue get no score and are no
part of the history.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

OUTPUT = (
    "customer_id bigint, event_id bigint, ts timestamp, revenue double, history_count bigint, "
    "z_score double, is_spike boolean, is_drop boolean, is_anomaly boolean, anomaly_severity string"
)
# Upper borders of the severity bands.
SEVERITY_BANDS = [(2.0, "none"), (2.5, "low"), (3.5, "medium"), (5.0, "high")]


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of parts that begin at starts and have so many values."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def score_customers(seen, held, values, rows, history: int, threshold: float) -> tuple[dict, np.ndarray, np.ndarray]:
    """Scores of revenues in order, each against the `history` ones of its customer before it; the histories after them.

    One customer's values follow another's: `held` of those seen and `rows` of the new ones belong to each. The
    histories are one after another as well, with the length of each.
    """
    held, rows = np.asarray(held, np.int64), np.asarray(rows, np.int64)
    there = ~np.isnan(values)
    of = np.repeat(np.arange(len(rows)), rows)
    new = np.bincount(of[there], minlength=len(rows))
    # a customer's part: zeros in place of a longer history, what was seen, what is new
    size = history + held + new
    start = np.cumsum(size) - size
    known = np.zeros(size.sum())
    known[_places(start + history, held)] = seen
    known[_places(start + history + held, new)] = values[there]
    # events before each one, without those that have no revenue
    before = held[of] + np.cumsum(there) - there - (np.cumsum(new) - new)[of]
    counts = np.minimum(before, history)
    total = np.maximum(counts, 1)
    cents = np.rint(known * 100)
    if len(cents) and np.abs(cents).max() * history >= 2**31:  # squares pass 64 bits: whole numbers of any size
        cents = np.array([int(c) for c in cents], dtype=object)
    else:
        cents = cents.astype(np.int64)
    # differences of running sums; where these pass 64 bits the difference is right all the same
    zero, low = np.zeros(1, cents.dtype), start[of] + before
    first, second = (s[low + history] - s[low] for s in (np.concatenate([zero, np.cumsum(x)]) for x in (cents, cents * cents)))
    mean = np.where(counts > 0, first.astype(float) / 100.0 / total, values)
    spread = np.sqrt(np.maximum(total * second - first * first, 0).astype(float) / 1e4) / total
    z = (values - mean) / np.maximum(np.where(counts > 1, spread, 1.0), 0.01)
    size_of = np.abs(z)
    bands = np.select([size_of < b for b, _ in SEVERITY_BANDS], [n for _, n in SEVERITY_BANDS], "critical")
    columns = {
        "history_count": counts,
        "z_score": np.sign(z) * np.floor(size_of * 1000 + 0.5) / 1000,
        "is_spike": z > threshold,
        "is_drop": z < -threshold,
        "is_anomaly": size_of > threshold,
        "anomaly_severity": np.where(there, bands, None),
    }
    left = np.minimum(held + new, history)
    return columns, known[_places(start + size - left, left)], left


def score_rows(seen, values, history: int, threshold: float) -> tuple[dict, list[float]]:
    """Scores of one customer's revenues, and the history after them."""
    columns, kept, _ = score_customers(seen, [len(seen)], values, [len(values)], history, threshold)
    return columns, kept.tolist()


class Histories:
    """The last revenues of customers, in ascending order of the customers."""

    def __init__(self, customers, counts, revenues):
        self.customers, self.counts, self.revenues = customers, counts, revenues

    def _taken(self, at: np.ndarray) -> Histories:
        starts = np.cumsum(self.counts) - self.counts
        return Histories(self.customers[at], self.counts[at], self.revenues[_places(starts[at], self.counts[at])])

    def of(self, customers: np.ndarray) -> Histories:
        """Those of some customers, ascending; of new ones an empty history."""
        known = self._taken(np.flatnonzero(np.isin(self.customers, customers)))
        counts = np.zeros(len(customers), np.int64)
        counts[np.searchsorted(customers, known.customers)] = known.counts
        return Histories(customers, counts, known.revenues)

    def without(self, customers: np.ndarray) -> Histories:
        return self._taken(np.flatnonzero(~np.isin(self.customers, customers)))

    def replaced(self, new: Histories) -> Histories:
        old = self.without(new.customers)
        both = Histories(*(np.concatenate([getattr(x, k) for x in (old, new)]) for k in ("customers", "counts", "revenues")))
        return both._taken(np.argsort(both.customers))


def _latest(customers: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each customer once, ascending, with the newest time."""
    order = np.lexsort((times, customers))
    customers, times = customers[order], times[order]
    last = np.append(customers[1:] != customers[:-1], True)[: len(customers)]
    return customers[last], times[last]


def _stored(*arrays: np.ndarray) -> tuple[bytes, ...]:
    return tuple(x.tobytes() for x in arrays)


def _read(parts, *kinds) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(bytes(p), k) for p, k in zip(parts, kinds, strict=True))


def _processor(history: int, threshold: float, quiet_ms: int, span_ms: int):
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class EventScores(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            #: a bucket's customers with the newest event time seen of each, and their last revenues; arrays as bytes
            self.newest = handle.getValueState("newest", "customers binary, newest binary")
            self.past = handle.getValueState("past", "customers binary, counts binary, revenues binary")
            #: spans with waiting events, and in how many pieces each lies
            self.spans = handle.getValueState("spans", "spans array<bigint>, pieces array<int>")
            self.pieces = handle.getMapState(
                "pieces", "span bigint, piece int", "customers binary, ts binary, event_id binary, revenue binary"
            )

        def _open_spans(self) -> dict[int, int]:
            if not self.spans.exists():
                return {}
            spans, pieces = self.spans.get()
            return dict(zip(spans, pieces, strict=True))

        def _keep(self, spans: dict[int, int]) -> None:
            if spans:
                self.spans.update(([int(s) for s in spans], [int(n) for n in spans.values()]))
            elif self.spans.exists():
                self.spans.clear()

        def _newest(self) -> tuple[np.ndarray, np.ndarray]:
            return _read(self.newest.get() if self.newest.exists() else (b"", b""), np.int64, np.int64)

        def _past(self) -> Histories:
            return Histories(*_read(self.past.get() if self.past.exists() else (b"", b"", b""), np.int64, np.int64, np.float64))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            spans, latest = self._open_spans(), []
            known = set(spans)
            for frame in rows:  # a bucket's rows of a micro-batch come in Arrow batches of bounded size
                # rows without an id only move the time
                frame = frame[frame["named"] & frame["ts"].notna()]
                if not len(frame):
                    continue
                micros = frame["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
                customers, ids = frame["customer"].to_numpy(np.int64), frame["event_id"].to_numpy(np.int64)
                revenue = frame["revenue"].to_numpy(float)
                latest.append(_latest(customers, np.maximum(micros // 1000, 0)))
                of = micros // (span_ms * 1000)
                for span in np.unique(of):
                    at = of == span
                    piece = spans.get(int(span), 0)
                    self.pieces.updateValue((int(span), piece), _stored(customers[at], micros[at], ids[at], revenue[at]))
                    spans[int(span)] = piece + 1
            if latest:
                self.newest.update(_stored(*_latest(*map(np.concatenate, zip(self._newest(), *latest, strict=True)))))
                self._keep(spans)
                if not known or min(spans) < min(known):
                    self.handle.registerTimer((min(spans) + 1) * span_ms)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now, spans = timerValues.getCurrentWatermarkInMs(), self._open_spans()
            if not self.newest.exists():
                return
            due = [s for s in sorted(spans) if (s + 1) * span_ms <= now]
            past = self._past()
            for span in due:
                parts = [
                    _read(self.pieces.getValue((span, i)), np.int64, np.int64, np.int64, np.float64) for i in range(spans[span])
                ]
                customers, ts, ids, revenue = map(np.concatenate, zip(*parts, strict=True))
                order = np.lexsort((ids, ts, customers))
                own, rows = np.unique(customers, return_counts=True)
                seen = past.of(own)
                columns, kept, left = score_customers(seen.revenues, seen.counts, revenue[order], rows, history, threshold)
                past = past.replaced(Histories(own, left, kept))
                yield pd.DataFrame(
                    {
                        "customer_id": None if key[1] else customers[order], "event_id": ids[order],
                        "ts": pd.to_datetime(ts[order], unit="us"), "revenue": revenue[order], **columns,
                    }
                )
                for i in range(spans.pop(span)):
                    self.pieces.removeKey((span, i))
            customers, newest = self._newest()
            # what came last of a customer is scored: nothing of the customer waits
            scored = (newest // span_ms + 1) * span_ms <= now
            quiet = scored & (newest + quiet_ms <= now)
            if due:
                self._keep(spans)
            if quiet.all():
                self.newest.clear()
                self.past.clear()
            elif due or quiet.any():
                self.newest.update(_stored(customers[~quiet], newest[~quiet]))
                past = past.without(customers[quiet])
                self.past.update(_stored(past.customers, past.counts, past.revenues))
            if spans:
                self.handle.registerTimer((min(spans) + 1) * span_ms)
            if (scored & ~quiet).any():
                self.handle.registerTimer(int(newest[scored & ~quiet].min()) + quiet_ms)

        def close(self) -> None:
            pass

    return EventScores()


def stream_event_zscore(
    events: DataFrame,
    history: int = 50,
    threshold: float = 2.5,
    quiet_ms: int = 7 * 86_400_000,
    delay: str = "10 minutes",
    span_ms: int = 60_000,
    buckets: int = 512,
) -> DataFrame:
    """Score of each event against the last `history` events of its customer, in event time.

    An event is scored when the watermark has passed the end of its span of `span_ms`; a task holds one span and the
    histories of one bucket of customers at a time. A checkpoint goes on with the number of buckets it began with. Events
    that come after the watermark are left out. Rows without an event id only move the time.
    """
    return (
        events.withWatermark("ts", delay)
        .selectExpr(
            f"CAST(pmod(xxhash64(CAST(customer_id AS BIGINT)), {buckets}) AS INT) AS bucket", "customer_id IS NULL AS nobody",
            "CAST(coalesce(customer_id, 0) AS BIGINT) AS customer", "event_id IS NOT NULL AS named",
            "CAST(coalesce(event_id, 0) AS BIGINT) AS event_id", "ts", "CAST(revenue AS DOUBLE) AS revenue",
        )
        # events without a customer are a bucket of their own
        .groupBy("bucket", "nobody")
        .transformWithStateInPandas(
            _processor(history, threshold, quiet_ms, span_ms),
            outputStructType=OUTPUT,
            outputMode="append",
            timeMode="EventTime",
        )
    )
