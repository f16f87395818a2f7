"""Counters of a streaming query, summed over its micro-batches."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def _get(obj, name: str):
    return obj.get(name) if isinstance(obj, dict) else getattr(obj, name, None)


class Progress:
    """Progress of a query by batch id, so no batch counts twice.

    A query remembers its last 100 batches: collect at least that often.
    """

    def __init__(self):
        self.by_batch: dict[int, object] = {}

    def collect(self, q: StreamingQuery) -> None:
        for p in q.recentProgress:
            at = int(_get(p, "batchId"))
            # an idle trigger reports the coming batch without rows
            if at not in self.by_batch or int(_get(p, "numInputRows") or 0):
                self.by_batch[at] = p

    def rows(self) -> list[int]:
        """Input rows of the micro-batches that had any, in order."""
        sizes = [int(_get(p, "numInputRows") or 0) for _, p in sorted(self.by_batch.items())]
        return [n for n in sizes if n]

    def totals(self) -> dict:
        """``groups_dropped_by_watermark`` counts what reaches the aggregation: partial groups, not flights."""
        out = {"batches": len(self.rows()), "input_rows": sum(self.rows()), "groups_dropped_by_watermark": 0}
        for p in self.by_batch.values():
            for op in _get(p, "stateOperators") or []:
                out["groups_dropped_by_watermark"] += int(_get(op, "numRowsDroppedByWatermark") or 0)
        return out
