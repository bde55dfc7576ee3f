"""Structured Streaming over trace events: open calls and order violations per session as events arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "session_id string, events long, open_calls int, last_sequence int, violations int"
STATE = "events long, last int, violations int, calls array<string>"


def monitor(events: DataFrame) -> DataFrame:
    """Running status of each session; events: session_id, sequence, event_type, call_id.

    A gap or a step back in sequence, a repeated request and an answer without a request count as
    violations. A session's state is its open calls, bounded by what one agent run may have open.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        events_seen, last, violations, calls = state.get if state.exists else (0, -1, 0, [])
        calls = set(calls)
        rows = pd.concat(list(batches)).sort_values("sequence", kind="stable")
        for r in rows.itertuples():
            events_seen += 1
            violations += int(r.sequence != last + 1)
            last = max(last, int(r.sequence))
            if r.event_type == "tool_requested":
                violations += int(r.call_id in calls)
                calls.add(r.call_id)
            elif r.event_type == "tool_finished":
                violations += int(r.call_id not in calls)
                calls.discard(r.call_id)
        state.update((events_seen, last, violations, sorted(calls)))
        yield pd.DataFrame([(key[0], events_seen, len(calls), last, violations)], columns=[c.split()[0] for c in OUT.split(", ")])

    return events.groupBy("session_id").applyInPandasWithState(step, OUT, STATE, "update", GroupStateTimeout.NoTimeout)
