"""eventide: event-stream analytics on Spark DataFrames and Structured Streaming.

Operators are functions ``DataFrame -> DataFrame`` with parameters (keys,
window sizes, bounds, patterns); the same operator serves stored tables and,
where marked, streams.  The most used ones are re-exported here::

    import eventide as ev
    ev.pv_uv(events, "ts", "user_id", "3 days", "1 day")
"""

from .operators.aggregates import (UserAggregate, count_by_key, distinct_per_window, pv_uv,
                                   running_count, running_max, sum_by_key, update_log, windowed_sum)
from .operators.joins import (connect_map, interval_join, previous_with_rule, reconcile,
                              window_cogroup, window_cogroup_members, window_join)
from .operators.late import late_split, late_window_counts
from .operators.patterns import StateMachine, consecutive, followed_by, run_state_machine, strict_sequence
from .operators.routing import route_split
from .operators.sequence import KeyedSequence
from .operators.topn import buffer_flush, top_n_per_window
from .operators.windows import session_ids, sessions, sliding, tumbling
from .session import apply_scale_settings, build_session, cut_lineage, ensure_checkpoint_dir

__all__ = [
    "KeyedSequence", "StateMachine", "UserAggregate", "apply_scale_settings", "buffer_flush",
    "build_session", "connect_map", "consecutive", "count_by_key", "cut_lineage",
    "distinct_per_window", "ensure_checkpoint_dir", "followed_by", "interval_join", "late_split",
    "late_window_counts", "previous_with_rule", "pv_uv", "reconcile", "route_split",
    "run_state_machine", "running_count", "running_max", "session_ids", "sessions", "sliding",
    "strict_sequence", "sum_by_key", "top_n_per_window", "tumbling", "update_log",
    "window_cogroup", "window_cogroup_members", "window_join", "windowed_sum",
]
