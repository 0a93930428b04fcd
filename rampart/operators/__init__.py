"""DataFrame-in, DataFrame-out operators (policies, matching, events, reports)."""
