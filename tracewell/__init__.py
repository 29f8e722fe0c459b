"""Agent-trace data work on Spark: conversations, trajectories, trials, logs."""
