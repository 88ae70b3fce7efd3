"""The registered queries: one Spark plan and, where SQL can say it, one oracle each."""
