"""Storage-tier analytics on PySpark: validate access events, keep per-dataset state, price tiers, plan moves."""
