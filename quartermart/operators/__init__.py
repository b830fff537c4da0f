"""Reusable DataFrame operators. Each takes a DataFrame and column names and
returns a DataFrame without running an action, with two exceptions:
``join.measure`` runs one aggregate over a dimension (one row reaches the
driver) to prove its size, and ``ranking.range_rank`` checkpoints its input to
``spark.checkpoint.dir`` to pin its range partitions."""
