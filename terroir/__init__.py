"""Market and taste analysis over daily ranked-chart snapshots, as Spark jobs."""
