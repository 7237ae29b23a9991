"""tickerloom: market-signal analytics over social posts, on Spark."""
