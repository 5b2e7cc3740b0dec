"""Analytics for noisy, multilingual message streams, as Spark plans."""
