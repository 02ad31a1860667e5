"""leafmill: document enrichment as Spark DataFrame transformations."""
