"""Document retrieval and multi-label tagging as Spark jobs over tables of documents and queries."""
