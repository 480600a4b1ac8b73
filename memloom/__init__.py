"""memloom: document-memory retrieval, evaluation and corpus preparation as Spark jobs."""
