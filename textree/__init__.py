"""textree: labelled text corpora, TF-IDF tables and gain-ratio trees as Spark jobs."""
