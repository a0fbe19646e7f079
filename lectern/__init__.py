"""Document collections to retrieval and question-answering benchmark datasets, as Spark plans."""
