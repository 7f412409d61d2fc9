"""corpusloom: document-corpus analytics written as PySpark DataFrame transformations."""
