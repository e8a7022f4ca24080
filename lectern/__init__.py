"""lectern: analytics over ordered, hierarchical text corpora on PySpark."""
