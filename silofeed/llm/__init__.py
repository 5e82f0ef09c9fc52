"""Operators for preparing training data, as Spark jobs over tables of documents and pages."""
