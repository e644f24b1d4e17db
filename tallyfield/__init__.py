"""Spark jobs over product catalogues and training corpora."""
