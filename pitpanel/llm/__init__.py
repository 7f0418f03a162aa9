"""Operators for training-data pipelines: text, tokens, archives and embeddings, each as a Spark job."""
