"""The query registry and the independent SQL each query is compared with."""
