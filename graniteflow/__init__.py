"""graniteflow: a PySpark-native engine for disclosure documents and the tables around them."""

__all__ = ["session"]
