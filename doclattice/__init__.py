"""doclattice: a PySpark-native engine for document structure, labelling and corpus preparation."""

__version__ = "0.1.0"
