"""folianth: book-structure analytics and document processing on Spark."""

__version__ = "0.1.0"
