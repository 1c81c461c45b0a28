"""Writers of documents, indexes and datasets."""
