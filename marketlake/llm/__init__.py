"""Training-data operators (documents, conversations) and their queries."""
