"""Training-data operators on documents, pages and conversations. Nothing outside this folder imports it."""
