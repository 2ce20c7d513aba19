"""Training-data operators on Spark tables of documents, pages and chats."""
