"""Training-data operators: quality, chat, packing, near-duplicates, language models, WARC and HTML."""
