"""Public licence texts, one file each, named by licence; read by :func:`tidemark.llm.licenses.full_texts`."""
