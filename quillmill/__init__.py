"""quillmill: building and curating text-training corpora on PySpark."""
