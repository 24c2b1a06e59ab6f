"""quillspark: document analytics on PySpark DataFrames."""
