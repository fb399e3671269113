"""quillmark: aligning annotation values with document words, as Spark DataFrames."""
