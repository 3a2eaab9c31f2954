"""judgeset: build and curate judged training datasets on Spark DataFrames."""
