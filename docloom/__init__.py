"""docloom: document analytics over blocks, pages, tables and text, written for Spark DataFrames."""
