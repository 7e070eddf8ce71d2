"""folioframe: page words in, structured and validated tables out, as Spark DataFrames."""
