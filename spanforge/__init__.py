"""Document-structure analytics on Spark: lines, spans, relations, slices and payloads as DataFrames."""
