"""tejido: corpus curation and text analytics expressed as Spark DataFrames."""
