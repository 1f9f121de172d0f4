"""perron: landing files to a published star schema of public-transport data, on Spark DataFrames."""
