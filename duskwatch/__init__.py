"""Discovery, registry upkeep and daily content analysis of web addresses, on Spark DataFrames."""
