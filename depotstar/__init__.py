"""Depotstar: a sales and supply-chain warehouse on Spark DataFrames."""
