"""ledgerline: financial-disclosure warehouse operators on Spark DataFrames."""
