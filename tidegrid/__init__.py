"""Panel time-series features, forecasting and reporting on Spark DataFrames."""
