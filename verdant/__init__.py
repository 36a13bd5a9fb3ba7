"""verdant: plant-sensor readings pipeline on Spark DataFrames."""

__version__ = "0.1.0"
